"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that may meet in one task.
TASK_ROWS = 1_000_000
# Keys that may be listed as hot; the row limit grows with the data to keep to it.
HOT_KEYS = 100_000


def spread_join(
    many: DataFrame, few: DataFrame, on: str, weight: str, by: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Inner join of ``many`` and ``few`` on one column, hot keys spread over tasks.

    ``few`` says in ``weight`` how many rows of ``many`` have its key, and is best
    read from storage, since it is used several times.  A key above the limit is
    split into parts by the hash of column ``by``, and its rows of ``few`` go to
    each part.  The hot keys are broadcast: at most ``HOT_KEYS`` of them can exceed
    the limit, as it is no less than that share of all rows.
    """
    total = few.agg(F.sum(weight)).first()[0] or 0
    limit = max(task_rows, -(-total // HOT_KEYS))
    parts = F.ceil(F.col(weight) / limit).cast("int")
    hot = few.where(F.col(weight) > limit).select(on, parts.alias("_parts")).distinct()
    if hot.isEmpty():
        return many.join(few.drop(weight), on)
    part = F.pmod(F.xxhash64(by), F.coalesce(F.col("_parts"), F.lit(1)))
    marked = many.join(F.broadcast(hot), on, "left").withColumn("_part", part.cast("int")).drop("_parts")
    copies = few.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(weight)
    return marked.join(copies, [on, "_part"]).drop("_part")
