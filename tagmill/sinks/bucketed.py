"""User tables laid out by user, so that joins on the user move no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.text import quoted
from tagmill.sources.tables import checked_name

# Buckets of a user table; tables that are joined must agree on it.
BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Replace ``table`` by ``df``, dealt to ``buckets`` files by the hash of ``key`` and sorted by it.

    Rows are dealt to as many tasks first, so a bucket is one file.
    """
    dealt = df.repartition(buckets, F.col(quoted(key)))
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(checked_name(table))


def side_by_side(spark, left: str, right: str, key: str) -> DataFrame:
    """All users of two bucketed tables with the columns of both, without an exchange.

    Each bucket meets the bucket of the same number; a user of one table only has
    NULL in the other's columns.  Other column names must differ.
    """
    a, b = spark.table(checked_name(left)), spark.table(checked_name(right))
    clash = {c.lower() for c in a.columns} & {c.lower() for c in b.columns} - {key.lower()}
    if clash:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")
    return a.join(b, key, "full_outer")
