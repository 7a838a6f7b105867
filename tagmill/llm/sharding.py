"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import materialize


def shard_by_bytes(df: DataFrame, order: str, size: Column, shards: int, keep: dict[str, Column]) -> DataFrame:
    """Deal all rows, in the order of ``order``, to ``shards`` runs of nearly equal size.

    Rows are range-partitioned and sorted; each partition's total becomes the
    offset of the next, so a row's global prefix sum is its partition's offset
    plus a running sum inside the partition.  A row belongs to the shard in which
    the middle of its bytes falls, so a shard misses its target by less than one
    row at either end.

    Returns ``keep``, ``size``, ``shard`` and ``slot``, the position inside the
    shard from 0 without gaps.  Sizes are whole numbers, zero or more; NULL counts
    as zero.  NULL orders come first; rows with equal orders stand in any order
    among themselves.  If all sizes are zero, every row goes to shard 0.  Only the
    order, the size and ``keep`` are shuffled.  The dealt rows are written to the
    shared folder once, which fixes the partition of each row even if an executor
    is lost later.
    """
    rows = df.select(
        F.col(order).alias("_order"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        F.monotonically_increasing_id().alias("_tie"),
        *[c.alias(n) for n, c in keep.items()],
    )
    rows = rows.repartitionByRange("_order", "_tie").sortWithinPartitions("_order", "_tie")
    rows = materialize(rows.withColumn("_part", F.spark_partition_id()), "shards")
    parts = rows.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    # One row a partition of the shuffle above: their number is a setting, not data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    parts = parts.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.sum("_bytes").over(whole).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy("_order", "_tie")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("_upto", upto).withColumn("_nth", F.row_number().over(inside) - 1)
    placed = placed.join(F.broadcast(parts), "_part")
    middle = (F.col("_byte0") + F.col("_upto") - F.col("size") / 2) / F.nullif("_total", F.lit(0))
    placed = placed.withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor(F.coalesce(middle, F.lit(0.0)) * shards)).cast("int")
    ).withColumn("_row", F.col("_row0") + F.col("_nth"))
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *keep, "size", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )
