"""Dates as a table: snapshot grids and look-back windows joined to events partitioned by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.bounds import TooLarge
from tagmill.functions.dates import on_grid
from tagmill.session import materialize

# Days a calendar may hold: some 270 years, sent to all tasks.
MAX_DAYS = 100_000


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``(day, month, weekday)`` for all days from ``first`` to ``last``, as a stored table.

    A stored table is what Spark can filter first and then use to choose partitions.
    """
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    dated = days.select("day", F.date_format("day", "yyyyMM").alias("month"), F.dayofweek("day").alias("weekday"))
    return materialize(dated.coalesce(1), "calendar")


def on_days(events: DataFrame, days: DataFrame, dt: str = "dt") -> DataFrame:
    """Events of the days of ``days`` (column ``day``), a filtered calendar.

    The calendar's size is checked and it is sent to all tasks; if ``events`` is partitioned by
    ``dt``, Spark reads only the partitions that the filtered calendar names.
    """
    if days.limit(MAX_DAYS + 1).count() > MAX_DAYS:
        raise TooLarge(f"calendar: more than {MAX_DAYS} days")
    chosen = F.broadcast(days.select(F.col("day").alias("_day")).distinct())
    return events.join(chosen, F.col(dt) == F.col("_day")).drop("_day")


def snapshots_by_calendar(events: DataFrame, days: DataFrame, anchor: str, step: int = 14, dt: str = "dt") -> DataFrame:
    """Events of every ``step``-th day from ``anchor`` that the calendar holds."""
    return on_days(events, days.where(on_grid(F.col("day"), anchor, step)), dt)


def look_backs(days: DataFrame, bases: Column, length: int) -> DataFrame:
    """``(base, day)``: for each calendar day where ``bases`` holds, itself and the ``length`` days before."""
    span = F.sequence(F.date_sub("day", length), F.col("day"))
    return days.where(bases).select(F.col("day").alias("base"), F.explode(span).alias("day"))


def events_in_windows(events: DataFrame, windows: DataFrame, dt: str = "dt") -> DataFrame:
    """Events once for each window (``base``, ``day``) that holds their day; only days of windows are read."""
    if windows.limit(MAX_DAYS + 1).count() > MAX_DAYS:
        raise TooLarge(f"windows: more than {MAX_DAYS} days")
    named = F.broadcast(windows.select("base", F.col("day").alias("_day")))
    return events.join(named, F.col(dt) == F.col("_day")).drop("_day")


def daily_sketches(events: DataFrame, user: str = "distinct_id", dt: str = "dt", bits: int = 14) -> DataFrame:
    """``(dt, users)``: one HyperLogLog sketch of the users of each day, of at most 2**bits bytes.

    Sketches combine before the shuffle, so a day's users are never gathered.  Days are
    final: a sketch is computed once and merged for any window.
    """
    return events.where(F.col(user).isNotNull()).groupBy(dt).agg(F.hll_sketch_agg(user, F.lit(bits)).alias("users"))


def users_in_windows(sketches: DataFrame, windows: DataFrame, dt: str = "dt") -> DataFrame:
    """``(base, users)``: about how many distinct users the days of each window have, by merging their sketches."""
    inside = events_in_windows(sketches, windows, dt)
    merged = inside.groupBy("base").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
    return windows.select("base").distinct().join(merged, "base", "left").select("base", F.coalesce("users", F.lit(0)).alias("users"))
