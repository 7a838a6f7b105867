"""Behaviour events: day slices, deduplication and duplicate counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.dates import on_grid, shift

# The columns that make an event (fixed values).
EVENT_COLUMNS = [
    "distinct_id", "dt", "tm", "event_duration", "title", "screen_name", "url", "url_path", "referrer",
    "element_id", "element_name", "element_type", "element_content", "element_position", "element_selector",
    "element_target_url", "element_class_name", "city", "province", "utm_source", "utm_medium", "utm_term",
    "utm_content", "utm_campaign", "manufacturer", "model", "os", "os_version", "platform", "product", "event",
]

# Days between an event and its export (fixed value).
LATE_DAYS = 7


def day_slice(events: DataFrame, execution_date: str, days_back: int = LATE_DAYS, dt: str = "dt") -> DataFrame:
    """The day ``days_back`` days before ``execution_date``.

    ``dt`` stays bare in the predicate, so a partitioned table is pruned to one day.
    """
    kind = events.schema[dt].dataType
    return events.where(F.col(dt) == F.lit(shift(execution_date, -days_back)).cast(kind))


def look_back(events: DataFrame, base: str, days: int = 30, dt: str = "dt") -> DataFrame:
    """The ``days`` days before ``base`` and ``base`` itself."""
    kind = events.schema[dt].dataType
    return events.where(F.col(dt).between(F.lit(shift(base, -days)).cast(kind), F.lit(base).cast(kind)))


def snapshots_on_grid(table: DataFrame, anchor: str, step: int = 14, dt: str = "dt") -> DataFrame:
    """Rows of every ``step``-th day counted from ``anchor``."""
    return table.where(on_grid(F.col(dt), anchor, step))


def dedup_events(events: DataFrame, subset: list[str] | None = None, order_by: str | None = None) -> DataFrame:
    """One row per distinct ``subset``; NULLs are equal to each other.

    Copies combine before the shuffle, so an event with any number of them is one
    row per task.  Columns beyond the subset come from the row with the smallest
    ``order_by``; without it from any row.
    """
    subset = subset or EVENT_COLUMNS
    rest = [c for c in events.columns if c not in subset]
    if not rest or order_by is None:
        return events.dropDuplicates(subset)
    first = F.min(F.struct(order_by, *[c for c in rest if c != order_by])).alias("_first")
    merged = events.groupBy(*subset).agg(first)
    return merged.select(*[F.col(c) if c in subset and c != order_by else F.col(f"_first.{c}") for c in events.columns])


def merged_events(events: DataFrame, subset: list[str] | None = None, copies: str = "_copies") -> DataFrame:
    """The distinct ``subset`` rows with the number of events each stands for."""
    return events.groupBy(*(subset or EVENT_COLUMNS)).agg(F.count(F.lit(1)).alias(copies))


def duplicate_report(events: DataFrame, subset: list[str] | None = None, user: str = "distinct_id") -> DataFrame:
    """``rows_before, rows_after, users`` of a deduplication, counted in one job."""
    subset = subset or EVENT_COLUMNS
    merged = merged_events(events, subset)
    by_user = merged.groupBy(user).agg(F.sum("_copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    return by_user.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("rows_after"),
        F.count(user).alias("users"),
    )
