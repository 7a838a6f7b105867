"""Exports of query results, of one day of events and of previews."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.bounds import bounded_values
from tagmill.functions.dates import month_name, shift
from tagmill.operators.events import LATE_DAYS, day_slice, dedup_events, merged_events
from tagmill.operators.flags import MAX_LABELS, count_matrix
from tagmill.sinks.jdbc import overwrite_jdbc, publish_day, write_snapshot
from tagmill.sinks.partitions import replace_day, replace_day_counted
from tagmill.sources.jdbc import Connection
from tagmill.sources.tables import preview, run_template


def template_export(
    spark: SparkSession, text: str, connection: Connection | str, table: str, day: str, names=None, args=None, **frames
) -> str:
    """Publish the result of a query text, ``:baseTime`` bound, as the table of ``day``."""
    result = run_template(spark, text, names, {"baseTime": day, **(args or {})}, **frames)
    return write_snapshot(result, connection, table, day)


def template_exports(
    spark: SparkSession, texts: dict[str, str], connection: Connection | str, day: str, parallel: int = 4, **options
) -> list[str]:
    """``template_export`` for several tables, such as the second-level interests, ``parallel`` at a time.

    All are tried; the first error is raised when the others have ended.
    """
    with ThreadPoolExecutor(parallel) as pool:
        runs = [pool.submit(template_export, spark, text, connection, table, day, **options) for table, text in texts.items()]
    return [run.result() for run in runs]


def activity_counts(facts: DataFrame, key: str, activity: str, activities: list[str] | None = None) -> DataFrame:
    """How often each user took part in each activity, one column per activity."""
    if activities is None:
        activities = bounded_values(facts, activity, MAX_LABELS, "activities")
    return count_matrix(facts, key, activity, activities)


def daily_events(events: DataFrame, execution_date: str, dt: str = "dt") -> DataFrame:
    """Distinct events of the day an export on ``execution_date`` covers."""
    return dedup_events(day_slice(events, execution_date, dt=dt))


def daily_event_export(events: DataFrame, execution_date: str, connection: Connection, table: str) -> str:
    """Replace the day in the relational table of its month; ``table`` holds ``yyyymm``."""
    day = shift(execution_date, -LATE_DAYS)
    name = month_name(table, day)
    publish_day(daily_events(events, execution_date), connection, f"{name}_staging", name, day)
    return name


def daily_event_files(events: DataFrame, execution_date: str, path: str) -> int:
    """Replace the day in a folder partitioned by ``dt``; returns the row count."""
    return replace_day(daily_events(events, execution_date), path, shift(execution_date, -LATE_DAYS))


def daily_event_counts(events: DataFrame, execution_date: str, path: str, dt: str = "dt") -> tuple[int, int]:
    """``daily_event_files`` that returns the day's events before and after the deduplication.

    Both are counted by the job that writes: every distinct event carries its number of
    copies over the last shuffle, so no count reads the events again.
    """
    day = shift(execution_date, -LATE_DAYS)
    rows = merged_events(day_slice(events, execution_date, dt=dt))
    counts = replace_day_counted(rows, path, day, dt, copies="_copies")
    return counts["before"], counts["rows"]


def preview_export(table: DataFrame, connection: Connection, target: str, rows: int = 10) -> None:
    overwrite_jdbc(preview(table, rows), connection, target)


def publish_through_staging(df: DataFrame, connection: Connection, staging: str, table: str, day: str, dt: str) -> None:
    """Truncate and fill a staging table, then move the day to production."""
    publish_day(df.where(F.col(dt) == F.lit(day).cast(df.schema[dt].dataType)), connection, staging, table, day, dt)
