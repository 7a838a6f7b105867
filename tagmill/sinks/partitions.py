"""Partitioned tables on shared storage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagmill.session import scratch_path
from tagmill.sinks.schemas import reconciled
from tagmill.sources.tables import checked_name


def _spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring rows of a partition together; AQE splits large ones and merges small ones."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def counted(df: DataFrame, copies: str | None = None) -> tuple[DataFrame, Observation]:
    """Count rows on their way to the sink.

    The counter sits after the last shuffle, where Spark counts a task once even
    if it ran again on another executor.  ``copies`` names a column that says how many
    rows each one stands for; it is added up as ``before`` and dropped.
    """
    seen = Observation()
    sums = [F.coalesce(F.sum(copies), F.lit(0)).alias("before")] if copies else []
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums)
    return (out.drop(copies) if copies else out), seen


def create_like(spark: SparkSession, table: str, df: DataFrame, partition_by=(), path: str | None = None) -> None:
    """Create an empty Parquet table with the columns of ``df`` unless it exists."""
    ddl = f"CREATE TABLE IF NOT EXISTS {checked_name(table)} ({df.schema.toDDL()}) USING parquet"
    if partition_by:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if path:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        ddl += f" LOCATION '{escaped}'"
    spark.sql(ddl)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(checked_name(table)) if c.isPartition]


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """Which partitions an overwrite replaces, for the writes inside; nothing is set if it holds already."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    if before.lower() == mode:
        yield
        return
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def clear_partition(spark: SparkSession, table: str, column: str, value: str) -> None:
    """Leave one partition of a table without rows; ``column`` is its only partition column."""
    spec = _partition_spec(column, value)
    kept = [f for f in spark.table(checked_name(table)).schema.fields if f.name != column]
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in kept)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {columns} WHERE false")


def replace_partition(df: DataFrame, table: str, column: str, value: str) -> int:
    """``overwrite_partitions`` for rows of one partition; without rows the partition is emptied."""
    rows = overwrite_partitions(df, table)
    if not rows:
        clear_partition(df.sparkSession, table, column, value)
    return rows


def overwrite_partitions(df: DataFrame, table: str) -> int:
    """Replace the partitions ``df`` has rows for, keep all others; returns the row count.

    Columns are matched by name, and the table follows the source as ``reconciled``
    says.  An empty ``df`` touches no partition.
    """
    spark = df.sparkSession
    keys = partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} has no partitions; use overwrite_table")
    out, seen = counted(_spread(reconciled(df, table, keys), keys))
    with _overwrite_mode(spark, "dynamic"):
        out.write.insertInto(table, overwrite=True)
    return seen.get["rows"]


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table's files."""
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {checked_name(table)}").where("col_name = 'Location'")
    return facts.first().data_type.rstrip("/")


def partition_location(spark: SparkSession, table: str, column: str, value: str) -> str | None:
    """Folder a partition is read from, or None where the catalog has no such partition."""
    spec = _partition_spec(column, value)
    if not spark.sql(f"SHOW PARTITIONS {checked_name(table)} PARTITION ({spec})").count():
        return None
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'")
    return facts.first().data_type


def _partition_spec(column: str, value: str) -> str:
    if not all(c.isalnum() or c in "-_" for c in value):
        raise ValueError(f"not a plain partition value: {value!r}")
    return f"`{checked_name(column)}` = '{value}'"


def publish_partition(df: DataFrame, table: str, column: str, value: str) -> int:
    """Put ``df`` in place of one partition in a single step; returns the row count.

    The rows, or none, go to a fresh folder beside the table's own.  What the folder holds is then counted
    again, and only if it is all that was written does the catalog point the partition
    there.  Until that step, and for good if a job dies before it, readers see the
    partition as it was.  Folders of earlier publications stay for readers that are
    still at them; ``stale_folders`` lists them.  ``column`` is the table's only partition
    column; a row of another value is an error.  Read such a table through the catalog.
    """
    spark = df.sparkSession
    spec = _partition_spec(column, value)
    if partition_columns(spark, table) != [column]:
        raise ValueError(f"{table} is not partitioned by {column} alone")
    rows = reconciled(df, table, [column])
    part = F.col(column)
    inside = F.when(part == F.lit(value).cast(rows.schema[column].dataType), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"row outside {column} = {value}")).cast("boolean")
    )
    out, seen = counted(rows.where(inside).drop(column).hint("rebalance"))
    path = f"{_versions(spark, table)}/{column}={value}/{uuid.uuid4().hex}"
    out.write.parquet(path)
    sent = seen.get["rows"]
    held = spark.read.schema(out.schema).parquet(path).count()
    if held != sent:
        raise RuntimeError(f"{path} holds {held} rows, {sent} were written; nothing is published")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return sent


def _versions(spark: SparkSession, table: str) -> str:
    return f"{table_location(spark, table)}__versions"


def stale_folders(spark: SparkSession, table: str, column: str, value: str) -> list[str]:
    """Folders of a partition's publications that the catalog does not point to, failed ones included."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{_versions(spark, table)}/{checked_name(column)}={value}")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    now = partition_location(spark, table, column, value)
    found = [status.getPath() for status in files.listStatus(root)]
    return sorted(p.toString() for p in found if not now or p.getName() != now.rstrip("/").rsplit("/", 1)[-1])


def overwrite_paths(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """``overwrite_partitions`` for a folder without a catalog entry."""
    return _write_paths(df, path, partition_by)["rows"]


def _write_paths(df: DataFrame, path: str, partition_by: list[str], copies: str | None = None) -> dict[str, int]:
    out, seen = counted(_spread(df, partition_by), copies)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return seen.get


def overwrite_table(df: DataFrame, table: str) -> int:
    """Replace all rows of a table, of every partition; an empty ``df`` empties it.

    The table follows the source's columns as ``reconciled`` says.  The rows are written once.  Only a ``df`` that reads the table itself is written
    aside first.
    """
    spark = df.sparkSession
    rows = reconciled(df, checked_name(table), partition_columns(spark, table))
    with _overwrite_mode(spark, "static"):
        out, seen = counted(rows)
        try:
            out.write.insertInto(table, overwrite=True)
        except AnalysisException as error:
            if "UNSUPPORTED_OVERWRITE" not in (error.getCondition() or ""):
                raise
            path = scratch_path(spark, "overwrite")
            out, seen = counted(rows)
            out.write.parquet(path)
            spark.read.schema(rows.schema).parquet(path).write.insertInto(table, overwrite=True)
    return seen.get["rows"]


def replace_day(df: DataFrame, path: str, day: str, dt: str = "dt") -> int:
    """Replace one day of a folder partitioned by ``dt``; a row of another day is an error.

    A day without rows leaves an empty partition in place of the old rows.
    """
    return replace_day_counted(df, path, day, dt)["rows"]


def replace_day_counted(df: DataFrame, path: str, day: str, dt: str = "dt", copies: str | None = None) -> dict[str, int]:
    """``replace_day`` that returns its counts: ``rows``, and ``before`` if there are ``copies``, from the writing job."""
    kind = df.schema[dt].dataType
    checked = F.when(F.col(dt) == F.lit(day).cast(kind), F.col(dt)).otherwise(
        F.raise_error(F.lit(f"row outside {day}")).cast(kind)
    )
    counts = _write_paths(df.withColumn(dt, checked), path, [dt], copies)
    if not counts["rows"]:
        folder = f"{path.rstrip('/')}/{checked_name(dt)}={date.fromisoformat(day).isoformat()}"
        df.drop(dt, *([copies] if copies else [])).limit(0).write.mode("overwrite").parquet(folder)
    return counts
