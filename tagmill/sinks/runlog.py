"""The run log: one row per task and run date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.sinks.partitions import overwrite_paths

COLUMNS = ["task_id", "run_date", "hive_db", "target_table", "row_count"]
SCHEMA = "task_id string, run_date date, hive_db string, target_table string, row_count bigint"


def replace_log(entries: DataFrame, path: str) -> None:
    """Put ``entries`` in the log in place of earlier ones of the same task and date."""
    overwrite_paths(entries.select(*COLUMNS), path, ["run_date", "task_id"])


def read_log(spark, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).select(*COLUMNS)


def log_run(spark, path: str, task_id: str, run_date: str, hive_db: str, target_table: str, row_count: int) -> None:
    """Log one finished run; call it last, after its rows are written."""
    replace_log(
        spark.range(1).select(
            F.lit(task_id).alias("task_id"),
            F.lit(run_date).cast("date").alias("run_date"),
            F.lit(hive_db).alias("hive_db"),
            F.lit(target_table).alias("target_table"),
            F.lit(row_count).cast("bigint").alias("row_count"),
        ),
        path,
    )
