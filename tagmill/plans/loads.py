"""Mirroring tables into the warehouse and loading vendor files.

How the three load patterns compare keys is this library's contract; see each
function.  Every load may be run again for the same date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagmill.functions.dates import month_of
from tagmill.functions.text import quoted
from tagmill.session import materialize
from tagmill.sinks.partitions import create_like, overwrite_partitions, overwrite_table, replace_partition
from tagmill.sources.files import BAD_LINE, good_and_bad, read_deliveries, read_vendor_file
from tagmill.sources.jdbc import Connection, equal_depth_predicates, read_jdbc
from tagmill.sources.tables import LoadSpec

# Tasks that read a mirrored table.
READ_TASKS = 32
LOAD_DATE = "load_dt"
MONTH = "yyyymm"


def load_full(source: DataFrame, table: str, path: str | None = None) -> int:
    """Replace a table, with all its partitions, by its source, rows or none."""
    create_like(source.sparkSession, table, source, path=path)
    return overwrite_table(source, table)


def load_append(source: DataFrame, table: str, key: str, execution_date: str, path: str | None = None) -> int:
    """Add the rows that earlier loads do not hold, by ``key``.

    ``source`` is the whole table as it is now.  Rows with a key above the largest one of all
    earlier loads are new.  Of rows with that very key, or without a key, and equal in all
    columns, as many are new as the source has more than is stored, so late ones arrive,
    a second equal one too; keys below the largest count as loaded.  Rows are kept by load
    date: a repeated run replaces its own rows only, also by none.  A load before the
    latest one is refused, as it would take rows that later loads already hold.
    """
    spark = source.sparkSession
    dated = source.withColumn(LOAD_DATE, F.lit(execution_date).cast("date"))
    create_like(spark, table, dated, [LOAD_DATE], path)
    loads = sorted(row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator())
    if loads and loads[-1] > execution_date:
        raise ValueError(f"{table} holds a load of {loads[-1]}, after {execution_date}")
    if any(d < execution_date for d in loads):
        stored = spark.table(table).where(F.col(LOAD_DATE) < F.lit(execution_date).cast("date"))
        largest = F.lit(stored.agg(F.max(key)).first()[0]).cast(source.schema[key].dataType)
        edge = F.col(key).isNull() | F.coalesce(F.col(key) == largest, F.lit(False))
        above = dated.where(F.coalesce(F.col(key) > largest, F.col(key).isNotNull() & largest.isNull()))
        late = source.where(edge).exceptAll(_as_delivered(stored.where(edge), source.schema))
        dated = above.unionByName(late.withColumn(LOAD_DATE, F.lit(execution_date).cast("date")))
        # The stored rows are read while their table is written.
        dated = materialize(dated, "append")
    return replace_partition(dated, table, LOAD_DATE, execution_date)


def _as_delivered(stored: DataFrame, schema: StructType) -> DataFrame:
    """Stored rows in the columns and types of a delivery; a column the table lacks is NULL."""
    known = {c.lower() for c in stored.columns}
    return stored.select(
        *[(F.col(quoted(f.name)) if f.name.lower() in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def month_bounds(day: str) -> tuple[str, str]:
    """First day of the month of ``day`` and of the month after."""
    first = date.fromisoformat(day).replace(day=1)
    return first.isoformat(), date(first.year + first.month // 12, first.month % 12 + 1, 1).isoformat()


def load_month(
    source: DataFrame, table: str, key: str, execution_date: str | None = None, path: str | None = None
) -> int:
    """Replace the month of ``execution_date``, also by no rows, or every month the source has.

    The month is cut by a range of the bare ``key``, which partitioned files and
    relational servers can evaluate themselves.
    """
    rows = source.withColumn(MONTH, month_of(F.col(key)))
    create_like(source.sparkSession, table, rows, [MONTH], path)
    if execution_date:
        kind = source.schema[key].dataType
        low, high = (F.lit(d).cast(kind) for d in month_bounds(execution_date))
        rows = rows.where((F.col(key) >= low) & (F.col(key) < high))
        return replace_partition(rows, table, MONTH, execution_date[:7].replace("-", ""))
    return overwrite_partitions(rows, table)


def load(source: DataFrame, spec: LoadSpec, execution_date: str, path: str | None = None) -> int:
    """Load ``source`` by the pattern of its specification."""
    if spec.pattern_type == "full":
        return load_full(source, spec.target, path)
    if spec.pattern_type == "append":
        return load_append(source, spec.target, spec.key_to_new_data, execution_date, path)
    return load_month(source, spec.target, spec.key_to_new_data, execution_date, path)


def mirror(
    spark: SparkSession, connection: Connection, spec: LoadSpec, execution_date: str, one_task: bool = False, **reading
) -> int:
    """``load`` from the relational table of the specification.

    The table is read in parallel by ranges of ``split_by``, by default the key of new
    data: by ranges of equally many rows where an earlier mirror tells its quantiles, else by equally wide ones.
    Reading it in one task must be asked for.
    """
    split_by = reading.pop("split_by", None) or spec.key_to_new_data
    if not one_task:
        if not split_by:
            raise ValueError(f"{spec.table}: name split_by, or ask for one_task")
        if spark.catalog.tableExists(spec.target):
            parts = reading.get("partitions", READ_TASKS)
            reading["predicates"] = equal_depth_predicates(spark.table(spec.target), split_by, parts)
        else:
            reading["split_by"] = split_by
    return load(read_jdbc(spark, connection, spec.table, **reading), spec, execution_date)


def refresh_mapping(source: DataFrame, table: str, path: str | None = None) -> int:
    """Replace a mapping table, such as the rule map."""
    return load_full(source, table, path)


def load_vendor_file(
    spark: SparkSession,
    files: str,
    schema: StructType,
    table: str,
    day: str,
    *,
    dt: str = "dt",
    bad_lines: int = 0,
    path: str | None = None,
    **reading,
) -> int:
    """Read a delivery, stage it, and replace the day of ``table`` by it.

    More than ``bad_lines`` unreadable lines stop the load before the table is touched.
    """
    staged = materialize(read_vendor_file(spark, files, schema, **reading), "vendor")
    good, bad = good_and_bad(staged)
    broken = bad.count()
    if broken > bad_lines:
        sample = "; ".join(str(r[BAD_LINE]) for r in bad.limit(3).collect())
        raise ValueError(f"{broken} unreadable lines in {files}, such as: {sample}")
    dated = good.withColumn(dt, F.lit(day).cast("date"))
    create_like(spark, table, dated, [dt], path)
    return replace_partition(dated, table, dt, day)


def load_deliveries(
    spark: SparkSession, files: str, schema: StructType, table: str, quarantine: str, day: str, *, dt: str = "dt", path: str | None = None, **reading
) -> tuple[int, int]:
    """Replace the day of ``table`` by the readable rows of all files and that of ``quarantine`` by the others.

    Returns how many rows went to each.  Good rows keep the name of their file in
    ``source_file``; a line in quarantine keeps its text, its file and the reason.  Both tables
    may be loaded again for the same day; ``path`` is the folder of both tables, each below its own name.
    """
    good, bad = read_deliveries(spark, files, schema, **reading)
    sent = []
    for rows, name in ((good, table), (bad, quarantine)):
        dated = rows.withColumn(dt, F.lit(day).cast("date"))
        create_like(spark, name, dated, [dt], f"{path.rstrip('/')}/{name}" if path else None)
        sent.append(replace_partition(dated, name, dt, day))
    return sent[0], sent[1]
