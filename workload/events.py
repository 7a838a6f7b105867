"""Event slices, deduplication and date rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.dates import compact, event_instant, month_name, month_of, on_grid, parse_tm, shift, table_suffix, underscored
from tagmill.functions.types import cast_wide
from tagmill.operators import calendar as calendars
from tagmill.operators import events as ops
from tagmill.plans import exports
from tagmill.plans.exports import daily_event_files
from tagmill.session import materialize, scratch_path
from tagmill.sinks.partitions import overwrite_paths
from tagmill.sources.tables import preview, run_template, run_text_template
from workload.inputs import EVENTS_SQL, OTHER_SQL, delivered_twice, events, table

_SHOWN = ["distinct_id", "dt", "tm", "event_duration", "element_content", "event"]


def event_day_slice(spark, folder):
    return ops.day_slice(events(spark, folder), "2024-01-15").select("event_id", *_SHOWN)


def event_lookback(spark, folder):
    return ops.look_back(events(spark, folder), "2024-01-20", 10).select("event_id", *_SHOWN)


def event_tm_parse(spark, folder):
    return events(spark, folder).select("event_id", parse_tm(F.col("tm")).alias("tm"))


def event_tm_instant(spark, folder):
    """Event times of the export's zone as instants in UTC."""
    return events(spark, folder).select("event_id", event_instant(F.col("tm")).alias("instant"))


def export_names(spark, folder):
    """Names an export of 1998-01-07 gives to what it writes about the day a week before."""
    day = shift("1998-01-07", -7)
    orders = table(spark, folder, "orders").where(F.to_date("o_orderdate") == F.lit(day).cast("date"))
    return orders.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(month_name("event_yyyymm", day)).alias("monthly"),
        F.lit(compact(day)).alias("compact"),
        F.lit(table_suffix(day)).alias("suffix"),
        "row_count",
    )


def template_export_files(spark, folder):
    """The template's result as the snapshot of a date on shared storage."""
    root = scratch_path(spark, "snapshots")
    source = table(spark, folder, "events")
    name = exports.template_export(
        spark, _TEMPLATE, root, "interest", "2024-01-20", names={"key": "user_id"}, source=source
    )
    return spark.read.parquet(f"{root}/{name}").withColumn("name", F.lit(name))


_LEVEL2 = {
    "by_type": "SELECT event_type AS name, count(*) AS rows FROM {source} WHERE ts < cast(:baseTime AS timestamp_ntz) GROUP BY 1",
    "by_user": "SELECT cast({key} AS string) AS name, count(*) AS rows FROM {source} GROUP BY 1",
    "by_day": "SELECT date_format(ts, 'yyyyMMdd') AS name, count(*) AS rows FROM {source} GROUP BY 1",
}


def template_exports_files(spark, folder):
    """Several templates, each the snapshot of a date on shared storage."""
    root = scratch_path(spark, "snapshots")
    names = exports.template_exports(
        spark, _LEVEL2, root, "2024-01-20", names={"key": "user_id"}, source=table(spark, folder, "events")
    )
    held = [spark.read.parquet(f"{root}/{name}").withColumn("snapshot", F.lit(name)) for name in names]
    return held[0].unionAll(held[1]).unionAll(held[2])


def event_dedup(spark, folder):
    return ops.dedup_events(delivered_twice(spark, folder))


def event_dedup_first(spark, folder):
    """The first event of each user, day and type."""
    rows = events(spark, folder).select("event_id", *_SHOWN)
    return ops.dedup_events(rows, ["distinct_id", "dt", "event"], order_by="event_id")


def event_dup_report(spark, folder):
    return ops.duplicate_report(delivered_twice(spark, folder))


def event_day_replace(spark, folder):
    """All days hold doubled rows; the export replaces the day seven days back, twice."""
    rows, path = delivered_twice(spark, folder), scratch_path(spark, "events")
    overwrite_paths(rows, path, ["dt"])
    for _ in range(2):
        daily_event_files(rows, "2024-01-15", path)
    return spark.read.schema(rows.schema).parquet(path)


def event_day_counts(spark, folder):
    """The replaced day with the counts of its writing job: events before and after the deduplication."""
    rows, path = delivered_twice(spark, folder), scratch_path(spark, "events")
    before, after = exports.daily_event_counts(rows, "2024-01-22", path)
    written = spark.read.schema(rows.schema).parquet(path)
    return written.withColumns({"rows_before": F.lit(before).cast("bigint"), "rows_after": F.lit(after).cast("bigint")})


def _events_by_day(spark, folder, columns=("event_id", "distinct_id", "event")):
    """The events as a folder partitioned by day."""
    path = scratch_path(spark, "by-day")
    rows = events(spark, folder).select(*columns, "dt")
    overwrite_paths(rows, path, ["dt"])
    return spark.read.schema(rows.schema).parquet(path)


def calendar_snapshots(spark, folder):
    """Every third day of a partitioned event table, chosen by a date table."""
    days = calendars.calendar(spark, "2023-12-01", "2024-03-31")
    return calendars.snapshots_by_calendar(_events_by_day(spark, folder), days, "2024-01-05", 3)


def calendar_windows(spark, folder):
    """Events and users of the seven days up to each Sunday."""
    days = calendars.calendar(spark, "2024-01-01", "2024-02-05")
    windows = calendars.look_backs(days, F.col("weekday") == 1, 6)
    inside = calendars.events_in_windows(_events_by_day(spark, folder), windows)
    return inside.groupBy("base").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("distinct_id").alias("users"))


def user_sketches(spark, folder):
    """Distinct users of look-back windows: exact, and whether merged daily sketches are within 3 %."""
    rows = _events_by_day(spark, folder)
    stored = materialize(calendars.daily_sketches(rows), "sketches")
    days = calendars.calendar(spark, "2024-01-01", "2024-02-05")
    windows = calendars.look_backs(days, F.col("weekday").isin(1, 4), 10)
    exact = calendars.events_in_windows(rows, windows).groupBy("base").agg(F.countDistinct("distinct_id").alias("exact"))
    both = calendars.users_in_windows(stored, windows).join(exact, "base", "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    return both.select("base", "exact", (F.abs(F.col("users") - F.col("exact")) * 100 <= F.col("exact") * 3).alias("close"))


def monthly_name_rollup(spark, folder):
    """Orders per monthly table of an export."""
    orders = table(spark, folder, "orders")
    name = F.concat(F.lit(month_name("event_", "2024-01-01")), month_of(F.col("o_orderdate")))
    return orders.groupBy(name.alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))


def biweekly_snapshots(spark, folder):
    orders = table(spark, folder, "orders").withColumn("dt", F.to_date("o_orderdate"))
    return ops.snapshots_on_grid(orders, "1998-01-05").select("o_orderkey", "dt")


def date_functions(spark, folder):
    day = F.to_date("l_shipdate")
    return table(spark, folder, "lineitem").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("row_count")).select(
        "day",
        "row_count",
        F.date_sub("day", 7).alias("week_before"),
        underscored(F.col("day")).alias("suffix"),
        F.date_format("day", "yyyyMMdd").alias("compact"),
        on_grid(F.col("day"), "1998-01-05").alias("on_grid"),
    )


def typed_wide(spark, folder):
    kinds = {
        "l_orderkey": "int64",
        "l_linenumber": "int32",
        "l_quantity": "int32",
        "l_tax": "float64",
        "l_extendedprice": "float64",
        "l_partkey": "object",
        "l_returnflag": "int64",
        "l_linestatus": "category",
    }
    return cast_wide(table(spark, folder, "lineitem").select(*kinds), kinds)


def preview_limit(spark, folder):
    return preview(table(spark, folder, "events"), 10, order_by="event_id")


_TEMPLATE = """SELECT {key} AS customuid, count(*) AS events, round(sum(value), 2) AS total
FROM {source} WHERE ts < cast(:baseTime AS timestamp_ntz) GROUP BY {key}"""


def template_export(spark, folder):
    return run_template(
        spark,
        _TEMPLATE,
        names={"key": "user_id"},
        args={"baseTime": "2024-01-20"},
        source=table(spark, folder, "events"),
    )


def text_template_export(spark, folder):
    text = """SELECT o_orderpriority AS priority, count(*) AS orders FROM parquet.`{path}`
    WHERE o_orderdate < timestamp_ntz '{baseTime}' GROUP BY o_orderpriority"""
    return run_text_template(spark, text, path=f"{folder}/orders.parquet", baseTime="1998-01-01")


QUERIES = {
    f.__name__: f
    for f in (
        event_day_slice,
        event_lookback,
        event_tm_parse,
        event_tm_instant,
        export_names,
        template_export_files,
        template_exports_files,
        event_dedup,
        event_dedup_first,
        event_dup_report,
        event_day_replace,
        event_day_counts,
        calendar_snapshots,
        calendar_windows,
        user_sketches,
        monthly_name_rollup,
        biweekly_snapshots,
        date_functions,
        typed_wide,
        preview_limit,
        template_export,
        text_template_export,
    )
}

_TWICE = "(" + " UNION ALL ".join(f"SELECT * EXCLUDE event_id FROM ({s})" for s in (EVENTS_SQL, EVENTS_SQL, OTHER_SQL)) + ")"
_COLUMNS = "distinct_id, dt, tm, event_duration, element_content, event"

_BASES = "SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS base"

SQL = {
    "event_day_slice": f"SELECT event_id, {_COLUMNS} FROM ({EVENTS_SQL}) WHERE dt = DATE '2024-01-08'",
    "event_lookback": f"SELECT event_id, {_COLUMNS} FROM ({EVENTS_SQL}) WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "event_tm_parse": "SELECT event_id, date_trunc('millisecond', ts) AS tm FROM events",
    "event_tm_instant": "SELECT event_id, date_trunc('millisecond', ts) - INTERVAL 8 HOUR AS instant FROM events",
    "export_names": """SELECT 'event_199712' AS monthly, '19971231' AS compact, '1997_12_31' AS suffix, count(*) AS row_count
FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-12-31'""",
    "template_export_files": """SELECT user_id AS customuid, count(*) AS events, round(sum(value), 2) AS total,
  'interest_2024_01_20' AS name FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id""",
    "template_exports_files": """SELECT event_type AS name, count(*) AS rows, 'by_type_2024_01_20' AS snapshot FROM events
WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1
UNION ALL SELECT CAST(user_id AS VARCHAR), count(*), 'by_user_2024_01_20' FROM events GROUP BY 1
UNION ALL SELECT strftime(ts, '%Y%m%d'), count(*), 'by_day_2024_01_20' FROM events GROUP BY 1""",
    "event_dedup": f"SELECT DISTINCT * FROM {_TWICE}",
    "event_dedup_first": f"""SELECT event_id, {_COLUMNS} FROM ({EVENTS_SQL})
QUALIFY row_number() OVER (PARTITION BY distinct_id, dt, event ORDER BY event_id) = 1""",
    "event_dup_report": f"""SELECT (SELECT count(*) FROM {_TWICE}) AS rows_before,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM {_TWICE})) AS rows_after,
  (SELECT count(DISTINCT user_id) FROM events) AS users""",
    "event_day_replace": f"""SELECT * FROM {_TWICE} WHERE dt <> DATE '2024-01-08'
UNION ALL SELECT DISTINCT * FROM {_TWICE} WHERE dt = DATE '2024-01-08'""",
    "event_day_counts": f"""WITH d AS MATERIALIZED (SELECT * FROM {_TWICE} WHERE dt = DATE '2024-01-15')
SELECT *, (SELECT count(*) FROM d) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS rows_after
FROM (SELECT DISTINCT * FROM d)""",
    "calendar_snapshots": f"""SELECT event_id, distinct_id, event, dt FROM ({EVENTS_SQL})
WHERE date_diff('day', DATE '2024-01-05', dt) % 3 = 0""",
    "calendar_windows": f"""SELECT base, count(*) AS events, count(DISTINCT distinct_id) AS users FROM ({EVENTS_SQL})
JOIN ({_BASES}) b ON dt BETWEEN base - 6 AND base WHERE dayofweek(base) = 0 GROUP BY base""",
    "user_sketches": f"""SELECT base, count(DISTINCT distinct_id) AS exact, true AS close
FROM ({_BASES}) b LEFT JOIN ({EVENTS_SQL}) ON dt BETWEEN base - 10 AND base WHERE dayofweek(base) IN (0, 3) GROUP BY base""",
    "monthly_name_rollup": """SELECT 'event_' || strftime(o_orderdate, '%Y%m') AS table_name, count(*) AS row_count
FROM orders GROUP BY 1""",
    "biweekly_snapshots": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders
WHERE date_diff('day', DATE '1998-01-05', CAST(o_orderdate AS DATE)) % 14 = 0""",
    "date_functions": """SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS row_count,
  CAST(CAST(l_shipdate AS DATE) - 7 AS DATE) AS week_before,
  strftime(CAST(l_shipdate AS DATE), '%Y_%m_%d') AS suffix, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS compact,
  date_diff('day', DATE '1998-01-05', CAST(l_shipdate AS DATE)) % 14 = 0 AS on_grid
FROM lineitem GROUP BY CAST(l_shipdate AS DATE)""",
    "typed_wide": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, l_tax, l_extendedprice,
  CAST(l_partkey AS VARCHAR) AS l_partkey, TRY_CAST(l_returnflag AS BIGINT) AS l_returnflag, l_linestatus
FROM lineitem""",
    "preview_limit": "SELECT * FROM events ORDER BY event_id LIMIT 10",
    "template_export": """SELECT user_id AS customuid, count(*) AS events, round(sum(value), 2) AS total
FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY user_id""",
    "text_template_export": """SELECT o_orderpriority AS priority, count(*) AS orders FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_orderpriority""",
}
