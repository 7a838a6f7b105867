"""Interest tables and activity counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.operators import interest as ops
from tagmill.plans import exports
from tagmill.plans.labels import interest_snapshot
from tagmill.session import materialize, scratch_path
from tagmill.sinks.bucketed import side_by_side, write_bucketed
from workload.inputs import scratch_table, table


def degree_facts(spark, folder):
    events = table(spark, folder, "events")
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "mid").when(F.col("value") < 500, "top")
    return events.select(
        F.col("user_id").cast("string").alias("customuid"),
        F.col("event_type").alias("interest_category"),
        band.alias("degree"),
    )


def class_facts(spark, folder):
    """Suppliers stand for users here; their numbers start at 100, so each side lacks some of the other."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        (F.col("l_suppkey") + 100).cast("string").alias("customuid"),
        F.col("l_returnflag").alias("interest_category"),
        F.concat_ws("_", "l_returnflag", "l_linestatus").alias("interest_class"),
    )


def interest_degree_matrix(spark, folder):
    return ops.degree_matrix(degree_facts(spark, folder))


def interest_class_flags(spark, folder):
    return ops.class_flags(class_facts(spark, folder))


def interest_wide(spark, folder):
    return ops.interest_wide(degree_facts(spark, folder), class_facts(spark, folder))


def interest_bucketed(spark, folder):
    """Degrees and classes kept by user in buckets, put side by side without moving rows."""
    names = []
    for kind, rows in (("degrees", ops.degree_matrix(degree_facts(spark, folder))), ("classes", ops.class_flags(class_facts(spark, folder)))):
        name, path = scratch_table(spark, kind)
        write_bucketed(rows, name, "customuid", path, 8)
        names.append(name)
    held = materialize(side_by_side(spark, *names, "customuid"), "interest")
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return held


def activity_counts(spark, folder):
    return exports.activity_counts(table(spark, folder, "events"), "user_id", "event_type")


def interest_snapshot_files(spark, folder):
    """The interest table of a date on shared storage."""
    root = scratch_path(spark, "snapshots")
    name = interest_snapshot(degree_facts(spark, folder), class_facts(spark, folder), root, "2024-01-31")
    return spark.read.parquet(f"{root}/{name}")


def part_facts(spark, folder):
    """Sizes stand for users, brand and kind together for some 150 classes."""
    name = F.concat_ws("_", "p_brand", "p_type")
    return table(spark, folder, "part").select(F.col("p_size").cast("string").alias("customuid"), name.alias("interest_class"))


# Every brand with every kind, whether a part has them or not.
KINDS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
PART_CLASSES = [f"Brand#{brand}_{kind}" for brand in range(1, 26) for kind in KINDS]


def class_flags_wide(spark, folder):
    return ops.class_flags(part_facts(spark, folder), classes=PART_CLASSES)


def activity_counts_wide(spark, folder):
    return exports.activity_counts(part_facts(spark, folder), "customuid", "interest_class", PART_CLASSES)


QUERIES = {
    f.__name__: f
    for f in (
        interest_degree_matrix,
        interest_class_flags,
        interest_wide,
        interest_snapshot_files,
        interest_bucketed,
        class_flags_wide,
        activity_counts,
        activity_counts_wide,
    )
}

_PARTS = "SELECT CAST(p_size AS VARCHAR) AS customuid, p_brand || '_' || p_type AS class FROM part"

_CATEGORIES = ("click", "error", "purchase", "signup", "view")
_CLASSES = ("A_F", "A_O", "N_F", "N_O", "R_F", "R_O")
_DEGREES = "SELECT customuid, " + ", ".join(
    f"""coalesce(max(CASE WHEN category = '{c}' THEN degree END), '') AS "大類_濃度_{c}\"""" for c in _CATEGORIES
) + """ FROM (SELECT CAST(user_id AS VARCHAR) AS customuid, event_type AS category, coalesce(
  CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' WHEN value < 500 THEN 'top' END, '') AS degree FROM events)
GROUP BY customuid"""
_FLAGS = "SELECT customuid, " + ", ".join(
    f"CASE WHEN max((class = '{c}')::INT) = 1 THEN '1' ELSE '0' END AS \"{c}\"" for c in _CLASSES
) + """ FROM (SELECT CAST(l_suppkey + 100 AS VARCHAR) AS customuid, l_returnflag || '_' || l_linestatus AS class
FROM lineitem) GROUP BY customuid"""

SQL = {
    "class_flags_wide": "SELECT customuid, "
    + ", ".join(f"CASE WHEN bool_or(class = '{c}') THEN '1' ELSE '0' END AS \"{c}\"" for c in PART_CLASSES)
    + f" FROM ({_PARTS}) GROUP BY customuid",
    "activity_counts_wide": "SELECT customuid, "
    + ", ".join(f"count(*) FILTER (class = '{c}') AS \"{c}\"" for c in PART_CLASSES)
    + f" FROM ({_PARTS}) GROUP BY customuid",
    "interest_snapshot_files": f"SELECT * FROM ({_DEGREES}) d FULL JOIN ({_FLAGS}) c USING (customuid)",
    "interest_bucketed": f"SELECT * FROM ({_DEGREES}) d FULL JOIN ({_FLAGS}) c USING (customuid)",
    "interest_degree_matrix": _DEGREES,
    "interest_class_flags": _FLAGS,
    "interest_wide": f"SELECT * FROM ({_DEGREES}) d FULL JOIN ({_FLAGS}) c USING (customuid)",
    "activity_counts": "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (event_type = '{c}') AS {c}" for c in _CATEGORIES)
    + " FROM events GROUP BY user_id",
}
