"""Inputs in the shape the jobs expect, derived from the given tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.operators.events import EVENT_COLUMNS
from tagmill.session import scratch_path

RULES = [
    ("%/fr/%", "french"),
    ("%utm_source=feed%", "\tfeed"),
    ("%cheap-pills%", "spam"),
    ("%spam-farm%", "SPAM"),
    ("%example%net%", "glued"),
    ("%.html%", "article"),
    ("%#tophttps%", "top_first"),
    ("%ref=x%", "ref"),
]
LABELS = [("french", "F"), ("feed", "E"), ("spam", "S"), ("article", "A"), ("top_first", "T"), ("unused", "U")]


# Event columns without a counterpart in the given table; they are derived from the event's number.
_GIVEN = ("distinct_id", "dt", "tm", "event_duration", "element_content", "event")
DERIVED = [c for c in EVENT_COLUMNS if c not in _GIVEN]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A few rows of text, such as a rule map, as a local relation."""
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))


def rule_map(spark: SparkSession, rules=None) -> DataFrame:
    return small(spark, rules or RULES, ["transfer_rule", "value"])


def dictionary(spark: SparkSession) -> DataFrame:
    return small(spark, LABELS, ["product_label", "product_label2"])


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """A visit per page; the site stands for the user."""
    return table(spark, folder, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("distinct_id"), F.col("page_id").alias("seq"), "url"
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the 31-column form, plus ``event_id``."""
    source = table(spark, folder, "events")
    known = {
        "distinct_id": F.col("user_id").cast("string"),
        "dt": F.to_date("ts"),
        "tm": F.date_format("ts", "yyyyMMddHHmmssSSS"),
        "event_duration": F.col("value"),
        "element_content": F.col("props"),
        "event": F.col("event_type"),
    }
    for i, c in enumerate(DERIVED):
        text = F.concat(F.lit(f"{c}_"), F.expr(f"(event_id div 2 + {i}) % 3").cast("string"))
        known[c] = F.when(F.expr(f"(event_id div 3 + {i}) % 5 <> 0"), text)
    return source.select("event_id", *[known[c].alias(c) for c in EVENT_COLUMNS])


def delivered_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as repeated deliveries leave it: every event twice, and once more
    with another text, or none, in a single column."""
    once = events(spark, folder)
    changed = {
        c: F.when(F.expr(f"event_id % {len(DERIVED)} = {i}"), F.when(F.expr("event_id % 2 = 0"), F.lit("changed"))).otherwise(F.col(c))
        for i, c in enumerate(DERIVED)
    }
    other = once.withColumns(changed).drop("event_id")
    return once.drop("event_id").unionAll(once.drop("event_id")).unionAll(other)


_DERIVED_SQL = "".join(
    f",\n  CASE WHEN (event_id // 3 + {i}) % 5 <> 0 THEN '{c}_' || ((event_id // 2 + {i}) % 3) END AS {c}" for i, c in enumerate(DERIVED)
)
EVENTS_SQL = f"""SELECT event_id, CAST(user_id AS VARCHAR) AS distinct_id, CAST(ts AS DATE) AS dt,
  strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(date_part('millisecond', ts)::BIGINT % 1000 AS VARCHAR), 3, '0') AS tm,
  value AS event_duration, props AS element_content, event_type AS event{_DERIVED_SQL}
FROM events"""
OTHER_SQL = "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN event_id % {len(DERIVED)} = {i} THEN CASE WHEN event_id % 2 = 0 THEN 'changed' END ELSE {c} END AS {c}"
    for i, c in enumerate(DERIVED)
) + f") FROM ({EVENTS_SQL})"


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A name no other run uses, and a folder for its rows."""
    return f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, name)


def written(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The rows of a scratch table; its catalog entry goes, its files stay for the reader."""
    rows = spark.table(name)
    back = spark.read.schema(rows.schema).parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return back
