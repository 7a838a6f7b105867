"""Catalog tables, query templates and load specifications."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tagmill.bounds import bounded_rows

# Default name of the table that holds URL rules (fixed value).
RULE_MAP = "dm_tag.dmp_rule_map"

_NAME = re.compile(r"^\w+(\.\w+)*$")
# Tables one mirror run may list.
MAX_SPECS = 10_000
PATTERNS = ("full", "append", "yyyymm")


def checked_name(name: str) -> str:
    """``name`` if it is a plain table or column name, else an error."""
    if not _NAME.match(name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(checked_name(name))


def read_rule_map(spark: SparkSession, name: str = RULE_MAP) -> DataFrame:
    return read_table(spark, name).select("transfer_rule", "value").distinct()


def preview(table: DataFrame, rows: int = 10, order_by: str | None = None) -> DataFrame:
    """The first ``rows`` rows; name an order when the answer must be stable."""
    return (table.orderBy(order_by) if order_by else table).limit(rows)


def run_template(
    spark: SparkSession, text: str, names: dict[str, str] | None = None, args: dict | None = None, **frames: DataFrame
) -> DataFrame:
    """Run a query text.

    Values are bound by Spark as ``:name`` markers through ``args``; ``{name}``
    holes take table or column names from ``names``, or a DataFrame or Column
    given by keyword, such as a compiled tag expression.
    """
    for hole, name in (names or {}).items():
        text = text.replace("{" + hole + "}", checked_name(name))
    return spark.sql(text, args or None, **frames)


def run_text_template(spark: SparkSession, text: str, **values: str) -> DataFrame:
    """Run a query text whose ``{name}`` holes stand inside the SQL as they are.

    For templates written with ``'{baseTime}'`` in quotes.  A value may not hold
    anything that could end a quoted text.
    """
    for name, value in values.items():
        if re.search(r"['\"`;\\]|--|/\*", value):
            raise ValueError(f"unsafe value for {name!r}")
    return spark.sql(text.format(**values))


@dataclass(frozen=True)
class LoadSpec:
    """How one table is mirrored."""

    hive_db: str
    sql_db: str
    table: str
    pattern_type: str
    key_to_new_data: str | None = None

    def __post_init__(self):
        for name in (self.hive_db, self.sql_db, self.table):
            checked_name(name)
        if self.pattern_type not in PATTERNS:
            raise ValueError(f"pattern_type {self.pattern_type!r} is none of {PATTERNS}")
        if self.pattern_type != "full" and not self.key_to_new_data:
            raise ValueError(f"pattern {self.pattern_type} needs key_to_new_data")

    @classmethod
    def from_record(cls, record: dict) -> "LoadSpec":
        """Take the fields a load needs; schedule and memory fields are ignored."""
        return cls(**{k: record.get(k) for k in ("hive_db", "sql_db", "table", "pattern_type", "key_to_new_data")})

    @classmethod
    def from_table(cls, table: DataFrame) -> "list[LoadSpec]":
        """The specifications a job table lists, one per row."""
        return [cls.from_record(row.asDict()) for row in bounded_rows(table, MAX_SPECS, "load specifications")]

    @property
    def target(self) -> str:
        return f"{self.hive_db}.{self.sql_db}_{self.table}"
