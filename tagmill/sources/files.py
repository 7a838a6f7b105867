"""Delimited vendor files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagmill.bounds import bounded_rows
from tagmill.functions.dates import compact
from tagmill.session import materialize
from tagmill.sinks.files import TSV_ESCAPES, TSV_NULL

# Holds the text of a line that does not fit the schema.
BAD_LINE = "_bad_line"
# Different column orders the files of one delivery may have.
MAX_ORDERS = 200


def vendor_path(folder: str, rule: str, day: str) -> str:
    """Path of a delivery: ``{date}`` in the name rule becomes ``yyyyMMdd``; globs stay."""
    return f"{folder.rstrip('/')}/{rule.replace('{date}', compact(day))}"


def read_vendor_file(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True, encoding: str = "UTF-8"
) -> DataFrame:
    """Read a delivery by a given schema; Spark splits large files among tasks.

    Lines that do not fit keep their text in ``BAD_LINE`` instead of being lost.
    """
    full = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    return (
        spark.read.schema(full)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("enforceSchema", "false" if header else "true")
        .csv(path)
    )


def read_deliveries(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """Rows and unreadable lines of many files, each read by its own header.

    A line that names the columns of ``schema``, in any order and case, is a header; each file
    is read in the order of its header.  The rows come with ``source_file``.  The others come as
    ``(source_file, line, reason)``: ``no header`` for all lines of a file without one, ``two headers`` for those of a
    file whose headers differ, ``unreadable`` for a line that does not fit the types or has more or
    fewer fields.  Blank lines are skipped.  A field may be quoted but not hold a line break.
    """
    lines = spark.read.option("encoding", encoding).text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    lines = materialize(lines.where(F.trim("line") != ""), "delivered")
    names = [f.name.lower() for f in schema.fields]
    clean = F.regexp_replace(F.lower("line"), r'[\s"\x{feff}]+', "")
    cells = F.split(clean, re.escape(sep), -1)
    is_header = F.sort_array(cells) == F.lit(sorted(names))
    headers = lines.where(is_header).groupBy("source_file").agg(F.min(clean).alias("header"), F.max(clean).alias("other"))
    headers = materialize(headers, "headers")
    data = lines.where(~is_header).join(headers, "source_file", "left")
    orders = [r.header for r in bounded_rows(headers.where("header = other").select("header").distinct(), MAX_ORDERS, "column orders")]
    read = data.select("source_file", "line", "header", "other").where(F.lit(False)).select("source_file", "line", F.lit(None).cast(schema).alias("row"), F.lit(None).cast("string").alias("bad"))
    for header in orders:
        kinds = {f.name.lower(): f for f in schema.fields}
        own = StructType([*[kinds[n] for n in header.split(sep)], StructField(BAD_LINE, StringType())])
        options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
        parsed = F.from_csv("line", F.lit(own.toDDL()), options)
        rows = data.where((F.col("header") == header) & (F.col("other") == header)).withColumn("_r", parsed)
        row = F.struct(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields])
        read = read.unionAll(rows.select("source_file", "line", row.alias("row"), F.col("_r")[BAD_LINE].alias("bad")))
    good = read.where("bad is null").select("row.*", "source_file")
    unreadable = read.where("bad is not null").select("source_file", "line", F.lit("unreadable").alias("reason"))
    lost = data.where("header is null or header <> other").select(
        "source_file", "line", F.when(F.col("header").isNull(), "no header").otherwise("two headers").alias("reason")
    )
    return good, unreadable.unionAll(lost)


def _plain(text):
    """Undo ``TSV_ESCAPES``: what stands between two doubled backslashes holds the other escapes."""

    def turned(part):
        for plain, spelt in TSV_ESCAPES[1:]:
            part = F.replace(part, F.lit(spelt), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), turned), "\\")


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read what ``export_tsv`` wrote; every text comes back as it was."""
    cells = F.split("value", "\t", -1)
    lines = spark.read.option("lineSep", "\n").text(path).select(cells.alias("c"))
    columns = []
    for i, field in enumerate(schema.fields):
        cell = F.get("c", F.lit(i))
        value = _plain(cell) if field.dataType.typeName() == "string" else cell.cast(field.dataType)
        columns.append(F.when(cell != TSV_NULL, value).alias(field.name))
    return lines.select(columns)


def good_and_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a delivery into its rows and its unreadable lines."""
    return rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE), rows.where(F.col(BAD_LINE).isNotNull())
