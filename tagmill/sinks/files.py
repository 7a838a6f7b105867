"""Day slices as delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.text import quoted


def _day(table: DataFrame, day: str, dt: str) -> DataFrame:
    return table.where(F.col(dt) == F.lit(day).cast(table.schema[dt].dataType))


# How NULL is spelt in tab-separated files; an empty field is an empty text (fixed value).
TSV_NULL = "\\N"
# Wall times with all their digits.
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# What would end a field or a line, and how it is spelt (fixed values, replaced in this order).
TSV_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(rows: DataFrame) -> DataFrame:
    """Text columns with ``TSV_ESCAPES`` applied, so a row is a line."""
    texts = {}
    for field in rows.schema.fields:
        if field.dataType.typeName() == "string":
            col = F.col(quoted(field.name))
            for plain, spelt in TSV_ESCAPES:
                col = F.replace(col, F.lit(plain), F.lit(spelt))
            texts[field.name] = col
    return rows.withColumns(texts) if texts else rows


def export_tsv(table: DataFrame, path: str, day: str | None = None, dt: str = "dt") -> None:
    """Tab-separated, no header; one day or, without ``day``, everything.

    Tabs, line breaks and backslashes inside a text are written as ``TSV_ESCAPES``;
    ``read_tsv`` turns them back.
    """
    rows = escaped(_day(table, day, dt) if day else table)
    rows.write.mode("overwrite").options(sep="\t", quote="", emptyValue="", nullValue=TSV_NULL, **_TIMES).csv(path)


def export_csv(table: DataFrame, path: str, day: str | None = None, dt: str = "dt") -> None:
    """Comma-separated with a header; NULL is an empty field, an empty text is quoted.

    A line break inside a text is quoted as it is: read such files with ``multiLine``.
    """
    rows = _day(table, day, dt) if day else table
    rows.write.mode("overwrite").options(header=True, **_TIMES).csv(path)
