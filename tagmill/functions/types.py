"""Column types of published wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tagmill.functions.text import quoted

# Published type per source type name (fixed values); anything else is text.
# float64 stays double: a 4-byte float would lose digits.
PUBLISHED = {
    "datetime64[ns]": "timestamp",
    "int64": "bigint",
    "int32": "int",
    "float64": "double",
}


# Texts worth a cast to each numeric type.  Spark's try_cast builds an exception for
# every other text, which costs far more than this test.
NUMERIC_TEXT = {
    "bigint": r"^\s*[+-]?[0-9]+\s*$",
    "int": r"^\s*[+-]?[0-9]+\s*$",
    "double": r"(?i)[0-9]|nan|inf",
}


def cast_wide(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast each column by its source type name; bad values become NULL."""
    cols = []
    for name, field in zip(df.columns, df.schema):
        to = PUBLISHED.get(kinds.get(name, ""), "string")
        col = F.col(quoted(name))
        cast = col.try_cast(to)
        if field.dataType == StringType() and to in NUMERIC_TEXT:
            cast = F.when(col.rlike(NUMERIC_TEXT[to]), cast)
        cols.append(cast.alias(name))
    return df.select(*cols)
