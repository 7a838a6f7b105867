"""Size checks for the few things that may reach the driver or be broadcast."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TooLarge(ValueError):
    """A frame that must be small is not."""


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect ``df``, refusing more than ``limit`` rows.  Nothing is cut off."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooLarge(f"{what}: more than {limit} rows")
    return rows


def bounded_values(df: DataFrame, column: str | Column, limit: int, what: str) -> list:
    """Distinct non-NULL values of one column, in order."""
    col = F.col(column) if isinstance(column, str) else column
    found = df.select(col.alias("v")).where(F.col("v").isNotNull()).distinct()
    return sorted(row.v for row in bounded_rows(found, limit, what))


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than it must."""
    return df.limit(limit + 1).count() <= limit


def held(df: DataFrame, limit: int) -> tuple[DataFrame, list | None]:
    """``df`` as a local relation with its rows, or ``df`` itself and None when it is larger.

    For text columns.  A rule map held this way is read once per job, not once
    per use.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, None
    columns = {c: pa.array([row[c] for row in rows], pa.string()) for c in df.columns}
    return df.sparkSession.createDataFrame(pa.table(columns)), rows
