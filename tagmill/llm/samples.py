"""Training rows: a bounded, repeatable choice of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the key as text leaves ``part`` modulo ``parts``; false for NULL."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def chosen(df: DataFrame, key: str, label: str, each: int, most: int) -> DataFrame:
    """About ``each`` rows of every label value, ``most`` at most over all.

    Rows are chosen by a hash of their key, so the same rows train every time.  Labels
    are counted first; the counts are small, a row a label value.
    """
    counts = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    each = min(each, most // max(1, len(counts)))
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, each / n))).otherwise(share)
    dealt = F.pmod(F.xxhash64(F.col(key), F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    return df.where(F.col(label).isNotNull() & (dealt < share)).limit(most + most // 4)
