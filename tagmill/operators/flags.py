"""Wide 0/1 tables: a row per user, a column per label.

Labels are positions in a few 64-bit masks, so the aggregation carries fixed
width buffers, combines before the shuffle, and a user with any number of rows
costs each task one small row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import bounded_values
from tagmill.functions.text import quoted

BITS = 64
# A wide table cannot hold more columns than this; more labels are an error.
MAX_LABELS = 10_000


def label_dictionary(table: DataFrame) -> DataFrame:
    """``(product_label, product_label2)`` with upper-cased labels."""
    return table.select(F.upper("product_label").alias("product_label"), "product_label2")


def dictionary_labels(dictionary: DataFrame) -> list[str]:
    return bounded_values(dictionary, F.upper("product_label"), MAX_LABELS, "label dictionary")


def mask_names(labels) -> list[str]:
    return [f"_mask{i}" for i in range(max(1, -(-len(labels) // BITS)))]


def with_masks(df: DataFrame, labels: list[str], label: str = "label") -> DataFrame:
    """Replace ``label`` by mask columns; NULL and unlisted labels set no bit."""
    listed = F.array(*[F.lit(v) for v in labels]) if labels else F.array().cast("array<string>")
    at = df.withColumn("_at", (F.array_position(listed, F.col(label)) - 1).cast("int"))
    masks = [
        F.when(
            (F.col("_at") >= i * BITS) & (F.col("_at") < (i + 1) * BITS), F.expr(f"shiftleft(1L, _at - {i * BITS})")
        )
        .otherwise(F.lit(0).cast("bigint"))
        .alias(name)
        for i, name in enumerate(mask_names(labels))
    ]
    return at.select(*[F.col(quoted(c)) for c in df.columns if c != label], *masks)


def merge_masks(pairs: DataFrame, key: str, labels: list[str], label: str = "label") -> DataFrame:
    """``key`` and its label masks.

    ``pairs`` holds ``(key, label)`` rows, a NULL label for a user without any,
    or the mask columns of ``with_masks`` in place of the label.
    """
    if label in pairs.columns:
        pairs = with_masks(pairs, labels, label)
    zero = F.lit(0).cast("bigint")
    return pairs.groupBy(key).agg(*[F.coalesce(F.bit_or(n), zero).alias(n) for n in mask_names(labels)])


def labels_present(merged: DataFrame, labels: list[str]) -> set[str]:
    """Labels at least one key of ``merged`` has."""
    names = mask_names(labels)
    found = merged.agg(*[F.coalesce(F.bit_or(n), F.lit(0).cast("bigint")).alias(n) for n in names]).first()
    return {v for i, v in enumerate(labels) if found[i // BITS] >> (i % BITS) & 1}


def flag_columns(merged: DataFrame, key: str, labels: list[str], keep: list[str] | None = None) -> DataFrame:
    """``key`` and one bigint 0/1 column per label of ``keep``; ``labels`` explains the masks."""
    names, keep = mask_names(labels), labels if keep is None else keep
    clash = [v for v in keep if v.lower() == key.lower()]
    if clash:
        raise ValueError(f"label {clash[0]!r} clashes with the key column")
    at = {v: i for i, v in enumerate(labels)}
    flags = [F.getbit(F.col(names[at[v] // BITS]), F.lit(at[v] % BITS)).cast("bigint").alias(v) for v in keep]
    return merged.select(key, *flags)


def flag_matrix(pairs: DataFrame, key: str, labels: list[str], label: str = "label") -> DataFrame:
    """One row per key of ``pairs`` and one bigint 0/1 column per label."""
    return flag_columns(merge_masks(pairs, key, labels, label), key, labels)


def count_matrix(facts: DataFrame, key: str, label: str, labels: list[str]) -> DataFrame:
    """How often each key has each label, as bigint columns."""
    # Counted by (key, label) first; a pivot over given values then places each count once.
    named = facts.select(F.col(key), F.col(quoted(label)).alias("_label"))
    wide = named.groupBy(key).pivot("_label", labels).agg(F.count(F.lit(1))) if labels else named.select(key).distinct()
    return wide.select(key, *[F.coalesce(F.col(quoted(v)), F.lit(0)).cast("bigint").alias(v) for v in labels])
