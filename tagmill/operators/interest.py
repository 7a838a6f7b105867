"""Interest tables: a degree per category and a flag per class, one row per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import TooLarge, bounded_rows, bounded_values
from tagmill.functions.text import quoted, unique_names
from tagmill.operators.flags import BITS, MAX_LABELS, mask_names, with_masks

# Prefix of degree columns (fixed value).
DEGREE_PREFIX = "大類_濃度_"
# Degrees that are aggregated as ranks; a larger vocabulary is compared as text.
RANKED_DEGREES = 100


def categories_and_degrees(facts: DataFrame) -> tuple[list[str], list[str] | None]:
    """Distinct categories, and the degree vocabulary when it is small, in one pass."""
    pairs = facts.select("interest_category", F.coalesce("degree", F.lit("")).alias("degree")).distinct()
    try:
        rows = bounded_rows(pairs, MAX_LABELS, "categories and degrees")
    except TooLarge:
        return bounded_values(facts, "interest_category", MAX_LABELS, "categories"), None
    degrees = sorted({r.degree for r in rows})
    return sorted({r.interest_category for r in rows} - {None}), degrees if len(degrees) <= RANKED_DEGREES else None


def _degree_cells(categories: list[str], degrees: list[str] | None) -> tuple[list[Column], list[Column]]:
    """Aggregates and cell values of the degree block.

    The largest degree of a cell wins.  Ranks keep the aggregation in fixed-width
    buffers; text would need a sort of every input row.
    """
    value = F.coalesce(F.col("degree"), F.lit(""))
    if degrees is not None:
        known = F.array(*[F.lit(d) for d in degrees])
        at = F.array_position(known, value).cast("int")
        strange = F.raise_error(F.concat(F.lit("degree outside the given ones: "), value)).cast("int")
        value = F.when(at > 0, at).otherwise(strange)
    aggs, cells = [], []
    for i, category in enumerate(categories):
        aggs.append(F.max(F.when(F.col("interest_category") == category, value)).alias(f"_d{i}"))
        cell = F.get(known, F.col(f"_d{i}") - 1) if degrees is not None else F.col(f"_d{i}")
        cells.append(F.coalesce(cell, F.lit("")))
    return aggs, cells


def _class_cells(classes: list[str], masks: list[str]) -> tuple[list[Column], list[Column]]:
    """Aggregates and cell values of the class block: a class is a bit of a few masks."""
    aggs = [F.bit_or(name).alias(name) for name in masks]
    bits = (F.getbit(F.coalesce(F.col(masks[i // BITS]), F.lit(0)), F.lit(i % BITS)) for i in range(len(classes)))
    return aggs, [F.when(bit == 1, F.lit("1")).otherwise(F.lit("0")) for bit in bits]


def _column_names(key: str, categories: list[str], classes: list[str]) -> tuple[list[str], list[str]]:
    """Column names of both blocks; labels that differ by case only are numbered."""
    degree_names = unique_names([DEGREE_PREFIX + c for c in categories], [key])
    return degree_names, unique_names(classes, [key, *degree_names])


def degree_matrix(facts: DataFrame, key: str = "customuid", categories=None, degrees=None) -> DataFrame:
    """``key`` and one text column per category: its largest degree, else ``''``.

    ``degrees``, when given, must list every degree that occurs, in order (NULL counts
    as ``''``); a fact with another degree is an error.
    """
    if categories is None:
        categories, degrees = categories_and_degrees(facts)
    aggs, cells = _degree_cells(categories, degrees)
    names, _ = _column_names(key, categories, [])
    wide = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return wide.select(key, *[c.alias(n) for c, n in zip(cells, names)])


def class_flags(facts: DataFrame, key: str = "customuid", classes=None) -> DataFrame:
    """``key`` and one column ``'0'``/``'1'`` per class."""
    if classes is None:
        classes = bounded_values(facts, "interest_class", MAX_LABELS, "classes")
    aggs, cells = _class_cells(classes, mask_names(classes))
    _, names = _column_names(key, [], classes)
    wide = with_masks(facts.select(key, "interest_class"), classes, "interest_class").groupBy(key).agg(*aggs)
    return wide.select(key, *[c.alias(n) for c, n in zip(cells, names)])


def interest_wide(
    degree_facts: DataFrame,
    class_facts: DataFrame,
    key: str = "customuid",
    categories=None,
    degrees=None,
    classes=None,
    fill_absent: tuple[str, str] = (None, None),
) -> DataFrame:
    """Degree block and class block side by side, users of either kept.

    The two fact tables are stacked and aggregated once, which equals the full
    outer join of both matrices on the key but moves each row a single time and
    pairs NULL keys.  A user absent from a block has NULL there, or the value
    ``fill_absent`` gives for the degree and the class block.
    """
    if categories is None:
        categories, degrees = categories_and_degrees(degree_facts)
    if classes is None:
        classes = bounded_values(class_facts, "interest_class", MAX_LABELS, "classes")
    degree_aggs, degree_cells = _degree_cells(categories, degrees)
    masks = mask_names(classes)
    class_aggs, class_cells = _class_cells(classes, masks)
    degree_names, class_names = _column_names(key, categories, classes)
    none = F.lit(None).cast("string")
    stacked = degree_facts.select(
        key, "interest_category", "degree", *[F.lit(0).cast("bigint").alias(m) for m in masks], F.lit(1).alias("_block")
    ).unionByName(
        with_masks(class_facts.select(key, "interest_class"), classes, "interest_class").select(
            key, none.alias("interest_category"), none.alias("degree"), *masks, F.lit(2).alias("_block")
        )
    )
    wide = stacked.groupBy(key).agg(F.bit_or("_block").alias("_blocks"), *degree_aggs, *class_aggs)
    cols = [key]
    for block, names, cells in ((1, degree_names, degree_cells), (2, class_names, class_cells)):
        present = F.col("_blocks").bitwiseAND(block) != 0
        absent = F.lit(fill_absent[block - 1]).cast("string")
        cols += [F.when(present, cell).otherwise(absent).alias(name) for cell, name in zip(cells, names)]
    return wide.select(*cols)
