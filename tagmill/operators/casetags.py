"""Tag expressions compiled from a code map.

A code map row says: when ``mapping_col`` is LIKE ``transfer_rule``, the user of
product ``product_label`` gets ``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import bounded_rows, fits
from tagmill.functions.text import decode_label, quoted, strip_blanks
from tagmill.operators.flags import BITS, MAX_LABELS, mask_names, merge_masks
from tagmill.operators.rules import like_parts, rule_hits
from tagmill.session import materialize

# Rules one product may have by default; they become one expression.
MAX_CASES = 20_000
# Rules that are still compared one by one where the rows lie; more are looked up.
COMPARED = 200
# Distinct tagged texts that are sent to all tasks; more are joined by a shuffle.
SENT_TEXTS = 100_000


def _any(tests: list[Column]) -> Column:
    """The OR of all tests as a balanced tree, which stays shallow for thousands of them."""
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + tests[len(tests) & ~1 :]
    return tests[0]


def product_rules(code_map: DataFrame, product: str) -> DataFrame:
    """Code-map rows of one product; the argument may be encoded, case is ignored."""
    return code_map.where(F.lower("product_label") == decode_label(product).lower())


def product_partition(code_map: DataFrame) -> tuple[str, str]:
    """The single ``(product_type, dt)`` of a product's rules."""
    found = code_map.select("product_type", "dt").distinct().limit(2).collect()
    if len(found) != 1:
        problem = "the rules of a product must share one product_type and dt" if found else "no rule for this product"
        raise ValueError(problem)
    return found[0].product_type, found[0].dt


def tag_columns(code_map: DataFrame, scope: str = "value", max_cases: int = MAX_CASES) -> dict[str, Column]:
    """``{"user_tag": Column}``, or ``user_tag_1..n`` when several pairs exist.

    There is one tag per ``(mapping_col, value)``, ordered by that pair.  In scope
    ``value`` it tests the rules of that value; in scope ``column`` those of every
    value on the same column.  No rule met gives NULL.
    """
    if scope not in ("value", "column"):
        raise ValueError(f"scope {scope!r}")
    rules = code_map.select("mapping_col", strip_blanks(F.col("transfer_rule")).alias("rule"), "value").distinct()
    rows = sorted(tuple(r) for r in bounded_rows(rules.na.drop(), max_cases, "code map"))
    out = []
    for column, value in sorted({(c, v) for c, _, v in rows}):
        tests = sorted({r for c, r, v in rows if c == column and (scope == "column" or v == value)})
        met = _any([F.col(quoted(column)).like(t) for t in tests])
        out.append(F.when(met, F.lit(value)))
    names = ["user_tag"] if len(out) == 1 else [f"user_tag_{i}" for i in range(1, len(out) + 1)]
    return dict(zip(names, out))


def with_tags(df: DataFrame, code_map: DataFrame, scope: str = "value") -> DataFrame:
    """``df`` with its tag columns: by one expression for few rules, by lookup for many."""
    if fits(_cleaned(code_map), COMPARED):
        return df.withColumns(tag_columns(code_map, scope))
    return with_tags_by_lookup(df, code_map, scope)


def _cleaned(code_map: DataFrame) -> DataFrame:
    return code_map.select("mapping_col", strip_blanks(F.col("transfer_rule")).alias("rule"), "value").distinct().na.drop()


def with_tags_by_lookup(df: DataFrame, code_map: DataFrame, scope: str = "value") -> DataFrame:
    """``with_tags`` for code maps of any number of rules; the same columns, without an expression per rule.

    The distinct texts of each mapped column are matched against its rules by an equi join on
    their rarest substrings.  A text's hits fold into bit masks over the tags, one
    bit for each ``(mapping_col, value)``, and the rows take the masks of their texts.  Tags are
    listed on the driver, at most ``MAX_LABELS`` of them; rules never are.
    """
    if scope not in ("value", "column"):
        raise ValueError(f"scope {scope!r}")
    rules = materialize(_cleaned(code_map), "code-map")
    tags = sorted(tuple(r) for r in bounded_rows(rules.select("mapping_col", "value").distinct(), MAX_LABELS, "tags"))
    names = ["user_tag"] if len(tags) == 1 else [f"user_tag_{i}" for i in range(1, len(tags) + 1)]
    out = df
    cells = {}
    for column in dict.fromkeys(c for c, _ in tags):
        values = [v for c, v in tags if c == column]
        needle, pattern = like_parts(F.col("rule"))
        # In scope ``column`` any hit gives every tag of the column, so all rules share one bit.
        label = F.col("value") if scope == "value" else F.lit("any")
        labels = values if scope == "value" else ["any"]
        own = rules.where(F.col("mapping_col") == column)
        own = own.select(needle.alias("needle"), pattern.alias("pattern"), label.alias("label")).distinct()
        texts = out.select(F.col(quoted(column)).cast("string").alias("_text")).where("_text is not null").distinct()
        hits = rule_hits(texts, "_text", own).select("_text", "label")
        masks = materialize(merge_masks(hits, "_text", labels), "tagged-texts")
        at = len(cells)
        named = {n: f"_m{at}_{n}" for n in mask_names(labels)}
        masks = masks.withColumnsRenamed(named).withColumnRenamed("_text", f"_text{at}")
        # Without the hint more are broadcast after all if their file is small by compression.
        masks = F.broadcast(masks) if fits(masks, SENT_TEXTS) else masks.hint("merge")
        same = F.col(quoted(column)).cast("string") == F.col(f"_text{at}")
        out = out.join(masks, same, "left").drop(f"_text{at}")
        for i, value in enumerate(values):
            bit = 0 if scope == "column" else i
            mask = F.col(named[mask_names(labels)[bit // BITS]])
            cells[column, value] = F.when(F.getbit(F.coalesce(mask, F.lit(0).cast("bigint")), F.lit(bit % BITS)) == 1, F.lit(value))
    return out.select(*[F.col(quoted(c)) for c in df.columns if c not in names], *[cells[t].alias(n) for t, n in zip(tags, names)])
