"""Quality rules as a cascade that stops at the first rejection.  Spark expressions only."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _repeats(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash.  Sorting (hash, position) brings equal
    windows together, so the work is n log n in the words of a text.
    """

    def marked(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = bound(
            pairs,
            lambda s: F.transform(
                F.filter(s, lambda x, j: (x.h == F.get(s, j - 1).h) | (x.h == F.get(s, j + 1).h)), lambda x: x.i
            ),
        )
        steps = bound(
            F.sort_array(twice),
            lambda at: F.transform(at, lambda x, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), x - F.get(at, k - 1)))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(marked(windows))

    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        bound(F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0))), counted)
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))


# Measures of a text (never NULL) and of its words; all are whole numbers.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")),
    "n_symbols": lambda text, words: F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
    "n_capitals": lambda text, words: F.regexp_count(text, F.lit("[A-Z]")),
    "n_lines": lambda text, words: F.size(_lines(text)),
    "n_dup_lines": lambda text, words: bound(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))),
    "n_repeat_words": lambda text, words: _repeats(words),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text where ``rejects`` holds for the measures it is handed by name."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., Column]


RULES = (
    Rule("short", ("n_words",), lambda n_words: n_words < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda n_repeat_words, n_words: 100 * n_repeat_words > 50 * n_words),
    Rule("symbols", ("n_symbols", "n_words"), lambda n_symbols, n_words: 10 * n_symbols > n_words),
    Rule("shouting", ("n_capitals", "word_chars"), lambda n_capitals, word_chars: 2 * n_capitals > word_chars),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda n_dup_lines, n_lines: 2 * n_dup_lines > n_lines),
    Rule("word_length", ("word_chars", "n_words"), lambda word_chars, n_words: (word_chars < 2 * n_words) | (word_chars > 15 * n_words)),
)


def measured(df: DataFrame, text: str, keep: list[str], names=tuple(MEASURES)) -> DataFrame:
    """``keep`` and the named measures as bigint columns.

    All measures of a row are fields of one expression that finds the words once, so a
    filter on one of them, which Spark evaluates where the rows are read, finds them once more.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    found = bound(words_of(value), lambda w: F.struct(*[MEASURES[n](value, w).cast("long").alias(n) for n in names]))
    return df.select(*keep, found.alias("_measures")).select(*keep, *[F.col(f"_measures.{n}").alias(n) for n in names])


def cascade_order(df: DataFrame, text: str = "text", rules=RULES, sample_rows: int = 2_000) -> list[Rule]:
    """The rules by rejections a second, estimated on a sample of about ``sample_rows`` rows.

    Each rule runs alone over the written sample; what it takes beyond reading is its
    cost.  The order decides only what is computed and which of several rules is
    named, never whether a text is kept.
    """
    total = df.count()
    if not total:
        return list(rules)
    sample = materialize(df.select(F.col(text).alias("text")).sample(min(1.0, sample_rows / total), 7), "sample")

    def seconds(expression: Column) -> tuple[float, int]:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            hits = sample.select(F.sum(expression.cast("long"))).first()[0] or 0
            took.append(time.perf_counter() - start)
        return min(took), hits

    value = F.coalesce("text", F.lit(""))
    words = words_of(value)
    base, _ = seconds(F.length(value) >= 0)

    def rate(rule: Rule) -> float:
        reject = bound(words, lambda w: rule.rejects(*[MEASURES[n](value, w) for n in rule.needs]))
        took, hits = seconds(reject)
        return hits / max(took - base, 1e-3)

    rates = {rule.name: rate(rule) for rule in rules}
    return sorted(rules, key=lambda r: -rates[r.name])


def first_rejection(order: list[Rule], measure: Callable[[str], Column]) -> Column:
    """The name of the first rule that rejects, or NULL; later rules are not evaluated."""
    found = F.lit(None).cast("string")
    for rule in reversed(order):
        found = F.when(rule.rejects(*[measure(n) for n in rule.needs]), rule.name).otherwise(found)
    return found


def quality_cascade(df: DataFrame, text: str = "text", keep: list[str] | None = None, rules=RULES, sample_rows: int = 2_000) -> DataFrame:
    """The columns ``keep`` (all by default) and ``rejected_by``, NULL for a text to keep.

    Measures are computed only as far as the cascade gets for a row, over words found
    once for all of them, also where a filter on the verdict is pushed to the scan.  A
    NULL text is an empty one and rejected as short.  Every row is judged by itself, without a
    shuffle; copies get the same verdict; an empty table gives an empty result; a
    column named ``rejected_by`` is replaced.
    """
    order = cascade_order(df, text, rules, sample_rows)
    kept = [c for c in (keep or df.columns) if c != "rejected_by"]
    value = F.coalesce(F.col(text), F.lit(""))
    verdict = bound(words_of(value), lambda w: first_rejection(order, lambda n: MEASURES[n](value, w)))
    return df.select(*kept, verdict.alias("rejected_by"))
