"""Text rules: labels, needles and argument decoding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes used for characters that a command line cannot carry (fixed values,
# replaced in this order).
LABEL_CODES = (("_and_", "&"), ("_or_", "/"), ("__", " "))


def clean_label(value: Column) -> Column:
    """Upper case without leading white space, Unicode blanks and separators included."""
    return F.regexp_replace(F.upper(value), r"(?U)^[\s\x1c-\x1f]+", "")


def needle(rule: Column) -> Column:
    """The literal text a rule asks for: every ``%`` is dropped, ``_`` is itself."""
    return F.replace(rule, F.lit("%"), F.lit(""))


def strip_blanks(rule: Column) -> Column:
    return F.replace(rule, F.lit(" "), F.lit(""))


def decode_label(label: Column | str) -> Column | str:
    """Undo ``LABEL_CODES`` on a job argument or on a column."""
    if isinstance(label, str):
        return reduce(lambda text, code: text.replace(*code), LABEL_CODES, label)
    return reduce(lambda c, code: F.replace(c, F.lit(code[0]), F.lit(code[1])), LABEL_CODES, label)


def grams(text: Column, size: Column | int, step: Column | int = 1) -> Column:
    """Substrings of ``size`` characters at every ``step``-th place; empty when there is none."""
    size = F.lit(size) if isinstance(size, int) else size
    step = F.lit(step) if isinstance(step, int) else step
    last = F.length(text) - size + 1
    cut = F.transform(F.sequence(F.lit(1), last, step), lambda i: F.substring(text, i, size))
    return F.when(last >= 1, cut).otherwise(F.array().cast("array<string>"))


def quoted(name: str) -> str:
    """A column name safe for ``F.col``, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def unique_names(names, taken=()) -> list[str]:
    """Number names that clash under case-insensitive resolution."""
    used = {name.lower() for name in taken}
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate.lower() in used:
            n += 1
            candidate = f"{name}_{n}"
        used.add(candidate.lower())
        out.append(candidate)
    return out
