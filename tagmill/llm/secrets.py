"""Secrets in texts, found through a trigram index.  Spark expressions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.frames import SENT_ROWS
from tagmill.llm.quality import bound
from tagmill.session import materialize


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{24,}"),
)
RULES = BASE + MORE
PART = 1024  # code points of a part while spans are masked
MOST = 8  # alternatives kept apart while a pattern is read


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """What a match must contain, in lower case: all of the clauses, of each clause one of
    the alternatives, of an alternative all trigrams.  An empty list: nothing is mandatory."""
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> set[str]:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))
        return {""}

    def exact(items) -> set[str] | None:
        """All strings that the items match if they are few, else None."""
        found = {""}
        for kind, value in items:
            name = str(kind)
            if name == "LITERAL":
                some = {chr(value).lower()}
            elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value):
                some = {chr(v).lower() for _, v in value}
            elif name == "SUBPATTERN":
                some = exact(value[-1])
            elif name == "BRANCH":
                parts = [exact(b) for b in value[1]]
                some = None if None in parts else set().union(*parts)
            elif name == "MAX_REPEAT" and value[:2] == (0, 1):
                some = exact(value[2])
                some = some and some | {""}
            elif name == "MAX_REPEAT" and value[0] == value[1] <= MOST:
                some = exact(list(value[2]) * value[0])
            else:
                some = None
            if some is None or len(found) * len(some) > MOST:
                return None
            found = {a + b for a in found for b in some}
        return found

    def read(items, strings: set[str]) -> set[str]:
        """``strings``: what may stand just before, from the last gap on."""
        for item in items:
            name = str(item[0])
            some = exact([item])
            if some is not None and len(strings) * len(some) <= MOST:
                strings = {a + b for a in strings for b in some}
            elif name == "SUBPATTERN":
                strings = read(item[1][-1], strings)
            elif name == "MAX_REPEAT" and item[1][0] >= 1:
                close(read(item[1][2], strings))
                strings = {""}
            else:
                strings = close(strings)
                if some is not None and "" not in some:
                    strings = some
        return strings

    close(read(re._parser.parse(pattern), {""}))
    return clauses


def trigram_index(df: DataFrame, text: str, trigrams: list[str]) -> DataFrame:
    """Postings (trigram number, text fingerprint) of the given trigrams over all rows.

    Copies of a text have one fingerprint; should two texts share one, both become
    candidates, and verification tells them apart.
    """
    listed = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for i, t in enumerate(trigrams)])
    found = F.transform(
        F.array(F.lower(text)), lambda low: F.transform(F.filter(listed, lambda x: F.contains(low, x.t)), lambda x: x.i)
    )[0]
    return df.select(F.xxhash64(text).alias("_h"), F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules, trigrams: list[str]) -> DataFrame:
    """(fingerprint, bits of the rules whose queries hold): postings are intersected as
    bit sets, which combine before the shuffle into one row a text and task."""
    at = {t: i for i, t in enumerate(trigrams)}
    words = -(-len(trigrams) // 62)
    sets = index.groupBy("_h").agg(
        *[
            F.bit_or(
                F.when(F.floor(F.col("trigram") / 62) == w, F.expr("shiftleft(1L, trigram % 62)")).otherwise(F.lit(0).cast("long"))
            ).alias(f"_w{w}")
            for w in range(words)
        ]
    )

    def holds(alternative) -> Column:
        ok = F.lit(True)
        for w in range(words):
            bits = sum(1 << (at[t] % 62) for t in alternative if at[t] // 62 == w)
            if bits:
                ok &= F.col(f"_w{w}").bitwiseAND(F.lit(bits)) == bits
        return ok

    rule_bits = F.lit(0)
    for bit, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query:
            ok = F.lit(True)
            for clause in query:
                some = F.lit(False)
                for alternative in clause:
                    some |= holds(alternative)
                ok &= some
            rule_bits = rule_bits + F.when(ok, 1 << bit).otherwise(0)
    return sets.select("_h", rule_bits.cast("int").alias("_rules")).where("_rules <> 0")


def running(values: Column, both) -> Column:
    """For every place ``both`` folded over the integers up to it; each pass doubles how far back a place sees."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def doubled(held, k):
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(held, lambda v, i: F.when(i < back, v).otherwise(both(v, F.get(held, i - back))))

    return F.aggregate(passes, values, doubled)


def _spans(text: Column, rule: Rule) -> Column:
    """Matches from left to right.  What lies between them and what they hold alternate, so
    running lengths give the positions, in code points."""
    pattern = F.lit(rule.pattern)
    held = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    zipped = F.zip_with(
        F.arrays_zip(F.transform(held, F.length).alias("n"), F.transform(group, F.length).alias("g")),
        F.slice(F.transform(between, F.length), 1, F.size(held)),
        lambda m, gap: F.struct(m["n"].alias("n"), m["g"].alias("g"), gap.alias("gap")),
    )
    placed = bound(
        zipped,
        lambda some: F.zip_with(
            some,
            running(F.transform(some, lambda m: m["gap"] + m["n"]), lambda x, y: x + y),
            lambda m, end: F.struct((end - m["n"]).alias("start"), end.alias("end"), m["g"].alias("g")),
        ),
    )
    return F.filter(placed, lambda m: m["g"] >= rule.least)


def _named(spans: Column, place: int, kind: str) -> Column:
    return F.transform(
        spans, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"))
    )


SPANS = "array<struct<start:int,place:int,end:int,kind:string>>"


def scan_secrets(df: DataFrame, text: str, keep: list[str], rules=RULES, sent: int = SENT_ROWS) -> DataFrame:
    """``keep`` and ``secrets``: spans (start, place of the rule, end, kind) by start.

    Each rule's pattern is read for trigrams that every match contains.  An index over
    those trigrams gives the candidate texts of each rule; patterns run on candidates
    only.  A rule without mandatory trigrams is tried on every text.  Starts and ends
    count code points, the end is exclusive; matches of one rule never overlap.

    A NULL or empty text has no spans; all rows stay.  The texts themselves are not
    shuffled while the candidate list has at most ``sent`` rows; a longer list is
    joined by a shuffle, in which adaptive execution splits a text with very many copies.
    """
    trigrams = sorted({t for rule in rules for clause in trigram_query(rule.pattern) for alt in clause for t in alt})
    texts = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = materialize(candidates(trigram_index(texts, "_text", trigrams), rules, trigrams), "candidates")
    few = found.limit(sent + 1).count() <= sent
    texts = texts.withColumn("_h", F.xxhash64("_text")).join(F.broadcast(found) if few else found, "_h", "left")
    parts = []
    for bit, rule in enumerate(rules):
        value = F.col("_text")
        if trigram_query(rule.pattern):
            maybe = F.coalesce("_rules", F.lit(0)).bitwiseAND(F.lit(1 << bit)) != 0
        else:
            maybe = F.rlike(value, F.lit(rule.pattern))
        spans = _named(_spans(value, rule), bit, rule.kind)
        parts.append(F.when(maybe, spans.cast(SPANS)).otherwise(F.array().cast(SPANS)))
    return texts.select(*keep, F.sort_array(F.concat(*parts)).alias("secrets"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans, by start, may overlap.

    A span that begins before an earlier one ends prolongs it.  What stands between them
    is taken from parts of ``PART`` code points, so a piece costs no walk from the start.
    """

    def between(parts, start, end):
        first = F.floor(start / PART).cast("int")
        some = F.slice(parts, first + 1, F.greatest(F.ceil(end / PART).cast("int") - first, F.lit(0)))
        return F.substring(F.array_join(some, ""), start - first * PART + 1, end - start)

    def joined(parts):
        def pieces(reached):
            def piece(s, i):
                at = F.when(i == 0, 0).otherwise(F.get(reached, i - 1))
                return F.when(s["start"] >= at, F.concat(between(parts, at, s["start"]), F.lit("["), s["kind"], F.lit("]"))).otherwise("")

            tail = between(parts, F.element_at(reached, -1), F.length(text))
            return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

        return bound(running(F.transform(spans, lambda s: s["end"]), F.greatest), pieces)

    return F.when(F.size(spans) > 0, bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)), joined)).otherwise(text)
