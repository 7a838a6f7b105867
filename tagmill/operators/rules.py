"""Matching texts against a rule map ``(transfer_rule, value)``.

A rule either asks for a literal substring (``contains``) or is a LIKE pattern.
Both reduce to a *needle*, a literal the text must hold, and an optional
*pattern* to check after it, so every strategy below serves both modes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import TooLarge, bounded_rows, fits
from tagmill.functions.text import clean_label, grams, needle
from tagmill.operators.skew import spread_join
from tagmill.session import materialize

# Rules compared one by one with every text, on a broadcast copy.  Measured: with
# 200 rules both strategies take the same time, with 1,000 ``gram`` takes a fifth.
NESTED_RULES = 200
# Rules looked up by substring on a broadcast copy; more are joined by a shuffle.
BROADCAST_RULES = 200_000
# How a needle is looked up, by its least length: substrings of that size are taken
# from texts at every step-th place, so ``step`` neighbouring ones of the needle
# meet each place it can stand at.  A shorter needle is looked up whole.
LOOKUPS = ((11, 6, 6), (7, 4, 4), (4, 4, 1))
# What a rule is looked up by: substrings of its needle, or the text's first or last
# characters, at most EDGE of them, where the pattern names those.
INSIDE, HEAD, TAIL = 0, 1, 2
EDGE = 32
# Characters of a text looked at together, and of the cuts those are taken from.
PIECE = 200
COARSE = 50 * PIECE


def clean_rules(rules: DataFrame, mode: str = "contains") -> DataFrame:
    """``(needle, pattern, label)``, distinct; rules without text or label drop out."""
    if mode == "contains":
        needle_col, pattern = needle(F.col("transfer_rule")), F.lit(None).cast("string")
    elif mode == "like":
        needle_col, pattern = like_parts(F.col("transfer_rule"))
    else:
        raise ValueError(f"mode {mode!r}")
    return (
        rules.where(F.col("transfer_rule").isNotNull() & F.col("value").isNotNull())
        .select(needle_col.alias("needle"), pattern.alias("pattern"), clean_label(F.col("value")).alias("label"))
        .distinct()
    )


def like_parts(rule: Column) -> tuple[Column, Column]:
    """Needle and pattern of a LIKE rule.

    ``%text%`` needs no pattern.  Otherwise the needle is the longest run free of
    wildcards; an escaped pattern has none to rely on.
    """
    simple = rule.rlike(r"(?s)^%[^%_\\]*%$")
    runs = F.transform(F.split(rule, "[%_]"), lambda run: F.struct(F.length(run).alias("n"), run.alias("run")))
    longest = F.when(rule.contains("\\"), F.lit("")).otherwise(F.array_max(runs)["run"])
    return (
        F.when(simple, needle(rule)).otherwise(longest),
        F.when(simple, F.lit(None)).otherwise(rule),
    )


def _holds(text: Column) -> Column:
    return F.contains(text, F.col("needle")) & (
        F.col("pattern").isNull() | F.like(text, F.col("pattern"))
    )


def rule_hits(
    texts: DataFrame,
    text: str,
    rules: DataFrame,
    strategy: str = "auto",
    keep_unmatched: bool = False,
    counted: bool = False,
) -> DataFrame:
    """``texts`` with the columns of each rule its ``text`` satisfies.

    ``nested`` compares every text with every rule where the text lies: no
    shuffle, and the broadcast rules are counted first.  ``gram`` is an equi join
    for rule maps beyond that size: each rule is looked up by its rarest
    substrings, or by the start or end of its pattern where fewer rules share that, and
    the few candidates are checked in full.  Both are exact and list a hit once for each
    row of ``texts``.
    ``counted`` says that the caller has found at most ``NESTED_RULES`` rules.
    """
    if strategy == "auto":
        strategy = "nested" if fits(rules, NESTED_RULES) else "gram"
    elif strategy == "nested" and not counted and not fits(rules, NESTED_RULES):
        raise TooLarge(f"more than {NESTED_RULES} rules; use strategy='gram'")
    if strategy == "nested":
        return texts.join(F.broadcast(rules), _holds(F.col(text)), "left" if keep_unmatched else "inner").drop(
            "needle", "pattern"
        )
    if strategy != "gram":
        raise ValueError(f"strategy {strategy!r}")
    hits = _gram_hits(texts, text, rules)
    if keep_unmatched:
        hits = hits.unionByName(texts, allowMissingColumns=True)
    return hits


def _gram_hits(texts: DataFrame, text: str, rules: DataFrame) -> DataFrame:
    anchors = _anchors(rules)
    patterned = F.bool_or(F.col("pattern").isNotNull())
    cuts = bounded_rows(
        anchors.groupBy("_kind", "_size", "_step").agg(
            F.max(F.length("needle")).alias("longest"), patterned.alias("patterned"), F.count(F.lit(1)).alias("rows")
        ),
        8 + 2 * EDGE,
        "substring sizes",
    )
    # Without the hint a large map is broadcast after all if its file is small by compression.
    few = sum(cut.rows for cut in cuts) <= BROADCAST_RULES
    anchors = F.broadcast(anchors) if few else anchors.hint("merge")
    texts = texts.withColumn("_row", F.monotonically_increasing_id())
    pieces = texts.withColumn("_piece", F.col(text))
    if cuts and not any(cut.patterned for cut in cuts):
        pieces = texts.withColumn("_piece", F.explode(_pieces(F.col(text), max(cut.longest for cut in cuts))))
    found = F.array(F.struct(F.lit(INSIDE).alias("_kind"), F.lit("").alias("_gram")))
    if cuts:
        found = F.array_distinct(F.flatten(F.array(*[_keys(F.col("_piece"), cut) for cut in cuts])))
    return (
        pieces.select("*", F.inline(found))
        .join(anchors.drop("_size", "_step"), ["_kind", "_gram"])
        .where(_holds(F.col("_piece")))
        .drop("_piece", "_kind", "_gram")
        .dropDuplicates(["_row", *rules.columns])
        .drop("_row", "needle", "pattern")
    )


def _keys(text: Column, cut) -> Column:
    """What rules of one kind and size are looked up by in a text."""
    size = cut["_size"]
    if cut["_kind"] == INSIDE:
        found = grams(text, size, cut["_step"])
    else:
        edge = F.left(text, F.lit(size)) if cut["_kind"] == HEAD else F.right(text, F.lit(size))
        found = F.when(F.length(text) >= size, F.array(edge)).otherwise(F.array().cast("array<string>"))
    return F.transform(found, lambda gram: F.struct(F.lit(cut["_kind"]).alias("_kind"), gram.alias("_gram")))


def _pieces(text: Column, longest: int) -> Column:
    """Pieces of a text that overlap enough to hold every needle whole.

    A row that pairs a piece with a substring stays small, however long the text;
    cutting twice spares walking a long text to the start of each piece.
    """

    def cut(part: Column, width: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(part), F.lit(width))
        return F.transform(starts, lambda at: F.substring(part, at, F.lit(width + longest - 1)))

    fine, coarse = max(PIECE, longest), max(COARSE, longest)
    pieces = F.flatten(F.transform(cut(text, coarse), lambda part: cut(part, fine)))
    return F.when(F.length(text) <= fine, F.array(text)).otherwise(pieces)


def _anchors(rules: DataFrame) -> DataFrame:
    """A row per rule and key it is looked up by: an edge, or its needle's rarest run of neighbours."""
    chosen = _lookups(rules)
    edges = chosen.where(F.col("_kind") != INSIDE).select(
        *rules.columns, "_kind", F.length("_gram").alias("_size"), F.lit(1).alias("_step"), "_gram"
    )
    inside = chosen.where(F.col("_kind") == INSIDE).select(*rules.columns)
    return _needle_anchors(inside).select(*edges.columns).unionAll(edges)


def _lookups(rules: DataFrame) -> DataFrame:
    """``rules`` with the kind of their lookup, and the characters of an edge in ``_gram``.

    Of its needle and the edges of its pattern a rule takes what the fewest rules share,
    the longer of equals.  Many rules may share a needle, as those of one product do that differ
    in a short number; a text has one start and one end of each size, so it meets few rules there.
    """
    runs = F.split("pattern", "[%_]")

    def option(kind: int, run: Column) -> Column:
        key = run if kind == INSIDE else F.left(run, F.lit(EDGE)) if kind == HEAD else F.right(run, F.lit(EDGE))
        return F.struct(F.lit(kind).alias("_kind"), key.alias("_gram"), F.length(run).alias("n"))

    options = F.array(option(INSIDE, F.col("needle")), option(HEAD, runs[0]), option(TAIL, F.element_at(runs, -1)))
    usable = F.filter(options, lambda o: (o["_kind"] == INSIDE) | (o["n"] > 0))
    # A pattern with an escape has no runs to rely on.
    free = F.col("pattern").isNotNull() & ~F.col("pattern").contains("\\")
    edged = rules.where(free).select(*rules.columns, F.inline(usable))
    uses = edged.groupBy("_kind", "_gram").agg(F.count(F.lit(1)).alias("_uses"))
    best = F.min_by(F.struct("_kind", "_gram"), F.struct("_uses", -F.col("n"), -F.col("_kind"))).alias("best")
    edged = edged.join(uses, ["_kind", "_gram"]).groupBy(*rules.columns).agg(best).select(*rules.columns, "best.*")
    others = rules.where(~F.coalesce(free, F.lit(False)))
    return edged.unionAll(others.select(*rules.columns, F.lit(INSIDE).alias("_kind"), F.lit("").alias("_gram")))


def _needle_anchors(rules: DataFrame) -> DataFrame:
    """A row per rule and substring of its needle's rarest run of neighbours."""
    size, step = F.length("needle"), F.lit(1)
    for least, at_size, at_step in reversed(LOOKUPS):
        long_enough = F.length("needle") >= least
        size = F.when(long_enough, at_size).otherwise(size)
        step = F.when(long_enough, at_step).otherwise(step)
    sized = rules.select("needle").distinct().withColumns({"_size": size, "_step": step})
    parts = sized.select(
        "needle", "_size", "_step", F.posexplode(grams(F.col("needle"), F.col("_size"))).alias("_at", "_gram")
    )
    uses = parts.groupBy("_gram").agg(F.count(F.lit(1)).alias("_uses"))
    placed = F.array_sort(F.collect_list(F.struct("_at", "_gram", "_uses"))).alias("_parts")
    known = parts.join(uses, "_gram").groupBy("needle", "_size", "_step").agg(placed)
    run = F.slice("_parts", F.col("_from") + 1, F.col("_step"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("_parts") - F.col("_step")),
        lambda i: F.struct(
            F.aggregate(
                F.slice("_parts", i + 1, F.col("_step")), F.lit(0).cast("bigint"), lambda n, p: n + p["_uses"]
            ).alias("n"),
            i.alias("at"),
        ),
    )
    chosen = known.withColumn("_from", F.array_min(runs)["at"])
    looked_up = F.array_distinct(F.transform(run, lambda p: p["_gram"]))
    anchors = chosen.select("needle", "_size", "_step", F.explode(looked_up).alias("_gram"))
    return rules.join(anchors, "needle").withColumn("_kind", F.lit(INSIDE))


def match_rules(
    users: DataFrame,
    rules: DataFrame,
    *,
    key: str = "distinct_id",
    urls: str = "dollar_url_list",
    scope: str = "row",
    strategy: str = "auto",
    dedupe: bool = False,
    keep_unmatched: bool = False,
    counted: bool = False,
) -> DataFrame:
    """``(key, label, ...)`` per hit of a cleaned rule map; repeats are possible.

    ``row`` tests the URLs of a row joined without a separator, so a needle may
    span two of them; ``url`` tests each URL alone.  Every visit is tested where it
    lies, without a shuffle; with ``dedupe`` a URL is tested once for all its
    visitors and joined back, which pays when URLs repeat much and rules are many
    (distinct visits are written aside, as they are read twice).
    ``keep_unmatched`` adds users without a hit, label NULL.
    """
    payload = [c for c in rules.columns if c not in ("needle", "pattern")]
    if scope not in ("row", "url"):
        raise ValueError(f"scope {scope!r}")
    if scope == "row" or not dedupe:
        joined = F.array_join(urls, "") if scope == "row" else F.explode_outer(urls)
        texts = users.select(key, joined.alias("text"))
        return rule_hits(texts, "text", rules, strategy, keep_unmatched, counted).select(key, *payload)
    visits = users.select(key, F.explode(urls).alias("text")).where(F.col("text").isNotNull())
    visits = materialize(visits.distinct(), "url-visits")
    texts = visits.groupBy("text").agg(F.count(F.lit(1)).alias("_users"))
    hits = materialize(rule_hits(texts, "text", rules, strategy, counted=counted).distinct(), "url-hits")
    pairs = spread_join(visits, hits, "text", "_users", key).select(key, *payload)
    if keep_unmatched:
        pairs = pairs.unionByName(users.select(key), allowMissingColumns=True)
    return pairs


def audit_rules(rules: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Findings ``(finding, transfer_rule, label)`` that silently change labels."""
    rule, value = F.col("transfer_rule"), F.col("value")
    label = clean_label(value)
    seen = rules.select("transfer_rule", "value").distinct()
    issues = F.array_compact(
        F.array(
            F.when(rule.isNull(), F.lit("null_rule")),
            F.when(needle(rule) == "", F.lit("empty_needle")),
            F.when(rule.rlike(r"(?s)[^%]%+[^%]"), F.lit("inner_wildcard")),
            F.when(value.isNull(), F.lit("null_label")),
            F.when(label == "", F.lit("blank_label")),
        )
    )
    own = seen.select(F.explode(issues).alias("finding"), "transfer_rule", label.alias("label"))
    labels = seen.select(label.alias("label")).where(F.col("label").isNotNull()).distinct()
    known = dictionary.select(F.upper("product_label").alias("label")).distinct()
    none = F.lit(None).cast("string").alias("transfer_rule")
    missing, idle = F.lit("label_not_in_dictionary"), F.lit("label_without_rule")
    unknown = labels.join(known, "label", "left_anti").select(missing.alias("finding"), none, "label")
    unused = known.join(labels, "label", "left_anti").select(idle.alias("finding"), none, "label")
    return own.unionByName(unknown).unionByName(unused)
