"""LIKE over URL lists that are cut into parts, as if each list were whole.

A pattern without its ``%`` is a row of segments, each of a fixed number of characters.
Matching takes the first place of every segment behind the one before, so all that
must be known at the end of a part is how many segments are found and how far the last one
lies behind or ahead.  Each part is a map from that state at its start to the state at its
end; maps are composed in part order, in groups, so no user is gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.bounds import fits
from tagmill.operators.rules import BROADCAST_RULES, match_rules, rule_hits
from tagmill.session import materialize

# Maps of neighbouring parts composed at a time.
COMPOSED = 500
# Stands for a wildcard between segments; no pattern may hold it.
_GAP = "\x00"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), use)[0]


def _tokens(text: Column) -> Column:
    """Characters of a pattern, an escaped one together with its backslash."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(\\.|.)"), F.lit(1))


def _segment(text: Column) -> Column:
    """Length of a segment and the regular expression for it."""
    one = lambda t: F.when(t == "_", F.lit(".")).otherwise(
        F.concat(F.lit(r"\x{"), F.hex(F.ascii(F.substring(t, -1, 1))), F.lit("}"))
    )
    return _bound(_tokens(text), lambda ts: F.struct(F.size(ts).alias("n"), F.array_join(F.transform(ts, one), "").alias("rx")))


def spelt_out(rules: DataFrame) -> DataFrame:
    """Cleaned LIKE rules, each with a pattern: one that only asks for its needle gets ``%needle%``."""
    literal = F.regexp_replace("needle", r"([\\%_])", r"\\$1")
    return rules.withColumn("pattern", F.coalesce("pattern", F.concat(F.lit("%"), literal, F.lit("%"))))


def with_segments(rules: DataFrame) -> DataFrame:
    """``rules`` with the parts of their LIKE ``pattern``.

    ``head`` must start the text and ``tail`` end it (length 0 where a ``%`` stands); ``mids`` follow
    each other between them; ``whole`` says that there is no ``%`` at all, so the head is everything.
    ``reach`` is one more than the length of the longest segment.
    """
    gaps = F.array_join(F.transform(_tokens(F.col("pattern")), lambda t: F.when(t == "%", F.lit(_GAP)).otherwise(t)), "")
    pieces = F.transform(F.split(gaps, _GAP, -1), _segment)
    cut = rules.withColumn("_p", pieces)
    inner = F.filter(F.slice("_p", 2, F.greatest(F.size("_p") - 2, F.lit(0))), lambda s: s["n"] > 0)
    return cut.select(
        *rules.columns,
        F.col("_p")[0].alias("head"),
        F.element_at("_p", -1).alias("tail"),
        inner.alias("mids"),
        (F.size("_p") == 1).alias("whole"),
        (F.array_max(F.transform("_p", lambda s: s["n"])) + 1).alias("reach"),
    )


def _states(text: Column, own: Column, mids: Column, reach: Column) -> Column:
    """The state a part leaves for every state it may be entered with.

    A state is ``found * 2 * reach + at + reach``: so many segments are found, and the
    last of them ends ``at`` characters behind the part's start; one that ended long before counts as ``-reach``.
    Segments start among the part's ``own`` characters and may end in those that follow.
    """

    def ahead(found: Column, at: Column) -> Column:
        """Where the segment after ``found`` ones ends if it is sought from ``at``; NULL if it is not in this part."""
        seg = F.get(mids, found)
        hit = F.regexp_substr(F.substring(text, at + 1, F.length(text)), F.concat(F.lit("(?s)^.*?"), seg["rx"]))
        size = F.length(F.when(found < F.size(mids), hit))
        return _bound(size, lambda n: F.when(at + n - seg["n"] < own, at + n))

    def walked(found: Column, at: Column) -> Column:
        """Segments found and the end of the last one, from a start on."""
        start = F.struct(found.alias("found"), at.alias("at"), F.lit(True).alias("on"))
        rest = F.filter(F.transform(mids, lambda _, i: i), lambda i: i >= found)

        def step(acc: Column, i: Column) -> Column:
            end = F.when(acc["on"], ahead(i, acc["at"]))
            return _bound(
                end,
                lambda e: F.struct(
                    (acc["found"] + F.when(e.isNotNull(), 1).otherwise(0)).alias("found"),
                    F.coalesce(e, acc["at"]).alias("at"),
                    (acc["on"] & e.isNotNull()).alias("on"),
                ),
            )

        return F.aggregate(rest, start, step)

    def left(found: Column, at: Column, end: Column) -> Column:
        """The state left by a walk; without a new segment the old end moves back."""
        last = F.when(end["found"] > found, end["at"]).otherwise(at)
        return end["found"] * 2 * reach + F.greatest(last - own, -reach) + reach

    def entered(firsts: Column, walks: Column, state: Column) -> Column:
        found = F.floor(state / (2 * reach)).cast("int")
        at = state % (2 * reach) - reach
        first = F.get(firsts, found)
        # From the part's start on, or behind what lies before the first hit, the walk is the same.
        same = (at <= 0) | first.isNull() | (first - F.get(mids, found)["n"] >= at)
        still = F.struct(found.alias("found"), at.alias("at"), F.lit(False).alias("on"))
        walk = F.when(same & first.isNull() & (at > 0), still).when(same, F.get(walks, found)).otherwise(walked(found, F.greatest(at, F.lit(0))))
        return left(found, at, walk)

    places = F.sequence(F.lit(0), F.size(mids))
    every = F.sequence(F.lit(0), (F.size(mids) + 1) * 2 * reach - 1)
    firsts = F.transform(places, lambda s: ahead(s, F.lit(0)))
    walks = F.transform(places, lambda s: walked(s, F.lit(0)))
    return _bound(firsts, lambda f: _bound(walks, lambda w: F.transform(every, lambda i: entered(f, w, i).cast("int"))))


def _folded(maps: DataFrame, by: list[str]) -> DataFrame:
    """Maps, lengths and ends of up to ``COMPOSED`` neighbouring parts as one."""
    parts = F.sort_array(F.collect_list(F.struct("part", "states", "chars", "first", "last")))
    grouped = maps.groupBy(*by, F.floor(F.col("part") / COMPOSED).alias("_next")).agg(parts.alias("_parts"))
    states = F.aggregate(
        F.transform(F.slice("_parts", 2, F.size("_parts")), lambda p: p["states"]),
        F.col("_parts")[0]["states"],
        lambda acc, g: F.transform(acc, lambda s: F.get(g, s)),
    )
    # Only as much of both ends is kept as a segment can reach; NULL at the start marks a later part.
    chars = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["chars"])
    last = F.aggregate("_parts", F.lit(""), lambda t, p: F.right(F.concat(t, p["last"]), F.col("reach")))
    return grouped.select(
        *by,
        F.col("_next").alias("part"),
        states.alias("states"),
        chars.alias("chars"),
        F.col("_parts")[0]["first"].alias("first"),
        last.alias("last"),
    )


def cut_like_hits(lists: DataFrame, rules: DataFrame, key: str, list_urls: int, urls: str = "dollar_url_list") -> DataFrame:
    """``(key, <columns of rules but needle and pattern>)`` of the users whose whole list a rule matches.

    ``lists`` holds ``(key, part, urls)`` with ``list_urls`` URLs a part and, behind them, at least as many of the
    next part as the longest segment has characters; ``rules`` are cleaned LIKE rules.
    Only rules whose longest literal run occurs in some part of a user are looked at.
    """
    payload = [c for c in rules.columns if c not in ("needle", "pattern")]
    named = materialize(with_segments(spelt_out(rules).withColumn("_rule", F.monotonically_increasing_id())), "like-rules")
    own = F.length(F.array_join(F.slice(urls, 1, list_urls), ""))
    texts = lists.select(key, "part", F.array_join(urls, "").alias("_text"), own.alias("chars"))
    needles = named.select("needle", F.lit(None).cast("string").alias("pattern"), "_rule")
    candidates = materialize(rule_hits(texts.select(key, "_text"), "_text", needles).select(key, "_rule").distinct(), "like-candidates")
    sought = candidates.join(named.select("_rule", "head", "tail", "mids", "whole", "reach"), "_rule")
    sought = sought.withColumnRenamed(key, "_key")
    if fits(candidates, BROADCAST_RULES):
        sought = F.broadcast(sought)
    pairs = texts.join(sought, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    by = [key, "_rule", "head", "tail", "mids", "whole", "reach"]
    maps = pairs.select(
        *by,
        "part",
        _states(F.col("_text"), F.col("chars"), F.col("mids"), F.col("reach")).alias("states"),
        F.col("chars").cast("bigint").alias("chars"),
        F.substring("_text", F.lit(1), F.col("reach")).alias("first"),
        F.right(F.substring("_text", F.lit(1), F.col("chars")), F.col("reach")).alias("last"),
    )
    most = lists.agg(F.max("part")).first()[0] or 0
    while True:
        maps = materialize(_folded(maps, by), "like-maps")
        most //= COMPOSED
        if not most:
            break
    starts = F.regexp_like("first", F.concat(F.lit("(?s)^"), F.col("head")["rx"]))
    ends = F.regexp_like("last", F.concat(F.lit("(?s)"), F.col("tail")["rx"], F.lit(r"\z")))
    final = F.get("states", F.col("head")["n"] + F.col("reach"))
    found, room = F.floor(final / (2 * F.col("reach"))), -(final % (2 * F.col("reach")) - F.col("reach"))
    spread = (found == F.size("mids")) & (room >= F.col("tail")["n"]) & ends
    hit = starts & F.when(F.col("whole"), F.col("chars") == F.col("head")["n"]).otherwise(spread)
    return maps.where(hit).select(key, "_rule").join(named.select("_rule", *payload), "_rule").select(key, *payload)


def longest_segment(rules: DataFrame) -> int:
    """Characters of the longest segment of cleaned LIKE rules."""
    return (with_segments(spelt_out(rules)).agg(F.max("reach")).first()[0] or 1) - 1


def match_cut_lists(
    lists: DataFrame, rules: DataFrame, *, key: str, list_urls: int, keep_unmatched: bool = False, **matching
) -> DataFrame:
    """``match_rules`` in scope ``row`` for LIKE rules, where lists of users may be cut into parts.

    Whole lists are matched as they are, those of users with several parts by ``cut_like_hits``.
    """
    lists = materialize(lists, "lists")
    heavy = materialize(lists.where("part > 0").select(F.col(key).alias("_key")).distinct(), "cut-users")
    same = F.col(key).eqNullSafe(F.col("_key"))
    light = lists.join(heavy, same, "left_anti").select(key, "dollar_url_list")
    hits = match_rules(light, rules, key=key, keep_unmatched=keep_unmatched, **matching)
    if heavy.isEmpty():
        return hits
    cut = cut_like_hits(lists.join(heavy, same, "left_semi"), rules, key, list_urls)
    hits = hits.unionByName(cut)
    if keep_unmatched:
        hits = hits.unionByName(heavy.select(F.col("_key").alias(key)), allowMissingColumns=True)
    return hits
