"""URL lists per user, built from single visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import materialize

# URLs one list may hold; a user with more gets several lists.
LIST_URLS = 10_000
# Visits of heavy users one task sorts at a time, and most tasks that share them.
SORT_ROWS = 2_000_000
SORT_TASKS = 20_000


def user_url_lists(
    visits: DataFrame,
    key: str = "distinct_id",
    order: str = "seq",
    url: str = "url",
    list_urls: int = LIST_URLS,
    overlap: int | None = None,
) -> DataFrame:
    """``(key, part, dollar_url_list)``: the URLs of each user in ``order``.

    ``order`` must tell the visits of one user apart.  A user with at most
    ``list_urls`` visits gets one list, part 0.  A heavier one, who may hold a
    third of all visits, is never gathered: the visits are range-partitioned,
    numbered, and cut into consecutive parts.  ``overlap`` repeats the first URLs
    of a part at the end of the part before; rows of one user are combined by OR
    after matching, so with ``overlap >= longest needle - 1`` the parts match
    exactly what the single list would.  It must be named once a user is heavy: cut
    lists without it are refused (``lists_for_rules`` computes it).  NULL and empty URLs are left out, so
    every URL has a character; a user with no other keeps an empty list.
    """
    if overlap is not None and not 0 <= overlap <= list_urls:
        raise ValueError("overlap must lie between 0 and list_urls")
    rows = visits.select(key, F.col(order).alias("_seq"), F.col(url).alias("_url"))
    heavy = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_urls)
    heavy = materialize(heavy, "heavy-users")
    total = heavy.agg(F.sum("_n")).first()[0]
    if total is None:
        return _whole_lists(rows, key)
    if overlap is None:
        raise ValueError(f"users with more than {list_urls} visits have their lists cut; name the overlap")
    full = rows.where(F.col("_url") != "")
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"h.{key}"))
    light = rows.alias("r").join(heavy.alias("h"), same, "left_anti")
    ranged = materialize(
        full.alias("r")
        .join(heavy.alias("h"), same, "left_semi")
        .repartitionByRange(min(SORT_TASKS, max(2, -(-total // SORT_ROWS))), key, "_seq")
        .withColumn("_slice", F.spark_partition_id()),
        "visits",
    )
    at = F.floor((F.col("_rn") - 1) / list_urls).cast("bigint")
    into = F.col("_rn") - 1 - at * list_urls
    parts = F.when((at > 0) & (into < overlap), F.array(at, at - 1)).otherwise(F.array(at))
    cut = _numbered(ranged, key).withColumn("part", F.explode(parts))
    seen = ranged.select(key).distinct()
    blank = heavy.alias("r").join(seen.alias("h"), same, "left_anti").select(
        key, F.lit(0).cast("bigint").alias("part"), F.array().cast("array<string>").alias("dollar_url_list")
    )
    return _whole_lists(light, key).unionByName(cut.groupBy(key, "part").agg(_collected())).unionByName(blank)


def lists_for_rules(
    visits: DataFrame,
    rules: DataFrame,
    key: str = "distinct_id",
    order: str = "seq",
    url: str = "url",
    list_urls: int = LIST_URLS,
) -> DataFrame:
    """``user_url_lists`` for a cleaned rule map: parts overlap by its longest needle, so
    matching them in scope ``row`` finds what the whole lists hold."""
    longest = rules.agg(F.max(F.length("needle"))).first()[0] or 0
    overlap = max(0, longest - 1)
    return user_url_lists(visits, key, order, url, max(list_urls, overlap), overlap)


def _numbered(ranged: DataFrame, key: str) -> DataFrame:
    """Number the rows of each key by ``_seq`` without one task seeing a whole key.

    Slices follow the order, so a row's number is its place in its slice plus the
    rows of the key in the slices before.
    """
    within = Window.partitionBy(key, "_slice").orderBy("_seq")
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        F.col(key).alias("_key"),
        F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    return (
        ranged.withColumn("_place", F.row_number().over(within))
        .join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")))
        .select(key, "_seq", "_url", (F.col("_place") + F.col("_offset")).alias("_rn"))
    )


def _collected():
    """The URLs of a group in order; empty ones are skipped, the group stays."""
    pairs = F.sort_array(F.collect_list(F.when(F.col("_url") != "", F.struct("_seq", "_url"))))
    return F.transform(pairs, lambda r: r["_url"]).alias("dollar_url_list")


def _whole_lists(rows: DataFrame, key: str) -> DataFrame:
    """One list per key; grouped by the key alone, so later steps need no new shuffle."""
    lists = rows.groupBy(key).agg(_collected())
    return lists.select(key, F.lit(0).cast("bigint").alias("part"), "dollar_url_list")
