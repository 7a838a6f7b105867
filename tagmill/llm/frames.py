"""Helpers for frames shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.session import materialize

SENT_ROWS = 1_000_000


def matched(rows: DataFrame, keys: DataFrame, on: str, limit: int = SENT_ROWS, how: str = "left_semi") -> DataFrame:
    """The rows whose ``on`` is among ``keys`` (one column of 8 bytes, read twice), or,
    with ``left_anti``, all others.

    A key list counted as at most ``limit`` rows, eight megabytes, is sent to all
    executors so the rows stay where they are; a longer one is joined by a shuffle.
    """
    few = keys.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(keys) if few else keys, on, how)


def components(edges: DataFrame, name: str, known: DataFrame | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b); root is the smallest node reachable.

    ``known``, the result for other edges, may stand for these: what it links stays linked,
    and only the new edges cost rounds, none if there are no new ones.

    Alternates the large-star and small-star steps: every round links all larger
    neighbours of a node, then all smaller ones, to its smallest neighbour, until
    nothing changes; the number of rounds grows with the logarithm of the longest
    path.  Minima combine before the shuffle, so a node with very many links costs
    a task no more than others.  Every round is written to the shared folder.
    """
    if known is not None:
        if edges.isEmpty():
            return known
        edges = edges.select("a", "b").unionAll(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    edges = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )

    def state(edges):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        edges = materialize(small, name)
        now = state(edges)
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
