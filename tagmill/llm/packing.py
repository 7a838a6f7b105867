"""Optimal length buckets and token-budget batches inside them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.session import materialize

# Lengths up to EXACT have a bin each; beyond, a bin spans 1/EXACT of a power of two.
# 64-bit lengths so give at most EXACT * 53 bins, whatever the corpus holds.
EXACT = 2048


def length_bin(length: Column) -> Column:
    """The largest length that falls in the same bin as ``length``."""
    step = F.greatest(F.lit(1).cast("long"), F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double")) + 1e-12) - 11).cast("long"))
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step) * step).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in total.

    ``lengths`` ascend; a document is padded to its bucket's bound, and the last
    bound is the largest length.  ``least[j]`` after k rounds is the least number of
    padded tokens for the first j bins in k buckets.  The cost of a bucket satisfies
    the quadrangle inequality, so the best cut never moves left as j grows, and each
    round halves its ranges: O(bins log bins) a bucket.  Of equally good plans the
    one with the smaller cuts is taken.
    """
    n = len(lengths)
    if n == 0:
        return []
    held = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    worst = np.iinfo(np.int64).max // 4
    least = np.full(n + 1, worst)
    least[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        best, at = np.full(n + 1, worst), np.zeros(n + 1, np.int64)
        spans = [(1, n, 0, n - 1)]
        while spans:
            lo, hi, a, b = spans.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            cost = least[i] + (held[j] - held[i]) * lengths[j - 1]
            k = int(cost.argmin())
            best[j], at[j] = min(int(cost[k]), worst), i[k]
            spans += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        if best[n] >= least[n]:
            break
        least = best
        cuts.append(at)
    bounds, j = [], n
    for at in reversed(cuts):
        bounds.append(int(lengths[j - 1]))
        j = int(at[j])
        if j == 0:
            break
    return bounds[::-1]


def pack(df: DataFrame, key: str, length: Column, buckets: int = 16, budget: int = 65_536, keep=()) -> DataFrame:
    """Every row with its length bucket and its batch.

    A dynamic program over the histogram of all lengths chooses the bucket bounds
    with the least padding (``best_bounds``); bounds are ends of ``length_bin``
    bins, which are single lengths up to 2,048.  Inside a bucket rows are ordered by
    the MD5 of their key, a fixed shuffle, and cut into batches of
    ``budget // pad_to`` rows (one at least), so a batch never holds more than
    ``budget`` padded tokens unless a single row does.

    Returns the columns ``keep``, ``key``, ``n_tokens``, ``bucket`` (from 0, by
    length), ``pad_to``, ``batch`` (from 0 inside the bucket) and ``slot`` (inside
    the batch).  A NULL length is 0; a NULL key sorts as an empty text; rows with the
    same key stand next to each other in any order; an empty table gives no rows.

    Only keys and lengths are shuffled.  A bucket may hold any share of the rows: its
    positions are counted in 4,096 parts by the first MD5 digits, and the parts'
    totals give each part its offset.
    """
    rows = df.select(F.col(key), *keep, F.coalesce(length.cast("long"), F.lit(0)).alias("n_tokens"))
    rows = materialize(rows.withColumn("_bin", length_bin(F.col("n_tokens"))), "lengths")
    bins = rows.groupBy("_bin").agg(F.count("*").alias("n")).orderBy("_bin").toPandas()  # EXACT * 53 rows at most
    lengths = bins["_bin"].to_numpy(np.int64)
    bounds = best_bounds(lengths, bins["n"].to_numpy(np.int64), buckets)
    bucket = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("_bin") <= bounds[i], i).otherwise(bucket)
    pad = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1) if bounds else F.lit(0).cast("long")
    rows = (
        rows.withColumn("bucket", bucket.cast("int"))
        .withColumn("pad_to", pad)
        .withColumn("_order", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")))
        .withColumn("_part", F.substring("_order", 1, 3))
    )
    counts = rows.groupBy("bucket", "_part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("bucket", "_part").orderBy("_order", key)
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("pad_to"), F.lit(1))))
    # 4,096 rows a bucket at most.
    placed = rows.withColumn("_nth", F.row_number().over(inside)).join(F.broadcast(offsets), ["bucket", "_part"])
    placed = placed.withColumn("_at", F.col("_offset") + F.col("_nth") - 1)
    return placed.select(
        *keep,
        key,
        "n_tokens",
        "bucket",
        "pad_to",
        F.floor(F.col("_at") / per).cast("long").alias("batch"),
        (F.col("_at") % per).cast("long").alias("slot"),
    )


def pack_sql(rows: str, key: str, buckets: int, budget: int, columns: str = "") -> str:
    """DuckDB SQL for ``pack`` over ``rows``, a query with ``key`` and ``n_tokens``: the
    program's rounds as a recursion over all pairs of bins, for small tables."""
    extra = f"{columns}, " if columns else ""
    return f"""WITH RECURSIVE lens AS MATERIALIZED ({rows}),
steps AS (SELECT *, CASE WHEN n_tokens <= {EXACT} THEN 1 ELSE (1::BIGINT << (floor(log2(n_tokens) + 1e-12)::INT - 11)) END AS step FROM lens),
binned AS MATERIALIZED (SELECT * EXCLUDE (step), ((n_tokens + step - 1) // step * step)::BIGINT AS bin FROM steps),
hist AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
cum AS MATERIALIZED (SELECT row_number() OVER (ORDER BY bin) AS j, bin, sum(n) OVER (ORDER BY bin)::BIGINT AS held FROM hist),
ends AS (SELECT 0::BIGINT AS i, 0::BIGINT AS held UNION ALL SELECT j, held FROM cum),
prog AS (
  SELECT 0 AS k, 0::BIGINT AS j, 0::BIGINT AS cost, 0::BIGINT AS cut
  UNION ALL
  SELECT k + 1, j, least_cost.c, least_cost.i FROM (
    SELECT p.k, c.j, min(struct_pack(c := p.cost + (c.held - e.held) * c.bin, i := p.j)) AS least_cost
    FROM prog p JOIN ends e ON e.i = p.j JOIN cum c ON c.j > p.j WHERE p.k < {buckets} GROUP BY p.k, c.j)
),
total AS (SELECT k, j FROM prog WHERE j = (SELECT max(j) FROM cum) ORDER BY cost, k LIMIT 1),
back AS (
  SELECT k, j FROM total
  UNION ALL
  SELECT b.k - 1, p.cut FROM back b JOIN prog p ON p.k = b.k AND p.j = b.j WHERE b.k > 1
),
bounds AS (SELECT (row_number() OVER (ORDER BY c.bin) - 1)::INT AS bucket, c.bin AS pad_to FROM back b JOIN cum c ON c.j = b.j),
dealt AS (SELECT b.*, (SELECT min(u.bucket) FROM bounds u WHERE u.pad_to >= b.bin) AS bucket FROM binned b),
placed AS (
  SELECT d.*, u.pad_to, row_number() OVER (PARTITION BY d.bucket ORDER BY md5(coalesce(CAST({key} AS VARCHAR), '')), {key}) - 1 AS pos,
    greatest(1, {budget} // greatest(u.pad_to, 1)) AS per_batch
  FROM dealt d JOIN bounds u USING (bucket))
SELECT {extra}{key}, n_tokens, bucket, pad_to, pos // per_batch AS batch, pos % per_batch AS slot FROM placed"""
