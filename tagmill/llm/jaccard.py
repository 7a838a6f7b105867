"""Near-duplicate texts by a rare-first prefix-filtered join on word n-grams."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.frames import components, matched
from tagmill.llm.textbytes import raw, row_hashes, shingles, words
from tagmill.session import materialize, small_batches

BLOCK = 1 << 14
# Bits of a signature: the parities of the shingle counts in so many ranges of the hash.
BITS = 1024
# Postings of one task, classes of one list compared with each other in a group, pairs looked at together.
TASK_POSTINGS, LIST_BLOCK, PAIRS = 2_000_000, 2048, 1 << 20
LIST_ROWS = 100_000
POSTING = np.dtype([("h", "<u8"), ("k", "<i8"), ("n", "<u4"), ("pos", "<u4")])
# Postings on their way: each class once, and its place in the others.
CLASS, PLACED = np.dtype([("k", "<i8"), ("n", "<u4")]), np.dtype([("h", "<u8"), ("place", "<u4"), ("pos", "<u4")])
SCAN = "id long, k long, k2 long, n int, sig binary, block int, salt int, cells binary"
HELD = 400_000


def _planes(rows: np.ndarray) -> bytes:
    """Rows byte by byte: first bytes, second ones and so on, as high bytes of sorted and small numbers are mostly alike."""
    return rows.view(np.uint8).reshape(-1, rows.itemsize).T.tobytes()


def _rows(flat: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _squeezed(postings: np.ndarray) -> bytes:
    """Postings compressed, with a table of their classes: a class posts many shingles and its hash does not compress."""
    keys, first, place = np.unique(postings["k"], return_index=True, return_inverse=True)
    table, body = np.empty(len(keys), CLASS), np.empty(len(postings), PLACED)
    table["k"], table["n"] = keys, postings["n"][first]
    body["h"], body["place"], body["pos"] = postings["h"], place, postings["pos"]
    packed = pa.Codec("zstd", 1).compress(_planes(table) + _planes(body), asbytes=True)
    return len(keys).to_bytes(4, "little") + packed


def _spread(blob: bytes, rows: int) -> np.ndarray:
    split = int.from_bytes(blob[:4], "little") * CLASS.itemsize
    flat = pa.Codec("zstd").decompress(blob[4:], split + rows * PLACED.itemsize, asbytes=True)
    table, body = _rows(flat[:split], CLASS), _rows(flat[split:], PLACED)
    out = np.empty(rows, POSTING)
    out["h"], out["pos"] = body["h"], body["pos"]
    out["k"], out["n"] = table["k"][body["place"]], table["n"][body["place"]]
    return out


def _released(batches):
    """The batches; then memory that the worker, which waits for other tasks, does not need goes back to the system."""
    yield from batches
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def _needed(na, nb, percent):
    """Shared shingles that two sets of these sizes need."""
    return -(-(percent * (na + nb)) // (100 + percent))


def _sets(column, size, seed):
    rows, _, _, hashes, _ = words(*raw(column))
    keys = row_hashes(rows, hashes, seed)
    return keys, np.diff(rows) > 0, shingles(rows, hashes, size)


def _slices(batches, rows=500):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _scan(batches, size, seed, cells):
    """Per row: two class hashes, set size and a signature; per task: counts of shingles by cell."""
    shift = np.uint64(64 - cells.bit_length() + 1)
    seen = np.zeros(cells, np.uint32)
    kind = pa.schema(
        [("id", pa.int64()), ("k", pa.int64()), ("k2", pa.int64()), ("n", pa.int32()), ("sig", pa.binary())]
        + [("block", pa.int32()), ("salt", pa.int32()), ("cells", pa.binary())]
    )
    for batch in _slices(batches):
        rows, _, _, hashes, _ = words(*raw(batch.column(1)))
        found = list(shingles(rows, hashes, size))
        n = len(found)
        if n and (flat := np.concatenate(found)).size:
            cell, times = np.unique(flat >> shift, return_counts=True)
            seen[cell.astype(np.int64)] += times.astype(np.uint32)
        signs = [np.packbits(np.bincount((x >> np.uint64(54)).astype(np.int64), minlength=BITS) & 1) for x in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array(row_hashes(rows, hashes, seed).view(np.int64)),
                pa.array(row_hashes(rows, hashes, seed + 1).view(np.int64)),
                pa.array(np.array([len(x) for x in found], np.int32)),
                pa.array([s.tobytes() for s in signs], pa.binary()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ],
            schema=kind,
        )
    used = [b for b in range(cells // BLOCK) if seen[b * BLOCK : (b + 1) * BLOCK].any()]
    packed = [zlib.compress(_planes(seen[b * BLOCK : (b + 1) * BLOCK]), 1) for b in used]
    m, salt = len(used), TaskContext.get().partitionId() % 64
    nothing = [pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())]
    counts = [pa.array(used, pa.int32()), pa.array([salt] * m, pa.int32()), pa.array(packed, pa.binary())]
    yield pa.RecordBatch.from_arrays(nothing + counts, schema=kind)


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.uint64)
    for cell in table.column("cells"):
        total += _rows(zlib.decompress(cell.as_py()), np.dtype(np.uint32))
    packed = zlib.compress(_planes(np.minimum(total, 2**32 - 1).astype(np.uint32)), 1)
    return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([packed], pa.binary())})


def shingle_counts(scan: DataFrame, cells: int) -> np.ndarray:
    """How many shingles of all documents fall in each cell: a fixed-size array."""
    blocks = scan.where("block is not null").select("block", "salt", "cells")
    kind = "block int, cells binary"
    blocks = blocks.groupBy("block", "salt").applyInArrow(_sum_blocks, kind).groupBy("block").applyInArrow(_sum_blocks, kind)
    counts = np.zeros(cells, np.uint32)
    for row in blocks.toLocalIterator():
        counts[row.block * BLOCK : (row.block + 1) * BLOCK] = _rows(zlib.decompress(row.cells), np.dtype(np.uint32))
    return counts


def _postings(batches, size, seed, percent, counts, buckets, heavy):
    """Each class's rarest shingles, packed by bucket of the shingle hash."""
    counts = counts.value
    shift = np.uint64(64 - len(counts).bit_length() + 1)

    def flush(parts):
        all_ = np.concatenate(parts)
        bucket = (all_["h"] % np.uint64(buckets)).astype(np.int32)
        hot = counts[(all_["h"] >> shift).astype(np.int64)] >= heavy
        bucket[hot] = buckets + (all_["k"][hot] % buckets).astype(np.int32)
        order = np.lexsort((all_["h"], bucket))
        all_, bucket = all_[order], bucket[order]
        ids, starts, sizes = np.unique(bucket, return_index=True, return_counts=True)
        blobs = [_squeezed(all_[a : a + m]) for a, m in zip(starts, sizes)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())],
            names=["bucket", "held", "postings"],
        )

    parts, held = [], 0
    for batch in _slices(batches):
        keys, full, sets = _sets(batch.column(0), size, seed)
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True
        for k, new, x in zip(keys.view(np.int64), first & full, sets):
            if not new:
                continue
            n = len(x)
            p = n - -(-percent * n // 100) + 1
            rare = x[np.argsort(counts[(x >> shift).astype(np.int64)], kind="stable")[:p]]
            post = np.empty(len(rare), POSTING)
            post["h"], post["k"], post["n"], post["pos"] = rare, k, n, np.arange(len(rare))
            parts.append(post)
            held += len(rare)
        if held >= HELD:
            yield flush(parts)
            parts, held = [], 0
    if parts:
        yield flush(parts)


def _shared(buckets, percent):
    def run(table: pa.Table) -> pa.Table:
        """Each posting once that shares its shingle with a class of a fitting size."""
        packed = zip(table.column("postings"), table.column("held"))
        all_ = np.concatenate([_spread(blob.as_py(), held.as_py()) for blob, held in packed])
        all_ = all_[np.lexsort((all_["k"], all_["n"], all_["h"]))]
        new = np.ones(len(all_), bool)
        new[1:] = (all_["h"][1:] != all_["h"][:-1]) | (all_["k"][1:] != all_["k"][:-1])
        all_ = all_[new]
        if table.column("bucket")[0].as_py() < buckets:
            same = (all_["h"][1:] == all_["h"][:-1]) & (100 * all_["n"][:-1].astype(np.int64) >= percent * all_["n"][1:])
            keep = np.zeros(len(all_), bool)
            keep[1:] |= same
            keep[:-1] |= same
            all_ = all_[keep]
        return pa.table(
            {
                "h": pa.array(all_["h"].astype(np.int64)),
                "k": pa.array(all_["k"].astype(np.int64)),
                "n": pa.array(all_["n"].astype(np.int32)),
                "pos": pa.array(all_["pos"].astype(np.int32)),
            }
        )

    return run


def _signs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles two sets have not in common, at least: parities that differ."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _suffix(percent):
    """Pairs whose sets may be close enough: the parities of their counts in hash ranges
    bound the size of the symmetric difference from below."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("na", "nb"))
            near = _apart(_signs(batch.column("sa")), _signs(batch.column("sb"))) <= na + nb - 2 * _needed(na, nb, percent)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _met(percent):
    """Pairs of classes that meet in the lists of a task and pass all filters, a row for a list and pair."""

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("g", "side", "k", "n", "pos", "before", "root")}
        order = np.lexsort((col["k"], col["g"]))
        g, side, k, n, pos, before, root = (col[c][order].astype(np.int64) for c in ("g", "side", "k", "n", "pos", "before", "root"))
        signs = _signs(table.column("sig"))[order]
        parts, left = [], np.arange(len(g))
        for step in range(1, len(g)):
            left = left[left + step < len(g)]
            left = left[g[left] == g[left + step]]
            if not len(left):
                break
            for at in range(0, len(left), PAIRS):
                x = left[at : at + PAIRS]
                y = x + step
                fits = ((side[x] < 0) | (side[x] != side[y])) & (k[x] != k[y]) & (root[x] != root[y])
                need = _needed(n[x], n[y], percent)
                fits &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
                fits &= np.minimum(before[x], before[y]) + np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
                x, y, need = x[fits], y[fits], need[fits]
                near = _apart(signs[x], signs[y]) <= n[x] + n[y] - 2 * need
                x, y = x[near], y[near]
                high = np.where(k[x] > k[y], x, y)
                low = x + y - high
                parts.append(np.stack([c[i] for c in (k, root, pos, n) for i in (high, low)]))
        found = np.concatenate(parts, axis=1) if parts else np.zeros((8, 0), np.int64)
        return pa.table([pa.array(c) for c in found], names=["a", "b", "ra", "rb", "pa", "pb", "na", "nb"])

    return run


def _keyed(size, seed):
    def run(batches):
        for batch in _slices(batches):
            rows, _, _, hashes, _ = words(*raw(batch.column(0)))
            keys = pa.array(row_hashes(rows, hashes, seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, batch.column(0)], names=["k", "text"])

    return run


def _verified(size, seed, percent):
    def run(batches):
        for batch in _slices(batches, 500):
            left, right = (_sets(batch.column(c), size, seed)[2] for c in ("ta", "tb"))
            keep = []
            for x, y in zip(left, right):
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                keep.append(int((both[1:] == both[:-1]).sum()) >= _needed(len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _meeting(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet in the open lists; a long list is cut into blocks, and each pair of blocks compared by itself."""
    long = materialize(open_.groupBy("h").count().where(f"count > {LIST_BLOCK}"), "long-lists")
    total = open_.count()
    none = F.lit(0).cast("long")
    dealt = open_.withColumns({"i": none, "j": none, "side": F.lit(-1)})
    if not long.isEmpty():
        blocks = F.coalesce(F.ceil(F.col("count") / LIST_BLOCK), F.lit(1))
        dealt = open_.join(long, "h", "left").withColumn("own", F.pmod(F.xxhash64("k"), blocks))
        dealt = dealt.withColumn("other", F.explode(F.sequence(none, blocks - 1)))
        side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
        dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": side})
        total += long.agg(F.sum(F.col("count") * F.ceil(F.col("count") / LIST_BLOCK))).first()[0]
    dealt = dealt.select(F.xxhash64("h", "i", "j").alias("g"), "side", "k", "n", "pos", "before", "root", "sig")
    part = F.pmod("g", F.lit(max(1, total // LIST_ROWS))).alias("part")
    kind = ", ".join(f"{c} long" for c in ("a", "b", "ra", "rb", "pa", "pb", "na", "nb"))
    return dealt.groupBy(part).applyInArrow(_met(percent), kind)


def ngram_jaccard(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    cells: int = 1 << 22,
    buckets: int | None = None,
    heavy: int = 200_000,
    rounds: int = 2,
) -> DataFrame:
    """``(key, n_shingles, component)`` for every row: near-duplicates share a component.

    A text's set holds its distinct ``size``-word shingles, A-Z read as a-z; fewer
    words give one shingle of all.  Two rows link when the sets' Jaccard similarity
    reaches ``percent`` hundredths; ``component`` is the smallest key reachable by
    links.  NULL and empty texts, or texts of white space, have no shingles and are
    alone.  Keys are whole numbers; rows with a NULL key link with nothing and get a
    NULL component; rows that repeat a key are judged each by its own text.

    1. Texts with the same word sequence form a class; only classes are joined.
    2. A count of all shingles in ``cells`` cells, an array of fixed size, orders
       shingles rare first; any fixed order gives exact results.
    3. Each class posts the first shingles of its order, just so many that two classes
       similar enough must share one.  Postings travel packed by hash bucket, in as many buckets as their count asks for, and those
       without a second class of a fitting size in their list are dropped.  Shingles in cells counted ``heavy`` times or more
       are dealt by class instead, so no bucket gathers a very long list.
    4. In a few ``rounds``, fewer if no list is left open, every class is compared with one class of each of its lists, the
       one with fewest shingles of its own, which others are likely copies of.  The number
       of pairs is linear in the lists, and lists whose classes are all linked are done.  Then all pairs of classes follow that share a posting and are
       not linked yet, those first that share most.  Length, positional and suffix filters run inside the tasks that
       hold the lists, so only pairs that pass them become rows; each is verified once.
       Components are carried from step to step, and a step without pairs starts no joins:
       plans and threads are what fills the driver's memory.

    Shingles are 64-bit hashes; two classes with equal hashes are told apart by a second
    hash, and the first is drawn anew if that happens.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    seed = 1
    while True:
        with small_batches(spark):
            scan = materialize(docs.mapInArrow(lambda it, s=seed: _released(_scan(it, size, s, cells)), SCAN), "scan")
        rows = scan.where("block is null")
        classes = rows.where("n > 0 and id is not null").groupBy("k").agg(F.min("id").alias("id"), F.min("k2").alias("k2"), F.max("k2").alias("k3"))
        if not classes.where("k2 <> k3").limit(1).count():
            break
        seed += 2
    classes = classes.select("k", "id")
    if buckets is None:
        postings = rows.agg(F.sum(F.expr(f"n - (n * {percent}L + 99) div 100 + 1"))).first()[0] or 0
        buckets = max(64, postings // TASK_POSTINGS)
    sent = spark.sparkContext.broadcast(shingle_counts(scan, cells))
    lists = docs.where("id is not null").select("text").mapInArrow(
        lambda it: _released(_postings(it, size, seed, percent, sent, buckets, heavy)), "bucket int, held int, postings binary"
    )
    lists = lists.groupBy("bucket").applyInArrow(_shared(buckets, percent), "h long, k long, n int, pos int")
    # before: a class's earlier postings that some other class has; the rest cannot be shared.
    # lost: how many of its postings no other class has; it is small for a text that others are copies of.
    earlier, whole = Window.partitionBy("k").orderBy("pos"), Window.partitionBy("k")
    posted = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    lists = lists.withColumn("before", F.row_number().over(earlier) - 1)
    with small_batches(spark):
        lists = materialize(lists.withColumn("lost", (posted - F.count("*").over(whole)).cast("int")), "lists")
    signed = materialize(
        rows.join(classes, ["k", "id"], "left_semi").select("k", "id", "n", "sig").dropDuplicates(["k"]), "signed"
    )

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that pass the length and the suffix filter."""
        side = lambda s: signed.select(F.col("k").alias(s), F.col("n").alias(f"n{s}"), F.col("sig").alias(f"s{s}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.where(f"100L * least(na, nb) >= {percent}L * greatest(na, nb)").select("a", "b", "na", "nb", "sa", "sb")
        return both.mapInArrow(_suffix(percent), "a long, b long")

    def linked(pairs: DataFrame) -> DataFrame:
        """The materialized pairs whose texts are similar enough; none need no reading of texts."""
        if pairs.isEmpty():
            return pairs.select("a", "b")
        members = pairs.select(F.col("a").alias("k")).unionAll(pairs.select(F.col("b").alias("k"))).distinct()
        ids = materialize(signed.join(members, "k", "left_semi").select("id"), "members")
        texts = matched(docs, ids, "id").select("text").mapInArrow(lambda it: _released(_keyed(size, seed)(it)), "k long, text string")
        with small_batches(spark):
            texts = materialize(texts.dropDuplicates(["k"]), "texts")
        sides = pairs.join(texts.select(F.col("k").alias("a"), F.col("text").alias("ta")), "a")
        sides = sides.join(texts.select(F.col("k").alias("b"), F.col("text").alias("tb")), "b")
        found = sides.select("a", "b", "ta", "tb").mapInArrow(lambda it: _released(_verified(size, seed, percent)(it)), "a long, b long")
        with small_batches(spark):
            return materialize(found, "links")

    open_, stars, known = lists.withColumn("root", F.col("k")), None, None
    for turn in range(rounds):
        rank = F.struct("lost", F.xxhash64("k", F.lit(turn)))
        centre = open_.groupBy("h").agg(*[F.min_by(c, rank).alias(f"c{c}") for c in ("k", "n", "root")])
        rays = open_.join(centre, "h").where(f"root <> croot and 100L * least(n, cn) >= {percent}L * greatest(n, cn)")
        rays = rays.select(F.greatest("k", "ck").alias("a"), F.least("k", "ck").alias("b")).distinct()
        rays = materialize(close(rays if stars is None else rays.join(stars, ["a", "b"], "left_anti")), "stars")
        stars = rays if stars is None else stars.unionAll(rays)
        known = components(linked(rays), "known", known)
        placed = lists.join(known.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
        mixed = placed.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("h")
        open_ = materialize(placed.join(mixed, "h", "left_semi"), "open")
        if open_.isEmpty():
            break
    pairs = _meeting(open_.join(signed.select("k", "sig"), "k"), percent).groupBy("a", "b").agg(
        *[F.first(c).alias(c) for c in ("ra", "rb", "na", "nb")], F.count("*").alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb")
    )
    # All that both have up to the last shared posting is counted; the rest cannot exceed the shorter tail.
    pairs = pairs.where(f"c + least(na - pa, nb - pb) - 1 >= ceil({percent}L * (na + nb) / {100 + percent})")
    pairs = pairs.join(stars, ["a", "b"], "left_anti").select("a", "b", "ra", "rb", "c")
    # Of a class and a component, the pairs that share most come first; one link between them will do.
    nth = [F.row_number().over(Window.partitionBy(*w).orderBy(F.desc("c"), *w[::2], "a", "b")) for w in (("a", "rb"), ("b", "ra"))]
    pairs = materialize(pairs.withColumn("nth", F.greatest(*nth)), "pairs")
    first, rest = (pairs.where(nth).select("a", "b") for nth in ("nth <= 4", "nth > 4"))
    if not first.isEmpty():
        known = components(linked(materialize(close(first), "first")), "known", known)
    if not rest.isEmpty():
        for side in ("a", "b"):
            rest = rest.join(known.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
        rest = rest.where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
        known = components(linked(materialize(close(rest), "rest")), "roots", known)
    classes = classes.join(known.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    least = classes.groupBy("root").agg(F.min("id").alias("component"))
    named = classes.join(least, "root").select("k", "component")
    return (
        rows.join(named, "k", "left")
        .select(
            F.col("id").alias(key),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component"),
        )
    )
