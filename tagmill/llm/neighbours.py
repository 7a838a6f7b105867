"""Near-duplicate vectors by counting collisions of sorted one-dimensional projections."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.frames import components
from tagmill.session import materialize

PROJECTIONS, SPREAD = 24, 2.0
FIRST_SPREAD = 4.5


def _chance(spread: float) -> float:
    """How likely a normal value stays within ``spread`` standard deviations."""
    return math.erf(spread / math.sqrt(2))


def calibrated_count(recall: float) -> int:
    """The largest count of collisions that a pair at the threshold reaches with ``recall``."""
    p, miss = _chance(SPREAD), 0.0
    for k in range(PROJECTIONS + 1):
        miss += math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)
        if miss > 1 - recall:
            return k
    return PROJECTIONS


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).normal(size=(dim, PROJECTIONS + 1))


def _rows(batches):
    """All rows; usable vectors with their first projection and class, a hash of their values."""
    for batch in batches:
        ids, groups, keys, firsts, dims, values = [], [], [], [], [], []
        vectors = batch.column(2)
        flat = vectors.flatten()
        whole = np.array(flat.fill_null(np.nan).cast(pa.float64()).to_numpy(zero_copy_only=False))
        sizes = np.array(vectors.value_lengths().fill_null(0).to_pylist(), np.int64)
        ends = np.cumsum(sizes)
        for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
            x = whole[end - size : end]
            top = np.abs(x).max(initial=0)
            ids.append(batch.column(0)[i].as_py())
            groups.append(batch.column(1)[i].as_py())
            if ids[-1] is None or groups[-1] is None or not size or not np.isfinite(top) or top == 0:
                for column in (keys, firsts, dims, values):
                    column.append(None)
                continue
            unit = x / top
            unit = unit / np.sqrt(unit @ unit)
            dims.append(size)
            firsts.append(float(unit @ _held_directions(size)[:, 0]))
            data = unit.astype("<f8").tobytes()
            values.append(data)
            keys.append(hashlib.blake2b(data + str(groups[-1]).encode(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(groups, pa.string()), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(firsts, pa.float64()), pa.array(values, pa.binary())],
            names=["id", "label", "dim", "class", "first", "vec"],
        )


_directions_of: dict[int, np.ndarray] = {}


def _held_directions(dim: int) -> np.ndarray:
    if dim not in _directions_of:
        _directions_of[dim] = _directions(dim)
    return _directions_of[dim]


def _packed(size: int):
    """Neighbours in the order of the first projection, packed by up to ``size``."""

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        group, held = None, []

        def flush():
            nonlocal nth, held
            nth += 1
            row = {
                "block": [(part << 32) + nth],
                "label": [group[0]],
                "dim": [group[1]],
                "low": [held[0][1]],
                "high": [held[-1][1]],
                "ids": [np.array([h[0] for h in held], "<i8").tobytes()],
                "weights": [np.array([h[2] for h in held], "<i8").tobytes()],
                "vecs": [b"".join(h[3] for h in held)],
            }
            held = []
            kinds = pa.schema([("block", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()), ("weights", pa.binary()), ("vecs", pa.binary())])
            return pa.RecordBatch.from_pydict(row, schema=kinds)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("label", "dim", "id", "first", "n", "vec")]):
                if held and (row[:2] != group or len(held) == size):
                    yield flush()
                group = row[:2]
                held.append(row[2:])
        if held:
            yield flush()

    return run


def _collisions(x: np.ndarray, y: np.ndarray, width: float) -> np.ndarray:
    """How many projections of each y lie in the window around those of each x."""
    counts = np.zeros((len(x), len(y)), np.uint8)
    span = np.arange(len(x))
    for j in range(x.shape[1]):
        order = np.argsort(y[:, j])
        line = y[order, j]
        steps = np.zeros((len(x), len(y) + 1), np.int8)
        steps[span, np.searchsorted(line, x[:, j] - width, "left")] += 1
        steps[span, np.searchsorted(line, x[:, j] + width, "right")] -= 1
        counts[:, order] += np.cumsum(steps, axis=1, dtype=np.int8)[:, :-1].view(np.uint8)
    return counts


def _compared(cosine: float, count: int):
    """Links of two blocks: per vector the weight of its partners, and edges that keep its component."""
    width = SPREAD * math.sqrt(2 - 2 * cosine)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = [np.frombuffer(r[f"{s}_ids"], "<i8") for s in "xy"]
                weights = [np.frombuffer(r[f"{s}_weights"], "<i8") for s in "xy"]
                vecs = [np.frombuffer(r[f"{s}_vecs"], "<f8").reshape(len(i), -1) for s, i in zip("xy", ids)]
                lines = _held_directions(r["dim"])[:, 1:]
                found = _collisions(vecs[0] @ lines, vecs[1] @ lines, width) >= count
                same = r["x_block"] == r["y_block"]
                if same:
                    np.fill_diagonal(found, False)
                some = np.flatnonzero(found.any(axis=1))
                if len(some):
                    found[some] &= vecs[0][some] @ vecs[1].T >= cosine
                a, b = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
                if not len(a):
                    continue
                link = found[np.ix_(a, b)]
                left, right = ids[0][a].copy(), ids[1][b].copy()
                big = np.iinfo(np.int64).max
                while True:  # smallest id over links, back and forth
                    right2 = np.minimum(right, np.where(link, left[:, None], big).min(axis=0))
                    left2 = np.minimum(left, np.where(link, right2, big).min(axis=1))
                    if (left2 == left).all() and (right2 == right).all():
                        break
                    left, right = left2, right2
                out = [(ids[0][a], (link * weights[1][b]).sum(axis=1), left)]
                if not same:
                    out.append((ids[1][b], (link * weights[0][a][:, None]).sum(axis=0), right))
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "root"])

    return run


def _close_blocks(ranges: DataFrame, reach: float) -> DataFrame:
    """(dim, x_block, y_block), once a pair: blocks of one label whose ranges come within ``reach``.

    Ranges are cut into bins and joined on them, so blocks meet only where they are near;
    a pair that shares several bins counts in the first.  A block lies in at most some
    thousand bins, as projections of unit vectors lie between -1 and 1.
    """
    width = max(reach, 2.0**-9)

    def side(name, slack):
        low, high = (F.floor((F.col(c) + d) / width) for c, d in (("low", -slack), ("high", slack)))
        some = [F.col("block").alias(f"{name}_block"), (F.col("low") - slack).alias(f"{name}_from"), (F.col("high") + slack).alias(f"{name}_to")]
        return ranges.select("label", "dim", *some, low.alias(f"{name}_bin"), F.explode(F.sequence(low, high)).alias("bin"))

    met = side("x", 0.0).join(side("y", reach), ["label", "dim", "bin"])
    near = "x_block <= y_block and x_from <= y_to and y_from <= x_to and bin = greatest(x_bin, y_bin)"
    return met.where(near).select("dim", "x_block", "y_block")


def near_vectors(
    df: DataFrame, key: str, vector: str, label: str, cosine: float = 0.98, recall: float = 0.9999, block: int = 512
) -> DataFrame:
    """``(key, n_links, component)`` for every row: links to other vectors and the smallest key reachable.

    Vectors with equal, non-NULL labels and equal dimension link when their cosine, in
    double precision, reaches ``cosine``.  Vectors that are NULL, empty, zero, or hold
    NULL or non-finite components, and rows with a NULL key or label, link with nothing
    (a NULL key has a NULL component).  Vectors with equal directions are one class with
    a weight and are compared once.  Rows that repeat a key are vectors of their own, each
    with the result of its own class.

    Unit vectors are projected on random directions.  They are sorted by the first
    projection, per label, and packed into blocks of ``block``; only blocks whose ranges
    come within a window of each other are paired.  Within a pair of blocks each further
    projection is sorted and the collisions in a window around every vector are counted.
    Pairs with enough collisions are verified.  The window and the count are set so that
    a pair exactly at the threshold passes with probability ``recall``, closer ones more
    often.  Links are summed inside the task; what leaves it grows with the vectors of
    the block pair and not with the links.  A label's work is spread over its block
    pairs, each a task's worth of work, so one label may hold any share of the rows.
    """
    source = df.select(F.col(key).cast("long"), F.col(label).cast("string"), F.col(vector))
    rows = materialize(source.mapInArrow(_rows, "id long, label string, dim int, class binary, first double, vec binary"), "vectors")
    classes = rows.where("class is not null").groupBy("class").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = materialize(classes.withColumn("number", F.monotonically_increasing_id()), "classes")
    kept = rows.join(classes, ["class", "id"]).dropDuplicates(["class"]).select("label", "dim", F.col("number").alias("id"), "first", "n", "vec")
    kept = kept.repartitionByRange("label", "dim", "first", "id").sortWithinPartitions("label", "dim", "first", "id")
    blocks = materialize(
        kept.mapInArrow(_packed(block), "block long, label string, dim int, low double, high double, ids binary, weights binary, vecs binary"),
        "blocks",
    )
    reach = FIRST_SPREAD * math.sqrt(2 - 2 * cosine)
    pairs = _close_blocks(blocks.select("block", "label", "dim", "low", "high"), reach)
    body = lambda s: blocks.select(*[F.col(c).alias(f"{s}_{c}") for c in ("block", "ids", "weights", "vecs")])
    pairs = pairs.join(body("x"), "x_block").join(body("y"), "y_block")
    found = materialize(pairs.mapInArrow(_compared(cosine, calibrated_count(recall)), "id long, n long, root long"), "links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "roots")
    counts = found.groupBy("id").agg(F.sum("n").alias("links")).withColumnRenamed("id", "number")
    roots = roots.withColumnRenamed("node", "number")
    lows = roots.join(classes.select("number", "id"), "number").groupBy("root").agg(F.min("id").alias("low"))
    named = classes.join(counts, "number", "left").join(roots, "number", "left").join(lows, "root", "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("low", "id").alias("component")
    )
    linked = rows.where("class is not null").select("id", "class").join(named, "class").select("id", "n_links", "component")
    alone = rows.where("class is null").select("id", F.lit(0).alias("n_links"), F.col("id").alias("component"))
    return linked.unionAll(alone).select(F.col("id").alias(key), F.col("n_links").cast("long").alias("n_links"), "component")
