"""Fingerprints of texts by signed votes of their weighted words, and all near ones by block tables."""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.frames import SENT_ROWS, components
from tagmill.llm.textbytes import mix, raw, words
from tagmill.session import materialize

BITS = 128
# Rows of text and terms that are worked on together inside a task.
ROWS, TERMS = 500, 1 << 15
# Fingerprints compared with each other in one group, and rows of the tables in one task.
BLOCK, TASK_ROWS = 512, 200_000
PAIRS = 1 << 21
_LANES = np.array([1, 0x632BE59BD9B4E019], np.uint64)
EDITED = (
    "part int, place int, id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, text string"
)


def signed_votes(texts: pa.Array, bits: int = BITS) -> np.ndarray:
    """A fingerprint of ``bits`` bits for each text, as rows of bytes.

    Words are runs without ASCII white space, A-Z read as a-z.  A word that occurs c
    times weighs 1 + floor(log2 c); each bit of its hash votes that weight for or against.
    A bit is set when the votes for it prevail, so a text without words has none.
    """
    rows, _, _, hashes, _ = words(*raw(texts))
    sums = np.zeros((len(rows) - 1, bits), np.int64)
    held, weights, owner = [], [], []
    waiting = 0

    def add():
        terms, row = np.concatenate(held), np.concatenate(owner)
        weight = np.concatenate(weights)
        lanes = _LANES[:, None] * mix(terms)[None, :] if bits == 128 else mix(terms)[None, :]
        votes = np.unpackbits(np.ascontiguousarray(mix(lanes).T).view(np.uint8), axis=1)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        sums[row[first]] += 2 * np.add.reduceat(votes * weight[:, None], first, axis=0, dtype=np.int64)
        sums[row[first]] -= np.add.reduceat(weight, first, dtype=np.int64)[:, None]

    for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
        if a == b:
            continue
        terms, times = np.unique(hashes[a:b], return_counts=True)
        weight = (np.frexp(times)[1]).astype(np.uint8)
        for at in range(0, len(terms), TERMS):
            held.append(terms[at : at + TERMS])
            weights.append(weight[at : at + TERMS])
            owner.append(np.full(len(held[-1]), i))
            waiting += len(held[-1])
            if waiting >= TERMS:
                add()
                held, weights, owner, waiting = [], [], [], 0
    if waiting:
        add()
    return np.packbits(sums > 0, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits of two lists of fingerprints, row by row."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / (8.0 * a.shape[1])


def _hexes(prints: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in prints], pa.string())


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids, texts, following, prints, next_prints, part, place=0):
    """Rows of ``EDITED`` for texts whose following text is known."""
    edited = [edited_text(a, b) for a, b in zip(texts, following)]
    edits = signed_votes(pa.array(edited, pa.large_string()))
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * n, pa.int32()),
            pa.array([place] * n, pa.int32()),
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            _hexes(prints),
            _hexes(edits),
            pa.array(likeness(prints, edits)),
            pa.array(likeness(prints, next_prints)),
            pa.nulls(n, pa.string()),
        ],
        names=[f.split()[0] for f in EDITED.split(", ")],
    )


def _edge(part, place, key, text):
    """The first (1) or last (2) row of a partition, which wait for a neighbour."""
    names = [f.split()[0] for f in EDITED.split(", ")]
    known = {"part": (part, pa.int32()), "place": (place, pa.int32()), "id": (key, pa.int64()), "text": (text, pa.string())}
    kinds = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    cells = [pa.array([known[n][0]], known[n][1]) if n in known else pa.nulls(1, kinds.get(n, pa.string())) for n in names]
    return pa.RecordBatch.from_arrays(cells, names=names)


def _in_order(batches):
    """Rows of a sorted partition against the row after each; the last row is handed on."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            ids, texts = piece.column(0).to_pylist(), [t or "" for t in piece.column(1).to_pylist()]
            prints = signed_votes(pa.array(texts, pa.large_string()))
            if before is None:
                yield _edge(part, 1, ids[0], texts[0])
            else:
                ids, texts = [before[0], *ids], [before[1], *texts]
                prints = np.concatenate([before[2], prints])
            if len(texts) > 1:
                yield _compared(ids[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:], part)
            before = ids[-1], texts[-1], prints[-1:]
    if before is not None:
        yield _edge(part, 2, before[0], before[1])


def _across(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            ids, texts, after = (batch.column(c).slice(at, ROWS).to_pylist() for c in range(3))
            prints, later = (signed_votes(pa.array(t, pa.large_string())) for t in (texts, after))
            yield _compared(ids, texts, after, prints, later, -1)


def edited_prints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the following row.

    Rows are ordered by ``key``, NULL first; rows that repeat a key by a hash of their
    text, equal rows in any order.  The edited text is ``edited_text`` of the row and the
    next one; the first row follows the last, a single row follows itself.  A NULL text
    is an empty one; an empty table gives an empty result.

    Texts are shuffled once, by ranges.  Inside a partition each row meets the next one;
    the last of a partition is kept with its text and meets the first of the next
    partition in a join of one row a partition.  Returns the columns of ``EDITED``
    without part, place and text; ``key`` is ``id``.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    order = ["id", "_h", "_tie"]
    rows = rows.withColumn("_h", F.xxhash64("text")).withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    found = materialize(rows.mapInArrow(_in_order, EDITED), "edited")
    # One row a partition of the range shuffle: their number is a setting, not data.
    parts = found.where("place = 1").select("part")
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    last = found.where("place = 2").select("part", "id", "text").join(F.broadcast(parts.select("part", following.alias("next"))), "part")
    first = found.where("place = 1").select(F.col("part").alias("next"), F.col("text").alias("after"))
    edges = last.join(first, "next").select("id", "text", "after").mapInArrow(_across, EDITED)
    return found.where("place = 0").unionAll(edges).drop("part", "place", "text")


def block_tables(bits: int, radius: int, n: int) -> list[int]:
    """Masks of the permuted tables for ``n`` fingerprints.

    Cut into b blocks, two fingerprints within ``radius`` bits agree on b - radius blocks
    at least, so a table for each choice of so many blocks finds every such pair.  More
    blocks give more selective tables; b is the least that leaves few chance meetings.
    """
    for blocks in range(radius + 1, radius + 4):
        cuts = [bits * i // blocks for i in range(blocks + 1)]
        whole = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
        chosen = [sum(c) for c in combinations(whole, blocks - radius)]
        if n >> min(m.bit_count() for m in chosen) < 64:
            break
    return chosen


def _halves(masks: list[int]) -> np.ndarray:
    return np.array([[m >> 64, m & (1 << 64) - 1] for m in masks], np.uint64)


def _keyed(masks):
    """A row for each fingerprint and table: the hash of the masked bits."""
    masks = _halves(masks)

    def run(batches):
        for batch in batches:
            c = batch.column(0)
            flat = bytes.fromhex("".join(batch.column(1).to_pylist()))
            prints = np.frombuffer(flat, ">u8").reshape(-1, 2).astype(np.uint64)
            for t, mask in enumerate(masks):
                part = prints & mask
                k = mix(mix(part[:, 0] + np.uint64(t)) ^ part[:, 1] + np.uint64(1))
                cells = [pa.array(x.view(np.int64)) for x in (k, prints[:, 0].copy(), prints[:, 1].copy())]
                table = pa.array(np.full(len(k), t, np.int32))
                yield pa.RecordBatch.from_arrays([table, cells[0], c, cells[1], cells[2]], names=["t", "k", "c", "hi", "lo"])

    return run


def _near(masks, radius):
    """Links inside the groups of a task: how many each fingerprint has, and its least partner reachable."""
    masks = _halves(masks)

    def run(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("g", "side", "t", "c", "hi", "lo")}
        order = np.lexsort((col["c"], col["g"]))
        g, side, t, c = (col[n][order] for n in ("g", "side", "t", "c"))
        prints = np.stack([col["hi"][order], col["lo"][order]], axis=1).view(np.uint64)
        n = len(g)
        count, root = np.zeros(n, np.int64), np.arange(n)

        def join(a, b):
            while len(a):
                x, y = root[a], root[b]
                low = np.minimum(x, y)
                np.minimum.at(root, x, low)
                np.minimum.at(root, y, low)
                while (root[root] != root).any():
                    root[:] = root[root]
                open_ = root[a] != root[b]
                a, b = a[open_], b[open_]

        left = np.arange(n)
        for step in range(1, n):
            left = left[left + step < n]
            left = left[g[left] == g[left + step]]
            if not len(left):
                break
            for at in range(0, len(left), PAIRS):
                a = left[at : at + PAIRS]
                b = a + step
                fits = (side[a] < 0) | (side[a] != side[b])
                apart = prints[a] ^ prints[b]
                fits &= np.bitwise_count(apart).sum(axis=1) <= radius
                a, b, apart = a[fits], b[fits], apart[fits]
                first = np.full(len(a), len(masks))
                for i in range(len(masks) - 1, -1, -1):
                    first[((apart & masks[i]) == 0).all(axis=1)] = i
                mine = first == t[a]
                a, b = a[mine], b[mine]
                np.add.at(count, a, 1)
                np.add.at(count, b, 1)
                join(a, b)
        linked = count > 0
        return pa.table({"c": pa.array(c[linked]), "links": pa.array(count[linked]), "root": pa.array(c[root[linked]])})

    return run


def near_classes(rows: DataFrame, radius: int) -> DataFrame:
    """``(fp, class_id, n_links, component)`` for every fingerprint of ``rows`` (id, fp)."""
    classes = rows.where("id is not null and fp is not null").groupBy("fp").agg(F.min("id").alias("c"))
    classes = materialize(classes, "prints")
    n = classes.count()
    masks = block_tables(BITS, radius, n)
    tables = classes.select("c", "fp").mapInArrow(_keyed(masks), "t int, k long, c long, hi long, lo long")
    hot = materialize(tables.groupBy("k").count().where(f"count > {BLOCK}"), "hot-keys")
    keys, repeated = hot.agg(F.count("*"), F.sum(F.col("count") * F.ceil(F.col("count") / BLOCK))).first()
    none = F.lit(0).cast("long")
    grouped = tables.withColumns({"i": none, "j": none, "side": F.lit(-1)})
    if keys:
        blocks = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1))
        own = F.pmod(F.xxhash64("c"), blocks)
        dealt = tables.join(F.broadcast(hot) if keys <= SENT_ROWS else hot, "k", "left")
        dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(none, blocks - 1)))
        side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
        grouped = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": side})
    buckets = max(1, (len(masks) * n + int(repeated or 0)) // TASK_ROWS)
    grouped = grouped.select("t", "c", "hi", "lo", "side", F.xxhash64("k", "i", "j").alias("g"))
    found = grouped.groupBy(F.pmod("g", F.lit(buckets)).alias("bucket")).applyInArrow(_near(masks, radius), "c long, links long, root long")
    found = materialize(found, "near")
    counts = found.groupBy("c").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")), "near-edges").withColumnRenamed("node", "c")
    named = classes.join(counts, "c", "left").join(roots, "c", "left")
    links = F.coalesce("n_links", F.lit(0)).alias("n_links")
    return named.select("fp", F.col("c").alias("class_id"), links, F.coalesce("root", "c").alias("component"))


def near_prints(df: DataFrame, key: str = "doc_id", fingerprint: str = "fingerprint", radius: int = 6) -> DataFrame:
    """All columns of ``df`` and ``class_id``, ``n_links``, ``component`` (replaced if there): rows with near fingerprints.

    ``fingerprint`` holds 128 bits as 32 hex digits; keys are whole numbers.  Rows with
    equal fingerprints are a class, named by its smallest key; two classes link when their
    fingerprints differ in at most ``radius`` bits, and no such pair is missed.
    ``n_links`` counts the other classes a class links with, ``component`` is the smallest
    key reachable by links.  Rows without a key or a fingerprint get NULLs; an empty table
    gives an empty result.

    Each class is a row of every block table, and classes that share a table's key are
    compared in a task; a pair counts in the first table it shares.  Keys are dealt to
    tasks by hash.  A key with more than ``BLOCK`` classes is cut into blocks and each
    pair of blocks is compared by itself.  Only counts and one edge a class leave a task.
    """
    added = ["class_id", "n_links", "component"]
    rows = df.drop(*added)
    near = near_classes(rows.select(F.col(key).cast("long").alias("id"), F.col(fingerprint).alias("fp")), radius)
    near = near.withColumnRenamed("fp", "_fp")
    match = (F.col(fingerprint) == F.col("_fp")) & F.col(key).isNotNull()
    return rows.join(near, match, "left").select(*rows.columns, *added)


def document_prints(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 6) -> DataFrame:
    """``edited_prints`` of all rows with the classes, links and components of their fingerprints."""
    found = materialize(edited_prints(df, key, text), "documents")
    return near_prints(found, "id", "fingerprint", radius).withColumnRenamed("id", key)
