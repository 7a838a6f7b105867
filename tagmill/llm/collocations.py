"""Phrases that occur together: pairs of ranked ids counted in direct-address tiles, level by level."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagmill.llm.textbytes import mix, raw, words
from tagmill.session import materialize

# Most frequent items of a level that get a rank; sent to all tasks, 16 bytes each.
RANKED = 1 << 20
# Side of a tile, and tiles in a row that are looked at for being dense.
TILE, DENSE = 1 << 10, 4
# Bytes of text worked on together, pairs a task holds before it passes them on, pairs of one reducing task.
# Measured on made-up words, a task allocates 16 bytes for each byte of the first and 57 for each pair of the second.
STEP, HELD, TASK_PAIRS = 1 << 22, 1 << 21, 1 << 22
# Distinct words of a slice passed on in a batch.
ENTRIES = 1 << 14
# Rows of a slice and language: one with the keys of its words and the sequence, and one for each word.
CHUNKS = pa.schema(
    [("lang", pa.string()), ("keys", pa.list_(pa.int64())), ("size", pa.int64()), ("sequence", pa.binary())]
    + [("k", pa.int64()), ("word", pa.string()), ("times", pa.int64())]
)

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_ENDS = _BREAKS.copy()
_ENDS[[32, 9]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Ids: a rank below 2**32, or the 63-bit key of an unranked item with the top bit set.
_HIGH, _NONE = np.uint64(1 << 63), np.uint64((1 << 64) - 1)
_ROW = np.dtype([("x", "<u8"), ("y", "<u8"), ("n", "<u8")])


def _squeezed(rows: np.ndarray) -> bytes:
    """Sorted rows as compressed byte planes, which are mostly alike."""
    planes = rows.view(np.uint8).reshape(-1, _ROW.itemsize).T
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _spread(blob: bytes, n: int) -> np.ndarray:
    flat = pa.Codec("zstd").decompress(blob, n * _ROW.itemsize, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(_ROW.itemsize, n).T).view(_ROW).ravel()


def _pieces(batch):
    """Slices of a batch of about ``STEP`` bytes of text, one row at least."""
    sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)])
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STEP, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _numbered(batches):
    """Texts as numbers: per language of a slice its distinct words, their counts and the sequence.

    A word is the number of its place in ``keys`` plus one, negative where a piece starts.  Words are rows of
    their own: as arrays of one row they take the JVM many times their size of heap, which it does not give back.
    """
    for batch in batches:
        for piece in _pieces(batch):
            yield from _encoded(piece)


def _encoded(piece: pa.RecordBatch) -> list[pa.RecordBatch]:
    """A batch for each language of a slice; its work arrays are gone before the batches are passed on."""
    langs = piece.column(0).dictionary_encode()
    data, offsets = raw(piece.column(1))
    rows, starts, ends, hashes, _ = words(data, offsets, separators=_ENDS)
    if not len(starts):
        return []
    breaks = np.flatnonzero(_BREAKS[data])
    first = np.ones(len(starts), bool)
    first[1:] = np.searchsorted(breaks, starts[1:]) != np.searchsorted(breaks, ends[:-1])
    first[rows[:-1][rows[:-1] < len(starts)]] = True
    hashes >>= np.uint64(1)
    code = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(rows))
    out = []
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        mine = np.flatnonzero(code == i)
        if not len(mine):
            continue
        key, where, place, times = np.unique(hashes[mine], return_index=True, return_inverse=True, return_counts=True)
        sequence = (place + 1).astype(np.int32) * np.where(first[mine], -1, 1).astype(np.int32)
        blob = pa.Codec("zstd", 1).compress(sequence.tobytes(), asbytes=True)
        del place
        row = [pa.array([lang], pa.string()), pa.array([key.view(np.int64)], pa.list_(pa.int64())), pa.array([len(sequence)]), pa.array([blob], pa.binary())]
        out.append(pa.RecordBatch.from_arrays(row + [pa.nulls(1, c.type) for c in CHUNKS][4:], schema=CHUNKS))
        for at in range(0, len(key), ENTRIES):
            some = slice(at, at + ENTRIES)
            texts = [data[starts[m] : ends[m]].tobytes().translate(_LOWER).decode() for m in mine[where[some]]]
            cells = [pa.array(key[some].view(np.int64)), pa.array(texts, pa.string()), pa.array(times[some])]
            nothing = [pa.nulls(len(texts), c.type) for c in CHUNKS][1:4]
            out.append(pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(texts)), *nothing, *cells], schema=CHUNKS))
    return out


class Ranks:
    """The most frequent items of a level, by language: their keys in order and their ranks."""

    def __init__(self, table: pa.Table, complete: bool):
        self.complete = complete
        langs, keys = table.column("lang").to_numpy(zero_copy_only=False), table.column("k").to_numpy().view(np.uint64)
        self.keys, self.sorted, self.rank = {}, {}, {}
        for lang in dict.fromkeys(langs):
            mine = keys[langs == lang]
            order = np.argsort(mine)
            self.keys[lang], self.sorted[lang], self.rank[lang] = mine, mine[order], order.astype(np.uint64)

    def ids(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Ids of keys: ranks, and for others the key itself, or none if all frequent items are ranked."""
        out = np.full(len(keys), _NONE) if self.complete else keys | _HIGH
        if lang in self.sorted:
            at = np.minimum(np.searchsorted(self.sorted[lang], keys), len(self.sorted[lang]) - 1)
            known = self.sorted[lang][at] == keys
            out[known] = self.rank[lang][at[known]]
        return out

    def key_of(self, lang: str, ids: np.ndarray) -> np.ndarray:
        ranked = ids < _HIGH
        out = ids & ~_HIGH
        if ranked.any():
            out[ranked] = self.keys[lang][ids[ranked].astype(np.int64)]
        return out


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The key of two items in a row."""
    return mix(mix(x + np.uint64(0x9E3779B97F4A7C15)) ^ (y * np.uint64(0xD6E8FEB86659FD93))) >> np.uint64(1)


def summed(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
    """Distinct pairs of ids with their counts, as rows of ``_ROW``.

    Pairs of low ranks lie in tiles of a square; a tile with many pairs is counted in an
    array with a cell for each pair, all others by sorting them.
    """
    parts = []
    low = (x < TILE * DENSE) & (y < TILE * DENSE)
    left = np.ones(len(x), bool)
    if low.any():
        tile = np.full(len(x), -1, np.int32)
        tile[low] = (x[low] // TILE).astype(np.int32) * DENSE + (y[low] // TILE).astype(np.int32)
        for t in np.flatnonzero(np.bincount(tile[low], minlength=DENSE * DENSE) >= TILE * TILE // 16):
            mine = tile == t
            cell = ((x[mine] % TILE) * TILE + y[mine] % TILE).astype(np.int64)
            if n is None:
                cells = np.bincount(cell, minlength=TILE * TILE)
            else:
                cells = np.zeros(TILE * TILE, np.int64)
                np.add.at(cells, cell, n[mine].astype(np.int64))
            at = np.flatnonzero(cells)
            part = np.empty(len(at), _ROW)
            part["x"], part["y"], part["n"] = at // TILE + t // DENSE * TILE, at % TILE + t % DENSE * TILE, cells[at]
            parts.append(part)
            left &= ~mine
        del tile
    x, y = x[left], y[left]
    if len(x):
        ranked = max(int(x.max()), int(y.max())) < 1 << 32
        if ranked and n is None:
            both = (x << np.uint64(32)) | y
            del x, y
            both.sort()
            at = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            sums = np.diff(at, append=len(both))
            x, y = both[at] >> np.uint64(32), both[at] & np.uint64((1 << 32) - 1)
        else:
            order = np.argsort((x << np.uint64(32)) | y, kind="stable") if ranked else np.lexsort((y, x))
            x, y = x[order], y[order]
            at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            sums = np.diff(at, append=len(x)) if n is None else np.add.reduceat(n[left][order], at)
            x, y = x[at], y[at]
        part = np.empty(len(at), _ROW)
        part["x"], part["y"], part["n"] = x, y, sums
        parts.append(part)
    return np.concatenate(parts) if parts else np.zeros(0, _ROW)


def _sequence(blob: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a slice from 0, and where pieces start."""
    flat = np.frombuffer(pa.Codec("zstd").decompress(blob, size * 4, asbytes=True), np.int32)
    return np.abs(flat) - 1, flat < 0


def _neighbours(lang, keys, sequence, size, levels):
    """Ids of both items of every pair of the last level in a row, where both count."""
    place, first = _sequence(sequence, size)
    ids = levels[0].ids(lang, keys)[place]
    for depth in range(len(levels)):
        if depth:
            known = np.flatnonzero((ids[:-1] != _NONE) & (ids[1:] != _NONE) & ~first[1:])
            x, y = (levels[depth - 1].key_of(lang, ids[i]) for i in (known, known + 1))
            longer = np.full(max(0, len(ids) - 1), _NONE)
            longer[known] = levels[depth].ids(lang, joined(x, y))
            # An item of two overlapping ones spans the place where the second starts.
            ids, first = longer, first[1:]
    return_ = np.flatnonzero((ids[:-1] != _NONE) & (ids[1:] != _NONE) & ~first[1:])
    return ids[return_], ids[return_ + 1]


def _paired(sent, buckets):
    """Counted pairs of a task by bucket: every pair of a language is in one row of each flush at most."""

    def flush(held):
        names = ["bucket", "lang", "rows", "pairs"]
        while held:
            lang, parts = held.popitem()
            x, y = (np.concatenate(p) for p in zip(*parts))
            del parts
            found = summed(x, y)
            del x, y
            bucket = (mix(found["x"] * np.uint64(3) ^ mix(found["y"])) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((found["y"], found["x"], bucket))
            found, bucket = found[order], bucket[order]
            at, starts, sizes = np.unique(bucket, return_index=True, return_counts=True)
            blobs = [_squeezed(found[a : a + m]) for a, m in zip(starts, sizes)]
            cells = [pa.array(at, pa.int32()), pa.array([lang] * len(at), pa.string()), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=names)

    def run(batches):
        levels, held, waiting = sent.value, {}, 0
        for batch in batches:
            for i in np.flatnonzero(batch.column(3).is_valid().to_numpy(zero_copy_only=False)):
                lang, size = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                keys = batch.column(1)[i].values.to_numpy().view(np.uint64)
                pair = _neighbours(lang, keys, batch.column(3)[i].as_py(), size, levels)
                if len(pair[0]):
                    held.setdefault(lang, []).append(pair)
                    waiting += len(pair[0])
                if waiting >= HELD:
                    yield from flush(held)
                    waiting = 0
        yield from flush(held)

    return run


def _frequent(sent, least):
    """Pairs of a bucket that occur often enough, as keys of both items and of the pair."""

    def run(table: pa.Table) -> pa.Table:
        out, level = [], sent.value[-1]
        langs = table.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [i for i, other in enumerate(langs) if other == lang]
            rows = np.concatenate([_spread(table.column("pairs")[i].as_py(), table.column("rows")[i].as_py()) for i in mine])
            found = summed(rows["x"], rows["y"], rows["n"])
            found = found[found["n"] >= least]
            x, y = level.key_of(lang, found["x"]), level.key_of(lang, found["y"])
            cells = [pa.array([lang] * len(found), pa.string())] + [pa.array(c.view(np.int64)) for c in (joined(x, y), x, y)]
            out.append(pa.table([*cells, pa.array(found["n"].astype(np.int64))], names=["lang", "k", "x", "y", "a"]))
        return pa.concat_tables(out)

    return run


def _ranked(level: DataFrame) -> Ranks:
    """Ranks of the ``RANKED`` most frequent items of ``(lang, k, a)``; whether that is all of them is counted."""
    top = level.orderBy(F.desc("a"), "lang", "k").limit(RANKED).select("lang", "k").toArrow()
    return Ranks(top, top.num_rows < RANKED or level.count() <= RANKED)


def frequent_phrases(chunks: DataFrame, longest: int, least: int) -> list[DataFrame]:
    """Tables of all phrases of 1, 2, ... ``longest`` words with at least ``least`` occurrences.

    Each holds ``lang``, the key ``k``, the occurrences ``a``, the keys of its ``words``, and
    ``f1``, ``f2``, ...: the occurrences of its parts of so many words, from the left.  A phrase of m
    words is a pair of two overlapping phrases of m - 1 words, so every level counts pairs
    of the level before and ranks the frequent ones anew.
    """
    spark = chunks.sparkSession
    level = chunks.where("k is not null").groupBy("lang", "k").agg(F.sum("times").alias("a")).where(f"a >= {least}")
    level = materialize(level.withColumn("words", F.array("k")), "phrases")
    tokens = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-tokens // TASK_PAIRS))
    levels, ranks = [level], []
    for m in range(2, longest + 1):
        ranks.append(_ranked(level))
        sent = spark.sparkContext.broadcast(list(ranks))
        pairs = chunks.where("sequence is not null").select("lang", "keys", "size", "sequence").mapInArrow(
            _paired(sent, buckets), "bucket int, lang string, rows int, pairs binary"
        )
        found = pairs.groupBy("bucket").applyInArrow(_frequent(sent, least), "lang string, k long, x long, y long, a long")
        found = materialize(found, "pairs")
        kept = ["words", *[f"f{i}" for i in range(1, m - 1)]]
        sides = [
            level.select("lang", F.col("k").alias(s), F.col("a").alias(f"a{s}"), *[F.col(c).alias(f"{c}_{s}") for c in kept])
            for s in ("x", "y")
        ]
        both = found.join(sides[0], ["lang", "x"]).join(sides[1], ["lang", "y"])
        # Counts of parts of i words: those of the left phrase and the last one of the right.
        spans = [F.concat(f"{c}_x", F.slice(f"{c}_y", -1, 1)).alias(c) for c in kept]
        level = materialize(both.select("lang", "k", "a", "x", "y", *spans, F.array("ax", "ay").alias(f"f{m - 1}")), "phrases")
        levels.append(level)
    return levels


def _scored(level: DataFrame, m: int) -> DataFrame:
    """Occurrences of both parts at the lowest-scoring cut, and its score, in exact whole numbers."""

    def cut(k: int):
        left, right = F.col(f"f{k}")[0], F.element_at(f"f{m - k}", -1)
        both = left.cast("decimal(20,0)") + right.cast("decimal(20,0)")
        twice = F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)")
        score = F.call_function("div", twice, both)
        return F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    return level.withColumn("cut", F.array_min(F.array(*[cut(k) for k in range(1, m)])))


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", top: int = 2_000, least: int = 30, longest: int = 4, percent: int = 80
) -> DataFrame:
    """The ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    A-Z is read as a-z.  Texts are cut into pieces at ``. , ; : ! ?`` and line breaks, and
    pieces into words at spaces and tabs.  A phrase of 2 to ``longest`` words that occurs
    ``a`` >= ``least`` times in the texts of its language scores floor(2,000,000 * a / (l + r)) for
    the occurrences l and r of the parts at its lowest-scoring cut, the leftmost of equal
    ones.  It is dropped if a longer phrase of up to ``longest`` words holds it with at least ``percent`` hundredths
    of its occurrences.  Ranks follow score, then a, both falling, then the phrase; ``n``
    counts all words of the language.  A NULL language is ``und`` and shares its rows with that value; NULL and empty texts
    have no words; repeated rows count each; an empty table gives an empty result.

    1. Texts become numbers once: for slices of texts the distinct words with their counts,
       and the sequence of their places.  Sequences are written compressed.
    2. Frequent words are ranked by frequency.  Tasks count neighbouring ranks: pairs in
       tiles of low ranks by direct address where a tile is dense, all others as sorted
       coordinates, and pass on one row for a pair and flush.
    3. Frequent pairs are ranked anew and counted as items of the next level, up to
       ``longest`` words.  Only items that occur ``least`` times can be parts of a candidate.

    At most ``RANKED`` items of a level are sent to the tasks; if there are more, the others go by
    their keys, which are counted as sorted coordinates, and nothing is lost.  Words and
    phrases are told apart by 63-bit hashes.
    """
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    chunks = materialize(
        docs.mapInArrow(_numbered, "lang string, keys array<long>, size long, sequence binary, k long, word string, times long"), "chunks"
    )
    levels = frequent_phrases(chunks, longest, least)
    kept = []
    for m in range(2, longest + 1):
        found = _scored(levels[m - 1], m).select("lang", "k", "words", "a", "cut.l", "cut.r", "cut.score")
        if m < longest:
            # A phrase inside any longer one lies inside one a single word longer that occurs as often or more.
            longer = levels[m].select("lang", "a", F.explode(F.array("x", "y")).alias("k"))
            most = longer.groupBy("lang", "k").agg(F.max("a").alias("most"))
            found = found.join(most, ["lang", "k"], "left")
            shadowed = F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
            found = found.where(~F.coalesce(shadowed, F.lit(False)))
        kept.append(found.select("lang", "words", "a", "l", "r", "score"))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionAll(more)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    close = materialize(every.withColumn("rank", F.rank().over(by)).where(f"rank <= {top}").drop("rank"), "close")
    parts = close.withColumn("phrase_id", F.monotonically_increasing_id())
    parts = materialize(parts, "numbered")
    cells = parts.select("lang", "phrase_id", F.posexplode("words").alias("place", "k"))
    needed = cells.select("lang", "k").distinct()
    spelt = chunks.where("k is not null").select("lang", "k", "word").join(needed, ["lang", "k"], "left_semi").dropDuplicates(["lang", "k"])
    texts = cells.join(spelt, ["lang", "k"]).groupBy("phrase_id").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"))
    phrases = parts.join(texts.select("phrase_id", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")), "phrase_id")
    total = chunks.where("sequence is not null").groupBy("lang").agg(F.sum("size").alias("n"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(last).cast("long")).where(f"rank <= {top}")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
