"""Words one edit apart, found by pairs of nodes of the forward and the reversed trie."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.textbytes import mix
from tagmill.session import materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
# Distinct words a task holds before it passes their counts on.
HELD = 300_000
# Letters of words worked on together, and pair rows of one task.
LETTERS, TASK_ROWS = 1 << 18, 400_000
_FORWARD, _BACKWARD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def lowered(run: str) -> str:
    """The run with A-Z, and nothing else, in lower case."""
    return run if run.islower() else run.translate(_LOWER)


def _counted(least: int, dropped: int):
    """``(word, n)`` of a task's texts, with one code point deleted in one of ``dropped`` runs of a document."""

    def sent(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                runs: dict[str, int] = {}
                for found, times in Counter(RUN.findall(text)).items():
                    found = lowered(found)
                    runs[found] = runs.get(found, 0) + times
                start = zlib.crc32(b"%s:" % ("" if key is None else str(key)).encode())
                for word, times in runs.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % dropped == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least:
                        counts[word] = counts.get(word, 0) + times
                if len(counts) >= HELD:
                    yield sent(counts)
                    counts = {}
        if counts:
            yield sent(counts)

    return run


def word_counts(df: DataFrame, key: str, text: str, least_length: int = 6, least_count: int = 5, dropped: int = 199) -> DataFrame:
    """``(word, n)`` of all words long and frequent enough; counts combine before the shuffle."""
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    counts = docs.mapInArrow(_counted(least_length, dropped), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {least_count}")


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(0, n - 1), base, np.uint64))])


def trie_pairs(words: list[str], base=(_FORWARD, _BACKWARD)):
    """Node pairs of words: ``(word number, prefix node, suffix node, kind)`` as arrays.

    A node is numbered by a 64-bit hash of its path, forward or reversed, so all tasks
    number it alike.  Kind 0 is a word itself, cut at any place; kinds 1 and 2 are a word
    with the letter between both parts skipped, 2 where the letter is the last of a run
    of equal letters.  Words that share a pair of kinds 1 or 2 differ in that letter; a
    word of kind 0 is what is left of those of kind 2 without it.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(points)) - starts[owner]
    letter = mix(points + np.uint64(1))
    longest = int(sizes.max(initial=0))
    sums = []
    for b, place in zip(base, (at, sizes[owner] - 1 - at)):
        sums.append(np.concatenate([[np.uint64(0)], np.cumsum(letter * _powers(b, longest)[place])]))
    # Cuts before every letter and, for whole words, one behind the last.
    prefix = mix((sums[0][:-1] - sums[0][starts[owner]]) + at.astype(np.uint64))
    left = sizes[owner] - at
    whole = mix((sums[1][ends[owner]] - sums[1][:-1]) ^ left.astype(np.uint64))
    rest = mix((sums[1][ends[owner]] - sums[1][1:]) ^ (left - 1).astype(np.uint64))
    last = np.ones(len(points), bool)
    last[:-1] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    full = mix((sums[0][ends] - sums[0][starts]) + sizes.astype(np.uint64))
    none = np.full(len(words), mix(np.zeros(1, np.uint64))[0])
    return (
        np.concatenate([owner, np.arange(len(words)), owner]),
        np.concatenate([prefix, full, prefix]),
        np.concatenate([whole, none, rest]),
        np.concatenate([np.zeros(len(points) + len(words), np.int8), 1 + last.astype(np.int8)]),
    )


def _pairs(batches):
    for batch in batches:
        numbers, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        at = 0
        while at < len(words):
            upto, letters = at, 0
            while upto < len(words) and (letters < LETTERS or upto == at):
                letters += len(words[upto])
                upto += 1
            owner, first, second, kind = trie_pairs(words[at:upto])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[at:upto][owner]), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(kind)],
                names=["w", "f", "b", "kind"],
            )
            at = upto


def _meetings(table: pa.Table) -> pa.Table:
    """For each word of each pair of nodes: how many near words it meets there and the first of them.

    Words are numbered from the most frequent on, so the first is the one of largest count.
    """
    w, f, b, kind = (table.column(c).to_numpy() for c in ("w", "f", "b", "kind"))
    order = np.lexsort((w, b, f))
    w, f, b, kind = w[order], f[order], b[order], kind[order]
    new = np.ones(len(w), bool)
    new[1:] = (f[1:] != f[:-1]) | (b[1:] != b[:-1])
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    far = np.iinfo(np.int64).max
    skips, lasts, wholes = kind > 0, kind == 2, kind == 0
    many = np.add.reduceat(skips.astype(np.int64), starts)
    some = np.add.reduceat(lasts.astype(np.int64), starts)
    least = lambda x: np.minimum.reduceat(np.where(x, w, far), starts)
    first, first_last, whole = least(skips), least(lasts), least(wholes)
    second = least(skips & (w != first[group]))
    met = np.where(wholes, some[group], many[group] - 1 + (lasts & (whole[group] != far)))
    best = np.where(w == first[group], second[group], first[group])
    best = np.where(lasts, np.minimum(best, whole[group]), best)
    best = np.where(wholes, first_last[group], best)
    keep = met > 0
    return pa.table({"w": w[keep], "met": met[keep], "best": best[keep]})


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for the distinct words of ``words`` (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code point.
    ``form`` is the near word of largest ``n``, of equal ones the smallest in code-point
    order, if its n is at least ``ratio`` (2 or more) times the word's; else NULL.  ``root`` is the end
    of the chain of forms, the word itself without one; ``n_near`` counts the near words.
    Rows with a NULL word or count are left out, rows of equal words added up; without
    words the result is empty.

    Words are numbered by falling n.  Each gives a pair (prefix node, suffix node) for
    every cut, and for every letter skipped; equal pairs meet.  As a pair and the skipped
    letter make a word, a pair is shared by no more words than there are letters, and one.
    Every word leaves a pair with one row, never with a row for each other word.  Pairs
    are dealt to tasks by hash, in as many parts as their number asks for.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    given = words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    falling = [F.desc("n"), F.asc("word")]
    ranked = given.repartitionByRange(*falling).sortWithinPartitions(*falling)
    ranked = materialize(ranked.withColumn("w", F.monotonically_increasing_id()), "words")
    rows = ranked.agg(F.sum(2 * F.length("word") + 1)).first()[0] or 0
    pairs = ranked.select("w", "word").mapInArrow(_pairs, "w long, f long, b long, kind byte")
    part = F.pmod(F.xxhash64("f", "b"), F.lit(max(1, -(-rows // TASK_ROWS))))
    met = pairs.groupBy(part.alias("part")).applyInArrow(_meetings, "w long, met long, best long")
    near = met.groupBy("w").agg(F.sum("met").alias("n_near"), F.min("best").alias("best"))
    named = ranked.select(F.col("w").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = ranked.join(near, "w", "left").join(named, "best", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    n_near = F.coalesce("n_near", F.lit(0)).alias("n_near")
    found = materialize(
        found.select("w", "word", "n", n_near, *[F.when(enough, F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "forms"
    )
    # Counts grow along a chain by the ratio, so chains are short and doubling ends soon.
    steps = found.where("best is not null").select("w", F.col("best").alias("root"))
    while True:
        onward = steps.select(F.col("w").alias("root"), F.col("root").alias("next"))
        longer = materialize(steps.join(onward, "root", "left"), "chains")
        if not longer.where("next is not null").limit(1).count():
            break
        steps = longer.select("w", F.coalesce("next", "root").alias("root"))
    roots = steps.join(ranked.select(F.col("w").alias("root"), F.col("word").alias("root_word")), "root").select("w", "root_word")
    return found.join(roots, "w", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
