"""Whole batches of text as numpy arrays: words, word hashes and 5-word shingles.

Words are runs without the six ASCII white space characters; hashes see A-Z as a-z.
Nothing here knows Spark: the functions run inside tasks, on the Arrow batches
that Spark deals out.  Work arrays cover about half a megabyte of text at a time, so
memory follows the batch and not the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# For word hashes of letters only: whatever is in ASCII and not a letter separates.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[128:] = False
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, STEP + (STEP >> 2))
        _powers[:] = [
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (_BASE, _INVERSE)
        ]
    return _powers[0], _powers[1]


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the row offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _cuts(space: np.ndarray, n: int) -> list[int]:
    """Positions about STEP apart, each just behind white space."""
    cuts, at = [0], 0
    while n - at > STEP:
        at += STEP
        while at < n:
            found = np.flatnonzero(space[at : at + 4096])
            if len(found):
                at += int(found[0]) + 1
                break
            at += 4096
        if at < n:
            cuts.append(at)
    return cuts + [n]


def words(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = (), separators=_SPACE):
    """``(first word of each row and an end, word starts, word ends, hashes, [prefix hashes])``.

    ``separators`` says for each byte value whether it separates words.
    A prefix hash covers a word's first so many bytes, or the word if it is shorter.
    """
    n = len(data)
    space = separators[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    starts, ends, hashes, heads = [], [], [], [[] for _ in prefixes]
    cuts = _cuts(space, n) if n else []
    for lo, hi in zip(cuts, cuts[1:]):
        word = ~space[lo:hi]
        first = begins[lo:hi].copy()
        first[0] = True
        first[1:] |= space[lo : hi - 1]
        last = begins[lo + 1 : hi + 1].copy()
        last[-1] = True
        last[:-1] |= space[lo + 1 : hi]
        s, e = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
        power, inverse = _power(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_TABLE[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        hashes.append(mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)))
        for held, size in zip(heads, prefixes):
            e2 = np.minimum(e, s + size)
            held.append(mix((sums[e2] - sums[s]) * inverse[s] ^ np.uint64(size)))
        starts.append(s + lo)
        ends.append(e + lo)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    starts = join(starts, np.int64)
    rows = np.searchsorted(starts, offsets)
    return rows, starts, join(ends, np.int64), join(hashes, np.uint64), [join(h, np.uint64) for h in heads]


def row_hashes(rows: np.ndarray, hashes: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit hash of each row's word sequence."""
    if not len(rows) > 1:
        return np.zeros(0, np.uint64)
    longest = int(np.diff(rows).max(initial=0))
    power, _ = _power(longest + 1)
    within = np.arange(len(hashes)) - np.repeat(rows[:-1], np.diff(rows))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(seed)) * power[within])])
    return mix((sums[rows[1:]] - sums[rows[:-1]]) + np.diff(rows).astype(np.uint64))


def shingles(rows: np.ndarray, hashes: np.ndarray, size: int):
    """Sorted distinct shingle hashes of each row, one array a row.

    A row of fewer words has its whole sequence as one shingle, an empty row none.
    """
    turned = mix(hashes)
    width = max(0, len(hashes) - size + 1)
    windows = np.zeros(width, np.uint64)
    for j in range(size):
        windows = windows * np.uint64(_BASE) + turned[j : j + width]
    windows = mix(windows)
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            x = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in turned[a:b]:
                    x = x * np.uint64(_BASE) + h
            yield mix(np.array([x ^ np.uint64(size)]))
        else:
            yield np.zeros(0, np.uint64)
