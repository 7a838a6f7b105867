"""Subword pieces of a SentencePiece merge model, encoded by backtracking, and decoding."""

from __future__ import annotations

import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
CACHED, CACHED_CHARS = 400_000, 48


class Pieces:
    """A merge-type model with byte fallback and identity normalisation, read from its file.

    The library reads the vocabulary; encoding and decoding are done here.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        text: list[bytes] = []
        self.byte = [0] * 256
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.high = np.zeros(n, bool)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte[value] = i
                self.high[i] = value >= 128
                text.append(bytes([value]))
            elif model.is_control(i):
                text.append(b"")
            elif model.is_unknown(i):
                text.append(" ⁇ ".encode())
            else:
                self.id[piece] = i
                self.rank[piece] = model.get_score(i)
                text.append(piece.replace(SPACE, " ").encode())
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.sizes = np.array([len(t) for t in text], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.leads = np.zeros(n, bool)
        self.leads[[i for p, i in self.id.items() if p.startswith(SPACE)]] = True
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        # No merge crosses the start of a run of spaces, nor a line feed, if no piece does.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.by_line = not any("\n" in p for p in self.id)
        # Nothing merges across two neighbouring characters that no piece has side by side.
        self.inside = frozenset(p[i : i + 2] for p in self.id for i in range(len(p) - 1))
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-ranked neighbours first, from the left."""
        parts = list(text)
        rank = self.rank.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' characters anew gives the two pieces."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 1_000_000:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text without dummy prefix.

        The encoding is the one cut into pieces of which all neighbours fit.  The longest
        match is tried first at each position; where nothing fits, the position is marked
        as failed and the last piece gives way to a shorter one.  An encoding of a prefix
        is unique, so a failed position fails on every path and is never tried again.
        A character in no piece stands alone and becomes its UTF-8 bytes.
        """
        n = len(text)
        alone = [1]
        lengths = [alone] * n
        for end, size in self.automaton.iter(text):
            if size > 1:
                start = end - size + 1
                if lengths[start] is alone:
                    lengths[start] = [1, size]
                else:
                    lengths[start].append(size)
        failed, none_failed = bytearray((n >> 3) + 1), True
        fits, known_pair, stack, tokens = self.fits, self.pairs.get, [], []
        pos, last = 0, ""
        at = len(lengths[0]) - 1 if n else -1
        while pos < n:
            choices = lengths[pos]
            while at >= 0:
                end = pos + choices[at]
                if none_failed or not failed[end >> 3] >> (end & 7) & 1:
                    token = text[pos:end]
                    fit = known_pair((last, token))
                    if fit or (fit is None and fits(last, token)):
                        break
                at -= 1
            if at >= 0:
                stack.append((pos, at))
                tokens.append(token)
                last, pos = token, end
                at = len(lengths[pos]) - 1 if pos < n else -1
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                none_failed = False
                pos, at = stack.pop()
                tokens.pop()
                last = tokens[-1] if tokens else ""
                at -= 1
        ids, known, byte = [], self.id.get, self.byte
        for token in tokens:
            i = known(token)
            if i is None:
                ids.extend(byte[b] for b in token.encode())
            else:
                ids.append(i)
        return ids


class _Cache(dict):
    """Ids, as bytes, of runs met before, up to a bound; others are encoded each time."""

    def __init__(self, pieces: Pieces, prefix: str):
        super().__init__()
        self.pieces, self.prefix = pieces, prefix
        # Single characters inside a run stand there without the prefix.
        self.single = _Cache(pieces, "") if prefix else self

    def __missing__(self, run: str) -> bytes:
        if 1 < len(run) <= CACHED_CHARS and run[-2:] not in self.pieces.inside:
            return self[run[:-1]] + self.single[run[-1]]
        ids = array("i", self.pieces.encode_run(self.prefix + run)).tobytes()
        if len(run) <= CACHED_CHARS and len(self) < CACHED:
            self[run] = ids
        return ids


class Encoder:
    """Encodes whole texts; equal words are encoded once while the cache has room."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.spaced, self.plain = _Cache(self.pieces, SPACE), _Cache(self.pieces, "")
        self.feed = array("i", [self.pieces.byte[10]]).tobytes()
        self.runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def encode(self, text: str | None) -> bytes:
        """The ids as 32-bit numbers."""
        if not text:
            return b""
        pieces = self.pieces
        if not pieces.by_word:
            return array("i", pieces.encode_run(SPACE + text.replace(" ", SPACE))).tobytes()
        out = []
        odd = SPACE in text
        for i, line in enumerate(text.split("\n") if pieces.by_line else [text]):
            words = line.split(" ")
            if odd or "" in words:
                line = (line if i else SPACE + line).replace(" ", SPACE)
                out.append(b"".join(map(self.plain.__getitem__, self.runs.findall(line))))
            elif i:
                out.append(self.plain[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:])))
            else:
                out.append(b"".join(map(self.spaced.__getitem__, words)))
        return self.feed.join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process; it keeps its cache from task to task."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decoded(pieces: Pieces, ids: list[int]) -> str:
    """The text of one list of ids."""
    return decoded_rows(pieces, np.array(ids, np.int32), np.array([0, len(ids)]))[0].as_py()


def decoded_rows(pieces: Pieces, flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Texts of rows of ids as ``encode`` gives them, taken from a table of the pieces' bytes.

    One space of a row's first piece is dropped.  Byte pieces put single bytes together; where
    they make no UTF-8 the text has replacement characters.
    """
    starts, sizes = pieces.starts[flat].copy(), pieces.sizes[flat].copy()
    firsts = bounds[:-1][np.diff(bounds) > 0]
    led = firsts[pieces.leads[flat[firsts]]]
    starts[led] += 1
    sizes[led] -= 1
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = pieces.bytes[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
    cuts = ends[bounds]
    if pieces.high[flat].any():
        return pa.array([data[a:b].tobytes().decode(errors="replace") for a, b in zip(cuts[:-1], cuts[1:])], pa.string())
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``ids``, the piece ids of every whole text.

    The same ids as the library gives for the model at ``path``, a file every executor
    has, without begin and end marks.  NULL and empty texts have no ids; a text of
    spaces has ids; input columns named ``ids`` are replaced.
    """
    keep = [c for c in (keep or df.columns) if c != "ids"]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches):
        own = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [own.encode(t) for t in batch.column(len(keep)).to_pylist()]
                flat = np.frombuffer(b"".join(found), np.int32)
                bounds = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [ids], names=[*keep, "ids"])

    return df.select(*keep, df[text].alias("_text")).mapInArrow(run, f"{kind}, ids array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``decoded``, the text of the ids.

    NULL and empty lists give an empty text; NULL elements are left out.
    """
    keep = [c for c in (keep or df.columns) if c != "decoded"]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches):
        pieces = encoder(path).pieces
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(len(keep)).cast(pa.list_(pa.int32()))
                if lists.null_count or lists.flatten().null_count:
                    lists = pa.array([[i for i in x or [] if i is not None] for x in lists.to_pylist()], pa.list_(pa.int32()))
                flat, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy()
                texts = decoded_rows(pieces, flat, bounds - bounds[0])
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*keep, "decoded"])

    return df.select(*keep, df[ids].alias("_ids")).mapInArrow(run, f"{kind}, decoded string")
