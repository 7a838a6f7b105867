"""Language of a text: known words first, then ever shorter character n-grams."""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagmill.llm.samples import chosen
from tagmill.llm.textbytes import NOT_LETTERS, raw, words

LONGEST = 5


@dataclass
class Languages:
    """Log frequencies per language of words (by hash) and of n-grams of 1 to LONGEST characters."""

    names: list[str]
    hashes: np.ndarray
    logs: np.ndarray
    grams: list[dict[str, int]]  # row of each n-gram
    gram_logs: list[np.ndarray]


def _logs(counts: np.ndarray, add: float) -> np.ndarray:
    return np.log((counts + add) / (counts.sum(axis=0) + add * max(1, len(counts)))).astype(np.float32)


class _Counts:
    """Counts of items by language, in rows that grow."""

    def __init__(self, langs: int):
        self.langs, self.row, self.held = langs, {}, array("d")

    def add(self, item, lang: int, n: float = 1.0) -> bool:
        """Count; whether the item is new for the language."""
        at = self.row.get(item)
        if at is None:
            at = self.row[item] = len(self.row)
            self.held.extend([0.0] * self.langs)
        at = at * self.langs + lang
        new = not self.held[at]
        self.held[at] += n
        return new

    def logs(self, add: float) -> np.ndarray:
        counts = np.frombuffer(self.held).reshape(-1, self.langs) if self.row else np.zeros((0, max(1, self.langs)))
        return _logs(counts, add)


def train(texts, labels: list[str], least: int = 2) -> Languages:
    """Words seen ``least`` times or more are known.  N-grams are counted over the
    distinct words of each language, each with a space on both sides."""
    names = sorted(set(labels))
    known, grams = _Counts(len(names)), [_Counts(len(names)) for _ in range(LONGEST + 1)]
    for lo in range(0, len(labels), 500):
        data, offsets = raw(texts.slice(lo, 500))
        rows, starts, ends, hashes, _ = words(data, offsets, separators=NOT_LETTERS)
        of = np.repeat([names.index(x) for x in labels[lo : lo + 500]], np.diff(rows))
        for lang in range(len(names)):
            mine = np.flatnonzero(of == lang)
            some, first, n = np.unique(hashes[mine], return_index=True, return_counts=True)
            for h, i, c in zip(some.tolist(), mine[first].tolist(), n.tolist()):
                if known.add(h, lang, c):
                    word = " " + data[starts[i] : ends[i]].tobytes().decode().lower() + " "
                    for size in range(1, LONGEST + 1):
                        for j in range(len(word) - size + 1):
                            grams[size].add(word[j : j + size], lang)
    hashes = np.fromiter(known.row, np.uint64, len(known.row))
    often = np.frombuffer(known.held).reshape(len(hashes), -1).sum(axis=1) >= least if len(hashes) else np.zeros(0, bool)
    order = np.argsort(hashes[often])
    logs = known.logs(0.1)[often][order]
    return Languages(names, hashes[often][order], logs, [g.row for g in grams], [g.logs(0.5) for g in grams])


def backed_off(model: Languages, word: str) -> np.ndarray:
    """Mean log frequencies of the longest n-grams of an unseen word that are known."""
    word = " " + word.lower() + " "
    for n in range(min(LONGEST, len(word)), 0, -1):
        held = [g for g in map(model.grams[n].get, (word[j : j + n] for j in range(len(word) - n + 1))) if g is not None]
        if held:
            return model.gram_logs[n][held].mean(axis=0)
    return np.zeros(len(model.names), np.float32)


def predict(model: Languages, column, cache: dict) -> tuple[list[str], np.ndarray]:
    """Language and its share of the posterior for each text; ``und`` and 0 without a letter."""
    data, offsets = raw(column)
    rows, starts, ends, hashes, _ = words(data, offsets, separators=NOT_LETTERS)
    n = len(rows) - 1
    total = np.zeros((n, len(model.names)))
    letters = np.zeros(n, bool)
    if len(hashes) and model.names:
        at = np.minimum(np.searchsorted(model.hashes, hashes), max(0, len(model.hashes) - 1))
        seen = model.hashes[at] == hashes if len(model.hashes) else np.zeros(len(hashes), bool)
        logs = np.zeros((len(hashes), len(model.names)), np.float32)
        logs[seen] = model.logs[at[seen]]
        rest = np.flatnonzero(~seen)
        for i, h in zip(rest.tolist(), hashes[rest].tolist()):
            found = cache.get(h)
            if found is None:
                found = backed_off(model, data[starts[i] : ends[i]].tobytes().decode())
                if len(cache) < 200_000:
                    cache[h] = found
            logs[i] = found
        full = np.flatnonzero(np.diff(rows))
        total[full] = np.add.reduceat(logs.astype(np.float64), rows[:-1][full], axis=0)
        ascii_ = np.concatenate([[0], np.cumsum(~NOT_LETTERS[data] & (data < 128))])
        letters = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
        for r in full:
            if not letters[r]:
                letters[r] = any(map(str.isalpha, data[offsets[r] : offsets[r + 1]].tobytes().decode()))
    if not model.names:
        return ["und"] * n, np.zeros(n)
    share = np.exp(total - total.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    names = [model.names[b] if ok else "und" for b, ok in zip(best, letters)]
    return names, np.where(letters, share.max(axis=1), 0.0)


def fit_languages(docs: DataFrame, key="doc_id", text="text", lang="lang", each: int = 1_500, most: int = 6_000) -> Languages:
    """Learn from about ``each`` rows of every language, ``most`` in all: a bounded sample
    chosen by a hash of the key and counted on the driver."""
    sample = chosen(docs.select(key, text, lang), key, lang, each, most).toArrow().sort_by(key)
    return train(sample.column(text), sample.column(lang).to_pylist())


def identify_languages(df: DataFrame, model: Languages, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default), ``lang_pred`` and ``score`` of every whole text.

    Words are runs of letters.  A NULL text or one without a letter is ``und`` with
    score 0, as is every text under a model without languages; of equally likely
    languages the first by name wins; input columns named like a result are replaced.
    """
    keep = [c for c in (keep or df.columns) if c not in ("lang_pred", "score")]
    sent = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*keep, df[text].alias("_text"))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches):
        model = sent.value
        cache = model.__dict__.setdefault("cache", {})  # kept by the worker from task to task
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                names, share = predict(model, batch.column("_text"), cache)
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(names, pa.string()), pa.array(share)], names=[*keep, "lang_pred", "score"]
                )

    return source.mapInArrow(run, f"{kind}, lang_pred string, score double")
