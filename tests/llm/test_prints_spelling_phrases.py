"""Fingerprints, spelling variants and collocations against plain versions, and their edge cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from functools import cache
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest

from tagmill.llm import collocations as C
from tagmill.llm import simhash, spelling
from tagmill.llm.queries import QUERIES
from tagmill.llm.textbytes import mix, raw, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()


def docs(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


# --- fingerprints


@cache
def word_bits(word):
    base = mix(words(*raw(pa.array([word])))[3])
    h = [int(mix(base * lane)[0]) for lane in simhash._LANES]
    return "".join(f"{b:08b}" for x in h for b in x.to_bytes(8, "little"))


def plain_print(text):
    """Bit by bit votes of the weighted words of one text."""
    votes = [0] * 128
    for word, times in Counter(brute.WORD.findall(brute.lower(text))).items():
        for i, bit in enumerate(word_bits(word)):
            votes[i] += times.bit_length() if bit == "1" else -times.bit_length()
    return f"{int(''.join('1' if v > 0 else '0' for v in votes), 2):032x}"


def alike(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def check_prints(got, rows):
    """``got`` against rows (id, text) in order."""
    texts = [t or "" for _, t in rows]
    plain = [plain_print(t) for t in texts]
    assert len(got) == len(rows)
    for i, (key, _) in enumerate(rows):
        after = (i + 1) % len(rows)
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain[i], plain_print(edited))
        assert r.near_edited == alike(plain[i], r.edited_fingerprint) and r.near_next == alike(plain[i], plain[after])
    return dict(zip([k for k, _ in rows], plain))


def check_near(got, prints, radius):
    """Classes, links and components of ``{id: fingerprint}``."""
    least = {}
    for key in sorted(prints):
        least.setdefault(prints[key], key)
    near = [(a, b) for a in least for b in least if a < b and (int(a, 16) ^ int(b, 16)).bit_count() <= radius]
    links = Counter(x for pair in near for x in pair)
    roots = brute.roots(least.values(), [(least[a], least[b]) for a, b in near])
    for key, p in prints.items():
        assert (got[key].class_id, got[key].n_links, got[key].component) == (least[p], links[p], roots[least[p]])


def test_fingerprint_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, FOLDER).collect()}
    prints = check_prints(got, [(r.doc_id, r.text) for r in documents])
    check_near(got, prints, 6)


def test_fingerprints_of_odd_texts(spark):
    long = " ".join(f"w{i % 9000}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "é"), (5, "One one TWO two"), (6, long), (7, "a" * 70_000), (8, "One one TWO two"), (9, "😀😀 x")]
    df = docs(spark, [(k, t, "old") for k, t in reversed(rows)], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in simhash.edited_prints(df).withColumnRenamed("id", "doc_id").collect()}
    check_prints(got, rows)
    assert got[5].fingerprint == got[8].fingerprint and got[1].fingerprint == "0" * 32


def test_fingerprints_across_many_partitions(spark):
    rows = [(i, f"text number {i} " + "and more " * (i % 7)) for i in range(60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = simhash.edited_prints(docs(spark, rows).repartition(9)).withColumnRenamed("id", "doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    check_prints({r.doc_id: r for r in found}, rows)


def test_fingerprints_of_one_none_and_repeated_rows(spark):
    assert simhash.document_prints(docs(spark, [])).count() == 0
    one = simhash.edited_prints(docs(spark, [(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    rows = [(None, "x y"), (3, "one two"), (3, "one two"), (3, "two"), (None, None)]
    got = simhash.document_prints(docs(spark, rows)).collect()
    assert len(got) == 5 and all(r.class_id == r.component == 3 for r in got if r.doc_id) and all(r.component is None for r in got if r.doc_id is None)


@pytest.mark.parametrize("block", [512, 8])
def test_all_near_fingerprints_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "TASK_ROWS", 500)
    rnd, prints = random.Random(4), []
    for _ in range(25):
        base = rnd.getrandbits(128)
        prints += [base ^ sum(1 << b for b in rnd.sample(range(128), rnd.randint(0, 8))) for _ in range(8)]
    hot = rnd.getrandbits(128)
    prints += [hot ^ (1 << i) ^ (1 << (i * 7 % 128)) for i in range(40)]
    rows = [(i, f"{p:032x}", i) for i, p in enumerate(prints)] + [(900, None, 1)]
    found = simhash.near_prints(spark.createDataFrame(rows, "doc_id long, fingerprint string, component int"), radius=6)
    got = {r.doc_id: r for r in found.collect()}
    check_near(got, {i: f"{p:032x}" for i, p in enumerate(prints)}, 6)
    assert (got[900].class_id, got[900].n_links) == (None, None)


def test_tables_hold_every_choice_of_blocks():
    for n in (10, 1 << 30):
        masks = simhash.block_tables(128, 6, n)
        rnd = random.Random(n)
        for _ in range(300):
            apart = sum(1 << b for b in rnd.sample(range(128), 6))
            assert any(apart & m == 0 for m in masks)
    assert len(simhash.block_tables(128, 6, 10)) == 7 < len(simhash.block_tables(128, 6, 1 << 30))


# --- spelling


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]
        yield word[:i] + word[i + 1 :]


def plain_variants(counts, ratio=5):
    letters = sorted({c for w in counts for c in w})
    out = {}
    for word, n in counts.items():
        near = {w for w in edits(word, letters) if w in counts and w != word}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        out[word] = (best if best and counts[best] >= ratio * n else None, len(near))
    return out


def check_variants(got, counts):
    want = plain_variants(counts)
    assert {r.word for r in got} == set(want) and len(got) == len(want)
    for r in got:
        root = r.word
        while want[root][0]:
            root = want[root][0]
        assert (r.form, r.n_near, r.n) == (*want[r.word], counts[r.word])
        assert r.root == root and r.form_n == (counts[r.form] if r.form else None)


def test_spelling_query(spark, documents):
    check_variants(QUERIES["op12_spelling_variants"](spark, FOLDER).collect(), plain_counts([(r.doc_id, r.text) for r in documents]))


def test_words_are_counted_as_by_hand(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 7)
    rnd = random.Random(8)
    pool = ["".join(rnd.choice("abÀßé×÷Zÿ") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    rows = [(i % 50 if i % 9 else None, " ".join(rnd.choices(pool, k=rnd.randint(0, 80))) + "1_x") for i in range(300)] + [(1, None), (2, "")]
    got = spelling.word_counts(docs(spark, rows), "doc_id", "text")
    assert {r.word: r.n for r in got.collect()} == plain_counts(rows)


def test_variants_of_close_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TASK_ROWS", 300)
    monkeypatch.setattr(spelling, "LETTERS", 64)
    rnd = random.Random(5)
    counts = {"".join(rnd.choice("abÀ") for _ in range(rnd.randint(1, 6))): rnd.choice([1, 1, 2, 5, 5, 25, 30, 700]) for _ in range(400)}
    counts |= {"x" * 5000: 10, "x" * 4999: 2, "x" * 2500 + "y" + "x" * 2499: 60}
    df = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, w int")
    check_variants(spelling.spelling_variants(df).collect(), counts)


def test_variants_of_nothing_and_repeats(spark):
    df = spark.createDataFrame([(None, 5), ("abc", None), ("abc", 2), ("abc", 3), ("abcd", 1)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df).collect()}
    assert got == {"abc": (None, "abc", 5, 1, None), "abcd": ("abc", "abc", 1, 1, 5)}
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    assert spelling.spelling_variants(spelling.word_counts(docs(spark, []), "doc_id", "text")).count() == 0


# --- collocations


def plain_phrases(rows, top=2000, least=30, longest=4):
    """{lang: rows in order}, every phrase counted by itself."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", brute.lower(text)):
            ws = re.findall("[^ \t]+", piece)
            total[lang] += len(ws)
            for m in range(1, longest + 1):
                found.update(tuple(ws[i : i + m]) for i in range(len(ws) - m + 1))
    out = {}
    for lang, f in counts.items():
        phrases = [p for p, a in f.items() if len(p) > 1 and a >= least]
        dropped = set()
        for p in phrases:
            for m in range(2, len(p)):
                dropped |= {q for i in range(len(p) - m + 1) if 100 * f[p] >= 80 * f[q := p[i : i + m]]}
        rows = []
        for p in phrases:
            if p not in dropped:
                a = f[p]
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        out[lang] = [(i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return {lang: rows for lang, rows in out.items() if rows}


def check_phrases(got, want):
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r.lang, []).append((r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score))
    assert mine == want


def test_collocation_query(spark, documents):
    check_phrases(QUERIES["op13_collocations"](spark, FOLDER).collect(), plain_phrases([(r.lang, r.text) for r in documents]))


def some_talk(n, seed):
    rnd = random.Random(seed)
    common = [rnd.choice("abcdeéÈ") * rnd.randint(1, 3) + rnd.choice("xyz") for _ in range(12)]
    fixed = [" ".join(rnd.choices(common, k=rnd.randint(2, 6))) for _ in range(6)]
    rows = [("xx", None), (None, ""), ("xx", " \t"), (None, ". ; !")]
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else rnd.choice(common) for _ in range(rnd.randint(1, 60))]
        rows.append((rnd.choice(["xx", "yy", None, "und"]), rnd.choice([" ", "\t", " , "]).join(parts) + rnd.choice([".", "\r", "\x0b!"])))
    return rows


@pytest.mark.parametrize("bounds", [{}, {"RANKED": 5}, {"TILE": 4, "HELD": 200, "TASK_PAIRS": 300, "STEP": 100}])
def test_collocations_as_by_hand(spark, monkeypatch, bounds):
    """Also with few ranks, so that most items go by their keys, and with small tiles, dense ones among them."""
    for name, value in bounds.items():
        monkeypatch.setattr(C, name, value)
    rows = some_talk(250, 6)
    df = spark.createDataFrame([(lang, text, 1) for lang, text in rows], "lang string, text string, a int").repartition(3)
    check_phrases(C.collocations(df, top=40).collect(), plain_phrases(rows, top=40))


def test_collocations_hold_little_memory():
    """A batch of 20 MB of text, then its pairs: a task stays far below what an executor of two has beside its heap."""
    rnd = random.Random(1)
    vocabulary = [f"w{rnd.randrange(20_000)}" for _ in range(5_000)]
    text = " ".join(rnd.choices(vocabulary, k=2_000)) + ". "
    texts = [text] * (20_000_000 // len(text))
    batch = pa.RecordBatch.from_arrays([pa.array(["xx"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        chunks = list(C._numbered([batch]))
        assert tracemalloc.get_traced_memory()[1] - before < 250e6
        keys = pa.chunked_array([b.column(1) for b in chunks]).combine_chunks().values.unique()
        level = C.Ranks(pa.table({"lang": pa.array(["xx"] * len(keys)), "k": keys}), True)
        rows = [b.select(["lang", "keys", "size", "sequence"]) for b in chunks] * 2
        before = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        pairs = sum(sum(b.column(2).to_pylist()) for b in C._paired(SimpleNamespace(value=[level]), 3)(iter(rows)))
        assert pairs and tracemalloc.get_traced_memory()[1] - before < 250e6
    finally:
        tracemalloc.stop()


def test_collocations_pass_words_on_as_rows():
    """No row holds the words of a slice, which the JVM would expand to many times their size: only its keys and its sequence."""
    n = 200_000
    texts = [" ".join(f"w{i}" for i in range(at, at + 10_000)) for at in range(0, n, 10_000)]
    found = list(C._numbered([pa.RecordBatch.from_arrays([pa.array(["xx"] * len(texts)), pa.array(texts)], names=["lang", "text"])]))
    assert max(b.nbytes / b.num_rows for b in found) < 16 * n
    assert sum(b.num_rows for b in found) == n + 1
    assert sum(sum(filter(None, b.column("times").to_pylist())) for b in found) == n


def test_collocations_of_nothing(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert C.collocations(spark.createDataFrame([("xx", "one two three")], "lang string, text string")).count() == 0


def test_pairs_are_summed_alike_in_tiles_and_by_sorting(monkeypatch):
    rnd = np.random.default_rng(3)
    x, y = (rnd.integers(0, 40, 5000).astype(np.uint64) for _ in range(2))
    x[::50] = np.uint64(1 << 63) + x[::50]
    want = Counter(zip(x.tolist(), y.tolist()))
    n = np.arange(5000).astype(np.uint64)
    weighed = Counter()
    for a, b, c in zip(x.tolist(), y.tolist(), n.tolist()):
        weighed[a, b] += c
    for tile in (1024, 8):
        monkeypatch.setattr(C, "TILE", tile)
        assert {(a, b): c for a, b, c in C.summed(x, y).tolist()} == want
        assert {(a, b): c for a, b, c in C.summed(x, y, n).tolist()} == {k: c for k, c in weighed.items()}


def test_scores_beyond_64_bits(spark):
    a = 9 * 10**18
    level = spark.createDataFrame([([a, a // 2], a - 1)], "f1 array<long>, a long")
    got = C._scored(level, 2).select("cut.score").first()[0]
    assert got == 2_000_000 * (a - 1) // (a + a // 2)
