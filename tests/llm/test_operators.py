"""Each operator on small tables with nulls, empty and long texts, copies, clashing names."""

import itertools
import random
import re
import time

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tagmill.llm import frames, htmltext, jaccard, language, neighbours, packing, pieces, quality, secrets, sharding, toxicity
from tagmill.llm.frames import components
from tagmill.llm.jaccard import ngram_jaccard
from tagmill.llm.samples import chosen
from tagmill.session import materialize

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


def some_texts(n=120, seed=3):
    rnd = random.Random(seed)
    words = ["the", "of", "and", *["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(60)]]
    texts = [None, "", " \n\t ", "one", "One two", "x" * 3000, " ".join(rnd.choice(words) for _ in range(20_000))]
    while len(texts) < n:
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 90))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 4)):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append((rnd.choice([" ", "\n"])).join(copy).upper() if rnd.random() < 0.3 else " ".join(copy))
    return texts


# --- components


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "c").collect()}
    want = brute.roots({n for e in edges for n in e}, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "c").count() == 0


def test_components_carried_on(spark, monkeypatch):
    """New edges join what is known; a star costs one round, and no new edges none."""
    rnd = random.Random(2)
    old, new = ([(rnd.randrange(200), rnd.randrange(200)) for _ in range(70)] for _ in range(2))
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    known = components(frame(old), "c")
    got = {r.node: r.root for r in components(frame(new), "c", known).collect()}
    want = brute.roots({n for e in old + new for n in e}, old + new)
    assert got == {n: want[n] for a, b in old + new if a != b for n in (a, b)}
    written = []
    monkeypatch.setattr(frames, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    assert components(frame([]), "c", known) is known and not written
    components(frame([(i, 0) for i in range(1, 9)]), "c")
    assert len(written) == 2


# --- 1 packing


def test_bounds_are_optimal():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        lengths = np.sort(rnd.choice(60, rnd.integers(1, 9), replace=False)).astype(np.int64) + 1
        counts = rnd.integers(1, 9, len(lengths)).astype(np.int64)
        for buckets in (1, 2, 3, 20):
            best = min(
                sum(int(c) * min(b for b in (*cut, int(lengths[-1])) if b >= x) for x, c in zip(lengths.tolist(), counts))
                for k in range(min(buckets, len(lengths)))
                for cut in itertools.combinations(lengths[:-1].tolist(), k)
            )
            bounds = packing.best_bounds(lengths, counts, buckets)
            assert len(bounds) <= buckets and bounds[-1] == lengths[-1]
            assert sum(int(c) * min(b for b in bounds if b >= x) for x, c in zip(lengths.tolist(), counts)) == best


def test_packing_edges(spark):
    rows = [(i % 40 if i % 7 else None, 5 if i % 3 == 0 else i * 3) for i in range(200)] + [(1, None), (2, 10**12)]
    df = spark.createDataFrame(rows, "id long, bucket long")
    got = packing.pack(df, "id", F.col("bucket"), buckets=4, budget=500).collect()
    assert len(got) == len(rows)
    seen = {}
    for r in got:
        assert r.n_tokens <= r.pad_to
        seen.setdefault((r.bucket, r.batch), []).append(r)
    for batch in seen.values():
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * batch[0].pad_to <= 500
    assert packing.pack(df.limit(0), "id", F.col("bucket")).count() == 0


# --- 2 pieces


def test_pieces_as_the_library():
    lib, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Encoder(MODEL)
    rnd = random.Random(5)
    letters = "abcdefgh  \n\r\t▁éßñ漢字🎉Ώ'\";(){}<>0123456789_-=/\\"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    known = sorted(own.pieces.id)
    texts += ["".join(rnd.choice(known) for _ in range(rnd.randint(1, 12))) for _ in range(800)]
    texts += [" ", "  ", "\n", "\n a", "▁", "<s> x", "<0x0A>", "a" * 5000, "=" * 999, "\x00a", "é"]
    for text in texts:
        ids = np.frombuffer(own.encode(text), np.int32).tolist()
        assert ids == lib.encode(text), text
        assert pieces.decoded(own.pieces, ids) == lib.decode(ids), text


def test_pieces_frames(spark):
    df = docs(spark, [(1, None, "x"), (None, "", "y"), (3, "Hello  wörld\n", "z"), (3, "Hello  wörld\n", "z")], ", ids string")
    got = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded) for r in got)[:2] == [(0, 0, ""), (1, 0, "")]
    assert [r.decoded for r in got if r.doc_id == 3] == ["Hello  wörld\n"] * 2
    assert pieces.encode(df.limit(0), MODEL).count() == 0


# --- 3 secrets


def test_trigram_queries():
    query = secrets.trigram_query
    assert query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert query("[0-9a-f]+") == [] and query("(abc|x)") == [] and query("ab?c") == []
    assert query("(?:abc|defg)+x*hij") == [
        [frozenset({"abc"}), frozenset({"def", "efg"})],
        [frozenset({"hij"})],
    ]
    for rule in secrets.RULES:
        assert rule.kind == "hex" or query(rule.pattern)


def test_secrets_as_plain_search(spark):
    rnd = random.Random(9)
    parts = ["password", "Token", "secret", "api_key", "APIKEY", "=", ": ", ' = "', "abc", "0123456789abcdef", "AKIA", "QWERTY12345678901", " ", "\n", "é🎉", "'", "x=y", "a" * 23, "b" * 25]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "secret=token = abcdefgh", "password=abc", "AKIA" * 40, "f" * 5000, "token: 'abcdef' " * 300]
    df = docs(spark, list(enumerate(texts)))
    for sent in (10**6, 0):
        found = secrets.scan_secrets(df, "text", ["doc_id", "text"], secrets.BASE, sent)
        found = found.select("doc_id", secrets.listed(F.col("secrets")).alias("spans"), secrets.masked(F.col("text"), F.col("secrets")).alias("out"))
        got = {r.doc_id: r for r in found.collect()}
        assert {i: r.spans for i, r in got.items()} == {i: ",".join(brute.base_spans(t)) for i, t in enumerate(texts)}
    for i, text in enumerate(texts):
        assert (got[i].out == text) == (not brute.base_spans(text))
        if text:
            assert not re.search(r"AKIA[A-Z0-9]{16}", got[i].out)


def test_secrets_take_time_with_their_number(spark):
    """Sixty thousand letters and words that look like secrets, in one text; spans and the masked text are those of a plain search."""
    text = "".join(f"a token={i:06x}z " if i % 2 else f"b {i:024x}é " for i in range(60_000))
    found = secrets.scan_secrets(docs(spark, [(1, text)]), "text", ["doc_id", "text"], secrets.BASE)
    start = time.perf_counter()
    row = found.select(secrets.listed(F.col("secrets")).alias("spans"), secrets.masked(F.col("text"), F.col("secrets")).alias("out")).first()
    assert time.perf_counter() - start < 60
    assert row.spans.split(",") == brute.base_spans(text)
    assert row.out == re.sub(r"token=[0-9a-f]{6}z", "[assign]", re.sub(r"[0-9a-f]{24}", "[hex]", text))


def test_secrets_of_nothing(spark):
    assert secrets.scan_secrets(docs(spark, []), "text", ["doc_id"]).count() == 0


# --- 4 quality


def repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)})


def test_quality_measures_and_cascade(spark):
    texts = [t for t in some_texts(80) if not t or len(t) < 4000] + ["a b\n" * 30, "a b c a b c", "x\n\nx\nx", "WORD up " * 40, "# * $ " * 50]
    df = docs(spark, [(i, t, "old") for i, t in enumerate(texts)], ", rejected_by string")
    got = {r.doc_id: r for r in quality.measured(df, "text", ["doc_id"]).collect()}
    verdict = {r.doc_id: r.rejected_by for r in quality.quality_cascade(df).collect()}
    for i, text in enumerate(texts):
        words = brute.WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), repeats(words)), text
        assert (r.n_lines, r.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        bad = {rule.name for rule in quality.RULES if eval_rule(rule, r)}
        assert verdict[i] in bad if bad else verdict[i] is None
    assert quality.quality_cascade(df.limit(0)).count() == 0


def eval_rule(rule, r):
    m = [getattr(r, n) for n in rule.needs]
    return rule.rejects(*m)


def test_repeats_of_long_text(spark):
    words = ["w%d" % (i % 700) for i in range(9_000)]
    got = quality.measured(docs(spark, [(1, " ".join(words))]), "text", ["doc_id"], ("n_repeat_words",)).first()
    assert got.n_repeat_words == 9_000


def test_filtered_verdict_of_long_texts_is_linear(spark):
    text = " ".join(f"word{i * 7919 % 20_011}" for i in range(20_000))
    df = docs(spark, [(1, text), (2, None)])
    start = time.perf_counter()
    kept = quality.quality_cascade(df).where("rejected_by is null").select("doc_id").collect()
    counts = quality.measured(df, "text", ["doc_id"]).where("n_words > 5 and n_repeat_words = 0").collect()
    assert [r.doc_id for r in kept] == [r.doc_id for r in counts] == [1]
    assert time.perf_counter() - start < 60


# --- 5 n-gram join


@pytest.mark.parametrize("options", [{}, {"heavy": 3, "buckets": 4, "cells": 1 << 14}])
def test_jaccard_as_brute_force(spark, options):
    texts = some_texts()
    hot = "one two three four five six seven eight nine ten eleven twelve " * 3
    texts += [hot] * 60 + [hot + f"tail{i}" for i in range(60)]
    df = docs(spark, [(i, t, 1) for i, t in enumerate(texts)], ", k int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component) for r in ngram_jaccard(df, **options).collect()}
    assert got == brute.jaccard(dict(enumerate(texts)))


def test_jaccard_of_long_lists_in_blocks(spark, monkeypatch):
    """A chain of near texts with one frequent passage: most pairs meet, few link, no star reaches all."""
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 8)
    monkeypatch.setattr(jaccard, "LIST_ROWS", 50)
    words = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(words[2 * i : 2 * i + 40] + ["common"] * 6) for i in range(120)}
    got = {r.doc_id: (r.n_shingles, r.component) for r in ngram_jaccard(docs(spark, list(texts.items())), rounds=1).collect()}
    assert got == brute.jaccard(texts)


def test_jaccard_starts_no_joins_without_pairs(spark, monkeypatch):
    """Each query leaves memory of the driver in use, so a step with no pairs left reads no texts."""
    written = []
    for module in (jaccard, frames):
        monkeypatch.setattr(module, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    words = [f"w{i}" for i in range(60)]
    texts = {0: " ".join(words), 1: " ".join([*words, "tail"]), 2: "another text of some more words than five"}
    got = {r.doc_id: (r.n_shingles, r.component) for r in ngram_jaccard(docs(spark, list(texts.items()))).collect()}
    assert got == brute.jaccard(texts)
    assert [written.count(n) for n in ("stars", "texts", "known", "first", "rest", "roots")] == [1, 1, 2, 0, 0, 0]


def test_jaccard_hands_texts_over_in_small_batches(spark, monkeypatch):
    """A worker of a stage that reads texts gets 12 MB of them in parts; other stages and later ones as the session says."""

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)

    def largest():
        texts = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
        return texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    seen = {}
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: seen.setdefault(name, largest()) and materialize(df, name))
    words = [f"w{i}" for i in range(60)]
    texts = {0: " ".join(words), 1: " ".join([*words, "tail"])}
    assert {r.component for r in ngram_jaccard(docs(spark, list(texts.items()))).collect()} == {0}
    assert all(seen[name] < 5e6 for name in ("scan", "lists", "texts", "links"))
    assert seen["signed"] > 12e6 - 1 and largest() > 12e6 - 1


def test_postings_travel_with_each_class_once():
    """A class posts many shingles; its hash and size are packed once."""
    rnd = np.random.default_rng(5)
    keys = np.sort(rnd.integers(-(1 << 62), 1 << 62, 500))
    posted = np.empty(40_000, jaccard.POSTING)
    place = rnd.integers(0, 500, len(posted))
    posted["h"], posted["k"], posted["n"] = np.sort(rnd.integers(0, 1 << 62, len(posted))), keys[place], 40 + place
    posted["pos"] = rnd.integers(0, 150, len(posted))
    blob = jaccard._squeezed(posted)
    assert (jaccard._spread(blob, len(posted)) == posted).all() and len(blob) < 11 * len(posted)
    assert len(jaccard._spread(jaccard._squeezed(posted[:0]), 0)) == 0


def test_jaccard_keys(spark):
    df = docs(spark, [(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, None)])
    got = sorted(ngram_jaccard(df).collect(), key=str)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component)) for r in got) == [
        ("2", 0, "2"), ("4", 1, "4"), ("4", 1, "4"), ("None", 1, "None")
    ]
    assert ngram_jaccard(docs(spark, [])).count() == 0


def test_jaccard_checks_a_pair_of_repeated_rows_once(spark, monkeypatch):
    frames = {}
    monkeypatch.setattr(jaccard, "materialize", lambda df, name, real=jaccard.materialize: frames.setdefault(name, real(df, name)))
    text = " ".join(f"w{i}" for i in range(60))
    df = docs(spark, [(1, text)] * 4 + [(2, text + " tail")] * 4)
    assert {(r.doc_id, r.component) for r in ngram_jaccard(df).collect()} == {(1, 1), (2, 1)}
    assert [frames[n].count() for n in ("signed", "stars", "links")] == [2, 1, 1]


# --- 6 toxicity, 9 languages


def test_toxicity_learns(spark):
    rnd = random.Random(4)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for i in range(900):
        text = [rnd.choice(words) for _ in range(rnd.randint(3, 60))]
        bad = i % 4 == 0
        if bad:
            text.insert(rnd.randrange(len(text)), rnd.choice(["nasty", "awful", "vile"]) + rnd.choice(["", "ly", "er"]))
        rows.append((i, " ".join(text), "en" if i % 3 else None, int(bad)))
    texts, labels = pa.array([r[1] for r in rows[:600]]), np.array([r[3] for r in rows[:600]])
    net = toxicity.train(texts, labels, [r[2] for r in rows[:600]])
    df = spark.createDataFrame(rows[600:] + [(10**6, None, "xx", 0), (10**6 + 1, "", None, 0)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, net).collect()}
    right = sum(got[r[0]].flagged == bool(r[3]) for r in rows[600:])
    assert right >= 0.95 * 300 and not got[10**6].flagged and got[10**6].score == got[10**6 + 1].score
    assert set(net.thresholds) == {"en"}
    assert toxicity.score_toxicity(df.limit(0), net).count() == 0


def test_toxicity_without_labels(spark):
    df = docs(spark, [(1, "a b", "en")], ", lang string")
    net = toxicity.fit_toxicity(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(df, net).first().score < 0.3


def test_languages(spark):
    texts = ["the cat and the dog", "the house of the man", "der Hund und die Katze", "das Haus und der Mann"] * 3
    model = language.train(pa.array(texts), ["en", "en", "de", "de"] * 3)
    df = docs(spark, [(1, "the dogs"), (2, "der Hundes"), (3, None), (4, " 12 "), (5, ""), (6, "«»"), (7, "漢字"), (8, "katzen " * 30_000)], "")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_languages(df, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[8][0] == "de" and got[7][0] in ("de", "en")
    assert all(got[i] == ("und", 0.0) for i in (3, 4, 5, 6)) and all(0 <= s <= 1 for _, s in got.values())
    none = language.fit_languages(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in language.identify_languages(df.limit(1), none).collect()] == ["und"]


def test_backoff_goes_to_shorter_grams():
    model = language.train(pa.array(["abcde", "zzzzz"]), ["a", "z"], least=1)
    for word in ("abcdx", "xxbcd", "xxxbx"):
        assert language.backed_off(model, word).argmax() == 0
    assert (language.backed_off(language.train(pa.array(["q"]), ["a"]), "") != 1).all()


def test_toxicity_thresholds_come_from_rows_apart(monkeypatch):
    """The network sees five of six rows, the thresholds the sixth."""
    texts = pa.chunked_array([[f"word{i} {'bad' if i % 3 == 0 else 'good'}" for i in range(300)]])
    labels = np.array([int(i % 3 == 0) for i in range(300)])
    seen = []
    monkeypatch.setattr(toxicity, "_fitted", lambda t, y, *rest, fit=toxicity._fitted: seen.append((t.to_pylist(), y)) or fit(t, y, *rest))
    monkeypatch.setattr(toxicity, "_calibrate", lambda net, t, y, langs: seen.append((t.to_pylist(), y)))
    toxicity.train(texts, labels, [None] * 300)
    (fitted, _), (held, y) = seen
    assert not set(fitted) & set(held) and set(fitted) | set(held) == set(texts.to_pylist())
    assert len(held) == 49 and y.sum() == 16


def test_toxicity_sample_of_repeated_ids(spark):
    """A key counts once, however many rows repeat it."""
    rows = [(i % 40, f"{'bad' if i % 2 else 'good'} {i} words", "en") for i in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 3, "doc_id long, toxic int")
    net = toxicity.fit_toxicity(df, labels)
    found = {(r.doc_id % 2, r.score > 0.5) for r in toxicity.score_toxicity(df, net).collect()}
    assert found == {(0, False), (1, True)}


def test_sample_is_bounded_and_fixed(spark):
    df = spark.range(4_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("y"))
    first, again = (sorted(r.doc_id for r in chosen(df.repartition(n), "doc_id", "y", 200, 300).collect()) for n in (2, 7))
    assert first == again and 200 < len(first) < 375


# --- 7 pages


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<article><h1>A &amp; B</h1><p>x\n <b>y</b>z<br>w</p></article><footer>c</footer>", "A & B\n\nx yz w"),
        ("<nav><p>m</p></nav><main><p>One two.</p><div class='ad box'><p>buy</p></div><p>Three.</p></main>", "One two.\n\nThree."),
        ("<main><p>t</p><div id=comments><div>c</div><p>d</p></div></main><p>stray</p>", "t"),
        ("<body><p>" + "long text " * 30 + "</p><script>var a='</p>';</script><style>p{}</style><p>end</p><aside>s</aside><p>x</p>", "long text " * 29 + "long text\n\nend"),
        ("<article><nav><p>kept, never closed</p><p>a &lt; b</p></article>", "kept, never closed\n\na < b"),
        ("<article><p>1 < 2 and <i title='>'>3</i></p><!-- <p>no</p> --></article>", "1 < 2 and 3"),
    ],
)
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


LONG = " ".join(["long text"] * 30)
CARD = "<article><h2><a href='/1'>Card</a></h2><p>Read about it.</p></article>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"{CARD * 4}<div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p></article><div><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<div><p>{LONG}</p><p>{LONG}</p></div><article><p>{LONG}</p></article>", f"{LONG}\n\n{LONG}\n\n{LONG}"),
        (f"<article><p>{LONG}</p></article>{CARD}<p>stray line</p>", f"{LONG}\n\nCard\n\nRead about it."),
        (f"<div><h1>Head</h1><p>{LONG}</p></div>", f"Head\n\n{LONG}"),
    ],
)
def test_main_text_where_articles_mislead(page, text):
    assert htmltext.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main class='with-sidebar'><p>a b</p></main>", "a b"),
        ("<div class='layout has-comments'><article class='post no-header'><p>a b</p></article></div>", "a b"),
        ("<div class=sidebar><main class=menu><p>a b</p></main></div><aside><article>c</article></aside>", "a b"),
        ("<form id=page><article><p>a b</p></article><div class=related><article>c</article></div></form>", "a b"),
        ("<article><div class='post-header'><h1>Head</h1></div><div class=header><p>by X</p></div><p>a</p></article>", "Head\n\nby X\n\na"),
        ("<article><p aria-hidden='false'>a</p><p style='overflow:hidden'>b</p><p class='overflow-hidden'>c</p></article>", "a\n\nb\n\nc"),
        ("<article><p><a title='the hidden garden' data-x='display:none'>a</a></p><p data-hidden=1>b</p></article>", "a\n\nb"),
        ("<article><p>a</p><p hidden>b</p><p aria-hidden=true>c</p><p style='color:red; DISPLAY : none'>d</p></article>", "a"),
        ("<article><p>a</p><div class='x cookie-banner'>b</div><div id=\"comments\">c</div><p role=navigation>d</p></article>", "a"),
    ],
)
def test_main_text_skips_marked_and_hidden_only(page, text):
    assert htmltext.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<h1>Head</h1><div class=ad>b</div><p>{LONG}</p><form>f</form><p>The end of it.</p>", f"Head\n\n{LONG}\n\nThe end of it."),
        (f"<p>In brief.</p><aside>b</aside><p>{LONG}</p><div class=notice>b</div><p>7</p><nav>n</nav><p>Last words.</p>", f"In brief.\n\n{LONG}\n\n7\n\nLast words."),
        (f"<p><a href='/'>Back home</a></p><div class=ad>b</div><p>{LONG}</p><div class=ad>b</div><p><a href='/'>More of</a> it</p>", LONG),
        (f"<div><p>{LONG}</p></div>{CARD}<div><p>The end of it.</p></div>", f"{LONG}\n\nThe end of it."),
        ("<p><a href='/'>only links</a></p><nav>n</nav><p><a href='/'>and more</a></p>", "only links\n\nand more"),
    ],
)
def test_main_text_is_not_cut_by_what_is_skipped(page, text):
    assert htmltext.main_text(page) == text


MENU = "<div>" + "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in ("Home", "World", "Sport", "Money", "About")) + "</div>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"{MENU}<div><h1>Head</h1><p>{LONG}</p><p>Short.</p></div><div>© 2024 The Site. All rights reserved.</div>", f"Head\n\n{LONG}\n\nShort."),
        (f"<div><a href='/'>Home</a> | <a href='/b'>About us</a></div><div><p>{LONG}</p>{MENU}<p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
        (f"<div><p>{LONG}</p><p><a href='/x'>All of the source</a></p><p>{LONG}</p></div>", f"{LONG}\n\nAll of the source\n\n{LONG}"),
        *[
            (f"<div><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div><p>The end.</p></div>", f"{LONG}\n\nThe end.")
            for name in ("comment-list", "user-comments", "ad-slot", "site-header", "main-nav", "site-footer", "ad-2 wide", "left_sidebar")
        ],
        (f"<div class='post-footer-less ad-free'><p>{LONG}</p></div>", LONG),
        (f"<article><h1>Head</h1><p>In brief.</p></article><div><p>{LONG}</p></div>", f"Head\n\nIn brief.\n\n{LONG}"),
        (f"<article><p>{LONG}</p><article class=comment><p>Nice.</p></article></article>", LONG),
        (f"<p>{LONG}</p><script>if (a <b) '</p>'", LONG),
    ],
)
def test_main_text_without_marks_or_articles(page, text):
    assert htmltext.main_text(page) == text


def test_main_text_equals_plain_blocks():
    """Surge, dive and threshold by plain loops over the same lines, on random pages without articles."""
    rng = random.Random(3)
    for _ in range(400):
        page = ""
        for _ in range(rng.randrange(1, 25)):
            words = " ".join(rng.choice(("ab", "cde", "f")) for _ in range(rng.choice((1, 3, 40, 200))))
            page += rng.choice(("<p>{}</p>", "<p><a href=x>{}</a></p>", "<div></div></div><p>{}", "<nav>{}</nav>", "<h2>{}</h2>", "<td></td><td></td>{}")).format(words)
        assert htmltext.main_text(page) == brute.line_block_text(htmltext.lines(page), htmltext.WINDOW, htmltext.SHARE), page


@pytest.mark.parametrize("piece", ["<nav>", "<div class=ad>", "<article>", "<!--", "<a<", "<script>", "<p hidden>", "</nav><nav>x", "<x class=ad><p>y</p>", "<div class=ad><article>y</article>"])
def test_main_text_takes_time_with_the_length_of_a_page(piece):
    start = time.perf_counter()
    htmltext.main_text(f"<p>{LONG}</p>" + piece * 40_000)
    assert time.perf_counter() - start < 10


def test_blocks_meet_where_their_ranges_are_near(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        low = rng.uniform(-1, 1)
        rows.append((i, rng.choice("ab"), 4, low, low + rng.choice((0.0, 0.01, 0.3))))
    df = spark.createDataFrame(rows, "block long, label string, dim int, low double, high double")
    for reach in (0.0, 0.02, 0.4):
        got = neighbours._close_blocks(df, reach).collect()
        near = lambda x, y: x[1] == y[1] and x[3] <= y[4] + reach and y[3] - reach <= x[4]
        want = {(x[0], y[0]) for x in rows for y in rows if x[0] <= y[0] and near(x, y)}
        assert len(got) == len(want) and {(r.x_block, r.y_block) for r in got} == want


def test_main_text_frames(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "<p>x</p>", "a"), (1, "<p>x</p>", "a")], "page_id int, html string, text string")
    assert sorted(r.text for r in htmltext.extract_main_text(df).collect()) == ["", "x", "x"]
    assert htmltext.extract_main_text(df.limit(0)).count() == 0


# --- 8 shards


def test_shards(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice([None, 5, *range(50)]), "é" * rnd.randint(0, 40)) for _ in range(700)]
    df = docs(spark, rows).repartition(6)
    got = sharding.shard_by_bytes(df, "doc_id", F.octet_length(F.coalesce("text", F.lit(""))) + 1, 8, {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == 700
    target, largest = sum(r.size for r in got) / 8, max(r.size for r in got)
    keys = []
    for shard in range(8):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - target) <= largest
        keys += [-1 if r.doc_id is None else r.doc_id for r in own]
    assert keys == sorted(keys)


def test_shards_edges(spark):
    size = F.octet_length("text")
    assert sharding.shard_by_bytes(docs(spark, []), "doc_id", size, 8, {}).count() == 0
    got = sharding.shard_by_bytes(docs(spark, [(1, None), (2, "")]), "doc_id", size, 8, {}).collect()
    assert [(r.shard, r.size) for r in got] == [(0, 0)] * 2


# --- 10 vectors


def test_vectors_as_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 16))
    vecs = [b + rng.normal(size=16) * s for b in base for s in (0, 0.05, 0.12, 0.16, 0.2)]
    vecs += [vecs[3]] * 30 + [2 * vecs[4]] * 3
    rows = [(i, [float(x) for x in v], i % 3 if i % 11 else None) for i, v in enumerate(vecs)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [None] * 16, 1), (n + 4, [], 1), (n + 5, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int")
    want, edges = {r[0]: 0 for r in rows}, []
    for a, b in itertools.combinations(rows[:n], 2):
        if a[2] is not None and a[2] == b[2]:
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                want[a[0]] += 1
                want[b[0]] += 1
                edges.append((a[0], b[0]))
    root = brute.roots(want, edges)
    got = {r.vec_id: (r.n_links, r.component) for r in neighbours.near_vectors(df, "vec_id", "v", "label", block=32).collect()}
    assert got == {i: (want[i], root[i]) for i in want}
    assert neighbours.near_vectors(df.limit(0), "vec_id", "v", "label").count() == 0


def test_vectors_of_repeated_keys(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (1, [0.0, 1.0], "b"), (2, [1.0, 0.01], "a"), (3, [0.01, 1.0], "a"), (4, [0.02, 1.0], "b"), (1, None, "a"), (5, [-1.0, 0.0], "a")]
    df = spark.createDataFrame(rows + [(0, [0.0, 2.0], "a")], "vec_id long, v array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component) for r in neighbours.near_vectors(df, "vec_id", "v", "label").collect())
    assert got == [(0, 2, 0), (1, 0, 1), (1, 1, 1), (1, 1, 1), (1, 2, 0), (2, 1, 1), (3, 2, 0), (4, 1, 1), (5, 0, 5)]


def test_calibrated_count():
    counts = [neighbours.calibrated_count(r) for r in (0.9, 0.99, 0.9999)]
    assert counts == sorted(counts, reverse=True) and 10 < counts[-1] < counts[0] < 24


def test_collisions_count_windows():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(30, 24)), rng.normal(size=(20, 24))
    want = (np.abs(x[:, None] - y[None]) <= 0.3).sum(axis=2)
    assert (neighbours._collisions(x, y, 0.3) == want).all()


