"""Registered queries against their SQL or brute force, and the pipeline stage by stage."""

import hashlib
import zlib

import brute
import public_tokenizers
import pytest
import sentencepiece
from oracle import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from tagmill.llm.queries import QUERIES, SQL
from tagmill.session import materialize

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    same, extra, missing, _ = compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name])
    assert same and not extra and not missing, (list(extra)[:3], list(missing)[:3])


def test_quality_query_computes_the_other_measures_in_the_cascade(spark):
    plan = QUERIES["op4_quality_cascade"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "n_capitals" not in plan and "n_lines" not in plan
    assert plan.count("[A-Z]") == 1 and plan.index("CASE WHEN") < plan.index("[A-Z]")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_query(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in QUERIES["op2_pieces"](spark, FOLDER).collect():
        ids = lib.encode(texts[r.doc_id] or "")
        want = (len(ids), digest(",".join(map(str, ids))), digest(lib.decode(ids)))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_secrets_query(spark, texts):
    for r in QUERIES["op3_secret_scan"](spark, FOLDER).collect():
        spans = brute.base_spans(texts[r.doc_id])
        assert r.base_sha256 == digest(",".join(spans)) and set(spans) <= set(r.spans.split(",") if r.spans else [])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]


def test_shards_query(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_byte_shards"](spark, FOLDER).collect()}
    total, before = sum(len((t or "").encode()) + 1 for t in texts.values()), 0
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law) == (len(data) + 1, zlib.crc32(data), "bytes")
        assert got[i].shard == min(7, int((before + (len(data) + 1) / 2) / total * 8))
        before += len(data) + 1


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op9_language"](spark, FOLDER).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.95 * len(rows)
    scored = QUERIES["op6_toxicity"](spark, FOLDER).collect()
    assert len(scored) == len(langs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)


def test_pipeline_stages(spark, texts):
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, FOLDER), "stage")
        rows = {r.doc_id: r for r in docs.collect()}
        came = {r.doc_id: r.text for r in before.collect()}
        assert rows.keys() <= came.keys() and (name == "packing" or docs.columns == columns)
        kept[name] = rows
        if name == "n-gram Jaccard join":
            assert rows.keys() == {i for i, (_, root) in brute.jaccard(came).items() if root == i}
        if name == "secret scans":
            assert rows.keys() == came.keys()
            assert all((r.text == came[i]) == (not brute.base_spans(came[i])) for i, r in rows.items())
            assert all(r.n_chars == len(r.text) for i, r in rows.items() if r.text != came[i])
        if name == "packing":
            assert rows.keys() == came.keys()
    good = {r.doc_id for r in QUERIES["op4_quality_cascade"](spark, FOLDER).collect() if r.kept}
    assert kept["quality rules"].keys() == good
    assert len(kept["toxicity"]) >= 0.8 * len(good)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), "empty")
    assert docs.count() == 0


def test_pipeline_with_nulls_and_repeats(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    text = " ".join(f"w{i} {w}" for i, w in enumerate((long * 6).split()))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (5, text.replace("w0 ", "token=abcdef123 ", 1))]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), "nulls")
        if name == "n-gram Jaccard join":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    assert docs.count() == 2


def test_near_duplicates_of_repeated_ids(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcd"}
    near = texts["a"] + " tail"
    rows = [(1, texts["a"]), (2, texts["b"]), (2, near), (3, texts["c"]), (3, texts["d"]), (3, texts["d"]), (4, None), (4, ""), (None, near)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()]
    assert sorted(got, key=str) == sorted((row for row in dict.fromkeys(rows) if row != (2, near)), key=str)


def test_main_text_query(spark):
    """The given pages hold one article each; its text is read with another parser."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op7_main_text"](spark, FOLDER).collect()}
    assert len(found) == len(pages)
    for page in pages:
        want = brute.article_text(page.html)
        got = found[page.page_id]
        assert (got.url, got.text, got.n_chars) == (page.url, want, len(want))
