"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.llm.collocations import collocations
from tagmill.llm.htmltext import extract_main_text
from tagmill.llm.jaccard import ngram_jaccard
from tagmill.llm.language import fit_languages, identify_languages
from tagmill.llm.neighbours import near_vectors
from tagmill.llm.packing import pack, pack_sql
from tagmill.llm.pieces import decode, encode
from tagmill.llm.quality import MEASURES, RULES, bound, cascade_order, first_rejection, words_of
from tagmill.llm.samples import held_out
from tagmill.llm.secrets import BASE, listed, scan_secrets
from tagmill.llm.sharding import shard_by_bytes
from tagmill.llm.simhash import document_prints
from tagmill.llm.spelling import spelling_variants, word_counts
from tagmill.llm.toxicity import fit_toxicity, score_toxicity

QUERIES = {}
SQL = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORD = r"[^\x20\x09-\x0D]+"


@query
def op1_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Words stand for tokens; any length column serves."""
    documents = table(spark, folder, "documents")
    return pack(documents, "doc_id", F.regexp_count("text", F.lit(WORD)), buckets=16, budget=65_536)


SQL["op1_length_buckets"] = pack_sql(
    r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents", "doc_id", 16, 65_536
)


@query
def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = decode(encode(table(spark, folder, "documents"), model, keep=["doc_id"]), model)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"), "text", ["doc_id"])
    spans = F.col("secrets")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["place"] < len(BASE))
    return found.select(
        "doc_id", *[count(rule.kind) for rule in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


@query
def op4_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """The measures asked for are columns; the others are computed only as far as the cascade gets."""
    documents = table(spark, folder, "documents")
    order = cascade_order(documents, "text", RULES)
    asked = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    text = F.coalesce("text", F.lit(""))

    def judged(words):
        def verdict(m):
            failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
            rejection = first_rejection(order, lambda n: m[n] if n in asked else MEASURES[n](text, words))
            kept = ~failed & rejection.isNull()
            return F.struct(*[m[n].alias(n) for n in asked], failed.alias("base_failed"), kept.alias("kept"))

        return bound(F.struct(*[MEASURES[n](text, words).cast("long").alias(n) for n in asked]), verdict)

    return documents.select("doc_id", bound(words_of(text), judged).alias("found")).select("doc_id", "found.*")


SQL["op4_quality_cascade"] = r"""WITH w AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS t(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, unnest([0, 1, 2]) AS u(j) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_capitals > word_chars OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b"""


@query
def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_jaccard(table(spark, folder, "documents"), "doc_id", "text", size=5, percent=75)
    return found.withColumnRenamed("component", "component_id")


SQL["op5_ngram_jaccard"] = r"""WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = held_out(F.col("doc_id"), 4, 2)
    net = fit_toxicity(documents, labels, ~held)
    found = score_toxicity(documents, net, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged")


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_main_text(table(spark, folder, "pages"), "html", ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    kept = {"doc_id": F.col("doc_id"), "text_crc32": F.crc32(text)}
    dealt = shard_by_bytes(documents, "doc_id", F.octet_length(text) + 1, 8, kept)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held = held_out(F.col("doc_id"), 3, 1)
    model = fit_languages(documents.where(~held))
    found = identify_languages(documents, model, keep=["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op10_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = near_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", cosine=0.98)
    found = found.withColumnRenamed("component", "component_id")
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


SQL["op10_near_vectors"] = """WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a
  JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT r.x AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.y) AS component_id, min(r.y) = r.x AS kept
FROM reach r LEFT JOIN n ON n.x = r.x GROUP BY r.x"""


@query
def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return document_prints(table(spark, folder, "documents"), "doc_id", "text", radius=6)


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, folder, "documents"), "doc_id", "text"))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
