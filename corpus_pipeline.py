"""Training-data pipeline over ``documents``: the stages in order, and their run.

Quality rules and toxicity drop documents, the n-gram join keeps one document of each
group of near-duplicates (the one with the smallest id), secrets are masked in the text,
and packing plans the batches.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.llm.frames import matched
from tagmill.llm.jaccard import ngram_jaccard
from tagmill.llm.packing import pack
from tagmill.llm.quality import WORD, quality_cascade
from tagmill.llm.samples import held_out
from tagmill.llm.secrets import masked, scan_secrets
from tagmill.llm.toxicity import fit_toxicity, score_toxicity
from tagmill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a NULL or empty text is rejected as short."""
    return quality_cascade(docs, "text", COLUMNS).where("rejected_by is null").select(COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language.

    The network learns from labelled documents of its input, without those that the
    query ``op6_toxicity`` holds out.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = fit_toxicity(docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    return score_toxicity(docs, net, keep=COLUMNS).where("not flagged").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.75 or more.

    Documents without words or without an id stay.  Rows that repeat an id with another
    text are documents of their own, judged by their own text; of rows that repeat both
    one stays.
    """
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return _near_duplicates_by_row(docs)
    found = materialize(ngram_jaccard(docs.select("doc_id", "text")), "groups")
    gone = found.where("component <> doc_id").select("doc_id").distinct()
    return matched(docs.select(COLUMNS), gone, "doc_id", how="left_anti").select(COLUMNS)


def _near_duplicates_by_row(docs: DataFrame) -> DataFrame:
    """As above with a number for each id and text; the smallest id, then text hash, of a group stays."""
    hashed = docs.where("doc_id is not null").select(*COLUMNS, F.coalesce(F.sha2("text", 256), F.lit("")).alias("hash"))
    rows = materialize(hashed.dropDuplicates(["doc_id", "hash"]).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = ngram_jaccard(rows.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row")
    named = found.join(rows.select("row", "hash", F.col("doc_id").alias("id")), "row")
    kept = materialize(named.groupBy("component").agg(F.min(F.struct("id", "hash", "row")).alias("first")).select("first.row"), "first")
    return matched(rows, kept, "row").select(COLUMNS).unionAll(docs.where("doc_id is null").select(COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in the text replaced by its kind in brackets."""
    found = scan_secrets(docs, "text", COLUMNS)
    text = masked(F.col("text"), F.col("secrets"))
    return found.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document; words stand for tokens."""
    return pack(docs, "doc_id", F.regexp_count("text", F.lit(WORD)), buckets=16, budget=65_536, keep=["lang", "source"])


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]
# The network has no SQL form; tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
