"""Corpus pipeline over ``documents``: drop low quality, drop exact copies,
keep one document of each near-duplicate group, mix the sources to target
weights, encode.

Each stage is a function of (spark, docs, sf_dir). ``run`` writes its result
as Parquet in the shared folder and rereads it as the next stage's docs, so a
lost executor costs at most the running stage. All stages but the last return
the columns of ``documents``. None of them can fail on nulls, empty texts,
repeated rows or extra columns; what happens to such rows is stated by the
operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.llm import byte_bpe, exact_dedup, mixing, nbsvm, ngram_join
from trafficlens.llm.queries import vocabulary
from trafficlens.runtime import scratch_path

QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3. The model is fitted on
    labelled documents outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = nbsvm.fit(docs, labels, held_out=nbsvm.crc_fold("_id") == 0)
    return docs.where(nbsvm.scorer(docs, model)("text") >= QUALITY_THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (but for the case of A-Z) the one with the
    largest id."""
    return exact_dedup.keep_one(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a 5-gram similarity of 0.8 the one with the
    smallest id."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix plays it (0 to 3 times), in the order of the mix."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text."""
    code = byte_bpe.coder(spark, vocabulary())
    coded = docs.select("doc_id", "source", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("raw"), code("text").alias("coded"))
    same = F.col("coded.decoded") == F.col("raw")
    return coded.select("doc_id", "source", F.size("coded.ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "coded.ids")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_duplicates", near), ("mix", mix), ("encode", encode)]

# The classifier's fit and the posterior pruning have no SQL form; the tests
# hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
