"""A corpus pipeline over ``documents``: each stage works on what the stage before it kept.

The quality classifier rejects documents, near duplicates leave one document of each group,
contaminated documents go, secrets are replaced, and what is left is encoded and decoded.

Stages take and return the columns of the documents they are given, whatever further columns those
have; the last returns token counts and digests. Decisions name rows, not ids: a stage knows a row by the file
and place it is read from, so rows that repeat an id, or have none, are judged each by its own text. Of
a class of near duplicates the row of the smallest id stays (null is the smallest), of several the first in the files' order.
Null and empty texts are documents without words. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm import bpe, decontamination, quality, secrets, simhash
from palaver.llm.common import numbered, small_batches, table
from palaver.session import PLAIN, fresh_path, materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.3 or more)."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fitted(spark, sf_dir, docs))


def _without(rows: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``rows`` without those that ``gone`` names (``row``, distinct)."""
    # names compress to a byte or two, and would be broadcast by the million
    listed = materialise(gone.select(F.col("row").alias(name)), "gone", options=PLAIN)
    return rows.join(listed, name, "left_anti").drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints within four bits (shingles of four words): the one of the smallest id."""
    small_batches(spark)
    rows, name = numbered(docs, "pipeline-docs")
    named = rows.select(F.struct(F.col("doc_id").alias("id"), F.col(name).alias("row")).alias("key"), "text")
    found = materialise(simhash.near_duplicates(named, key="key", shingle=4, max_bits=4), "pipeline-classes")
    return _without(rows, found.where("key.row <> component_id.row").select("key.row"), name)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty lie in a phrase of the benchmark."""
    small_batches(spark)
    rows, name = numbered(docs, "pipeline-docs")
    named = rows.select(F.col(name).alias("row"), "text")
    found = decontamination.contamination(named, table(spark, sf_dir, "benchmark"), key="row")
    return _without(rows, found.where("contaminated").select("row"), name)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced, and ``n_chars`` (where there is one) counted again."""
    path = F.col("source") if "source" in docs.columns else None
    found = secrets.scan(docs, path=path)
    clean = secrets.redact(docs, found)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").contains("[SECRET]"), size).otherwise(F.col("n_chars")))
    return clean


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text decoded from them."""
    small_batches(spark)
    return bpe.digests(docs, bpe.vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

#: SQL cannot express the classifier, the fingerprints, the forest or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
