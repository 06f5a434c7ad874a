"""Documents to packed training sequences: quality, near copies, benchmark leaks, secrets, packing.

Every stage takes the documents its predecessor kept and returns documents with the same columns; the last
one returns packed pieces. Each result is a table of its own, so a stage never recomputes an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import decontaminate, forest, packing, quality, secrets
from sensorloom.llm.common import discard, stage, table, vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the rest goes."""
    return quality.keep(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near copies (five words, Jaccard 0.8)."""
    return forest.keep_one(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate.keep(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` is that of the new text."""
    found = secrets.redact(docs.select(*COLUMNS))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 tokens with their ids."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# A trained model, hashed signatures and a tokenizer: no SQL gives these rows. tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        done = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(docs)
        docs = done
    return docs
