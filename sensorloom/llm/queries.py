"""Queries of the text operators, one per operator, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import (
    arrow_file, decontaminate, forest, mixing, negatives, packing, periods, quality, repeats, secrets, shards, toxicity, vamana,
)
from sensorloom.llm.common import table, vocabulary_path
from sensorloom.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), vocabulary_path()))


@query
def op10_arrow_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = arrow_file.write_sequences(
        table(spark, sf_dir, "documents"), scratch(spark, "sequences"), vocabulary_path())
    return arrow_file.read_documents(manifest)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op2_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, drawn = quality.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "log_weight", "draw", "rank")


@query
def op1_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@query
def op4_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.classes(table(spark, sf_dir, "documents").select("doc_id", "text")) \
        .select("doc_id", "class_id", "n_links")


@query
def op3_vamana_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(table(spark, sf_dir, "embeddings"))


def relabelled(column: str = "label") -> Column:
    """The label, one further (of ten) where vec_id is divisible by 7: noise that makes some positives wrong."""
    return F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col(column) + 1) % 10).otherwise(F.col(column))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.whole_rows(table(spark, sf_dir, "embeddings"), relabelled())
    return negatives.mine(rows, F.pmod("vec_id", F.lit(100)) == 0)


SQL["op11_hard_negatives"] = """
    WITH numbers AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
        FROM numbers a JOIN numbers r ON len(a.v) = len(r.v) AND a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (
        SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""


@query
def op12_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(periods.plant(table(spark, sf_dir, "documents")))
