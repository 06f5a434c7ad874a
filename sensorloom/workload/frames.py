"""Telemetry frames derived from the shared test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.records import encode
from sensorloom.schemas import VIBRATION_COLUMNS
from sensorloom.sources import scan
from sensorloom.streaming import file_stream

READING_DDL = "EVENT BIGINT, SPEED DOUBLE, ID DOUBLE, TIMESTAMP TIMESTAMP"
EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
# The supplier table plays the device status: its keys cover part of the ids of the events.
STATUS_SQL = (
    "(SELECT s_suppkey AS id, CASE WHEN s_acctbal < 3000 THEN 'damaged' ELSE 'healthy' END AS status FROM supplier)"
)
FEATURE_SQL = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(VIBRATION_COLUMNS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream. The pattern lets the path be one file or a folder of files."""
    return file_stream(spark, f"{sf_dir}/events.parque[t]", EVENTS_DDL)


def land_files(rows: DataFrame, path: str, least: int, take: int = 2, files: int = 64, batches: int = 16) -> int:
    """Write ``rows`` as files for a stream; returns how many of them a micro-batch takes, ``take`` at least.

    A file holds ``least`` rows, or more where that makes over ``files`` files (and a last one per writing task): a file
    and a micro-batch have their cost in listings and log entries whatever they hold, so they grow with the table
    and their numbers do not. Where many tasks write, a micro-batch takes more of their files.
    """
    count = rows.count()
    size = max(least, -(-count // files))
    rows.write.option("maxRecordsPerFile", size).parquet(path)
    landed = len(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles())
    return max(take, -(-count // (size * batches)), landed // batches)


def readings(events: DataFrame) -> DataFrame:
    """Events as decoded readings: device, time, speed and the event number."""
    return events.select(
        F.col("event_id").alias("EVENT"), F.col("value").alias("SPEED"),
        F.col("user_id").cast("double").alias("ID"), F.col("ts").cast("timestamp").alias("TIMESTAMP"),
    )


def raw(events: DataFrame) -> DataFrame:
    """Events as raw ``(key, value)`` records."""
    return encode(readings(events), F.col("ID"))


def messages(events: DataFrame) -> DataFrame:
    """Events as connector records: binary payload and text key."""
    return raw(events).select(
        F.col("value").cast("binary").alias("data"),
        F.col("key").cast("bigint").cast("string").alias("partitionKey"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") < 3000, "damaged").otherwise("healthy").alias("status"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vibration features with a two-class status."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(VIBRATION_COLUMNS)],
        F.when(F.col("label") == 0, "damaged").otherwise("healthy").alias("status"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a two-class prediction: the label is the error flag, the score is the value."""
    return events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("value") > 10, 1.0).otherwise(0.0).alias("prediction"),
        F.col("value").alias("score"),
    )


def wall_time(col: str) -> Column:
    """A timestamp column without its zone, as other engines read it."""
    return F.col(col).cast("timestamp_ntz").alias(col)
