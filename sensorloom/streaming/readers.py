"""Streaming sources."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.records import try_number

# Fixed value: how the connector that ships with Spark spells the start position.
START_OPTIONS = {"kafka": "startingOffsets"}


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    infer: bool = False,
    **options: Any,
) -> DataFrame:
    """Every file below ``path`` once, as it arrives; ``max_files`` bounds a micro-batch.

    ``infer=True`` takes the schema from the files present at the start: footers for parquet, a scan
    for JSON (``samplingRatio`` shortens it).
    """
    if schema is None:
        if not infer:
            raise ValueError("give a schema, or infer=True to take it from the present files")
        schema = spark.read.format(fmt).options(**options).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def connect(spark: SparkSession, connector: str, start: str = "earliest", **options: Any) -> DataFrame:
    """A message stream by connector name. The connector's jar comes from the cluster.

    ``start`` is translated for connectors in :data:`START_OPTIONS`; others take it among ``options``.
    """
    if start not in ("earliest", "latest"):
        raise ValueError("start is earliest or latest")
    if connector in START_OPTIONS:
        options = {START_OPTIONS[connector]: start, **options}
    return spark.readStream.format(connector).options(**options).load()


def message_stream(df: DataFrame, key: str = "partitionKey", data: str = "data") -> DataFrame:
    """Connector records to raw ``(key double, value string)`` records.

    A key that is no number becomes NULL and is left to the quality rules.
    """
    return df.select(try_number(key).alias("key"), F.col(data).cast("string").alias("value"))


def table_stream(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """A table as a stream of its new files."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.table(name)
