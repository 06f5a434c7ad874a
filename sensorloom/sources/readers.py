"""Batch reads of files, tables and JSON literals."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorloom.functions.records import decode
from sensorloom.operators.evolution import observed_schema


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Read files by path. ``fmt="text"`` gives raw lines.

    JSON without a schema costs one extra pass over the files; pass ``samplingRatio`` to read fewer
    rows for it, or a schema to skip it.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def from_json_lines(
    spark: SparkSession, rows: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON texts held by the caller as a frame; the schema is inferred if not given."""
    lines = spark.createDataFrame([(row,) for row in rows], "value string")
    return decode(lines, schema or observed_schema(lines))


def table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A saved table by name, or by path when ``name`` contains a slash."""
    return spark.read.format(fmt).load(name) if "/" in name else spark.read.table(name)
