"""Relational databases. The driver jar comes from the cluster."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _options(url: str, table: str, options: dict[str, Any]) -> dict[str, Any]:
    split = {"partitionColumn", "lowerBound", "upperBound"} & set(options)
    if split and (len(split) < 3 or "numPartitions" not in options):
        raise ValueError("a parallel read needs partitionColumn, lowerBound, upperBound and numPartitions")
    return {"url": url, "dbtable": table, **options}


def read_jdbc(spark: SparkSession, url: str, table: str, **options: Any) -> DataFrame:
    """Read a table. Filters and column choice are sent to the database.

    Without ``partitionColumn`` one task reads everything, which suits a status table only. With it
    (and bounds and ``numPartitions``) the read is split; the bounds shape the split and drop no row.
    """
    return spark.read.format("jdbc").options(**_options(url, table, options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: Any) -> None:
    """Write a table; ``numPartitions`` bounds the number of open connections."""
    df.write.format("jdbc").options(**_options(url, table, options)).mode(mode).save()
