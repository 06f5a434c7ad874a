"""Joins of readings with the device status table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.hashing import every_salt, row_salt

STREAM_SALT = 8


def assert_unique(df: DataFrame, on: str) -> DataFrame:
    """Return ``df`` if no value of ``on`` occurs twice; a repeated id would multiply readings."""
    repeated = df.where(F.col(on).isNotNull()).groupBy(on).count().where("count > 1").select(on).take(5)
    if repeated:
        raise ValueError(f"{on} is not unique, for example {[row[0] for row in repeated]}")
    return df


def label(readings: DataFrame, status: DataFrame, on: str = "id", salt: int | None = None) -> DataFrame:
    """Every reading with the status of its device, NULL where there is none; ``on`` comes first.

    Works on a batch or a stream of readings against a static status table. No broadcast is forced:
    the engine broadcasts the status table only below its size threshold. Otherwise both sides
    are shuffled on the id; a batch query splits hot ids at run time. A stream does not, so there
    ``salt`` (:data:`STREAM_SALT` unless given) spreads each id over that many tasks and repeats the status rows.
    """
    if salt is None:
        salt = STREAM_SALT if readings.isStreaming else 1
    if salt <= 1:
        return readings.join(status, [on], "left")
    salted = readings.withColumn("_salt", row_salt(readings, salt))
    copies = status.withColumn("_salt", every_salt(salt))
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")


def join_hinted(a: DataFrame, b: DataFrame, on: str, hint: str = "shuffle_merge") -> DataFrame:
    """Inner equi join with the strategy named by ``hint`` applied to ``b``."""
    return a.join(b.hint(hint), [on], "inner")
