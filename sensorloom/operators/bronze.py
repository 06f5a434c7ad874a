"""Raw records: stamping, union, one row per key, and message batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.hashing import row_salt
from sensorloom.functions.records import encode
from sensorloom.operators.features import sample


def stamp(df: DataFrame, col: str = "TIMESTAMP", at: dt.datetime | None = None) -> DataFrame:
    """Set ``col`` to the time of the query (of the micro-batch in a stream), or to ``at``."""
    value = F.current_timestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp")
    return df.withColumn(col, value)


def union_sources(*dfs: DataFrame) -> DataFrame:
    """All rows of all sources, matched by column name: sources may order columns differently."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] | None = None,
    within_watermark: bool = False,
    salt: int = 1,
) -> DataFrame:
    """One row per key.

    With ``order`` it is the first row in that order; the engine keeps one row per key and task
    before the shuffle, so a hot key stays small. Without it the row is arbitrary. A stream keeps the
    first row that arrives; after ``withWatermark``, ``within_watermark=True`` bounds its state, and
    ``salt`` thins out hot keys in that many tasks before the rest meets in one.
    """
    if df.isStreaming:
        if order is not None:
            raise ValueError("a stream keeps the first row that arrives; order is not possible")

        def first(rows: DataFrame, cols: list[str]) -> DataFrame:
            return rows.dropDuplicatesWithinWatermark(cols) if within_watermark else rows.dropDuplicates(cols)

        if salt > 1:
            df = first(df.withColumn("_salt", row_salt(df, salt)), [*keys, "_salt"]).drop("_salt")
        return first(df, list(keys))
    if order is None:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def make_messages(
    df: DataFrame,
    fraction: float,
    cap: int,
    id_col: str = "ID",
    key: str | Column = "key",
    seed: int = 0,
    order: Sequence[str] | None = None,
    at: dt.datetime | None = None,
    ts: str = "TIMESTAMP",
    method: str = "xxhash64",
) -> DataFrame:
    """A batch of at most ``cap`` messages: sample, cap, one per device, stamp, encode.

    ``order`` (unique columns) makes the batch repeatable; without it cap and choice are arbitrary.
    """
    if order is None:
        picked = df.sample(fraction, seed=seed).limit(cap)
        unique = dedup(picked, [id_col])
    else:
        picked = sample(df, fraction, seed, key=order[0], method=method).orderBy(*order).limit(cap)
        unique = dedup(picked, [id_col], list(order))
    stamped = stamp(unique, ts, at)
    return encode(stamped, key, stamped.columns)
