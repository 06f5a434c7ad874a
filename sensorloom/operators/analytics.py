"""Counts, ranges, sums, event-time windows and distributions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.predicates import instant_literal


def on_day(df: DataFrame, ts: str, day: dt.date | None = None) -> DataFrame:
    """Rows of one calendar day, by default the day on which the query or micro-batch runs.

    The filter is a half-open time range, so files outside the day are skipped by their statistics.
    """
    start = F.current_date() if day is None else F.lit(day)
    low = instant_literal(df, ts, start)
    high = instant_literal(df, ts, F.date_add(start, 1))
    return df.where((F.col(ts) >= low) & (F.col(ts) < high))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_by(df: DataFrame, *keys: str, ordered: bool = True) -> DataFrame:
    """Rows per key. A stream can be ordered in complete mode only."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.orderBy(*keys) if ordered else counts


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def daily_sum(df: DataFrame, ts: str, value: str, name: str = "power") -> DataFrame:
    return df.groupBy(F.col(ts).cast("date").alias("day")).agg(F.sum(value).alias(name))


def window_mean(
    df: DataFrame,
    id: str,
    ts: str,
    value: str,
    width: str = "10 minutes",
    late: str | None = "1 hour",
    name: str = "mean_velocity",
) -> DataFrame:
    """Mean of ``value`` per device and tumbling event-time window.

    Columns: ``id``, ``window`` (start, end) and ``name``; the mean column really carries that name.
    In a stream, ``late`` bounds the state: append mode emits a window once the watermark has passed
    it, update mode re-emits it, and complete mode keeps every window and drops nothing.
    Rows are combined per task before the shuffle, so a hot device costs no more than any other.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if df.isStreaming and late is not None:
        df = df.withWatermark(ts, late)
    return df.groupBy(F.col(id), F.window(ts, width)).agg(F.avg(value).alias(name))


def window_series(means: DataFrame, ids: Sequence | None = None, id: str = "id") -> DataFrame:
    """Window means flattened to ``window_start``, for the devices ``ids`` or for all."""
    if ids is not None:
        means = means.where(F.col(id).isin(list(ids)))
    others = [c for c in means.columns if c not in (id, "window")]
    return means.select(id, F.col("window.start").alias("window_start"), *others)


def top_k(df: DataFrame, by: str | Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first rows, by a column descending or by given orderings.

    Each task keeps ``k`` rows, so ``k`` has to be report-sized.
    """
    order = [F.col(by).desc()] if isinstance(by, str) else list(by)
    return df.orderBy(*order).limit(k)


def spread(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Mean, standard deviation and range of ``cols`` per value of ``by``, in one pass."""
    parts = []
    for c in cols:
        parts += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_sd"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.groupBy(by).agg(F.count("*").alias("n"), *parts)
