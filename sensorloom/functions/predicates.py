"""Predicates with a settled meaning for NULL, and typed time literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(predicate: str | Column) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def is_true(predicate: str | Column, null_passes: bool = False) -> Column:
    """The predicate as a strict boolean: NULL counts as ``null_passes``."""
    return F.coalesce(as_column(predicate), F.lit(null_passes))


def instant_literal(df: DataFrame, ts: str, value: dt.date | dt.datetime | str | Column) -> Column:
    """``value`` as a literal of the type of column ``ts``.

    Comparing equal types leaves the column bare, so the filter reaches the file scan. Text is
    parsed here, and a date such as month 00 is rejected before any job starts.
    """
    kind = df.schema[ts].dataType
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime) and value.tzinfo and isinstance(kind, T.TimestampNTZType):
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()).cast(kind)
