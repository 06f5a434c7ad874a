"""Corrections as frame transforms: delete, insert-only merge, difference of two states."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.predicates import as_column


def delete_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows for which the predicate is not TRUE; a NULL predicate keeps the row."""
    predicate = as_column(predicate)
    return df.where(~predicate | predicate.isNull())


def new_rows(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``source`` without a partner in ``target``.

    NULL keys never match, so such rows are all new, and so are all copies of an unmatched row. The
    target is first cut to keys that the source has (where those are few, they are broadcast and the
    target is not shuffled), then to distinct ones; hot keys are split at run time.
    """
    asked = source.select(*on).distinct()
    held = target.select(*on).join(asked, list(on), "left_semi").distinct()
    return source.join(held, list(on), "left_anti").select(*source.columns)


def merge_insert(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Target rows plus the unmatched source rows."""
    return target.unionByName(new_rows(target, source, on))


def append_null_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def row_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Difference of two states of a table.

    Whole rows are counted on both sides and the surplus is the change, so NULLs compare equal,
    repeated rows are right, and no group holds more than a pair of counts. A key that loses exactly
    one row and gains exactly one is an update (``update_pre``, ``update_post``); other surplus rows
    are ``delete`` or ``insert``. A NULL key has no identity and is never an update. Columns: those
    of the table, ``_change`` and ``_copies`` (how often the row was added or removed).
    """
    columns = list(before.columns)
    tagged = before.withColumn("_side", F.lit(-1)).unionByName(after.withColumn("_side", F.lit(1)))
    return classify(tagged, "_side", columns, keys)


def classify(tagged: DataFrame, side: str, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """:func:`row_changes` of rows tagged -1 (lost) and 1 (won) in the column ``side``."""
    surplus = tagged.groupBy(*columns).agg(F.sum(side).alias("_net")).where("_net <> 0")
    names = [f"_key{i}" for i in range(len(keys))]
    per_key = surplus.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        F.sum(F.when(F.col("_net") < 0, -F.col("_net"))).alias("_lost"),
        F.sum(F.when(F.col("_net") > 0, F.col("_net"))).alias("_won"),
    )
    pairs = per_key.where("_lost = 1 AND _won = 1").select(*names, F.lit(True).alias("_paired"))
    # A null-safe match filters neither side, so both sides are the same plan up to the exchange of
    # the whole-row counts, and the engine runs it once.
    matched = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    update = F.coalesce("_paired", F.lit(False)) & reduce(and_, [F.col(k).isNotNull() for k in keys])
    change = (
        F.when(update, F.when(F.col("_net") < 0, "update_pre").otherwise("update_post"))
        .otherwise(F.when(F.col("_net") < 0, "delete").otherwise("insert"))
    )
    return surplus.join(pairs, matched, "left").select(
        *columns, change.alias("_change"), F.abs("_net").alias("_copies")
    )
