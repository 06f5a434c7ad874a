"""Samples, splits, class balance and model inputs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.hashing import UNIT, row_hash, unit_bucket
from sensorloom.session import scratch


def sample(
    df: DataFrame, fraction: float, seed: int = 0, key: str | None = None, method: str = "xxhash64"
) -> DataFrame:
    """Each row with probability ``fraction``.

    With ``key`` a row is in or out by its key's hash: the same rows whatever the layout or retry.
    """
    if key is None:
        return df.sample(fraction, seed=seed)
    return df.where(unit_bucket(key, seed, method) < int(fraction * UNIT))


def split(
    df: DataFrame, fractions: Sequence[float], seed: int = 42, key: str | None = None,
    method: str = "xxhash64",
) -> list[DataFrame]:
    """Disjoint parts that cover ``df``, in the given proportions.

    With ``key`` the parts are hash ranges, filters that need no shuffle or sort.
    """
    if key is None:
        return df.randomSplit([float(f) for f in fractions], seed)
    total, low, parts = sum(fractions), 0, []
    bucket = unit_bucket(key, seed, method)
    for i in range(len(fractions)):
        last = i == len(fractions) - 1
        high = UNIT if last else int(sum(fractions[: i + 1]) / total * UNIT)
        inside = (bucket >= low) & (bucket < high)
        parts.append(df.where(F.coalesce(inside, F.lit(last))))
        low = high
    return parts


def shuffle_rows(df: DataFrame, seed: int) -> DataFrame:
    """All rows in random order (a distributed sort)."""
    return df.orderBy(F.rand(seed))


def first_per_group(df: DataFrame, group: str, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group, exact, without sorting a whole group in one task.

    ``order`` has to tell all rows apart. Each round cuts every group by row hash into slices and
    keeps ``k`` rows per slice, with 32 times fewer slices in the next round: the first round spreads
    a group over all shuffle partitions, the others see about ``32 * k`` rows per slice.
    """
    slices = max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = df.withColumn("_slice", row_hash(df))
    while slices:
        window = Window.partitionBy(group, F.pmod("_slice", F.lit(slices))).orderBy(*order)
        df = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")
        slices = 0 if slices == 1 else max(1, slices // 32)
    return df.drop("_slice")


SKETCH = 1024  # size of a quantile sketch; its ranks are off by less than RANK_ERROR of the rows
RANK_ERROR, RANK_STEP = 0.01, 1.05
CLASSES = 1000  # cut-offs that become part of the scan's filter


def within_cut_off(df: DataFrame, group: str, first: str, k: int, rounds: int = 6) -> DataFrame:
    """Rows that can be among the ``k`` smallest by ``first`` of their group: all of those, and about as many others.

    Every round sums up one quantile sketch per group and task, so only sketches are shuffled, and the rows at
    or below the quantile that is sure to hold ``k`` of them go on. A round whose quantile held fewer after all is
    taken back and tried wider. NULLs come first in an order and stay. Rows that share the cut-off value stay too.
    """
    kind = df.schema[first].dataType
    if isinstance(kind, T.IntegralType):
        number, family = F.col(first).cast("bigint"), "bigint"
    elif isinstance(kind, T.FractionalType):
        number, family = F.col(first).cast("double"), "double"
    elif isinstance(kind, T.TimestampType):
        number, family = F.unix_micros(first), "bigint"
    elif isinstance(kind, T.DateType):
        number, family = F.unix_date(first).cast("bigint"), "bigint"
    else:
        return df
    sketch, quantile = (getattr(F, f"kll_sketch_{part}_{family}") for part in ("agg", "get_quantile"))
    ranks = [RANK_ERROR * RANK_STEP ** i for i in range(int(math.log(1 / RANK_ERROR, RANK_STEP)) + 1)]
    cuts: dict = {}  # group -> (largest value that goes on, the cut-off before it)
    slack: dict = {}
    for _ in range(rounds):
        near = _below(df, group, number, cuts)
        seen = F.when(~F.isnan(number), number) if family == "double" else number
        told = near.groupBy(group).agg(F.count(seen).alias("n"), sketch(seen, F.lit(SKETCH)).alias("s"))
        held = told.where(F.col("n") > 0).select(group, "n", quantile("s", F.array(*map(F.lit, ranks))).alias("values")) \
            .limit(CLASSES + 1).collect()
        if len(held) > CLASSES:
            return df
        moved = False
        for row in held:
            key, n, old = row[group], row["n"], cuts.get(row[group])
            share = k / n + slack.get(key, RANK_ERROR)
            cut = next((v for r, v in zip(ranks, row["values"], strict=True) if r >= share), None)
            if old is not None and n < k:  # too narrow: back to the one before, with more room
                cuts[key] = old[1]
                slack[key] = 4 * slack.get(key, RANK_ERROR)
                moved = True
            elif n > 2 * k and cut is not None and (old is None or cut < old[0]):
                cuts[key] = (cut, old)
                moved = True
        cuts = {g: c for g, c in cuts.items() if c is not None}
        if not moved:
            return near
    # The last cut-offs have not been counted yet; those before them have.
    return _below(df, group, number, {g: c[1] for g, c in cuts.items() if c[1] is not None})


def _below(df: DataFrame, group: str, number: Column, cuts: dict) -> DataFrame:
    """Rows at or below the cut-off of their group, by a filter on plain values that reaches the scan."""
    if not cuts:
        return df
    beyond = reduce(lambda a, b: a | b, [F.col(group).eqNullSafe(F.lit(key)) & (number > F.lit(cut[0])) for key, cut in cuts.items()])
    return df.where(~F.coalesce(beyond, F.lit(False)))


def balance(
    df: DataFrame, label: str, cap: int, classes: Sequence | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """At most ``cap`` rows of every class (of ``classes`` only, if given), in one frame.

    With ``order`` (columns that tell all rows apart) the first rows are kept; where the first of them is a
    name of a number, time or date, rows beyond a cut-off of their class are dropped in the scan, so about twice
    ``cap`` rows per class are sorted. Without an order the rows with the smallest hash are kept, and the class sizes
    tell which hashes can matter.
    """
    if classes is not None:
        df = df.where(F.col(label).isin(list(classes)))
    if order is not None:
        near = within_cut_off(df, label, order[0], cap) if isinstance(order[0], str) else df
        return first_per_group(near, label, order, cap)
    return _smallest_hashes(df, label, cap)


def _smallest_hashes(df: DataFrame, label: str, cap: int) -> DataFrame:
    spark, sizes = df.sparkSession, scratch(df.sparkSession, "class-sizes")
    hashed = df.withColumn("_hash", F.pmod(row_hash(df), F.lit(UNIT)))
    df.groupBy(label).agg(F.count("*").alias("_size")).where(F.col("_size") > cap).write.parquet(sizes)
    # Read back as files, whose real size tells the engine whether a broadcast is fine.
    large = spark.read.parquet(sizes).withColumnRenamed(label, "_class")
    slack, short = 1.1, True
    # NULL labels, as a left join leaves them, are a class like any other.
    while short:
        # Copies of one row share a hash, so a share of the hashes can hold too few rows; then widen it.
        limit = F.least(F.lit(1.0), slack * cap / F.col("_size")) * UNIT
        limited = hashed.join(large, F.col(label).eqNullSafe(F.col("_class")), "left")
        near = limited.where(F.col("_size").isNull() | (F.col("_hash") < limit)).drop("_size", "_class")
        kept = near.groupBy(label).agg(F.count("*").alias("_near"))
        found = large.join(kept, F.col(label).eqNullSafe(F.col("_class")), "left")
        # Once a class's limit is the whole range of hashes, all its rows are in.
        short = found.where((F.coalesce("_near", F.lit(0)) < cap) & (limit < UNIT)).limit(1).count() > 0
        slack *= 2
    copies = near.groupBy(*df.columns, "_hash").agg(F.count("*").alias("_copies"))
    kept = first_per_group(copies, label, ["_hash", *df.columns], cap)
    before = F.sum("_copies").over(
        Window.partitionBy(label).orderBy("_hash", *df.columns).rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.lit(cap) - F.coalesce("_before", F.lit(0))
    capped = kept.withColumn("_before", before).withColumn("_take", F.least("_copies", room)).where("_take > 0")
    repeat = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))).alias("_copy")
    return capped.select(*df.columns, repeat).drop("_copy")


def balance_any(df: DataFrame, label: str, cap: int, classes: Sequence) -> DataFrame:
    """At most ``cap`` arbitrary rows of each class: the cheap form, with a plain limit per class."""
    parts = [df.where(F.col(label).eqNullSafe(F.lit(value))).limit(cap) for value in classes]
    return reduce(lambda a, b: a.unionByName(b), parts)


def feature_stages(
    cols: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> Pipeline:
    """Assemble ``cols`` to a vector and divide each by its standard deviation (no centring).

    A NULL feature fails the job, or drops the row (``skip``), or becomes NaN (``keep``).
    """
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="va", handleInvalid=handle_invalid),
        StandardScaler(inputCol="va", outputCol=out),
    ])


def label_index(
    df: DataFrame, col: str, out: str = "label", positive: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Numeric label and the class names by label.

    By default the most frequent class is 0, ties alphabetical, so 1 is the rarer of two. Name the
    ``positive`` class to make it 1 and every other class 0. NULL stays NULL.
    """
    if positive is None:
        model = StringIndexer(inputCol=col, outputCol=out, handleInvalid="keep").fit(df)
        known = df.where(F.col(col).isNotNull())
        return model.transform(known), list(model.labelsArray[0])
    value = F.when(F.col(col) == positive, 1.0).when(F.col(col).isNotNull(), 0.0)
    return df.withColumn(out, value), [f"not {positive}", positive]
