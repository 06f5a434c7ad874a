"""Why the model scored a row as it did: Shapley values of the boosted trees, as a Spark job.

A tree's margin is a sum over leaves, and a leaf is reached when every feature on its path lies in an
interval. If only the features in S are known, an unknown feature passes with the share z of training
rows that took its branches, so the leaf is worth ``v(S) = value * prod_{S} o_j * prod_{not S} z_j``
with ``o_j`` 1 inside the interval and 0 outside. The Shapley value of such a product is

    phi_i = value * (o_i - z_i) * integral_0^1 prod_{j != i} (t * o_j + (1 - t) * z_j) dt,

a polynomial integral that Gauss-Legendre nodes give exactly. (Path-dependent values of Lundberg et
al., "From local explanations to global understanding with explainable AI for trees", 2020.)
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import scratch

SUFFIX = "_shap_value"

# Ship the code of this module with the tasks, so executors need numpy and pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Leaves:
    """All leaves of all trees: arrays of shape (leaves,) and (leaves, features)."""

    value: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    @property
    def base(self) -> float:
        """Margin with no feature known: the mean margin of the training rows as the trees saw them."""
        return float((self.value * self.share.prod(axis=1)).sum())


def leaves(spark: SparkSession, model: GBTClassificationModel, n_features: int) -> Leaves:
    """Leaf table of a model, read from its saved form. Its size is set by the model, not by data."""
    path = scratch(spark, "trees")
    model.write().save(path)
    nodes: dict[int, dict[int, T.Row]] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(row["treeID"], {})[row["id"]] = row
    out: list[tuple] = []
    for tree, weight in enumerate(model.treeWeights):
        start = (0, np.full(n_features, -np.inf), np.full(n_features, np.inf), np.ones(n_features))
        stack = [start]
        while stack:
            at, low, high, share = stack.pop()
            node = nodes[tree][at]
            if node["leftChild"] < 0:
                out.append((weight * node["prediction"], low, high, share))
                continue
            split = node["split"]
            if split["numCategories"] != -1:
                raise ValueError("categorical splits cannot be explained")
            feature, threshold = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            for child, is_left in ((node["leftChild"], True), (node["rightChild"], False)):
                lo, hi, part = low.copy(), high.copy(), share.copy()
                if is_left:
                    hi[feature] = min(hi[feature], threshold)
                else:
                    lo[feature] = max(lo[feature], threshold)
                part[feature] *= nodes[tree][child]["rawCount"] / node["rawCount"]
                stack.append((child, lo, hi, part))
    value, low, high, share = (np.array(part, dtype=float) for part in zip(*out))
    return Leaves(value, low, high, share)


def shapley_values(x: np.ndarray, table: Leaves) -> np.ndarray:
    """Shapley values of the rows of ``x``: shape (rows, features).

    Only the features on a leaf's path count, so the work per row is leaves times path length.
    """
    used = np.isfinite(table.low) | np.isfinite(table.high)
    length = max(1, int(used.sum(axis=1).max()))
    on_path = np.argsort(~used, axis=1, kind="stable")[:, :length]
    low, high, share = (np.take_along_axis(a, on_path, axis=1) for a in (table.low, table.high, table.share))
    # Per path position: leaf value into the column of the feature at that position.
    into = np.zeros((length, *table.low.shape))
    for at in range(length):
        into[at, np.arange(len(on_path)), on_path[:, at]] = table.value
    points, weights = np.polynomial.legendre.leggauss((length + 1) // 2)
    points, weights = (points + 1) / 2, weights / 2

    out = np.zeros(x.shape)
    step = max(1, 200_000 // len(low))
    for start in range(0, len(x), step):
        rows = x[start:start + step]
        inside = []
        for at in range(length):
            values = rows[:, on_path[:, at]]
            # A missing value (NaN) goes right at every split, as in the trees.
            inside.append(~(values <= low[:, at]) & ((values <= high[:, at]) | np.isinf(high[:, at])))
        without = [np.zeros(inside[0].shape) for _ in range(length)]
        for t, weight in zip(points, weights):
            factors = [t * inside[at] + (1 - t) * share[:, at] for at in range(length)]
            product = weight * reduce(np.multiply, factors)
            for at in range(length):
                without[at] += product / factors[at]
        for at in range(length):
            out[start:start + step] += ((inside[at] - share[:, at]) * without[at]) @ into[at]
    return out


def shap(
    model: GBTClassificationModel, df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
    features: str = "features", dtype: str = "float",
) -> DataFrame:
    """One column ``<feature>_shap_value`` per feature, after the ``keep`` columns.

    ``df`` holds the vector the model was fitted on (``scorer.transform`` adds it). Base value plus
    the values of a row is its margin, ``rawPrediction[1]``. Narrow: no shuffle, batch or stream.
    """
    spark = df.sparkSession
    table = leaves(spark, model, len(cols))
    shared = spark.sparkContext.broadcast((table.value, table.low, table.high, table.share))
    names = [f"{c}{SUFFIX}" for c in cols]
    vector = vector_to_array(features)
    inputs = df.select(*keep, *[vector[i].alias(f"_x{i}") for i in range(len(cols))])
    kind = {"float": T.FloatType(), "double": T.DoubleType()}[dtype]
    schema = T.StructType(
        [f for f in inputs.schema.fields if f.name in keep]
        + [T.StructField(n, kind) for n in names]
    )
    kept = list(keep)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[[f"_x{i}" for i in range(len(names))]].to_numpy(dtype=float)
            values = pd.DataFrame(shapley_values(x, Leaves(*shared.value)), columns=names, index=batch.index)
            yield pd.concat([batch[kept], values], axis=1)

    return inputs.mapInPandas(compute, schema)


def importances(spark: SparkSession, model: GBTClassificationModel, cols: Sequence[str]) -> DataFrame:
    """Feature importances of the model, largest first, compared as numbers."""
    rows = [(c, float(w)) for c, w in zip(cols, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, weight double").orderBy(F.desc("weight"), "feature")


def _value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith(SUFFIX)]


def mean_abs(shap_df: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` features with the largest mean absolute value over all rows."""
    cols = _value_columns(shap_df)
    means = shap_df.agg(*[F.avg(F.abs(F.col(c).cast("double"))).alias(c.removesuffix(SUFFIX)) for c in cols])
    long = means.unpivot([], [c.removesuffix(SUFFIX) for c in cols], "feature", "mean_abs_shap")
    return long.orderBy(F.desc("mean_abs_shap"), F.desc("feature")).limit(k)


def row(shap_df: DataFrame, id_col: str, value=None) -> DataFrame:
    """Values in long form, one line per feature: of one row, or of all rows if ``value`` is None."""
    cols = _value_columns(shap_df)
    if value is not None:
        shap_df = shap_df.where(F.col(id_col) == value)
    long = shap_df.select(id_col, *[F.col(c).alias(c.removesuffix(SUFFIX)) for c in cols]).unpivot(
        [id_col], [c.removesuffix(SUFFIX) for c in cols], "feature", "shap_value"
    )
    return long if value is None else long.orderBy(F.desc(F.abs("shap_value")), "feature")


def dependence(
    df: DataFrame, feature: str, by: str | None = None, bins: int = 10, how: str = "quantile",
) -> DataFrame:
    """Mean Shapley value of ``feature`` per bin of its value, and per bin of ``by`` if given.

    ``df`` has the features and their ``_shap_value`` columns. Bins are ``quantile`` bins
    (exact at any size) or of equal ``width``. Output: ``bin``
    (``by_bin``), ``n``, ``mean_value``, ``mean_shap``. NULL values form the bin NULL.
    """
    names = {feature: "bin"} | ({by: "by_bin"} if by else {})
    binned = df.select("*", *[_bin(df, c, bins, how).alias(alias) for c, alias in names.items()])
    return binned.groupBy(*names.values()).agg(
        F.count("*").alias("n"), F.avg(feature).alias("mean_value"),
        F.avg(F.col(f"{feature}{SUFFIX}").cast("double")).alias("mean_shap"),
    )


def _bin(df: DataFrame, col: str, bins: int, how: str) -> Column:
    """Bin number of ``col`` from edges taken from the whole frame."""
    if how == "quantile":
        edges = exact_quantiles(df, col, [(j, bins) for j in range(1, bins)])
        passed = [F.when(F.col(col) > F.lit(edge), 1).otherwise(0) for edge in edges if edge is not None]
        number = sum(passed, F.lit(0))
    elif how == "width":
        low = df.select(F.min(col)).scalar()
        step = df.select((F.max(col) - F.min(col)) / bins).scalar()
        number = F.least(F.floor(F.coalesce(F.try_divide(F.col(col) - low, step), F.lit(0.0))), F.lit(bins - 1))
    else:
        raise ValueError(f"unknown kind of bins {how!r}")
    return F.when(F.col(col).isNotNull(), number.cast("int"))


def exact_quantiles(df: DataFrame, col: str, shares: Sequence[tuple[int, int]]) -> list:
    """For each share ``(part, of)`` the smallest value with at least that share of the rows up to it.

    Rows are counted per value first; the values are range-partitioned and only running totals of the
    partitions are ordered in one place, so no group is gathered.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "value-counts")
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n"))
    counted.repartitionByRange("v").sortWithinPartitions("v").withColumn("at", F.monotonically_increasing_id()) \
        .withColumn("part", F.shiftright("at", 33)).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return [None for _ in shares]
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.groupBy("part").agg(F.sum("n").alias("m")).select(
        "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("base"))
    upto = F.col("base") + F.sum("n").over(Window.partitionBy("part").orderBy("at"))
    ranked = counts.join(base, "part").select("v", upto.alias("upto"))
    least = [max(1, -(-part * total // of)) for part, of in shares]
    return list(ranked.agg(*[F.min(F.when(F.col("upto") >= k, F.col("v"))).alias(f"q{i}") for i, k in enumerate(least)]).first())
