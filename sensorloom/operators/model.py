"""Boosted-tree classifier: search, metrics, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.features import feature_stages, label_index


@dataclass(frozen=True)
class Trained:
    """``scorer`` turns raw features to predictions; it needs no label column.

    ``labels`` holds the class names by label, ``search`` maps each depth to its mean metric.
    """

    scorer: PipelineModel
    labels: list[str]
    search: dict[int, float]

    @property
    def classifier(self) -> GBTClassificationModel:
        return self.scorer.stages[-1]


def train(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    positive: str | None = None,
    depths: Sequence[int] = (3, 4, 5),
    folds: int = 2,
    iters: int = 5,
    metric: str = "areaUnderROC",
    seed: int = 42,
    parallelism: int = 2,
    handle_invalid: str = "skip",
) -> Trained:
    """Grid search over tree depth by cross validation, refit on all rows. ``folds=0`` fits the only depth.

    Rows without a label are left out. Folds go by the hash of the features, so they are the same in
    every run and equal rows never sit on both sides. The training frame is read once and kept on the
    executors; a lost executor only costs recomputing its part.
    """
    labelled, names = label_index(df.select(*cols, label), label, positive=positive)
    labelled = labelled.where("label IS NOT NULL")
    stages = feature_stages(cols, handle_invalid=handle_invalid).fit(labelled)
    fold = F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(max(1, folds))).cast("int").alias("fold")
    data = stages.transform(labelled).select("features", "label", fold).persist(StorageLevel.MEMORY_AND_DISK)
    if not folds and len(depths) != 1:
        raise ValueError("without folds there is one depth to fit")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=iters, seed=seed)
    if metric.startswith("areaUnder"):
        evaluator = BinaryClassificationEvaluator(metricName=metric)
    else:
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
    if not folds:
        try:
            return Trained(PipelineModel([*stages.stages, gbt.setMaxDepth(depths[0]).fit(data)]), names, {})
        finally:
            data.unpersist()
    search = CrossValidator(
        estimator=gbt,
        estimatorParamMaps=ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(),
        evaluator=evaluator, numFolds=folds, foldCol="fold", seed=seed, parallelism=parallelism,
    )
    try:
        found = search.fit(data)
    finally:
        data.unpersist()
    return Trained(
        PipelineModel([*stages.stages, found.bestModel]), names, dict(zip(depths, found.avgMetrics)),
    )


def score(scorer: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Predictions for a batch or a stream; ``keep`` chooses the columns before ``prediction``."""
    scored = scorer.transform(df)
    return scored if keep is None else scored.select(*keep, "prediction")


def auroc(pred: DataFrame, label: str = "label", score: str = "rawPrediction") -> float:
    """Area under the ROC curve over all distinct scores, ties counted half."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(pred)


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Count per (label, prediction) pair."""
    return pred.groupBy(label, prediction).agg(F.count("*").alias("n"))


def confusion_matrix(pred: DataFrame, classes: Sequence, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per label, one column ``predicted_<class>`` per class; absent pairs are 0."""
    counts = [F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes]
    return pred.groupBy(label).agg(*counts)


def class_metrics(
    pred: DataFrame, positive: float = 1.0, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: ``precision, recall, f1`` of the positive class and ``weighted_f1`` over all classes.

    The rows are reduced to pair counts first; everything after that is as small as the number of
    classes squared. A ratio without any row is 0.
    """
    pairs = confusion(pred, label, prediction)
    by_label = pairs.groupBy(F.col(label).alias("c")).agg(
        F.sum("n").alias("actual"),
        F.sum(F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)).alias("hit"),
    )
    by_prediction = pairs.groupBy(F.col(prediction).alias("c")).agg(F.sum("n").alias("predicted"))
    per_class = by_label.join(by_prediction, "c", "full").fillna(0, ["actual", "hit", "predicted"])
    scored = per_class.select(
        "c", "actual",
        F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)).alias("p"),
        F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0)).alias("r"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("predicted") + F.col("actual")), F.lit(0.0)).alias("f"),
    )

    def chosen(col):
        return F.coalesce(F.max(F.when(F.col("c") == positive, F.col(col))), F.lit(0.0))

    return scored.agg(
        chosen("p").alias("precision"), chosen("r").alias("recall"), chosen("f").alias("f1"),
        F.try_divide(F.sum(F.col("f") * F.col("actual")), F.sum("actual")).alias("weighted_f1"),
    )
