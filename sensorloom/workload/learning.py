"""Features, metrics, runs, scoring and explanations."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import streaming
from sensorloom.operators import explain, features, model, runs
from sensorloom.schemas import VIBRATION_COLUMNS
from sensorloom.operators.analytics import on_day
from sensorloom.session import scratch
from sensorloom.workload import frames
from sensorloom.workload.registry import MD5_NUMBER as _MD5
from sensorloom.workload.registry import query


@query("split_keyed", f"""SELECT event_id, CASE WHEN {_MD5.format(key='event_id', seed=42)} < 3006477107
    THEN 'train' ELSE 'test' END AS part FROM events""")
def split_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir).select("event_id")
    train, test = features.split(rows, [0.7, 0.3], 42, "event_id", "md5")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("scaled_features", f"""WITH f AS (SELECT vec_id, {frames.FEATURE_SQL} FROM embeddings),
    s AS (SELECT {', '.join(f'stddev_samp({c}) AS {c}' for c in VIBRATION_COLUMNS)} FROM f)
    SELECT vec_id, {', '.join(f'round(f.{c} / s.{c}, 6) AS {c}' for c in VIBRATION_COLUMNS)} FROM f, s""")
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.features(spark, sf_dir)
    scaled = features.feature_stages(VIBRATION_COLUMNS).fit(rows).transform(rows)
    values = vector_to_array("features")
    return scaled.select("vec_id", *[F.round(values[i], 6).alias(c) for i, c in enumerate(VIBRATION_COLUMNS)])


@query("label_index", """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT e.event_id, CAST(r.idx AS DOUBLE) AS label FROM events e JOIN (
      SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx FROM c) r USING (event_type)""")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, _ = features.label_index(frames.events(spark, sf_dir).select("event_id", "event_type"), "event_type")
    return labelled.select("event_id", "label")


_AUROC_SQL = """WITH r AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
      rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rk FROM events)
    SELECT round((sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6)
    AS auroc FROM r"""


@query("auroc", _AUROC_SQL)
def auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = model.auroc(frames.predictions(spark, sf_dir), score="score")
    return spark.range(1).select(F.round(F.lit(value), 6).alias("auroc"))


_PREDICTION_SQL = """(SELECT CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS label,
    CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END AS prediction FROM events)"""


@query("class_metrics", f"""WITH m AS (SELECT
      count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
      count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn
      FROM {_PREDICTION_SQL})
    SELECT round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
      round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
      round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + fp + fn + tn), 6)
      AS weighted_f1 FROM m""")
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = model.class_metrics(frames.predictions(spark, sf_dir))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("confusion", f"SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n "
                    f"FROM {_PREDICTION_SQL} GROUP BY 1, 2")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.confusion(frames.predictions(spark, sf_dir))


@query("confusion_matrix", f"""SELECT CAST(label AS DOUBLE) AS label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
    count(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM {_PREDICTION_SQL} GROUP BY 1""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.confusion_matrix(frames.predictions(spark, sf_dir), [0, 1])


_THRESHOLDS = (5, 10, 20)


@query("best_run", f"""WITH runs AS ({' UNION ALL '.join(
    f'''SELECT 'value > {t}' AS source, 2.0 * count(*) FILTER (WHERE event_type = 'error' AND value > {t})
        / (count(*) FILTER (WHERE value > {t}) + count(*) FILTER (WHERE event_type = 'error')) AS f1 FROM events'''
    for t in _THRESHOLDS)})
    SELECT source, round(f1, 6) AS f1 FROM runs ORDER BY f1 DESC LIMIT 1""")
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three threshold classifiers are measured and logged as runs; the best one is found again."""
    root = scratch(spark, "runs")
    scored = frames.predictions(spark, sf_dir)
    for t in _THRESHOLDS:
        pred = scored.withColumn("prediction", F.when(F.col("score") > t, 1.0).otherwise(0.0))
        metrics = model.class_metrics(pred).first().asDict()
        runs.log(spark, root, "threshold", metrics, source=f"value > {t}")
    return runs.best(spark, root, "threshold", "f1").select("source", F.round("metric", 6).alias("f1"))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding elements in the shape of Shapley values."""
    vectors = frames.table(spark, sf_dir, "embeddings")
    named = [F.col("embedding")[i].cast("double").alias(f"{c}{explain.SUFFIX}") for i, c in enumerate(VIBRATION_COLUMNS)]
    feature = [F.col("embedding")[i + 8].cast("double").alias(c) for i, c in enumerate(VIBRATION_COLUMNS)]
    return vectors.select("vec_id", *feature, *named)


_LONG_SQL = " UNION ALL ".join(
    f"SELECT vec_id, '{c}' AS feature, CAST(embedding[{i + 1}] AS DOUBLE) AS shap_value FROM embeddings"
    for i, c in enumerate(VIBRATION_COLUMNS))


@query("mean_abs_values", f"""SELECT feature, round(avg(abs(shap_value)), 6) AS mean_abs_shap FROM ({_LONG_SQL})
    GROUP BY feature ORDER BY 2 DESC, 1 DESC LIMIT 6""")
def mean_abs_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.mean_abs(_values(spark, sf_dir), 6)
    return out.withColumn("mean_abs_shap", F.round("mean_abs_shap", 6))


@query("row_values", _LONG_SQL)
def row_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.row(_values(spark, sf_dir), "vec_id")


@query("dependence_width", """WITH v AS (SELECT CAST(embedding[9] AS DOUBLE) AS x, CAST(embedding[1] AS DOUBLE) AS y FROM embeddings),
    r AS (SELECT min(x) AS low, (max(x) - min(x)) / 10 AS step FROM v)
    SELECT CAST(least(floor((x - low) / step), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(x), 6) AS mean_value,
    round(avg(y), 6) AS mean_shap FROM v, r GROUP BY 1""")
def dependence_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.dependence(_values(spark, sf_dir), "AN3", bins=10, how="width")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_value", "mean_shap")})


@query("dependence_quantile", """WITH v AS (SELECT CAST(embedding[9] AS DOUBLE) AS x, CAST(embedding[1] AS DOUBLE) AS y FROM embeddings),
    q AS (SELECT quantile_disc(x, [0.25, 0.5, 0.75]) AS cuts FROM v)
    SELECT CAST(len(list_filter(cuts, lambda c: c < x)) AS INTEGER) AS bin, count(*) AS n, round(avg(x), 6) AS mean_value,
    round(avg(y), 6) AS mean_shap FROM v, q GROUP BY 1""")
def dependence_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = explain.dependence(_values(spark, sf_dir), "AN3", bins=4)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_value", "mean_shap")})


def _trained(spark: SparkSession, sf_dir: str, depths=(3,), folds: int = 0) -> model.Trained:
    """One depth without a search: these queries show scores and explanations, not the choice of a depth."""
    return model.train(frames.features(spark, sf_dir), VIBRATION_COLUMNS, "status", "damaged", depths=depths, folds=folds)


@query("trained_metrics")
def trained_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search, fit on the train part, metrics on the test part."""
    train, test = features.split(frames.features(spark, sf_dir), [0.7, 0.3], 42, "vec_id")
    trained = model.train(train, VIBRATION_COLUMNS, "status", "damaged", depths=(3, 4), folds=2, iters=5)
    labelled, _ = features.label_index(test, "status", positive="damaged")
    pred = model.score(trained.scorer, labelled)
    return model.class_metrics(pred).withColumn("auroc", F.lit(model.auroc(pred)))


@query("trained_confusion", f"""SELECT CAST(embedding[1] > 0 AS INTEGER)::DOUBLE AS label, CAST(embedding[1] > 0 AS INTEGER)::DOUBLE AS prediction,
    count(*) AS n FROM embeddings WHERE NOT ({_MD5.format(key='vec_id', seed=42)} < 3006477107) GROUP BY 1""")
def trained_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search, fit and test where the status follows from the sign of one feature: every test row has to be right."""
    first = VIBRATION_COLUMNS[0]
    rows = frames.features(spark, sf_dir).withColumn(first, F.when(F.col(first) > 0, 1.0).otherwise(-1.0)) \
        .withColumn("status", F.when(F.col(first) > 0, "damaged").otherwise("healthy"))
    train, test = features.split(rows, [0.7, 0.3], 42, "vec_id", "md5")
    trained = model.train(train, VIBRATION_COLUMNS, "status", "damaged", depths=(2, 3), folds=2, iters=5)
    labelled, _ = features.label_index(test, "status", positive="damaged")
    return model.confusion(model.score(trained.scorer, labelled))


@query("production_scores")
def production_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, log, register, promote, load, and score the whole table."""
    root, trained = scratch(spark, "runs"), _trained(spark, sf_dir, (3, 4), 2)
    runs.log(spark, root, "vibration", {"AUROC": max(trained.search.values())}, scorer=trained.scorer)
    version = runs.register(spark, root, runs.best(spark, root, "vibration", "AUROC").first())
    runs.promote(spark, root, "vibration", version)
    scorer = runs.load_production(spark, root, "vibration")
    return model.score(scorer, frames.features(spark, sf_dir), ["vec_id", *VIBRATION_COLUMNS])


@query("stream_scores")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scorer on a stream of the features."""
    files, out = scratch(spark, "incoming"), scratch(spark, "scored")
    rows = frames.features(spark, sf_dir)
    rows.write.parquet(files)
    scored = model.score(_trained(spark, sf_dir).scorer, streaming.file_stream(spark, files, rows.schema), ["vec_id"])
    streaming.to_path(scored, out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)


@query("feature_importances")
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.importances(spark, _trained(spark, sf_dir).classifier, VIBRATION_COLUMNS)


@query("importances_complete", """SELECT true AS complete, true AS none_negative, true AS sum_is_one, count(*) > 0 AS fitted
    FROM embeddings""")
def importances_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances name every feature once, are not negative and add up to one."""
    rows = explain.importances(spark, _trained(spark, sf_dir).classifier, VIBRATION_COLUMNS)
    names = F.array_sort(F.collect_list("feature")) == F.array(*[F.lit(c) for c in sorted(VIBRATION_COLUMNS)])
    return rows.agg(names.alias("complete"), (F.min("weight") >= 0).alias("none_negative"),
                    (F.abs(F.sum("weight") - 1) < 1e-9).alias("sum_is_one"), (F.count("*") > 0).alias("fitted"))


@query("shapley_values")
def shapley_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = _trained(spark, sf_dir)
    scored = model.score(trained.scorer, frames.features(spark, sf_dir))
    return explain.shap(trained.classifier, scored, VIBRATION_COLUMNS, ["vec_id"])


@query("shapley_additivity", "SELECT vec_id, CAST(0 AS DOUBLE) AS gap FROM embeddings")
def shapley_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base value plus the values of a row is its margin, for every row."""
    trained = _trained(spark, sf_dir)
    scored = model.score(trained.scorer, frames.features(spark, sf_dir))
    base = explain.leaves(spark, trained.classifier, len(VIBRATION_COLUMNS)).base
    values = explain.shap(trained.classifier, scored, VIBRATION_COLUMNS, ["vec_id", "rawPrediction"], dtype="double")
    total = sum((F.col(f"{c}{explain.SUFFIX}") for c in VIBRATION_COLUMNS), F.lit(base))
    margin = vector_to_array("rawPrediction")[1]
    return values.select("vec_id", F.round(F.abs(total - margin), 6).alias("gap"))


@query("stream_scores_agree", "SELECT vec_id, true AS same FROM embeddings")
def stream_scores_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream is scored exactly like a batch."""
    files, out = scratch(spark, "incoming"), scratch(spark, "scored")
    rows = frames.features(spark, sf_dir)
    rows.write.parquet(files)
    scorer = _trained(spark, sf_dir).scorer
    scored = model.score(scorer, streaming.file_stream(spark, files, rows.schema), ["vec_id"])
    streaming.to_path(scored, out, scratch(spark, "checkpoint")).awaitTermination()
    batch = model.score(scorer, rows, ["vec_id"]).withColumnRenamed("prediction", "expected")
    both = batch.join(spark.read.schema(scored.schema).parquet(out), "vec_id", "left")
    return both.select("vec_id", F.col("expected").eqNullSafe(F.col("prediction")).alias("same"))


@query("stream_scores_today", "SELECT vec_id AS id, true AS same FROM embeddings WHERE vec_id % 5 = 2")
def stream_scores_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one day of a labelled stream with event time, scored as in a batch."""
    files, out = scratch(spark, "incoming"), scratch(spark, "scored")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("vec_id", F.lit(5)).cast("int"))
    rows = frames.features(spark, sf_dir).withColumn("ts", day.cast("timestamp"))
    take = frames.land_files(rows, files, 100, take=8)
    scorer = _trained(spark, sf_dir).scorer
    today = on_day(streaming.file_stream(spark, files, rows.schema, max_files=take), "ts", dt.date(2024, 1, 3))
    scored = model.score(scorer, today, ["vec_id", "ts"])
    streaming.to_path(scored, out, scratch(spark, "checkpoint")).awaitTermination()
    batch = model.score(scorer, rows, ["vec_id", "ts"]).withColumnRenamed("prediction", "expected")
    both = spark.read.schema(scored.schema).parquet(out).join(batch, ["vec_id", "ts"], "left")
    return both.select(F.col("vec_id").alias("id"), F.col("expected").eqNullSafe(F.col("prediction")).alias("same"))
