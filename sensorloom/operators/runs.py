"""Training runs and model versions, kept in two small append-only tables below a folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.session import append_row, path_exists

RUNS = (
    "run_id STRING, model STRING, status STRING, metrics MAP<STRING, DOUBLE>, path STRING, source STRING, "
    "finished_at TIMESTAMP"
)
STAGES = "model STRING, version BIGINT, stage STRING, run_id STRING, path STRING, step BIGINT"


def log(
    spark: SparkSession, root: str, model: str, metrics: dict[str, float], path: str | None = None,
    scorer: PipelineModel | None = None, status: str = "FINISHED", source: str | None = None,
) -> str:
    """Record a run, and save ``scorer`` at ``path`` (by default below ``root``). Returns its id."""
    run_id = uuid.uuid4().hex
    if scorer is not None:
        path = path or f"{root}/models/{model}/{run_id}"
        scorer.write().save(path)
    append_row(spark, f"{root}/runs", {
        "run_id": run_id, "model": model, "status": status, "path": path, "source": source,
        "metrics": {k: float(v) for k, v in metrics.items()},
        "finished_at": dt.datetime.now(dt.timezone.utc),
    }, RUNS)
    return run_id


def runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{root}/runs")


def best(spark: SparkSession, root: str, model: str, metric: str) -> DataFrame:
    """The finished run of ``model`` with the largest positive metric, as one row."""
    value = F.col("metrics")[metric]
    return (
        runs(spark, root)
        .where((F.col("model") == model) & (F.col("status") == "FINISHED") & (value > 0))
        .withColumn("metric", value).orderBy(F.desc("metric"), "finished_at").limit(1)
    )


def register(spark: SparkSession, root: str, run: Row) -> int:
    """Make a run the next version of its model. Returns the version number."""
    known = [r["version"] for r in versions(spark, root, run["model"]).select("version").collect()]
    version = max(known, default=0) + 1
    _stage(spark, root, [(run["model"], version, "None", run["run_id"], run["path"])])
    return version


def promote(spark: SparkSession, root: str, model: str, version: int, stage: str = "Production") -> None:
    """Put a version in a stage and archive the version that was there."""
    current = {r["version"]: r for r in versions(spark, root, model).collect()}
    if version not in current:
        raise ValueError(f"{model} has no version {version}")
    moved = [(v, "Archived") for v, r in current.items() if r["stage"] == stage and v != version]
    _stage(spark, root, [(model, v, to, current[v]["run_id"], current[v]["path"])
                         for v, to in [*moved, (version, stage)]])


def versions(spark: SparkSession, root: str, model: str | None = None) -> DataFrame:
    """Current stage of every version: its last transition."""
    if not path_exists(spark, f"{root}/versions"):
        return spark.createDataFrame([], STAGES)
    steps = spark.read.schema(STAGES).parquet(f"{root}/versions")
    if model is not None:
        steps = steps.where(F.col("model") == model)
    last = F.row_number().over(Window.partitionBy("model", "version").orderBy(F.desc("step")))
    return steps.withColumn("_last", last).where("_last = 1").drop("_last")


def load_production(spark: SparkSession, root: str, model: str, stage: str = "Production") -> PipelineModel:
    """The scorer of the version in the given stage."""
    found = versions(spark, root, model).where(F.col("stage") == stage).select("path").collect()
    if not found:
        raise ValueError(f"{model} has no {stage} version")
    return PipelineModel.load(found[0]["path"])


def _stage(spark, root, rows) -> None:
    step = versions(spark, root).agg(F.max("step")).first()[0]
    first = 0 if step is None else step + 1
    rows = [(*row, first + i) for i, row in enumerate(rows)]
    spark.createDataFrame(rows, STAGES).coalesce(1).write.mode("append").parquet(f"{root}/versions")
