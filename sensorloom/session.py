"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE_CONF = {
    # Let the engine size and split partitions from what it measures at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Timestamps without zone are read and written as UTC wall time.
    "spark.sql.session.timeZone": "UTC",
    # Window state of an unbounded stream does not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "sensorloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings this package is written for.

    ``spark.sql.shuffle.partitions`` is left to the cluster: it should be two to three times the
    number of cores, and it is frozen into the checkpoint of every stateful stream.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    It is ``spark.checkpoint.dir``; where that is not set, a folder below ``spark.sql.warehouse.dir``,
    which is shared wherever tables are. No machine-local temporary folder is ever used.
    """
    shared = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch(spark: SparkSession, label: str) -> str:
    """Unused path below :func:`scratch_root`; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder; nothing is listed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def folder(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of ``path`` and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there is one."""
    files, at = folder(spark, path)
    files.delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name, at which there must be nothing yet."""
    files, at = folder(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if files.exists(to):
        raise FileExistsError(f"{target} is there already")
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")


def append_row(spark: SparkSession, path: str, row: dict[str, Any], ddl: str) -> None:
    """Add one bookkeeping row to a small parquet table."""
    text = json.dumps(row, default=lambda v: v.isoformat() if isinstance(v, dt.datetime) else str(v))
    frame: DataFrame = spark.range(1).select(F.from_json(F.lit(text), ddl).alias("row")).select("row.*")
    frame.coalesce(1).write.mode("append").parquet(path)
