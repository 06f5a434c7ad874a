"""Streaming sinks and control of running streams."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from sensorloom.sources.constraints import enforce
from sensorloom.streaming.readers import file_stream

BATCH = "batch_id"


def _writer(df: DataFrame, mode: str, checkpoint: str | None, trigger: str | None, name: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def to_table(
    df: DataFrame,
    table: str,
    checkpoint: str | None = None,
    trigger: str | None = "available_now",
    name: str | None = None,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    source_is_append_only: bool = True,
) -> StreamingQuery:
    """Append a stream to a table, created if absent.

    ``trigger`` is ``available_now`` (process what is there, then stop), an interval such as
    ``10 seconds``, or None for back-to-back batches. File sources see new files only: a source
    whose rows are rewritten (``source_is_append_only=False``) is followed by ``changes.follow``. The
    constraints that the table has when the stream starts hold for every row: a bad one fails its batch.
    """
    if not source_is_append_only:
        raise ValueError("a file source cannot follow rewritten rows; follow its ledger or start a stream on the new snapshot")
    writer = _writer(enforce(df, table), "append", checkpoint, trigger, name).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def to_path(
    df: DataFrame, path: str, checkpoint: str | None = None, trigger: str | None = "available_now",
    name: str | None = None, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to parquet files; each micro-batch appears whole and once."""
    writer = _writer(df, "append", checkpoint, trigger, name).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def to_memory(
    df: DataFrame, name: str, mode: str = "complete", trigger: str | None = "available_now",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Keep the result in driver memory under ``name``, for SQL.

    Only for aggregates whose size does not grow with the data; others use
    :func:`rewrite_each_batch`.
    """
    return _writer(df, mode, checkpoint, trigger, name).format("memory").start()


def rewrite_each_batch(
    df: DataFrame, path: str, checkpoint: str, mode: str = "complete", trigger: str | None = "available_now",
    name: str | None = None,
) -> StreamingQuery:
    """Write every micro-batch to its own folder ``path/batch_id=N``.

    The folder is overwritten, so a batch that is replayed after a failure leaves no duplicates. In
    complete mode read it with :func:`latest_result`, in update mode with :func:`merge_updates`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _writer(df, mode, checkpoint, trigger, name).foreachBatch(save).start()


def _batches(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def latest_result(spark: SparkSession, path: str) -> DataFrame:
    """The result as of the last micro-batch of a complete-mode stream."""
    batches = _batches(spark, path)
    last = batches.select(F.max(BATCH)).first()[0]
    return batches.where(F.col(BATCH) == last).drop(BATCH)


def merge_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last value of every key of an update-mode stream."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(BATCH)))
    return _batches(spark, path).withColumn("_last", last).where("_last = 1").drop("_last", BATCH)


def copy_into(
    spark: SparkSession, table: str, path: str, checkpoint: str, fmt: str = "parquet",
    schema: T.StructType | str | None = None, table_path: str | None = None, **options: Any,
) -> int:
    """Load the files of a folder that were not loaded before. Returns the number of new rows.

    The checkpoint belongs to the table and remembers the files; a second call adds nothing.
    ``max_files`` splits a large backlog into micro-batches. A listener hears of every one of them, so
    the number is complete however many there are.
    """
    stream = file_stream(spark, path, schema, fmt, infer=schema is None, **options)
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        query = to_table(stream, table, checkpoint, path=table_path)
        query.awaitTermination()
        return counter.total(str(query.runId))
    finally:
        spark.streams.removeListener(counter)


class _RowCounter(StreamingQueryListener):
    """Rows read by each run of a stream, summed over all its micro-batches."""

    def __init__(self) -> None:
        self._rows: dict[str, int] = defaultdict(int)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def total(self, run: str, patience: float = 60) -> int:
        """Events arrive in order and the end of the run is the last one."""
        if not self._ended[run].wait(patience):
            raise RuntimeError("the stream's last event did not arrive")
        return self._rows[run]


def configure(spark: SparkSession, root: str) -> None:
    """Default folder for checkpoints of streams that name none."""
    spark.conf.set("spark.sql.streaming.checkpointLocation", root)


def stop_all(spark: SparkSession) -> int:
    """Stop all streams of the session. Returns how many were running."""
    running = spark.streams.active
    for query in running:
        query.stop()
    return len(running)
