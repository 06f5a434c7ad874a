"""Streams over tables whose rows are rewritten: signed rows, retraction, refreshed joins, latest rows, rule counts."""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorloom.operators.gold import label
from sensorloom.operators.ledger import SIGN, Ledger
from sensorloom.operators.quality import Rule
from sensorloom.session import folder
from sensorloom.streaming.readers import file_stream
from sensorloom.streaming.writers import BATCH, _batches, _writer, rewrite_each_batch


def change_stream(ledger: Ledger, max_files: int | None = None) -> DataFrame:
    """All changes of a table as a stream of signed rows: its columns, the step and ``_sign``.

    A deleted row comes once more with sign -1, a rewritten one with -1 and its successor with 1. Signs add up,
    so files and steps may be cut into micro-batches anywhere. Row-wise steps (selecting, filtering, decoding,
    joining a static table) keep the meaning as long as they keep ``_sign``.
    """
    return file_stream(ledger.spark, ledger.root, ledger.log_schema, max_files=max_files)


def new_rows_only(changes: DataFrame) -> DataFrame:
    """Added rows alone, for a sink that only appends: rewritten rows come again, removed ones stay."""
    return changes.where(F.col(SIGN) > 0).drop(SIGN)


def follow(
    changes: DataFrame, target: Ledger, checkpoint: str, trigger: str | None = "available_now", name: str | None = None
) -> StreamingQuery:
    """Apply signed rows to another table: its state is that of the source, rewritten rows and all.

    A micro-batch is one step of the target, numbered by the batch, so a batch that is replayed replaces itself.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        target.land(batch, batch_id)

    return _writer(changes, "append", checkpoint, trigger, name).foreachBatch(apply).start()


def signed_counts(changes: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Running ``n`` and sums per key in which removed rows are taken back.

    Write it with ``rewrite_each_batch(mode="update")`` and read it with :func:`merge_counts`. The state is one row
    per key. Sums of exact types are exact; those of doubles carry the rounding of what was taken back.
    """
    return changes.groupBy(*keys).agg(F.sum(SIGN).alias("n"), *[F.sum(F.col(c) * F.col(SIGN)).alias(c) for c in sums])


def merge_counts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last counts of every key that still has rows."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(BATCH)))
    return _batches(spark, path).withColumn("_last", last).where("_last = 1 AND n <> 0").drop("_last", BATCH)


def label_refreshed(
    readings: DataFrame, status: Callable[[], DataFrame], path: str, checkpoint: str, on: str = "id",
    trigger: str | None = "available_now", name: str | None = None,
) -> StreamingQuery:
    """Every reading with the status its device has when its micro-batch runs.

    A join inside the stream's plan lists a static table's files once, when the stream starts. Here
    ``status`` is called for every micro-batch, so a table that is replaced while the stream runs is
    seen by the next one. The join is a batch join: hot ids are split at run time and nothing is salted.
    Results lie in ``path/batch_id=N`` and a batch that is replayed replaces its own.
    """
    def join(batch: DataFrame, batch_id: int) -> None:
        label(batch, status(), on, salt=1).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _writer(readings, "append", checkpoint, trigger, name).foreachBatch(join).start()


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], within: Column | None = None) -> DataFrame:
    """Per key the row with the greatest ``by``, of a batch or a stream; its columns, keys first.

    Equal ``by`` are settled by the other columns, so the result does not depend on the order of arrival. Rows
    are reduced per task before the shuffle: a hot key moves one row per task. On a stream this is a running
    aggregate for update mode with one row of state per key, read back by :func:`latest_rows`. To bound the state
    give ``within``, such as ``window("ts", "1 day")`` after ``withWatermark("ts", …)``: the state then holds
    the keys of open windows only, and rows later than the watermark are dropped by the engine.
    """
    rest = [c for c in df.columns if c not in (*keys, *by)]
    groups = [*keys, *([within.alias("_within")] if within is not None else [])]
    best = df.groupBy(*groups).agg(F.max(F.struct(*by, *rest)).alias("_best"))
    return best.select(*keys, "_best.*")


def keep_latest(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], path: str, checkpoint: str, within: Column | None = None,
    trigger: str | None = "available_now", name: str | None = None,
) -> StreamingQuery:
    """Run :func:`latest` over a stream; every micro-batch writes the keys it changed to ``path/batch_id=N``."""
    return rewrite_each_batch(latest(df, keys, by, within), path, checkpoint, "update", trigger, name)


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The latest row of every key over all micro-batches of :func:`keep_latest`.

    Compared by ``by`` and not by batch, so windows that closed and keys that come back in later ones are right.
    """
    return latest(_batches(spark, path).drop(BATCH), keys, by)


class RuleLog(StreamingQueryListener):
    """Lands the counts that :func:`operators.quality.apply_rules` observes, one small file per micro-batch.

    Use it as a context around the run of a stream::

        rules = apply_rules(stream, RULES, "rules")
        with RuleLog(spark, "rules", path) as log:
            log.finished(to_path(rules, …))
        rule_report(spark, path, RULES)

    A file is named by the stream (its id outlives restarts from the checkpoint) and the batch, so a batch that is
    reported twice counts once.
    """

    def __init__(self, spark: SparkSession, observation: str, path: str) -> None:
        self.spark, self.observation, self.path = spark, observation, path
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self._failed: list[BaseException] = []

    def __enter__(self) -> RuleLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = (progress.observedMetrics or {}).get(self.observation)
        if counts is None:
            return
        try:
            self._land(f"{progress.id}-{progress.batchId}", counts.asDict())
        except Exception as error:  # noqa: BLE001 - an error here would be lost in the listener's thread
            self._failed.append(error)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def _land(self, name: str, counts: dict[str, int]) -> None:
        # Plain file calls: no job may wait for a slot while the stream's own jobs hold them.
        files, at = folder(self.spark, f"{self.path}/{name}.json")
        out = files.create(at, True)
        try:
            out.write(bytearray(json.dumps({"batch": name, "counts": counts}).encode()))
        finally:
            out.close()

    def finished(self, query: StreamingQuery, patience: float = 60) -> None:
        """Wait for the stream and for its last report."""
        query.awaitTermination()
        self.settled(query, patience)

    def settled(self, query: StreamingQuery, patience: float = 60) -> None:
        """Wait for the last report of a stream that has ended."""
        if not self._ended[str(query.runId)].wait(patience):
            raise RuntimeError("the stream's last event did not arrive")
        if self._failed:
            raise RuntimeError("rule counts could not be written") from self._failed[0]


def rule_report(spark: SparkSession, path: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule over all micro-batches of a :class:`RuleLog`: ``rule, passed, failed, total``."""
    landed = spark.read.schema("batch STRING, counts MAP<STRING, BIGINT>").json(path)
    total = landed.agg(F.coalesce(F.sum(F.col("counts")["total"]), F.lit(0)).alias("total"), *[
        F.coalesce(F.sum(F.col("counts")[f"{rule.name}_{side}"]), F.lit(0)).alias(f"{side}{i}")
        for i, rule in enumerate(rules) for side in ("passed", "failed")])
    rows = F.array(*[F.struct(F.lit(rule.name).alias("rule"), F.col(f"passed{i}").alias("passed"),
                              F.col(f"failed{i}").alias("failed"), F.col("total").alias("total"))
                     for i, rule in enumerate(rules)])
    return total.select(F.explode(rows).alias("r")).select("r.*")
