"""Deletes, merges and versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import corrections, snapshots
from sensorloom.operators.ledger import Ledger
from sensorloom.session import scratch
from sensorloom.workload import frames
from sensorloom.workload.registry import query

CUTOFF = "TIMESTAMP_NTZ '2024-01-10 00:00:00'"
_KEPT = "ts >= TIMESTAMP '2024-01-10'"


def _moment(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 3, day, hour, tzinfo=dt.timezone.utc)


def _ledger(spark: SparkSession, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> Ledger:
    return Ledger(spark, scratch(spark, "ledger"), rows.schema, partition_by)


def _corrected(spark: SparkSession, sf_dir: str) -> Ledger:
    """All events by day; a day later without those before the cutoff; then put back."""
    rows = frames.events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    ledger = _ledger(spark, rows, ("day",))
    ledger.append(rows, _moment(1))
    ledger.delete_where(f"ts < {CUTOFF}", _moment(2))
    ledger.merge_step(_moment(1), ["user_id", "ts"], _moment(3))
    return ledger


def _versioned(spark: SparkSession, sf_dir: str) -> str:
    """The same three states in the older layout, a list of folders per version."""
    root = scratch(spark, "versions")
    rows = frames.events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    snapshots.write(spark, root, rows, ["day"], _moment(1))
    snapshots.delete_where(spark, root, f"ts < {CUTOFF}", _moment(2))
    snapshots.merge_insert(spark, root, snapshots.read(spark, root, version=0), ["user_id", "ts"], _moment(3))
    return root


@query("delete_where", "SELECT * FROM events WHERE NOT coalesce(ts < TIMESTAMP '2024-01-10', false)")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.delete_where(frames.events(spark, sf_dir), f"ts < {CUTOFF}")


@query("merge_insert", f"""WITH cur AS (SELECT * FROM events WHERE {_KEPT}) SELECT * FROM cur UNION ALL
    SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.user_id = e.user_id AND c.ts = e.ts)""")
def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.events(spark, sf_dir)
    current = corrections.delete_where(events, f"ts < {CUTOFF}")
    return corrections.merge_insert(current, events, ["user_id", "ts"])


@query("unmatched_rows", f"""SELECT * FROM events e WHERE NOT EXISTS (
    SELECT 1 FROM events c WHERE c.user_id = e.user_id AND c.ts = e.ts AND c.{_KEPT})""")
def unmatched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.events(spark, sf_dir)
    return corrections.new_rows(corrections.delete_where(events, f"ts < {CUTOFF}"), events, ["user_id", "ts"])


@query("version_after_delete", f"SELECT event_id, ts, value FROM events WHERE {_KEPT}")
def version_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrected(spark, sf_dir).as_of(_moment(2)).select("event_id", "ts", "value")


@query("version_as_of", "SELECT min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n FROM events")
def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _corrected(spark, sf_dir).as_of(_moment(1, 12))
    return old.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("n"))


@query("version_merged", "SELECT * FROM events")
def version_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrected(spark, sf_dir).as_of().drop("day")


@query("version_merge_restore", "SELECT * FROM events")
def version_merge_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an old state put back where the table lacks them, reading as source only what went since."""
    rows = frames.events(spark, sf_dir)
    ledger = _ledger(spark, rows)
    ledger.append(rows, 0)
    ledger.delete_where(f"ts < {CUTOFF}", 1)
    ledger.merge_step(0, ["user_id", "ts"], 2)
    return ledger.as_of()


@query("version_history", f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows_added, 0 AS rows_removed FROM events
    UNION ALL SELECT 1, 'DELETE', 0, count(*) FILTER (WHERE NOT {_KEPT}) FROM events
    UNION ALL SELECT 2, 'MERGE', count(*) FILTER (WHERE NOT {_KEPT}), 0 FROM events""")
def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = snapshots.history(spark, _versioned(spark, sf_dir))
    return history.select("version", "operation", "rows_added", "rows_removed")


@query("table_detail", """SELECT CAST(2 AS BIGINT) AS version, 'day' AS partition_columns,
    count(DISTINCT CAST(ts AS DATE)) AS folders FROM events""")
def table_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = snapshots.detail(spark, _versioned(spark, sf_dir))
    return detail.select("version", F.array_join("partition_columns", ",").alias("partition_columns"), "folders")


@query("version_changes", f"""SELECT event_id, value, 'delete' AS change FROM events WHERE NOT {_KEPT} AND event_type <> 'error'
    UNION ALL SELECT event_id, value, 'update_pre' FROM events WHERE NOT {_KEPT} AND event_type = 'error'
    UNION ALL SELECT event_id, value + 1, 'update_post' FROM events WHERE NOT {_KEPT} AND event_type = 'error'""")
def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early rows are deleted, and the early error rows come back with another value."""
    rows = frames.events(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    ledger = _ledger(spark, rows)
    ledger.append(rows, 0)
    ledger.delete_where(f"ts < {CUTOFF}", 1)
    early = rows.where(f"ts < {CUTOFF} AND event_type = 'error'").withColumn("value", F.col("value") + 1)
    ledger.append(early, 2)
    return ledger.changes(0, 2, ["event_id"]).select("event_id", "value", F.col("_change").alias("change"))


@query("ledger_history", f"""SELECT CAST(2 AS BIGINT) AS step, count(*) FILTER (WHERE NOT {_KEPT}) AS rows_added,
        CAST(0 AS BIGINT) AS rows_removed FROM events
    UNION ALL SELECT 1, 0, count(*) FILTER (WHERE NOT {_KEPT}) FROM events UNION ALL SELECT 0, count(*), 0 FROM events""")
def ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir).select("event_id", "ts")
    ledger = _ledger(spark, rows)
    ledger.append(rows, 0)
    ledger.delete_where(f"ts < {CUTOFF}", 1)
    ledger.restore(0, 2)
    return ledger.history()


@query("restore_state", f"SELECT event_id, value FROM events WHERE {_KEPT}")
def restore_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state before the rows were put back, as a new step and copied to a table of its own."""
    ledger = _corrected(spark, sf_dir)
    ledger.restore(_moment(2), _moment(4))
    return ledger.compact(scratch(spark, "ledger")).as_of().select("event_id", "value")


@query("restore_version", f"SELECT event_id, value FROM events WHERE {_KEPT}")
def restore_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _versioned(spark, sf_dir)
    snapshots.restore(spark, root, version=1)
    return snapshots.read(spark, root).select("event_id", "value")


@query("clone_version", "SELECT event_id, value FROM events")
def clone_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = scratch(spark, "clone")
    snapshots.clone(spark, _versioned(spark, sf_dir), copy, version=0)
    return snapshots.read(spark, copy).select("event_id", "value")
