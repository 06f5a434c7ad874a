"""Partitioned, bucketed and compacted tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import layout, snapshots
from sensorloom.plans.facts import plan_facts
from sensorloom.session import scratch
from sensorloom.sources import scan, table
from sensorloom.workload import frames
from sensorloom.workload.registry import query


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("dated")
    layout.write_partitioned(frames.events(spark, sf_dir), name, "ts", path=scratch(spark, name))
    return table(spark, name)


@query("partitioned_table", "SELECT event_id, ts, CAST(ts AS DATE) AS yymmdd FROM events")
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).select("event_id", "ts", "yymmdd")


@query("partition_pruning", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-19 15:17:05'")
def partition_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _dated(spark, sf_dir)
    return layout.prune(dated, "ts", lower="2024-01-19 15:17:05", strict=True).select("event_id", "ts")


def bucketed_events(spark: SparkSession, sf_dir: str, salt: int | dict[int | None, int]) -> DataFrame:
    data = _name("readings_bucketed")
    readings = frames.readings(frames.events(spark, sf_dir)).withColumnRenamed("ID", "id")
    layout.write_bucketed(readings, data, "id", layout.bucket_count(spark, f"{sf_dir}/events.parquet"), salt,
                          scratch(spark, data))
    return table(spark, data)


def bucketed_pair(spark: SparkSession, sf_dir: str, salt: int | dict[int | None, int]) -> tuple[DataFrame, DataFrame]:
    status = _name("status_bucketed")
    n = layout.bucket_count(spark, f"{sf_dir}/events.parquet")
    layout.write_replicated(frames.status(spark, sf_dir), status, "id", n, salt, scratch(spark, status))
    return bucketed_events(spark, sf_dir, salt), table(spark, status)


_BUCKET_JOIN_SQL = f"""SELECT e.user_id AS id, e.event_id AS event, e.value AS speed, s.status
    FROM events e JOIN {frames.STATUS_SQL} s ON e.user_id = s.id"""


def hot_devices(spark: SparkSession, sf_dir: str) -> dict[int | None, int]:
    """Devices with more than twice the rows of an even share of the buckets."""
    events = frames.events(spark, sf_dir)
    n = layout.bucket_count(spark, f"{sf_dir}/events.parquet")
    return layout.hot_keys(events, "user_id", max(1, events.count() // (8 * n)))


def _bucket_join(spark: SparkSession, sf_dir: str, salt: int | dict[int | None, int]) -> DataFrame:
    joined = layout.join_bucketed(*bucketed_pair(spark, sf_dir, salt), "id")
    return joined.select("id", F.col("EVENT").alias("event"), F.col("SPEED").alias("speed"), "status")


@query("bucketed_join", _BUCKET_JOIN_SQL)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_join(spark, sf_dir, 4)


@query("bucketed_join_salted", _BUCKET_JOIN_SQL)
def bucketed_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_join(spark, sf_dir, 16)


@query("bucketed_join_hot", _BUCKET_JOIN_SQL)
def bucketed_join_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only devices with many rows are spread, and only their status rows repeated."""
    return _bucket_join(spark, sf_dir, hot_devices(spark, sf_dir))


_BUCKET_COUNT_SQL = "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1"


@query("bucketed_count", _BUCKET_COUNT_SQL)
def bucketed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.count_bucketed(bucketed_events(spark, sf_dir, 4), "id")


@query("bucketed_count_salted", _BUCKET_COUNT_SQL)
def bucketed_count_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.count_bucketed(bucketed_events(spark, sf_dir, 16), "id")


@query("bucketed_count_hot", _BUCKET_COUNT_SQL)
def bucketed_count_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.count_bucketed(bucketed_events(spark, sf_dir, hot_devices(spark, sf_dir)), "id")


@query("compact_files", "SELECT event_id, user_id, value FROM events")
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch(spark, "small-files"), scratch(spark, "compacted")
    frames.events(spark, sf_dir).select("event_id", "user_id", "value") \
        .write.option("maxRecordsPerFile", 1000).parquet(source)
    layout.compact(spark, source, target)
    return scan(spark, target)


@query("compact_version", "SELECT event_id, user_id, value FROM events")
def compact_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "versions")
    rows = frames.events(spark, sf_dir).select("event_id", "user_id", "value")
    snapshots.write(spark, root, rows)
    # As many files as the table's size asks for.
    snapshots.compact(spark, root, layout.bucket_count(spark, f"{sf_dir}/events.parquet", least=1))
    return snapshots.read(spark, root)


@query("plan_exchanges", "SELECT true AS plain_exchanges, 0 AS bucketed_exchanges, count(*) > 0 AS counted FROM events")
def plan_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bucketing takes out of the plan of a grouped count."""
    name = _name("readings_plain")
    readings = frames.readings(frames.events(spark, sf_dir)).withColumnRenamed("ID", "id")
    layout.write_bucketed(readings, name, "id", layout.bucket_count(spark, f"{sf_dir}/events.parquet"), 1,
                          scratch(spark, name))
    bucketed = layout.count_bucketed(table(spark, name), "id")
    plain = plan_facts(readings.groupBy("id").count())["exchanges"]
    return bucketed.agg(F.lit(plain > 0).alias("plain_exchanges"),
                        F.lit(plan_facts(bucketed)["exchanges"]).alias("bucketed_exchanges"),
                        (F.count("*") > 0).alias("counted"))
