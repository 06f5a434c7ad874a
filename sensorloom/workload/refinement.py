"""Decoding, projection, filters, joins, unions and one row per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import decode, json_field, to_date_col
from sensorloom.operators import bronze, features
from sensorloom.operators.analytics import on_day, top_k, window_mean
from sensorloom.operators.gold import assert_unique, join_hinted, label
from sensorloom.plans import medallion
from sensorloom.streaming import message_stream
from sensorloom.workload import frames
from sensorloom.workload.registry import MD5_NUMBER as _MD5
from sensorloom.workload.registry import query

FLOW_RULES = medallion.READING_RULES


@query("layered_flow", f"""
    SELECT CAST(e.user_id AS DOUBLE) AS id, s.status, time_bucket(INTERVAL '10 minutes', e.ts) AS window_start,
           round(avg(e.value), 6) AS mean_velocity
    FROM events e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id
    WHERE e.user_id > 0 GROUP BY 1, 2, 3""")
def layered_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records to window means: the whole flow in one plan.

    The means are taken before the status is joined, so the join sees one row per device and window.
    """
    raw = medallion.bronze(frames.raw(frames.events(spark, sf_dir)))
    silver = medallion.silver(raw, frames.READING_DDL, FLOW_RULES)
    means = window_mean(silver, "ID", "TIMESTAMP", "SPEED")
    gold = medallion.gold(means, frames.status(spark, sf_dir))
    return gold.select(
        "id", "status", F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.round("mean_velocity", 6).alias("mean_velocity"),
    )


@query("decode_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(frames.events(spark, sf_dir), "k BIGINT", "props", keep=["event_id"])


@query("json_predicate", "SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) < 10")
def json_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.events(spark, sf_dir).where(json_field("props", "k BIGINT", "k") < 10).select("event_id")


@query("project_rename", "SELECT event_id AS id, value AS speed, value * 3.6 AS speed_kmh FROM events")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir).select(F.struct("event_id", "value").alias("r")).select("r.*")
    return rows.withColumnsRenamed({"event_id": "id", "value": "speed"}).withColumn("speed_kmh", F.col("speed") * 3.6)


@query("casts", """SELECT event_id, CAST(CAST(user_id AS VARCHAR) AS DOUBLE) AS key, CAST(ts AS DATE) AS day,
    CAST(props AS VARCHAR) AS payload, TRY_CAST(event_type AS DOUBLE) AS no_number FROM events""")
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir)
    binary = rows.select("event_id", "ts", F.col("event_type"), F.encode("props", "utf-8").alias("data"),
                         F.col("user_id").cast("string").alias("partitionKey"))
    return binary.select(
        "event_id", F.col("partitionKey").cast("double").alias("key"), to_date_col("ts").alias("day"),
        F.col("data").cast("string").alias("payload"), F.col("event_type").try_cast("double").alias("no_number"),
    )


@query("message_records", """SELECT CAST(user_id AS DOUBLE) AS key, event_id AS event, value AS speed FROM events""")
def message_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = message_stream(frames.messages(frames.events(spark, sf_dir)))
    decoded = decode(raw, frames.READING_DDL, keep=["key"])
    return decoded.select("key", F.col("EVENT").alias("event"), F.col("SPEED").alias("speed"))


@query("stamp_rows", "SELECT event_id, TIMESTAMP '2024-02-01 12:00:00' AS ts FROM events")
def stamp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = bronze.stamp(frames.events(spark, sf_dir), "ts", dt.datetime(2024, 2, 1, 12))
    return stamped.select("event_id", frames.wall_time("ts"))


@query("on_day", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_day(frames.events(spark, sf_dir), "ts", dt.date(2024, 1, 15)).select("event_id")


@query("filters", """SELECT event_id FROM events WHERE value >= 5 AND event_type IN ('error', 'view')
    AND props IS NOT NULL AND user_id <> 33""")
def filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir)
    return rows.where(
        (F.col("value") >= 5) & F.col("event_type").isin("error", "view")
        & F.col("props").isNotNull() & (F.col("user_id") != 33)
    ).select("event_id")


@query("limit_rows", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 100")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(frames.events(spark, sf_dir), [F.desc("value"), F.col("event_id")], 100).select("event_id", "value")


_LABEL_SQL = f"""SELECT CAST(e.user_id AS DOUBLE) AS id, e.event_id AS event, e.value AS speed, s.status
    FROM events e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id"""


def _labelled(spark: SparkSession, sf_dir: str, salt: int) -> DataFrame:
    readings = frames.readings(frames.events(spark, sf_dir))
    joined = label(readings, assert_unique(frames.status(spark, sf_dir), "id"), "id", salt)
    return joined.select("id", F.col("EVENT").alias("event"), F.col("SPEED").alias("speed"), "status")


@query("label_left_join", _LABEL_SQL)
def label_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, 1)


@query("label_left_join_salted", _LABEL_SQL)
def label_left_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, 8)


@query("join_sort_merge", """SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_totalprice
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def join_sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = frames.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice")
    return join_hinted(lines, orders, "l_orderkey")


@query("union_sources", "SELECT user_id AS key, event_type AS value FROM events "
                        "UNION ALL SELECT o_custkey, o_orderpriority FROM orders")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = frames.events(spark, sf_dir).select(F.col("user_id").alias("key"), F.col("event_type").alias("value"))
    history = frames.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("value"), F.col("o_custkey").alias("key"))
    return bronze.union_sources(live, history)


@query("balance_classes", """SELECT l_orderkey, l_linenumber, l_returnflag FROM (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rn
    FROM lineitem WHERE l_returnflag IN ('A', 'R')) WHERE rn <= 5000""")
def balance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frames.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    capped = features.balance(lines, "l_returnflag", 5000, ["A", "R"],
                              ["l_extendedprice", "l_orderkey", "l_linenumber"])
    return capped.drop("l_extendedprice")


@query("balance_any", """SELECT event_type, least(count(*), 500) AS n FROM events
    WHERE event_type IN ('error', 'view') GROUP BY 1""")
def balance_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows stay is up to the hash, so the classes are compared by size."""
    rows = frames.events(spark, sf_dir).select("event_id", "event_type", "value")
    return features.balance(rows, "event_type", 500, ["error", "view"]).groupBy("event_type").agg(
        F.count_distinct("event_id").alias("n"))


@query("dedup_latest", """SELECT event_id, user_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir).select("event_id", "user_id", "ts")
    return bronze.dedup(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("dedup_any", "SELECT DISTINCT user_id, event_type FROM events")
def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.dedup(frames.events(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"])


@query("sample_keyed", f"SELECT event_id, value FROM events WHERE {_MD5.format(key='event_id', seed=7)} < 42949672")
def sample_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.sample(frames.events(spark, sf_dir), 0.01, 7, "event_id", "md5").select("event_id", "value")


@query("message_batch", f"""WITH picked AS (
      SELECT event_id, user_id FROM events WHERE {_MD5.format(key='event_id', seed=0)} < 42949672
      ORDER BY event_id LIMIT 500),
    one AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM picked)
    SELECT CAST(user_id AS DOUBLE) AS key, '{{"EVENT":' || event_id || ',"ID":' || user_id
      || ',"TIMESTAMP":"2024-02-01T12:00:00.000000Z"}}' AS value FROM one WHERE rn = 1""")
def message_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir).select(F.col("event_id").alias("EVENT"), F.col("user_id").alias("ID"))
    return bronze.make_messages(rows, 0.01, 500, "ID", F.col("ID").cast("double"), order=["EVENT"],
                                at=dt.datetime(2024, 2, 1, 12, tzinfo=dt.timezone.utc), method="md5")


@query("shuffle_rows", "SELECT event_id FROM events")
def shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.shuffle_rows(frames.events(spark, sf_dir).select("event_id"), 42)
