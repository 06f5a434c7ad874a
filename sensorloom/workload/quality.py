"""Row rules, constraints and evolving schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import quality
from sensorloom.operators.evolution import decode_rescued, observed_schema, schema_with_hints
from sensorloom.operators.quality import Rule
from sensorloom.session import scratch
from sensorloom.sources import create, insert, scan, table
from sensorloom.streaming import read_evolved, run_evolving
from sensorloom.workload import frames
from sensorloom.workload.registry import query


@query("expect_keep", "SELECT event_id, value FROM events")
def expect_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect(frames.events(spark, sf_dir).select("event_id", "value"), "speed", "value >= 5")


@query("expect_or_drop", "SELECT event_id, user_id FROM events WHERE user_id > 0")
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_or_drop(frames.events(spark, sf_dir).select("event_id", "user_id"), "id", "user_id > 0")


@query("expect_or_fail", "SELECT event_id, ts FROM events WHERE ts IS NOT NULL")
def expect_or_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_or_fail(frames.events(spark, sf_dir).select("event_id", "ts"), "time", "ts IS NOT NULL")


@query("expectation_report", """
    SELECT 'id' AS rule, count(*) FILTER (WHERE user_id > 0) AS passed,
           count(*) FILTER (WHERE NOT coalesce(user_id > 0, false)) AS failed, count(*) AS total FROM events
    UNION ALL SELECT 'speed', count(*) FILTER (WHERE value >= 5),
           count(*) FILTER (WHERE NOT coalesce(value >= 5, false)), count(*) FROM events
    UNION ALL SELECT 'time', count(ts), count(*) - count(ts), count(*) FROM events""")
def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule("id", "user_id > 0", "drop"), Rule("speed", "value >= 5"), Rule("time", "ts IS NOT NULL", "fail")]
    return quality.report(frames.events(spark, sf_dir), rules)


@query("table_constraint", "SELECT event_id, user_id FROM events WHERE user_id >= 0 AND event_id IS NOT NULL")
def table_constraint(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"checked_{uuid.uuid4().hex[:12]}"
    create(spark, name, "event_id BIGINT NOT NULL, user_id BIGINT", path=scratch(spark, name))
    rows = frames.events(spark, sf_dir).select("event_id", "user_id")
    quality.add_check(spark, name, "id_not_negative", "user_id >= 0")
    insert(quality.enforce(rows, name), name, ["event_id", "user_id"])
    return table(spark, name)


@query("schema_hints", "SELECT event_id, ts, CAST(value AS FLOAT) AS value, event_type FROM events")
def schema_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "hints")
    rows = frames.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp"), "value", "event_type")
    rows.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    schema = schema_with_hints(observed_schema(scan(spark, path, "text")), "ts TIMESTAMP, value FLOAT")
    return scan(spark, path, "json", schema).select("event_id", frames.wall_time("ts"), "value", "event_type")


_MIXED = """'{"event_id":' || event_id || ',"user_id":' ||
    CASE WHEN event_type = 'error' THEN '"u' || user_id || '"' ELSE CAST(user_id AS VARCHAR) END || '}'"""


def _mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts in which the device of an error event is text instead of a number."""
    user = F.when(F.col("event_type") == "error", F.concat(F.lit('"u'), "user_id", F.lit('"'))).otherwise(
        F.col("user_id").cast("string"))
    text = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), user, F.lit("}"))
    return frames.events(spark, sf_dir).select(text.alias("value"))


@query("rescued_record", f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN event_type = 'error' THEN {_MIXED} END AS incorrect FROM events""")
def rescued_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_rescued(_mixed_records(spark, sf_dir), "event_id BIGINT, user_id BIGINT", side="incorrect")


@query("rescued_fields", """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN event_type = 'error' THEN '{"user_id":"u' || user_id || '"}' END AS incorrect FROM events""")
def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_rescued(_mixed_records(spark, sf_dir), "event_id BIGINT, user_id BIGINT", side="incorrect",
                          fields_only=True)


@query("evolving_ingest", """SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type FROM events
    UNION ALL SELECT event_id, user_id, event_type FROM events""")
def evolving_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a column, then files with it, loaded by one evolving stream."""
    path, out, checkpoint = (scratch(spark, f"evolving-{part}") for part in ("in", "out", "checkpoint"))
    rows = frames.events(spark, sf_dir)
    rows.select("event_id", "user_id").write.mode("append").json(path)
    run_evolving(spark, path, out, "event_id BIGINT, user_id BIGINT", checkpoint)
    rows.select("event_id", "user_id", "event_type").write.mode("append").json(path)
    run_evolving(spark, path, out, "event_id BIGINT, user_id BIGINT", checkpoint)
    return read_evolved(spark, out).select("event_id", "user_id", "event_type")


@query("evolving_odd_names", """SELECT event_id, value AS "FLOAT_VALUE", user_id AS "VOID OBJECT<x" FROM events""")
def evolving_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field names that look like types keep their values when the schema is inferred and widened."""
    path, out, checkpoint = (scratch(spark, f"odd-{part}") for part in ("in", "out", "checkpoint"))
    rows = frames.events(spark, sf_dir).select("event_id", F.col("value").alias("FLOAT_VALUE"),
                                               F.col("user_id").alias("VOID OBJECT<x"))
    rows.write.json(path)
    run_evolving(spark, path, out, "event_id BIGINT", checkpoint)
    return read_evolved(spark, out).select("event_id", "FLOAT_VALUE", "`VOID OBJECT<x`")
