"""Reads and batch writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.records import encode
from sensorloom.operators.analytics import top_k
from sensorloom.plans import cached, define_table, register, reset, view
from sensorloom.session import path_exists, scratch
from sensorloom.sources import create, insert, scan, table, write
from sensorloom.workload import frames
from sensorloom.workload.registry import query


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _json_copy(df: DataFrame) -> str:
    path = scratch(df.sparkSession, "json")
    write(df, path, "overwrite", "json", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return path


@query("scan_files", "SELECT * FROM lineitem")
def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/lineitem.parquet")


@query(
    "scan_text",
    """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS value FROM events""",
)
def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, _json_copy(frames.events(spark, sf_dir).select("event_id", "user_id")), "text")


@query(
    "scan_json_schema",
    "SELECT l_suppkey AS turbine_id, l_shipdate AS date, CAST(l_quantity AS FLOAT) AS power FROM lineitem",
)
def scan_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = frames.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("turbine_id"), F.col("l_shipdate").cast("timestamp").alias("date"),
        F.col("l_quantity").alias("power"),
    )
    back = scan(spark, _json_copy(power), "json", "turbine_id BIGINT, date TIMESTAMP, power FLOAT")
    return back.withColumn("date", frames.wall_time("date"))


@query("scan_json_inferred", "SELECT event_id, event_type, value FROM events")
def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, _json_copy(frames.events(spark, sf_dir).select("event_id", "event_type", "value")), "json")


@query("saved_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("saved")
    orders = frames.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write(orders, name, "overwrite", path=scratch(spark, name))
    return table(spark, name)


@query("table_from_query", "SELECT * FROM events")
def table_from_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("defined")
    return define_table(name, frames.events(spark, sf_dir), "raw history of all devices", scratch(spark, name),
                        {"quality": "bronze"})


@query("registered_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "external")
    write(frames.table(spark, sf_dir, "customer"), path, "overwrite")
    name = register(spark, spark.catalog.currentDatabase(), _table_name("external"), path)
    return table(spark, name).select("c_custkey", "c_name", "c_acctbal")


@query("write_overwrite", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "overwrite")
    lines = frames.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    write(lines.withColumn("l_quantity", -F.col("l_quantity")), path, "overwrite")
    write(lines, path, "overwrite")
    return scan(spark, path)


@query("write_append", "SELECT event_id, user_id FROM events UNION ALL SELECT event_id, user_id FROM events")
def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch(spark, "append"), frames.events(spark, sf_dir).select("event_id", "user_id")
    write(rows, path, "append")
    write(rows, path, "append")
    return scan(spark, path)


@query("write_sample_file", "SELECT event_id, event_type FROM events ORDER BY value DESC, event_id LIMIT 10")
def write_sample_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = top_k(frames.events(spark, sf_dir), [F.desc("value"), F.col("event_id")], 10)
    path = scratch(spark, "sample")
    write(best.select("event_id", "event_type"), path, "overwrite", "json", n_files=1)
    return scan(spark, path, "json", "event_id BIGINT, event_type STRING")


@query("insert_columns", "SELECT event_id, value, CAST(NULL AS VARCHAR) AS note FROM events")
def insert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("inserted")
    create(spark, name, "event_id BIGINT NOT NULL, value DOUBLE, note STRING", {"quality": "silver"},
           "events by column list", scratch(spark, name))
    insert(frames.events(spark, sf_dir), name, ["value", "event_id"])
    return table(spark, name)


@query(
    "append_new_column",
    "SELECT event_id, value, CAST(NULL AS VARCHAR) AS event_type FROM events "
    "UNION ALL SELECT event_id, value, event_type FROM events",
)
def append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch(spark, "widened"), frames.events(spark, sf_dir)
    write(rows.select("event_id", "value"), path, "append")
    write(rows.select("event_id", "value", "event_type"), path, "append", merge_schema=True)
    return scan(spark, path, mergeSchema=True).select("event_id", "value", "event_type")


@query("temp_view_sql", "SELECT user_id, max(value) AS peak FROM events GROUP BY user_id")
def temp_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("live")
    view(frames.events(spark, sf_dir), name)
    return spark.sql(f"SELECT user_id, max(value) AS peak FROM {name} GROUP BY user_id")


@query("encode_json", """SELECT CAST(user_id AS DOUBLE) AS key,
    '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""")
def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.events(spark, sf_dir)
    return encode(rows, F.col("user_id").cast("double"), ["event_id", "user_id", "event_type"])


@query("cached_rows", """SELECT 'all' AS part, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events WHERE value >= 5
    UNION ALL SELECT event_type, count(*), min(event_id), max(event_id) FROM events WHERE value >= 5 GROUP BY event_type""")
def cached_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates over rows that are computed once."""
    totals = [F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last")]
    out = scratch(spark, "totals")
    with cached(frames.events(spark, sf_dir).where("value >= 5").select("event_id", "event_type")) as rows:
        write(rows.agg(*totals).select(F.lit("all").alias("part"), "*"), out)
        write(rows.groupBy(F.col("event_type").alias("part")).agg(*totals), out)
    return scan(spark, out)


@query("reset_flow", "SELECT event_id, user_id, false AS other_there, false AS files_there FROM events")
def reset_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table and its folder are cleared, the table beside it stays."""
    root, (gone, kept) = scratch(spark, "flow"), (_table_name("gone"), _table_name("kept"))
    rows = frames.events(spark, sf_dir).select("event_id", "user_id")
    for name in (gone, kept):
        write(rows, name, "overwrite", path=f"{root}/{name}")
    reset(spark, [gone], [f"{root}/{gone}"], root)
    return table(spark, kept).withColumn("other_there", F.lit(spark.catalog.tableExists(gone))) \
        .withColumn("files_there", F.lit(path_exists(spark, f"{root}/{gone}")))
