"""Counts, ranges, sums, windows and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators import analytics
from sensorloom.workload import frames
from sensorloom.workload.registry import query

WINDOW_SQL = """SELECT user_id AS id, time_bucket(INTERVAL '10 minutes', ts) AS window_start,
    time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end,
    round(avg(value), 6) AS mean_velocity FROM events GROUP BY 1, 2, 3"""


def window_means(events: DataFrame) -> DataFrame:
    renamed = events.select(F.col("user_id").alias("id"), "ts", "value")
    return analytics.window_mean(renamed, "id", "ts", "value")


def flat_windows(means: DataFrame) -> DataFrame:
    return means.select(
        "id", F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        F.round("mean_velocity", 6).alias("mean_velocity"),
    )


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.count_rows(frames.table(spark, sf_dir, "lineitem"))


@query("count_by_id", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY user_id")
def count_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.count_by(frames.events(spark, sf_dir).withColumnRenamed("user_id", "id"), "id")


@query("count_by_id_status", f"""SELECT e.user_id AS id, s.status, count(*) AS n
    FROM events e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id GROUP BY 1, 2""")
def count_by_id_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = frames.events(spark, sf_dir).select(F.col("user_id").alias("id"))
    return analytics.count_by(events.join(frames.status(spark, sf_dir), ["id"], "left"), "id", "status")


@query("time_range", "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events")
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.time_range(frames.events(spark, sf_dir), "ts")


@query("daily_sum", """SELECT CAST(l_shipdate AS DATE) AS day, round(sum(l_quantity), 2) AS power
    FROM lineitem GROUP BY 1""")
def daily_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = analytics.daily_sum(frames.table(spark, sf_dir, "lineitem"), "l_shipdate", "l_quantity")
    return sums.withColumn("power", F.round("power", 2))


@query("window_mean", WINDOW_SQL)
def window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_windows(window_means(frames.events(spark, sf_dir)))


@query("window_series", """SELECT user_id AS id, time_bucket(INTERVAL '10 minutes', ts) AS window_start,
    round(avg(value), 6) AS mean_velocity FROM events WHERE user_id IN (5, 33) GROUP BY 1, 2""")
def window_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asking for single devices is the feature here: the series of named devices."""
    series = analytics.window_series(window_means(frames.events(spark, sf_dir)), [5, 33])
    return series.select("id", frames.wall_time("window_start"), F.round("mean_velocity", 6).alias("mean_velocity"))


@query("window_series_all", """SELECT user_id AS id, time_bucket(INTERVAL '10 minutes', ts) AS window_start,
    round(avg(value), 6) AS mean_velocity FROM events GROUP BY 1, 2""")
def window_series_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = analytics.window_series(window_means(frames.events(spark, sf_dir)))
    return series.select("id", frames.wall_time("window_start"), F.round("mean_velocity", 6).alias("mean_velocity"))


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frames.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return analytics.top_k(orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


@query("spread_by_type", """SELECT event_type, count(*) AS n, round(avg(value), 6) AS value_mean,
    round(stddev_samp(value), 6) AS value_sd, min(value) AS value_min, max(value) AS value_max
    FROM events GROUP BY 1""")
def spread_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.spread(frames.events(spark, sf_dir), ["value"], "event_type")
    return out.withColumns({c: F.round(c, 6) for c in ("value_mean", "value_sd")})
