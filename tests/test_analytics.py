import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from sensorloom.operators import analytics
from sensorloom.plans import plan_facts
from sensorloom.workload import frames


def test_rows_on_a_boundary_open_the_next_window(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 0, 9, 59, 999999), 1.0), (1, dt.datetime(2024, 1, 1, 0, 10), 3.0),
         (1, dt.datetime(2024, 1, 1, 0, 19), 5.0), (1, None, 7.0)], "id INT, ts TIMESTAMP, v DOUBLE")
    series = analytics.window_series(analytics.window_mean(df, "id", "ts", "v"), [1])
    assert series.columns == ["id", "window_start", "mean_velocity"]
    assert rows(series) == [(1, dt.datetime(2024, 1, 1, 0, 0), 1.0), (1, dt.datetime(2024, 1, 1, 0, 10), 4.0)]


def test_day_filter_is_pushed_to_the_scan(spark, sf_dir):
    day = analytics.on_day(frames.events(spark, sf_dir), "ts", dt.date(2024, 1, 15))
    assert any("GreaterThanOrEqual(ts" in f for f in plan_facts(day)["pushed_filters"])
    assert day.count() == frames.events(spark, sf_dir).where("to_date(ts) = '2024-01-15'").count() > 0


def test_day_filter_defaults_to_today(spark):
    df = spark.range(2).select(F.when(F.col("id") == 0, F.current_timestamp())
                               .otherwise(F.current_timestamp() - F.expr("INTERVAL 2 DAYS")).alias("ts"))
    assert analytics.on_day(df, "ts").count() == 1
    assert analytics.on_day(df.select(F.col("ts").cast("timestamp_ntz")), "ts").count() == 1


def test_aggregates_read_only_their_columns(spark, sf_dir):
    events = frames.events(spark, sf_dir)
    facts = plan_facts(analytics.daily_sum(events, "ts", "value"))
    assert facts["exchanges"] == 1 and facts["read_schemas"] == ["struct<ts:timestamp_ntz,value:double>"]
    assert plan_facts(analytics.count_rows(events))["read_schemas"] == ["struct<>"]


def test_top_k_does_not_sort_everything(spark, sf_dir):
    from sensorloom.plans.facts import plan_text

    assert "TakeOrderedAndProject" in plan_text(analytics.top_k(frames.events(spark, sf_dir), "value", 5))


def test_time_range_and_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k STRING, v DOUBLE")
    assert rows(analytics.time_range(df, "v")) == [(1.0, 3.0)]
    found = {r["k"]: r for r in analytics.spread(df, ["v"], "k").collect()}
    assert found["a"]["v_sd"] == 2 ** 0.5 and found["b"]["v_sd"] is None and found["a"]["n"] == 2
    assert rows(analytics.count_by(df, "k")) == [("a", 2), ("b", 1)]
