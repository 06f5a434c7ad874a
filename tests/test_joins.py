import datetime as dt
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sensorloom.operators import bronze, gold, layout
from sensorloom.plans import plan_facts
from sensorloom.session import scratch
from sensorloom.sources import table
from sensorloom.workload import frames


@pytest.fixture
def hot(spark):
    """A third of all rows on one device, some on no device, half of the devices without status."""
    readings = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
        .cast("double").alias("ID"), F.col("id").alias("n"))
    status = spark.range(0, 40, 2).select(F.col("id").cast("int"), F.lit("healthy").alias("status"))
    return readings, status


def test_label_keeps_every_reading_and_salt_changes_nothing(hot):
    readings, status = hot
    plain, salted = gold.label(readings, status), gold.label(readings, status, salt=5)
    assert plain.columns == salted.columns == ["ID", "n", "status"]
    assert rows(plain) == rows(salted)
    assert plain.count() == 3000
    assert plain.where("status IS NULL AND id % 2 = 0").count() == 0


def test_status_has_to_be_unique(spark):
    status = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id INT, status STRING")
    with pytest.raises(ValueError, match="not unique"):
        gold.assert_unique(status, "id")
    assert gold.assert_unique(status.where("status > 'a'"), "id").count() == 3


def test_hint_forces_sort_merge(hot):
    readings, status = hot
    plan = plan_facts(gold.join_hinted(readings, status, "id"))
    assert plan["sort_merge_joins"] == 1 and plan["broadcast_joins"] == 0 and plan["exchanges"] == 2


def bucketed(spark, hot, salt, n=16):
    readings, status = hot
    a, b = (f"{x}_{uuid.uuid4().hex[:8]}" for x in ("data", "status"))
    layout.write_bucketed(readings.withColumnRenamed("ID", "id"), a, "id", n, salt, scratch(spark, a))
    layout.write_replicated(status, b, "id", n, salt, scratch(spark, b))
    return table(spark, a), table(spark, b)


def test_bucketed_join_and_count_have_no_exchange(spark, hot):
    data, status = bucketed(spark, hot, 1)
    assert plan_facts(layout.join_bucketed(data, status, "id"))["exchanges"] == 0
    assert plan_facts(layout.count_bucketed(data, "id"))["exchanges"] == 0
    assert plan_facts(hot[0].groupBy("ID").count())["exchanges"] == 1


def test_salted_buckets_spread_the_hot_device(spark, hot):
    data, status = bucketed(spark, hot, 16)
    joined = layout.join_bucketed(data, status, "id")
    assert plan_facts(joined)["exchanges"] == 0
    assert plan_facts(layout.count_bucketed(data, "id"))["exchanges"] == 1
    expected = hot[0].join(hot[1], "id").select(F.col("id").cast("bigint"), "n", "status")
    assert rows(joined.select("id", "n", "status")) == rows(expected)
    files = data.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert files < 600  # unsalted, one file would hold more than a third of the 3000 rows


def test_only_hot_devices_are_spread(spark, hot):
    readings, devices = hot
    devices = devices.union(spark.createDataFrame([(7, "damaged")], devices.schema))  # the hot one
    salts = layout.hot_keys(readings.withColumnRenamed("ID", "id"), "id", 150)
    sizes = {r["ID"]: r["count"] for r in readings.groupBy("ID").count().collect()}
    assert salts == {(None if k is None else int(k)): -(-n // 150) for k, n in sizes.items() if n >= 300} and salts
    data, copies = bucketed(spark, (readings, devices), salts)
    joined = layout.join_bucketed(data, copies, "id")
    assert plan_facts(joined)["exchanges"] == 0
    expected = readings.join(devices, "id").select(F.col("id").cast("bigint"), "n", "status")
    assert rows(joined.select("id", "n", "status")) == rows(expected)
    assert rows(layout.count_bucketed(data, "id")) == rows(readings.groupBy(F.col("ID").cast("bigint").alias("id")).count())
    # Status rows are repeated for hot devices alone, readings of other devices keep one salt.
    known = {r["id"] for r in devices.collect()}
    assert copies.count() == devices.count() + sum(n - 1 for k, n in salts.items() if k in known) > devices.count()
    assert data.groupBy("id").agg(F.count_distinct(layout.SALT).alias("s")).where("s > 1").count() <= len(salts)
    files = data.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert files < 600
    assert layout.hot_keys(readings.withColumnRenamed("ID", "id").limit(0), "id", 10) == {}
    none = bucketed(spark, (readings, devices), {})
    assert rows(layout.join_bucketed(*none, "id").select("id", "n", "status")) == rows(expected)


def test_count_of_null_key_and_fractional_keys(spark, hot):
    data, _ = bucketed(spark, hot, 16)
    assert rows(layout.count_bucketed(data, "id")) == rows(
        hot[0].groupBy(F.col("ID").cast("bigint").alias("id")).count())
    bad = spark.createDataFrame([(1.5,)], "id DOUBLE")
    with pytest.raises(Exception, match="not a whole number"):
        layout.write_bucketed(bad, "never_written", "id", 2, path=scratch(spark, "bad"))


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1.0, "x")], "key DOUBLE, value STRING")
    b = spark.createDataFrame([("y", 2.0)], "value STRING, key DOUBLE")
    assert rows(bronze.union_sources(a, b)) == [(1.0, "x"), (2.0, "y")]


def test_dedup_by_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e")],
                               "id INT, t INT, v STRING")
    assert rows(bronze.dedup(df, ["id"], [F.desc("t")])) == [(1, 9, "b"), (2, 1, "c"), (None, 2, "e")]
    assert bronze.dedup(df, ["id"]).count() == 3


def test_messages_repeat_and_are_one_per_device(spark, sf_dir):
    rows_in = frames.readings(frames.events(spark, sf_dir)).drop("TIMESTAMP")
    at = dt.datetime(2024, 5, 1)
    make = lambda df: bronze.make_messages(df, 0.5, 300, key="ID", order=["EVENT"], at=at)
    once = rows(make(rows_in))
    assert once == rows(make(rows_in.repartition(5)))
    assert len({key for key, _ in once}) == len(once) > 5
    assert all('"TIMESTAMP":"2024-05-01T00:00:00.000000Z"' in value for _, value in once)
    loose = bronze.make_messages(rows_in, 0.5, 300, key="ID")
    assert 0 < loose.count() <= 300
