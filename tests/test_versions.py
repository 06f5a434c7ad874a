import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sensorloom.operators import corrections, layout, snapshots
from sensorloom.plans import plan_facts
from sensorloom.session import scratch
from sensorloom.sources import table
from sensorloom.workload import frames


def at(day):
    return dt.datetime(2024, 3, day, tzinfo=dt.timezone.utc)


@pytest.fixture
def readings(spark):
    """Three days, one of them with most of the rows."""
    return spark.range(300).select(
        F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, "
                            "cast(case when id % 10 = 0 then 1 when id % 10 = 1 then 2 else 0 end as int))").alias("ts"),
        (F.col("id") / 2).alias("v"),
    ).withColumn("day", F.col("ts").cast("date"))


def test_delete_keeps_rows_with_a_null_predicate(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v INT")
    assert rows(corrections.delete_where(df, "v > 3")) == [(1,), (None,)]


def test_merge_inserts_null_keys_and_all_copies(spark):
    target = spark.createDataFrame([(1, 1, "old"), (None, 2, "old")], "id INT, t INT, v STRING")
    source = spark.createDataFrame(
        [(1, 1, "new"), (None, 2, "new"), (3, 3, "new"), (3, 3, "new"), (4, None, "new")], "id INT, t INT, v STRING")
    merged = corrections.merge_insert(target, source, ["id", "t"])
    assert rows(merged) == sorted(
        [(1, 1, "old"), (None, 2, "old"), (None, 2, "new"), (3, 3, "new"), (3, 3, "new"), (4, None, "new")], key=repr)


def test_delete_then_merge_restores_the_rows(spark, readings):
    root = scratch(spark, "table")
    assert snapshots.write(spark, root, readings, ["day"], at(1)) == 0
    assert snapshots.delete_where(spark, root, "ts < timestamp_ntz'2024-01-02 00:00:00'", at(2)) == 1
    assert snapshots.read(spark, root).agg(F.min("ts")).first()[0] == dt.datetime(2024, 1, 2)
    assert rows(snapshots.read(spark, root, version=0)) == rows(readings)
    assert snapshots.merge_insert(spark, root, snapshots.read(spark, root, version=0), ["id", "ts"], at(3)) == 2
    assert rows(snapshots.read(spark, root)) == rows(readings)
    history = snapshots.history(spark, root).select("version", "operation", "rows_added", "rows_removed")
    assert [tuple(r) for r in history.collect()] == [(2, "MERGE", 240, 0), (1, "DELETE", 0, 240), (0, "WRITE", 300, 0)]


def test_merge_of_an_old_version_equals_a_plain_merge(spark, readings):
    holes = readings.withColumn("id", F.when(F.col("id") % 17 != 0, F.col("id")))
    found = []
    for merge in (lambda r: snapshots.merge_insert(spark, r, snapshots.read(spark, r, version=0), ["id", "ts"]),
                  lambda r: snapshots.merge_version(spark, r, 0, ["id", "ts"])):
        root = scratch(spark, "table")
        snapshots.write(spark, root, holes, ["day"])
        snapshots.delete_where(spark, root, "ts < timestamp_ntz'2024-01-02 00:00:00' AND v < 80")
        merge(root)
        found.append(rows(snapshots.read(spark, root)))
    assert found[0] == found[1] and len(found[0]) > 300


def test_delete_leaves_other_days_alone(spark, readings):
    root = scratch(spark, "table")
    snapshots.write(spark, root, readings, ["day"])
    snapshots.delete_where(spark, root, "id = 0")
    old, new = (set(snapshots._required(spark, root, v)["folders"]) for v in (0, 1))
    assert len(old & new) == 2 and len(new) == 3
    assert snapshots.read(spark, root).count() == 299
    snapshots.delete_where(spark, root, "id = 12345")
    assert set(snapshots._required(spark, root, 2)["folders"]) == new


def test_time_travel_by_instant(spark, readings):
    root = scratch(spark, "table")
    snapshots.write(spark, root, readings.limit(5), at=at(1))
    snapshots.write(spark, root, readings.limit(7), at=at(3))
    assert snapshots.read(spark, root, as_of=at(2)).count() == 5
    assert snapshots.read(spark, root, as_of=at(3)).count() == 7
    with pytest.raises(ValueError):
        snapshots.read(spark, root, as_of=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    with pytest.raises(ValueError):
        snapshots.read(spark, root, version=9)


def test_emptied_table_can_be_read_and_filled(spark, readings):
    for partition_by in ([], ["day"]):
        root = scratch(spark, "table")
        snapshots.write(spark, root, readings, partition_by)
        snapshots.delete_where(spark, root, "true")
        empty = snapshots.read(spark, root)
        assert empty.count() == 0 and empty.columns == readings.columns
        snapshots.append(spark, root, readings)
        assert rows(snapshots.read(spark, root)) == rows(readings)


def test_append_can_add_a_column(spark, readings):
    root = scratch(spark, "table")
    snapshots.write(spark, root, readings.select("id"))
    snapshots.append(spark, root, readings.select("id", F.lit("x").alias("extra")))
    assert rows(snapshots.read(spark, root).groupBy("extra").count()) == [("x", 300), (None, 300)]
    assert snapshots.read(spark, root, version=0).columns == ["id"]


def test_changes_between_versions(spark):
    before = spark.createDataFrame(
        [(1, "same"), (2, "old"), (3, "gone"), (None, "nokey"), (5, "twice"), (5, "twice"), (6, None)], "id INT, v STRING")
    after = spark.createDataFrame(
        [(1, "same"), (2, "new"), (4, "born"), (None, "other"), (5, "twice"), (6, None)], "id INT, v STRING")
    root = scratch(spark, "table")
    snapshots.write(spark, root, before)
    snapshots.write(spark, root, after)
    assert rows(snapshots.changes(spark, root, 0, 1, ["id"])) == sorted([
        (2, "old", "update_pre", 1), (2, "new", "update_post", 1), (3, "gone", "delete", 1), (4, "born", "insert", 1),
        (None, "nokey", "delete", 1), (None, "other", "insert", 1), (5, "twice", "delete", 1)], key=repr)


def test_changes_read_only_what_differs(spark, readings):
    root = scratch(spark, "table")
    snapshots.write(spark, root, readings, ["day"])
    snapshots.delete_where(spark, root, "id = 0")
    changed = snapshots.changes(spark, root, 0, 1, ["id"])
    assert rows(changed.select("id", "_change")) == [(0, "delete")]
    files = {f for f in changed.inputFiles()}
    assert all("day=2024-01-02" in f for f in files)


def test_restore_copies_nothing_and_clone_copies_all(spark, readings):
    root, copy = scratch(spark, "table"), scratch(spark, "copy")
    snapshots.write(spark, root, readings, ["day"])
    snapshots.delete_where(spark, root, "id < 100")
    assert snapshots.restore(spark, root, version=0) == 2
    assert snapshots._required(spark, root, 2)["folders"] == snapshots._required(spark, root, 0)["folders"]
    snapshots.clone(spark, root, copy, version=1)
    assert rows(snapshots.read(spark, copy)) == rows(readings.where("id >= 100"))
    assert all(copy in f for f in snapshots.read(spark, copy).inputFiles())


def test_detail_and_compaction(spark, readings):
    root = scratch(spark, "table")
    snapshots.write(spark, root, readings.repartition(12))
    before = snapshots.detail(spark, root).first()
    snapshots.compact(spark, root, 2)
    after = snapshots.detail(spark, root).first()
    assert before["num_files"] == 12 and after["num_files"] == 2 and after["size_in_bytes"] > 0
    assert after["version"] == 1 and after["partition_columns"] == []
    assert rows(snapshots.read(spark, root)) == rows(readings)
    snapshots.compact(spark, root)
    assert snapshots.detail(spark, root).first()["num_files"] == 1
    small, big = scratch(spark, "small"), scratch(spark, "big")
    readings.repartition(9).write.parquet(small)
    layout.compact(spark, small, big)
    assert len(spark.read.parquet(big).inputFiles()) == 1 and rows(spark.read.parquet(big)) == rows(readings)


def test_derived_partition_prunes(spark, sf_dir):
    layout.write_partitioned(frames.events(spark, sf_dir), "dated_events", "ts", path=scratch(spark, "dated"))
    dated = table(spark, "dated_events")
    plain = dated.where("ts > timestamp_ntz'2024-01-19 15:17:05'")
    pruned = layout.prune(dated, "ts", lower="2024-01-19 15:17:05", strict=True)
    assert plan_facts(plain)["partition_filters"] == []
    assert "yymmdd" in plan_facts(pruned)["partition_filters"][0]
    assert rows(pruned) == rows(plain)
    both = layout.prune(dated, "ts", lower=dt.datetime(2024, 1, 5), upper=dt.datetime(2024, 1, 6))
    assert rows(both) == rows(dated.where("ts between timestamp_ntz'2024-01-05' and timestamp_ntz'2024-01-06'"))
    with pytest.raises(ValueError):
        layout.prune(dated, "ts", lower="2024-00-19")
    spark.sql("DROP TABLE dated_events")


def test_bucket_count_grows_with_the_files(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    assert layout.bucket_count(spark, path) == 16
    assert layout.bucket_count(spark, path, target_bytes=1000) > 100
