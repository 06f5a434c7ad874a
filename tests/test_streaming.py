import datetime as dt
import os
import pathlib

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom import streaming
from sensorloom.operators import analytics, bronze
from sensorloom.operators.gold import label
from sensorloom.plans import medallion
from sensorloom.session import scratch
from sensorloom.sources import create, table
from sensorloom.workload import frames, streams

DDL = "id INT, ts TIMESTAMP, v DOUBLE"


def files_of(spark, batches, ddl=DDL):
    """One file per batch; the file times give the order."""
    path, known = scratch(spark, "files"), set()
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(path)
        for file in set(pathlib.Path(path).glob("*.parquet")) - known:
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
            known.add(file)
    return path


def minute(m, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(minutes=m)


def land(df, checkpoint=None, path=None):
    spark, path = df.sparkSession, path or scratch(df.sparkSession, "landed")
    streaming.to_path(df, path, checkpoint or scratch(spark, "ck")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def test_each_file_once_over_a_restart(spark):
    path = files_of(spark, [[(i, minute(i), 1.0)] for i in range(5)])
    checkpoint, out = scratch(spark, "ck"), scratch(spark, "out")
    stream = lambda: streaming.file_stream(spark, path, DDL, max_files=2)
    assert land(stream(), checkpoint, out).count() == 5
    spark.createDataFrame([(9, minute(9), 1.0)], DDL).write.mode("append").parquet(path)
    found = land(stream(), checkpoint, out)
    assert sorted(r["id"] for r in found.collect()) == [0, 1, 2, 3, 4, 9]


def test_batches_replayed_after_a_failure_leave_no_duplicates(spark):
    path = files_of(spark, [[(i, minute(i), 1.0)] for i in range(4)])
    checkpoint, out = scratch(spark, "ck"), scratch(spark, "out")

    def failing(df, stop_at):
        def save(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            if batch_id == stop_at:
                raise RuntimeError("lost after the write")
        return (df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
                .foreachBatch(save).start())

    stream = streaming.file_stream(spark, path, DDL, max_files=1)
    with pytest.raises(Exception, match="lost after the write"):
        failing(stream, 2).awaitTermination()
    streaming.rewrite_each_batch(streaming.file_stream(spark, path, DDL, max_files=1), out, checkpoint,
                                 "append").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 200), st.integers(-5, 5)), min_size=1, max_size=6),
                min_size=1, max_size=4))
def test_windows_of_a_stream_equal_those_of_a_batch(spark, batches):
    batches = [[(i, minute(m), float(v)) for i, m, v in batch] for batch in batches]
    path = files_of(spark, batches)
    everything = spark.read.schema(DDL).parquet(path)
    flat = lambda df: rows(analytics.window_series(df))
    expected = flat(analytics.window_mean(everything, "id", "ts", "v"))
    for mode in ("complete", "update"):
        out = scratch(spark, "windows")
        means = analytics.window_mean(streaming.file_stream(spark, path, DDL, max_files=1), "id", "ts", "v",
                                      late="1 day")
        streaming.rewrite_each_batch(means, out, scratch(spark, "ck"), mode).awaitTermination()
        found = (streaming.latest_result(spark, out) if mode == "complete"
                 else streaming.merge_updates(spark, out, ["id", "window"]))
        assert flat(found) == expected
    raw = streaming.file_stream(spark, path, DDL, max_files=1)
    status = spark.createDataFrame([(0, "healthy"), (2, "damaged")], "id INT, status STRING")
    assert rows(land(label(raw, status))) == rows(label(everything, status))


def test_late_rows_are_dropped_in_append_mode_only(spark):
    # The engine lets rows in by the watermark of one batch earlier, hence the batch in between.
    times = [(0, 2.0), (180, 4.0), (181, 4.0), (5, 100.0), (400, 1.0)]
    batches = [[(1, minute(m), v)] for m, v in times]
    path = files_of(spark, batches)
    means = lambda: analytics.window_mean(
        streaming.file_stream(spark, path, DDL, max_files=1), "id", "ts", "v", late="1 hour")
    appended = land(means())
    found = {r["window"]["start"]: r["mean_velocity"] for r in appended.collect()}
    assert found == {minute(0): 2.0, minute(180): 4.0}
    out = scratch(spark, "complete")
    streaming.rewrite_each_batch(means(), out, scratch(spark, "ck")).awaitTermination()
    complete = {r["window"]["start"]: r["mean_velocity"] for r in streaming.latest_result(spark, out).collect()}
    assert complete == {minute(0): 51.0, minute(180): 4.0, minute(400): 1.0}


def test_load_is_idempotent_and_incremental(spark):
    path, checkpoint = files_of(spark, [[(1, minute(1), 1.0)], [(2, minute(2), 1.0)]]), scratch(spark, "ck")
    create(spark, "loaded", DDL, path=scratch(spark, "loaded"))
    counts = [streaming.copy_into(spark, "loaded", path, checkpoint, schema=DDL) for _ in range(2)]
    spark.createDataFrame([(3, minute(3), 1.0)], DDL).write.mode("append").parquet(path)
    counts.append(streaming.copy_into(spark, "loaded", path, checkpoint, schema=DDL))
    assert counts == [2, 0, 1] and table(spark, "loaded").count() == 3
    spark.sql("DROP TABLE loaded")


def test_expectation_counts_of_a_stream(spark, sf_dir):
    silver = medallion.silver(frames.raw(frames.events_stream(spark, sf_dir)), frames.READING_DDL)
    query = streaming.to_path(silver, scratch(spark, "out"), scratch(spark, "ck"))
    query.awaitTermination()
    seen = [p.observedMetrics["silver"] for p in query.recentProgress if "silver" in p.observedMetrics]
    assert sum(m["id_passed"] for m in seen) == frames.events(spark, sf_dir).where("user_id > 0").count()


def test_failing_rule_stops_a_stream(spark):
    path = files_of(spark, [[(1, None, 1.0)]])
    raw = frames.encode(streaming.file_stream(spark, path, DDL).select(
        F.col("id").alias("ID"), F.col("v").alias("SPEED"), F.col("ts").alias("TIMESTAMP")), "ID")
    with pytest.raises(Exception, match="rule 'timestamp' failed"):
        land(medallion.silver(raw, frames.READING_DDL))


def test_dedup_of_a_stream(spark):
    path = files_of(spark, [[(1, minute(1), 1.0), (2, minute(1), 1.0)], [(1, minute(2), 5.0)]])
    stream = streaming.file_stream(spark, path, DDL, max_files=1).withWatermark("ts", "1 hour")
    assert rows(land(bronze.dedup(stream, ["id"], within_watermark=True)).select("id")) == [(1,), (2,)]
    salted = bronze.dedup(streaming.file_stream(spark, path, DDL, max_files=1).withWatermark("ts", "1 hour"), ["id"],
                          within_watermark=True, salt=4)
    assert rows(land(salted).select("id")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        bronze.dedup(stream, ["id"], ["ts"])


def test_triggers_names_and_stopping(spark):
    path = files_of(spark, [[(1, minute(1), 1.0)]])
    streaming.configure(spark, scratch(spark, "checkpoints"))
    query = streaming.to_table(streaming.file_stream(spark, path, DDL), "periodic", trigger="10 seconds",
                               name="periodic_write", path=scratch(spark, "periodic"))
    query.processAllAvailable()
    assert query.name == "periodic_write" and table(spark, "periodic").count() == 1
    assert streaming.stop_all(spark) == 1 and not spark.streams.active
    spark.sql("DROP TABLE periodic")
    spark.conf.unset("spark.sql.streaming.checkpointLocation")


def test_rewritten_sources_are_refused(spark):
    path = files_of(spark, [[(1, minute(1), 1.0)]])
    with pytest.raises(ValueError, match="new snapshot"):
        streaming.to_table(streaming.file_stream(spark, path, DDL), "t", source_is_append_only=False)


def test_schema_has_to_be_given_or_inferred(spark):
    path = files_of(spark, [[(1, minute(1), 1.0)]])
    with pytest.raises(ValueError):
        streaming.file_stream(spark, path)
    assert streaming.file_stream(spark, path, infer=True).columns == ["id", "ts", "v"]


def test_connectors_are_named(spark):
    with pytest.raises(ValueError):
        streaming.connect(spark, "kafka", "middle")
    rate = streaming.connect(spark, "rate", rowsPerSecond=1)
    assert rate.isStreaming and rate.columns == ["timestamp", "value"]


def test_tables_may_be_folders_of_files(spark, sf_dir):
    """On a cluster each table is a folder; the streams of the named queries read that too."""
    from sensorloom.workload import QUERIES

    copy = scratch(spark, "sf")
    for name in ("events", "supplier"):
        frames.table(spark, sf_dir, name).repartition(3).write.parquet(f"{copy}/{name}.parquet")
    for query in ("stream_label_join", "stream_window_complete", "layered_flow", "bucketed_join"):
        assert rows(QUERIES[query](spark, copy)) == rows(QUERIES[query](spark, sf_dir)), query


def test_copy_into_counts_every_batch(spark):
    files = scratch(spark, "many")
    spark.range(60).repartition(6).write.parquet(files)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        loaded = streaming.copy_into(spark, "counted", files, scratch(spark, "checkpoint"), schema="id BIGINT",
                                     table_path=scratch(spark, "counted"), max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert loaded == 60


@pytest.mark.parametrize("name", ["file_stream", "declarative_stream"])
def test_micro_batches_do_not_multiply_with_the_table(spark, tmp_path, monkeypatch, name):
    n = 200_000
    spark.range(n).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id % 9 + 1 AS user_id",
                              "'view' AS event_type", "0.5D AS value", "'{}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT 1L AS s_suppkey, 2.0D AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    made = []
    monkeypatch.setattr(streams, "scratch", lambda *a: made.append(scratch(*a)) or made[-1])
    assert getattr(streams, name)(spark, str(tmp_path)).count() == n
    commits = next(pathlib.Path(p) / "commits" for p in made if pathlib.Path(p).name.startswith("checkpoint"))
    assert 2 <= len([f for f in commits.iterdir() if f.name.isdigit()]) <= 24


def test_landed_files_grow_and_their_number_does_not(spark):
    for n, take, most in [(0, 2, 9), (1000, 2, 18), (50_000, 4, 72)]:
        path = scratch(spark, "landed")
        assert frames.land_files(spark.range(n), path, 100) == take
        assert len(list(pathlib.Path(path).glob("*.parquet"))) <= most
        assert spark.read.schema("id BIGINT").parquet(path).distinct().count() == n


def test_files_of_many_tasks_are_taken_together(spark):
    path = scratch(spark, "landed")
    take = frames.land_files(spark.range(0, 4000, 1, 200), path, 100)
    landed = len(list(pathlib.Path(path).glob("*.parquet")))
    assert landed == 200 and landed / take < 32
