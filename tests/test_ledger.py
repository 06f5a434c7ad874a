"""Signed rows in time: states, differences, restores, and streams that follow them."""

from __future__ import annotations

import datetime as dt
import os
import pathlib

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import streaming
from sensorloom.operators.corrections import row_changes
from sensorloom.operators.ledger import Ledger, step_of
from sensorloom.operators.quality import Rule, apply_rules
from sensorloom.plans.facts import plan_text
from sensorloom.session import scratch
from sensorloom.sources import scan

DDL = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("day", T.StringType()), T.StructField("v", T.DoubleType())])
CELL = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.sampled_from([1.0, 2.0])))


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def ordered(data):
    return sorted(map(tuple, data), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CELL, max_size=12), st.lists(CELL, max_size=6), st.booleans())
def test_every_state_stays_readable(spark, first, second, partitioned):
    ledger = Ledger(spark, scratch(spark, "ledger"), DDL, ("day",) if partitioned else ())
    states = [first]
    ledger.append(frame(spark, first), 0)
    ledger.delete_where("k < 2", 1)
    states.append([r for r in first if r[0] is None or r[0] >= 2])
    ledger.append(frame(spark, second), 2)
    states.append(states[1] + second)
    ledger.replace_where("v = 1.0", frame(spark, [(9, "a", 9.0)]), 3)
    states.append([r for r in states[2] if r[2] != 1.0] + [(9, "a", 9.0)])
    ledger.restore(1, 4)
    states.append(states[1])
    for step, state in enumerate(states):
        assert rows(ledger.as_of(step)) == ordered(state)
    assert rows(ledger.as_of()) == ordered(states[4])
    for a, b in ((0, 1), (1, 3), (0, 4)):
        want = row_changes(frame(spark, states[a]), frame(spark, states[b]), ["k"])
        assert rows(ledger.changes(a, b, ["k"])) == rows(want)
    small = ledger.compact(scratch(spark, "ledger"))
    assert rows(small.as_of()) == ordered(states[4]) and small.steps() == [4]


def test_steps_are_repeatable_and_in_order(spark):
    ledger = Ledger(spark, scratch(spark, "ledger"), DDL)
    ledger.append(frame(spark, [(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0)]), 10)
    for _ in range(2):  # as after a failure
        ledger.delete_where("k = 1", 20)
        assert rows(ledger.as_of()) == [(2, "b", 2.0)]
    for _ in range(2):
        ledger.merge_step(10, ["k"], 30)
        assert rows(ledger.as_of()) == [(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0)]
    with pytest.raises(ValueError, match="before"):
        ledger.append(frame(spark, []), 25)
    assert [tuple(r) for r in ledger.history().collect()] == [(30, 2, 0), (20, 0, 2), (10, 3, 0)]

    def broken(row):
        raise RuntimeError("lost")

    bad = frame(spark, [(3, "c", 3.0)]).rdd.map(broken).toDF(DDL)
    with pytest.raises(Exception, match="lost"):
        ledger.append(bad, 40)
    assert ledger.steps() == [10, 20, 30] and len(list(pathlib.Path(ledger.root).iterdir())) == 3


def test_instants_and_pruning(spark):
    ledger = Ledger(spark, scratch(spark, "ledger"), DDL, ("day",))
    at = lambda d: dt.datetime(2024, 3, d, tzinfo=dt.timezone.utc)
    ledger.append(frame(spark, [(1, "a", 1.0), (2, "b", 2.0)]), at(1))
    ledger.delete_where("day = 'a'", at(2))
    assert rows(ledger.as_of(dt.datetime(2024, 3, 1, 12))) == [(1, "a", 1.0), (2, "b", 2.0)]
    assert rows(ledger.as_of(at(2))) == [(2, "b", 2.0)]
    assert ledger.as_of(dt.datetime(2023, 1, 1)).count() == 0
    text = plan_text(ledger.log(at(1), at(2)))
    assert f"(_at#" in text and str(step_of(at(1))) in text and "PartitionFilters: [isnotnull(_at" in text
    empty = Ledger(spark, scratch(spark, "ledger"), DDL)
    assert empty.as_of().collect() == [] and empty.steps() == [] and empty.changes(0, None, ["k"]).collect() == []


def test_stream_follows_deletes_and_rewrites(spark):
    """Steps arrive between runs of one stream; cut anywhere, the target and the counts follow."""
    source = Ledger(spark, scratch(spark, "ledger"), DDL)
    target = Ledger(spark, scratch(spark, "ledger"), DDL)
    check, counts_at, counts_check = (scratch(spark, p) for p in ("ck", "counts", "ck"))
    data = [(i % 5, "a" if i < 30 else "b", float(i)) for i in range(60)]

    def run():
        changes = streaming.change_stream(source, max_files=1)
        streaming.follow(changes.where("v >= 10"), target, check).awaitTermination()
        counted = streaming.signed_counts(changes, ["k"], ["v"])
        streaming.rewrite_each_batch(counted, counts_at, counts_check, "update").awaitTermination()

    def verify(state):
        assert rows(target.as_of()) == ordered(r for r in state if r[2] >= 10)
        per_key = {k: [r[2] for r in state if r[0] == k] for k in {r[0] for r in state}}
        got = streaming.merge_counts(spark, counts_at, ["k"]).collect()
        assert {r["k"]: (r["n"], r["v"]) for r in got} == {k: (len(v), sum(v)) for k, v in per_key.items()}

    source.append(frame(spark, data), 0)
    run()
    verify(data)
    source.delete_where("day = 'a' OR k = 3", 1)
    kept = [r for r in data if r[1] != "a" and r[0] != 3]
    run()
    verify(kept)
    source.replace_where("k = 4", frame(spark, [(4, "c", 100.0)]), 2)
    source.append(frame(spark, data[:30]), 3)
    run()
    verify([r for r in kept if r[0] != 4] + [(4, "c", 100.0)] + data[:30])
    appended = streaming.new_rows_only(streaming.change_stream(source))
    out = scratch(spark, "appended")
    streaming.to_path(appended, out, scratch(spark, "ck")).awaitTermination()
    assert spark.read.schema(DDL).parquet(out).count() == 60 + 1 + 30


def files_in_order(spark, path, batches, ddl):
    known = set(pathlib.Path(path).glob("*.parquet"))
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(path)
        for file in set(pathlib.Path(path).glob("*.parquet")) - known:
            os.utime(file, (1_700_000_000 + len(known) + i, 1_700_000_000 + len(known) + i))
            known.add(file)


def test_latest_rows_of_a_stream(spark):
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    ddl = "k STRING, ts TIMESTAMP, n INT, v STRING"
    batches = [[("a", at(2), 1, "x"), ("b", at(1), 1, "y"), (None, at(1), 1, None)], [("a", at(1), 9, "old"), ("a", at(2), 1, "w")],
               [("b", at(3), 0, None), ("c", at(4), 0, "z")], [("b", at(2), 5, "late"), ("a", at(2), 0, "v"), (None, at(2), 0, "q")]]
    want = ordered([("a", at(2), 1, "x"), ("b", at(3), 0, None), ("c", at(4), 0, "z"), (None, at(2), 0, "q")])
    flat = [r for b in batches for r in b]
    assert rows(streaming.latest(spark.createDataFrame(flat, ddl), ["k"], ["ts", "n"])) == want
    for within in (None, F.window("ts", "1 day")):
        path, out = scratch(spark, "in"), scratch(spark, "out")
        files_in_order(spark, path, batches, ddl)
        stream = streaming.file_stream(spark, path, ddl, max_files=1)
        if within is not None:
            stream = stream.withWatermark("ts", "10 days")
        query = streaming.keep_latest(stream, ["k"], ["ts", "n"], out, scratch(spark, "ck"), within)
        query.awaitTermination()
        assert rows(streaming.latest_rows(spark, out, ["k"], ["ts", "n"])) == want


def test_closed_windows_leave_the_state(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    ddl = "k INT, ts TIMESTAMP"
    path, out = scratch(spark, "in"), scratch(spark, "out")
    files_in_order(spark, path, [[(i, at(d)) for i in range(20)] for d in (1, 5, 10, 15, 20)], ddl)
    stream = streaming.file_stream(spark, path, ddl, max_files=1).withWatermark("ts", "2 days")
    query = streaming.keep_latest(stream, ["k"], ["ts"], out, scratch(spark, "ck"), F.window("ts", "1 day"))
    query.awaitTermination()
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 40
    assert rows(streaming.latest_rows(spark, out, ["k"], ["ts"])) == [(i, at(20)) for i in sorted(range(20), key=lambda i: repr((i, at(20))))]


def test_status_is_read_again_for_every_batch(spark):
    path, status, out = (scratch(spark, p) for p in ("in", "status", "out"))
    ddl = "id DOUBLE, n INT"
    spark.createDataFrame([(1, "healthy")], "id INT, status STRING").write.parquet(status)
    query = streaming.label_refreshed(streaming.file_stream(spark, _file(spark, path, [(1.0, 0), (2.0, 0)], ddl), ddl),
                                      lambda: scan(spark, status), out, scratch(spark, "ck"), trigger=None)
    try:
        query.processAllAvailable()
        spark.createDataFrame([(1, "damaged"), (2, "healthy")], "id INT, status STRING").write.mode("overwrite").parquet(status)
        _file(spark, path, [(1.0, 1), (2.0, 1), (None, 1)], ddl)
        query.processAllAvailable()
    finally:
        query.stop()
    got = scan(spark, out).select("id", "n", "status")
    assert rows(got) == ordered([(1.0, 0, "healthy"), (2.0, 0, None), (1.0, 1, "damaged"), (2.0, 1, "healthy"), (None, 1, None)])


def _file(spark, path, data, ddl):
    spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(path)
    return path


def test_rule_counts_over_batches_restarts_and_failures(spark):
    path, out, check, counts = (scratch(spark, p) for p in ("in", "out", "ck", "counts"))
    ddl = "id INT, v DOUBLE"
    rules = [Rule("id", "id > 0", "drop"), Rule("v", "v >= 5")]
    files_in_order(spark, path, [[(i, float(i)), (-i, None)] for i in range(1, 8)], ddl)
    for more in ([], [(100, 100.0)]):
        if more:
            files_in_order(spark, path, [more], ddl)
        with streaming.RuleLog(spark, "rules", counts) as log:
            checked = apply_rules(streaming.file_stream(spark, path, ddl, max_files=2), rules, "rules")
            log.finished(streaming.to_path(checked, out, check))
    report = streaming.rule_report(spark, counts, rules)
    assert rows(report) == [("id", 8, 7, 15), ("v", 4, 11, 15)]
    # A second stream of the same source counts for itself; a folder without files is an empty report.
    other = scratch(spark, "counts")
    with streaming.RuleLog(spark, "rules", other) as log:
        log.finished(streaming.to_path(apply_rules(streaming.file_stream(spark, path, ddl), rules, "rules"), scratch(spark, "o"), scratch(spark, "c")))
    assert rows(streaming.rule_report(spark, other, rules)) == rows(report)
