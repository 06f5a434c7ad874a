"""Operators against plain Python on small random tables."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import bronze, corrections, features, gold

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(KEY, st.sampled_from(["a", "b", None])), max_size=12)
DDL = "id INT, v STRING"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@few
@given(ROWS, ROWS)
def test_row_changes(spark, before, after):
    old, new = Counter(before), Counter(after)
    lost, won = old - new, new - old
    expected = Counter()
    for sign, change in ((lost, "delete"), (won, "insert")):
        for (key, v), n in sign.items():
            paired = key is not None and all(
                sum(c for (k, _), c in side.items() if k == key) == 1 for side in (lost, won))
            name = {"delete": "update_pre", "insert": "update_post"}[change] if paired else change
            expected[(key, v, name, n)] += 1
    assert bag(corrections.row_changes(frame(spark, before), frame(spark, after), ["id"])) == expected


@few
@given(ROWS, ROWS)
def test_merge_insert(spark, target, source):
    keys = {(k, v) for k, v in target if k is not None and v is not None}
    expected = Counter(target) + Counter(r for r in source if r not in keys)
    assert bag(corrections.merge_insert(frame(spark, target), frame(spark, source), ["id", "v"])) == expected


@few
@given(ROWS, st.integers(1, 4))
def test_balance(spark, rows, cap):
    found = bag(features.balance(frame(spark, rows), "v", cap, ["a", "b"]))
    for name in ("a", "b"):
        have = sum(n for (_, v), n in found.items() if v == name)
        assert have == min(cap, sum(1 for _, v in rows if v == name))
    assert not found - Counter(rows)


@few
@given(ROWS, st.integers(2, 5))
def test_salted_label(spark, readings, salt):
    left = frame(spark, readings)
    status = spark.createDataFrame([(0, "ok"), (1, "bad")], "id INT, status STRING")
    names = {0: "ok", 1: "bad"}
    expected = Counter((k, v, names.get(k)) for k, v in readings)
    assert bag(gold.label(left, status, salt=salt)) == expected == bag(gold.label(left, status))


@few
@given(ROWS)
def test_dedup_keeps_the_first(spark, rows):
    found = bag(bronze.dedup(frame(spark, rows), ["id"], [F.col("v").asc_nulls_last()]))
    best = {}
    for k, v in rows:
        best[k] = min(best.get(k, v), v, key=lambda x: (x is None, x or ""))
    assert found == Counter(best.items())


@pytest.mark.parametrize("k", [1, 3])
def test_first_per_group_over_many_slices(spark, k):
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("o"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1100")
        plan = features.first_per_group(df, "g", ["o"], k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        found = bag(plan)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    everything = {}
    for g, o in (tuple(r) for r in df.collect()):
        everything.setdefault(g, []).append(o)
    assert found == Counter((g, o) for g, values in everything.items() for o in sorted(values)[:k])
