"""Periodic runs against a scan of every lag."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from sensorloom.llm import periods
from sensorloom.llm.queries import QUERIES


def every_lag(words):
    n, found = len(words), {}
    for lag in range(1, n // 4 + 1):
        i = 0
        while i + lag < n:
            j = i
            while j + lag < n and words[j] == words[j + lag]:
                j += 1
            if j + lag - i >= max(6, 4 * lag):
                found.setdefault((i, j + lag), lag)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def woven(rng):
    """Words with cycles of many lengths, cut, nested and disturbed."""
    letters, out = rng.choice([1, 2, 3, 5, 50]), []
    while len(out) < rng.randrange(300):
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randrange(letters) for _ in range(rng.randrange(1, 20))]
        elif kind < 0.9:
            cycle = [rng.randrange(letters) for _ in range(rng.randrange(1, 40))]
            out += (cycle * 8)[:rng.randrange(1, 7 * len(cycle) + 2)]
        elif out:
            at = rng.randrange(len(out))
            out += out[at:at + rng.randrange(50)] * rng.randrange(1, 6)
    return out


def test_runs_equal_those_of_every_lag():
    rng = random.Random(4)
    seen = 0
    for _ in range(1500):
        words = woven(rng)
        own = periods.find_in(np.array(words, np.int64))
        assert own == every_lag(words)
        seen += len(own)
    assert seen > 1500


def test_long_texts():
    cycle = np.random.default_rng(0).integers(0, 1000, 10_000)
    assert periods.find_in(np.tile(cycle, 5)) == [(0, 50_000, 10_000)]
    assert periods.find_in(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    a, b = [0], [0, 1]  # no fourth power in a Fibonacci word
    while len(b) < 50_000:
        a, b = b, b + a
    assert periods.find_in(np.array(b)) == []


def expected(doc_id, text):
    words = periods.split_words(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = every_lag(periods.numbered_words(words).tolist())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_report_equals_brute_force(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{x}" for x in woven(rng)) for _ in range(300)]
    texts += [None, "", " \n\t ", "a", "é é é é é é é", "a\x1cb a\x1cb a\x85 a\xa0b", "x\ty\nx y\rx\x0by\x0cx y"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (5, texts[5]), (5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in periods.report(periods.plant(docs)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r[1] for r in got) > 300


def test_other_columns_pass(spark, odd, none):
    clash = odd.withColumn("runs", F.lit("own")).withColumn("collapsed", F.lit(1)).withColumn("N_Words", F.lit(2))
    out = periods.find_runs(clash.drop("runs", "collapsed", "N_Words").withColumn("start", F.lit(3)))
    assert out.count() == odd.count() and out.where("start = 3 AND runs IS NOT NULL").count() == odd.count()
    assert periods.find_runs(none).collect() == []
    renamed = periods.find_runs(odd.select("doc_id", F.col("text").alias("collapsed")).limit(3), "collapsed")
    assert renamed.count() == 3


def test_registered_query(spark, small):
    assert QUERIES["op13_periodic_runs"](spark, small).count() == spark.read.parquet(f"{small}/documents.parquet").count()
