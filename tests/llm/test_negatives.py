"""Hard negatives against all inner products, with ties, repeated rows and odd vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import negatives
from sensorloom.llm.queries import QUERIES, relabelled

SCHEMA = "vec_id bigint, embedding array<double>, label bigint, row string, shard int, cluster int, v string"


def brute(rows):
    held = set()
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        held.add((vec_id, label, tuple(math.floor(256 * c) for c in x)))
    held, out = sorted(held), []
    for a in held:
        if a[0] % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in held if r != a and len(r[2]) == len(a[2])]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2] == a[1]][:5]:
            good = [s for s in scored if s[2] != a[1] and 80 * -score <= 100 * -s[0] <= 100 * -score][:5]
            out += [(a[0], positive, i + 1, s[1], -score, -s[0]) for i, s in enumerate(good)]
    return sorted(out)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    found = negatives.mine(negatives.whole_rows(frame, relabelled()), F.pmod("vec_id", F.lit(100)) == 0)
    return sorted(tuple(r) for r in found.collect())


def clouds(rng, n, labels, spread):
    middle = [rng.normal(size=16) for _ in range(labels)]
    return [(i, (middle[i % labels] + spread * rng.normal(size=16)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_equals_all_inner_products(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "SMALL", 200)  # several shards
    monkeypatch.setattr(negatives, "MEMBERS", 3)  # several blocks of a cluster
    rows = clouds(np.random.default_rng(5), 1500, 10, spread)
    want = brute(rows)
    assert len(want) > 50 and run(spark, rows) == want


def test_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SMALL", 100)
    rng = random.Random(1)
    same = [0.5, 0.25, -0.125]
    rows = [(i, same, rng.randrange(3)) for i in range(400)]  # one vector in a third of all rows
    rows += [(1000 + i, [rng.random() for _ in range(3)], rng.randrange(10)) for i in range(300)]
    rows += [(2000, [0.0, 0.0, 0.0], 1), (2100, [], 1), (2101, [], 2), (2200, [1.0, 1.0], 3), (2201, [1.0, 1.0], 3), (2202, [0.9, 1.0], 4)]
    rows += [(3000, None, 1), (3100, [1.0, None, 2.0], 1), (3200, [float("nan"), 1.0, 1.0], 1), (3300, [float("inf"), 1.0, 1.0], 1),
             (3400, same, None), (None, same, 1), (3500, [1e200, 1.0, 1.0], 1), (0, same, rows[0][2]), (0, same, rows[0][2])]
    assert run(spark, rows) == brute([r for r in rows if r[0] != 3500])
    assert run(spark, []) == [] and run(spark, rows[:1]) == []


def test_large_numbers_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(1 << 18, 1 << 20)) for _ in range(4)], i % 4) for i in range(300)]
    want = brute(rows)
    assert max(r[5] for r in want) > 1 << 53 and run(spark, rows) == want


def test_bounds_certify():
    """No candidate scores above its bound, and the list is walked only as far as needed."""
    rng = np.random.default_rng(8)
    vectors = np.floor(256 * np.concatenate([rng.normal(size=(3000, 8)), rng.normal(size=(3000, 8)) * 0.1]))
    shard = negatives.Shard(np.arange(6000), np.arange(6000), np.zeros(6000, int), vectors)
    centre = rng.normal(size=8)
    centre /= np.linalg.norm(centre)
    asked = np.floor(256 * (centre + 0.05 * rng.normal(size=(20, 8))))
    cosine = asked @ centre / np.linalg.norm(asked, axis=1)
    shard.sort_for(centre, cosine.min())
    score = asked @ shard.vectors[shard.order].T
    assert (score <= np.linalg.norm(asked, axis=1)[:, None] * shard.bound).all()
    assert (np.diff(shard.bound) <= 0).all()
    seen = []
    question, place, found = shard.walk(asked, np.arange(20), np.full(20, -1 << 60), np.full(20, 1 << 60), 5,
                                        lambda users, piece: seen.append(len(piece)) or np.ones((len(users), len(piece)), bool))
    assert sum(seen) < 2000
    for q in range(20):
        assert found[question == q].tolist() == sorted((asked[q] @ vectors.T).astype(int).tolist(), reverse=True)[:5]


def test_registered_query(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding, r.label) for r in table])
    assert sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, small).collect()) == want
