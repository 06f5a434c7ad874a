"""Trained operators: held-out accuracy, planted cases, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import decontaminate, quality, toxicity, vamana
from tests.llm.conftest import SCHEMA, sentences, words

INSULTS = ["grumblehead", "snotface", "dirtbagger", "numbskull"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(300):
        text = sentences(rng, 60).split()
        toxic, bad = int(i % 4 == 0), int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        if bad:
            text = [w.upper() + "!!" for w in text]
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1 - bad, toxic))
    return (spark.createDataFrame(docs, SCHEMA),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_quality_keeps_good_documents(labelled, spark):
    docs, labels = labelled
    kept = {r.doc_id for r in quality.keep(docs, labels.where("doc_id < 200")).collect()}
    good = [i for i in range(200, 300) if i % 5]
    assert np.mean([i in kept for i in good]) >= 0.95
    assert np.mean([i in kept for i in range(200, 300, 5)]) <= 0.1


def test_gumbel_top_k_is_the_k_largest(labelled):
    docs, labels = labelled
    scored, drawn = quality.resample(docs, labels, k=37)
    want = sorted(((-r.draw, r.doc_id) for r in scored.collect()))[:37]
    assert [d for _, d in want] == [r.doc_id for r in drawn.orderBy("rank").collect()]


def test_long_forms_differ_at_their_end():
    store = quality._Words()
    one, other = (store["x1" * 30 + end] & 0xFFFF for end in ("-x", "+x"))
    assert one != other


def test_quality_edge_cases(spark, odd, none, labelled):
    _, labels = labelled
    kept = quality.keep(odd, labels)
    assert kept.columns == odd.columns
    assert quality.keep(odd, labels.limit(0)).count() == odd.count()
    assert quality.keep(none, labels).collect() == []


def test_toxicity_held_out(labelled, odd, none):
    docs, labels = labelled
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r.toxic for r in held]) >= 0.95
    scored = toxicity.classify(odd, labels)
    assert scored.count() == odd.count() and scored.where("score is null").count() == 0
    assert toxicity.classify(none, labels).collect() == []
    assert toxicity.classify(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_toxicity_tolerates_gaps(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels, F.lit(True))
    plain, gapped, other = (model.margins(ws) for ws in (
        INSULTS, ["grum-ble-head", "s.n.o.t.f.a.c.e", "dirtbxagger", "n u m b s k u l l".replace(" ", "*")], ["abcdefgh", "ponmlk"]))
    assert plain.min() > other.max() and gapped.min() > other.max()
    features = model.documents(["g r u m b l e h e a d you", "abcd efgh"], {})
    assert features[0, 0] > features[1, 0]


def naive_kernel(a, b):
    def weights(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    key = w[i] + w[j] + w[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out
    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(key, 0) for key, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_matches_its_definition():
    ws = ["idiot", "idxiot", "banana", "abc", "moron"]
    got = toxicity.Landmarks(ws).kernel(ws)
    assert np.allclose(got, [[naive_kernel(a, b) for b in ws] for a in ws], atol=1e-5)


def naive_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_lcs():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(1, 90))] for _ in range(2))
        mask = {}
        for i, w in enumerate(a):
            mask[w] = mask.get(w, 0) | 1 << i
        assert decontaminate.lcs(mask, b, len(a)) == naive_lcs(a, b)


def test_decontamination(spark, odd, none):
    rng = random.Random(6)
    items = [(i, sentences(rng, rng.randrange(15, 120))) for i in range(20)]
    docs, planted = [], {}
    for i in range(120):
        text = sentences(rng, 300).split()
        if i % 3 == 0:
            item = items[i % 20]
            part = [w if rng.random() > (0.0 if i % 2 else 0.12) else "other" for w in item[1].split()]
            at = rng.randrange(len(text))
            text[at:at] = part
            planted[i] = item[0]
        docs.append((i, " ".join(text), "en", "s", 1))
    benchmark = spark.createDataFrame([*items, (None, "x y z"), (50, None), (51, ""), (52, "...")], "item_id bigint, text string")
    frame = spark.createDataFrame(docs, SCHEMA)
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(frame, benchmark).collect()}
    assert got == set(planted.items())
    assert {r.doc_id for r in decontaminate.keep(frame, benchmark).collect()} == {d[0] for d in docs} - planted.keys()
    assert decontaminate.keep(odd, benchmark).columns == odd.columns
    assert decontaminate.keep(odd, benchmark).count() == odd.count()
    assert decontaminate.report(none, benchmark).collect() == []
    assert decontaminate.report(frame, benchmark.limit(0)).collect() == []


def test_vamana_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 24))
    v = (centres[rng.integers(0, 30, 3000)] + 0.4 * rng.standard_normal((3000, 24))).tolist()
    v[100:400] = [v[0]] * 300  # a hot vector
    rows = [(i, x) for i, x in enumerate(v)] + [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, []),
                                                (5200, [1.0, 2.0]), (5250, [2.0, 4.0]), (None, v[0]), (50, v[50]),
                                                (5300, [None] * 24), (5350, [float("inf")] + [1.0] * 23)]
    got = vamana.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by.keys() == {*range(0, 3000, 50), 5200, 5250}
    assert by[5200] == [(5250, pytest.approx(1.0))]
    m = np.array([np.float32(x) for x in v], np.float64)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        want = np.lexsort((np.arange(3000), -score))[:5]
        hit += len(set(want) & {i for i, _ in by[q]})
        assert all(abs(s - unit[i] @ unit[q]) < 1e-12 for i, s in by[q])
    assert hit >= 0.97 * 5 * 60
    assert [i for i, _ in by[100]] == [0, 101, 102, 103, 104]
    assert vamana.nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


def test_words_are_words():
    assert len(words(random.Random(1), 5)) == 5


def test_decontamination_finds_every_item_in_long_texts():
    """Short and long items of rare words, verbatim and with replaced words, among many other passages."""
    rng = random.Random(12)
    pool = words(rng, 9000)
    prose = lambda n: [rng.choice(pool[:6000] if rng.random() < 0.7 else pool) for _ in range(n)]
    items = [(i, prose(rng.choice([4, 15, 16, 18, 40, 57]))) for i in range(400)]
    vocabulary = decontaminate.Vocabulary(items)
    sketch = decontaminate.Sketch(len(vocabulary.words))
    for _ in range(20):
        sketch.add(*vocabulary.of([" ".join(prose(2000)) for _ in range(5)])[1:])
    model = decontaminate.Model(items, vocabulary, sketch)
    for share in (0, 0.15):
        texts = []
        for _, item in items:
            text, drop = prose(600), set(rng.sample(range(len(item)), int(share * len(item))))
            at = rng.randrange(len(text))
            text[at:at] = ["other" if k in drop else w for k, w in enumerate(item)]
            texts.append(" ".join(text))
        missed = [i for i, found in enumerate(model.leaks(texts)) if i not in {x["item_id"] for x in found}]
        assert missed == []
        assert all(0 < x["cosine"] <= 1 for found in model.leaks(texts[:20]) for x in found)


def topics(rng, n):
    """Words in groups that go together, and common words that go with all of them."""
    pool = list(dict.fromkeys(words(rng, 40 * n)))
    return [pool[12 * i:12 * i + 12] for i in range(n)], pool[12 * n:12 * n + 30]


def test_paraphrases_are_found_by_the_latent_arm_alone(monkeypatch):
    """Telling words replaced by others of their topic: little common mass, but the same direction."""
    rng = random.Random(3)
    groups, common = topics(rng, 70)  # more topics than leading directions, as in any large corpus
    mixed = lambda telling, n: [w for pair in zip(rng.choices(common, k=n), rng.choices(telling, k=n), strict=True) for w in pair]
    answer = common[:6]
    items, texts, copies = [], [], []
    for i, group in enumerate(groups):
        fill = rng.choices(common, k=10)
        own, other = rng.sample(group[:6], 5), rng.sample(group[6:], 5)
        asked = [w for k in range(5) for w in (*fill[2 * k:2 * k + 2], own[k])] + answer
        again = [w for k in range(5) for w in (*fill[2 * k:2 * k + 2], other[k])] + answer
        items += [(i, asked), (100 + i, mixed(group[6:], 8))]
        noise = lambda: rng.choices(common, k=60)
        texts.append(" ".join([*noise(), *again, *noise()]))
        copies.append(" ".join([*noise(), *asked, *noise()]))
    vocabulary = decontaminate.Vocabulary(items)
    sketch = decontaminate.Sketch(len(vocabulary.words))
    for group in groups * 8:
        sketch.add(*vocabulary.of([" ".join(mixed(group, 24))])[1:])
    found = lambda arm: [{x["item_id"] for x in row} for row in decontaminate.Model(items, vocabulary, sketch).leaks(arm)]
    hits = np.mean([i in f for i, f in enumerate(found(texts))])
    assert hits >= 0.9
    assert all(i in f for i, f in enumerate(found(copies)))
    monkeypatch.setattr(decontaminate, "COSINE", 2.0)
    assert np.mean([i in f for i, f in enumerate(found(texts))]) <= 0.1
    assert all(i in f for i, f in enumerate(found(copies)))  # the mass alone finds what is verbatim


def test_report_equals_all_windows_against_all_items(spark, monkeypatch):
    """Every window against every item: the same documents as through candidates, and in blocks of items."""
    rng = random.Random(17)
    items = [(i, sentences(rng, rng.randrange(12, 70))) for i in range(12)]
    rows = []
    for i in range(60):
        text = sentences(rng, rng.randrange(0, 250)).split()
        if i % 2:
            part = items[i % 12][1].split()
            rate = rng.choice([0, 0.1, 0.25, 0.45, 0.6])
            text[len(text) // 2:len(text) // 2] = [w if rng.random() > rate else "other" for w in part]
        rows.append((i, " ".join(text), "en", "s", 1))
    want = set()
    for i, text, *_ in rows:
        plain = [decontaminate.plain(w) for w in text.split()]
        for item, asked in items:
            asked = [decontaminate.plain(w) for w in asked.split()]
            size, tail = len(asked), asked[-max(1, len(asked) // 3):]
            for at in range(0, max(1, len(plain)), decontaminate.CHUNK):
                region = plain[max(0, at - size):at + decontaminate.CHUNK * decontaminate.CHUNKS + size]
                whole = naive_lcs(asked, region) / size
                if whole >= decontaminate.LCS or whole >= decontaminate.LCS_WITH_ANSWER and size >= 10 \
                        and naive_lcs(tail, region) / len(tail) >= decontaminate.ANSWER:
                    want.add((i, item))
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(docs, benchmark).collect()}
    assert len(want) >= 15 and got == want
    monkeypatch.setattr(decontaminate, "ITEMS", 5)
    assert {(r.doc_id, r.item_id) for r in decontaminate.report(docs, benchmark).collect()} == want


def exact_nearest(rows, every, k):
    held = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, v in held:
        if q % every == 0:
            scored = sorted((-float(vamana.cosine(v, w[None])[0]), i) for i, w in held if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found_nearest(spark, rows, every=50, k=5, schema="vec_id bigint, embedding array<double>"):
    out = {}
    for r in sorted(vamana.nearest(spark.createDataFrame(rows, schema), every, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_vamana_equal_directions_tie_by_id(spark):
    """Scaled copies of one direction, by powers of two and by other numbers, beside others."""
    rng = np.random.default_rng(3)
    base, other = rng.standard_normal(12), rng.standard_normal(12)
    rows = [(i, (base * 2.0 ** (i % 40 - 20)).tolist()) for i in range(50)]
    got = found_nearest(spark, rows)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    rows += [(i, (base * (1 + i % 7)).tolist()) for i in range(50, 150)]  # equal up to rounding
    rows += [(i, (other + 1e-9 * rng.standard_normal(12)).tolist()) for i in range(150, 260)]
    assert found_nearest(spark, rows) == exact_nearest(rows, 50, 5)


def test_vamana_shards_names_and_negative_ids(spark, monkeypatch):
    monkeypatch.setattr(vamana, "SMALL", 100)
    monkeypatch.setattr(vamana, "ROUND", 7)
    rng = np.random.default_rng(4)
    rows = [(i - 600, rng.standard_normal(6 if i % 5 else 3).tolist(), "n", 1, 2, 3.0) for i in range(1200)]
    got = found_nearest(spark, rows, schema="vec_id bigint, embedding array<double>, n string, shard int, kind int, top double")
    want = exact_nearest([r[:2] for r in rows], 50, 5)
    assert got.keys() == want.keys()
    hit = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert hit >= 0.99
