"""Context mixing: counts against plain Python, probabilities that sum to one, held-out gain, odd rows."""

from __future__ import annotations

import collections
import math
import pickle
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import mixing
from sensorloom.llm.queries import QUERIES
from tests.llm.conftest import SCHEMA, document_rows, words



def held_rows():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


def tokens(text):
    return (text or "").encode().translate(mixing.LOWER).split() + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def test_base_score_equals_plain_counts(spark, odd):
    rows = [(r[0], r[1]) for r in document_rows()]
    count = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    total, different = sum(count.values()), len(count)
    floor = math.log10(total + 0.5 * (different + 1))
    want = sorted((str(d), held(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total,
                   round(sum(math.log10(count[w] + 0.5) - floor for w in tokens(t)), 6)) for d, t in rows)
    got = mixing.score(odd, held_rows()).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    empty = next(r for r in got if r.n_tokens == 1)
    assert empty.bits_per_byte is None


def small_model(vocabulary):
    words_, counts = list(vocabulary), np.array(list(vocabulary.values()), float)
    sizes = mixing.table_sizes(len(words_))
    flat = b"".join(w + b" " if w else b"\n" for w in words_)
    code = mixing.prefix_code(np.bincount(np.frombuffer(flat, np.uint8), minlength=256))
    tables = [np.zeros(2 << s) for s in sizes]
    events = mixing.Events(words_, code, sizes)
    for table, slots in zip(tables, events.slots, strict=True):
        np.add.at(table, slots * 2 + events.bit, counts[events.word])
    model = mixing.Model(code, sizes, [t.reshape(-1, 2).astype(np.float32) for t in tables])
    model.learn(words_, counts, np.zeros_like(model.weights), np.zeros(mixing.GATES))
    return model


def test_first_bytes_sum_to_one():
    """All one-byte symbols in the place after a prefix share one distribution, whatever was learned."""
    rng = random.Random(2)
    model = small_model(collections.Counter(w.encode() for w in words(rng, 3000)) | collections.Counter({b"": 40}))
    for prefix in (b"", b"ab", b"unseen"):
        said = []
        for byte in range(256):
            events = mixing.Events([prefix + bytes([byte])], model.code, model.sizes)
            x, gate = model.inputs(events, unseen=False)
            one = model.refined(model.mixed(x, gate), gate)
            chance = np.where(events.bit == 1, one, 1 - one)
            depth = model.code[2]
            start = sum(depth[b] for b in prefix)
            said.append(np.prod(chance[start:start + depth[byte]]))
        assert sum(said) == pytest.approx(1, abs=1e-6)


def test_contexts_stay_inside_the_word():
    model = small_model(collections.Counter({b"one": 5, b"two": 3, b"three": 2, b"": 4}))
    alone = [model.log10([w])[0] for w in (b"one", b"unseen", b"")]
    assert model.log10([b"one", b"unseen", b""]) == pytest.approx(alone)
    assert model.log10([b"one"])[0] > model.log10([b"two"])[0] > model.log10([b"qqq"])[0]


def test_words_of_the_text_are_weighed_by_evidence(monkeypatch):
    ids, length = np.array([1, 2, 1, 1, 0, 3, 0]), np.array([5, 2])
    place, before = mixing.said_before(ids, length)
    assert place.tolist() == [0, 1, 2, 3, 4, 0, 1] and before.tolist() == [0, 0, 1, 2, 0, 0, 0]
    said = np.full(7, -3.0)
    got = mixing.adapted(said, ids, length)
    step = []
    for most, half in mixing.RECENT:
        p = [(1 - most * t / (t + half)) * 1e-3 + most * t / (t + half) * (b / t if t else 0)
             for t, b in zip(place[:5], before[:5], strict=True)]
        step.append(np.prod(p))
    assert got[0] == pytest.approx(math.log10(np.mean(step)))
    assert got[0] > -15
    monkeypatch.setattr(mixing, "SLICE", 3)
    assert mixing.adapted(said, ids, length) == pytest.approx(got)


def test_held_out_texts_and_edges(spark, none):
    rng = random.Random(9)
    common = words(rng, 400)
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(common, weights, k=120)) for _ in range(400)]
    noise = [" ".join(words(rng, 120, "qwxyz")) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + noise)], SCHEMA)
    rows = {r.doc_id: r for r in mixing.score(docs, F.col("doc_id") >= 320).collect()}
    natural, odd_ones = ([rows[i].bits_per_byte for i in ids] for ids in (range(320, 400), range(400, 420)))
    assert max(natural) < min(odd_ones) and np.mean(natural) < 2
    # Known words drawn one by one: nothing beats their frequencies, and little is lost against them.
    assert np.mean([rows[i].score / rows[i].base_score for i in range(320, 400)]) < 1.08
    assert mixing.score(none, held_rows()).collect() == []
    untrained = mixing.score(docs.limit(3), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == pytest.approx(0) and r.score < 0 for r in untrained)
    long = spark.createDataFrame([(1, "x" * 200_000 + " a" * 200_000, "en", "s", 1)], SCHEMA)
    told = mixing.score(long, F.lit(False)).collect()
    assert told[0].n_tokens == 200_002 and math.isfinite(told[0].score)


def test_registered_query(spark, small):
    assert QUERIES["op12_context_mixing"](spark, small).count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_openings_name_the_bytes_before_a_word():
    texts = [["one", "a", "b", "to", "xyz", ""], ["", ], ["q", "longer", ""]]
    known = sorted({w for t in texts for w in t})
    ids = np.array([known.index(w) for t in texts for w in t])
    spelled = [w.encode() for w in known]
    heads, tails = mixing.opened(mixing.openings(*mixing.ends(spelled), ids, np.array([len(t) for t in texts])))
    want = []
    for text in texts:
        for i, w in enumerate(text):
            before = "\n\n\n" + " ".join(text[:i])
            want.append((((w + " ") if w else "\n")[:3].encode(), before[-3:].encode()))
    assert list(zip(heads, tails, strict=True)) == want


def test_the_text_before_a_word_predicts_it(spark):
    """Words that take turns: held-out texts in turn are likelier than the same words in another order."""
    rng = random.Random(4)
    turn = {"red": "kilo", "kilo": "sand", "sand": "moon", "moon": "red"}
    rows = []
    for i in range(300):
        text = [rng.choice(list(turn))]
        while len(text) < 80:
            text.append(turn[text[-1]])
        if i >= 280:
            text.sort() if i % 2 else None
        rows.append((i, " ".join(text), "en", "s", 1))
    got = {r.doc_id: r for r in mixing.score(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") >= 280).collect()}
    assert got[280].base_score == pytest.approx(got[281].base_score)
    in_turn, sorted_ones = ([got[i].score for i in range(first, 300, 2)] for first in (280, 281))
    assert min(in_turn) > max(sorted_ones) and min(in_turn) > 0.5 * got[280].base_score


def test_words_after_a_text_sum_to_one():
    """First bytes after one text, and what follows them, share one distribution."""
    rng = random.Random(6)
    spelled = [w.encode() for w in words(rng, 300)] + [b""]
    model = small_model(collections.Counter(spelled))
    chance = sum(10 ** model.log10([bytes([a])], [b"abc"])[0] for a in range(256))
    assert chance == pytest.approx(1, abs=1e-6)
    rest = model.log10([b"on", b"only"], [None, None])
    assert rest[0] == 0 > rest[1]


def test_a_model_travels_packed():
    """What is sent is small beside the tables, and a model that only predicts says the same without its counts."""
    rng = random.Random(8)
    spelled = [w.encode() for w in words(rng, 2000)] + [b""]
    tails = [None if i % 3 else b"a b" for i in range(len(spelled))]
    model = small_model(collections.Counter(spelled))
    sent = pickle.dumps(model)
    assert len(sent) - model.seen.nbytes - model.weights.nbytes < sum(t.nbytes for t in model.tables) / 2
    back, lean = pickle.loads(sent), pickle.loads(pickle.dumps(model.learned()))
    assert all(np.array_equal(a, b) for a, b in zip(back.tables, model.tables, strict=True))
    assert not lean.tables and 2 * sum(t.nbytes for t in lean.odds) == sum(t.nbytes for t in model.tables)
    for other in (back, lean):
        assert np.array_equal(other.log10(spelled, tails), model.log10(spelled, tails))


def test_packed_arrays_come_back():
    for values in (np.array([], "<i4"), np.array([0, -1, 1 << 30], "<i4"), np.arange(12, dtype=np.float32).reshape(3, 4),
                   np.array([3, 200], np.uint8)):
        assert np.array_equal(mixing.unpacked(*mixing.packed(values)), values)
