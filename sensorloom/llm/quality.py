"""Quality by importance resampling.

Two generative models of hashed n-grams are counted: one of the target text (labelled good documents), one
of all raw text. A document's log weight is the log of their ratio over its n-grams; documents are drawn
without replacement by Gumbel top-k on those weights. n-grams are one and two words long and come in two
views: the words, and their written forms (case, digits, signs, repetition of the word before).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import CACHE_WORDS, MIX, numbered, own_store, shielded, smallest_hashes, stage

VIEW_BITS = 14  # buckets per view
BUCKETS = 4 << VIEW_BITS
#: Labelled rows of either class that the target model and the cut are fitted on, chosen by hash.
MAX_LABELLED = 20_000
PSEUDO = 5.0  # pseudo-count: a bucket seen a few times says little

_FORM = [(re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"),
         (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1\1+"), r"\1\1\1")]


class _Words(dict):
    """Word to 48 bits of its text and 16 bits of its form."""

    def __missing__(self, word: str) -> int:
        form = word
        for pattern, mark in _FORM:
            form = pattern.sub(mark, form)
        stem = word.lower().strip("\"'.,;:!?()[]|*#$%&") or word
        value = (xxhash.xxh64_intdigest(stem.encode()) >> 16 << 16) | (xxhash.xxh64_intdigest(form.encode()) >> 48)
        self[word] = value
        return value



def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of ``texts``, one text after the other, and how many each text has."""
    store = own_store("quality", _Words)
    if len(store) > CACHE_WORDS:
        store.clear()
    words = [(text or "").split() for text in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    codes = np.fromiter(map(store.__getitem__, flat), np.uint64, len(flat))
    owner = np.repeat(np.arange(len(texts)), n)
    word, form = codes >> np.uint64(16), codes & np.uint64(0xFFFF)
    inside = owner[1:] == owner[:-1]
    same = (word[1:] == word[:-1]).astype(np.uint64)
    views = [(word * MIX, owner),
             (((word[:-1] * MIX + word[1:]) * MIX)[inside], owner[1:][inside]),
             ((form + np.uint64(1)) * MIX, owner),
             ((((form[:-1] * MIX + form[1:]) * np.uint64(2) + same) * MIX)[inside], owner[1:][inside])]
    shift = np.uint64(64 - VIEW_BITS)
    buckets = np.concatenate([(h >> shift).astype(np.int64) + (i << VIEW_BITS) for i, (h, _) in enumerate(views)])
    owners = np.concatenate([o for _, o in views])
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.bincount(owners, minlength=len(texts))


@dataclass(frozen=True)
class Model:
    """Log ratio per bucket; ``cut`` is the log weight that best parts the labelled classes."""

    weights: np.ndarray
    cut: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        buckets, n = features(texts)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets])])
        ends = np.cumsum(n)
        return sums[ends] - sums[ends - n]


def labelled_ids(labels: DataFrame, label: str, limit: int = MAX_LABELLED) -> dict[int, int]:
    """Up to ``limit`` doc_ids of each class, those with the smallest hashes: ``{doc_id: 0 or 1}``."""
    out: dict[int, int] = {}
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    for y in (0, 1):
        rows = known.where((F.col("y") == y) & F.col("doc_id").isNotNull()).distinct()
        out.update((r.doc_id, y) for r in smallest_hashes(rows, "doc_id", limit).collect())
    return out


def fit(docs: DataFrame, ids: dict[int, int]) -> Model:
    """Count both models: the raw one over all documents, the target one over those labelled 1 in ``ids``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                keys = batch.column(0).slice(low, 256).to_pylist()
                buckets, n = features(batch.column(1).slice(low, 256).to_pylist())
                total[0] += np.bincount(buckets, minlength=BUCKETS)
                y = np.repeat([ids.get(k, -1) for k in keys], n)
                for row, value in ((1, 1), (2, 0)):
                    total[row] += np.bincount(buckets[y == value], minlength=BUCKETS)
        held = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held, *total[:, held])], ["bucket", "raw", "good", "bad"])

    counted = (docs.select("doc_id", "text").mapInArrow(count, "bucket bigint, raw bigint, good bigint, bad bigint")
               .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "good", "bad")]))
    table = np.zeros((3, BUCKETS))
    for row in counted.collect():  # one row per bucket
        table[:, row.bucket] = row.raw, row.good, row.bad
    raw, good, _ = table
    if not good.sum():
        return Model(np.zeros(BUCKETS), -np.inf)
    weights = np.zeros(BUCKETS)
    for view in range(4):
        part = slice(view << VIEW_BITS, (view + 1) << VIEW_BITS)
        # The smoothed ratio of the models: a bucket's target count over what its raw share would give.
        expected = raw[part] * (good[part].sum() / max(1.0, raw[part].sum()))
        weights[part] = np.log(good[part] + PSEUDO) - np.log(expected + PSEUDO)
    return Model(weights, 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``log_weight``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            values = [model.score(texts.slice(low, 256).to_pylist()) for low in range(0, batch.num_rows, 256)]
            values = pa.array(np.concatenate(values or [np.zeros(0)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, "log_weight"])

    docs = docs.drop("log_weight")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("log_weight", T.DoubleType())]))


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The log weight with the fewest wrongly parted rows, good ones counting three times.

    In the gap between the classes it is the middle, and never less likely than a weight of nothing.
    """
    if not len(scores) or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(3 * g)]) + (~g).sum() - np.concatenate([[0], np.cumsum(~g)])
    i = int(np.argmin(wrong))
    return float(s[0] - 1 if i == 0 else s[-1] + 1 if i == len(s) else (s[i - 1] + s[i]) / 2)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 7,
             label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """``(scored, drawn)``: all documents with ``log_weight`` and ``draw``, and the ``k`` drawn of them by rank.

    ``draw`` is the log weight plus a Gumbel number made from the row's hash and ``seed``; the ``k`` largest
    are a sample without replacement in proportion to the weights. ``k`` unset: as many as there are documents
    above the weight that best parts the labelled classes, so the sample is as large as the good text.

    NULL and empty texts have log weight 0. Equal rows draw equally and stand next to each other. Without
    labels of the target class all weights are equal and everything is kept; without labels of the other class
    too. Columns named ``log_weight`` or ``draw`` are replaced; an empty table gives an empty sample.
    """
    ids = labelled_ids(labels, label)
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # One half of the labels fits the model, the other half, new to it, sets the cut.
    halves = [{k: y for k, y in ids.items() if (k * 2_654_435_761 >> 16) & 1 == side} for side in (0, 1)]
    fitted, held = halves if all(1 in half.values() for half in halves) else (ids, ids)
    model = fit(plain, fitted)
    uniform = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    scored = stage(score(docs.drop("draw"), model).withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform))),
                   "scored")
    if k is None:
        sample = _sample_scores(scored, held)
        cut = best_cut(sample["log_weight"].to_numpy(), sample["y"].to_numpy() == 1) if len(sample) else -np.inf
        k = scored.where(F.col("log_weight") > F.lit(float(cut))).count()
    small = scored.select("doc_id", "log_weight", "draw", F.xxhash64("text").alias("_h"))
    order = [F.col("draw").desc(), F.col("doc_id"), F.col("_h")]
    return scored, numbered(small, order).where(F.col("rank") < k)


def _sample_scores(scored: DataFrame, ids: dict[int, int]) -> pd.DataFrame:
    """Scores of the labelled sample, one row per doc_id: of several rows that with the smallest hash of its text."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            held = pa.array([i for i, key in enumerate(keys) if key in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([c.take(held) for c in batch.columns], batch.schema.names)

    rows = scored.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "log_weight")
    one = (rows.mapInArrow(pick, rows.schema).groupBy("doc_id")
           .agg(F.min(F.struct("h", "log_weight")).alias("r")).select("doc_id", "r.log_weight").toPandas())
    return one.assign(y=[ids[key] for key in one["doc_id"]])


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The drawn documents with their own columns."""
    def run(docs: DataFrame) -> DataFrame:
        scored, drawn = resample(docs, labels)
        last = drawn.orderBy(F.col("rank").desc()).limit(1).select("draw").collect()
        if not last:
            return scored.select(*docs.columns).limit(0)
        return scored.where(F.col("draw") >= F.lit(last[0].draw)).select(*docs.columns)

    return shielded(docs, ("log_weight", "draw"), run)
