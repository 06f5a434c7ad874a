"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The gap-weighted subsequence kernel compares words by all their ordered character triples, each worth less
the wider it is spread, so an insult with gaps or inserted characters still meets its triples. Landmarks span
a Nyström feature space in which a linear support vector machine is trained on single words, told apart by the
labelled sentences that have them. As the kernel is a dot product over triples, the machine folds into one weight per triple; a
word's margin then costs its own triples only, whatever the number of landmarks. A document's score is a
logistic function of its strongest words and their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import CACHE_WORDS, discard, largest, smallest_hashes, stage

DECAY = 0.6
WIDEST = 20  # characters compared at once; a longer word is scored in overlapping windows
BITS = 6  # per character
#: Bounds of the training sample: labelled documents of each class, landmarks, words of the clean class.
MAX_DOCS, MAX_LANDMARKS, MAX_WORDS = 6_000, 250, 20_000
OUTER = 10  # features of the logistic function
LOW = -3.0  # margin of a word with fewer than three characters
_SENTENCE = re.compile(r"[.!?]\s+|\n")
_EDGE = "\"'.,;:!?()[]{}|*#$%&-_~<>/\\+="
_CODES = np.array([0 if c == 0 else c - 96 if 97 <= c <= 122 else 27 + c % 37 for c in range(0x3000)], np.int64)


@lru_cache(maxsize=None)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(length), 3)), np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def _windows(word: str) -> list[str]:
    step = WIDEST // 2
    return [word] if len(word) <= WIDEST else [word[i:i + WIDEST] for i in range(0, len(word) - step, step)]


def plain(word: str) -> str:
    return word.lower().strip(_EDGE)


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By word length: positions in ``words``, triple codes, their weights, and the kernel of a word with itself."""
    size = np.array([len(w) for w in words], np.int64)
    for length in np.unique(size[size >= 3]).tolist():
        rows = np.flatnonzero(size == length)
        points = np.frombuffer("".join(words[i] for i in rows).encode("utf-32-le"), np.uint32)
        letters = _CODES[np.minimum(points, len(_CODES) - 1)].reshape(len(rows), length)
        at, weight = _triples(length)
        for low in range(0, len(rows), 4096):
            c = letters[low:low + 4096][:, at]
            codes = (c[:, :, 0] << (2 * BITS)) | (c[:, :, 1] << BITS) | c[:, :, 2]
            # The same triple may occur at several places; its weights add up before they are squared.
            order = np.argsort(codes, axis=1)
            ranked = np.take_along_axis(codes, order, 1)
            new = np.ones(ranked.shape, bool)
            new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
            sums = np.add.reduceat(weight[order].ravel(), np.flatnonzero(new.ravel()))
            row = np.repeat(np.arange(len(codes)), new.sum(1))
            own = np.bincount(row, sums * sums, len(codes))
            yield rows[low:low + 4096], codes, weight, own


class Landmarks:
    """Landmark words as sparse triples: only triples that some landmark has take a column."""

    def __init__(self, words: list[str]) -> None:
        parts = [(rows, codes, weight / np.sqrt(own)[:, None]) for rows, codes, weight, own in triples(words)]
        held = np.unique(np.concatenate([codes.ravel() for _, codes, _ in parts]))
        self.column = np.full(1 << (3 * BITS), len(held), np.int32)
        self.column[held] = np.arange(len(held))
        self.held = held
        self.table = np.zeros((len(words), len(held) + 1), np.float32)
        for rows, codes, weight in parts:
            for i, row in enumerate(rows):
                np.add.at(self.table[row], self.column[codes[i]], weight[i])

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of each word with each landmark."""
        out = np.zeros((len(words), len(self.table)))
        for rows, codes, weight, own in triples(words):
            at = self.column[codes]
            for j, row in enumerate(self.table):
                out[rows, j] = row[at] @ weight / np.sqrt(own)
        return out

    def fold(self, alpha: np.ndarray) -> np.ndarray:
        """One weight per triple: the machine with weight ``alpha`` per landmark."""
        out = np.zeros(1 << (3 * BITS), np.float32)
        out[self.held] = self.table[:, :-1].T @ alpha
        return out


@dataclass
class Model:
    """``weights`` per triple and ``bias`` of the machine; ``outer`` of the logistic function over documents."""

    weights: np.ndarray
    bias: float
    outer: np.ndarray

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word; the strongest window's for a long word."""
        parts = [_windows(plain(w)) for w in words]
        for i, word in enumerate(words):  # inserted signs and digits: also the letters alone
            letters = "".join(filter(str.isalpha, word.lower()))
            if letters and letters != parts[i][0]:
                parts[i] = [*parts[i], *_windows(letters)]
        flat = [p for ps in parts for p in ps]
        values = np.full(len(flat), LOW)
        for rows, codes, weight, own in triples(flat):
            values[rows] = self.weights[codes] @ weight / np.sqrt(own) + self.bias
        starts = np.cumsum([0, *[len(ps) for ps in parts]])[:-1]
        return np.maximum.reduceat(values, starts) if len(flat) else values

    def documents(self, texts: list[str | None], known: dict[str, float]) -> np.ndarray:
        """Features per document: its three strongest margins, hits, words; ``known`` keeps margins of words."""
        if len(known) > CACHE_WORDS:
            known.clear()
        words = [(text or "").split() for text in texts]
        for ws in words:
            ws += _spelled(ws)
        flat = [w for ws in words for w in ws]
        value = np.fromiter(map(known.get, flat, repeat(np.nan)), np.float64, len(flat))
        holes = np.flatnonzero(np.isnan(value))
        if len(holes):
            new = list({flat[i] for i in holes})
            known.update(zip(new, self.margins(new).tolist(), strict=True))
            value[holes] = [known[flat[i]] for i in holes]
        out = np.full((len(texts), 5), LOW)
        at = 0
        for i, ws in enumerate(words):
            own = value[at:at + len(ws)]
            at += len(ws)
            top = np.sort(own[np.argpartition(own, -3)[-3:]])[::-1] if len(own) > 3 else np.sort(own)[::-1]
            out[i, :len(top)] = top
            out[i, 3:] = np.log1p((own > 0).sum()), max(4.0, np.log1p(len(ws)))
        out[:, :3] = np.clip(out[:, :3], LOW, 3.0)
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_outer(features) @ self.outer, -30, 30)))


def _outer(f: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(f)), f, f[:, 3] * f[:, 4], np.maximum(f[:, :3], 0)])


def _spelled(words: list[str]) -> list[str]:
    """Words spelled out with spaces between the letters, put together."""
    out, run = [], []
    for word in [w if len(w) == 1 else "" for w in words] + [""]:
        if word:
            run.append(word)
        else:
            if len(run) >= 4:
                out.append("".join(run))
            run = []
    return out


def sample_ids(labels: DataFrame, usable: Column, label: str = "toxic", limit: int = MAX_DOCS) -> dict[int, int]:
    """Up to ``limit`` doc_ids of each class among ``usable`` rows, by smallest hash."""
    out: dict[int, int] = {}
    known = labels.where(usable & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    for y in (0, 1):
        out.update((r.doc_id, y) for r in smallest_hashes(known.where(F.col("y") == y).distinct(), "doc_id", limit).collect())
    return out


def sentence_words(docs: DataFrame, ids: dict[int, int]) -> DataFrame:
    """Words of the different sentences of the sampled documents: ``word, toxic, clean`` (sentences of each class).

    A sentence has its document's label; one that a clean document also has is clean. Copies count once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, y, words = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc_id not in ids:
                    continue
                for sentence in _SENTENCE.split(text or ""):
                    held = sorted({v for w in sentence.split() for v in _windows(plain(w)) if len(v) >= 3})
                    if held:
                        key.append(xxhash.xxh64_intdigest(" ".join(held).encode()) - (1 << 63))
                        y.append(ids[doc_id])
                        words.append(held)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(y, pa.int32()),
                                              pa.array(words, pa.list_(pa.string()))], ["key", "y", "words"])

    kept = (docs.select("doc_id", "text").mapInArrow(run, "key bigint, y int, words array<string>")
            .groupBy("key").agg(F.min("y").alias("y"), F.first("words").alias("words")))
    return (kept.select("y", F.explode("words").alias("word")).groupBy("word")
            .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")))


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Linear support vector machine by squared hinge loss and accelerated gradient steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    for value in (1, -1):
        weight = np.where(y == value, weight / weight[y == value].sum(), weight)
    ridge = 1e-3
    rate = 1 / (2 * np.linalg.norm(x1 * np.sqrt(weight)[:, None], 2) ** 2 + ridge)
    w = z = np.zeros(x1.shape[1])
    for t in range(rounds):
        gap = np.maximum(0, 1 - y * (x1 @ z))
        step = z - rate * (ridge * z - 2 * x1.T @ (weight * y * gap))
        z = step + t / (t + 3) * (step - w)
        w = step
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
    return w


def _worst(words: DataFrame, model: Model, limit: int) -> list:
    """The ``limit`` words with the largest margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.margins(batch.column(0).to_pylist()))],
                                             ["word", "clean", "margin"])

    told = stage(words.select("word", F.col("clean").cast("bigint")).mapInArrow(run, "word string, clean bigint, margin double"),
                 "margins")
    out = largest(told, F.col("margin"), limit, "word").collect()
    discard(told)
    return out


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Fit on a bounded sample of the labelled documents for which ``usable`` holds.

    Without both classes the model gives every document the share of toxic rows in the sample (0 if none).
    """
    ids = sample_ids(labels, usable)
    share = sum(ids.values()) / max(1, len(ids))
    flat = Model(np.zeros(1 << (3 * BITS), np.float32), LOW, np.zeros(OUTER))
    flat.outer[0] = np.log((share + 1e-9) / (1 - share + 1e-9))
    words = stage(sentence_words(docs, ids), "sentence-words")
    total = words.agg(F.sum("toxic"), F.sum("clean")).first()
    if not total[0] or not total[1]:
        discard(words)
        return flat
    odds = F.log((F.col("toxic") + 0.5) / float(total[0])) - F.log((F.col("clean") + 0.5) / float(total[1]))
    told = words.withColumn("odds", odds)
    telling = largest(told.where("toxic >= 4 and odds > 2"), F.col("odds") * F.sqrt("toxic"), MAX_LANDMARKS, "word").collect()
    ordinary = told.where("clean >= 1 and odds <= 1.5")
    common = largest(ordinary, F.col("clean"), MAX_WORDS // 4, "word").collect()
    others = smallest_hashes(ordinary, "word", MAX_WORDS // 4).collect()
    if not telling or not common:
        discard(words)
        return flat
    heads = [r.word for r in telling]
    clean = {r.word: r.clean for r in [*common, *others]}
    marks = list(dict.fromkeys([*heads, *[r.word for r in common[:40]]]))
    for turn in range(3):
        land = Landmarks(marks)
        values, vectors = np.linalg.eigh(land.kernel(marks))
        half = vectors / np.sqrt(np.maximum(values, 0.05))  # the Nyström map
        y = np.array([1.0] * len(heads) + [-1.0] * len(clean))
        weight = np.sqrt(np.array([r.toxic for r in telling] + list(clean.values()), float))
        w, bias = _machine(land.kernel([*heads, *clean]) @ half, y, weight)
        model = Model(land.fold(half @ w), bias, np.zeros(OUTER))
        if turn < 2:  # clean words that the machine takes for insults join the sample; the worst become landmarks
            worst = _worst(ordinary, model, MAX_WORDS // 4)
            marks = list(dict.fromkeys([*marks, *[r.word for r in worst[:80] if r.margin > -0.5]]))
            clean.update((r.word, r.clean) for r in worst)
    discard(words)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            rows = [(k, h, t) for k, h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if k in ids]
            f = model.documents([t for _, _, t in rows], known)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in rows], pa.int64()), pa.array([h for _, h, _ in rows], pa.int64()),
                 pa.array([ids[k] for k, _, _ in rows], pa.int32()), *[pa.array(c) for c in f.T]], ["doc_id", "h", "y", *"abcde"])

    # Of several rows with one doc_id the one with the smallest hash of its text.
    fitted = (docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text"), F.col("text").cast("string"))
              .mapInArrow(features, "doc_id bigint, h bigint, y int, a double, b double, c double, d double, e double")
              .groupBy("doc_id").agg(F.min(F.struct("h", "y", *"abcde")).alias("r")).orderBy("doc_id")
              .select("r.y", *[f"r.{c}" for c in "abcde"]).toPandas().to_numpy(float))
    model.outer = _logistic(_outer(fitted[:, 1:]), fitted[:, 0])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the probability of label 1 for every document, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            parts = [shared.value.probability(shared.value.documents(batch.column(1).slice(low, 256).to_pylist(), known))
                     for low in range(0, batch.num_rows, 256)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts or [np.zeros(0)]))],
                                             ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id bigint, score double")


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(3))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Rows whose crc32 of the doc_id as text leaves 1 by 3 are held out: their labels are never learned from.
    NULL and empty texts get the score of a text without words; a very long text is scored whole, its strongest words
    count; a NULL doc_id is not held out; repeated rows are scored alike, and of rows with one doc_id one is learned
    from; other columns, whatever their names, are ignored.
    """
    model = train(docs, labels, remainder(F.col("doc_id")) != 1)
    return score(docs, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
