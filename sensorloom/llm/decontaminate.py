"""Benchmark decontamination by latent semantic retrieval.

The words of all documents are numbered once, in the vocabulary of the benchmark's content words, and written
beside the text. Passages are TF-IDF vectors over that vocabulary. One pass over the numbers counts passage
frequencies and sketches the passages' Gram matrix with a random test matrix; the sketch gives the leading singular
directions (randomised SVD, single pass). A second pass projects all overlapping windows of every text onto them
and takes as candidates the windows whose cosine with a part of an item reaches a
floor, which finds paraphrases by words that go together, and those that hold enough of a part's mass themselves,
which finds items of rare words that the leading directions hardly know. Every candidate is settled by the longest
common subsequence with the item's words and by a check of the item's last part, its answer.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import CACHE_WORDS, numbered, own_store, shielded, stage

PASSAGE = 48  # words of a passage in the statistics
CHUNK, CHUNKS = 12, 3  # a window is CHUNKS chunks; one starts at every chunk
RANK, SKETCH = 64, 80
SEGMENT = 32  # words of an item looked for at once
COSINE, SHARED = 0.7, 0.4  # a candidate's least cosine in the leading directions, or least share of the item's mass
CELLS = 2_000_000  # of windows by item parts at once
LCS, LCS_WITH_ANSWER, ANSWER = 0.7, 0.5, 0.8
ITEMS = 1_000  # items a pass looks for; a larger benchmark takes several passes
ROWS = 256  # words whose sketch rows make one row of a table
COMMON = 0.05  # a word in more than this share of the items is no content word
LEAKS = "array<struct<item_id:bigint,word:int,cosine:double,lcs:double,answer:double>>"
_EDGE = "\"'.,;:!?()[]{}|*#$%&-_~<>/\\+="


def plain(word: str) -> str:
    return word.lower().strip(_EDGE)


class _Numbers(dict):
    """Written word to its number in a vocabulary."""

    def __init__(self, number: dict[str, int]) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> int:
        value = self[word] = self.number.get(plain(word), -1)
        return value


class Vocabulary:
    """Word to its number: content words of the items from 0, their other words after those, words of no item -1."""

    def __init__(self, items: list[tuple[int, list[str]]], held: dict[str, int] | None = None, total: int = 0) -> None:
        """``held`` says in how many of all ``total`` items a word stands; without it ``items`` are all."""
        if held is None:
            held, total = {}, len(items)
            for _, words in items:
                for w in set(words):
                    held[w] = held.get(w, 0) + 1
        most = max(2.0, COMMON * total)
        content = {w for _, words in items for w in words if held[w] <= most}
        for _, words in items:  # an item of common words only keeps them
            if sum(w in content for w in set(words)) < 3:
                content.update(words)
        self.words = sorted(content)
        common = sorted({w for _, words in items for w in words} - content)
        self.number = {w: i for i, w in enumerate([*self.words, *common])}
        self.mark = zlib.crc32("\n".join(self.number).encode())

    def of(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words of each text, their numbers put together, and the words per text."""
        store = own_store(f"benchmark:{self.mark}", lambda: _Numbers(self.number))
        if len(store) > CACHE_WORDS:
            store.clear()
        words = [(text or "").split() for text in texts]
        n = np.array([len(w) for w in words], np.int64)
        return words, np.fromiter(map(store.__getitem__, chain.from_iterable(words)), np.int32, int(n.sum())), n


def _pieces(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece number of every word when each text is cut into pieces of ``size`` words, and the text of each piece."""
    per = -(-n // size)
    first = np.cumsum(per) - per
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first, n) + place // size, np.repeat(np.arange(len(n)), per)


def _presence(numbers: np.ndarray, piece: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different ``(piece, number)`` pairs of content words, by piece."""
    held = (numbers >= 0) & (numbers < width)
    pairs = np.unique(piece[held].astype(np.int64) * width + numbers[held])
    return pairs // width, pairs % width


class Sketch:
    """Passage frequencies and the sketched Gram matrix of the passages seen so far."""

    def __init__(self, width: int) -> None:
        self.test = np.random.default_rng(3).standard_normal((width, SKETCH)).astype(np.float32)
        self.gram = np.zeros((width, SKETCH), np.float64)
        self.frequency = np.zeros(width, np.float64)
        self.passages = 0.0

    def add(self, numbers: np.ndarray, n: np.ndarray) -> None:
        piece, owner = _pieces(n, PASSAGE)
        self.passages += len(owner)
        piece, number = _presence(numbers, piece, len(self.frequency))
        if not len(piece):
            return
        self.frequency += np.bincount(number, minlength=len(self.frequency))
        starts = np.flatnonzero(np.diff(piece, prepend=-1))
        rows = np.add.reduceat(self.test[number], starts)
        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(piece))))
        order = np.argsort(number, kind="stable")
        at = np.flatnonzero(np.diff(number[order], prepend=-1))
        self.gram[number[order][at]] += np.add.reduceat(rows[row[order]], at)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """The sketch in pieces of :data:`ROWS` words, and the number of passages as piece -1."""
        yield -1, np.array([self.passages]).tobytes()
        every = np.hstack([self.frequency[:, None], self.gram])
        for low in range(0, len(every), ROWS):
            yield low, every[low:low + ROWS].tobytes()

    def put(self, low: int, packed: bytes) -> None:
        data = np.frombuffer(packed)
        if low < 0:
            self.passages += data[0]
            return
        data = data.reshape(-1, SKETCH + 1)
        self.frequency[low:low + ROWS] += data[:, 0]
        self.gram[low:low + ROWS] += data[:, 1:]


def _summed(pieces: DataFrame) -> DataFrame:
    """Sums of ``packed`` doubles per ``low``; a task holds one sum at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["low", "packed"])

        for batch in batches:
            for low, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if low == key:
                    total += np.frombuffer(packed)
                    continue
                if key is not None:
                    yield one()
                key, total = low, np.frombuffer(packed).copy()
        if key is not None:
            yield one()

    return pieces.repartition("low").sortWithinPartitions("low").mapInArrow(add, "low int, packed binary")


class Model:
    """Inverse frequencies, the latent space, and the items in it."""

    def __init__(self, items: list[tuple[int, list[str]]], vocabulary: Vocabulary, sketch: Sketch) -> None:
        self.items, self.vocabulary = items, vocabulary
        width = len(vocabulary.words)
        idf = np.log((sketch.passages + 1) / (sketch.frequency + 1)) + 1
        # The sketch of the unweighted passages is that of the weighted ones for the test matrix test / idf.
        test = sketch.test / idf[:, None]
        gram = idf[:, None] * sketch.gram
        core = test.T @ gram
        values, vectors = np.linalg.eigh((core + core.T) / 2)
        good = values > values.max(initial=0) * 1e-9
        half = gram @ (vectors[:, good] / np.sqrt(values[good]))
        left, scale, _ = np.linalg.svd(half, full_matrices=False)
        rank = max(1, min(RANK, int((scale > scale.max(initial=0) * 1e-6).sum())))
        #: Latent row of every word: its weight along the leading directions. Strong ones, such as a language's,
        #: are scaled down towards one size; weak ones, which are noise, are not scaled up.
        self.axes = (idf[:, None] * left[:, :rank] / (scale[:rank] + scale[:rank].mean())).astype(np.float32)
        self.idf = idf
        # A long item is looked for by parts about as long as a window.
        parts = [(i, words[k:k + SEGMENT]) for i, (_, words) in enumerate(items)
                 for k in range(0, max(1, len(words) - SEGMENT // 2), SEGMENT)]
        self.item_of = [i for i, _ in parts]
        rows = np.zeros((len(parts), width))
        for i, (_, words) in enumerate(parts):
            held = sorted({vocabulary.number[w] for w in words if vocabulary.number[w] < width})
            rows[i, held] = idf[held]
        self.size = np.linalg.norm(rows, axis=1)
        latent = (rows / idf) @ self.axes
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        self.latent = np.divide(latent, size, out=np.zeros_like(latent), where=size > 0).astype(np.float32)
        # Item parts of each word one after the other, with the word's share of the part's mass.
        number, self.part = np.nonzero(rows.T)
        self.share = idf[number] ** 2 / self.size[self.part] ** 2
        self.parts_of = np.searchsorted(number, np.arange(width + 1))
        numbered_items = [[vocabulary.number[w] for w in words] for _, words in items]
        self.masks = [places(words) for words in numbered_items]
        self.tails = [places(words[-max(1, len(words) // 3):]) for words in numbered_items]

    def candidates(self, numbers: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int, float]]:
        """``(text, first word, item, cosine)`` of all windows that are near a part of an item or hold enough of it."""
        piece, owner = _pieces(n, CHUNK)
        at, number = _presence(numbers, piece, len(self.idf))
        first = np.searchsorted(owner, np.arange(len(n)))
        stop, parts, out = np.searchsorted(owner, owner, "right"), len(self.size), []
        step = max(CHUNKS, CELLS // max(1, parts))
        for low in range(0, len(owner), step):
            high = min(len(owner), low + step)
            a, b = np.searchsorted(at, (low, min(len(owner), high + CHUNKS - 1)))
            count = self.parts_of[number[a:b] + 1] - self.parts_of[number[a:b]]
            if not count.sum():
                continue
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.parts_of[number[a:b]], count)
            cell = np.repeat((at[a:b] - low) * parts, count) + self.part[place]
            chunk = np.bincount(cell, self.share[place], (high - low + CHUNKS) * parts).reshape(-1, parts)
            mass = chunk[:high - low].copy()
            held = np.zeros((high - low + CHUNKS, self.axes.shape[1]), np.float32)
            if b > a:
                start = np.flatnonzero(np.diff(at[a:b], prepend=-1))
                held[at[a:b][start] - low] = np.add.reduceat(self.axes[number[a:b]], start)
            window = held[:high - low].copy()
            for k in range(1, CHUNKS):
                same = (np.arange(low, high) + k < stop[low:high])[:, None]
                mass += np.where(same, chunk[k:high - low + k], 0)
                window += np.where(same, held[k:high - low + k], 0)
            size = np.linalg.norm(window, axis=1, keepdims=True)
            cosine = np.divide(window, size, out=np.zeros_like(window), where=size > 0) @ self.latent.T
            near = (mass >= SHARED - 1e-9) | (cosine >= COSINE)
            for row, part in np.argwhere(near).tolist():
                text = int(owner[low + row])
                out.append((text, int(low + row - first[text]) * CHUNK, self.item_of[part], float(np.clip(cosine[row, part], 0, 1))))
        return out

    def leaks(self, texts: list[str | None]) -> list[list[dict]]:
        """Items found in each text, one entry per item: where, and how alike."""
        return self.settled(*self.vocabulary.of(texts)[1:])

    def settled(self, numbers: np.ndarray, n: np.ndarray) -> list[list[dict]]:
        """:meth:`leaks` of texts by the numbers of their words, in which all words of the items differ."""
        out: list[dict[int, dict]] = [{} for _ in n]
        stop = np.cumsum(n)
        for text, word, item, cosine in self.candidates(numbers, n):
            item_id, asked = self.items[item]
            begin, end = int(stop[text] - n[text]), int(stop[text])
            region = numbers[begin + max(0, word - len(asked)):min(end, begin + word + CHUNK * CHUNKS + len(asked))].tolist()
            whole = lcs(self.masks[item], region, len(asked)) / len(asked)
            best = out[text].get(item_id)
            if whole < LCS_WITH_ANSWER or best and best["lcs"] >= whole:
                continue
            tail = max(1, len(asked) // 3)
            answer = lcs(self.tails[item], region, tail) / tail
            if whole >= LCS or answer >= ANSWER and len(asked) >= 10:  # half of a few words is chance
                out[text][item_id] = {"item_id": item_id, "word": word, "cosine": cosine, "lcs": whole, "answer": answer}
        return [list(found.values()) for found in out]


def places(words: Sequence) -> dict:
    """The places of each word as bits."""
    out: dict = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def lcs(mask: dict, words: Sequence, length: int) -> int:
    """Length of the longest common subsequence; ``mask`` has the places of each word as bits."""
    full = (1 << length) - 1
    row = full
    for word in words:
        if hit := row & mask.get(word, 0):
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def _items(benchmark: DataFrame) -> DataFrame:
    """``rank, item_id, words`` of all items with words, equal ones once, numbered from 0."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [[w for w in map(plain, text.split()) if w] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["item_id", "words"])

    rows = (benchmark.where("item_id is not null and text is not null")
            .select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct())
    split_rows = rows.mapInArrow(split, "item_id bigint, words array<string>").where("size(words) > 0")
    return stage(numbered(split_rows, [F.col("item_id"), F.col("words")]), "items")


def _word_counts(items: DataFrame) -> DataFrame:
    """``word, n``: in how many items a word stands."""
    return stage(items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word")
                 .agg(F.count(F.lit(1)).alias("n")), "item-words")


def _kind(vocabulary: Vocabulary) -> str:
    return "<i2" if len(vocabulary.number) < 1 << 15 else "<i4"


def number_words(docs: DataFrame, vocabulary: Vocabulary, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``docs`` and ``_numbers``, the numbers of the words of its text; a table of its own."""
    kind = _kind(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                _, numbers, n = vocabulary.of(batch.column(0).slice(at, 256).to_pylist())
                out += [part.tobytes() for part in np.split(numbers.astype(kind), np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out, pa.binary())], [*columns, "_numbers"])

    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("_numbers", T.BinaryType())])
    text = F.col("text").alias("_text")
    return stage(docs.select(text, *columns).mapInArrow(run, schema), "numbered-words")


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    held = [x or b"" for x in column.to_pylist()]
    return np.frombuffer(b"".join(held), kind).astype(np.int32), np.array([len(x) // np.dtype(kind).itemsize for x in held], np.int64)


def fit(docs: DataFrame, items: list[tuple[int, list[str]]], vocabulary: Vocabulary) -> Model:
    """Statistics of all documents, whose words are numbered, for these items."""
    width, kind = len(vocabulary.words), _kind(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(width)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                sketch.add(*_numbers(batch.column(0).slice(low, 256), kind))
        for low, packed in sketch.rows():
            yield pa.RecordBatch.from_arrays([pa.array([low], pa.int32()), pa.array([packed], pa.binary())], ["low", "packed"])

    sketch = Sketch(width)
    for row in _summed(docs.select("_numbers").mapInArrow(run, "low int, packed binary")).toLocalIterator():
        sketch.put(row.low, row.packed)
    for _, words in items:  # the items are passages too
        numbers = np.array([vocabulary.number[w] for w in words], np.int32)
        sketch.add(numbers, np.array([len(numbers)]))
    return Model(items, vocabulary, sketch)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``leaks``: the benchmark items found in the text.

    NULL and empty texts and texts without the items' words have none; so has everything when the benchmark
    is empty. NULL or wordless items are never found; equal items are found each. Repeated rows and doc_ids
    are rows of their own; columns named ``leaks`` or ``_numbers`` are replaced. Long texts are searched whole, in
    windows. A benchmark of more than :data:`ITEMS` items is looked for block by block; which words are content words
    is decided over all of it, so an item is judged by the same words in any block.
    """
    out = docs.drop("leaks", "_numbers").withColumn("text", F.col("text").cast("string")).withColumn("leaks", F.array().cast(LEAKS))
    for model, vocabulary in _models(benchmark):
        out = _search(out, out.columns, model, vocabulary)
    return out


def _models(benchmark: DataFrame) -> Iterator[tuple[Callable[[DataFrame], Model], Vocabulary]]:
    """Per block of items its vocabulary, and what makes its model of documents with numbered words."""
    items = _items(benchmark)
    held, total = _word_counts(items), items.count()
    for low in range(0, total, ITEMS):
        block = items.where((F.col("rank") >= low) & (F.col("rank") < low + ITEMS))
        told = block.select(F.explode("words").alias("word")).distinct().join(held, "word").collect()
        mine = [(r.item_id, r.words) for r in block.orderBy("rank").collect()]
        vocabulary = Vocabulary(mine, {r.word: r.n for r in told}, total)
        yield (lambda words, mine=mine, vocabulary=vocabulary: fit(words, mine, vocabulary)), vocabulary


def _search(docs: DataFrame, columns: Sequence[str], model_of: Callable[[DataFrame], Model], vocabulary: Vocabulary) -> DataFrame:
    """``columns`` of ``docs``, the last of which is ``leaks``, with the leaks of one block of items added."""
    words = number_words(docs, vocabulary, columns)
    shared = docs.sparkSession.sparkContext.broadcast(model_of(words))
    schema, kind = docs.select(*columns).schema, _kind(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.list_(pa.struct([("item_id", pa.int64()), ("word", pa.int32()), ("cosine", pa.float64()),
                                     ("lcs", pa.float64()), ("answer", pa.float64())]))
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 256):
                found += shared.value.settled(*_numbers(batch.column(batch.num_columns - 1).slice(at, 256), kind))
            found = [a + b for a, b in zip(batch.column(batch.num_columns - 2).to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, listed)], list(columns))

    return words.mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it."""
    plain_docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("leaks", F.array().cast(LEAKS))
    # The numbers of the words say it all, so the texts are not written again.
    found = [_search(plain_docs, ["doc_id", "leaks"], model, vocabulary) for model, vocabulary in _models(benchmark)]
    every = reduce(DataFrame.unionByName, found) if found else plain_docs.drop("text").limit(0)
    return every.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item was found."""
    return shielded(docs, ("leaks", "_numbers"), lambda docs: find_leaks(docs, benchmark)
                    .where(F.size("leaks") == 0).select(*docs.columns))
