"""Log-probabilities of texts by logistic mixing of hashed-context bit predictors.

Texts are lower-cased (A-Z only) and cut into words at ASCII white space; a word is its bytes and a closing
space, and a text ends with a symbol of its own. Bytes are sent bit by bit along a prefix code made from the
training words. For every bit six contexts (the last 1, 2, 3, 4 and 6 bytes, and the whole word so far) are hashed
to counts of zeros and ones. For the first :data:`HEAD` bytes of a word the byte contexts reach over its start into
the text before it, :data:`TAIL` bytes back; later ones see the word alone. Their log odds are combined by one of 80 weight sets, which a
gate chooses by the place in the word and by how often the word so far was seen; a table adapted on the way maps
the mixed probability to the one that was observed. The product over the bits is a distribution over all words.
Inside a text the words said so far are one more predictor: :data:`RECENT` trust it to different degrees, and
the evidence of the text itself weighs them, word after word.

The work follows the corpus: counts are taken over every training text. Words and
openings (the bytes before a word and its first ones) are counted in chunks and summed, so whatever is done per bit
is done once per different word, for its first bytes once per different opening. Counts are additive and are summed over tasks; the
weights are learned online in each task, each word predicted as if its own occurrence were not yet counted, and
averaged by the evidence behind them. A model has a fixed largest size, :data:`MAX_BITS`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, stage

ORDERS = (1, 2, 3, 4, 6, 0)  # bytes of context; 0 is the word so far
MIN_BITS, MAX_BITS = 12, 22  # slots of the widest context's table: 2 to the power of these
#: First bytes of a word, its end included, that are predicted from the text before it, and how many bytes of that.
HEAD, TAIL = 3, 3
CHUNK_BYTES, CHUNK_DOCS = 24 << 20, 100_000  # texts of one chunk, about
SLICE = 1 << 20  # words of whole texts whose probabilities are adapted at once
SHARE = 1_000_000  # different words per task that learns
STEP, LEARN = 2_000, 4_000  # words whose bits are predicted at once, and learned from at once
LEAST_STEPS = 100  # a task with fewer words goes through them several times
BLOCK = 1 << 16  # slots of a table in one row
RATE, DELTA = 0.05, 0.1
PLACES, SEEN = 8, np.array([1, 2, 4, 16, 64, 256, 1024, 4096, 16384])  # what a gate tells apart
GATES, KNOTS, SPAN = PLACES * (len(SEEN) + 1), 33, 8.0
#: Most trust in the words of the text so far, and after how many words half of it is given.
RECENT = ((0.0, 1), (0.05, 4), (0.1, 16), (0.2, 16), (0.2, 128), (0.4, 16), (0.4, 128), (0.6, 128), (0.8, 16))
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CLOSE, END = 0x20, 0x0A  # no word holds these bytes
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_BYTE = np.random.default_rng(12).integers(1, 1 << 63, 257, dtype=np.uint64) | np.uint64(1)


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, bits and length of the path of each of the 256 bytes in a tree where frequent bytes are near the root."""
    heap = [(int(c) + 1, byte, byte) for byte, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for node in range(256, 511):
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (node, 0), (node, 1)
        heapq.heappush(heap, (a + b, node, node))
    paths = []
    for byte in range(256):
        path, at = [], byte
        while at in parent:
            at, bit = parent[at]
            path.append((at, bit))
        paths.append(path[::-1])
    depth = np.array([len(p) for p in paths])
    nodes, bits = np.zeros((256, depth.max()), np.uint64), np.zeros((256, depth.max()), np.int8)
    for byte, path in enumerate(paths):
        nodes[byte, :len(path)], bits[byte, :len(path)] = [n for n, _ in path], [b for _, b in path]
    return nodes, bits, depth


def ends(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per word its first bytes with its end, and its last bytes above their number, as whole numbers."""
    heads = b"".join([(w[:HEAD] + b" " if w else b"\n")[:HEAD].ljust(HEAD, b"\0") for w in words])
    tails = b"".join([w[-TAIL:].rjust(TAIL, b"\0") for w in words])
    size = np.fromiter((min(len(w), TAIL) for w in words), np.int64, len(words))
    packed = [np.frombuffer(b, np.uint8).reshape(-1, 3).astype(np.int64) @ np.array([1 << 16, 1 << 8, 1]) for b in (heads, tails)]
    return packed[0], size << 24 | packed[1]


def openings(head: np.ndarray, tail: np.ndarray, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per word of the texts the bytes before it (one space between words) and its first bytes, as a whole number.

    ``head`` and ``tail`` are the :func:`ends` of the words that ``ids`` number. Before a text stands another's end.
    """
    starts = np.cumsum(length) - length
    last, size = tail[ids] & 0xFFFFFF, tail[ids] >> 24
    gap = np.full(len(ids), CLOSE)
    gap[starts] = END
    earlier = np.concatenate([[END], last[:-1] & 255])
    earlier[starts] = END
    after = np.where(size == 3, last, np.where(size == 2, gap << 16 | last, earlier << 16 | gap << 8 | last))
    before = np.concatenate([[0], after[:-1]])
    before[starts] = END << 16 | END << 8 | END
    return before << 24 | head[ids]


def opened(keys: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """First bytes of words and the bytes before them, from their numbers."""
    raw = keys.astype(">i8").tobytes()
    head = np.frombuffer(raw, np.uint8).reshape(-1, 8)[:, 5:]
    # Nothing stands behind the end of a word.
    size = np.where(head[:, 0] == END, 1, np.where((head == CLOSE).any(1), (head == CLOSE).argmax(1) + 1, HEAD)).tolist()
    at = range(0, len(raw), 8)
    return [raw[i + 5:i + 5 + n] for i, n in zip(at, size, strict=True)], [raw[i + 2:i + 5] for i in at]


class Events:
    """The bits of some words: ``word`` (its number), ``bit``, and the slot of every context.

    Without ``tails`` they are whole words at the start of a text. Otherwise a word with a tail is the first bytes of
    one, and the tail stands before it; of a word whose tail is None only what follows its first bytes counts.
    """

    def __init__(self, words: Sequence[bytes], code: tuple, sizes: Sequence[int], tails: Sequence[bytes | None] | None = None) -> None:
        nodes, bits, depth = code
        tails = [None] * len(words) if (whole := tails is None) else tails
        spelled = [w if t is not None else w + b" " if w else b"\n" for w, t in zip(words, tails, strict=True)]
        flat = np.frombuffer(b"".join(spelled), np.uint8)
        length = np.fromiter(map(len, spelled), np.int64, len(words))
        first = np.repeat(np.cumsum(length) - length, length)
        place = np.arange(len(flat)) - first
        opening = np.repeat(np.fromiter((t is not None for t in tails), bool, len(words)), length)
        near = np.frombuffer(b"".join([t or b"\0" * TAIL for t in tails]), np.uint8).reshape(-1, TAIL)[:, ::-1]
        contexts = self._contexts(flat, first, place, opening, np.repeat(near, length, 0) if opening.any() else None)
        used = np.flatnonzero(opening | whole | (place >= HEAD))
        steps = depth[flat[used]]
        at = np.repeat(used, steps)
        within = np.arange(len(at)) - np.repeat(np.cumsum(steps) - steps, steps)
        symbol = flat[at]
        node = nodes[symbol, within] * _FACTOR
        self.bit = bits[symbol, within]
        self.word = np.repeat(np.arange(len(words)), length)[at]
        self.place = place[at]
        self.slots = []
        for context, size in zip(contexts, sizes, strict=True):
            mixed = (context[at] + node) * _MIX
            mixed ^= mixed >> np.uint64(31)
            self.slots.append(((mixed * _FACTOR) >> np.uint64(64 - size)).astype(np.int64))

    @staticmethod
    def _contexts(flat: np.ndarray, first: np.ndarray, place: np.ndarray, opening: np.ndarray,
                  near: np.ndarray | None) -> list[np.ndarray]:
        codes = _BYTE[flat]
        out, hashed, last = {}, np.zeros(len(flat), np.uint64), 0
        for order in sorted(o for o in ORDERS if o):
            for back in range(last + 1, order + 1):
                # Before the word stands one mark, and before that the text's earlier bytes, the nearest first.
                before = np.zeros(len(flat), np.uint64)
                before[back:] = codes[:-back] if back < len(flat) else 0
                before = np.where(place >= back, before, np.where(place == back - 1, _BYTE[256], np.uint64(0)))
                if near is not None:
                    seen = np.flatnonzero(opening & (place <= back - 2) & (place > back - 2 - TAIL))
                    before[seen] = _BYTE[near[seen, back - 2 - place[seen]]]
                hashed = (hashed + before) * _FACTOR
            out[order], last = hashed * _BYTE[order], order
        power = np.cumprod(np.full(len(flat), _FACTOR, np.uint64))
        back = np.cumprod(np.full(len(flat), _INVERSE, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * power, dtype=np.uint64)])
        out[0] = (total[:-1] - total[first]) * back[first] * _BYTE[0]
        return [out[order] for order in ORDERS]


def packed(values: np.ndarray) -> tuple[bytes, str, tuple[int, ...]]:
    """An array as compressed bytes, all lowest bytes first: the higher ones of most numbers are alike."""
    planes = np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T)
    return pa.compress(planes, "zstd", asbytes=True), values.dtype.str, values.shape


def unpacked(data: bytes, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    size = int(np.prod(shape)) * np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size, "zstd"), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(shape)


class Model:
    """Counts per context slot, weights per gate and the refinement table."""

    def __init__(self, code: tuple, sizes: Sequence[int], tables: Sequence[np.ndarray]) -> None:
        self.code, self.sizes, self.tables = code, list(sizes), list(tables)
        self.weights = np.full((GATES, len(ORDERS) + 1), 0.2, np.float64)
        self.weights[:, -1] = 0
        knots = 1 / (1 + np.exp(-np.linspace(-SPAN, SPAN, KNOTS)))
        #: How often a one followed, and how often either, near each knot; the start says what was predicted.
        self.seen = np.tile(np.stack([20 * knots, np.full(KNOTS, 20.0)], -1), (GATES, 1, 1))

    @cached_property
    def odds(self) -> list[np.ndarray]:
        """Log odds of a one per slot."""
        return [np.log((t[:, 1] + np.float32(DELTA)) / (t[:, 0] + np.float32(DELTA))) for t in self.tables]

    @cached_property
    def often(self) -> np.ndarray:
        """The gate's part of the count in each slot of the word so far, which is the last context."""
        return np.searchsorted(SEEN, self.tables[-1].sum(1), side="right").astype(np.uint8)

    def learned(self) -> Model:
        """This model with what predicts only: half the memory."""
        model = Model(self.code, self.sizes, [])
        model.weights, model.seen, model.odds, model.often = self.weights, self.seen, self.odds, self.often
        return model

    def __getstate__(self) -> dict[str, Any]:
        """Tables are packed: every executor keeps what is sent to it on its disk."""
        return {k: [packed(t) for t in v] if k in ("tables", "odds") else packed(v) if k == "often" else v
                for k, v in self.__dict__.items()}

    def __setstate__(self, state: dict[str, Any]) -> None:
        self.__dict__.update({k: [unpacked(*t) for t in v] if k in ("tables", "odds") else unpacked(*v) if k == "often" else v
                              for k, v in state.items()})

    def inputs(self, events: Events, unseen: bool) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of every context and a constant, and the gate, of each bit.

        ``unseen``: as if the occurrence at hand were not among the counts.
        """
        x = np.ones((len(ORDERS) + 1, len(events.bit)), np.float32)
        if unseen:
            bit = events.bit.astype(np.float32)
            for i, (slots, table) in enumerate(zip(events.slots, self.tables, strict=True)):
                counts = np.take(table, slots, 0)
                zero, one = np.maximum(counts[:, 0] - (1 - bit), 0), np.maximum(counts[:, 1] - bit, 0)
                np.log((one + np.float32(DELTA)) / (zero + np.float32(DELTA)), out=x[i])
            often = np.searchsorted(SEEN, zero + one, side="right")
        else:
            for row, slots, odds in zip(x, events.slots, self.odds):  # the constant has no slots
                np.take(odds, slots, out=row, mode="clip")
            often = self.often[events.slots[-1]]
        return x, np.minimum(events.place, PLACES - 1) * (len(SEEN) + 1) + often

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Log odds of a one."""
        weights = np.take(self.weights.astype(np.float32), gate, 0)
        return np.clip(np.einsum("ij,ji->j", x, weights), -SPAN, SPAN).astype(np.float64)

    @staticmethod
    def _knot(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (odds + SPAN) * ((KNOTS - 1) / (2 * SPAN))
        low = np.minimum(at.astype(np.int64), KNOTS - 2)
        return low, at - low

    def refined(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Probability of a one: the mean of the mixed and the observed one."""
        share = (self.seen[..., 0] / self.seen[..., 1]).ravel()
        low, part = self._knot(odds)
        low += gate * KNOTS
        observed = share[low] * (1 - part) + share[low + 1] * part
        return np.clip((1 / (1 + np.exp(-odds)) + observed) / 2, 1e-6, 1 - 1e-6)

    def log10(self, words: Sequence[bytes], tails: Sequence[bytes | None] | None = None) -> np.ndarray:
        """log10 of the probability of each word, or part of one (see :class:`Events`)."""
        out = np.zeros(len(words))
        for at in range(0, len(words), STEP):
            events = Events(words[at:at + STEP], self.code, self.sizes, tails and tails[at:at + STEP])
            x, gate = self.inputs(events, unseen=False)
            one = self.refined(self.mixed(x, gate), gate)
            said = np.log10(np.where(events.bit == 1, one, 1 - one))
            out[at:at + STEP] = np.bincount(events.word, said, min(STEP, len(words) - at))
        return out

    def learn(self, words: Sequence[bytes], counts: np.ndarray, pace: np.ndarray, evidence: np.ndarray, last: bool = True,
              tails: Sequence[bytes | None] | None = None) -> None:
        """One online step: predict the words, then move the weights of the gates met and note what followed.

        A word weighs its count. ``pace`` sums squared slopes, ``evidence`` weights per gate. What followed is noted in
        the ``last`` pass over the words only.
        """
        events = Events(words, self.code, self.sizes, tails)
        x, gate = self.inputs(events, unseen=True)
        odds = self.mixed(x, gate)
        weight = counts[events.word]
        error = weight * (events.bit - 1 / (1 + np.exp(-odds)))
        mass = np.bincount(gate, weight, GATES)
        met = mass > 0
        slope = np.stack([np.bincount(gate, error * row, GATES) for row in x], -1)[met] / mass[met, None]
        pace[met] += slope ** 2
        self.weights[met] += RATE * slope / np.sqrt(pace[met] + 1e-8)
        if not last:
            return
        evidence += mass
        low, part = self._knot(odds)
        for knot, near in ((low, 1 - part), (low + 1, part)):
            cell = gate * KNOTS + knot
            self.seen[..., 0] += np.bincount(cell, weight * near * (events.bit == 1), GATES * KNOTS).reshape(GATES, KNOTS)
            self.seen[..., 1] += np.bincount(cell, weight * near, GATES * KNOTS).reshape(GATES, KNOTS)


class Numbers(dict):
    """Words to their numbers, in the order they are asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def chunks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Texts in chunks: the different words of a chunk, their counts in training texts, their :func:`ends` and the texts
    as word numbers, both :func:`packed`; also the different openings of the training texts with their counts.

    A chunk is some megabytes of texts, or one longer text. The end of a text is the empty word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        known = Numbers()
        rows: list[tuple] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate([r[3] for r in rows])
            trained = np.repeat([not r[1] for r in rows], [len(r[3]) for r in rows])
            counts = np.bincount(ids[trained], minlength=len(known))
            lengths = np.array([len(r[3]) for r in rows])
            outer = np.stack(ends(list(known)))
            opening, times = np.unique(openings(*outer, ids, lengths)[trained], return_counts=True)
            listed = lambda values, kind: pa.array([values], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number], pa.int64()), listed(list(known), pa.binary()), listed(counts, pa.int64()),
                 listed([r[0] or 0 for r in rows], pa.int64()), listed([r[0] is not None for r in rows], pa.bool_()),
                 listed([r[1] for r in rows], pa.bool_()),
                 listed([r[2] for r in rows], pa.int64()), listed([len(r[3]) for r in rows], pa.int64()),
                 pa.array([packed(ids.astype("<i4"))[0]], pa.binary()), pa.array([packed(outer.astype("<i4"))[0]], pa.binary()),
                 listed(opening, pa.int64()), listed(times, pa.int64())],
                ["chunk", "words", "trained", "doc_ids", "named", "held", "sizes", "lengths", "tokens", "ends", "openings", "times"])

        for batch in batches:
            for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = (text.as_buffer().to_pybytes() if text.is_valid else b"")
                words = raw.translate(LOWER).split()
                words.append(b"")
                ids = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                rows.append((doc_id, held, len(raw), ids))
                size += len(raw)
                if size >= CHUNK_BYTES or len(rows) >= CHUNK_DOCS:
                    yield chunk()
                    known, rows, size, number = Numbers(), [], 0, number + 1
        if rows:
            yield chunk()

    held = F.coalesce(held_out, F.lit(False))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "chunk bigint, words array<binary>, trained array<bigint>, doc_ids array<bigint>, named array<boolean>, "
                         "held array<boolean>, sizes array<bigint>, lengths array<bigint>, tokens binary, ends binary, "
                         "openings array<bigint>, times array<bigint>")


def vocabulary(chunked: DataFrame) -> DataFrame:
    """``word, c``: every different word of the texts with its count in training texts."""
    pairs = chunked.select(F.explode(F.arrays_zip("words", "trained")).alias("p"))
    return pairs.groupBy(F.col("p.words").alias("word")).agg(F.sum("p.trained").alias("c"))


def opening_counts(chunked: DataFrame) -> DataFrame:
    """``word, c, opening``: every different opening of the training texts with its count; ``word`` is NULL."""
    pairs = chunked.select(F.explode(F.arrays_zip("openings", "times")).alias("p"))
    counted = pairs.groupBy(F.col("p.openings").alias("opening")).agg(F.sum("p.times").alias("c"))
    return counted.select(F.lit(None).cast("binary").alias("word"), "c", "opening")


def _in_steps(batches: Iterator[pa.RecordBatch], size: int = STEP) -> Iterator[tuple[list[bytes], np.ndarray, list[bytes | None]]]:
    """Words, counts and tails (see :class:`Events`) of rows ``word, c, opening``."""
    for batch in batches:
        words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.float64)
        tails: list[bytes | None] = [None] * len(words)
        rows = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False))
        for row, head, tail in zip(rows.tolist(), *opened(batch.column(2).drop_null().to_numpy()), strict=True):
            words[row], tails[row] = head, tail
        for at in range(0, len(words), size):
            yield words[at:at + size], counts[at:at + size], tails[at:at + size]


def _byte_counts(words: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for step, _, _ in _in_steps(batches):
            total += np.bincount(np.frombuffer(b"".join([w + b" " if w else b"\n" for w in step]), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], ["byte", "n"])

    out = np.zeros(256, np.int64)
    for row in words.where("opening IS NULL").mapInArrow(run, "byte int, n bigint").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[row.byte] = row.n
    return out


def _count_bits(words: DataFrame, code: tuple, sizes: Sequence[int]) -> list[np.ndarray]:
    """Counts of zeros and ones per slot, summed over the tasks block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(2 << size, np.int64) for size in sizes]
        for step, counts, tails in _in_steps(batches):
            events = Events(step, code, sizes, tails)
            weight = counts.astype(np.int64)[events.word]
            for table, slots in zip(tables, events.slots, strict=True):
                np.add.at(table, slots * 2 + events.bit, weight)
        for which, table in enumerate(tables):
            for at in range(0, len(table), BLOCK):
                part = table[at:at + BLOCK]
                if part.any():
                    # All lowest bytes first: the higher ones are mostly zero and are shuffled as next to nothing.
                    planes = part.astype("<u4" if part.max() < 1 << 32 else "<i8").view(np.uint8).reshape(len(part), -1).T
                    yield pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([at], pa.int32()), pa.array(
                        [planes.tobytes()], pa.binary())], ["which", "at", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def block() -> pa.RecordBatch:
            # The ratio is what counts; beyond the exact integers of a float both counts lose digits alike.
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                               pa.array([total.astype("<f4").tobytes()], pa.binary())], ["which", "at", "part"])

        for batch in batches:
            for which, at, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                length = min(BLOCK, 2 << sizes[which])
                planes = np.ascontiguousarray(np.frombuffer(part, np.uint8).reshape(-1, length).T)
                values = planes.view("<u4" if len(part) == 4 * length else "<i8").ravel().astype(np.int64)
                if (which, at) == key:
                    total += values
                    continue
                if key is not None:
                    yield block()
                key, total = (which, at), values
        if key is not None:
            yield block()

    schema = "which int, at int, part binary"
    summed = (words.mapInArrow(run, schema).repartition("which", "at").sortWithinPartitions("which", "at").mapInArrow(add, schema))
    out = [np.zeros(2 << size, np.float32) for size in sizes]
    for row in summed.toLocalIterator():
        out[row.which][row.at:row.at + BLOCK] = np.frombuffer(row.part, "<f4")
    return [t.reshape(-1, 2) for t in out]


def table_sizes(different: int) -> list[int]:
    """Bits of every context's table: they grow with the words up to :data:`MAX_BITS`; short contexts need fewer."""
    wide = min(MAX_BITS, max(MIN_BITS, int(different).bit_length() + 1))
    return [min(wide, {1: 16, 2: 20}.get(order, MAX_BITS - 1 if order else MAX_BITS)) for order in ORDERS]


def train(words: DataFrame, different: int) -> Model:
    """The model of the training words and openings ``word, c, opening`` (``different`` rows, ``c > 0``).

    The driver holds one model, whose size :data:`MAX_BITS` bounds; counts, weights and refinement come from all rows.
    """
    sizes = table_sizes(different)
    code = prefix_code(_byte_counts(words))
    model = Model(code, sizes, _count_bits(words, code, sizes))
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        own = Model(held.code, held.sizes, held.tables)
        start = own.seen.copy()
        pace, evidence = np.zeros_like(own.weights), np.zeros(GATES)
        steps = _in_steps(batches, LEARN)
        few = list(islice(steps, LEAST_STEPS))
        passes = -(-LEAST_STEPS // max(1, len(few)))
        for again in range(passes):
            for step, counts, tails in few:
                own.learn(step, counts, pace, evidence, again == passes - 1, tails)
        for step, counts, tails in steps:
            own.learn(step, counts, pace, evidence, tails=tails)
        values = np.concatenate([(own.weights * evidence[:, None]).ravel(), evidence, (own.seen - start).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["at", "v"])

    # A few thousand sums, whatever the number of tasks.
    sums = words.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    if sums:
        values = np.array([r.v for r in sums])
        weights, evidence, seen = np.split(values, [model.weights.size, model.weights.size + GATES])
        met = evidence > 0
        model.weights[met] = weights.reshape(model.weights.shape)[met] / evidence[met, None]
        model.seen += seen.reshape(model.seen.shape)
    shared.destroy()
    return model


def score_words(words: DataFrame, shared: Broadcast[Model]) -> DataFrame:
    """``word, c, said``: log10 of the probability of what follows a word's first bytes, which is the same in every text;
    a table of its own. :func:`score_openings` adds the first bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            spelled = batch.column(0).to_pylist()
            said = held.log10(spelled, [None] * len(spelled))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(said)], ["word", "c", "said"])

    return stage(words.mapInArrow(run, "word binary, c bigint, said double"), "word-scores")


def score_openings(model: Model, keys: np.ndarray) -> np.ndarray:
    """log10 of the probability of each word's first bytes after the text before it."""
    different, which = np.unique(keys, return_inverse=True)
    return np.concatenate([model.log10(*opened(different[at:at + STEP])) for at in range(0, len(different), STEP)])[which]


def said_before(ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its place in its text, and how often the same word stands before it there."""
    first = np.cumsum(length) - length
    text = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(ids)) - first[text]
    order = np.lexsort((ids, text))  # stable: words of one kind stay in text order
    mine, of = ids[order], text[order]
    fresh = np.concatenate([[True], (mine[1:] != mine[:-1]) | (of[1:] != of[:-1])])
    number = np.arange(len(ids))
    before = np.empty(len(ids), np.int64)
    before[order] = number - np.maximum.accumulate(np.where(fresh, number, 0))
    return place, before


def adapted(said: np.ndarray, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
    """log10 probability per text: ``said`` per word, mixed with the words that the text has said so far.

    Every pair of :data:`RECENT` is a predictor of whole texts; their mean is what step-by-step weighing by
    evidence gives.
    """
    end = np.cumsum(length)
    if end[-1] > SLICE and len(length) > 1:
        half = int(np.clip(np.searchsorted(end, end[-1] // 2, side="right"), 1, len(length) - 1))
        at = end[half - 1]
        return np.concatenate([adapted(said[:at], ids[:at], length[:half]), adapted(said[at:], ids[at:], length[half:])])
    first = end - length
    place, before = said_before(ids, length)
    again = before > 0
    share = np.log(before[again] / place[again])
    places, known = np.arange(length.max()), place[again]
    totals = []
    for most, half in RECENT:
        trust = most * places / (places + half)
        now = said + np.log10(1 - trust)[place]
        if most:
            now[again] = np.logaddexp(now[again] * np.log(10), np.log(trust[1:])[known - 1] + share) / np.log(10)
        totals.append(np.add.reduceat(now, first))
    top = np.max(totals, 0)
    return top + np.log10(np.mean([10 ** (t - top) for t in totals], 0))


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double, bits_per_byte double")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per document the unigram and the mixed log10 probability, and total bits per byte of the text.

    Learns from all documents for which ``held_out`` is not true and scores every whole text, however long; a text is
    its words and one end. NULL, empty and blank texts are the end alone (``bits_per_byte`` is NULL where there is no
    byte). Repeated rows are scored and counted one by one; other columns, whatever their names, are not read. With no
    training documents every bit has probability one half. No rows give no result.
    """
    chunked = stage(chunks(docs, held_out), "chunks")
    vocab = stage(vocabulary(chunked), "words")
    told = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"),
                     F.count(F.lit(1)).alias("rows")).first()
    learned = vocab.where("c > 0").select("word", "c", F.lit(None).cast("bigint").alias("opening"))
    tasks = max(1, -(-told.v // SHARE))
    learned = stage(learned.unionByName(opening_counts(chunked)).repartition(tasks, "word", "opening"), "learned")
    shared = docs.sparkSession.sparkContext.broadcast(train(learned, learned.count()).learned())
    discard(learned)
    scored = score_words(vocab.repartition(max(tasks, -(-told.rows // (SHARE // 4))), "word"), shared)
    floor = np.log10(told.n + 0.5 * (told.v + 1))
    tokens = told.n

    pairs = chunked.select("chunk", F.posexplode("words").alias("at", "word")).join(scored, "word").select("chunk", "at", "c", "said")
    texts = chunked.select(F.col("chunk").alias("of"), "doc_ids", "named", "held", "sizes", "lengths", "tokens", "ends")

    def sums(words: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        c, said = np.zeros(len(words)), np.zeros(len(words))
        c[words["at"]], said[words["at"]] = words["c"], words["said"]
        length = np.asarray(row["lengths"])
        ids = unpacked(row["tokens"], "<i4", (length.sum(),))
        head, tail = unpacked(row["ends"], "<i4", (2, len(words))).astype(np.int64)
        first = np.cumsum(length) - length  # every text has its end, so no stretch is empty
        base = np.log10(c + 0.5) - floor
        total = adapted(said[ids] + score_openings(shared.value, openings(head, tail, ids, length)), ids, length)
        size = np.asarray(row["sizes"], float)
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = np.where(size > 0, -total * np.log2(10) / size, np.nan)
        return pd.DataFrame({
            "doc_id": pd.Series(np.asarray(row["doc_ids"], np.int64)).astype("Int64").where(np.asarray(row["named"], bool)), "held_out": np.asarray(row["held"], bool), "n_tokens": length,
            "n_known": np.add.reduceat((c > 0).astype(np.int64)[ids], first), "train_tokens": tokens,
            "base_score": np.add.reduceat(base[ids], first), "score": total,
            "bits_per_byte": pd.Series(bits).astype(object).where(size > 0, None)})

    out = stage(pairs.groupBy("chunk").cogroup(texts.groupBy("of")).applyInPandas(sums, SCORES), "scores")
    shared.destroy()
    for used in (chunked, vocab, scored):
        discard(used)
    return out
