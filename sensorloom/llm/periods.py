"""Periodic runs of words by multi-scale minimizers, and texts with the repetitions taken out.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical) that holds at least
``COPIES`` periods and ``SHORTEST`` words and that no neighbouring word extends. Periods below ``DIRECT`` are
found by scans of each lag. Longer ones are found scale by scale: for periods in ``[m, 2m)`` the names of all
``2m``-grams are taken, the smallest name of every window of ``m`` of them is selected, and successive
selected places with equal names at a distance in ``[m, 2m)`` are seeds, extended to both sides.

No run is missed. A run of four periods holds a window and the window one period later, both whole, so the
place selected in the first is selected again one period later. Equal grams of ``2m > q`` words inside the
run cannot lie closer than ``q`` (two periods of a stretch as long as both have their common divisor as a
period, and ``q`` is the smallest), so the two places succeed each other. Names are exact ranks made by
doubling, not hashes; a scale whose grams are all different ends the search, as longer grams differ too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import shielded

SHORTEST, COPIES = 6, 4
DIRECT = 8  # periods below are found by direct scans; a power of two
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def numbered_words(words: Sequence[str]) -> np.ndarray:
    """Equal words get equal numbers, different words different ones."""
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    different, ranks = np.unique(values, return_inverse=True)
    return ranks.astype(np.int64), len(different)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _selected(order: np.ndarray, width: int) -> np.ndarray:
    """Places that are the leftmost smallest of some window of ``width`` (a power of two) neighbours."""
    n = len(order)
    low, have = order * n + np.arange(n), 1
    while have < width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.unique(low % n)


def _seeds(names: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of successive selected places with equal names, by distance and place."""
    mixed, _ = _ranks(names.astype(np.uint64) * _MIX)  # an order that text order does not decide
    at = _selected(mixed, scale)
    at = at[np.lexsort((at, names[at]))]
    lag = np.diff(at)
    good = (names[at[1:]] == names[at[:-1]]) & (lag >= scale) & (lag < 2 * scale)
    at, lag = at[:-1][good], lag[good]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def _reach(same_from: np.ndarray, same_to: np.ndarray) -> int:
    """How many words agree from the first on; compared in pieces that grow."""
    n, at, step = min(len(same_from), len(same_to)), 0, 64
    same_from, same_to = same_from[:n], same_to[:n]
    while at < n:
        differ = same_from[at:at + step] != same_to[at:at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return n


def find_in(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of the word numbers, by start and then period."""
    n, found = len(words), {}

    def note(start: int, end: int, period: int) -> None:
        # A stretch with two periods has the smaller one; lags are tried in no fixed order.
        if end - start >= max(SHORTEST, COPIES * period):
            found[start, end] = min(period, found.get((start, end), period))

    for lag in range(1, min(DIRECT, n // COPIES + 1)):
        starts, ends = _stretches(words[:-lag] == words[lag:])
        long = ends - starts >= max(SHORTEST, COPIES * lag) - lag
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            note(start, end + lag, lag)
    names, length, scale = words, 1, DIRECT
    while COPIES * scale <= n:
        while length < 2 * scale:  # names of grams twice as long
            names, different = _ranks(names[:-length] * n + names[length:])
            length *= 2
            if different == len(names):
                return [(s, e - s, q) for (s, e), q in sorted(found.items(), key=lambda r: (r[0][0], r[1]))]
        done = (0, -1)  # lag and end of the last stretch looked at: later seeds inside it tell nothing new
        for at, lag in zip(*(x.tolist() for x in _seeds(names, scale)), strict=True):
            if lag == done[0] and at < done[1]:
                continue
            end = at + _reach(words[at:], words[at + lag:])
            start = at - _reach(words[at - 1::-1] if at else words[:0], words[at + lag - 1::-1])
            done = (lag, end)
            note(start, end + lag, lag)
        scale *= 2
    return [(s, e - s, q) for (s, e), q in sorted(found.items(), key=lambda r: (r[0][0], r[1]))]


def kept_words(n: int, runs: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: all but those that a run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (by start, then period), ``n_words`` and ``collapsed`` (kept words, one space between).

    Words are what ASCII white space separates; they are numbered from 0. NULL, empty and blank texts have no
    words, no runs and an empty ``collapsed``. A text is worked on as a whole, however long: the time grows as its
    words times their logarithm, and a stretch is compared once per lag. Repeated rows are handled one by one,
    other columns pass through under their own names, and an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, sizes, texts = [], [], []
            at = batch.schema.get_field_index("_periods_of")
            for value in batch.column(at):
                words = split_words(value.as_py())
                own = find_in(numbered_words(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                sizes.append(len(words))
                if own:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), own)).tolist()]
                texts.append(" ".join(words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(runs, kind), pa.array(sizes, pa.int64()), pa.array(texts, pa.string())],
                [batch.schema.names[i] for i in kept] + ["_runs", "_n_words", "_collapsed"])

    def whole(own: DataFrame) -> DataFrame:
        # Positions, not names, reach the Python side, so any column names will do.
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
        out = own.select("*", F.col(f"`{given}`").cast("string").alias("_periods_of")).mapInArrow(
            run, f"{fields}, _runs {RUNS}, _n_words bigint, _collapsed string")
        return out.withColumnsRenamed({"_runs": "runs", "_n_words": "n_words", "_collapsed": "collapsed"})

    taken = ("runs", "n_words", "collapsed", "_periods_of", "_runs", "_n_words", "_collapsed")
    given = f"_own_{docs.columns.index(text)}_" if text.lower() in taken else text
    return shielded(docs, taken, whole)


def strongest(runs: str | Column) -> Column:
    """The run with the greatest length per period, exactly; ties go to the smaller start, then period."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with periods planted in a tenth of the texts, as the crc32 of doc_id tells.

    With ``h`` that crc32 and ``g = h div 10``, where ``h`` ends in 0 the words from ``a = g mod n`` on repeat the
    first ``1 + (n - a) div (3 + g mod 8)`` of them. A NULL doc_id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("bigint").alias("g")) \
        .withColumn("n", F.size("w").cast("bigint"))
    start = chosen.withColumn("a", F.expr("cast(if(n > 0, g % n, 0) as int)")) \
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    # Whole copies of the cycle, cut to length: no function runs per word.
    cycle = F.expr("flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p as int) + 1))")
    made = F.concat(F.expr("slice(w, 1, a)"), F.slice(cycle, F.lit(1), F.expr("cast(n as int) - a")))
    return start.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Digests of the runs and of the collapsed text, and the strongest run, per document."""
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return find_runs(docs).withColumn("best", strongest("runs")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
