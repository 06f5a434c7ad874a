"""Repeated passages: units of lines hashed, grouped over all documents, earliest occurrence kept.

A unit is a line, or the part of a line between sentence ends; short sentences join the next one. Units are
normalised (case, white space) and hashed to 128 bits; digests are counted before anything is joined. Of each
digest the occurrence with the smallest doc_id and offset stays. Whole lines of several units have a digest of
their own. Repeated whole lines and runs of repeated units that are long enough are removed, with their offsets
in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import shielded, stage

UNIT_WORDS = 5  # a sentence with fewer words is one unit with the next one of its line
RUN_WORDS = 10  # repeated units in a row with fewer words together stay, unless they are a whole line
_END = re.compile(r"[.!?]+(?=\s)|\n")
UNITS = "row bigint, doc_id bigint, unit int, start int, stop int, words int, line int, hi bigint, lo bigint"
SPANS = "array<struct<start:int,stop:int,kept_doc_id:bigint>>"


def units(text: str, least: int = UNIT_WORDS) -> Iterator[tuple[int, int, list[str]]]:
    """``(start, stop, words)`` of the units of a text; ``words`` in lower case."""
    start, held = 0, []
    at = 0
    for end in _END.finditer(text):
        held += text[at:end.end()].split()
        line = text[end.start()] == "\n"
        at = end.end()
        if line or len(held) >= least:
            if held:
                yield start, end.start() if line else at, [w.lower() for w in held]
            start, held = at, []
    held += text[at:].split()
    if held:
        yield start, len(text), [w.lower() for w in held]


def units_and_lines(text: str, least: int = UNIT_WORDS) -> Iterator[tuple[int, int, int, list[str], int]]:
    """``(number, start, stop, words, line)`` of the units, and once more of each line that has several.

    ``line`` is the number of units of a whole line, which starts with unit ``number``, and 0 for a part of a line.
    """
    held: list[tuple[int, int, int, list[str]]] = []
    for number, (start, stop, words) in enumerate(units(text, least)):
        if held and "\n" in text[held[-1][2]:start + 1]:
            yield from _line(held)
            held = []
        held.append((number, start, stop, words))
    yield from _line(held)


def _line(held: list[tuple[int, int, int, list[str]]]) -> Iterator[tuple[int, int, int, list[str], int]]:
    for unit in held:
        yield *unit, int(len(held) == 1)
    if len(held) > 1:
        yield held[0][0], held[0][1], held[-1][2], [w for unit in held for w in unit[3]], len(held)


def hash_units(docs: DataFrame, least: int = UNIT_WORDS) -> DataFrame:
    """Units and whole lines of ``docs (row, doc_id, text)`` with their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "unit", "start", "stop", "words", "line", "hi", "lo"]
        kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for number, start, stop, words, line in units_and_lines(text or "", least):
                    digest = xxhash.xxh3_128_intdigest(" ".join(words).encode())
                    for column, value in zip(out, (row, doc_id, number, start, stop, len(words), line,
                                                   (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)),
                                             strict=True):
                        column.append(value)
                if len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return docs.select("row", "doc_id", "text").mapInArrow(run, UNITS)


def find_repeats(docs: DataFrame, least: int = UNIT_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """Rows of ``docs (row, doc_id, text)`` with something to remove: ``row, doc_id, spans``.

    Repeated whole lines of ``least`` words and repeated units in a row with ``run_words`` together are removed.
    ``spans`` are ``start, stop`` (code points of the original text, stop exclusive) and the doc_id of the
    occurrence that stays, in order. NULL and empty texts have no units; a NULL doc_id ranks first; rows
    with equal doc_ids rank by ``row``; copies of a whole text lose all of these but in the first copy.
    """
    hashed = stage(hash_units(docs, least), "units")
    place = F.struct(F.col("doc_id"), F.col("row"), F.col("unit"))
    repeated = (hashed.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                .where("n > 1").select("hi", "lo", "first"))
    later = (hashed.join(repeated, ["hi", "lo"])
             .where((F.col("row") != F.col("first.row")) | (F.col("unit") != F.col("first.unit")))
             .select("row", "doc_id", F.struct("unit", "line", "start", "stop", "words", F.col("first.doc_id").alias("kept")).alias("u")))
    grouped = later.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("u")).alias("us"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for us in batch.column(2).to_pylist():
                # A line of several units stands for them: they are repeated in the same place or an earlier one.
                gone = {n for u in us if u["line"] and u["words"] >= least for n in range(u["unit"], u["unit"] + u["line"])}
                parts, run = [u for u in us if u["line"] < 2], []
                for u in [*parts, None]:
                    if run and (u is None or u["unit"] != run[-1]["unit"] + 1):
                        if sum(x["words"] for x in run) >= run_words:
                            gone.update(x["unit"] for x in run)
                        run = []
                    if u is not None:
                        run.append(u)
                spans, last = [], None
                for u in parts:
                    if u["unit"] not in gone:
                        continue
                    if u["unit"] - 1 == last:
                        spans[-1]["stop"] = u["stop"]
                    else:
                        spans.append({"start": u["start"], "stop": u["stop"], "kept_doc_id": u["kept"]})
                    last = u["unit"]
                out.append(spans)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kept_doc_id", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], ["row", "doc_id", "spans"])

    return grouped.mapInArrow(runs, f"row bigint, doc_id bigint, spans {SPANS}").where(F.size("spans") > 0)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Per document with repeated passages: ``doc_id, spans, kept_in`` (where they stay), ``removed`` characters."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return find_repeats(_rows(docs)).select(
        "doc_id", "spans", F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["kept_doc_id"]))).alias("kept_in"),
        removed.alias("removed"))


def clean(docs: DataFrame) -> DataFrame:
    """All documents, repeated passages cut out of ``text``; other columns stay."""
    return shielded(docs, ("row", "spans"), _cleaned)


def _cleaned(docs: DataFrame) -> DataFrame:
    placed = stage(docs.withColumn("row", F.monotonically_increasing_id()), "documents")
    found = find_repeats(placed.select("row", F.col("doc_id").cast("bigint").alias("doc_id"), "text")).select("row", "spans")

    def step(acc, s):
        gap = F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(s["stop"].alias("at"), F.concat(acc["out"], gap).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate("spans", zero, step, lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    return (placed.join(found.hint("shuffle_hash"), "row", "left")
            .withColumn("text", F.when(F.col("spans").isNotNull(), cut).otherwise(F.col("text"))).select(*docs.columns))
