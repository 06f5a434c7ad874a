"""Concatenate and cut: documents as one stream of token ids, cut into equal windows.

Pass one encodes every document where it lies and writes its ids with its place in the partition; the
token totals of the partitions, summed up in order, give each partition its global offset. Pass two cuts
at multiples of the window and writes one boundary record per piece. No text or token is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import encoder, running_start, stage


def encode_partitions(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``(part, at, doc_id, n, ids)``: ids of each document with ``end_id`` appended, little-endian.

    ``at`` counts the tokens before the document in its partition ``part``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at, part = encoder(vocabulary), 0, TaskContext.get().partitionId()
        end = np.array(end_id, enc.dtype).tobytes()
        width = enc.dtype.itemsize
        for batch in batches:
            keys = batch.column(0)
            for low in range(0, batch.num_rows, 256):
                ids = [x + end for x in enc.encode(batch.column(1).slice(low, 256).to_pylist())]
                n = np.array([len(x) // width for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int64)), pa.array(starts), keys.slice(low, 256),
                     pa.array(n), pa.array(ids, pa.binary())], ["part", "at", "doc_id", "n", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "part bigint, at bigint, doc_id bigint, n bigint, ids binary")


def pack(docs: DataFrame, vocabulary: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of the concatenated documents in windows of ``window`` tokens.

    Columns: ``doc_id, start`` (tokens of the document before the piece), ``length, doc_tokens,
    sequence_id, offset`` (place in the window) and ``ids`` (little-endian unsigned 32-bit). Windows are
    full; only the last one of all may be shorter. The order of documents is the order of the scan.

    A NULL or empty text is one token, the end id. NULL or repeated doc_ids are documents like any other,
    other columns are ignored, no documents give no pieces. A long text simply crosses many windows.
    """
    coded = stage(encode_partitions(docs, vocabulary, end_id), "tokens")
    base = running_start(coded.groupBy("part").agg(F.sum("n").alias("total")), "part", "total")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(vocabulary).dtype
        for batch in batches:
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, begin, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(ids, dtype).astype("<u4")
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(begin + start, window)
                    length = min(window - offset, len(ids) - start)
                    for name, value in zip(names, (doc_id, start, length, len(ids), sequence, offset,
                                                   ids[start:start + length].tobytes()), strict=True):
                        out[name].append(value)
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], pa.binary() if n == "ids" else pa.int64()) for n in names], names)

    return (coded.join(base, "part").select("doc_id", (F.col("base") + F.col("at")).alias("begin"), "ids")
            .mapInArrow(cut, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
                             "sequence_id bigint, offset bigint, ids binary"))


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The windows themselves: ``sequence_id, ids`` (padded), ``n_tokens, bounds`` (its pieces in order).

    A window has at most ``window`` pieces, so each group is bounded. The last window is padded to the
    next power of two instead of the whole window.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, total = [], []
            for parts in batch.column("parts").to_pylist():
                row = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int64)
                size = window if len(row) == window else 1 << max(0, int(len(row) - 1).bit_length())
                total.append(len(row))
                ids.append(np.pad(row, (0, size - len(row)), constant_values=pad_id))
            bounds = batch.column("bounds")
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int64())), pa.array(total, pa.int64()),
                 bounds], ["sequence_id", "ids", "n_tokens", "bounds"])

    grouped = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("parts"))
    bounds = F.transform("parts", lambda p: F.struct(p.offset.alias("offset"), p.doc_id.alias("doc_id"),
                                                     p.start.alias("start"), p.length.alias("length")))
    kind = "array<struct<offset:bigint,doc_id:bigint,start:bigint,length:bigint>>"
    return grouped.select("sequence_id", F.transform("parts", lambda p: F.struct(p.ids.alias("ids"))).alias("parts"),
                          bounds.alias("bounds")) \
        .mapInArrow(build, f"sequence_id bigint, ids array<bigint>, n_tokens bigint, bounds {kind}")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
