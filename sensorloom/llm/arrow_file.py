"""Token ids as Arrow files of fixed-size lists.

A file holds equal-length sequences of one range of doc_ids and, beside them, masks of bytes that are 1 where a
token is. Only the last sequence of a file is padded, so the masks are a dictionary of the file: that of a full
sequence and, with the last batch, that of the padded one. Record batches have a fixed number of sequences, so sequence ``i`` lies in batch ``i // rows``
at place ``i % rows`` and is read as a slice of the mapped file, without a copy. A second small file per
range lists its documents. File names follow from the partition, and a file appears under its name only
when complete, so a task that runs again replaces its own file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import encoder, running_start, stage

MANIFEST = "part bigint, tokens_path string, docs_path string, n_docs bigint, n_tokens bigint"


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    path = _uri(path)
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/")
                                  and not path.startswith("file://") else path)


class SequenceWriter:
    """Writes a stream of ids as batches of ``rows`` sequences of ``length`` ids, and a mask."""

    def __init__(self, sink, dtype: np.dtype, length: int, rows: int) -> None:
        self.length, self.rows, self.dtype = length, rows, dtype
        value = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(value, length)), ("mask", pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length)))],
                                metadata={"length": str(length), "rows": str(rows)})
        self.out = pa.ipc.new_file(sink, self.schema, options=pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True))
        self.waiting: list[bytes] = []
        self.size, self.total = 0, 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.dtype.itemsize
        full = self.length * self.rows * self.dtype.itemsize
        if self.size >= full:
            data = b"".join(self.waiting)
            whole = len(data) // full * full
            for low in range(0, whole, full):
                self._batch(np.frombuffer(data, self.dtype, self.length * self.rows, low))
            self.waiting, self.size = [data[whole:]], len(data) - whole

    def _batch(self, ids: np.ndarray) -> None:
        n = -(-len(ids) // self.length)
        padded = np.zeros(n * self.length, self.dtype)
        padded[:len(ids)] = ids
        which, masks = np.zeros(n, np.int8), np.ones(self.length, np.uint8)
        if short := n * self.length - len(ids):
            which[-1] = 1
            masks = np.concatenate([masks, np.ones(self.length - short, np.uint8), np.zeros(short, np.uint8)])
        fixed = lambda values: pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [fixed(padded), pa.DictionaryArray.from_arrays(pa.array(which), fixed(masks))], schema=self.schema))

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.waiting), self.dtype)
        if len(rest):
            self._batch(rest)
        self.out.close()


class SequenceFile:
    """Random access to a file of :class:`SequenceWriter`; local files are mapped, not read."""

    def __init__(self, path: str) -> None:
        store, inner = open_store(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(inner) if local else store.open_input_file(inner)
        self.file = pa.ipc.open_file(self.source)
        meta = self.file.schema.metadata
        self.length, self.rows = int(meta[b"length"]), int(meta[b"rows"])
        self.at: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _batch(self, i: int) -> pa.RecordBatch:
        if self.at[0] != i:
            self.at = (i, self.file.get_batch(i))
        return self.at[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``, both views of the file."""
        batch, row = self._batch(i // self.rows), i % self.rows
        mask = batch.column(1)
        at = mask.indices[row].as_py()
        return (batch.column(0).values.to_numpy()[row * self.length:(row + 1) * self.length],
                mask.dictionary.values.to_numpy()[at * self.length:(at + 1) * self.length])

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the stream."""
        span, out = self.length * self.rows, []
        while n > 0:
            i, low = divmod(start, span)
            take = min(n, span - low)
            out.append(self._batch(i).column(0).values.to_numpy()[low:low + take])
            start, n = start + take, n - take
        return out[0] if len(out) == 1 else np.concatenate(out or [np.zeros(0, np.uint16)])

    def close(self) -> None:
        self.at = (-1, None)
        self.source.close()


def write_sequences(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, length: int = 2048, rows: int = 128
) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the manifest, one row per file.

    A NULL or empty text is the end id alone, a very long one spans as many sequences as it needs; NULL doc_ids come first, rows with the same doc_id stand
    next to each other; other columns are ignored; no documents give no file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, writer, at = encoder(vocabulary), TaskContext.get().partitionId(), None, 0
        end = np.array(end_id, enc.dtype).tobytes()
        doc_ids, starts, counts = [], [], []
        store, root = open_store(folder)
        names = [f"{root}/part-{part:06d}{kind}.arrow" for kind in ("", ".docs")]
        temp = [f"{name}.{uuid.uuid4().hex}" for name in names]
        for batch in batches:
            if writer is None and batch.num_rows:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(temp[0])
                writer = SequenceWriter(sink, enc.dtype, length, rows)
            for low in range(0, batch.num_rows, 256):
                doc_ids += batch.column(0).slice(low, 256).to_pylist()
                for ids in enc.encode(batch.column(1).slice(low, 256).to_pylist()):
                    writer.add(ids + end)
                    starts.append(at)
                    counts.append(writer.total - at)
                    at = writer.total
        if writer is None:
            return
        writer.close()
        sink.close()
        index = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(starts, pa.int64()),
                          "n_tokens": pa.array(counts, pa.int64())})
        with store.open_output_stream(temp[1]) as out, pa.ipc.new_file(out, index.schema) as file:
            file.write_table(index, max_chunksize=65_536)
        for old, new in zip(temp, names, strict=True):
            store.move(old, new)
        prefix = folder.rstrip("/")
        row = {"part": [part], "tokens_path": [f"{prefix}/part-{part:06d}.arrow"],
               "docs_path": [f"{prefix}/part-{part:06d}.docs.arrow"], "n_docs": [len(doc_ids)], "n_tokens": [at]}
        yield pa.RecordBatch.from_pydict(row)

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    sorted_docs = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(sorted_docs.mapInArrow(run, MANIFEST), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32`` from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens_path, docs_path, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tokens, (store, inner) = SequenceFile(tokens_path), open_store(docs_path)
                with store.open_input_file(inner) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        docs = index.get_batch(i)
                        start, n = (docs.column(k).to_numpy() for k in (1, 2))
                        crc = [zlib.crc32(tokens.tokens(s, k).astype("<u4").tobytes())
                               for s, k in zip(start.tolist(), n.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [docs.column(0), pa.array(start + base), docs.column(2), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                tokens.close()

    base = running_start(manifest, "part", "n_tokens")
    placed = manifest.join(base, "part").select("tokens_path", "docs_path", "base")
    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(width, "tokens_path").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
