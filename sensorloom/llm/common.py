"""Helpers of the text operators: staged tables, gapless numbering, components, word hashes."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterable, Sequence
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorloom.session import scratch

# Words a Python worker keeps between batches; beyond that the store starts anew.
CACHE_WORDS = 700_000
#: Pieces of text in each of an encoder's stores; twice as many with those of the round before.
CACHE_PIECES = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers on this machine find the package where the driver found it;
    on a cluster it is shipped with ``--py-files`` as usual."""
    home, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if home not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [home, paths.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here.

    A task that is run again after a lost executor reads these files and so sees the same rows.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stage` that nothing reads any more."""
    spark, path = df.sparkSession, getattr(df, "_staged_at", None)
    if path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shielded(docs: DataFrame, reserved: Sequence[str], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` over ``docs`` while columns whose names it needs for itself have other names."""
    away = {c: f"_own_{i}_" for i, c in enumerate(docs.columns) if c.lower() in reserved}
    return run(docs.withColumnsRenamed(away)).withColumnsRenamed({v: k for k, v in away.items()})


def running_start(totals: DataFrame, part: str, total: str) -> DataFrame:
    """Per part the sum of ``total`` over all earlier parts: ``(part, base)``.

    One row per input partition comes in, so the single ordered window stays small. It is staged,
    so the join that follows knows its size and broadcasts it only below the engine's own limit.
    """
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return stage(totals.select(part, F.coalesce(F.sum(total).over(before), F.lit(0)).alias("base")), "offsets")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add gapless numbers from 0 in the order of ``order``, without gathering the rows in one task.

    Rows are range-partitioned and sorted once and written with their place in the partition; the
    partition sizes then give every partition its first number.
    """
    spot = F.monotonically_increasing_id()
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_spot", spot)
        .withColumn("_part", F.shiftright("_spot", 33))
        .withColumn("_at", F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))).drop("_spot"), "numbered")
    base = running_start(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n")
    return (placed.join(base, "_part").withColumn(name, F.col("base") + F.col("_at"))
            .drop("_part", "_at", "base"))


def smallest_hashes(keys: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows of ``keys`` (all different) whose ``key`` has the smallest hashes.

    A bound on the hash leaves about ``n`` rows in all before they are sorted, so what the driver gets does not grow
    with the partitions.
    """
    total, share = keys.count(), 1.2
    order = [F.xxhash64(key), F.col(key)]
    while total > 4 * n and share * n < total:
        bound = int((1 << 62) * (share * n + 100) / total) * 2
        near = keys.where(F.pmod(F.xxhash64(key), F.lit((1 << 63) - 1)) < F.lit(min(bound, (1 << 63) - 1)))
        if near.count() >= n:
            return near.orderBy(F.pmod(order[0], F.lit((1 << 63) - 1)), order[1]).limit(n)
        share *= 2
    return keys.orderBy(F.pmod(order[0], F.lit((1 << 63) - 1)), order[1]).limit(n)


def largest(rows: DataFrame, value: Column, n: int, then: str) -> DataFrame:
    """The ``n`` rows with the largest ``value``, ties by ``then``; all but about ``n`` are dropped before the sort."""
    total = rows.count()
    if total > 4 * n:
        share = min(1.0, 1.2 * n / total + 4e-4)
        cut = rows.agg(F.percentile_approx(value.cast("double"), F.lit(1 - share), F.lit(10_000)).alias("c")).first()["c"]
        near = rows.where(value.cast("double") >= F.lit(cut))
        rows = near if near.count() >= n else rows
    return rows.orderBy(value.desc(), then).limit(n)


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Smallest node of every connected component: ``(node, root)`` for the ends of ``edges (a, b)``.

    Every round takes the smallest root among the neighbours and then the root of the root, so long
    chains shrink by powers. Each round is staged; only the number of changed rows comes to the driver.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").distinct(), "edges")
    roots = stage(both.groupBy(F.col("a").alias("node"))
                  .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    for _ in range(rounds):
        near = (both.join(roots.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        lower = roots.join(near, "node").select("node", F.least("root", "m").alias("root"),
                                                F.col("root").alias("was"))
        top = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        after = stage(lower.join(top, "root", "left")
                      .select("node", F.least("root", F.coalesce("above", "root")).alias("root"), "was"), "roots")
        changed = after.where("root <> was").limit(1).count()
        discard(roots)
        roots = after
        if not changed:
            discard(both)
            return roots.select("node", "root")
    raise RuntimeError("components did not settle")


_stores: dict[str, Any] = {}


def own_store(name: str, make: Callable[[], Any]) -> Any:
    """What this Python worker keeps between tasks for operator ``name``.

    Workers outlive an operator; the store of one that ran before is dropped, so stores never add up.
    """
    if name not in _stores:
        _stores.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _stores[name] = make()
    return _stores[name]


class WordHashes(dict):
    """Word to 64-bit hash, the same in every process; computed once per distinct word."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value

    def of(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()


MIX = np.uint64(0x9E3779B97F4A7C15)  # odd constant of multiplicative hashing


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` words; a shorter text is one run of all its words."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * MIX + hashes[i:i + len(out)]
    out ^= out >> np.uint64(29)
    return out * MIX


#: What the byte-level tokenizer counts as white space.
SPACE = ("\t\n\x0b\x0c\r \x85\xa0            "
         "    　")
#: The tokenizer's own rule for cutting a text before merges; no merge crosses a cut.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(
    r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]").replace(f"[^[{SPACE}]", f"[^{SPACE}")


class _Pieces(dict):
    """Piece between two spaces to its ids; None for a piece that cannot be encoded by itself."""

    def __init__(self, owner: Encoder, lead: str) -> None:
        super().__init__()
        self.owner, self.lead, self.older = owner, lead, {}

    def turned(self) -> _Pieces:
        """This store, or when it is full an empty one that still knows its pieces."""
        if len(self) <= CACHE_PIECES:
            return self
        fresh = type(self)(self.owner, self.lead)
        fresh.older, self.older = self, {}
        return fresh

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.older.get(piece)
        if ids is not None:
            self[piece] = ids
            return ids
        word = piece.rstrip(".,!?;:")
        if word.isalpha():  # a word and its closing marks: two cuts, most pieces
            tail = piece[len(word):]
            ids = self[piece] = self[word] + self.owner.cuts[tail] if tail else self.owner.merged(self.lead + word)
            return ids
        body = piece[1:] if piece[:1] == "\n" else piece
        if not body or body[0] in SPACE or body[-1] in SPACE:
            return None
        ids = self.owner.ids(self.lead + piece if body is piece else piece)
        self[piece] = ids
        return ids


class _Cuts(_Pieces):
    """Cut to its ids."""

    def __missing__(self, cut: str) -> bytes:
        ids = self[cut] = self.older.get(cut) or self.owner.merged(cut)
        return ids


class Encoder:
    """Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library.

    The library cuts a text by :data:`CUT` and merges inside the cuts. A space between two other
    characters always starts a cut, so every distinct piece between spaces is encoded once and looked up
    afterwards. Texts with other white space runs are cut as a whole. Texts that hold the string of a special
    token of the file are left to the library, which gives such a string its own id.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(CUT)
        # The byte-level alphabet: a printable character for each of the 256 bytes.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.as_bytes = [np.array(i, self.dtype).tobytes() for i in range(tokenizer.get_vocab_size())]
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")
        self.cuts = _Cuts(self, "")

    def merged(self, cut: str) -> bytes:
        """Ids of one cut, from the library's merge table."""
        if cut.isascii() and cut.isprintable():  # of these only the space has another character in the alphabet
            mapped = cut.replace(" ", self.alphabet[32])
        else:
            mapped = cut.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.as_bytes[token.id] for token in self.model.tokenize(mapped)])

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.cuts.__getitem__, self.cut.findall(text)))

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``dtype``; NULL counts as empty."""
        return [self.encode_one(text or "") for text in texts]

    def encode_one(self, text: str) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        self.later, self.first, self.cuts = self.later.turned(), self.first.turned(), self.cuts.turned()
        pieces = text.replace("\n", " \n").split(" ")
        head = self.first[pieces[0]]
        try:
            return head + b"".join(map(self.later.__getitem__, pieces[1:]))
        except TypeError:  # a piece that only its neighbours can settle
            return self.ids(text)


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for ``path``."""
    return own_store(f"tokens:{path}", lambda: Encoder(path))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
