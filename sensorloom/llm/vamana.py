"""Approximate nearest neighbours over robust-pruned directed graphs, one per shard.

Vectors are dealt to shards of bounded size. In each shard a graph is built in batches: greedy searches from
the medoid propose neighbours, relaxed distance pruning keeps near and diverse edges, and reverse edges are
pruned the same way. A query searches every shard's graph with a beam; the shards' best are merged by the
exact cosine in double precision. The graph is one table row per shard, so the index is stored and shipped
like any other table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorloom.llm.common import stage

SHARD, SMALL = 50_000, 4_000  # different vectors per shard: at most about, and at least if there are tasks to spare
DEGREE, BEAM, RELAX = 32, 64, 1.2
WIDE = 160  # beam of a query
ROUND = 256  # vectors inserted, or queries searched, at once
INDEX = "dim int, shard int, n int, start int, vectors binary, graph binary, ids binary, node binary"


def valid(table: DataFrame) -> DataFrame:
    """Rows that take part: ``vec_id, v`` with ``v`` finite, not NULL and not zero."""
    v = F.col("embedding").cast("array<double>")
    good = (F.coalesce(F.size(v), F.lit(0)) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return table.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(F.coalesce(good, F.lit(False)))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``v, ids``: each different direction once with its ``k + 1`` smallest ids, which is all that a result can hold.

    A direction is the vector over its largest component, so copies scaled by a power of two are one: all their
    cosines are equal. The rank is cut before the shuffle, so a direction with a third of all rows moves few of them.
    """
    top = F.array_max(F.transform("v", F.abs))
    scaled = rows.withColumn("top", top).withColumn("v", F.transform("v", lambda x: x / F.col("top") + 0.0))
    rank = F.row_number().over(W.partitionBy("key", "v").orderBy("vec_id"))
    return (scaled.withColumn("key", F.xxhash64("v")).withColumn("r", rank).where(F.col("r") <= k + 1)
            .groupBy("key", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))


class Graph:
    """Directed graph over unit vectors; the rows of ``edges`` end with -1 where a vector has fewer edges."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, start: int) -> None:
        self.vectors, self.edges, self.start = vectors, edges, start

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX) -> Graph:
        n = len(vectors)
        middle = vectors.mean(0)
        graph = cls(vectors, np.full((n, degree), -1, np.int32), int(np.argmax(vectors @ middle)))
        order = np.random.default_rng(5).permutation(n)
        # Two passes, as the first vectors met a graph of few; batches grow with the graph.
        for factor in (1.0, relax):
            at = 0
            while at < n:
                batch = order[at:at + max(1, min(ROUND, at if factor == 1.0 else ROUND))]
                graph._insert(batch, beam, factor)
                at += len(batch)
        return graph

    def _insert(self, batch: np.ndarray, beam: int, relax: float) -> None:
        near, _ = self.search(self.vectors[batch], beam)
        for row, found in zip(batch.tolist(), near, strict=True):
            pool = np.union1d(found[found >= 0], self.edges[row][self.edges[row] >= 0])
            self._set(row, self._prune(row, pool[pool != row], relax))
        # Reverse edges, target by target.
        source = np.repeat(batch, self.edges.shape[1])
        target = self.edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        for rows in np.split(np.arange(len(target)), np.flatnonzero(np.diff(target)) + 1):
            if len(rows):
                row = int(target[rows[0]])
                own = self.edges[row][self.edges[row] >= 0]
                pool = np.union1d(own, source[rows])
                pool = pool[pool != row]
                self._set(row, pool if len(pool) <= self.edges.shape[1] else self._prune(row, pool, relax))

    def _set(self, row: int, targets: np.ndarray) -> None:
        self.edges[row] = -1
        self.edges[row, :len(targets)] = targets

    def _prune(self, row: int, pool: np.ndarray, relax: float) -> np.ndarray:
        """Nearest first; a candidate goes if a kept one is nearer to it, relaxed, than the vector itself."""
        if not len(pool):
            return pool
        far = 1 - self.vectors[pool] @ self.vectors[row]
        pool = pool[np.argsort(far, kind="stable")]
        far = np.sort(far, kind="stable")
        between = 1 - self.vectors[pool] @ self.vectors[pool].T
        alive, kept = np.ones(len(pool), bool), []
        for i in range(len(pool)):
            if alive[i]:
                kept.append(pool[i])
                if len(kept) == self.edges.shape[1]:
                    break
                alive &= relax * between[i] > far
        return np.array(kept, np.int32)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all ``queries`` side by side: nearest vectors first, -1 where none, and their cosines."""
        n, q = len(self.vectors), len(queries)
        beam = min(beam, n)
        ids = np.full((q, beam), -1, np.int32)
        score = np.full((q, beam), -np.inf, np.float32)
        ids[:, 0], score[:, 0] = self.start, queries @ self.vectors[self.start]
        seen = np.zeros((q, n), bool)
        seen[:, self.start] = True
        open_ = np.zeros((q, beam), bool)
        open_[:, 0] = True
        active = np.arange(q)
        while len(active):
            best = np.argmax(np.where(open_[active], score[active], -np.inf), axis=1)
            open_[active, best] = False
            out = self.edges[ids[active, best]]
            fresh = (out >= 0) & ~seen[active[:, None], np.maximum(out, 0)]
            row, col = np.nonzero(fresh)
            target = out[row, col]
            seen[active[row], target] = True
            new = np.full(out.shape, -np.inf, np.float32)
            new[row, col] = np.einsum("ij,ij->i", self.vectors[target], queries[active[row]])
            every = np.concatenate([score[active], new], axis=1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            score[active] = np.take_along_axis(every, order, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], out], axis=1), order, 1)
            open_[active] = np.take_along_axis(np.concatenate([open_[active], fresh], axis=1), order, 1)
            active = active[(open_[active] & np.isfinite(score[active])).any(1)]
        return np.where(np.isfinite(score), ids, -1), score


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    """Vectors of length one as the graph sees them; safe for very large and very small numbers."""
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def build_index(rows: DataFrame, k: int = 5) -> DataFrame:
    """One row per shard with its vectors, graph and ids; vectors of a shard have one length.

    Vectors that the graph cannot tell apart are one node of it, so none hides the others; ``node`` says which.
    """
    unique = stage(distinct_vectors(rows, k), "vectors")
    n = unique.count()
    shards = max(1, -(-n // SHARD), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // SMALL)))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", kind="stable")
        raw = np.stack(frame["v"].to_numpy()).astype(np.float64)
        unit, node = np.unique(unit_vectors(raw), axis=0, return_inverse=True)
        order = np.argsort(node.ravel(), kind="stable")
        graph = Graph.build(unit)
        ids = np.zeros((len(raw), k + 2), np.int64)
        for i, own in enumerate(frame["ids"]):
            ids[i, 0], ids[i, 1:len(own) + 1] = len(own), own
        return pd.DataFrame({"dim": [raw.shape[1]], "shard": [frame["shard"].iloc[0]], "n": [len(raw)], "start": [graph.start],
                             "vectors": [raw[order].tobytes()], "graph": [graph.edges.tobytes()],
                             "ids": [ids[order].tobytes()], "node": [node.ravel()[order].astype(np.int64).tobytes()]})

    dealt = unique.select("key", "v", "ids", F.size("v").alias("dim"), F.pmod("key", F.lit(shards)).cast("int").alias("shard"))
    return stage(dealt.repartition(shards, "dim", "shard").groupBy("dim", "shard").applyInPandas(build, INDEX), "index")


class ShardSearch:
    """One shard's graph, its vectors sorted by node, and the nearest of them to some queries."""

    def __init__(self, n: int, dim: int, start: int, vectors: bytes, graph: bytes, ids: bytes, node: bytes) -> None:
        self.vectors = np.frombuffer(vectors).reshape(n, dim)
        listed = np.frombuffer(ids, np.int64).reshape(n, -1)
        self.ids = listed[:, 1:]  # as many as the first column says
        self.held = np.arange(self.ids.shape[1]) < listed[:, :1]
        node_of = np.frombuffer(node, np.int64)
        self.first = np.searchsorted(node_of, np.arange(node_of[-1] + 2))
        unit = unit_vectors(self.vectors[self.first[:-1]])
        self.graph = Graph(unit, np.frombuffer(graph, np.int32).reshape(len(unit), -1), start)

    def nearest(self, asked: np.ndarray, own: np.ndarray, k: int, beam: int) -> list[tuple[int, int, float]]:
        """``(query, vec_id, score)``: all vectors of the found nodes compete by exact cosine, then id."""
        found, _ = self.graph.search(unit_vectors(asked), max(beam, 4 * k))
        out = []
        for i, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            size = self.first[nodes + 1] - self.first[nodes]
            rows = np.repeat(self.first[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
            ids = self.ids[rows]
            score = np.repeat(cosine(asked[i], self.vectors[rows]), ids.shape[1])
            ids = ids.ravel()
            good = self.held[rows].ravel() & (ids != own[i])
            ids, score = ids[good], score[good]
            best = np.lexsort((ids, -score))[:k]
            out += [(int(own[i]), int(v), float(s)) for v, s in zip(ids[best], score[best], strict=True)]
        return out


def search_index(index: DataFrame, queries: DataFrame, k: int = 5, beam: int = WIDE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query ``(vec_id, v)`` but itself.

    Every shard of a length meets all its queries: its row comes first in the task's stream, then the queries,
    a block at a time, so a task holds one shard and one block.
    """
    last = index.select(F.max("shard")).first()[0] or 0
    no = F.lit(None)
    shards = index.select("dim", "shard", F.lit(0).alias("kind"), no.cast("bigint").alias("vec_id"), no.cast("array<double>").alias("v"),
                          F.struct("n", "dim", "start", "vectors", "graph", "ids", "node").alias("held"))
    spread = queries.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("shard"), F.lit(1).alias("kind"),
                            "vec_id", "v", no.cast(shards.schema["held"].dataType).alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, asked = None, None, []

        def answer() -> pa.RecordBatch:
            found = shard.nearest(np.array([v for _, v in asked], np.float64), np.array([i for i, _ in asked], np.int64), k, beam) \
                if shard else []
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

        for batch in batches:
            for dim, number, kind, vec_id, v, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if asked and ((dim, number) != key or len(asked) == ROUND):
                    yield answer()
                    asked = []
                if (dim, number) != key:
                    key, shard = (dim, number), None
                if kind == 0:
                    shard = ShardSearch(**held)
                else:
                    asked.append((vec_id, v))
        if asked:
            yield answer()

    order = ["dim", "shard", "kind", "vec_id"]
    found = (shards.unionByName(spread).repartition(last + 1, "dim", "shard").sortWithinPartitions(*order)
             .mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosine(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of ``a`` with each row in double precision, safe for very large and very small numbers."""
    x, y = a / np.abs(a).max(), rows / np.abs(rows).max(1, keepdims=True)
    return (y * x).sum(1) / (np.sqrt((y * y).sum(1)) * np.sqrt((x * x).sum()))


def nearest(table: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows by cosine of every row whose vec_id is divisible by ``every``.

    Ties go to the smaller vec_id. Vectors that are NULL, zero, empty or hold NULL or non-finite numbers take
    no part, on either side; nor do rows without a vec_id. Vectors of different lengths never meet. Rows with
    the same vec_id and vector count once; other columns are ignored; no rows give no result.
    """
    rows = valid(table).where("vec_id is not null")
    index = build_index(rows, k)
    return search_index(index, rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct(), k)
