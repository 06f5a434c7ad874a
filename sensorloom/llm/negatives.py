"""Hard negatives by exact inner-product search over lists that clusters of anchors share.

Anchors are clustered by direction. In every shard of the rows a cluster sorts the candidates once by an upper
bound of their inner product with any member: with ``b`` the widest angle between a member and the centre, a
candidate at angle ``t`` from the centre scores at most its length times ``cos(max(0, t - b))`` times the member's
length. Each member walks that list in growing pieces and stops where the next bound is below what it still needs,
which certifies that nothing further down counts. Results are therefore exact; shards are merged by score.

The shard is one task's share of the rows; anchors, which are few, are sent to every shard and read in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, stage

SHARD, SMALL = 65_536, 4_096  # rows per shard: at most about, and at least if there are tasks to spare
SAMPLE, CLUSTERS = 4_096, 256  # anchors that place the centres, about; most centres
MEMBERS = 256  # anchors that walk a list at once
SLACK = 1e-7  # of a bound, for rounding in its cosine
ROWS = "row bigint, vec_id bigint, label bigint, v array<double>"


def whole_rows(table: DataFrame, label: str | Column = "label", factor: int = 256) -> DataFrame:
    """Rows that take part: ``row, vec_id, label, v`` with components ``floor(factor * x)``.

    Left out are rows with a NULL vec_id, label or vector, with a NULL or non-finite component, and those whose
    squared length does not fit a long, as their scores would not either. Rows equal in all three count once.
    """
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    square = F.reduce("v", F.lit(0.0), lambda total, c: total + c * c)
    return (table.where(x.isNotNull() & good)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                    F.transform(x, lambda c: F.floor(c * factor).cast("double")).alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (square < float(1 << 62)))
            .distinct().withColumn("row", F.monotonically_increasing_id()))


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def centres(vectors: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """``n`` directions at most, each the mean of the vectors nearest to it."""
    unit = _unit(np.unique(vectors, axis=0))
    unit = unit[np.abs(unit).sum(1) > 0]
    if not len(unit):
        return np.zeros((0, vectors.shape[1]))
    at = unit[np.random.default_rng(11).permutation(len(unit))[:n]]
    for _ in range(rounds):
        nearest = (unit @ at.T).argmax(1)
        total = np.zeros_like(at)
        np.add.at(total, nearest, unit)
        at = np.where(np.abs(total).sum(1, keepdims=True) > 0, _unit(total), at)
    return at


def cluster(anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Anchors with ``dim, cluster``, and the centres ``dim, cluster, v, spread`` (least cosine to a member).

    Centres are placed by a sample of about :data:`SAMPLE` anchors; every anchor then joins its nearest one. An anchor
    whose length has no centre, or that is zero, is in cluster -1, whose bounds are the lengths alone.
    """
    total = anchors.count()
    some = anchors.where(F.pmod(F.xxhash64("row", F.lit(11)), F.lit(max(1, total // SAMPLE))) == 0)
    n = int(min(CLUSTERS, max(1, round(total ** 0.5))))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        found = centres(np.stack(frame["v"].to_numpy()), n)
        return pd.DataFrame({"dim": [int(frame["dim"].iloc[0])], "n": [len(found)], "held": [found.astype("<f8").tobytes()]})

    placed = stage(some.select("v", F.size("v").alias("dim")).where("dim > 0").groupBy("dim")
                   .applyInPandas(place, "dim int, n int, held binary"), "centres")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, near = [], []
            for v, held in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                x = v.values.to_numpy()
                length = np.sqrt((x * x).sum())
                cosine = np.frombuffer(held).reshape(-1, len(x)) @ x / length if held and length > 0 else np.zeros(0)
                which.append(int(cosine.argmax()) if len(cosine) else -1)
                near.append(float(cosine.max()) if len(cosine) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], batch.column(0), pa.array(which, pa.int32()), pa.array(near, pa.float64())],
                                             [*batch.schema.names[2:], "v", "cluster", "near"])

    sized = anchors.withColumn("dim", F.size("v")).join(placed.select("dim", "held"), "dim", "left")
    told = stage(sized.select("v", "held", "row", "vec_id", "label", "dim").mapInArrow(
        assign, "row bigint, vec_id bigint, label bigint, dim int, v array<double>, cluster int, near double"), "anchors")

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = np.frombuffer(held).reshape(-1, dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()),
                     pa.array(rows.tolist(), pa.list_(pa.float64()))], ["dim", "cluster", "v"])

    widest = told.groupBy("dim", "cluster").agg(F.min("near").alias("spread"))
    listed = placed.select("dim", "held").mapInArrow(spread_out, "dim int, cluster int, v array<double>")
    return told.drop("near"), listed.join(widest, ["dim", "cluster"])


class Shard:
    """Rows of one shard, by vec_id, and the list of the cluster at hand."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.labels, self.vectors = rows[order], ids[order], labels[order], vectors[order]
        self.length = np.linalg.norm(self.vectors, axis=1)
        self.order, self.bound = np.arange(len(rows)), self.length

    def sort_for(self, centre: np.ndarray | None, spread: float) -> None:
        """Order the list by the bound for members within the angle whose cosine is ``spread`` of the centre."""
        most = np.ones(len(self.ids))
        if centre is not None:
            cosine = np.clip(np.divide(self.vectors @ centre, self.length, out=np.ones(len(most)), where=self.length > 0), -1, 1)
            spread = min(1.0, max(-1.0, spread))
            turned = cosine * spread + np.sqrt((1 - cosine ** 2) * (1 - spread ** 2))
            most = np.where(cosine >= spread, 1.0, turned)
        bound = self.length * (most + SLACK)
        self.order = np.argsort(-bound, kind="stable")  # rows of one bound stay in the order of their ids
        self.bound = bound[self.order]

    def walk(self, asked: np.ndarray, member: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
             allowed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``k`` best rows of every question: ``question, place of the row, score``.

        Question ``q`` is that of ``asked[member[q]]`` and takes scores in ``[low[q], high[q]]`` of rows that
        ``allowed(member, places)`` grants.
        """
        exact = max(self.length.max(initial=0), 1) * max(np.linalg.norm(asked, axis=1).max(initial=0), 1) < 1 << 52
        asked_as, vectors = (asked, self.vectors) if exact else (asked.astype(np.int64), self.vectors.astype(np.int64))
        reach = np.linalg.norm(asked, axis=1)[member]
        question, place, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        need, active, at, step = low.copy(), np.arange(len(member)), 0, 256
        while at < len(self.order):
            active = active[reach[active] * self.bound[at] >= need[active]]
            if not len(active):
                break
            piece = self.order[at:at + step]
            users, back = np.unique(member[active], return_inverse=True)
            found = (asked_as[users] @ vectors[piece].T).astype(np.int64)
            good = allowed(users, piece)[back] & (found[back] >= need[active, None]) & (found[back] <= high[active, None])
            q, p = np.nonzero(good)
            if len(q):
                question = np.concatenate([question, active[q]])
                score = np.concatenate([score, found[back[q], p]])
                place = np.concatenate([place, piece[p]])
                order = np.lexsort((place, -score, question))
                question, place, score = question[order], place[order], score[order]
                start = np.flatnonzero(np.concatenate([[True], question[1:] != question[:-1]]))
                rank = np.arange(len(question)) - np.repeat(start, np.diff(np.append(start, len(question))))
                # With k rows in hand only better ones count, or equal ones of a smaller id.
                full = rank == k - 1
                need[question[full]] = np.maximum(low[question[full]], score[full])
                question, place, score = question[rank < k], place[rank < k], score[rank < k]
            at, step = at + step, min(4096, step * 2)
        return question, place, score


def _search(rows: DataFrame, anchors: DataFrame, spots: DataFrame, shards: int, k: int, positives: bool) -> DataFrame:
    """``anchor, asked, row, vec_id, score``: per shard the ``k`` best rows of each anchor (and positive score ``asked``)."""
    kind = lambda n: F.lit(n).alias("kind")
    no, every = F.lit(None), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    wanted = no.cast("array<bigint>").alias("wanted") if positives else F.col("wanted")
    stream = (
        rows.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), kind(0),
                    no.cast("int").alias("cluster"), "row", "vec_id", "label", "v", no.cast("double").alias("spread"),
                    no.cast("array<bigint>").alias("wanted"))
        .unionByName(spots.select("dim", every, kind(1), "cluster", no.cast("bigint").alias("row"), no.cast("bigint").alias("vec_id"),
                                  no.cast("bigint").alias("label"), "v", "spread", no.cast("array<bigint>").alias("wanted")))
        .unionByName(anchors.select("dim", every, kind(2), "cluster", "row", "vec_id", "label", "v",
                                    no.cast("double").alias("spread"), wanted)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, spot, sorted_for = None, None, {}, None
        held: list[tuple] = []

        def settle() -> Shard:
            vectors = np.array([r[3] for r in held], float).reshape(len(held), key[0])
            return Shard(*(np.array([r[i] for r in held], np.int64) for i in range(3)), vectors)

        def answer(members: list[tuple]) -> pa.RecordBatch | None:
            nonlocal sorted_for
            which = members[0][0]
            if sorted_for != which:
                shard.sort_for(*spot.get(which, (None, 1.0)))
                sorted_for = which
            own, labels = (np.array([m[i] for m in members], np.int64) for i in (1, 2))
            asked = np.array([m[3] for m in members], float).reshape(len(members), key[0])
            if positives:
                member = np.arange(len(members))
                low, high = np.full(len(members), np.iinfo(np.int64).min), np.full(len(members), np.iinfo(np.int64).max)
                allowed = lambda users, piece: (labels[users, None] == shard.labels[piece]) & (own[users, None] != shard.rows[piece])
            else:
                member = np.repeat(np.arange(len(members)), [len(m[4]) for m in members])
                high = np.array([s for m in members for s in m[4]], np.int64)
                low = high - high // 5  # 80 * positive <= 100 * negative
                allowed = lambda users, piece: labels[users, None] != shard.labels[piece]
            question, place, score = shard.walk(asked, member, low, high, k, allowed)
            if not len(question):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(own[member[question]]), pa.array(high[question]), pa.array(shard.rows[place]), pa.array(shard.ids[place]),
                 pa.array(score)], ["anchor", "asked", "row", "vec_id", "score"])

        members: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                dim, number, what, which, own, vec_id, label, v, spread, scores = row
                if members and ((dim, number) != key or which != members[0][0] or len(members) == MEMBERS):
                    if (told := answer(members)) is not None:
                        yield told
                    members = []
                if (dim, number) != key:
                    key, shard, spot, sorted_for, held = (dim, number), None, {}, None, []
                if what == 0:
                    held.append((own, vec_id, label, v))
                elif what == 1:
                    spot[which] = (np.array(v, float), spread)
                else:
                    if shard is None:
                        shard, held = settle(), []
                    members.append((which, own, label, v, scores))
        if members and (told := answer(members)) is not None:
            yield told

    order = ["dim", "shard", "kind", "cluster", "row"]
    return (stream.repartition(shards, "dim", "shard").sortWithinPartitions(*order)
            .mapInArrow(run, "anchor bigint, asked bigint, row bigint, vec_id bigint, score bigint"))


def mine(rows: DataFrame, chosen: Column, k_positive: int = 5, k_negative: int = 5) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the ``chosen`` rows.

    ``rows`` come from :func:`whole_rows`. An anchor's positives are the best ``k_positive`` other rows of its
    label; its negatives for a positive are the best ``k_negative`` rows of other labels that score at least 80 % of
    the positive and no more than it. Ties go to the smaller vec_id. Vectors of different lengths never meet;
    a zero or empty vector scores 0. A positive below 0 has no negatives. Many equal vectors are equally near and are
    all looked at; a label may hold any share of the rows, as shards do not depend on it. An anchor without other
    rows of its label, and an empty table, give no rows. Columns of the table other than vec_id, the label and
    embedding are not read.
    """
    rows = stage(rows, "rows")
    spark = rows.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    n = rows.count()
    shards = max(1, -(-n // SHARD), min(tasks, -(-n // SMALL)))
    anchors, spots = cluster(rows.where(chosen))
    spots = stage(spots, "spots")
    best = W.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id", "row")
    positives = stage(_search(rows, anchors, spots, shards, k_positive, True).withColumn("r", F.row_number().over(best))
                      .where(F.col("r") <= k_positive).select("anchor", "vec_id", "row", "score"), "positives")
    wanted = positives.where("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("wanted"))
    asking = anchors.join(wanted.withColumnRenamed("anchor", "row"), "row")
    each = W.partitionBy("anchor", "asked").orderBy(F.col("score").desc(), "vec_id", "row")
    negatives = (_search(rows, asking, spots, shards, k_negative, False).withColumn("rank", F.row_number().over(each))
                 .where(F.col("rank") <= k_negative)
                 .select("anchor", F.col("asked").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                         F.col("score").alias("negative_score")))
    named = positives.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = stage(negatives.join(named, ["anchor", "positive_score"])
                .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
                .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    for used in (rows, anchors, spots, positives):
        discard(used)
    return out
