"""n-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts become sets of word n-grams; equal sets share one representative. A representative's signature has
``TREES`` prefixes of ``DEPTH`` values, each the path to a leaf of a sorted prefix trie. Representatives that
share a path down to some depth are candidates; the depth is the longest at which a pair just at the threshold
is found with the target probability, whatever other pairs the table has. The shortening of prefixes is thus worked
out in advance: shortening while found pairs fall short of the recall lets many very similar pairs speak for the few
at the threshold. Candidates are verified on the exact sets, in blocks, so a large group of near copies costs
comparisons but never one row per pair: blocks are first compared with themselves and contracted to their classes,
and two blocks then name only links between classes that are still apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import MIX, WordHashes, components, discard, own_store, shielded, shingles, stage

N, THRESHOLD, RECALL = 5, 0.8, 0.999
TREES, DEPTH = 16, 8
BLOCK = 256  # members of a group compared at once
_rng = np.random.default_rng(41)
_FACTOR = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def ngrams(text: str | None) -> np.ndarray:
    """Sorted different hashes of the text's word n-grams, in lower case."""
    store = own_store("forest", WordHashes)
    store.trim()
    return np.unique(shingles(store.of((text or "").lower().split()), N))


def signature(grams: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` minimal hash values of a set that is not empty."""
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 2048):
        np.minimum(low, (grams[at:at + 2048, None] * _FACTOR + _SHIFT).min(0), out=low)
    return ((low * MIX) >> np.uint64(32)).astype("<u4")


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id, h`` (hash of the text), ``hi, lo`` (digest of the set, NULL without words), ``sig`` per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, sig = [], [], []
            for text in batch.column(2).to_pylist():
                grams = ngrams(text)
                digest = xxhash.xxh3_128_intdigest(grams.tobytes())
                hi.append((digest >> 64) - (1 << 63) if len(grams) else None)
                lo.append((digest & (1 << 64) - 1) - (1 << 63) if len(grams) else None)
                sig.append(signature(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(sig, pa.binary())], ["doc_id", "h", "hi", "lo", "sig"])

    return _keyed(docs).select("doc_id", "h", "text").mapInArrow(run, "doc_id bigint, h bigint, hi bigint, lo bigint, sig binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def _path(tree: Column, depth: int) -> Column:
    return F.xxhash64(tree, F.substring(F.col("sig"), tree * (4 * DEPTH) + 1, F.lit(4 * depth)))


def candidate_groups(reps: DataFrame, depth: int) -> DataFrame:
    """Groups of representatives linked by shared paths: ``rep, root``."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    paths = reps.select("rep", F.explode(F.transform(trees, lambda t: _path(t, depth))).alias("path"))
    heads = paths.groupBy("path").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = paths.join(heads.select("path", "head"), "path").where("rep <> head")
    return components(edges.select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()) \
        .select(F.col("node").alias("rep"), "root")


def _dealt(groups: DataFrame) -> DataFrame:
    """``rep, root, blocks, block``: the members of every group in blocks of about :data:`BLOCK`."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n")) \
        .select("root", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    return groups.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))


def _pairs(members: DataFrame) -> DataFrame:
    """``i, j``: every member once for each other block of its group."""
    others = F.expr("filter(sequence(0, blocks - 1), b -> b <> block)")
    return (members.where("blocks > 1").withColumn("other", F.explode(others))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))


def _meet(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Which rows of ``a`` share a path of ``depth`` with which rows of ``b``; ``(rows, TREES, DEPTH)`` each."""
    out = np.zeros((len(a), len(b)), bool)
    for tree in range(TREES):
        x, y = (np.ascontiguousarray(s[:, tree, :depth]).view(f"V{4 * depth}")[:, 0] for s in (a, b))
        _, number = np.unique(np.concatenate([x, y]), return_inverse=True)
        out |= number[:len(x), None] == number[None, len(x):]
    return out


def _shared(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets."""
    used = np.unique(pairs)
    if len(pairs) > 500:  # many pairs over few n-grams: a product of incidence matrices
        all_grams, column = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
        if len(used) * len(all_grams) <= 30_000_000:
            held = np.zeros((len(used), len(all_grams)), np.float32)
            held[np.repeat(np.arange(len(used)), [len(sets[i]) for i in used]), column] = 1
            product = held @ held.T
            at = np.searchsorted(used, pairs)
            return product[at[:, 0], at[:, 1]].astype(np.int64)
    return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs], np.int64)


def compare(members: list[tuple], same_block: bool, depth: int, done: int | None,
            threshold: float) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], np.ndarray]:
    """Verified links of a pair of blocks: ``(rep, links, 0)``, spanning edges ``(a, b, 0)`` and similarities.

    ``members``: ``rep, block, copies, text`` and, if some are known to be linked already, the class so far, which
    edges then name instead of members. Only pairs that meet at ``depth`` and not at the deeper
    ``done`` are looked at, so every pair is counted in one step only.
    """
    sets = [ngrams(m[3]) for m in members]
    sig = np.stack([signature(s) for s in sets]).reshape(len(members), TREES, DEPTH)
    block = np.array([m[1] for m in members])
    meet = _meet(sig, sig, depth)
    if done:
        meet &= ~_meet(sig, sig, done)
    meet &= np.triu(np.ones(meet.shape, bool), 1)
    if not same_block:
        meet &= block[:, None] != block[None, :]
    size = np.array([len(s) for s in sets])
    meet &= np.minimum.outer(size, size) >= threshold * np.maximum.outer(size, size) - 1e-9
    pairs = np.argwhere(meet)
    if not len(pairs):
        return [], [], np.zeros(0)
    shared = _shared(sets, pairs)
    alike = shared / (size[pairs[:, 0]] + size[pairs[:, 1]] - shared)
    good = alike >= threshold - 1e-12
    pairs, alike = pairs[good], alike[good]
    rep, copies = np.array([m[0] for m in members]), np.array([m[2] for m in members])
    links = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(members)) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(members))
    known = [m[4] if len(m) > 4 else m[0] for m in members]
    first: dict[int, int] = {}
    root = [first.setdefault(k, i) for i, k in enumerate(known)]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for a, b in pairs.tolist():
        if (x := find(a)) != (y := find(b)):
            root[max(x, y)] = min(x, y)
            edges.append((int(known[a]), int(known[b]), 0))
    held = np.flatnonzero(links)
    return list(zip(rep[held].tolist(), links[held].astype(int).tolist(), [0] * len(held), strict=True)), edges, alike


def verify(blocks: DataFrame, depth: int, done: int | None, threshold: float) -> DataFrame:
    """``kind, a, b``: links of a representative (0), spanning edges (1), pairs per similarity in percent (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (_, i, j), group in groupby(rows, key=lambda r: r[:3]):
            members = {r[3]: r[3:] for r in group}  # a text may stand in several equal rows
            if len(members) < 2:
                continue
            links, edges, alike = compare(list(members.values()), i == j, depth, done, threshold)
            out = [(0, a, b) for a, b, _ in links] + [(1, a, b) for a, b, _ in edges]
            percent, n = np.unique(np.floor(alike * 100 + 1e-9).astype(int), return_counts=True)
            out += [(2, p, c) for p, c in zip(percent.tolist(), n.tolist(), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                    zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["kind", "a", "b"])

    key = ["root", "i", "j"]
    return (blocks.select(*key, "rep", "block", "copies", "text", "known").repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "kind int, a bigint, b bigint"))


def found_share(histogram: dict[int, int], depth: int) -> float:
    """Estimated recall: found pairs over the number they stand for at this depth.

    A figure over all pairs, in which many very similar ones outweigh the rest; no depth is chosen by it.
    """
    missed = lambda s: (1 - (s / 100) ** depth) ** TREES
    return sum(histogram.values()) / max(1e-9, sum(n / (1 - missed(max(s, 1))) for s, n in histogram.items())) \
        if histogram else 1 - missed(100 * THRESHOLD)


def search_depth(threshold: float, recall: float) -> int:
    """The longest depth at which a pair at ``threshold`` is found with probability ``recall``; 1 if none is.

    At 0.8 and 0.999 it is 4, where such a pair is missed once in 4,000.
    """
    return next((d for d in range(DEPTH, 1, -1) if 1 - (1 - threshold ** d) ** TREES >= recall), 1)


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id, h, class_no, class_id, n_links``: one row per document.

    ``class_no`` tells classes apart even where doc_ids repeat; it is NULL for texts without words.
    ``class_id`` is the smallest doc_id reachable by links, ``n_links`` the number of other documents whose
    n-gram sets have a Jaccard similarity of ``threshold`` or more; copies count one by one and are linked.
    A text with fewer than five words is one n-gram of all its words. NULL, empty and blank texts have no
    links and are their own class; so is everything in a table without pairs. NULL doc_ids are never a
    class_id if the class has another one; repeated rows are copies; other columns are ignored.
    """
    return _classes(docs, threshold, recall)[0]


def _classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, list[DataFrame]]:
    """The classes, and the tables that they are read from."""
    signed = stage(sign(docs), "signed")
    reps = stage(signed.where("hi is not null").groupBy("hi", "lo").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h")).alias("first"),
        F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"))
        .select("hi", "lo", "first.doc_id", "first.h", "copies", "sig")
        .withColumn("rep", F.monotonically_increasing_id()), "reps")
    texts = _keyed(docs).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "text")
    depth = search_depth(threshold, recall)
    groups = stage(candidate_groups(reps, depth), "groups")
    named = _dealt(groups).join(reps.select("rep", "copies", "doc_id", "h"), "rep")
    found = texts.join(named.hint("shuffle_hash"), F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h")))
    members = stage(found.select("rep", "root", "blocks", "block", "copies", "text"), "members")
    discard(groups)
    same = members.withColumn("i", F.col("block")).withColumn("j", F.col("block")).withColumn("known", F.col("rep"))
    links = stage(verify(same, depth, None, threshold), "links")
    roots = components(links.where("kind = 1").select("a", "b"))
    if members.where("blocks > 1").limit(1).count():
        # Classes inside the blocks are known now; edges between blocks join classes, not members.
        contracted = _pairs(members).join(roots.withColumnRenamed("node", "rep").withColumnRenamed("root", "class"), "rep", "left") \
            .withColumn("known", F.coalesce("class", "rep"))
        across = stage(verify(contracted, depth, None, threshold), "links")
        tops = components(across.where("kind = 1").select("a", "b"))
        joined = roots.withColumnRenamed("root", "class").join(
            tops.select(F.col("node").alias("class"), "root"), "class", "full") \
            .select(F.coalesce("node", "class").alias("node"), F.coalesce("root", "class").alias("root"))
        links, roots = links.unionByName(across), joined
    discard(members)
    counts = links.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    told = (reps.select("rep", "hi", "lo", "doc_id", "copies").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .join(counts, "rep", "left").withColumn("root", F.coalesce("root", "rep")))
    named = told.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    told = told.join(named, "root").select(
        "hi", "lo", F.col("root").alias("class_no"), F.col("class_id").alias("_class"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("_links"))
    out = signed.join(told, ["hi", "lo"], "left").select(
        "doc_id", "h", "class_no", F.coalesce("_class", "doc_id").alias("class_id"),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"))
    return out, [signed, reps, links]


def keep_one(docs: DataFrame) -> DataFrame:
    """The first document of every class, by doc_id and then by the hash of the text; NULL doc_ids come last.

    Documents without words have no near copies and all stay; of rows with equal doc_id and text one stays.
    """
    told, tables = _classes(docs)
    found = stage(told, "classes")
    for used in tables:
        discard(used)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h")).alias("first")
    chosen = (found.where("class_no is not null").groupBy("class_no").agg(first).select("first.doc_id", "first.h")
              .unionByName(found.where("class_no is null").select("doc_id", "h").distinct())
              .select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")))
    return shielded(docs, ("_key", "_d", "_h"), lambda docs: _chosen_rows(docs, found, chosen))


def _chosen_rows(docs: DataFrame, found: DataFrame, chosen: DataFrame) -> DataFrame:
    keyed = docs.withColumn("_key", F.xxhash64(F.col("text").cast("string")))
    left = keyed.join(chosen.hint("shuffle_hash"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("_d"))
                      & (F.col("_key") == F.col("_h")), "left_semi")
    # Equal rows are equally first; only one of them stays.
    repeated = found.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    return (left.dropDuplicates(["doc_id", "_key"]) if repeated else left).select(*docs.columns)
