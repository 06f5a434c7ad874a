"""Near copies, repeated passages and shards against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from sensorloom.llm import forest, repeats, shards
from tests.llm.conftest import SCHEMA, document_rows, sentences, words


def brute_links(rows):
    sets = [frozenset(forest.ngrams(r[1]).tolist()) for r in rows]
    links, group = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                group = [group[j] if g == group[i] else g for g in group]
    return links, group


def test_forest_matches_brute_force(spark):
    rng = random.Random(9)
    rows = document_rows()
    stem = sentences(rng, 120).split()
    for i in range(60):  # a group of near copies on both sides of the threshold
        text = list(stem)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = "x%d" % i
        rows.append((1000 + i, " ".join(text), "en", "s", 1))
    got = forest.classes(spark.createDataFrame(rows, SCHEMA)).collect()
    links, group = brute_links(rows)
    assert Counter((r.doc_id, r.n_links) for r in got) == Counter((r[0], n) for r, n in zip(rows, links, strict=True))
    smallest = defaultdict(lambda: None)
    for g, r in zip(group, rows, strict=True):
        if r[0] is not None:
            smallest[g] = r[0] if smallest[g] is None else min(smallest[g], r[0])
    want = Counter((r[0], smallest[g]) for g, r in zip(group, rows, strict=True) if forest.ngrams(r[1]).size)
    assert Counter((r.doc_id, r.class_id) for r in got if r.class_no is not None) == want


def test_blocks_split_a_large_group(spark, monkeypatch):
    """The same links however many blocks a group has, and no row per pair."""
    rng = random.Random(4)
    stem = words(rng, 60)
    members = [(i, 0, 1, " ".join([*stem, f"end{i}"])) for i in range(40)]
    whole, _, _ = forest.compare(members, True, 4, None, 0.8)
    assert {n for _, n, _ in whole} == {39} and len(whole) == 40
    half = [(i, i % 2, 1, t) for i, _, _, t in members]
    across, edges, _ = forest.compare(half, False, 4, None, 0.8)
    assert {n for _, n, _ in across} == {20} and len(edges) == 39


def test_links_between_blocks_join_classes_only(spark):
    rng = random.Random(4)
    stem = words(rng, 60)
    half = [(i, i % 2, 1, " ".join([*stem, f"end{i}"]), i % 2) for i in range(40)]
    across, edges, _ = forest.compare(half, False, 4, None, 0.8)
    assert {n for _, n, _ in across} == {20} and [(a, b) for a, b, _ in edges] == [(0, 1)]


def test_groups_over_several_blocks_match_brute_force(spark):
    """Over 600 differing near copies, dealt over three blocks: drifting texts, so many are linked by others only."""
    rng = random.Random(13)
    rows = []
    for family in range(2):
        text = words(rng, 90)
        for i in range(320):
            if i % 40 == 0:
                text = list(text)
                text[rng.randrange(len(text))] = f"drift{family}x{i}"
            own = list(text)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = f"y{family}x{i}"
            rows.append((family * 1000 + i, " ".join(own), "en", "s", 1))
    rows += rows[:30]  # copies count one by one
    links, group = brute_links(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = forest.classes(docs).collect()
    missed = sum(links) - sum(r.n_links for r in got)
    assert 0 <= missed <= 2 * 0.0005 * sum(links)  # the promised recall, pair by pair
    by_class = defaultdict(set)
    for g, r in zip(group, rows, strict=True):
        by_class[g].add(r[0])
    told = defaultdict(set)
    for r in got:
        told[r.class_no].add(r.doc_id)
    assert sorted(map(sorted, told.values())) == sorted(map(sorted, by_class.values()))
    assert all(r.class_id == min(told[r.class_no]) for r in got)


def test_keep_one_keeps_a_row_of_each_class(spark, odd):
    kept = forest.keep_one(odd)
    assert kept.columns == odd.columns
    rows, found = kept.collect(), forest.classes(odd).collect()
    classes = {r.class_no for r in found if r.class_no is not None}
    blank = {(r.doc_id, r.h) for r in found if r.class_no is None}
    assert len(rows) == len(classes) + len(blank)


def test_forest_without_pairs(spark, none):
    assert forest.classes(none).collect() == []
    assert forest.keep_one(none).collect() == []


def test_recall_estimate():
    assert forest.found_share({}, 8) < 0.95 < 0.999 < forest.found_share({99: 1000}, 8)
    assert forest.found_share({}, 4) >= 0.999


def test_forest_finds_far_pairs_beside_a_large_group(spark):
    """Pairs at the threshold that meet at no long path, with 4,950 pairs of very similar texts beside them."""
    rng = random.Random(21)
    stem, rows, far = words(rng, 600), [], 0
    for i in range(100):
        rows.append((i, " ".join([*stem, f"end{i}"]), "en", "s", 1))
    while far < 3:
        text = words(rng, 120)
        other = [*text[:107], *words(rng, 12)]
        a, b = (forest.ngrams(" ".join(t)) for t in (text, other))
        x, y = (forest.signature(g).reshape(forest.TREES, forest.DEPTH) for g in (a, b))
        alike = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        if alike >= 0.8 and not (x == y).all(1).any() and (x[:, :4] == y[:, :4]).all(1).any():
            rows += [(1000 + 2 * far, " ".join(text), "en", "s", 1), (1001 + 2 * far, " ".join(other), "en", "s", 1)]
            far += 1
    got = forest.classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.n_links for r in got} == {r[0]: 99 if r[0] < 1000 else 1 for r in rows}


def test_search_depth_holds_at_the_threshold():
    for threshold in (0.5, 0.8, 0.95):
        depth = forest.search_depth(threshold, 0.999)
        assert 1 - (1 - threshold ** depth) ** forest.TREES >= 0.999
    assert forest.search_depth(0.8, 0.999) == 4


def brute_repeats(rows):
    """Spans by one pass over all units in rank order."""
    seen, out = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        run, spans = [], []
        for unit in [*repeats.units(rows[i][1] or ""), None]:
            if unit is not None and (key := tuple(unit[2])) in seen:
                run.append(unit)
                continue
            if sum(len(u[2]) for u in run) >= repeats.RUN_WORDS:
                spans.append((run[0][0], run[-1][1]))
            run = []
            if unit is not None:
                seen[key] = i
        if spans:
            out[i] = spans
    return out


def test_repeats_match_brute_force(spark):
    rng = random.Random(5)
    rows = document_rows()
    passage = sentences(rng, 60)
    for i in range(6):
        rows.append((2000 + i, sentences(rng, 40) + " " + passage + "\n" + sentences(rng, 30), "en", "s", 1))
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = repeats.find_repeats(repeats._rows(docs)).collect()
    assert {r.row: [(s.start, s.stop) for s in r.spans] for r in got} == brute_repeats(rows)
    assert {r.doc_id for r in got} >= {2001, 2002, 2003, 2004, 2005} and 2000 not in {r.doc_id for r in got}
    text = dict((r[0], r[1]) for r in rows)
    clean = {r.doc_id: r.text for r in repeats.clean(docs).collect() if r.doc_id is not None and r.doc_id >= 2000}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 2000:
            left, at = "", 0
            for s in r.spans:
                left, at = left + text[r.doc_id][at:s.start], s.stop
            assert clean[r.doc_id] == left + text[r.doc_id][at:]


def test_repeats_remove_short_lines_and_cut_passages(spark):
    """Whole lines from five words on; of a passage that starts inside a sentence all but that sentence."""
    rng = random.Random(14)
    line, two, short = "the same short line again", "one two three four five. six seven eight nine ten.", "only four words here"
    a, b = (" ".join(words(rng, n)) + "." for n in (30, 22))
    texts = ["\n".join([sentences(rng, 20), line, sentences(rng, 20), two, sentences(rng, 20), short, f"begin {i} {a} {b} {sentences(rng, 20)}"])
             for i in range(4)]
    # The sentences of ``two`` alone, inside other lines, have too few words.
    texts += [f"{sentences(rng, 12)} one two three four five. {sentences(rng, 12)}"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = {r.doc_id: [texts[r.doc_id][s.start:s.stop].strip() for s in r.spans]
           for r in repeats.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: [line, two, b] for i in (1, 2, 3)}


def test_repeats_edge_cases(none, odd):
    assert repeats.report(none).collect() == []
    assert repeats.clean(odd).columns == odd.columns
    assert repeats.clean(odd).count() == odd.count()


def test_shards(spark, odd, none):
    rows = shards.assign(odd, shards=7).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == Counter(
        (r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 16) for r in document_rows())
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert shards.assign(none, shards=7).collect() == []


def test_shards_keep_copies_together_and_split_a_large_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"alone {i}", "", "", 0) for i in range(900)]
    got = shards.assign(spark.createDataFrame(rows, SCHEMA), shards=9).collect()
    text, where = dict((r[0], r[1]) for r in rows), defaultdict(set)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
    assert len(where["hot"]) <= 5  # 300 rows need three shards of 100
    cut = sum(len(v) > 1 for k, v in where.items() if k != "hot")
    assert cut <= 0.15 * len(where)
    assert np.ptp(list(Counter(r.shard for r in got).values())) <= 1
