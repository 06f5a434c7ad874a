"""The pipeline against its stages' brute force, and on odd and empty tables."""

from __future__ import annotations

import random
import re

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from sensorloom.llm import forest, secrets
from sensorloom.llm.common import vocabulary_path
from tests.llm.conftest import SCHEMA, document_rows, sentences


def write(spark, tmp_path, docs, labels, items):
    for name, rows, ddl in (("documents", docs, SCHEMA), ("labels", labels, "doc_id bigint, quality int, toxic int"),
                            ("benchmark", items, "item_id bigint, text string")):
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(12)
    docs, labels, items = [], [], [(1, sentences(rng, 40)), (2, sentences(rng, 30))]
    for i in range(200):
        text = sentences(rng, 80)
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i in (31, 32):
            text += " " + items[i - 31][1]
        if i in (41, 42):
            text += " token = abcdefgh1234 and more"
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(i % 5 != 0), 0))
    docs += [(300 + i, docs[i][1] + " end", "en", "s", 1) for i in range(1, 5)]
    folder = write(spark, tmp_path, docs, labels, items)
    step = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder)
        assert step.columns == list(corpus_pipeline.COLUMNS)
        rows = step.collect()
        step = spark.createDataFrame(rows, SCHEMA)
        seen.append({r.doc_id: r for r in rows})
    quality, copies, leaks, clean = seen
    assert all(i % 5 for i in quality if i < 300) and len(quality) >= 160
    assert copies.keys() == quality.keys() - {301, 302, 303, 304}
    assert leaks.keys() == copies.keys() - {31, 32}
    assert clean.keys() == leaks.keys()
    for i, r in clean.items():
        base = [rule for rule in secrets.RULES if any(len(m[rule.group]) >= rule.least for m in re.finditer(rule.pattern, r.text))]
        assert not base and r.n_chars == len(r.text)
    assert clean[41].text.endswith(" [SECRET] and more")
    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.values())
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert sum(len(np.frombuffer(p.ids, "<u4")) for p in pieces) == want
    assert {p.doc_id for p in pieces} == clean.keys()


def test_odd_and_empty_tables(spark, tmp_path):
    folder = write(spark, tmp_path / "odd", document_rows(), [(1, 1, 0)], [(1, None)])
    pieces = corpus_pipeline.run(spark, folder).collect()
    found = forest.classes(spark.createDataFrame(document_rows(), SCHEMA)).collect()
    kept = len({r.class_no for r in found if r.class_no is not None}) + len({(r.doc_id, r.h) for r in found if r.class_no is None})
    assert sum(p.start == 0 for p in pieces) == kept
    folder = write(spark, tmp_path / "none", [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []
