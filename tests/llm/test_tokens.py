"""Packing and Arrow files against the tokenizer itself."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sensorloom.llm import arrow_file, common, packing
from sensorloom.llm.common import Encoder, vocabulary_path
from sensorloom.session import scratch
from tests.llm.conftest import document_rows, odd_texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_encoder_is_the_tokenizer(tokenizer):
    mixed = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext| >", "a  b\n\n c\t d \n", " <|endoftext|>x", "　a\xa0 b\x1c c", " ", "\n\n", "don't  we'll", "a\nb", "\na", "a\n", "a\n\nb",
             "x\x85y  z", "1²½ x１２", "é é 漢字 🙂🙂 a'S 'll", "a.b.c...", "​ x y", "́a b́"]
    enc = Encoder(vocabulary_path())
    for text in [*mixed, *odd_texts(), *mixed]:
        assert np.frombuffer(enc.encode_one(text or ""), enc.dtype).tolist() == ids_of(tokenizer, text, 0)[:-1].tolist(), repr(text)


def test_pack(odd, tokenizer):
    pieces = packing.pack(odd.repartition(3), vocabulary_path(), window=64).collect()
    streams, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length
        streams[p.sequence_id * 64 + p.offset] = (p, ids)
        windows[p.sequence_id].append((p.offset, p.length))
    place, got, doc = 0, Counter(), []
    for at in sorted(streams):
        assert at == place
        p, ids = streams[at]
        assert p.start == sum(len(x) for x in doc)
        doc.append(ids)
        place += len(ids)
        if p.start + p.length == p.doc_tokens:
            got[(p.doc_id, np.concatenate(doc).tobytes())] += 1
            doc = []
    assert got == Counter((r[0], ids_of(tokenizer, r[1], 0).tobytes()) for r in document_rows())
    assert all(sum(n for _, n in w) == 64 for k, w in windows.items() if k != max(windows))


def test_sequences(odd):
    pieces = packing.pack(odd, vocabulary_path(), window=64)
    rows = sorted(packing.sequences(pieces, 64).collect(), key=lambda r: r.sequence_id)
    assert all(len(r.ids) == 64 == r.n_tokens for r in rows[:-1])
    assert len(rows[-1].ids) & (len(rows[-1].ids) - 1) == 0 and rows[-1].n_tokens <= len(rows[-1].ids)
    assert all(b.offset == sum(x.length for x in r.bounds[:i]) for r in rows for i, b in enumerate(r.bounds))


def test_arrow_files(spark, odd, tokenizer):
    folder = scratch(spark, "files")
    manifest = arrow_file.write_sequences(odd, folder, vocabulary_path(), length=32, rows=4)
    rows = arrow_file.read_documents(manifest).collect()
    want = Counter((r[0], zlib.crc32(ids_of(tokenizer, r[1], 2).tobytes())) for r in document_rows())
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == want
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id is not None and r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id if r.doc_id is not None else last
    file = manifest.orderBy("part").first()
    reader = arrow_file.SequenceFile(file.tokens_path)
    for i in (0, 5):
        ids, mask = reader.sequence(i)
        assert len(ids) == len(mask) == 32 and mask.all() and not ids.flags.owndata
        assert ids.tolist() == reader.tokens(32 * i, 32).tolist()
    _, mask = reader.sequence((file.n_tokens - 1) // 32)
    assert mask.sum() == (file.n_tokens - 1) % 32 + 1
    reader.close()


def test_empty_tables(spark, none):
    assert packing.pack(none, vocabulary_path()).collect() == []
    manifest = arrow_file.write_sequences(none, scratch(spark, "files"), vocabulary_path())
    assert manifest.count() == 0 and arrow_file.read_documents(manifest).collect() == []


def test_encoder_keeps_its_ids_when_stores_turn(tokenizer, monkeypatch):
    monkeypatch.setattr(common, "CACHE_PIECES", 5)
    enc = Encoder(vocabulary_path())
    for text in [*odd_texts(), *odd_texts()]:
        assert np.frombuffer(enc.encode_one(text or ""), enc.dtype).tolist() == ids_of(tokenizer, text, 0)[:-1].tolist()
        assert not any(getattr(store.older, "older", None) for store in (enc.first, enc.later, enc.cuts))  # two rounds, no more


def test_masks_are_views_of_the_file(tmp_path):
    path = str(tmp_path / "x.arrow")
    for total in (0, 7, 64, 200):
        with open(path, "wb") as sink:
            writer = arrow_file.SequenceWriter(sink, np.dtype("<u2"), 8, 4)
            ids = np.arange(total, dtype="<u2")
            for low in range(0, total, 5):
                writer.add(ids[low:low + 5].tobytes())
            writer.close()
        if not total:
            continue
        file = arrow_file.SequenceFile(path)
        for i in range(-(-total // 8)):
            got, mask = file.sequence(i)
            n = min(8, total - 8 * i)
            assert got[:n].tolist() == ids[8 * i:8 * i + n].tolist() and mask.tolist() == [1] * n + [0] * (8 - n)
            assert not got.flags.owndata and not mask.flags.owndata and not mask.flags.writeable
        file.close()
