"""Token files and packing against the tokenizers library used directly."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import eliasfano, packing, tokens, tokenstore
from rillflow.session import scratch_path
from tests.llm import tables


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_vocabulary())


def direct(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.integers(0, 1 << 40), max_size=2000))
@settings(max_examples=60, deadline=None)
def test_coded_numbers(values):
    values = sorted(values)
    coded = eliasfano.Coded(eliasfano.encode(np.array(values, np.int64)))
    assert coded.all().tolist() == values
    for i in range(0, len(values), max(1, len(values) // 20)):
        assert coded.select(i) == values[i]


def test_coded_numbers_are_small():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 10_000))
    assert len(eliasfano.encode(values)) < 10_000 * (2 + 17 + 1) / 8 + 200


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_words_encode_like_texts(library, text):
    text = text.encode("utf-8", "ignore").decode()
    encoder = tokens.PieceEncoder.of(tokens.default_vocabulary())
    assert encoder.ids(text.encode()).tolist() == direct(library, text)[:-1]


@pytest.mark.parametrize("text", [
    "a\x1cb c", "don't stop <|endoftext|>x", "İstanbul É é é 12345", "ΑΣ Σ ὈΔΥΣΣΕΎΣ", "x" * 5000,
    "%%%$$$&&& | 3.14 it's 'tis 're", "日本語 テスト ß ẞ ÿ Ÿ µ ª", "<|startoftext|><|endoftext|>",
])
def test_awkward_words(library, text):
    encoder = tokens.PieceEncoder.of(tokens.default_vocabulary())
    assert encoder.ids(text.encode()).tolist() == direct(library, text)[:-1]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 256)
    encoder = tokens.PieceEncoder(tokens.default_vocabulary())
    texts = [tables.prose(i, 100) for i in range(30)]
    found = [ids for t in texts for group in encoder.batches([t.encode()]) for ids in group]
    assert [f.tolist() for f in found] == [direct(library, t)[:-1] for t in texts]


def test_store_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(tokenstore, "BLOCK_IDS", 3000)
    docs = tables.documents(spark).where("doc_id IS NOT NULL")
    path = scratch_path(spark, "store")
    tokenstore.write_store(docs, path, tokens.default_vocabulary())
    out = tokenstore.read_documents(spark, path).orderBy("start").collect()
    start, expected = 0, []
    for doc, text in sorted(tables.pairs_of(docs), key=lambda r: (r[0], (r[1] or "").encode())):
        ids = direct(library, text)
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert [tuple(r) for r in out] == expected
    blocks = spark.read.parquet(path).collect()
    texts = dict(tables.pairs_of(docs))
    for doc in (10, 20, 40):
        held = [ids for b in blocks if (ids := tokenstore.ids_of(b.asDict(), doc))]
        assert held == [direct(library, texts[doc])]


def test_rows_without_an_id_come_first(spark, library, monkeypatch):
    monkeypatch.setattr(tokenstore, "BLOCK_IDS", 3000)
    docs, path = tables.documents(spark), scratch_path(spark, "store")
    tokenstore.write_store(docs, path, tokens.default_vocabulary())
    out = [tuple(r) for r in tokenstore.read_documents(spark, path).orderBy("start").collect()]
    start, expected = 0, []
    order = sorted(tables.pairs_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for doc, text in order:
        ids = direct(library, text)
        expected.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    assert out == expected and out[0][0] is None and out[1][0] is None


def test_store_of_an_empty_table(spark):
    path = scratch_path(spark, "store")
    tokenstore.write_store(tables.empty(spark), path, tokens.default_vocabulary())
    assert tokenstore.read_documents(spark, path).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
@settings(max_examples=100, deadline=None)
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held = defaultdict(int)
    for p in patterns:
        assert sum(p.lengths) <= 64
        for length in p.lengths:
            held[length] += p.count
    assert dict(held) == histogram


def check_packing(library, rows, out):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = defaultdict(list)
    for doc, text in rows:
        texts[doc].append(direct(library, text))
    for doc, all_ids in texts.items():
        wanted = sorted(
            (at, len(ids[at : at + 2048]), crc(ids[at : at + 2048]), len(ids))
            for ids in all_ids for at in range(0, len(ids), 2048)
        )
        mine = pieces.pop(doc)
        assert wanted == sorted(
            (r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in mine
        )
    assert not pieces
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(n for held in sequences.values() for _, n in held) / 2048 / len(sequences)


def test_packing(spark, library):
    docs = tables.documents(spark)
    out = packing.pack(spark, docs, tokens.default_vocabulary()).collect()
    assert check_packing(library, tables.pairs_of(docs), out) > 0.9


def test_hot_length(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_PIECES", 50)
    rows = [(i, "one two three") for i in range(500)] + [(1000 + i, tables.prose(i, 90)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = packing.pack(spark, docs, tokens.default_vocabulary()).collect()
    assert check_packing(library, rows, out) > 0.9


def test_packing_an_empty_table(spark):
    out = packing.pack(spark, tables.empty(spark), tokens.default_vocabulary())
    assert out.count() == 0
