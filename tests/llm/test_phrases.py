"""Automata over repeated passages against a search of every window."""

import hashlib
from collections import Counter

import pytest

from rillflow.llm import phrases
from tests.llm import tables


def brute(rows):
    windows = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 12):
            if doc is not None:
                w = tuple(words[i : i + 13])
                windows[w] = min(windows.get(w, doc), doc)
    out = Counter()
    for doc, text in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - 12):
            if doc is not None and windows[tuple(words[i : i + 13])] < doc:
                keep[i : i + 13] = [False] * 13
        left = b" ".join(w for w, k in zip(words, keep) if k)
        out[(doc, len(words), keep.count(False), hashlib.sha256(left).hexdigest())] += 1
    return out


def found(spark, docs):
    df = phrases.remove_repeated(spark, docs, with_text=False)
    return Counter(tuple(r) for r in df.collect())


def test_awkward_documents(spark):
    docs = tables.documents(spark)
    assert found(spark, docs) == brute(tables.pairs_of(docs))


def test_shards_and_splits(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 300)
    monkeypatch.setattr(phrases, "SPLIT_WORDS", 500)
    monkeypatch.setattr(phrases, "AUTOMATON_WINDOWS", 50)
    passage = tables.prose(70, 60)
    rows = [
        (i, tables.prose(200 + i, 40) + "\n" + tables.changed(passage, i, i % 4)) for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(spark, docs) == brute(rows)


def test_kept_text(spark):
    rows = [(1, tables.prose(71, 30)), (2, "before\n" + tables.prose(71, 30) + " after")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r["kept_text"] for r in phrases.remove_repeated(spark, docs).collect()}
    assert out == {1: " ".join(rows[0][1].split()), 2: "before after"}


@pytest.mark.parametrize("words", [0, 12, 13, 14])
def test_short_texts(spark, words):
    text = " ".join(f"w{i}" for i in range(words))
    rows = [(1, text), (2, text + " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(spark, docs) == brute(rows)


def test_empty_table(spark):
    assert phrases.remove_repeated(spark, tables.empty(spark)).count() == 0
