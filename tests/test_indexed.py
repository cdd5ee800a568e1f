"""Searches of a saved index against searches of the texts."""

import math
import re

import pytest

from rillflow.operators import indexed, search
from rillflow.session import scratch_path
from tests.conftest import rows

TEXTS = [
    (1, "the red sea of the north, of the"), (2, "of red the"), (3, None), (4, ""), (5, "THE Red-Sea"),
    (6, "red red sea sea red sea"), (20_000, "operation red sea"), (-7, "sea of the red"), (8, "红海 red 海"),
]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    return indexed.build_index(docs, "doc_id", "text", "films_index", scratch_path(spark, "films"), span=5, buckets=8)


@pytest.mark.parametrize("query", ["of the", "the of the", "红海", "nowhere", "red red", ""])
def test_searches_equal_scans(spark, index, query):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    if query:
        by_scan = search.match_any(docs, "text", query).select("doc_id", "score")
        assert rows(indexed.index_match(index, query)) == rows(by_scan)
        assert rows(indexed.index_match_all(index, query)) == rows(search.match_all(docs, "text", query).select("doc_id"))
        assert rows(indexed.index_phrase(index, query)) == rows(search.match_phrase(docs, "text", query).select("doc_id"))
    else:
        assert rows(indexed.index_match(index, query)) == rows(indexed.index_phrase(index, query)) == []


def test_ranking(index):
    words = {d: re.findall(r"[a-z]+", (t or "").lower()) for d, t in TEXTS if d != 8}
    words[8] = ["红", "海", "red", "海"]
    mean = sum(map(len, words.values())) / len(words)
    wanted = {}
    for token in ("red", "sea"):
        holding = sum(token in w for w in words.values())
        for d, w in words.items():
            if n := w.count(token):
                part = math.log(1 + (len(words) - holding + 0.5) / (holding + 0.5)) * n * 2.2 / (
                    n + 1.2 * (0.25 + 0.75 * len(w) / mean))
                wanted[d] = wanted.get(d, 0) + part
    found = {r["doc_id"]: r["score"] for r in indexed.index_ranked(index, "red sea").collect()}
    assert found == pytest.approx(wanted)


def test_only_the_buckets_of_the_query_are_read(spark, index):
    # Plans name the buckets only where these also decide the tasks; files are left out either way.
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")
    try:
        check_buckets(index)
    finally:
        spark.conf.unset(key)


def check_buckets(index):
    plan = index.postings("sea")._jdf.queryExecution().executedPlan().toString()
    assert f"SelectedBucketsCount: 1 out of 8" in plan
    plan = indexed.index_phrase(index, "of the")._jdf.queryExecution().executedPlan().toString()
    assert f"SelectedBucketsCount: 2 out of 8" in plan


def test_blocks_of_a_frequent_token(spark, index):
    blocks = spark.table(index.name).where("token = 'red'").select("block", "postings").collect()
    assert len(blocks) > 2 and all(len(r["postings"]) <= 5 for r in blocks)
    # The index is found again by its name.
    again = indexed.TextIndex(spark, index.name)
    assert rows(indexed.index_match(again, "operation")) == [(20_000, 1)]


def test_pieces_of_unordered_repeated_and_missing_ids(spark, monkeypatch):
    """Places meet in one list a document, wherever its rows stand, and a length for every document."""
    texts = [(9, "a b a"), (None, "b"), (2, "a"), (9, "c a"), (2, None), (7, ""), (-3, "b a 红b")] * 2
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    for n, tokens in enumerate((1, 4, 1 << 20)):
        monkeypatch.setattr(indexed, "PIECE_TOKENS", tokens)
        made = indexed.build_index(
            docs.coalesce(1), "doc_id", "text", f"pieces_{n}", scratch_path(spark, "pieces"), span=4, buckets=2
        )
        assert {tuple(r) for r in made.lengths.collect()} == {(9, 10), (None, 2), (2, 2), (7, 0), (-3, 8)}
        found = {(r["token"], r["doc_id"]): r["positions"] for r in made.postings("a b c 红").collect()}
        assert found == {
            ("a", 9): [0, 0, 1, 1, 2, 2], ("b", 9): [1, 1], ("c", 9): [0, 0], ("b", None): [0, 0],
            ("a", 2): [0, 0], ("a", -3): [1, 1], ("b", -3): [0, 0, 3, 3], ("红", -3): [2, 2],
        }
