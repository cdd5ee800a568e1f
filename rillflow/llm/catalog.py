"""The named queries of the dealt operators, each beside its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from rillflow.catalog.registry import Tables
from rillflow.llm import (
    htmlblocks, linefreq, oddsketch, packing, passages, phrases, seeds, templates, tokens, tokenstore,
    trie, urls, warc, whiten,
)
from rillflow.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op4_token_store(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tokens")
    tokenstore.write_store(t.documents, path, tokens.default_vocabulary())
    return tokenstore.read_documents(t.spark, path)


@query()
def op5_packing(t: Tables) -> DataFrame:
    return packing.pack(t.spark, t.documents, tokens.default_vocabulary())


@query(linefreq.VERDICT_SQL)
def op7_line_frequency(t: Tables) -> DataFrame:
    return linefreq.line_verdicts(t.documents)


@query()
def op8_url_trees(t: Tables) -> DataFrame:
    model = urls.UrlModel.train(urls.labelled_urls(t.spark))
    return urls.judge(t.pages, model, urls.RULES)


@query()
def op2_html_blocks(t: Tables) -> DataFrame:
    return htmlblocks.extract(t.pages)


@query()
def op9_odd_sketch(t: Tables) -> DataFrame:
    return oddsketch.near_duplicates(t.spark, t.documents)


@query()
def op10_passage_attention(t: Tables) -> DataFrame:
    return passages.score(t.documents, passages.train(t.documents, t.labels))


@query()
def op6_spaced_seeds(t: Tables) -> DataFrame:
    return seeds.overlaps(t.spark, t.documents, t.benchmark)


@query(templates.TEMPLATE_SQL)
def op1_template_tree(t: Tables) -> DataFrame:
    changed = templates.drop_recurring_lines(t.spark, t.documents)
    return changed.select("doc_id", "text", *templates.COUNTS)


@query()
def op3_phrase_automata(t: Tables) -> DataFrame:
    return phrases.remove_repeated(t.spark, t.documents, with_text=False)


@query(warc.ARCHIVE_SQL)
def op12_warc_reader(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "warc")
    warc.write_archives(t.spark, t.pages, path)
    records = warc.page_records(warc.read_archives(t.spark, path))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op11_refined_whitening(t: Tables) -> DataFrame:
    return whiten.whiten(t.spark, t.embeddings)


@query(trie.TRIE_SQL)
def op13_burst_trie(t: Tables) -> DataFrame:
    return trie.prefix_trie(t.spark, t.conversations)
