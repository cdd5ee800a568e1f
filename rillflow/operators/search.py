"""Searches over document tables (SCH-01 .. SCH-10, FLT-10, FLT-12, FLT-13)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import (
    analysed,
    compute_once,
    contains_all,
    contains_any,
    contains_phrase,
    highlight,
    match_score,
    query_tokens,
)
from rillflow.operators.relational import page
from rillflow.session import spread

POSTING_SPAN = 65_536


@dataclass(frozen=True)
class Hits:
    """A page of hits and, as a plan of its own, how many there are in all."""

    total: DataFrame
    detail: DataFrame


def _holding(df: DataFrame, field: str, query: str, every: bool) -> DataFrame:
    """Rows whose text holds the query's tokens anywhere, also inside other words.

    A token of the text is a piece of the lower-case text, so this drops no hit; it spares the
    analysis of the texts that cannot be one.
    """
    asked = df.sparkSession.sql("SELECT 1").select(query_tokens(query)).first()[0]
    pieces = [F.lower(field).contains(token) for token in asked]
    both = Column.__and__ if every else Column.__or__
    return df.where(reduce(both, pieces, F.lit(every)))


def _hits(df: DataFrame, found: Column) -> DataFrame:
    """Keep the rows found; the costly test stays where the rows have been spread."""
    return compute_once(df, "_hit", found).where("_hit").drop("_hit")


def match_any(df: DataFrame, field: str, query: str) -> DataFrame:
    """Documents with at least one query token, scored by distinct tokens hit (SCH-01)."""
    held = _holding(spread(df), field, query, every=False)
    scored = compute_once(held, "score", match_score(F.col(field), query))
    return scored.where(F.col("score") > 0)


def match_all(df: DataFrame, field: str, query: str) -> DataFrame:
    """Documents with every query token (SCH-02)."""
    held = _holding(spread(df), field, query, every=True)
    return _hits(held, contains_all(F.col(field), query))


def match_phrase(df: DataFrame, field: str, phrase: str) -> DataFrame:
    """Documents with the phrase's tokens one after the other (SCH-03)."""
    held = _holding(spread(df), field, phrase, every=True)
    return _hits(held, contains_phrase(F.col(field), phrase))


def token_term(field: Column, token: str) -> Column:
    """One token, compared as it is: a text of several words never hits (FLT-10)."""
    return F.array_contains(analysed(field), token)


def nested_match(df: DataFrame, items: str, field: str, query: str) -> DataFrame:
    """Any query token in any element's text (SCH-04)."""
    return df.where(F.exists(items, lambda item: contains_any(item[field], query)))


def filter_must(df: DataFrame, condition: Column, field: str, query: str) -> DataFrame:
    """Both have to hold, only the match scores (FLT-12)."""
    return match_any(df.where(condition), field, query)


def filter_should(df: DataFrame, condition: Column, field: str, query: str) -> DataFrame:
    """The match adds score and excludes nothing (FLT-13)."""
    return df.where(condition).withColumn(
        "score", F.coalesce(match_score(F.col(field), query), F.lit(0))
    )


def inverted_index(df: DataFrame, doc_id: str, field: str, span: int = POSTING_SPAN) -> DataFrame:
    """Posting lists (token, block, sorted doc ids) of whole-number document ids (SCH-10).

    A frequent token occurs in a large share of all documents, so its list is cut into blocks
    of ``span`` consecutive ids: no row and no task holds more than ``span`` ids of a token.
    """
    tokens = spread(df.select(doc_id, field)).select(
        F.col(doc_id), F.explode(F.array_distinct(analysed(F.col(field)))).alias("token")
    )
    block = F.floor(F.col(doc_id) / span)
    listed = tokens.groupBy("token", block.alias("block")).agg(
        F.sort_array(F.collect_list(doc_id)).alias("doc_ids")
    )
    return listed


def search_page(
    df: DataFrame, field: str, query: str, key: str, columns: list[str],
    condition: Column | None = None, every_token: bool = False, order: list[Column] | None = None,
    page_no: int = 1, page_size: int = 20,
) -> Hits:
    """Filter, match, highlight, sort and page, with the exact total (SCH-07, SCH-08)."""
    wanted = df if condition is None else df.where(condition)
    if every_token:
        # A plain filter, which Catalyst can push below the joins of a wide table.
        found = wanted.where(contains_all(F.col(field), query))
        found = found.withColumn("score", F.size(query_tokens(query)))
    else:
        found = match_any(wanted, field, query)
    total = found.agg(F.count(F.lit(1)).alias("total"))
    order = order or [F.col("score").desc(), F.col(key).asc()]
    shown = page(found, order, page_no, page_size)
    # Only the rows of the page are highlighted.
    marked = shown.withColumn(field, highlight(F.col(field), query))
    return Hits(total, marked.select(*columns))
