"""Searches served from a saved index with positions (SCH-01, SCH-03, SCH-10).

An index is two tables: ``<name>`` holds posting lists, bucketed and sorted by token, so that a
query reads only the buckets of its tokens; ``<name>_lengths`` holds the tokens of every document.
A list is cut into blocks of consecutive document ids, so a frequent token is many rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import analysed
from rillflow.session import plan_bytes, spread

# Document ids of a block, and bytes of text that a bucket should stand for.
SPAN = 8192
BUCKET_BYTES = 256 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 4096
# Tokens whose places are sorted at once, unless one text has more.
PIECE_TOKENS = 1 << 21
# No text has the empty token: its list holds the number of tokens of every document.
LENGTH = ""
PIECE = "token string, block bigint, postings array<struct<doc_id: bigint, positions: array<int>>>"
# Fixed values of the published ranking formula.
SATURATION, LENGTH_SHARE = 1.2, 0.75


@dataclass(frozen=True)
class TextIndex:
    """A saved index by name; opened again by naming it."""

    spark: SparkSession
    name: str

    def postings(self, query: str) -> DataFrame:
        """Rows (token, doc_id, positions) of the query's tokens; other buckets are not read."""
        tokens = self.tokens(query)
        listed = self.spark.table(self.name).where(F.col("token").isin(sorted(set(tokens))))
        return listed.select("token", F.inline("postings"))

    def tokens(self, query: str) -> list[str]:
        """The query's tokens in order; analysed like the texts."""
        words = analysed(F.lit(query))
        return self.spark.range(1).select(words.alias("t")).first()["t"]

    @property
    def lengths(self) -> DataFrame:
        return self.spark.table(f"{self.name}_lengths")


def _buckets(df: DataFrame) -> int:
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, plan_bytes(df) // BUCKET_BYTES))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any of the keys."""
    differ = np.ones(len(keys[0]), dtype=bool)
    differ[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return np.flatnonzero(differ)


def _piece(docs: pa.Array, words: pa.ListArray, span: int) -> pa.RecordBatch:
    """The lists of some documents, one row per token and block."""
    # Documents in order of their ids; those without an id stand last.
    missing = docs.is_null().to_numpy(zero_copy_only=False)
    docs = docs.fill_null(0).to_numpy()
    order = np.lexsort((docs, missing))
    if np.any(np.diff(order) != 1):
        docs, missing, words = docs[order], missing[order], words.take(pa.array(order))
    sizes = np.diff(words.offsets.to_numpy())
    named = pc.dictionary_encode(words.flatten())
    tokens = pa.concat_arrays([named.dictionary, pa.array([LENGTH])])
    row = np.repeat(np.arange(len(docs), dtype="int32"), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # The rows of the lengths stand behind those of the places.
    code = np.append(named.indices.to_numpy(), np.full(len(docs), len(tokens) - 1, "int32"))
    row, at = np.append(row, np.arange(len(docs), dtype="int32")), np.append(at, sizes)
    entry = np.zeros(len(docs), dtype="int64")
    entry[_starts(missing, docs)] = 1
    entry = np.cumsum(entry) - 1
    if entry[-1] + 1 == len(docs):
        order = np.argsort(code, kind="stable")
    else:
        # Rows with the same id have their places in one list.
        order = np.lexsort((at, entry[row], code))
    code, row, at = code[order], row[order], at[order]
    doc, missing = docs[row], missing[row]
    posting = _starts(code, missing, doc)
    code, doc, missing = code[posting], doc[posting], missing[posting]
    listed = _starts(code, missing, doc // span)
    positions = pa.ListArray.from_arrays(
        pa.array(np.append(posting, len(at)), "int32"), pa.array(at, "int32")
    )
    postings = pa.StructArray.from_arrays(
        [pa.array(doc, "int64", mask=missing), positions], ["doc_id", "positions"]
    )
    return pa.RecordBatch.from_arrays([
        tokens.take(pa.array(code[listed])),
        pa.array((doc // span)[listed], "int64", mask=missing[listed]),
        pa.ListArray.from_arrays(pa.array(np.append(listed, len(doc)), "int32"), postings),
    ], ["token", "block", "postings"])


def _pieces(span: int):
    """Lists of the documents of a batch; the same token and block may come from many batches."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.cumsum(pc.list_value_length(batch["words"]).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < len(seen):
                before = seen[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(seen, before + PIECE_TOKENS, "right")))
                part = batch.slice(begin, end - begin)
                yield _piece(part["doc_id"], part["words"], span)
                begin = end

    return pieces


def _merged(postings: Column) -> Column:
    """Sorted postings with one entry a document, whose rows may have come in several pieces."""
    n = F.size(postings)
    starts = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | ~F.get(postings, i - 1)["doc_id"].eqNullSafe(F.get(postings, i - 2)["doc_id"]),
    )

    def entry(own: Column) -> Column:
        return F.struct(
            own[0]["doc_id"].alias("doc_id"),
            F.sort_array(F.flatten(F.transform(own, lambda p: p["positions"]))).alias("positions"),
        )

    def cut(found: Column) -> Column:
        return F.transform(found, lambda start, k: entry(
            F.slice(postings, start, F.coalesce(F.get(found, k + 1), n + 1) - start)
        ))

    # Bound once, since a lambda computes what it refers to for every element.
    return F.transform(F.array(starts), cut)[0]


def build_index(
    df: DataFrame, doc_id: str, field: str, name: str, path: str, span: int = SPAN,
    buckets: int | None = None,
) -> TextIndex:
    """Index a text field by whole-number document ids and save it as tables below ``path``.

    The id names one document: rows with the same id have their places in one list. A null or empty
    text has no tokens. An index of the same name is replaced. A text is analysed once; its tokens
    are sorted beside those of the other texts of a batch, and only lists are shuffled.
    """
    spark = df.sparkSession
    words = analysed(F.coalesce(F.col(field), F.lit("")))
    texts = spread(df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(field)))
    pieces = texts.select("doc_id", words.alias("words")).mapInArrow(_pieces(span), PIECE)
    # Pieces hardly ever combine before the shuffle, where it would cost a sort.
    blocks = pieces.repartition("token", "block").groupBy("token", "block").agg(
        F.sort_array(F.flatten(F.collect_list("postings"))).alias("postings")
    )
    once = F.size(F.array_distinct("postings.doc_id")) == F.size("postings")
    blocks = blocks.withColumn(
        "postings", F.when(once, F.col("postings")).otherwise(_merged(F.col("postings")))
    )
    for table in (name, f"{name}_lengths"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        blocks.write.option("path", f"{path}/postings").bucketBy(buckets or _buckets(df), "token")
        .sortBy("token").saveAsTable(name)
    )
    lengths = spark.table(name).where(F.col("token") == LENGTH).select(F.inline("postings"))
    total = F.aggregate("positions", F.lit(0).cast("bigint"), lambda whole, n: whole + n)
    lengths.select("doc_id", total.alias("length")).write.option(
        "path", f"{path}/lengths"
    ).saveAsTable(f"{name}_lengths")
    return TextIndex(spark, name)


def index_match(index: TextIndex, query: str) -> DataFrame:
    """Documents with at least one query token, scored by distinct tokens hit (SCH-01)."""
    return index.postings(query).groupBy("doc_id").agg(F.count("*").cast("int").alias("score"))


def index_match_all(index: TextIndex, query: str) -> DataFrame:
    """Documents with every query token (SCH-02)."""
    asked = len(set(index.tokens(query)))
    return index_match(index, query).where(F.col("score") == asked).select("doc_id")


def index_phrase(index: TextIndex, phrase: str) -> DataFrame:
    """Documents with the phrase's tokens one after the other (SCH-03).

    A token that stands ``i`` words into the phrase and at ``p`` in the text names ``p - i`` as the
    begin; a begin that all places of the phrase name is a hit.
    """
    tokens = index.tokens(phrase)
    places: dict[str, list[int]] = {}
    for i, token in enumerate(tokens):
        places.setdefault(token, []).append(i)
    if not tokens:
        return index.lengths.select("doc_id").where(F.lit(False))
    wanted = F.create_map(*[
        part for token, at in places.items() for part in (F.lit(token), F.array(*map(F.lit, at)))
    ])
    found = index.postings(phrase)
    if len(places) > 1:
        # Positions are compared only in documents that hold all the tokens.
        whole = index_match(index, phrase).where(F.col("score") == len(places)).select("doc_id")
        found = found.join(whole, "doc_id", "left_semi")
    begins = found.select(
        "doc_id", F.explode("positions").alias("at"), F.element_at(wanted, F.col("token")).alias("i")
    ).select("doc_id", F.explode("i").alias("i"), "at").select("doc_id", (F.col("at") - F.col("i")).alias("begin"))
    return (
        begins.groupBy("doc_id", "begin").count().where(F.col("count") == len(tokens))
        .select("doc_id").distinct()
    )


def _rarity(documents: Column, holding: Column) -> Column:
    return F.log(1 + (documents - holding + 0.5) / (holding + 0.5))


def index_ranked(index: TextIndex, query: str) -> DataFrame:
    """Documents with a query token, scored by rarity of the tokens and length of the text (SCH-01).

    The published formula: a token counts more the fewer documents hold it, ever less the more
    often it stands in a text, and less in texts longer than the mean.
    """
    hits = index.postings(query).select("token", "doc_id", F.size("positions").alias("found"))
    whole = index.lengths.agg(F.count("*").alias("documents"), F.avg("length").alias("mean"))
    holding = hits.groupBy("token").agg(F.count("*").alias("holding"))
    share = LENGTH_SHARE * F.col("length") / F.col("mean") + (1 - LENGTH_SHARE)
    score = (
        _rarity(F.col("documents"), F.col("holding")) * F.col("found") * (SATURATION + 1)
        / (F.col("found") + SATURATION * share)
    )
    # One row per query token and one row in all are small by nature.
    rows = hits.join(F.broadcast(holding), "token").join(index.lengths, "doc_id")
    return (
        rows.join(F.broadcast(whole)).select("doc_id", score.alias("score"))
        .groupBy("doc_id").agg(F.sum("score").alias("score"))
    )
