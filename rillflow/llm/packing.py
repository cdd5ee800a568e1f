"""Packing of documents into sequences by the histogram of their lengths.

Shortest-pack-first: lengths are placed longest first, each into the open packs with the most
space left. Only the histogram (one row per length, at most ``width`` rows) is seen by the driver;
the packing patterns go back to the documents by the rank of a piece among those of its length.
The ids of a piece go with it to its sequence, which is padded and written; where each piece lies,
and the digest of its ids, are read from the written sequences.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rillflow.llm.arrow import byte_texts, map_batches, struct_of
from rillflow.llm.scratch import saved
from rillflow.llm.tokens import PieceEncoder
from rillflow.llm.tokenstore import END_ID

WIDTH = 2048
# Pieces that are numbered together, by length; a task with more begins another chunk.
CHUNK_PIECES = 100_000
# A table of at most so many small rows may be sent to every executor.
BROADCAST_ROWS = 500_000
# Sequences hold little-endian unsigned 32-bit ids.
ID_BYTES = 4
# Fills a sequence up; ``n_ids`` tells where the filling begins.
PAD_ID = 0
# ``number`` counts the pieces of a chunk that have the same length.
PIECE = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " chunk bigint, number bigint"
)
PLACE = "offset bigint, length bigint, doc_id bigint, start bigint, doc_tokens bigint"
SEQUENCE = f"sequence_id bigint, n_ids bigint, ids binary, pieces array<struct<{PLACE}>>"
SLOT = "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, offset bigint"


@dataclass
class Pattern:
    """Lengths that share a sequence, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], width: int = WIDTH) -> list[Pattern]:
    """Packing patterns that hold exactly the pieces of a length histogram."""
    open_packs: list[tuple[int, int, Pattern]] = []
    closed: list[Pattern] = []
    made = 0

    def put(lengths: tuple[int, ...], count: int) -> None:
        nonlocal made
        if count:
            made += 1
            space = width - sum(lengths)
            pattern = Pattern(lengths, count)
            if space:
                heapq.heappush(open_packs, (-space, made, pattern))
            else:
                closed.append(pattern)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and -open_packs[0][0] >= length:
                _, _, pack = heapq.heappop(open_packs)
                used = min(left, pack.count)
                put(pack.lengths, pack.count - used)
                put((*pack.lengths, length), used)
                left -= used
            else:
                each = width // length
                put((length,) * each, left // each)
                put((length,) * (left % each), 1 if left % each else 0)
                left = 0
    return closed + [pack for _, _, pack in open_packs]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """Ranges of ranks per length with the sequence and offset of their first piece."""
    out, rank, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            first = rank.get(length, 0)
            out.append((length, first, first + pattern.count, sequence, offset))
            rank[length] = first + pattern.count
            offset += length
        sequence += pattern.count
    return out


def token_pieces(docs: DataFrame, vocabulary: str, width: int = WIDTH) -> DataFrame:
    """Documents (doc_id, text) as pieces of at most ``width`` ids; only the last is shorter.

    Ids take two bytes each if the vocabulary allows. Chunks and numbers follow the partitions
    of ``docs``, so the pieces must be written before they are used.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    most = CHUNK_PIECES
    target = to_arrow_schema(struct_of(PIECE))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(vocabulary)
        kind = "<u2" if encoder.n_ids <= 1 << 16 else "<u4"
        chunk, met, made = TaskContext.get().partitionId() << 32, Counter(), 0
        for batch in batches:
            numbers = iter(batch.column("doc_id").to_pylist())
            for group in encoder.batches(byte_texts(batch.column("text"))):
                rows = []
                for ids in group:
                    ids, doc = np.concatenate([ids, np.array([END_ID], np.uint32)]), next(numbers)
                    for at in range(0, len(ids), width):
                        piece = ids[at : at + width]
                        if made == most:
                            chunk, met, made = chunk + 1, Counter(), 0
                        rows.append((
                            doc, at, len(piece), piece.astype(kind).tobytes(), len(ids), chunk,
                            met[len(piece)],
                        ))
                        met[len(piece)] += 1
                        made += 1
                if rows:
                    columns = [pa.array(x, f.type) for x, f in zip(zip(*rows), target)]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    return plain.mapInArrow(cut, PIECE)


def placed(
    spark: SparkSession, docs: DataFrame, vocabulary: str, width: int = WIDTH
) -> DataFrame:
    """Every piece of every document with its ids, its sequence and its offset there."""
    pieces = saved(spark, token_pieces(docs, vocabulary, width), "pieces", "zstd")
    # One row per chunk and length. The rank of a piece is its number after those of the chunks
    # before, so the ids need not be moved to be ranked.
    counts = saved(spark, pieces.groupBy("length", "chunk").count(), "counts")
    totals = counts.groupBy("length").agg(F.sum("count").alias("count"), F.count("*").alias("n"))
    totals = totals.collect()
    histogram = {r["length"]: r["count"] for r in totals}
    # At most ``width`` lengths and so a bounded number of patterns, whatever the table.
    table = spark.createDataFrame(slots(shortest_pack_first(histogram, width)), SLOT)

    before = (
        Window.partitionBy("length").orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = counts.select(
        "length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")
    )
    if sum(r["n"] for r in totals) <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    ranked = pieces.join(bases, ["length", "chunk"]).withColumn(
        "_rank", F.col("_base") + F.col("number")
    )
    here = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("end_rank"))
    same = (ranked["length"] == table["length"]) & here
    return ranked.join(F.broadcast(table), same).select(
        "doc_id", "start", ranked["length"], "ids", "doc_tokens",
        (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )


def sequences(
    spark: SparkSession, docs: DataFrame, vocabulary: str, width: int = WIDTH
) -> DataFrame:
    """The packed sequences, written: (sequence_id, n_ids, ids, pieces).

    ``ids`` holds ``width`` ids of ``ID_BYTES`` each, the last ones ``PAD_ID`` from ``n_ids`` on.
    ``pieces`` says from the first to the last whose ids they are. A null text is empty and still
    holds its end id. Rows with the same doc_id, or none, are documents of their own. An empty
    table gives no sequences.
    """
    fields = [f.name for f in struct_of(PLACE)]
    # At most ``width`` pieces with ``width`` ids in all.
    held = placed(spark, docs, vocabulary, width).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct(*fields, "ids"))).alias("held")
    )
    places = F.transform("held", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    ids = F.transform("held", lambda x: x["ids"])

    def padded(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = []
        for pieces, parts in zip(*(batch.column(c).to_pylist() for c in ("pieces", "parts"))):
            n_ids, joined = sum(x["length"] for x in pieces), b"".join(parts)
            full = np.full(width, PAD_ID, "<u4")
            full[:n_ids] = np.frombuffer(joined, f"<u{len(joined) // n_ids}")
            rows.append((n_ids, full.tobytes()))
        yield {
            "sequence_id": batch.column("sequence_id"), "n_ids": [n for n, _ in rows],
            "ids": [x for _, x in rows], "pieces": batch.column("pieces"),
        }

    parts = held.select("sequence_id", places.alias("pieces"), ids.alias("parts"))
    return saved(spark, map_batches(parts, padded, SEQUENCE), "sequences", "zstd")


def cut_sequences(packed: DataFrame) -> DataFrame:
    """The pieces that written sequences hold, with the digest of the ids that lie there.

    The first piece of a sequence carries its padded ids as ``sequence``; others have null.
    """
    at = (F.lit(ID_BYTES) * F.col("offset") + 1).cast("int")
    ids = F.substring("ids", at, (ID_BYTES * F.col("length")).cast("int"))
    return packed.select("sequence_id", "ids", F.inline("pieces")).select(
        "doc_id", "start", "length", F.crc32(ids).alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", F.when(F.col("offset") == 0, F.col("ids")).alias("sequence"),
    )


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, width: int = WIDTH) -> DataFrame:
    """Every piece of every document as it lies in the written sequences, with its digest.

    ``cut_sequences`` of ``sequences`` without the ids themselves.
    """
    return cut_sequences(sequences(spark, docs, vocabulary, width)).drop("sequence")
