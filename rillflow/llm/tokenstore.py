"""Token files: a concatenated id array with Elias-Fano coded document boundaries.

A store is a Parquet folder, written and committed by Spark, whose rows are blocks of documents in
ascending doc_id order: the blocks of a shard follow one another, and so do the shards. A block
holds its ids back to back as little-endian unsigned integers of ``width`` bytes, the document
numbers and the ends of the documents, both Elias-Fano coded. The offset of document k is one
select on the boundaries; there is no table of 64-bit offsets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.llm import eliasfano
from rillflow.llm.arrow import byte_texts, map_batches, struct_of, to_arrow_schema
from rillflow.llm.tokens import PieceEncoder

END_ID = 1
BLOCK_IDS = 1 << 20
BLOCK = (
    "shard int, block int, first_id bigint, n_docs bigint, n_ids bigint, width int,"
    " base_doc bigint, docs binary, bounds binary, ids binary"
)
DOCUMENT = "shard int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _packed(shard: int, block: int, first: int, docs: list[int], ids: list[np.ndarray]) -> dict:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids)
    width = 2 if int(flat.max(initial=0)) < 1 << 16 else 4
    return {
        "shard": [shard], "block": [block], "first_id": [first], "n_docs": [len(docs)],
        "n_ids": [len(flat)], "width": [width], "base_doc": [docs[0]],
        "docs": [eliasfano.encode(np.array(docs, np.int64) - docs[0]) if docs[0] is not None else None],
        "bounds": [eliasfano.encode(np.concatenate([[0], np.cumsum(sizes)]))],
        "ids": [flat.astype(f"<u{width}").tobytes()],
    }


def write_store(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write a store.

    A null text is empty, and every document ends with id 1, so an empty one has one token. Rows
    without a doc_id come first, in blocks of their own without document numbers. Rows with the same
    doc_id follow one another in order of their texts. An empty table gives a store without blocks.
    """
    ordered = (
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = PieceEncoder.of(vocabulary), TaskContext.get().partitionId()
        end = np.array([END_ID], np.uint32)
        block = first = size = 0
        held_docs: list[int] = []
        held_ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            row = _packed(shard, block, first, held_docs, held_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(row[f.name], f.type) for f in schema], schema=schema
            )

        for batch in batches:
            numbers = iter(batch.column("doc_id").to_pylist())
            for group in encoder.batches(byte_texts(batch.column("text"))):
                for ids in group:
                    number = next(numbers)
                    if held_docs and held_docs[0] is None and number is not None:
                        yield flush()
                        block, first, size = block + 1, first + size, 0
                        held_docs.clear()
                        held_ids.clear()
                    held_docs.append(number)
                    held_ids.append(np.concatenate([ids, end]))
                    size += len(ids) + 1
                    if size >= BLOCK_IDS:
                        yield flush()
                        block, first, size = block + 1, first + size, 0
                        held_docs.clear()
                        held_ids.clear()
        if held_docs:
            yield flush()

    schema = to_arrow_schema(struct_of(BLOCK))
    ordered.mapInArrow(encode, BLOCK).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each document of a store: where it starts, its length and the CRC of its ids.

    Every offset is a select on the bounds of its block.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)

    def decode(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            coded, count = eliasfano.Coded(row["bounds"]), row["n_docs"]
            bounds = np.fromiter(map(coded.select, range(count + 1)), np.int64, count + 1)
            numbers = [None] * count
            if row["base_doc"] is not None:
                numbers = eliasfano.Coded(row["docs"]).all() + row["base_doc"]
            ids = np.frombuffer(row["ids"], f"<u{row['width']}")
            yield {
                "shard": np.full(len(numbers), row["shard"]), "doc_id": numbers,
                "local_start": row["first_id"] + bounds[:-1], "n_tokens": np.diff(bounds),
                "ids_crc32": [crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])],
            }

    # One row per shard, so the running sum over all shards is small.
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    return (
        map_batches(blocks, decode, DOCUMENT)
        .join(bases, "shard")
        .select(
            "doc_id", (F.col("_base") + F.col("local_start")).alias("start"), "n_tokens",
            "ids_crc32",
        )
    )


def ids_of(block: dict, doc_id: int) -> list[int]:
    """The ids of a document in a block row, by two selects; empty when it is not there."""
    if block["base_doc"] is None:
        return []
    numbers, bounds = eliasfano.Coded(block["docs"]), eliasfano.Coded(block["bounds"])
    low, high = 0, numbers.count
    while low < high:
        middle = (low + high) // 2
        if numbers.select(middle) + block["base_doc"] < doc_id:
            low = middle + 1
        else:
            high = middle
    if low == numbers.count or numbers.select(low) + block["base_doc"] != doc_id:
        return []
    ids = np.frombuffer(block["ids"], f"<u{block['width']}")
    return ids[bounds.select(low) : bounds.select(low + 1)].tolist()
