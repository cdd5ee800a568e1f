"""Benchmark passages in documents, found by spaced seeds and verified with substitutions.

Fixed masks pick five of up to ten token positions and ignore the rest, so that a changed word
spoils only the seeds that look at it. Seeds of documents that can be seeds of the benchmark are
joined with these, and the words around each hit are laid beside the item and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.arrow import byte_texts, map_batches
from rillflow.llm.filters import bitmap, passing
from rillflow.llm.words import Hasher, mixed, numbers
from rillflow.llm.worker import kept
from rillflow.session import scratch_path

# Any 13 words with two substitutions, and any 16 with three, are hit by one of these.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 5, 8, 9), (0, 1, 2, 4, 7), (0, 2, 4, 7, 9))
# Items of fewer words than SHORT are hit by further masks: up to four words as they are, and more
# with the substitutions that four fifths allow between the first word and the last.
SHORT_MASKS = ((0,), (0, 1), (0, 1, 2), (0, 1, 2, 3), (0, 1, 3))
ALL_MASKS = MASKS + SHORT_MASKS
SHORT = 11
LEAST_WORDS = 13
IDENTITY = 0.8
FILTER_BITS = 1 << 24
# Signs of ASCII, which are dropped, and upper case, which becomes lower case.
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain(text: bytes) -> bytes:
    """A-Z in lower case, without ASCII signs."""
    return text.translate(LOWER, SIGNS)


def masks_of(words: int) -> list[int]:
    """The numbers of the masks that find an item of so many words."""
    long = list(range(len(MASKS)))
    if words >= SHORT:
        return long
    fit = (words - 1,) if words <= 4 else (2, 4)
    return [*long, *(len(MASKS) + i for i in fit if i >= 0)]


def seeds(words: np.ndarray, masks: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each mask its number and the hash at every position where it fits."""
    for number in masks:
        mask = ALL_MASKS[number]
        count = len(words) - mask[-1]
        if count > 0:
            out = np.zeros(count, np.uint64)
            for offset, factor in zip(mask, numbers(21 + number, len(mask))):
                out += words[offset : offset + count] * factor
            yield number, mixed(out)


def best_overlap(same: np.ndarray) -> tuple[int, int, int]:
    """Begin, length and matches of the longest stretch with enough equal words.

    It begins and ends with a match; of stretches as long the first counts. Without one the
    length is 0.
    """
    gain = np.concatenate([[0], np.cumsum(np.where(same, 1 - IDENTITY, -IDENTITY))])
    latest = np.maximum.accumulate(gain[::-1])[::-1]
    begin = length = end = 0
    for start in range(len(same)):
        if same[start]:
            end = max(end, start)
            while end < len(same) and latest[end + 1] >= gain[start] - 1e-9:
                end += 1
            stop = end
            while stop > start and (gain[stop] < gain[start] - 1e-9 or not same[stop - 1]):
                stop -= 1
            if stop - start > length:
                begin, length = start, stop - start
    return begin, length, int(same[begin : begin + length].sum())


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """Items of the benchmark (item_id, text) with the hashes of their words."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher = kept(("hasher",), Hasher)
        texts = (plain(x) for x in byte_texts(batch.column("text")))
        words = []
        for _, hashes, bounds in hasher.texts(texts):
            words += [hashes[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
        yield {"item_id": batch.column("item_id"), "item_words": words}

    known = benchmark.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), "text"
    )
    return map_batches(known, work, "item_id bigint, item_words array<bigint>")


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """Every seed of every item: (seed, item_id, item_at)."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for item, words in zip(*(batch.column(c).to_pylist() for c in ("item_id", "item_words"))):
            for _, found in seeds(np.array(words, np.int64).view(np.uint64), masks_of(len(words))):
                yield {
                    "seed": found.view(np.int64), "item_id": np.full(len(found), item),
                    "item_at": np.arange(len(found)),
                }

    return map_batches(items, work, "seed bigint, item_id bigint, item_at bigint")


SEGMENT = (
    "segment string, doc_id bigint, seg_start bigint, words array<bigint>,"
    " hits array<struct<seed:bigint,at:bigint>>"
)


def hit_segments(
    docs: DataFrame, seen: np.ndarray, reach: int, masks: list[int]
) -> DataFrame:
    """Stretches of documents around seeds that pass the filter, ``reach`` words to either side."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        import uuid

        bits, hasher = shared.value, kept(("hasher",), Hasher)
        doc_ids = batch.column("doc_id").to_pylist()
        texts = (plain(x) for x in byte_texts(batch.column("text")))
        for first, words, bounds in hasher.texts(texts):
            places, values = [], []
            for number, found in seeds(words, masks):
                place = np.flatnonzero(passing(bits, found))
                # A seed must lie within one text.
                owner = np.searchsorted(bounds, place, "right")
                place = place[place + ALL_MASKS[number][-1] < bounds[owner]]
                places.append(place)
                values.append(found[place])
            if not places:
                continue
            place, value = np.concatenate(places), np.concatenate(values).view(np.int64)
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
            owner = np.searchsorted(bounds, place, "right") - 1
            new = np.ones(len(place), bool)
            new[1:] = (np.diff(owner) > 0) | (np.diff(place) > reach)
            cuts = [*np.flatnonzero(new).tolist(), len(place)]
            rows = {f: [] for f in ("segment", "doc_id", "seg_start", "words", "hits")}
            for a, b in zip(cuts[:-1], cuts[1:]):
                low, high = int(bounds[owner[a]]), int(bounds[owner[a] + 1])
                begin = max(low, int(place[a]) - reach)
                end = min(high, int(place[b - 1]) + reach)
                rows["segment"].append(uuid.uuid4().hex)
                rows["doc_id"].append(doc_ids[first + int(owner[a])])
                rows["seg_start"].append(begin - low)
                rows["words"].append(words[begin:end].view(np.int64))
                rows["hits"].append([
                    {"seed": s, "at": p - begin}
                    for s, p in zip(value[a:b].tolist(), place[a:b].tolist())
                ])
            yield rows

    return map_batches(known, work, SEGMENT)


FOUND = (
    "doc_id bigint, item_id bigint, doc_at bigint, item_at bigint, n_words bigint, n_same bigint"
)


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each pair of a document and a benchmark item that share a passage, with the longest one.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Positions and lengths count words
    without signs. A passage has at least 13 words, or the whole item if that is shorter, of which
    four fifths are equal. Items without words, null texts, and rows without an id are never found. Rows with the same doc_id count as one document. Of passages as long the one with
    more equal words counts, then the first. Empty tables give an empty one.
    """
    # Words as hashes; as large as the benchmark, and read four times below.
    path = scratch_path(spark, "items")
    benchmark_words(benchmark).write.parquet(path)
    items = spark.read.parquet(path)
    table = benchmark_seeds(items)
    # Only masks that some item needs are laid on the documents; there is one row per short length.
    size = F.size("item_words")
    lengths = items.select(F.least(size, F.lit(SHORT)).alias("n")).distinct().collect()
    masks = sorted({m for r in lengths for m in masks_of(r["n"])})
    longest = items.agg(F.max(size)).first()[0] or 0
    # A passage lies within an item's length of any of its seeds.
    reach = max(longest, 1) + MASKS[1][-1] + 1

    path = scratch_path(spark, "segments")
    named = docs.where("doc_id IS NOT NULL")
    hit_segments(named, bitmap(table.select("seed"), FILTER_BITS), reach, masks).write.parquet(path)
    segments = spark.read.schema(SEGMENT).parquet(path)

    hits = segments.select("segment", F.inline("hits"))
    diagonals = (
        hits.join(table, "seed")
        .select("segment", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    laid = (
        diagonals.join(segments.select("segment", "doc_id", "seg_start", "words"), "segment")
        .join(items.withColumnRenamed("item_id", "_item"), F.col("item_id") == F.col("_item"))
    )

    def verify(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = {f: [] for f in ("doc_id", "item_id", "doc_at", "item_at", "n_words", "n_same")}
        for r in batch.to_pylist():
            words, item = np.array(r["words"], np.int64), np.array(r["item_words"], np.int64)
            shift = r["diagonal"]
            low, high = max(0, -shift), min(len(item), len(words) - shift)
            begin, length, same = best_overlap(item[low:high] == words[low + shift : high + shift])
            if length >= min(LEAST_WORDS, len(item)):
                rows["doc_id"].append(r["doc_id"])
                rows["item_id"].append(r["item_id"])
                rows["doc_at"].append(r["seg_start"] + low + begin + shift)
                rows["item_at"].append(low + begin)
                rows["n_words"].append(length)
                rows["n_same"].append(same)
        yield rows

    found = map_batches(
        laid.select("doc_id", "item_id", "seg_start", "diagonal", "words", "item_words"), verify,
        FOUND,
    )
    best = F.max(F.struct(
        "n_words", "n_same", (-F.col("doc_at")).alias("d"), (-F.col("item_at")).alias("i")
    ))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", (-F.col("b.d")).alias("doc_at"), (-F.col("b.i")).alias("item_at"),
        "b.n_words", "b.n_same",
    )
