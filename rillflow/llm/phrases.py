"""Substring dedup by automata over repeated passages.

A window of 13 words goes wherever its words also start in a document with a smaller doc_id.

1. Every 13 words hold one of the fingerprints of a text, the least of nine successive 5-word
   hashes. Fingerprints of two documents or more are counted out; the smallest document with a
   fingerprint is its owner.
2. Stretches around such fingerprints are cut by owner, so that whatever two documents share lies
   in stretches of the same owner. Exact copies of a text are left out and judged whole.
3. The windows of the stretches are counted: those of two documents or more are confirmed, and
   their first documents give them as passages.
4. Owners are dealt to shards. A shard compiles automata from its passages, a bounded number of
   windows at a time, and streams the stretches of their owners through them. Shards with many
   stretches or passages are split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.arrow import byte_texts, map_batches
from rillflow.llm.filters import bitmap, passing, row_slot
from rillflow.llm.scratch import saved
from rillflow.llm.words import Hasher, windows
from rillflow.llm.worker import kept

WIDTH = 13
GRAM = 5
# Successive grams of which one is a fingerprint: together they span a window.
RUN = WIDTH - GRAM + 1
FINGERPRINT_BITS = 48
FILTER_BITS = 1 << 25
ROW_FILTER_BITS = 1 << 23
# Windows of one automaton, pattern words of a shard, and streamed words of a split.
AUTOMATON_WINDOWS = 20_000
SHARD_WORDS = 100_000
SPLIT_WORDS = 500_000
# Where the two alphabets of a shard begin, both below the surrogates.
HIGH_CHARS, LOW_CHARS = 0x100, 0x4000


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the fingerprints of some texts."""
    grams = windows(hashes, GRAM) >> np.uint64(64 - FINGERPRINT_BITS)
    if len(grams) < RUN:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, RUN)
    starts = np.arange(len(runs))
    # The window must lie within one text.
    inside = starts + WIDTH <= bounds[np.searchsorted(bounds, starts, "right")]
    starts = starts[inside]
    places = np.unique(starts + runs[inside].argmin(1))
    return places, grams[places]


def _squeezed(data: bytes) -> bytes:
    from zstandard import ZstdCompressor

    return kept(("squeeze",), lambda: ZstdCompressor(level=1)).compress(data)


def _unsqueezed(data: bytes) -> bytes:
    from zstandard import ZstdDecompressor

    return kept(("unsqueeze",), ZstdDecompressor).decompress(data)


def _words(data: bytes) -> list[bytes]:
    return _unsqueezed(data).split()


def _runs(places: np.ndarray, span: int) -> list[tuple[int, int]]:
    """The ranges covered by stretches of ``span`` at ascending places."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > span) + 1
    return [(int(p[0]), int(p[-1]) + span) for p in np.split(places, cuts)]


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """The fingerprints of every document: (fp, doc_id)."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher = kept(("hasher",), Hasher)
        doc_ids = batch.column("doc_id").to_numpy()
        for first, hashes, bounds in hasher.texts(byte_texts(batch.column("text"))):
            places, values = fingerprints(hashes, bounds)
            if len(places):
                owner = np.searchsorted(bounds, places, "right") - 1
                yield {"fp": values.view(np.int64), "doc_id": doc_ids[first + owner]}

    return map_batches(docs.select("doc_id", "text"), work, "fp bigint, doc_id bigint")


STRETCH = (
    "doc_id bigint, key bigint, part bigint, start bigint, words binary,"
    " fp array<bigint>, at array<bigint>"
)


def _lists(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Values cut into lists that begin at ``firsts``, the first of them at 0."""
    return pa.LargeListArray.from_arrays(np.append(firsts, len(values)), values).cast(
        pa.list_(pa.int64())
    )


def _ranks(groups: np.ndarray) -> np.ndarray:
    """The place of every row in its run of equal groups."""
    rows = np.arange(len(groups))
    new = np.append(True, groups[1:] != groups[:-1])[: len(groups)]
    return rows - np.maximum.accumulate(np.where(new, rows, 0))


def candidate_stretches(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """Stretches of documents around fingerprints that pass the filter, with these."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hasher, bits = kept(("hasher",), Hasher), shared.value
        doc_ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "key"))
        texts = byte_texts(batch.column("text"))
        for first, hashes, bounds, data, starts, ends in hasher.placed(texts):
            places, values = fingerprints(hashes, bounds)
            held = passing(bits, values)
            places, values = places[held], values[held].view(np.int64)
            if not len(places):
                continue
            text = np.searchsorted(bounds, places, "right") - 1
            reach = np.maximum(places - RUN + 1, bounds[text])
            apart = (reach[1:] > places[:-1] + WIDTH) | (text[1:] != text[:-1])
            firsts = np.append(0, np.flatnonzero(apart) + 1)
            lasts = np.append(firsts[1:], len(places)) - 1
            text_of, begin = text[firsts], reach[firsts]
            end = np.minimum(bounds[text_of + 1], places[lasts] + WIDTH)
            yield {
                "doc_id": doc_ids[first + text_of],
                "key": keys[first + text_of],
                "part": _ranks(text_of),
                "start": begin - bounds[text_of],
                "words": [
                    _squeezed(data[a:b])
                    for a, b in zip(starts[begin].tolist(), ends[end - 1].tolist())
                ],
                "fp": _lists(values, firsts),
                "at": _lists(places - np.repeat(begin, lasts - firsts + 1), firsts),
            }

    return map_batches(docs.select("doc_id", "key", "text"), work, STRETCH)


OWNED = "owner bigint, doc_id bigint, key bigint, start bigint, n_words bigint, words binary"


def owned_stretches(stretches: DataFrame, owners: DataFrame, copies: DataFrame) -> DataFrame:
    """Stretches cut by the owner of their fingerprints, without exact copies."""
    names = ["doc_id", "key", "part"]
    marks = (
        stretches.select(*names, F.inline(F.arrays_zip("fp", "at")))
        .join(copies, ["doc_id", "key"], "left_anti")
        .join(owners, "fp")
        .groupBy(*names).agg(F.collect_list(F.struct("owner", "at")).alias("owned"))
    )

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        owned = batch.column("owned")
        owner, at = (x.to_numpy(False) for x in owned.flatten().flatten())
        row = np.repeat(np.arange(batch.num_rows), owned.value_lengths().to_numpy(False))
        order = np.lexsort((at, owner, row))
        row, owner, at = row[order], owner[order], at[order]
        apart = (
            (row[1:] != row[:-1]) | (owner[1:] != owner[:-1])
            | (np.maximum(at[1:] - RUN + 1, 0) > at[:-1] + WIDTH)
        )
        firsts = np.append(0, np.flatnonzero(apart) + 1)
        lasts = np.append(firsts[1:], len(at)) - 1
        row, owner = row[firsts], owner[firsts]
        begin, end = np.maximum(at[firsts] - RUN + 1, 0), at[lasts] + WIDTH
        sizes, pieces, words, last = [], [], [], -1
        texts = batch.column("words")
        for r, a, b in zip(row.tolist(), begin.tolist(), end.tolist()):
            if r != last:
                words, last = _words(texts[r].as_py()), r
            piece = words[a:b]
            sizes.append(len(piece))
            pieces.append(_squeezed(b" ".join(piece)))
        yield {
            "owner": owner,
            "doc_id": batch.column("doc_id").to_numpy()[row],
            "key": batch.column("key").to_numpy()[row],
            "start": batch.column("start").to_numpy()[row] + begin,
            "n_words": sizes,
            "words": pieces,
        }

    kept_columns = stretches.drop("fp", "at").join(marks, names)
    return map_batches(kept_columns, work, OWNED)


def _found_windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of texts every window, the text it is in, and its place in the group."""
    hasher = kept(("hasher",), Hasher)
    for first, hashes, bounds in hasher.texts(texts):
        found = windows(hashes, WIDTH).view(np.int64)
        starts = np.arange(len(found))
        row = np.searchsorted(bounds, starts, "right")
        inside = starts + WIDTH <= bounds[row]
        yield found[inside], first + row[inside] - 1, starts[inside] - bounds[row[inside] - 1]


def confirmed_windows(owned: DataFrame) -> DataFrame:
    """Windows of two documents or more with the first of them: (window, first)."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        doc_ids = batch.column("doc_id").to_numpy()
        texts = [_unsqueezed(x) for x in batch.column("words").to_pylist()]
        for found, text, _ in _found_windows(texts):
            yield {"window": found, "doc_id": doc_ids[text]}

    rows = map_batches(owned.select("doc_id", "words"), work, "window bigint, doc_id bigint")
    return (
        rows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last")).select("window", "first")
    )


PASSAGE = "owner bigint, first bigint, n_words bigint, passage binary"


def first_passages(owned: DataFrame, confirmed: DataFrame) -> DataFrame:
    """The confirmed windows as passages of their first documents."""
    lists = confirmed.groupBy("first").agg(F.collect_list("window").alias("found"))
    pieces = owned.groupBy("doc_id").agg(F.collect_list(F.struct("owner", "words")).alias("pieces"))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        # A window has one first document, so those of a batch can be looked up together.
        wanted = batch.column("found").flatten().to_numpy(False)
        sizes = batch.column("found").value_lengths().to_numpy(False)
        document = np.repeat(np.arange(batch.num_rows), sizes)
        order = np.argsort(wanted)
        wanted, document = wanted[order], document[order]
        held = batch.column("pieces")
        owners, squeezed = held.flatten().flatten()
        row = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy(False))
        owners, firsts = owners.to_numpy(False), batch.column("first").to_numpy()
        texts = [_unsqueezed(x) for x in squeezed.to_pylist()]
        rows = {f: [] for f in ("owner", "first", "n_words", "passage")}
        for found, text, at in _found_windows(texts):
            near = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
            own = (wanted[near] == found) & (document[near] == row[text])
            text, at = text[own], at[own]
            if not len(at):
                continue
            # Runs of windows one after the other are one passage.
            apart = (text[1:] != text[:-1]) | (np.diff(at) > 1)
            begins = np.append(0, np.flatnonzero(apart) + 1)
            lasts = np.append(begins[1:], len(at)) - 1
            words, last = [], -1
            for t, a, b in zip(text[begins].tolist(), at[begins].tolist(), at[lasts].tolist()):
                if t != last:
                    words, last = texts[t].split(), t
                rows["owner"].append(int(owners[t]))
                rows["first"].append(int(firsts[row[t]]))
                rows["n_words"].append(b + WIDTH - a)
                rows["passage"].append(_squeezed(b" ".join(words[a : b + WIDTH])))
        yield rows

    return map_batches(pieces.join(lists, F.col("doc_id") == F.col("first")), work, PASSAGE)


class _Lexicon:
    """Words of a shard as pairs of characters.

    An automaton searches the children of a node one by one, and a node has as many as there are
    words that can follow. Two characters from small alphabets keep that number near the square
    root, and as the alphabets differ, a match can only begin where a word does.
    """

    def __init__(self, words: Iterable[bytes]):
        numbered = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
        base = int(len(numbered) ** 0.5) + 2
        self._pairs = {
            w: chr(HIGH_CHARS + i // base) + chr(LOW_CHARS + i % base) for w, i in numbered.items()
        }
        self._other = chr(HIGH_CHARS) + chr(LOW_CHARS)

    def text(self, words: list[bytes]) -> str:
        pairs, other = self._pairs, self._other
        return "".join([pairs.get(w, other) for w in words])


def _automata(passages: list[tuple[int, list[bytes]]], lexicon: _Lexicon) -> Iterator:
    """Automata over the windows of passages, each of a bounded number of windows.

    The value of a window is the first of the documents that have it.
    """
    import ahocorasick

    firsts: dict[str, int] = {}
    for first, words in sorted(passages, key=lambda p: p[0]):
        text = lexicon.text(words)
        for i in range(0, len(text) - 2 * WIDTH + 1, 2):
            firsts.setdefault(text[i : i + 2 * WIDTH], first)
    windows_left = iter(firsts.items())
    while chunk := list(islice(windows_left, AUTOMATON_WINDOWS)):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for window, first in chunk:
            automaton.add_word(window, first)
        automaton.make_automaton()
        yield automaton


COVERED = "doc_id bigint, key bigint, begin bigint, end bigint"


def locate(key, passages: pd.DataFrame, stretches: pd.DataFrame) -> pd.DataFrame:
    """Ranges of words of a shard's stretches that windows of smaller documents cover.

    A stretch can only hold passages of its own owner. Owners are taken some at a time, as many as
    fill an automaton, and only their stretches are streamed.
    """
    rows: list[tuple[int, int, int, int]] = []
    passages = passages.sort_values("owner", kind="stable")
    filled = (passages["n_words"] - WIDTH + 1).cumsum() // AUTOMATON_WINDOWS
    by_owner = stretches.groupby("owner").indices
    for _, some in passages.groupby(filled.to_numpy()):
        at = [by_owner[o] for o in some["owner"].unique() if o in by_owner]
        if not at:
            continue
        mine = stretches.iloc[np.concatenate(at)]
        known = [(int(f), _words(x)) for f, x in zip(some["first"], some["passage"])]
        lexicon = _Lexicon(w for _, words in known for w in words)
        texts = [lexicon.text(_words(x)) for x in mine["words"]]
        names = list(zip(mine["doc_id"], mine["key"], mine["start"]))
        for automaton in _automata(known, lexicon):
            for text, (doc, name, start) in zip(texts, names):
                ends = [end >> 1 for end, first in automaton.iter(text) if first < doc]
                for begin, end in _runs(np.array(ends, np.int64) - WIDTH + 1, WIDTH):
                    rows.append((doc, name, start + begin, start + end))
    return pd.DataFrame(rows, columns=["doc_id", "key", "begin", "end"])


def covered_ranges(owned: DataFrame, passages: DataFrame) -> DataFrame:
    """Ranges of words to remove, found by the automata of all shards.

    A shard with many stretches is split by these, each split with all passages; one with many
    passages, for an owner may have more than a shard should, also by these.
    """
    total = passages.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).alias("shard")
    streamed, patterns = owned.select("*", shard), passages.select("*", shard)

    def ways(df: DataFrame, words: int, name: str) -> DataFrame:
        return df.groupBy("shard").agg(F.ceil(F.sum("n_words") / words).cast("int").alias(name))

    # One row per shard.
    cuts = ways(streamed, SPLIT_WORDS, "splits").join(
        ways(patterns, 2 * SHARD_WORDS, "parts"), "shard"
    )

    def each(name: str):
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    stretches = streamed.join(cuts, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id", "start"), F.col("splits")).cast("int").alias("split"),
        each("parts").alias("part"), "owner", "doc_id", "key", "start", "words",
    )
    patterns = patterns.join(cuts, "shard").select(
        "shard", each("splits").alias("split"),
        F.pmod(F.xxhash64("first", "passage"), F.col("parts")).cast("int").alias("part"),
        "owner", "first", "n_words", "passage",
    )
    names = ["shard", "split", "part"]
    return (
        patterns.groupBy(*names).cogroup(stretches.groupBy(*names)).applyInPandas(locate, COVERED)
    )


DEDUPED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"


def remove_repeated(spark: SparkSession, docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) without the words of repeated windows.

    Words are runs without ASCII white space; kept words are joined by one space. A null text has
    no words. A row without a doc_id is neither changed nor a source. Rows with the same doc_id
    are not repeats of each other. Texts of fewer than 13 words stay. An empty table gives an
    empty one. ``with_text`` adds the kept text.
    """
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    usable = named.where("doc_id IS NOT NULL")

    # Copies are told by 128 bits. Only repeated texts are kept, so this table is seldom large.
    texts = usable.select("doc_id", "key", F.xxhash64(F.lit(1), "text").alias("more"))
    firsts = saved(
        spark,
        texts.groupBy("key", "more").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n"),
        "firsts",
    )
    copies = (
        texts.join(firsts, ["key", "more"]).where("doc_id > first")
        .select("doc_id", "key").distinct()
    )
    owners = (
        fingerprint_rows(usable)
        .groupBy("fp").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        .where(F.col("owner") < F.col("last")).select("fp", "owner")
    )
    owners = saved(spark, owners, "owners")
    seen = bitmap(owners.select("fp"), FILTER_BITS)
    stretches = saved(spark, candidate_stretches(usable, seen), "stretches")
    owned = saved(spark, owned_stretches(stretches, owners, copies), "owned")
    passages = saved(spark, first_passages(owned, confirmed_windows(owned)), "passages")
    ranges = covered_ranges(owned, passages)
    whole = copies.select("doc_id", "key", F.lit(0).alias("begin"), F.lit(-1).alias("end"))
    changes = saved(spark, ranges.unionByName(whole), "ranges")

    touched = changes.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("begin", "end")).alias("ranges")
    )
    slots = bitmap(changes.select(row_slot("doc_id", "key").alias("slot")), ROW_FILTER_BITS)
    return _finished(named, touched, slots, with_text)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _finished(
    named: DataFrame, touched: DataFrame, slots: np.ndarray, with_text: bool
) -> DataFrame:
    """Rows that nothing touches are finished where they are read; only others are joined."""
    shared = named.sparkSession.sparkContext.broadcast(slots)

    def scan(batch: pa.RecordBatch) -> Iterator[dict]:
        known = batch.column("doc_id").is_valid().to_numpy(False)
        slot = batch.column("slot").to_numpy(False).view(np.uint64)
        maybe = known & passing(shared.value, slot)
        rows = {f: [] for f in ("n_words", "kept_sha256", "kept_text", "words")}
        for may, text in zip(maybe.tolist(), byte_texts(batch.column("text"))):
            words = text.split()
            rows["n_words"].append(len(words))
            rows["words"].append(_squeezed(text) if may else None)
            rows["kept_sha256"].append(None if may else _digest(words))
            rows["kept_text"].append(b" ".join(words).decode() if with_text and not may else None)
        yield {"doc_id": batch.column("doc_id"), "key": batch.column("key"), **rows}

    scanned = map_batches(
        named.withColumn("slot", row_slot("doc_id", "key")), scan,
        "doc_id bigint, key bigint, n_words bigint, kept_sha256 string, kept_text string,"
        " words binary",
    )

    def finish(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = {f: [] for f in ("n_removed", "kept_sha256", "kept_text")}
        columns = ("n_words", "kept_sha256", "kept_text", "words", "ranges")
        for count, digest, text, data, ranges in zip(
            *(batch.column(c).to_pylist() for c in columns)
        ):
            removed = 0
            if data is not None:
                words = _words(data)
                keep = np.ones(count, bool)
                for r in ranges or []:
                    if r["end"] >= 0:
                        keep[r["begin"] : r["end"]] = False
                    elif count >= WIDTH:
                        keep[:] = False
                left = [words[i] for i in np.flatnonzero(keep)]
                removed, digest = count - len(left), _digest(left)
                text = b" ".join(left).decode() if with_text else None
            rows["n_removed"].append(removed)
            rows["kept_sha256"].append(digest)
            rows["kept_text"].append(text)
        yield {"doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), **rows}

    joined = scanned.join(touched, ["doc_id", "key"], "left")
    out = map_batches(
        joined.select("doc_id", "n_words", "kept_sha256", "kept_text", "words", "ranges"), finish,
        DEDUPED,
    )
    return out if with_text else out.drop("kept_text")
