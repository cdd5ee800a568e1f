"""Prefix trie of conversations as a burst trie.

Equal conversations are one sequence of turn ids. All sequences begin in the container of the root.
A container with too many of them bursts: it becomes a node of the trie heads, and its suffixes go
to containers by their next turn id. One look counts several turns ahead, so deep heads take few
rounds. Containers are then dealt to shards, sorted and swept into nodes, and what the sweeps find
at the top of each container is added up along the heads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.llm.arrow import struct_of, to_arrow_schema
from rillflow.llm.scratch import saved

# Conversations take up to this many turns from the first one of their group of so many ids.
SHARED_TURNS, GROUP_IDS = 3, 20
# Different sequences that a container may hold.
CONTAINER = 2048
# Turns that the first look goes ahead; each further look goes twice as far, up to the most.
LOOK, MOST_LOOK = 4, 64
# Prefixes of the heads that may be sent to every executor, about 100 bytes each.
BROADCAST_ROWS = 200_000
WORD = r"[^\x20\x09-\x0D]+"
ID_BYTES = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
NODES = [f.split()[0] for f in NODE.split(", ")]
SWEPT = f"{NODE}, path binary, path_words array<int>"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its shared first turns: (conv_id, seq, words).

    ``seq`` is the ids of its turns, 16 bytes each, and ``words`` their numbers of words. A null
    role or text is empty. Turns are in order of their number, null first, and of their ids where
    numbers are equal. Turns without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("bigint")
    turns = conversations.where("conv_id IS NOT NULL").select(
        conv.alias("conv_id"), (conv - conv % GROUP_IDS).alias("base"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("t"),
    )
    # One shuffle serves the grouping and the group's first conversation.
    whole = turns.repartition("base").groupBy("base", "conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("own")
    )
    head = F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, SHARED_TURNS))
    shared = F.first(head, ignorenulls=True).over(Window.partitionBy("base"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED_TURNS + 1)).cast("int")
    turns = F.concat(
        F.slice(F.coalesce("shared", F.slice("own", 1, 0)), F.lit(1), F.col("taken")),
        F.slice("own", F.col("taken") + 1, F.size("own")),
    )
    return whole.select("conv_id", "own", shared.alias("shared"), taken.alias("taken")).select(
        "conv_id", turns.alias("turns")
    ).select(
        "conv_id", F.unhex(F.array_join(F.col("turns.id"), "")).alias("seq"),
        F.col("turns.words").alias("words"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of a class as one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        classes = batch.column("class").to_pylist()
        ids = batch.column("conv_id").to_pylist()
        cuts = [0, *[i for i in range(1, len(ids)) if classes[i] != classes[i - 1]], len(ids)]
        yield pa.RecordBatch.from_pydict({
            "class": [classes[a] for a in cuts[:-1]], "first": [ids[a] for a in cuts[:-1]],
            "members": [b - a for a, b in zip(cuts, cuts[1:])],
            "ids": [",".join(map(str, ids[a:b])) for a, b in zip(cuts, cuts[1:])],
        })


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a class, in order, as one digest; a run is held at a time."""
    schema = pa.schema(
        [("class", pa.binary()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())]
    )
    now = digest = None
    first = members = 0

    def row() -> dict:
        return {"class": now, "conv_id": first, "n": members, "ends": digest.hexdigest()}

    for batch in batches:
        out = []
        for run in batch.to_pylist():
            if run["class"] == now:
                digest.update(b",")
            else:
                if now is not None:
                    out.append(row())
                now, first, members, digest = run["class"], run["first"], 0, hashlib.sha256()
            digest.update(run["ids"].encode())
            members += run["members"]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def sequences(spark: SparkSession, whole: DataFrame) -> DataFrame:
    """Each different sequence once, with the smallest id, the number and the digest of its ids.

    Ids are brought into order by ranges of (sequence, id), so those of a frequent sequence come
    from many tasks, as runs, and only the runs meet.
    """
    named = saved(spark, whole.withColumn("class", F.unhex(F.md5("seq"))), "conversations")
    runs = (
        named.select("class", "conv_id").repartitionByRange("class", "conv_id")
        .sortWithinPartitions("class", "conv_id")
        .mapInArrow(_runs, "class binary, first bigint, members bigint, ids string")
    )
    ends = runs.repartition("class").sortWithinPartitions("class", "first").mapInArrow(
        _digests, "class binary, conv_id bigint, n bigint, ends string"
    )
    # The smallest id of a class has its sequence.
    return saved(spark, named.join(ends, ["class", "conv_id"]).select(
        "seq", "words", "conv_id", "n", "ends",
    ), "sequences")


def _prefix(seq: str, depth: Column) -> Column:
    return F.substring(F.col(seq), F.lit(1), (depth * ID_BYTES).cast("int"))


def _key(seq: str, depth: Column) -> Column:
    return F.md5(_prefix(seq, depth))


def _checked(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def burst(spark: SparkSession, distinct: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The rows of ``distinct`` with the depth of their container's head, and whether any burst.

    ``head`` is null for a sequence that ends within the heads. ``most`` different sequences may
    stay in one container.
    """
    held = distinct.withColumn("size", F.size("words"))
    if distinct.count() <= most:
        return held.withColumn("head", F.lit(0)), False
    done, open_rows, depth, look = [], held, 0, LOOK
    while True:
        # Everything open has this depth, and its prefix is a burst container.
        reach = F.least(F.col("size"), F.lit(depth + look))
        ahead = (
            open_rows.where(F.col("size") > depth)
            .select("conv_id", "seq", F.explode(F.sequence(F.lit(depth + 1), reach)).alias("at"))
            .select("conv_id", "at", _key("seq", F.col("at")).alias("key"))
        )
        bursts = saved(
            spark, ahead.groupBy("key").count().where(F.col("count") > most).select("key"), "bursts"
        )
        count = bursts.count()
        deepest = (
            ahead.join(_checked(bursts, count), "key", "left_semi")
            .groupBy("conv_id").agg(F.max("at").alias("burst"))
        )
        burst_at = F.coalesce("burst", F.lit(depth))
        placed = saved(spark, open_rows.join(deepest, "conv_id", "left").select(
            *held.columns, burst_at.alias("burst")
        ), "placed")
        again = (F.col("burst") == depth + look) & (F.col("size") > depth + look)
        done.append(placed.where(~again).select(
            *held.columns, F.when(F.col("size") > F.col("burst"), F.col("burst") + 1).alias("head")
        ))
        open_rows = placed.where(again).select(*held.columns)
        depth, look = depth + look, min(2 * look, MOST_LOOK)
        if open_rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, True


class Sweep:
    """Nodes of one container from its sequences in order; only open nodes are held."""

    def __init__(self, head: int):
        self._head, self._last, self._open = head, b"", []
        self._first: tuple[bytes, list[int]] | None = None

    def add(self, seq: bytes, words: list[int], conv: int, members: int, ends: str) -> Iterator[tuple]:
        """Take the next sequence; gives the nodes whose parents it closes."""
        size = len(seq) // ID_BYTES
        if self._first is None:
            self._first = (seq[: self._head * ID_BYTES], words[: self._head])
            self._push(self._head, words)
        else:
            same = min(len(seq), len(self._last))
            a, b = (np.frombuffer(x, np.uint8, same) for x in (seq, self._last))
            other = np.flatnonzero(a != b)
            common = (int(other[0]) if len(other) else same) // ID_BYTES
            while len(self._open) - 1 + self._head > common:
                yield from self._close()
        for depth in range(self._head + len(self._open), size + 1):
            self._push(depth, words)
        node = self._open[-1]
        node[1], node[2], node[6] = min(node[1], conv), node[2] + members, ends
        self._last = seq

    def _push(self, depth: int, words: list[int]) -> None:
        # depth, smallest id, members, leaves, saved, words, ends, closed children
        self._open.append([depth, 1 << 63, 0, 0, 0, words[depth - 1] if depth else 0, NO_ENDS, []])

    def _close(self) -> Iterator[tuple]:
        """Close the deepest node; gives its children, which now know their parent."""
        depth, conv, members, leaves, tokens, words, ends, children = self._open.pop()
        node = (conv, depth, members, len(children), leaves or 1, tokens + (members - 1) * words, ends)
        for child in children:
            yield (child[0], child[1], conv, *child[2:], None, None)
        if self._open:
            above = self._open[-1]
            above[1], above[2] = min(above[1], conv), above[2] + members
            above[3], above[4] = above[3] + node[4], above[4] + node[5]
            above[7].append(node)
        else:
            yield (node[0], node[1], None, *node[2:], *self._first)

    def end(self) -> Iterator[tuple]:
        """Close what is open; the top comes last, with the path from the root to it."""
        while self._open:
            yield from self._close()


BATCH_ROWS = 8192


def sweep(containers: DataFrame) -> DataFrame:
    """The nodes of all containers (container, head, seq, words, conv_id, n, ends).

    The top node of a container has no parent yet and carries its ``path``.
    """
    names = [f.name for f in struct_of(SWEPT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            container, now = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["container"] != container:
                        if now:
                            yield from now.end()
                        container, now = row["container"], Sweep(row["head"])
                    yield from now.add(
                        row["seq"], row["words"], row["conv_id"], row["n"], row["ends"]
                    )
            if now:
                yield from now.end()

        held: list[tuple] = []
        for node in nodes():
            held.append(node)
            if len(held) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], names=names
                )
                held = []
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], names=names
            )

    schema = to_arrow_schema(struct_of(SWEPT))
    shards = containers.repartition("container").sortWithinPartitions("container", "seq")
    return shards.select(
        "container", "head", "seq", "words", "conv_id", "n", "ends"
    ).mapInArrow(run, SWEPT)


def _above(rows: DataFrame, last: Column, *columns: Column) -> DataFrame:
    """A row of (key, at, path, path's last words, ...) for each prefix of ``path`` up to ``last``."""
    at = F.col("at")
    return rows.withColumn("at", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        _key("path", at).alias("key"), "at", _prefix("path", at).alias("path"),
        F.when(at > 0, F.get("path_words", at - 1)).otherwise(0).cast("bigint").alias("w"), *columns,
    )


def head_nodes(spark: SparkSession, tops: DataFrame, ended: DataFrame) -> DataFrame:
    """The burst containers as nodes: NODE and ``key``.

    ``tops`` are the tops of the containers below them, ``ended`` the sequences that end there.
    """
    at, nothing = F.col("at"), F.lit(0).cast("bigint")
    below = _above(
        tops, F.col("depth") - 1, "conv_id", F.col("n_convs").alias("n"), "n_leaves", "saved_tokens",
        (at == F.col("depth") - 1).cast("bigint").alias("tops"), F.lit(None).cast("string").alias("ends"),
    )
    here = _above(
        ended.withColumnsRenamed({"seq": "path", "words": "path_words"}), F.col("size"), "conv_id", "n",
        nothing.alias("n_leaves"), nothing.alias("saved_tokens"), nothing.alias("tops"),
        F.when(at == F.col("size"), F.col("ends")).alias("ends"),
    )
    heads = saved(spark, below.unionByName(here).groupBy("key", "at").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("tops").alias("tops"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"),
        F.max("ends").alias("ends"), F.max("w").alias("w"), F.max("path").alias("path"),
    ), "heads")
    # What the heads themselves save counts in all heads above them.
    own = heads.withColumn("path_words", F.array().cast("array<int>")).withColumn(
        "own", (F.col("n_convs") - 1) * F.col("w")
    )
    own = _above(own.withColumnRenamed("at", "depth"), F.col("depth"), "own").groupBy("key").agg(
        F.sum("own").alias("own")
    )
    linked = heads.where(at > 0).select(_key("path", at - 1).alias("key"))
    children = linked.groupBy("key").agg(F.count("*").alias("heads"))
    parents = heads.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        heads.join(own, "key").join(children, "key", "left")
        .withColumn("parent", F.when(at > 0, _key("path", at - 1)))
        .join(parents, "parent", "left")
        .select(
            "conv_id", at.cast("bigint").alias("depth"), "parent_conv_id", "n_convs",
            (F.col("tops") + F.coalesce("heads", nothing)).alias("n_children"), "n_leaves",
            (F.col("below") + F.col("own")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"), "key",
        )
    )


def prefix_trie(spark: SparkSession, conversations: DataFrame, most: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Repeated turns stay. Other columns are ignored. An empty table has no nodes, not even a root.
    A conversation is one row of 20 bytes a turn while its trie is built; texts are not moved.
    """
    placed, any_burst = burst(spark, sequences(spark, rebuilt(conversations)), most)
    inside = placed.where("head IS NOT NULL").withColumn("container", _key("seq", F.col("head")))
    swept = saved(spark, sweep(inside), "nodes")
    if not any_burst:
        return swept.select(*NODES)
    tops = swept.where("path IS NOT NULL")
    heads = saved(spark, head_nodes(spark, tops, placed.where("head IS NULL")), "heads")
    parents = heads.select("key", F.col("conv_id").alias("above"))
    linked = (
        tops.withColumn("key", _key("path", F.col("depth") - 1))
        .join(_checked(parents, heads.count()), "key")
        .withColumn("parent_conv_id", F.col("above"))
    )
    return swept.where("path IS NULL").select(*NODES).unionByName(
        linked.select(*NODES)
    ).unionByName(heads.select(*NODES))


# CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: unicode(c)::BIGINT)),
  lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_HASH = "md5(length(r)::VARCHAR || ':' || r || x)"
# The same trie for DuckDB.
TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL
), u AS (
  SELECT conv_id, {_CRC.format("conv_id")} % {SHARED_TURNS + 1} AS h,
    list({_HASH} ORDER BY turn NULLS FIRST, {_HASH}) AS ids,
    list(len(regexp_extract_all(x, '{WORD}')) ORDER BY turn NULLS FIRST, {_HASH}) AS ws
  FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ids, [])[1:c.h], c.ids[c.h + 1:]) AS ids,
    list_concat(coalesce(b.ws, [])[1:c.h], c.ws[c.h + 1:]) AS ws
  FROM u c LEFT JOIN u b ON b.conv_id = c.conv_id - c.conv_id % {GROUP_IDS}
), p AS (
  SELECT conv_id, ids, ws, unnest(range(0, len(ids) + 1)) AS d FROM r
), n AS (
  SELECT array_to_string(ids[1:d], '') AS k, d, min(conv_id) AS conv_id, count(*) AS n,
    any_value(CASE WHEN d > 0 THEN ws[d] ELSE 0 END) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
      FILTER (d = len(ids)), '')) AS e
  FROM p GROUP BY k, d
), kids AS (
  SELECT left(k, 32 * (d::INT - 1)) AS k, count(*) AS c FROM n WHERE d > 0 GROUP BY 1
), a AS (
  SELECT n.k, n.n, n.w, kids.c IS NULL AS leaf, unnest(range(0, d + 1)) AS j
  FROM n LEFT JOIN kids USING (k)
), s AS (
  SELECT left(k, 32 * j::INT) AS k, sum((n - 1) * w) AS saved, count(*) FILTER (leaf) AS leaves
  FROM a GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n AS n_convs,
  coalesce(kids.c, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.e AS ends_sha256
FROM n JOIN s USING (k) LEFT JOIN kids USING (k)
LEFT JOIN n up ON n.d > 0 AND up.k = left(n.k, 32 * (n.d::INT - 1)) AND up.d = n.d - 1
"""
