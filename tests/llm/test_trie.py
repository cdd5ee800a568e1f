"""The trie against one built turn by turn in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from rillflow.llm import trie
from tests.oracle import compare

TURNS = "conv_id bigint, turn bigint, role string, text string"


def turn_key(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """The nodes of the contract, from dictionaries of whole prefixes."""
    convs = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            convs[row[0]].append(row)
    for turns in convs.values():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, turn_key(r)))
    said = {c: [(r[2] or "", r[3] or "") for r in turns] for c, turns in convs.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    saved, leaves = Counter(), Counter()
    for path, convs_here in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs_here) - 1) * words
            leaves[path[:d]] += path not in children
    out = Counter()
    for path, convs_here in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs_here if whole[c] == path))
        out[(min(convs_here), len(path), min(members[path[:-1]]) if path else None, len(convs_here),
             len(children[path]) if path in children else 0, leaves[path], saved[path],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def sample(seed, convs, depth=6, choices=3):
    picked = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(picked.randrange(1, depth)):
            text = " ".join(["word"] * picked.randrange(0, choices)) + f"\t{picked.randrange(choices)}"
            rows.append((c * picked.choice([1, 1, 3]), t, picked.choice(["user", "assistant"]), text))
    return rows


def found(spark, rows, most=trie.CONTAINER, schema=TURNS):
    df = spark.createDataFrame(rows, schema)
    return Counter(tuple(r) for r in trie.prefix_trie(spark, df, most).select(*trie.NODES).collect())


def awkward():
    rows = sample(1, 60)
    rows += [(None, 0, "user", "lost"), (7, None, "user", "before all"), (7, None, None, None),
             (8, 0, "a", "b"), (8, 0, "a", "b"), (9, 0, "ab", "c"), (10, 0, "a", "bc"), (11, 5, "", ""),
             (12, 5, None, ""), (-5, 0, "user", "below zero"), (-25, 0, "user", "below zero"),
             (401, 0, "user", "only one turn"), (402, 0, "user", "only one turn"), (9000, 0, "x", "y " * 9000)]
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    rows += [(2000 + i, t, "user", f"long {t}" if t < 150 else f"{i}") for i in range(6) for t in range(160)]
    return rows


def test_one_container(spark):
    rows = awkward()
    more = [(*r, 1, "s", b"p", 3) for r in rows]
    schema = f"{TURNS}, depth int, seq string, path binary, n int"
    assert found(spark, more, schema=schema) == brute(rows)


@pytest.mark.parametrize("most", [1, 2, 5, 20])
def test_burst_containers(spark, most):
    rows = awkward()
    assert found(spark, rows, most) == brute(rows)


def test_plain_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(trie, "LOOK", 1)
    rows = sample(4, 80, depth=5, choices=2)
    assert found(spark, rows, 3) == brute(rows)


def test_ids_of_a_frequent_conversation_come_in_order(spark):
    rows = [(i * 20, 0, "user", "hello") for i in range(30_000)]
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    nodes = [r.asDict() for r in trie.prefix_trie(spark, df).collect()]
    ends = ",".join(str(i * 20) for i in range(30_000))
    assert {(n["depth"], n["n_convs"], n["ends_sha256"]) for n in nodes} == {
        (0, 30_000, trie.NO_ENDS), (1, 30_000, hashlib.sha256(ends.encode()).hexdigest())}


def test_conversations_without_turns_left(spark):
    """A conversation that loses all turns and takes none over ends at the root."""
    lone = [c for c in range(20, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:3]
    rows = [(c, 0, "user", "gone") for c in lone]
    assert found(spark, rows) == brute(rows)
    (node,) = found(spark, rows)
    assert node[1:3] == (0, None) and node[3] == 3 and node[5] == 1


def test_empty_table(spark):
    assert found(spark, []) == Counter()
    assert found(spark, [(None, 1, "a", "b")]) == Counter()


def test_sql_twin(spark):
    import duckdb
    import pandas as pd

    rows = [r for r in awkward()]
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    frame["conv_id"], frame["turn"] = frame["conv_id"].astype("Int64"), frame["turn"].astype("Int64")
    db = duckdb.connect()
    db.register("frame", frame)
    db.execute("CREATE VIEW conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id,"
               " CAST(turn AS BIGINT) AS turn, role, text FROM frame")
    df = spark.createDataFrame(rows, TURNS)
    assert compare(trie.prefix_trie(spark, df, 4), db, trie.TRIE_SQL) == ""
