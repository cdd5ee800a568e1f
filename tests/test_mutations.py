"""Mutations with repeated keys, and ordered logs of them against a replay row by row."""

import random

import pytest

from rillflow.operators import mutate
from tests.conftest import rows

TABLE = "id bigint, name string, size int"


def test_the_last_write_of_a_key_wins(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], TABLE)
    batch = spark.createDataFrame([(1, "c", 3, 7), (1, "d", None, 9), (3, "e", 5, 1)], f"{TABLE}, n int")
    assert rows(mutate.put(table, batch, ["id"], ["n"])) == [(1, "d", None), (2, "b", 2), (3, "e", 5)]
    assert rows(mutate.patch(table, batch, ["id"], ["n"])) == [(1, "d", 3), (2, "b", 2)]
    # Without an order it is the last in the batch.
    plain = batch.select("id", "name", "size").coalesce(1)
    assert rows(mutate.put(table, plain, ["id"])) == [(1, "d", None), (2, "b", 2), (3, "e", 5)]
    assert rows(mutate.patch(table, plain, ["id"])) == [(1, "d", 3), (2, "b", 2)]


def replayed(table, log):
    """The log applied one entry after the other."""
    held = {r[0]: list(r[1:]) for r in table}
    rank = {"patch": 0, "put": 1, "delete": 2}
    for key, op, _, name, size in sorted(log, key=lambda e: (e[2], rank[e[1]])):
        if op == "delete":
            held.pop(key, None)
        elif op == "put":
            held[key] = [name, size]
        elif key in held:
            held[key] = [new if new is not None else old for new, old in zip((name, size), held[key])]
    return sorted((k, *v) for k, v in held.items())


@pytest.mark.parametrize("seed", range(4))
def test_a_log_equals_its_replay(spark, seed):
    picked = random.Random(seed)
    table = [(i, f"old{i}", i) for i in range(20)]
    log = [
        (picked.randrange(30), picked.choice(["put", "patch", "patch", "delete"]), n,
         picked.choice([None, f"name{n}"]), picked.choice([None, n]))
        for n in picked.sample(range(-500, 500), 150)
    ]
    out = mutate.apply_log(
        spark.createDataFrame(table, TABLE),
        spark.createDataFrame(log, "id bigint, op string, seq int, name string, size int").repartition(5),
        ["id"], ["seq"],
    )
    key = [tuple(str(x) for x in r) for r in replayed(table, log)]
    assert sorted(tuple(str(x) for x in r) for r in out.collect()) == sorted(key)
    assert out.columns == ["id", "name", "size"]


def test_delete_then_put(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], TABLE)
    log = [(1, "delete", 1, None, None), (1, "patch", 2, "lost", 9), (1, "put", 3, "new", None),
           (1, "patch", 4, None, 8), (2, "patch", 5, "z", None), (2, "delete", 6, None, None),
           (9, "patch", 7, "nobody", 1), (3, "wrong", 8, "x", 1)]
    out = mutate.apply_log(
        table, spark.createDataFrame(log, "id bigint, op string, n int, name string, size int"), ["id"], ["n"]
    )
    assert rows(out) == [(1, "new", 8), (3, "c", 3)]


def test_an_empty_log_and_an_empty_table(spark):
    table = spark.createDataFrame([(1, "a", None)], TABLE)
    log = spark.createDataFrame([], "id bigint, op string, n int, name string")
    assert rows(mutate.apply_log(table, log, ["id"], ["n"])) == [(1, "a", None)]
    entry = spark.createDataFrame([(5, "put", 1, "x")], log.schema)
    assert rows(mutate.apply_log(table.limit(0), entry, ["id"], ["n"])) == [(5, "x", None)]


def test_a_log_is_one_aggregation(spark):
    """A hot key is combined before the shuffle; there is no join and no window."""
    table = spark.createDataFrame([(1, "a", 1)], TABLE)
    log = spark.createDataFrame([(1, "put", 1, "x", 1)], "id bigint, op string, n int, name string, size int")
    plan = mutate.apply_log(table, log, ["id"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("Exchange") <= 1
