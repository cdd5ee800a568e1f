"""The sliced path for hot keys equals a plain scan and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from rillflow.operators import alerts, windows
from rillflow.operators.ordered import OrderedKeys, Running


@pytest.fixture(scope="module")
def series(spark):
    """One key has a third of all rows, one is null, times repeat."""
    chance = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 40}")
        data.append((key, chance.randrange(300_000), i, float(chance.randrange(60))))
    chance.shuffle(data)
    df = spark.createDataFrame(data, "id string, ms bigint, seq bigint, temperature double").cache()
    return df, data


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def test_hot_keys_are_found_and_sliced(series):
    df, _ = series
    split = OrderedKeys.of(df, ["id"], ["ms", "seq"], limit=25)
    per_key = {r["id"]: r["n"] for r in split.hot.groupBy("id").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert set(per_key) == {"hot"} and per_key["hot"] >= 4
    biggest = split.hot.groupBy("_hot_id", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest <= 75
    assert split.cold.where("id = 'hot'").count() == 0 and split.frame().count() == 900


def test_previous_running_and_numbers(series):
    df, data = series
    scanned = (
        OrderedKeys.of(df, ["id"], ["ms", "seq"], limit=15).numbered("rn")
        .previous(before="temperature")
        .running(total=Running("sum", F.col("temperature")), top=Running("max", F.col("temperature")))
        .running(before=True, top_before=Running("max", F.col("temperature")))
    )
    found = {r.seq: r for r in scanned.frame().collect()}
    assert len(found) == 900
    for rows in by_key(data).values():
        total, top, before = 0.0, None, None
        for n, (_, _, seq, value) in enumerate(rows, 1):
            r = found[seq]
            assert (r.rn, r.before, r.top_before) == (n, before, top)
            total, top, before = total + value, value if top is None else max(top, value), value
            assert (r.total, r.top) == (total, top)


def test_count_windows_cross_slices(series):
    df, data = series
    found = windows.count_windows(
        df, ["id"], ["ms", "seq"], 10, 2, limit=12, cnt=F.count(F.lit(1)), low=F.min("temperature")
    )
    expected = set()
    for key, rows in by_key(data).items():
        for n in range(2, len(rows) + 1, 2):
            last = [r[3] for r in rows[max(0, n - 10):n]]
            expected.add((key, n, len(last), min(last)))
    assert {tuple(r) for r in found.collect()} == expected and found.count() == len(expected)


def test_sessions_cross_slices(series):
    df, data = series
    timed = df.withColumn("ts", F.timestamp_millis("ms").cast("timestamp_ntz"))
    found = windows.sessions(timed.where("id IS NOT NULL"), ["id"], "ts", ["ts", "seq"], 1, limit=10)
    expected = []
    for key, rows in by_key(data).items():
        if key is None:
            continue
        start = last = rows[0][1]
        n = 0
        for _, ms, _, _ in rows:
            if ms - last > 1000:
                expected.append((key, start, last + 1000, n))
                start, n = ms, 0
            last, n = ms, n + 1
        expected.append((key, start, last + 1000, n))
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def rise_by_hand(rows, wait):
    last, due, out = 0.0, 0, []
    for _, at, _, value in rows:
        if due and at > due:
            out.append(due - wait)
            due = 0
        if value > last and not due:
            due = at + wait
        elif value < last:
            due = 0
        last = value
    return out + ([due - wait] if due else [])


@pytest.mark.parametrize("limit", [None, 3])
def test_rise_alarms_equal_the_state_machine(series, limit):
    df, data = series
    data = [r for r in data if r[0] is not None]
    found = alerts.rise_alarms(df.where("id IS NOT NULL"), "id", "temperature", "ms", ["ms", "seq"], 2, limit=limit)
    expected = [(k, at) for k, rows in by_key(data).items() for at in rise_by_hand(rows, 2000)]
    assert sorted((r.id, r.armed_at) for r in found.collect()) == sorted(expected)


def test_one_long_rise_is_followed_by_doubling(spark):
    chance, at, rows = random.Random(3), 0, []
    for i in range(400):
        at += chance.randrange(1, 2500)
        rows.append(("a", at, i, float(i + 1)))
    df = spark.createDataFrame(rows, "id string, ms bigint, seq bigint, temperature double")
    assert len(rows) > alerts.SHORT_RUN
    for limit in (None, 40):
        found = alerts.rise_alarms(df, "id", "temperature", "ms", ["ms", "seq"], 5, limit=limit)
        assert sorted(r.armed_at for r in found.collect()) == rise_by_hand(rows, 5000)
