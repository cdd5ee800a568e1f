"""Streaming jobs: restarts, late rows, replays, and equality with the batch forms."""

import time
from itertools import takewhile

import pytest
from pyspark.sql import functions as F

from rillflow.operators import alerts, windows
from rillflow.plans import order_wide
from rillflow.schemas import ORDER_DETAIL, ORDER_INFO
from rillflow.sources.topics import MESSAGE, read_topic
from rillflow.streaming import jobs, state
from tests.conftest import ids, rows
from tests.test_warehouse import detail, dims, order  # noqa: F401

READING = "id string, ts timestamp, seq bigint, temperature double"


def write_files(spark, path, parts, schema):
    """One file per part, with rising modification times."""
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(str(path))
        time.sleep(0.02 if n else 0)


@pytest.fixture
def parts():
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    out = []
    for f in range(4):
        out.append([
            (f"s{i % 3}", start + timedelta(seconds=4 * (25 * f + i)), 25 * f + i, float((i * 7 + f * 3) % 40))
            for i in range(25)
        ])
    return out


def source(spark, path, per_batch=1):
    from pyspark.sql.types import StructType

    return jobs.file_stream(spark, str(path), StructType.fromDDL(READING), per_batch, "json")


def collected(spark, query, root, schema, mode="update"):
    def write(batch, batch_id):
        batch.write.mode("overwrite").json(f"{root}/out/batch_id={batch_id}")

    jobs.run(query, f"{root}/checkpoint", write=write, mode=mode, store=jobs.ROCKSDB)
    return spark.read.schema(schema).json(f"{root}/out")


PROCESSORS = {
    "jump": (lambda: state.JumpAlert(10.0), False),
    "jump_zero": (lambda: state.JumpAlert(10.0, initial=0.0, every_row=True), False),
    "count_window": (lambda: state.CountWindow(10, 2), False),
    "changes": (lambda: state.CountChanges(), False),
}


@pytest.mark.parametrize("name", sorted(PROCESSORS))
def test_state_carries_over_batches_and_restarts(spark, tmp_path, parts, name):
    make, timed = PROCESSORS[name]
    schema = make().schema
    # All files in one batch ...
    write_files(spark, tmp_path / "whole", parts, READING)
    whole = collected(spark, state.keyed(source(spark, tmp_path / "whole", 100), make(), timed), tmp_path / "a", schema)
    # ... against two runs over the same checkpoint, one file per batch.
    write_files(spark, tmp_path / "split", parts[:2], READING)
    collected(spark, state.keyed(source(spark, tmp_path / "split"), make(), timed), tmp_path / "b", schema)
    write_files(spark, tmp_path / "split", parts[2:], READING)
    split = collected(spark, state.keyed(source(spark, tmp_path / "split"), make(), timed), tmp_path / "b", schema)
    names = [c for c in whole.columns if c != "batch_id"]
    assert whole.count() > 0 and rows(whole.select(*names)) == rows(split.select(*names))


@pytest.mark.parametrize("name", sorted(PROCESSORS))
def test_state_and_calls_follow_buckets_not_keys(spark, tmp_path, parts, name):
    """Many ids, one of them null: a row of state per bucket, and what each id would give alone."""
    make, _ = PROCESSORS[name]
    many = [
        [(f"{row[0]}-{n}" if n else None, *row[1:]) for row in part if row[0] == "s1" for n in range(60)]
        for part in parts
    ]
    write_files(spark, tmp_path / "in", many, READING)
    schema, root = make().schema, tmp_path / "many"

    def write(batch, batch_id):
        batch.write.mode("overwrite").json(f"{root}/out/batch_id={batch_id}")

    query = jobs.start(
        state.keyed(source(spark, tmp_path / "in"), make(), buckets=4), f"{root}/checkpoint", write=write,
        mode="update", every=None, store=jobs.ROCKSDB,
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    write_files(spark, tmp_path / "one", [[r for r in part if r[0] == "s1"] for part in parts], READING)
    alone = collected(spark, state.keyed(source(spark, tmp_path / "one"), make()), tmp_path / "alone", schema)
    columns = alone.columns[1:]
    ids = spark.createDataFrame([(f"s1-{n}" if n else None,) for n in range(60)], "id string")
    got = spark.read.schema(schema).json(f"{root}/out").select("id", *columns)
    wanted = ids.crossJoin(alone.select(*columns))
    assert got.count() and rows(got.fillna("none", ["id"])) == rows(wanted.fillna("none", ["id"]))


def test_jump_alert_stream_equals_batch(spark, tmp_path, parts):
    write_files(spark, tmp_path / "in", parts, READING)
    maker = state.JumpAlert(10.0)
    got = collected(spark, state.keyed(source(spark, tmp_path / "in"), maker), tmp_path, maker.schema)
    flat = spark.createDataFrame([r for p in parts for r in p], READING)
    batch = alerts.jump_alerts(flat, "id", "temperature", ["ts", "seq"], 10.0)
    columns = ["id", "seq", "previous", "current"]
    assert rows(got.select(*columns)) == rows(batch.select(*columns))


def test_rise_alarm_timers(spark, tmp_path, parts):
    """Whatever falls due before the last watermark comes out, by a row or by a timer."""
    write_files(spark, tmp_path / "in", parts, READING)
    maker = state.RiseAlarm(10)
    readings = jobs.bounded_lateness(source(spark, tmp_path / "in"), "ts")
    got = collected(spark, state.keyed(readings, maker, event_time=True), tmp_path, maker.schema, "append")
    flat = spark.createDataFrame([r for p in parts for r in p], READING).withColumn("ms", F.unix_millis("ts"))
    last = flat.agg(F.max("ms")).first()[0]
    batch = alerts.rise_alarms(flat, "id", "temperature", "ms", ["ts", "seq"], 10).where(F.col("due_at") < last - 1000)
    found = rows(got.select("id", "armed_at", "due_at"))
    assert found and found == rows(batch.select("id", "armed_at", "due_at"))


def test_tumbling_stream_equals_batch_up_to_the_watermark(spark, tmp_path, parts):
    write_files(spark, tmp_path / "in", parts, READING)
    counted = jobs.window_stream(source(spark, tmp_path / "in"), ["id"], "ts", 15)
    jobs.run(counted, str(tmp_path / "c"), path=str(tmp_path / "out"))
    flat = spark.createDataFrame([r for p in parts for r in p], READING)
    end = flat.agg(F.unix_millis(F.max("ts"))).first()[0] - 1000
    batch = windows.window_counts(flat, ["id"], "ts", 15).where(F.col("window_start") + 15_000 <= end)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)


def test_word_count_resumes(spark, tmp_path):
    table = jobs.counts_table(str(tmp_path / "t"))
    folder = tmp_path / "in"
    folder.mkdir()

    def go():
        lines = spark.readStream.text(str(folder))
        jobs.running_word_count(lines, str(tmp_path / "c"), table, every=None).awaitTermination()
        return {r.word: r.cnt for r in table.read(spark).collect()}

    (folder / "a").write_text("hello spark\nhello  flink\n")
    assert go() == {"hello": 2, "spark": 1, "flink": 1}
    (folder / "b").write_text("hello hadoop\n")
    assert go() == {"hello": 3, "spark": 1, "flink": 1, "hadoop": 1}


def at(df, column="create_time"):
    return df.withColumn("at", F.to_timestamp(column))


def test_order_join_waits_a_day(spark, tmp_path, dims):  # noqa: F811
    infos = spark.createDataFrame(
        [order(1, at="2023-02-01 10:00:00"), order(2, at="2023-02-01 11:00:00"),
         order(3, at="2023-02-01 12:00:00"), order(4, at="2023-02-01 12:30:00")], ORDER_INFO)
    details = spark.createDataFrame(
        [detail(10, 1, at="2023-02-01 10:00:01"),      # same time
         detail(20, 2, at="2023-02-01 09:00:00"),      # before its order
         detail(30, 3, at="2023-02-02 11:00:00"),      # 23 hours later
         detail(31, 3, at="2023-02-02 13:00:01"),      # 25 hours later: none
         detail(11, 1, at="2023-02-01 12:00:00"), detail(12, 1, at="2023-02-01 13:00:00"),
         detail(90, 9, at="2023-02-01 13:00:00")], ORDER_DETAIL)
    infos.write.json(str(tmp_path / "infos"))
    details.write.json(str(tmp_path / "details"))
    stream_infos = spark.readStream.schema(ORDER_INFO).json(str(tmp_path / "infos"))
    stream_details = spark.readStream.schema(ORDER_DETAIL).json(str(tmp_path / "details"))
    enriched = at(order_wide.enriched_orders(stream_infos, *dims))
    joined = order_wide.wide_order_stream(enriched, at(stream_details), "at", "at")
    table = order_wide.wide_table(str(tmp_path / "out"), joined)
    batches = []

    def write(batch, batch_id):
        batches.append(batch_id)
        for _ in range(2):  # a repeated batch changes nothing
            table.write_batch(batch, batch_id)

    jobs.run(joined, str(tmp_path / "c"), write=write)
    assert sorted(r.detail_id for r in table.read(spark).collect()) == [10, 11, 12, 20, 30]
    assert batches and {r.create_hour for r in table.read(spark, ["2023-02-01"]).collect()} == {"10", "11", "12"}


def test_first_in_day_state(spark, tmp_path):
    schema = "dt string, mid string, at timestamp"
    rows_in = "SELECT 'd1' AS dt, 'a' AS mid, timestamp'2024-01-01 01:00:00' AS at"
    for _ in range(2):
        spark.sql(rows_in).write.mode("append").json(str(tmp_path / "in"))
        entries = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        jobs.run(jobs.first_in_day_stream(entries, "at"), str(tmp_path / "c"), path=str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_topic_reader_over_files(spark, tmp_path):
    spark.createDataFrame([("t", "k", "v")], MESSAGE).write.parquet(str(tmp_path / "in"))
    stream = read_topic(spark, {}, "parquet", MESSAGE, str(tmp_path / "in"))
    jobs.run(stream, str(tmp_path / "c"), path=str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("t", "k", "v")]


def test_entries_of_the_state_expire(spark, tmp_path):
    """A kind is new again once its entry's time to live is over, and not before."""
    from datetime import datetime

    schema = f"{READING}, kind string"
    root, out = tmp_path / "in", {}
    row = ("s", datetime(2024, 1, 1), 1, 1.0, "a")
    for life in (1, 3600):
        for run in range(2):
            spark.createDataFrame([row[:2] + (run,) + row[3:]], schema).coalesce(1).write.mode("append").json(f"{root}{life}")
            rows_in = jobs.file_stream(spark, f"{root}{life}", spark.createDataFrame([], schema).schema, 1, "json")
            found = state.keyed(rows_in, state.FirstOfKind(life), time="ProcessingTime")

            def write(batch, batch_id, life=life):
                batch.write.mode("overwrite").json(f"{tmp_path}/out{life}/batch_id={batch_id}")

            jobs.run(found, f"{tmp_path}/c{life}", write=write, mode="update", store=jobs.EXPIRING)
            time.sleep(2.5 if run == 0 and life == 1 else 0)
        out[life] = rows(spark.read.schema(state.FirstOfKind.schema).json(f"{tmp_path}/out{life}").select("seq"))
    assert out == {1: [(0,), (1,)], 3600: [(0,)]}


def test_files_of_a_slice_follow_the_size_of_the_table(spark, monkeypatch):
    """A task reads one file of a slice, so a table six times as large has more files, not larger ones."""
    from rillflow.catalog import streams
    from rillflow.catalog.registry import Tables

    s = streams.StreamedTables(Tables(spark, "/root/testdata/sf0.001"), slices=0)
    for size in (120 << 20, 720 << 20):
        monkeypatch.setattr(streams, "plan_bytes", lambda table, size=size: size)
        assert size / (streams.BATCHES * s.files("events")) <= 16 << 20


def test_a_larger_table_comes_in_more_batches(spark, monkeypatch):
    """A batch of the order joins is in the state at once, so its share of a table must not grow."""
    from rillflow.catalog import streams
    from rillflow.catalog.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for size in (1 << 30, 6 << 30):
        monkeypatch.setattr(streams, "plan_bytes", lambda table, size=size: size)
        assert size / streams._batches(t, "orders", "lineitem") <= 64 << 20


def test_order_joins_in_many_batches(spark, monkeypatch):
    """Slices hold every row once, in order, and the join over many of them gives the rows of the SQL."""
    from rillflow.catalog import ORACLES, QUERIES, streams
    from rillflow.catalog.registry import Tables
    from tests.oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    t = Tables(spark, folder)
    s = streams.StreamedTables(t, "orders", slices=0, batches=6)
    parts = [part.select("o_orderkey", "o_orderdate").collect() for part in s.cut("orders")]
    assert len(parts) == 6 and all(parts)
    assert sorted(r[0] for part in parts for r in part) == ids(t.orders, "o_orderkey")
    for before, after in zip(parts, parts[1:]):
        assert max(r[1] for r in before) < min(r[1] for r in after)
    monkeypatch.setattr(streams, "_batches", lambda *names: 6)
    assert compare(QUERIES["stream_order_match"](spark, folder), connect(folder), ORACLES["stream_order_match"]) == ""


def test_what_batches_look_up_is_judged_by_its_real_size(spark, monkeypatch, capsys):
    """Parts whose file is below the limit for broadcasts, but whose rows are not, stay off the driver."""
    from rillflow.catalog import ORACLES, QUERIES
    from rillflow.session import plan_bytes
    from tests.oracle import compare, connect

    folder, limit, started, start = "/root/testdata/sf0.001", 1600, [], jobs.start
    assert plan_bytes(spark.read.parquet(f"{folder}/part.parquet").select("p_partkey")) < limit
    monkeypatch.setattr(jobs, "start", lambda *a, **b: started.append(start(*a, **b)) or started[-1])
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    try:
        found = QUERIES["stream_order_match"](spark, folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    started[0].explain()
    plan = capsys.readouterr().out
    assert "InMemoryTableScan" in plan and "BroadcastExchange" not in plan
    assert compare(found, connect(folder), ORACLES["stream_order_match"]) == ""
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def below(plan, name):
    """The lines of a plan that lie below the operator of that name."""
    lines = plan.split("\n")
    at = next(n for n, line in enumerate(lines) if name in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    return [line for line, _ in takewhile(lambda x: x[1] > depth[at], zip(lines[at + 1 :], depth[at + 1 :]))]


def test_wide_orders_look_up_what_has_found_its_other_half(spark, monkeypatch, capsys):
    """Nothing is looked up for rows on their way into the state, and no batch deals a dimension out again."""
    from rillflow.catalog import ORACLES, QUERIES
    from tests.oracle import compare, connect

    folder, started, start = "/root/testdata/sf0.001", [], jobs.start
    monkeypatch.setattr(jobs, "start", lambda *a, **b: started.append(start(*a, **b)) or started[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1500")
    try:
        found = QUERIES["stream_order_wide"](spark, folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    started[0].explain()
    plan = capsys.readouterr().out
    state_inputs = below(plan, "StreamingSymmetricHashJoin")
    assert sum("EventTimeWatermark" in line for line in state_inputs) == 2
    assert not any("SortMergeJoin" in line or "BroadcastHashJoin" in line for line in state_inputs)
    assert plan.count("InMemoryTableScan") == 2
    assert compare(found, connect(folder), ORACLES["stream_order_wide"]) == ""


def test_lookups_of_pairs_add_what_lookups_before_would(spark, tmp_path, dims):  # noqa: F811
    """Users that are missing or there twice, and columns of the other side with the same names."""
    users, provinces, as_of = dims
    users = users.unionByName(users.limit(1))
    infos = at(spark.createDataFrame([order(1), order(2), order(3, user=999)], ORDER_INFO))
    details = at(spark.createDataFrame([detail(10, 1), detail(11, 1), detail(20, 2), detail(30, 3)], ORDER_DETAIL))

    def enrich(side):
        return order_wide.enriched_orders(side, users, provinces, as_of)

    first = order_wide.wide_order_stream(enrich(infos), details, "at", "at")
    later = order_wide.wide_order_stream(infos, details, "at", "at", enrich=enrich)
    assert later.columns == first.columns
    assert sorted(map(str, later.collect())) == sorted(map(str, first.collect())) and first.count() > 3
