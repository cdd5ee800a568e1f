"""Streaming twins: each runs a streaming job over a table's files and reads back its sink."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.catalog import records
from rillflow.catalog.records import AS_OF, DIM_TABLES, FACT_TABLES, READINGS, Tables
from rillflow.catalog.registry import query
from rillflow.catalog.timeline import COUNT_WINDOWS, JUMPS, RISES, SESSIONS, WAIT
from rillflow.catalog.warehouse import CHANGES, DAU, MESSAGE_FIELDS, message_fields
from rillflow.operators import relational
from rillflow.plans import change_split, daily_users, log_split, order_wide
from rillflow.schemas import DAU_INFO, SENSOR, struct
from rillflow.session import plan_bytes, scratch_path, state_buckets, state_partitions
from rillflow.sinks.keyed import KeyedTable
from rillflow.sinks.topics import stream_messages
from rillflow.sources import records as record_files
from rillflow.streaming import jobs, offsets, state

HOUR = 3600


BATCHES = 3
# Bytes of the larger table in a batch of the order joins. What a batch brings is in the state until the
# watermark moves, so more rows come in more batches, not in larger ones.
BATCH_BYTES = 64 << 20
# The column whose order the rows of a table arrive in.
ARRIVAL = {
    "events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate",
    "conversations": "conv_id", "customer": "c_custkey", "supplier": "s_suppkey",
}


# Bytes of a file of a slice, as the plan estimates them. A file is read by one task, which holds what
# its rows become until it is written: log messages are some thirty times the size of their events.
FILE_BYTES = 8 << 20
# The order joins have batches of one size however large the tables are, and the smaller table brings less
# than a file of that size to a batch: smaller files let all cores write and read it.
JOIN_FILE_BYTES = 2 << 20
# Settings while slices are written. A task that parts a table sorts its rows by slice, and in memory they
# are many times as large as in the file. Files are read in one order, so that rows dealt out in turn
# need no sorting before.
WRITING = {
    "spark.sql.files.maxPartitionBytes": str(32 << 20), "spark.sql.execution.sortBeforeRepartition": "false",
}


class StreamedTables(Tables):
    """The same tables, with the named ones read as streams of several batches.

    A table arrives in slices by time or key. The slices are ranges of the column it is ordered by,
    so each is read by itself where the files are in that order, and is written by as many tasks as
    its size asks for. All slices have the same number of files, and the source takes so many at
    a time. A table of many slices is parted in one pass first, for reading it once a slice would
    cost the square of its size.

    ``kept`` has tables in the form a query keeps them in for its batches; they are not read again.
    """

    def __init__(
        self, t: Tables, *streamed: str, slices: int | None = None, batches: int = BATCHES,
        file_bytes: int = FILE_BYTES,
    ):
        super().__init__(t.spark, t.folder)
        self.file_bytes = file_bytes
        self.streamed = {name: scratch_path(t.spark, name) for name in streamed}
        self.arrived, self.batches = 0, batches
        self.kept: dict[str, DataFrame] = {}
        self.slices: dict[str, list[DataFrame]] = {}
        self.arrive(batches if slices is None else slices)

    def files(self, name: str) -> int:
        """The files of a slice."""
        table = self.spark.read.parquet(self.path(name))
        return max(1, plan_bytes(table) // (self.batches * self.file_bytes))

    def cut(self, name: str) -> list[DataFrame]:
        """The slices of a table; rows without a place in the order are in the first."""
        table = self.spark.read.parquet(self.path(name))
        at, kind = F.col(ARRIVAL[name]), dict(table.dtypes)[ARRIVAL[name]]
        whole = kind in ("bigint", "int")
        order = at if whole else F.unix_seconds(at.cast("timestamp"))
        shares = [i / self.batches for i in range(1, self.batches)]
        found = table.agg(F.percentile_approx(order, shares)).first()[0] or [0]
        # A value that fills several slices ends only one: others would be empty.
        ends = [
            F.lit(c) if whole else F.timestamp_seconds(F.lit(c)).cast(kind) for c in sorted(set(found))
        ]
        if self.batches > BATCHES:
            place = sum((F.coalesce(at > end, F.lit(False)).cast("int") for end in ends), F.lit(0))
            path = scratch_path(self.spark, f"{name}-slices")
            table.withColumn("_slice", place).write.partitionBy("_slice").parquet(path)
            schema = T.StructType([*table.schema.fields, T.StructField("_slice", T.IntegerType())])
            parted = self.spark.read.schema(schema).parquet(path)
            return [parted.where(F.col("_slice") == k).drop("_slice") for k in range(len(ends) + 1)]
        first = at.isNull() | (at <= ends[0])
        between = [(at > low) & (at <= high) for low, high in zip(ends, ends[1:])]
        return [table.where(c) for c in (first, *between, at > ends[-1])]

    def arrive(self, slices: int) -> None:
        """Write the next slices of every streamed table, the tables beside each other."""

        def write(name: str) -> None:
            if name not in self.slices:
                self.slices[name] = self.cut(name)
            files = self.files(name)
            for part in self.slices[name][self.arrived : self.arrived + slices]:
                part.repartition(files).write.mode("append").parquet(self.streamed[name])

        with (
            jobs.with_settings(self.spark, WRITING),
            ThreadPoolExecutor(max(1, len(self.streamed))) as pool,
        ):
            list(pool.map(write, self.streamed))
        self.arrived += slices

    def __getattr__(self, name: str) -> DataFrame:
        if name in self.kept:
            return self.kept[name]
        table = super().__getattr__(name)
        if name in self.streamed:
            return jobs.file_stream(
                self.spark, self.streamed[name], table.schema, files_per_batch=self.files(name)
            )
        return table


def _batches(t: Tables, *names: str) -> int:
    """Batches that tables come in together, so that none brings more than its share."""
    return max(BATCHES, *[plan_bytes(getattr(t, name)) // BATCH_BYTES for name in names])


def _joined_tables(t: Tables) -> StreamedTables:
    """Both sides of the order joins as streams."""
    sides = ("orders", "lineitem")
    return StreamedTables(t, *sides, batches=_batches(t, *sides), file_bytes=JOIN_FILE_BYTES)


def _saved(
    t: Tables, df: DataFrame, name: str, table: DataFrame, store: dict[str, str] | None = None
) -> DataFrame:
    """Run an append query over a table into files and read them."""
    root = scratch_path(t.spark, name)
    jobs.run(
        df, f"{root}/checkpoint", path=f"{root}/table", store=store, partitions=state_partitions(table)
    )
    return t.spark.read.schema(df.schema).parquet(f"{root}/table")


def _instants(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@query("""WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM conversations),
words AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words WHERE length(word) > 0 GROUP BY word""")
def stream_word_count(t):
    """AGG-02: update mode into a keyed table."""
    root = scratch_path(t.spark, "words")
    table = jobs.counts_table(f"{root}/table")
    lines = StreamedTables(t, "conversations").conversations.select(
        F.explode(F.split("text", "\n")).alias("value")
    )
    jobs.running_word_count(
        lines, f"{root}/checkpoint", table, every=None,
        partitions=state_partitions(t.conversations),
    ).awaitTermination()
    return table.read(t.spark)


@query(f"""WITH {READINGS}, counted AS (
  SELECT id, ms - ms % 3600000 AS window_start, count(*) AS cnt FROM readings GROUP BY ALL)
SELECT * FROM counted WHERE window_start + 3600000 <= (SELECT max(ms) - 1000 FROM readings)""")
def stream_tumbling(t):
    """WIN-01, STR-01: windows the watermark has closed."""
    rows = records.readings(StreamedTables(t, "events")).select("id", "ts")
    return _saved(t, jobs.window_stream(rows, ["id"], "ts", HOUR), "tumbling", t.events)


@query(f"""WITH {READINGS}, counted AS (
  SELECT id, ms - ms % 3600000 AS window_start, count(*) AS cnt FROM readings GROUP BY ALL)
SELECT * FROM counted WHERE window_start + 3600000 <= (SELECT max(ms) - 1000 FROM readings)""")
def stream_resumed(t):
    """STR-08, SRC-06: a query that ends and goes on from its saved progress with what came since."""
    s, root = StreamedTables(t), scratch_path(t.spark, "resumed")
    s.streamed, s.arrived = {"events": f"{root}/events"}, 0
    for _ in range(BATCHES):
        s.arrive(1)
        rows = jobs.window_stream(records.readings(s).select("id", "ts"), ["id"], "ts", HOUR)
        jobs.run(rows, f"{root}/checkpoint", path=f"{root}/table", partitions=state_partitions(t.events))
    return t.spark.read.schema("id string, window_start bigint, cnt bigint").parquet(f"{root}/table")


@query(f"""WITH {READINGS}, reduced AS (
  SELECT id, ms - ms % 3600000 AS window_start, max("timestamp") AS "timestamp",
         min(temperature) AS temperature FROM readings GROUP BY ALL)
SELECT * FROM reduced WHERE window_start + 3600000 <= (SELECT max(ms) FROM readings)""")
def stream_window_reduce(t):
    """WIN-06, STR-02: ascending times need no delay."""
    rows = records.readings(StreamedTables(t, "events")).select("id", "ts", "timestamp", "temperature")
    return _saved(t, jobs.reduced_window_stream(rows, ["id"], "ts", HOUR, delay=0), "reduced", t.events)


@query(f"""{SESSIONS} SELECT * FROM sessions
WHERE session_end <= (SELECT epoch_us(max(ts)) // 1000 - 1000 FROM events)""")
def stream_session(t):
    """WIN-04."""
    rows = records.readings(StreamedTables(t, "events")).select("id", "ts")
    return _saved(t, jobs.session_stream(rows, ["id"], "ts", 6 * HOUR), "sessions", t.events)


def _keyed(
    t: Tables, processor, event_time: bool = False, latest: bool = False, extra: list[str] = (),
    time: str = "None",
) -> DataFrame:
    """What a processor sends; with ``latest`` only the last row of every id counts."""
    rows = records.readings(StreamedTables(t, "events")).select("id", "ts", "seq", "temperature", *extra)
    rows = jobs.bounded_lateness(rows, "ts") if event_time else _instants(rows)
    states = state.keyed(rows, processor, event_time, time, state_buckets(t.events))
    root = scratch_path(t.spark, type(processor).__name__)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    mode = "append" if event_time else "update"
    jobs.run(
        states, f"{root}/checkpoint", write=write, mode=mode,
        store=jobs.EXPIRING if time == "ProcessingTime" else jobs.ROCKSDB,
        partitions=state_partitions(t.events),
    )
    schema = T.StructType.fromDDL(processor.schema)
    if latest:
        return KeyedTable(f"{root}/table", ("id",), schema, ("cnt",), day=None).read(t.spark)
    return t.spark.read.schema(schema).parquet(f"{root}/table").select(*schema.fieldNames())


@query(f"{JUMPS} SELECT id, seq, previous, current FROM lagged WHERE abs(current - previous) > 10")
def stream_jump_alert(t):
    """STA-01, EXT-01."""
    return _keyed(t, state.JumpAlert(10.0))


@query(f"""{JUMPS}, flagged AS (
  SELECT *, abs(current - coalesce(previous, 0)) > 10 AS jumped FROM lagged)
SELECT id, seq, CASE WHEN jumped THEN coalesce(previous, 0) ELSE 0 END AS previous,
       CASE WHEN jumped THEN current ELSE 0 END AS current FROM flagged""")
def stream_jump_alert_map(t):
    """STA-02, STA-03."""
    return _keyed(t, state.JumpAlert(10.0, initial=0.0, every_row=True))


@query(f"""{RISES} SELECT id, armed_at, due_at, message FROM alarms a WHERE due_at < greatest(
  (SELECT max(ms) FROM readings r WHERE r.id = a.id), (SELECT max(ms) - 1000 FROM readings))""")
def stream_rise_alarm(t):
    """STA-04, STA-06: alarms whose due time has passed when the input ends."""
    return _keyed(t, state.RiseAlarm(WAIT), event_time=True)


@query(COUNT_WINDOWS)
def stream_count_window(t):
    """WIN-05, STA-05."""
    return _keyed(t, state.CountWindow(10, 2))


@query("""WITH numbered AS (
  SELECT concat('sensor_', user_id) AS id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT id, true AS is_add, n AS cnt, 2 * n - 1 AS step FROM numbered
UNION ALL SELECT id, false, n - 1, 2 * n - 2 FROM numbered WHERE n > 1""")
def stream_changelog(t):
    """AGG-04."""
    return _keyed(t, state.CountChanges())


@query(f"""WITH {READINGS} SELECT id, count(*) AS cnt, least(count(*), 3) AS kept,
  count(DISTINCT floor(temperature / 10)) AS bands, max(ms) AS latest, min(temperature) AS lowest
FROM readings GROUP BY id""")
def stream_reading_states(t):
    """STA-05."""
    return _keyed(t, state.ReadingStates(3), latest=True)


@query(f"""WITH {READINGS} SELECT id, "timestamp", temperature, coalesce(temperature > 30, false) AS high
FROM readings""")
def stream_side_output(t):
    """FLT-14: one pass, two tables; both are read."""
    rows = records.readings(StreamedTables(t, "events")).select(*SENSOR.fieldNames())
    root = scratch_path(t.spark, "sides")

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        high, low = relational.threshold_split(batch, "temperature", 30)
        return {"high": high, "low": low}

    jobs.run(rows, f"{root}/checkpoint", write=jobs.branch_tables(split, f"{root}/tables"))
    sides = [
        t.spark.read.schema(SENSOR).parquet(f"{root}/tables/{side}")
        .select(*SENSOR.fieldNames(), F.lit(side == "high").alias("high"))
        for side in ("high", "low")
    ]
    return sides[0].unionByName(sides[1])


@query(MESSAGE_FIELDS)
def stream_log_split(t):
    """PIP-01, SNK-02: files laid out by topic."""
    split = log_split.split_messages(records.log_lines(StreamedTables(t, "events")))
    root = scratch_path(t.spark, "topics")
    # The file sink stands for the broker; it ends when the table has been read.
    query = stream_messages(split, f"{root}/checkpoint", "parquet", f"{root}/table", every=None)
    query.awaitTermination()
    topics = t.spark.read.schema("value string, topic string").parquet(f"{root}/table")
    return message_fields(topics)


DIMENSION = struct(dim_key="string", table_name="string", id="string", value="string", seq="bigint")


@query(f"""WITH {CHANGES}
SELECT upper(tab) AS target, concat(upper(tab), ':', id) AS key, data AS value
FROM changes WHERE tab = 'user_info' AND op IS NOT NULL
UNION ALL SELECT concat('DWD_', upper(tab), '_', op, '_1018'), NULL, data
FROM changes WHERE tab = 'order_info' AND op IS NOT NULL""")
def stream_change_split(t):
    """PIP-04, SNK-10: facts to topics, dimensions to a keyed table; both are read."""
    root = scratch_path(t.spark, "changes")
    lists = {"facts": FACT_TABLES, "dims": DIM_TABLES}
    for name, tables in lists.items():
        records.table_list(t, tables).write.json(f"{root}/lists/{name}")
    dims = KeyedTable(f"{root}/dims", ("dim_key",), DIMENSION, ("seq",), day="table_name")
    write = change_split.batch_writer(
        f"{root}/lists/facts", f"{root}/lists/dims", f"{root}/topics", dims, "seq"
    )
    lines = records.change_lines(StreamedTables(t, "orders", "customer", "supplier"))
    jobs.run(lines, f"{root}/checkpoint", write=write)
    known = dims.read(t.spark).select(
        F.col("table_name").alias("target"), F.col("dim_key").alias("key"), "value"
    )
    facts = t.spark.read.schema("value string, topic string").parquet(f"{root}/topics")
    return known.unionByName(
        facts.select(F.col("topic").alias("target"), F.lit(None).cast("string").alias("key"), "value")
    )


@query(f"WITH {DAU} SELECT * FROM dau")
def stream_dau(t):
    """PIP-05, STA-07, STA-08, SNK-06."""
    root = scratch_path(t.spark, "dau")
    table = KeyedTable(f"{root}/table", ("mid",), DAU_INFO, ("ts",))
    views = records.page_views(StreamedTables(t, "events"))
    write = daily_users.batch_writer(table, records.users(t), records.provinces(t), F.lit(AS_OF))
    jobs.run(views, f"{root}/checkpoint", write=write)
    return table.read(t.spark)


@query(f"""WITH {DAU} SELECT dt, mid FROM dau""")
def stream_first_in_day(t):
    """STA-07, STA-09: the dedupe state lives in the query and expires."""
    views = records.page_views(StreamedTables(t, "events"))
    found = daily_users.entries(views).withColumn("at", F.timestamp_millis("ts")).select("dt", "mid", "at")
    return _saved(t, jobs.first_in_day_stream(found, "at"), "first", t.events).select("dt", "mid")


@query(f"""WITH {records.ORDER_WIDE} SELECT w.* FROM order_wide w
JOIN orders o ON o.o_orderkey = w.order_id
WHERE abs(date_diff('day', o.o_orderdate, CAST(w.create_time AS TIMESTAMP))) <= 30""")
def stream_order_wide(t):
    """PIP-06, JON-03, STR-06: both sides wait 30 days for the other, by event time."""
    s = _joined_tables(t)
    infos = records.order_infos(s).withColumn("at", F.date_trunc("day", F.to_timestamp("create_time")))
    lines = records.order_lines(s).withColumn("at", F.to_timestamp("create_time"))
    parts, places = t.part.select("p_partkey", "p_name"), state_partitions(t.lineitem)
    with (
        jobs.looked_up(records.users(t), "id", places) as users,
        jobs.looked_up(parts, "p_partkey", places) as part,
    ):
        joined = order_wide.wide_order_stream(
            infos, lines, "at", "at", "30 days",
            lambda pairs: order_wide.enriched_orders(pairs, users, records.provinces(t), F.lit(AS_OF)),
            lambda pairs: records.with_sku_name(pairs, part),
        )
        return _saved(t, joined, "wide", t.lineitem, jobs.LAST_VERSION)


@query(f"""WITH {records.ORDER_INFOS}, infos AS (
  SELECT id, date_trunc('day', CAST(create_time AS TIMESTAMP)) AS seen FROM order_infos
), lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_orderkey AS order_id,
    CAST(l_shipdate AS TIMESTAMP) AS seen FROM lineitem
), closed AS (
  SELECT least((SELECT max(seen) FROM infos), (SELECT max(seen) FROM lines)) - INTERVAL 31 DAYS AS t
), pairs AS (
  SELECT i.id AS order_id, d.id AS detail_id FROM infos i JOIN lines d ON i.id = d.order_id
    AND d.seen BETWEEN i.seen - INTERVAL 30 DAYS AND i.seen + INTERVAL 30 DAYS
)
SELECT order_id, detail_id, 'both' AS match_state FROM pairs
UNION ALL SELECT id, NULL, 'info_only' FROM infos WHERE seen < (SELECT t FROM closed)
  AND id NOT IN (SELECT order_id FROM pairs)
UNION ALL SELECT order_id, id, 'detail_only' FROM lines WHERE seen < (SELECT t FROM closed)
  AND id NOT IN (SELECT detail_id FROM pairs)""")
def stream_order_match(t):
    """JON-06, STR-06: pairs at once, what stays alone when the watermark has passed its time."""
    s = _joined_tables(t)
    infos = records.order_infos(s).withColumn("at", F.date_trunc("day", F.to_timestamp("create_time")))
    parts = t.part.select("p_partkey", "p_name")
    with jobs.looked_up(parts, "p_partkey", state_partitions(t.lineitem)) as s.kept["part"]:
        details = records.order_details(s).withColumn("at", F.to_timestamp("create_time"))
        joined = order_wide.match_state_stream(infos, details, "at", "at", "30 days", "1 day")
        return _saved(t, joined, "match", t.lineitem, jobs.LAST_VERSION)


@query(f"WITH {DAU} SELECT dt, mid, ts FROM dau")
def stream_dau_restored(t):
    """STA-08: a query that has lost its checkpoint takes its state from what it has written."""
    root, s = scratch_path(t.spark, "restored"), StreamedTables(t, "events", slices=BATCHES - 1)
    schema = T.StructType.fromDDL(state.FirstInDay.schema)
    found = daily_users.entries(records.page_views(s))
    for life in ("first", "second"):
        table = KeyedTable(f"{root}/table", ("mid",), schema, ("ts",))
        known = table.read(t.spark)
        if life == "second":
            # Written apart, so that what the state begins with does not change under the query.
            known.write.parquet(f"{root}/known")
            known = t.spark.read.schema(schema).parquet(f"{root}/known")
            s.arrive(1)
        begin = 0 if life == "first" else 1_000_000
        jobs.run(
            state.first_in_day(found, known, state_buckets(t.events, 1 << 20)),
            f"{root}/checkpoint-{life}", store=jobs.ROCKSDB,
            write=lambda batch, n, begin=begin: table.write_batch(batch, begin + n),
            partitions=state_partitions(t.events),
        )
    # Every written row, not the last of a key: a device that came out twice would be seen.
    return table.versions(t.spark).select("dt", "mid", "ts")


@query("""SELECT concat('sensor_', user_id) AS id, event_type AS kind, min(event_id) AS seq
FROM events GROUP BY ALL""")
def stream_first_of_kind(t):
    """STA-09: entries of the state that live for a day."""
    return _keyed(t, state.FirstOfKind(24 * HOUR), extra=["kind"], time="ProcessingTime")


def _event_records(s: StreamedTables, topic: str, checkpoint: str) -> None:
    """Write what has arrived of the events as records: the next epoch."""
    record_files.register(s.spark)
    sent = s.events.select(records.text("event_id").alias("key"), F.col("event_type").alias("value"))
    jobs.run(sent, checkpoint, path=topic, source="keyed_records")


EVENT_RECORDS = "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS value FROM events"


@query(EVENT_RECORDS)
def stream_records(t):
    """EXT-04, EXT-05 as streams: epochs written, read as they come and written again."""
    s, root = StreamedTables(t, "events", slices=0), scratch_path(t.spark, "records")
    for _ in range(BATCHES):
        s.arrive(1)
        _event_records(s, f"{root}/topic", f"{root}/sent")
        read = t.spark.readStream.format("keyed_records").load(f"{root}/topic")
        jobs.run(read, f"{root}/got", path=f"{root}/copy", source="keyed_records")
    return t.spark.read.format("keyed_records").load(f"{root}/copy")


@query(EVENT_RECORDS)
def stream_from_offsets(t):
    """STR-08, SRC-06: a query without its checkpoint goes on from the offsets it has saved."""
    s, root = StreamedTables(t, "events", slices=0), scratch_path(t.spark, "offsets")
    schema, name = struct(key="string", value="string"), "from-offsets"
    table = KeyedTable(f"{root}/table", ("key",), schema, ("value",), day=None)
    for life in range(BATCHES):
        s.arrive(1)
        _event_records(s, f"{root}/topic", f"{root}/sent")
        known = offsets.saved_offsets(f"{root}/saved", name)
        reader = t.spark.readStream.format("keyed_records")
        if known:
            reader = reader.option("startingEpoch", known[0]["epoch"])
        with offsets.OffsetKeeper(t.spark, f"{root}/saved", name):
            jobs.run(
                reader.load(f"{root}/topic"), f"{root}/checkpoint-{life}", name=name,
                write=lambda batch, n, life=life: table.write_batch(batch, life * 1_000_000 + n),
            )
    # Every written row, so that one that came twice would be seen.
    return table.versions(t.spark).select("key", "value")
