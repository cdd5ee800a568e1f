"""Sources and sinks: whole tables written, then read back."""

from pyspark.sql import functions as F

from rillflow.catalog.records import PAGE_VIEWS, READINGS, page_views, readings, text
from rillflow.catalog.registry import Tables, query
from rillflow.operators import aggregates, views
from rillflow.schemas import PAGE_LOG, SENSOR, struct
from rillflow.session import scratch_path
from rillflow.sinks import files, keyed, topics
from rillflow.sources import records as record_files
from rillflow.sources import stores
from rillflow.sources.files import csv_table, text_lines
from rillflow.sources.topics import csv_topic, decode, read_topic
from rillflow.streaming import jobs

SALES = struct(
    dt="string", id="string", value="string", o="bigint", n="int", s="bigint",
)


def _sales_table(t: Tables) -> keyed.KeyedTable:
    """Two batches of line items by year and part, the second one written twice."""
    lines = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy").alias("dt"), text("l_partkey").alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("value"), F.col("l_orderkey").alias("o"),
        F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("s"), "l_returnflag",
    )
    table = keyed.KeyedTable(
        scratch_path(t.spark, "sales"), ("id",), SALES, ("value", "o", "n", "s")
    )
    table.write_batch(lines.where(F.col("l_returnflag") != "R"), 0)
    for _ in range(2):
        table.write_batch(lines.where(F.col("l_returnflag") == "R"), 1)
    return table


UPSERTED = """WITH ranked AS (
  SELECT strftime(l_shipdate, '%Y') AS dt, CAST(l_partkey AS VARCHAR) AS id,
         strftime(l_shipdate, '%Y-%m-%d') AS value, l_orderkey AS o, l_linenumber AS n, l_suppkey AS s,
         row_number() OVER (PARTITION BY l_partkey, strftime(l_shipdate, '%Y')
           ORDER BY l_returnflag = 'R' DESC, l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                    l_suppkey DESC) AS rn FROM lineitem)
SELECT dt, id, value, o, n, s FROM ranked WHERE rn = 1"""


@query(UPSERTED)
def upsert_by_key(t):
    """SNK-06, STR-09: the last batch wins, a repeated batch changes nothing."""
    return _sales_table(t).read(t.spark)


@query(UPSERTED)
def compacted_table(t):
    """SNK-15: the same rows in few files."""
    return _sales_table(t).compact(t.spark, scratch_path(t.spark, "compact")).read(t.spark)


@query("""SELECT 'sensor_temp' AS table_name, concat('sensor_', user_id) AS key,
  CAST(arg_max(event_type, event_id) AS VARCHAR) AS value, max(event_id) AS seq
FROM events GROUP BY user_id""")
def hash_upsert(t):
    """SNK-09: the last reading's kind per sensor."""
    table = keyed.hash_table(scratch_path(t.spark, "hash"))
    table.write_batch(keyed.hash_rows(readings(t), "sensor_temp", "id", "kind", "seq"), 0)
    return table.read(t.spark)


@query("SELECT s_suppkey, count(*) * 2 AS copies FROM supplier GROUP BY s_suppkey")
def appended_twice(t):
    """SNK-07: appending again keeps both."""
    path = scratch_path(t.spark, "append")
    for _ in range(2):
        keyed.append_rows(t.supplier, path)
    return t.spark.read.parquet(path).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("copies"))


@query(f"WITH {READINGS} SELECT id AS sensor_id, CAST(kind AS VARCHAR) AS kind, CAST(\"timestamp\" AS VARCHAR) AS ts FROM readings")
def document_strings(t):
    """SNK-08."""
    return keyed.renamed_strings(readings(t), sensor_id="id", kind="kind", ts="timestamp")


@query(f"WITH {READINGS} SELECT id, temperature AS cnt FROM readings")
def csv_table_by_position(t):
    """SNK-03, SRC-04: columns bind by position."""
    schema, path = struct(id="string", cnt="double"), scratch_path(t.spark, "csv")
    files.insert_by_position(readings(t).select("id", F.col("temperature").alias("temp")), schema, path)
    csv_table(t.spark, path, schema, "output_table")
    return t.spark.sql("SELECT id, cnt FROM output_table")


@query("""SELECT '20240131' AS clndr_dt_id, '07' AS hour_id, p_name AS value FROM part""")
def ingested_files(t):
    """SNK-14: two sources into one day and hour, one of them twice; files lie side by side."""
    target, names = scratch_path(t.spark, "ingest"), t.part.select("p_name", "p_size")
    sources = []
    for part in ("p_size < 25", "p_size >= 25"):
        sources.append(scratch_path(t.spark, "lines"))
        names.where(part).select("p_name").write.text(sources[-1])
    for source in (*sources, sources[0]):
        files.ingest_files(t.spark, source, target, "20240131", "07")
    schema = "value string, file_name string, clndr_dt_id string, hour_id string"
    return t.spark.read.schema(schema).parquet(target).select("clndr_dt_id", "hour_id", "value")


@query(f"""WITH {PAGE_VIEWS} SELECT mid, page_id, last_page_id, during_time, ts FROM page_views""")
def topic_round_trip(t):
    """SNK-02, SRC-05, PIP-07: messages written to a topic, read as a stream and decoded."""
    path, root = scratch_path(t.spark, "topic"), scratch_path(t.spark, "decoded")
    sent = topics.messages(page_views(t).select(*PAGE_LOG.fieldNames()), "pages", F.col("mid"))
    topics.write_messages(sent, "parquet", path)
    schema = struct(key="string", value="string", topic="string")
    got, _ = decode(read_topic(t.spark, {}, "parquet", schema, path), PAGE_LOG)
    jobs.run(got, f"{root}/checkpoint", path=f"{root}/table")
    saved = t.spark.read.schema(PAGE_LOG).parquet(f"{root}/table")
    return saved.select("mid", "page_id", "last_page_id", "during_time", "ts")


@query(f"""WITH {READINGS} SELECT id, "timestamp", temperature FROM readings""")
def csv_topic_round_trip(t):
    """SNK-04, SRC-07: append-only CSV messages and the table over them."""
    path = scratch_path(t.spark, "csv-topic")
    sent = topics.csv_messages(readings(t).select(*SENSOR.fieldNames()), "sensors")
    topics.write_messages(sent, "parquet", path)
    csv_topic(t.spark.read.parquet(path), SENSOR, "sensor_topic")
    return t.spark.sql("SELECT id, timestamp, temperature FROM sensor_topic")


@query("""SELECT event_id, seq % 7 = 0 OR seq % 11 = 0 AS rejected
FROM (SELECT event_id, event_id AS seq FROM events)""")
def decode_rejects(t):
    """PIP-07: broken and missing messages are rejected, none becomes a record of nulls."""
    seq, sent = F.col("event_id"), t.events.select("event_id", "event_type")
    whole = topics.messages(sent, "events", text("event_id"))
    number = F.col("key").cast("bigint")
    broken = F.when(number % 11 == 0, F.lit(None)).when(number % 7 == 0, F.substring("value", 1, 12))
    found = whole.withColumn("value", broken.otherwise(F.col("value")))
    records, rejects = decode(found, struct(event_id="bigint", event_type="string"))
    bad = rejects.select(F.col("key").cast("bigint").alias("event_id"), F.lit(True).alias("rejected"))
    return records.select(seq, F.lit(False).alias("rejected")).unionByName(bad)


@query(f"""WITH {READINGS} SELECT concat(id, CASE WHEN seq % 5 = 0 THEN ',late' ELSE '' END) AS line,
  seq % 5 = 0 AS rejected FROM readings""")
def csv_topic_rejects(t):
    """SRC-07: lines that are no records are returned."""
    wrong = F.when(F.col("seq") % 5 == 0, "late").otherwise(text("timestamp"))
    line = F.concat_ws(",", "id", wrong, F.when(F.col("seq") % 5 != 0, text("temperature")))
    sent = readings(t).select(F.lit("sensors").alias("topic"), line.alias("value"))
    records, rejects = csv_topic(sent, SENSOR)
    good = records.select(F.col("id").alias("line"), F.lit(False).alias("rejected"))
    return good.unionByName(rejects.select("line", F.lit(True).alias("rejected")))


@query("""SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split(line, ' ')) AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations))
WHERE length(word) > 0 GROUP BY word""")
def text_file_words(t):
    """SRC-02: text written as lines, read back as lines and counted."""
    path = scratch_path(t.spark, "text")
    t.conversations.select("text").write.text(path)
    return aggregates.word_count(text_lines(t.spark, path), keep_empty=False)


@query("""SELECT CAST(c_custkey AS VARCHAR) || chr(9) || c_nationkey AS key,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name || chr(10) || '\\t' || chr(92) END AS value
FROM customer""")
def record_round_trip(t):
    """EXT-04, EXT-05: the partitioned Python source and sink; the second write replaces the first."""
    record_files.register(t.spark)
    path = scratch_path(t.spark, "records")
    value = F.concat(F.col("c_name"), F.lit("\n\\t\\"))
    pairs = t.customer.select(
        F.concat_ws("\t", text("c_custkey"), text("c_nationkey")).alias("key"),
        F.when(F.col("c_nationkey") != 3, value).alias("value"),
    )
    for _ in range(2):
        pairs.write.format("keyed_records").mode("overwrite").save(path)
    return t.spark.read.format("keyed_records").option("path", path).load()


def _daily_pages(t: Tables) -> str:
    path = scratch_path(t.spark, "pages")
    days = page_views(t).withColumn("dt", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
    days.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    return path


@query(f"""WITH {PAGE_VIEWS} SELECT mid FROM page_views
WHERE strftime(make_timestamp(ts * 1000), '%Y-%m-%d') = '2024-01-15'""")
def day_field(t):
    """SRC-13: one column of one day, without a row cap."""
    return stores.day_field(t.spark, _daily_pages(t), "2024-01-15", "mid")


@query(f"""WITH {PAGE_VIEWS} SELECT strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt, page_id,
  count(*) AS cnt FROM page_views GROUP BY ALL""")
def day_view(t):
    """ALS-04: one name over all days, under a declared schema."""
    views.publish_days(
        t.spark, "all_pages", _daily_pages(t), struct(mid="string", page_id="string", dt="string")
    )
    return t.spark.sql("SELECT dt, page_id, count(*) AS cnt FROM all_pages GROUP BY dt, page_id")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS app_code, p_size AS task_code, p_name AS task_cells,
  p_type AS task_labels, 1 AS task_state, CAST(length(p_name) AS INTEGER) AS cells_length,
  CAST(length(p_type) AS INTEGER) AS labels_length FROM part""")
def task_projection(t):
    """SRC-09: the projection that runs on the JDBC reader's rows."""
    return stores.task_info(t.part.select(
        text("p_partkey").alias("app_code"), F.col("p_size").alias("task_code"),
        F.col("p_name").alias("task_cells"), F.col("p_type").alias("task_labels"),
        F.lit(1).alias("task_state"),
    ))
