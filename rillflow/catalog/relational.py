"""Projection, filter, function and aggregation queries."""

from pyspark.sql import functions as F

from rillflow.catalog.records import (
    AGE, AS_OF, PAGE_VIEWS, READINGS, USERS, k_of_props, page_views, readings, text, users,
)
from rillflow.catalog.registry import query
from rillflow.functions import (
    age_years, copy_fields, day_from_text, day_of_millis, hour_from_text, hour_of_millis,
    previous_day, reversed_key, salted_key, seconds_to_time, split_at,
)
from rillflow.operators import aggregates, relational
from rillflow.schemas import DAU_INFO, SENSOR
from rillflow.sinks.keyed import pairs_from_entries
from rillflow.sources.files import parse_lines
from rillflow.sources.stores import hash_entries


@query(f"WITH {READINGS} SELECT id, temperature FROM readings WHERE kind = 'click'")
def select_filter_sql(t):
    """PRJ-01, FLT-01: the SQL form; Catalyst gives the fluent form the same plan."""
    readings(t).createOrReplaceTempView("readings")
    return t.spark.sql("SELECT id, temperature FROM readings WHERE kind = 'click'")


@query(f"WITH {READINGS} SELECT id, temperature FROM readings WHERE kind = 'click'")
def select_filter_fluent(t):
    return readings(t).where(F.col("kind") == "click").select("id", "temperature")


@query(f'WITH {READINGS} SELECT id, temperature AS temp, "timestamp" AS ts FROM readings')
def renamed_projection(t):
    return readings(t).select("id", F.col("temperature").alias("temp"), F.col("timestamp").alias("ts"))


@query(f"""WITH {PAGE_VIEWS}
SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand,
       page_id, page_item, page_item_type, "sourceType", during_time,
       CAST(NULL AS VARCHAR) AS user_gender, CAST(NULL AS VARCHAR) AS dt, ts FROM page_views""")
def copied_fields(t):
    """PRJ-04: same-named fields are copied, fields the source lacks stay null."""
    views = page_views(t)
    looked_up = ("province_name", "province_iso_code", "province_3166_2", "province_area_code")
    names = [n for n in DAU_INFO.fieldNames() if n not in looked_up]
    row = views.select(F.struct(*views.columns).alias("row"))
    copied = copy_fields(row, names, "row").drop("user_age", "hr")
    return copied.withColumns({c: F.col(c).cast("string") for c in ("user_gender", "dt")})


LINES = "lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"


def _lines(t):
    return t.documents.select(F.explode(F.split("text", "\n")).alias("value"))


@query(f"""WITH {LINES}, words AS (
  SELECT unnest(string_split(regexp_replace(value, ' +$', ''), ' ')) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words GROUP BY word""")
def word_count(t):
    """AGG-01, PRJ-05: empty words inside a line count."""
    return aggregates.word_count(_lines(t))


@query(f"""WITH {LINES}, words AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines)
SELECT word, count(*) AS cnt FROM words WHERE length(word) > 0 GROUP BY word""")
def nonempty_word_count(t):
    """FLT-02: the form of the stream."""
    return aggregates.word_count(_lines(t), keep_empty=False)


@query(f"WITH {PAGE_VIEWS} SELECT mid, page_id, ts FROM page_views WHERE last_page_id IS NULL")
def entry_pages(t):
    """FLT-03: null counts, the empty text does not."""
    return page_views(t).where(F.col("last_page_id").isNull()).select("mid", "page_id", "ts")


@query(f"WITH {READINGS} SELECT id, count(id) AS cnt FROM readings GROUP BY id")
def group_count(t):
    return aggregates.group_count(readings(t), "id")


@query("""WITH numbered AS (
  SELECT event_type AS kind, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n
  FROM events)
SELECT kind, true AS is_add, n AS cnt, 2 * n - 1 AS step FROM numbered
UNION ALL SELECT kind, false, n - 1, 2 * n - 2 FROM numbered WHERE n > 1""")
def retract_changelog(t):
    """AGG-04."""
    return aggregates.retract_changelog(readings(t), "kind", ["ts", "seq"])


@query(f"""WITH {READINGS} SELECT id, max("timestamp") AS "timestamp", min(temperature) AS temperature
FROM readings GROUP BY id""")
def reduced_readings(t):
    """AGG-05."""
    return aggregates.reduce_readings(readings(t), "id")


@query(f"""WITH {READINGS}
SELECT id, min(temperature) AS temperature, arg_min(ms, seq) AS min_ms,
       min(seq) AS min_seq, arg_min(ms, (temperature, seq)) AS minby_ms,
       arg_min(seq, (temperature, seq)) AS minby_seq
FROM readings GROUP BY id""")
def min_vs_minby(t):
    """AGG-06; rows arrive in the order of their sequence number."""
    rows = readings(t).select("id", "temperature", "ms", "seq")
    return aggregates.min_and_min_by(rows, "id", "temperature", ["seq"])


@query(f"WITH {READINGS} SELECT id, \"timestamp\", temperature FROM readings WHERE temperature > 30")
def side_output_high(t):
    """FLT-14, main output."""
    return relational.threshold_split(readings(t), "temperature", 30)[0].select(*SENSOR.fieldNames())


@query(f"WITH {READINGS} SELECT id, temperature, \"timestamp\" FROM readings WHERE temperature <= 30")
def side_output_low(t):
    """FLT-14, side output; exactly 30 is low."""
    return relational.threshold_split(readings(t), "temperature", 30)[1]


@query(f"""WITH {READINGS}, tagged AS (
  SELECT 'errors' AS tag FROM readings WHERE kind = 'error'
  UNION ALL SELECT 'hot' FROM readings WHERE temperature > 30
  UNION ALL SELECT 'cold' FROM readings WHERE temperature < 5)
SELECT tag, count(*) AS cnt FROM tagged GROUP BY tag""")
def tagged_split(t):
    """FLT-15: branches by tag, a row may be in several."""
    kind, heat = F.col("kind"), F.col("temperature")
    found = relational.tagged(readings(t), errors=kind == "error", hot=heat > 30, cold=heat < 5)
    return found.groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_extract(t):
    """FUN-11."""
    return t.events.select("event_id", k_of_props().alias("k"))


@query("""SELECT o_orderkey, concat('{"id":', o_orderkey, ',"status":"', o_orderstatus, '"}') AS doc
FROM orders""")
def json_build(t):
    """FUN-12."""
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")))
    return t.orders.select("o_orderkey", doc.alias("doc"))


@query(f"WITH {USERS} SELECT id, birthday, {AGE} AS age FROM users")
def age_in_years(t):
    """FUN-04."""
    as_of = F.lit(AS_OF)
    return users(t).select("id", "birthday", age_years(F.col("birthday"), as_of).alias("age"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
       strftime(ts, '%Y-%m-%d') AS dt_text, strftime(ts, '%H') AS hr_text,
       strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday,
       epoch_us(ts) // 1000000 AS seconds FROM events""")
def day_and_hour(t):
    """FUN-02, FUN-03, FUN-05, FUN-15."""
    ms, time = F.unix_millis(F.col("ts").cast("timestamp")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id", day_of_millis(ms).alias("dt"), hour_of_millis(ms).alias("hr"),
        day_from_text(time).alias("dt_text"), hour_from_text(time).alias("hr_text"),
        previous_day(day_of_millis(ms)).alias("yesterday"),
        F.unix_seconds(seconds_to_time(F.floor(ms / 1000))).alias("seconds"),
    )


@query("""SELECT p_partkey, split_part(p_name, ' ', 2) AS second_word,
       reverse(CAST(p_partkey AS VARCHAR)) AS reversed,
       concat(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3), p_partkey) AS salted,
       upper(p_name) AS upper_name, length(p_name) AS name_length,
       abs(p_size - 25) AS distance FROM part""")
def key_functions(t):
    """FUN-01, FUN-06 .. FUN-09, FUN-13."""
    key = text("p_partkey")
    return t.part.select(
        "p_partkey", split_at(F.col("p_name"), " ", 1).alias("second_word"),
        reversed_key(key).alias("reversed"), salted_key(key).alias("salted"),
        F.upper("p_name").alias("upper_name"), F.length("p_name").cast("bigint").alias("name_length"),
        F.abs(F.col("p_size") - 25).alias("distance"),
    )


def _csv_lines(t):
    # A reading without a temperature is no record.
    bad = F.col("kind") == "error"
    line = F.concat_ws(",", "id", text("timestamp"), F.when(~bad, text("temperature")))
    return readings(t).select(line.alias("value"))


@query(f"""WITH {READINGS} SELECT id, "timestamp", temperature FROM readings WHERE kind <> 'error'""")
def csv_records(t):
    """SRC-03."""
    return parse_lines(_csv_lines(t), SENSOR)[0]


@query(f"""WITH {READINGS} SELECT concat(id, ',', "timestamp") AS line FROM readings WHERE kind = 'error'""")
def csv_rejects(t):
    return parse_lines(_csv_lines(t), SENSOR)[1]


@query("""SELECT concat(c_custkey, '-', c_mktsegment) AS entry FROM customer""")
def hash_entry_texts(t):
    """SRC-12."""
    return hash_entries(t.customer.select(text("c_custkey").alias("key"), F.col("c_mktsegment").alias("value")))


@query("""SELECT split_part(o_orderpriority, '-', 1) AS key, split_part(o_orderpriority, '-', 2) AS value,
       count(*) AS cnt FROM orders GROUP BY 1, 2""")
def hash_pairs(t):
    """SNK-09: only the first two parts of an entry are kept."""
    pairs = pairs_from_entries(t.orders.select(F.concat("o_orderpriority", F.lit("-x")).alias("entry")))
    return pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("cnt"))


@query("SELECT source AS dt, count(*) AS doc_count FROM documents GROUP BY source")
def table_counts(t):
    """AGG-15."""
    return aggregates.partition_counts(t.documents.select(F.col("source").alias("dt")))


@query("""SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 20""")
def sorted_page(t):
    """SRT-01, SRT-03: the second page."""
    order = [F.col("n_chars").desc(), F.col("doc_id").asc()]
    return relational.page(t.documents.select("doc_id", "n_chars"), order, page_no=2)
