"""Log split, change split, daily users and wide orders."""

from pyspark.sql import functions as F

from rillflow.catalog.records import (
    AGE, AS_OF, DIM_TABLES, FACT_TABLES, ORDER_DETAILS, ORDER_INFOS, ORDER_WIDE, PAGE_VIEWS,
    PROVINCES, USERS, change_lines, log_lines, order_details, order_infos, page_views,
    provinces, table_list, users,
)
from rillflow.catalog.registry import query
from rillflow.operators import joins
from rillflow.plans import change_split, daily_users, log_split, order_wide
from rillflow.schemas import ORDER_INFO
from rillflow.sinks.topics import messages
from rillflow.sources.topics import decode

COMMON = """mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand"""
PAGE = f"{COMMON}, page_id, last_page_id, page_item, page_item_type, during_time, \"sourceType\""


def _logs(t):
    return log_split.parsed(log_lines(t))


@query(f"""WITH {PAGE_VIEWS} SELECT {PAGE}, ts FROM page_views
WHERE page_id IN ('view', 'click', 'purchase')""")
def log_split_page(t):
    """PIP-01."""
    return log_split.pages(_logs(t))


@query(f"""WITH {PAGE_VIEWS}
SELECT {PAGE}, 'promotion' AS display_type, page_item AS display_item, 'sku_id' AS display_item_type,
       display_order, '5' AS display_pos_id, ts
FROM page_views, (VALUES ('1'), ('2')) AS d(display_order)
WHERE page_id = 'view' OR (page_id = 'purchase' AND display_order = '1')""")
def log_split_display(t):
    """PIP-02."""
    return log_split.displays(_logs(t))


@query(f"""WITH {PAGE_VIEWS}, acts(kind, action_id, after) AS (
  VALUES ('click', 'open', 1), ('purchase', 'cart', 1), ('purchase', 'pay', 2))
SELECT {PAGE}, action_id, page_item AS action_item, 'sku_id' AS action_item_type,
       ts + after AS action_ts, ts FROM page_views JOIN acts ON page_id = kind""")
def log_split_action(t):
    """PIP-03; action times are quoted numbers in the log (FUN-11)."""
    return log_split.actions(_logs(t))


@query(f"""WITH {PAGE_VIEWS}
SELECT {COMMON}, 'icon' AS entry, '7' AS open_ad_id, during_time AS loading_time_ms,
       during_time * 2 AS open_ad_ms, CAST(0 AS BIGINT) AS open_ad_skip_ms, ts
FROM page_views WHERE page_id = 'signup'""")
def log_split_start(t):
    """PIP-01."""
    return log_split.starts(_logs(t))


@query("""SELECT json_extract_string(props, '$.k') AS code, epoch_us(ts) // 1000 AS ts FROM events
WHERE event_type = 'error'""")
def log_split_error(t):
    """PIP-01: the whole line, read back here field by field."""
    line = log_split.errors(_logs(t))
    return line.select(
        F.get_json_object("line", "$.err.code").alias("code"),
        F.get_json_object("line", "$.ts").cast("bigint").alias("ts"),
    )


# The messages of all topics, read back field by field; ``part`` is what sets a topic apart.
MESSAGE_FIELDS = f"""WITH {PAGE_VIEWS}, acts(kind, part) AS (
  VALUES ('click', 'open'), ('purchase', 'cart'), ('purchase', 'pay')), parts AS (
  SELECT 'DWD_PAGE_LOG_TOPIC_1018' AS topic, page_views.*, CAST(NULL AS VARCHAR) AS part
  FROM page_views WHERE page_id IN ('view', 'click', 'purchase')
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC_1018', page_views.*, part
  FROM page_views, (VALUES ('1'), ('2')) AS d(part)
  WHERE page_id = 'view' OR (page_id = 'purchase' AND part = '1')
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC_1018', page_views.*, part
  FROM page_views JOIN acts ON page_id = kind
  UNION ALL SELECT 'DWD_START_LOG_TOPIC_1018', page_views.*, 'icon' FROM page_views
  WHERE page_id = 'signup')
SELECT topic, mid, user_id, brand,
  CASE WHEN topic NOT LIKE '%START%' THEN page_id END AS page_id,
  CASE WHEN topic NOT LIKE '%START%' THEN page_item END AS page_item,
  CASE WHEN topic NOT LIKE '%START%' THEN during_time END AS during_time, part, ts FROM parts
UNION ALL
SELECT 'DWD_ERROR_LOG_TOPIC_1018', NULL, NULL, NULL, NULL, NULL, NULL,
  json_extract_string(props, '$.k'), epoch_us(ts) // 1000 FROM events WHERE event_type = 'error'"""


def message_fields(messages_):
    """Topic and fields of the log messages (topic, value)."""
    error = F.col("topic").contains("ERROR")

    def field(name):
        return F.when(~error, F.get_json_object("value", f"$.{name}"))

    part = F.coalesce(
        F.get_json_object("value", "$.display_order"), F.get_json_object("value", "$.action_id"),
        F.get_json_object("value", "$.entry"), F.get_json_object("value", "$.err.code"),
    )
    return messages_.select(
        "topic", *[field(n).alias(n) for n in ("mid", "user_id", "brand", "page_id", "page_item")],
        field("during_time").cast("bigint").alias("during_time"), part.alias("part"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
    )


@query(MESSAGE_FIELDS)
def log_split_messages(t):
    """PIP-01 as one pass over the lines, SNK-02."""
    return message_fields(log_split.split_messages(log_lines(t)))


@query(f"""WITH {PAGE_VIEWS} SELECT 'pages' AS topic, mid AS key,
  concat('{{"mid":"', mid, '"',
         CASE WHEN last_page_id IS NULL THEN '' ELSE concat(',"last_page_id":"', last_page_id, '"') END,
         ',"ts":', ts, '}}') AS value FROM page_views""")
def topic_messages(t):
    """SNK-02: absent fields are left out of the message."""
    return messages(page_views(t).select("mid", "last_page_id", "ts"), "pages", F.col("mid"))


CHANGES = """changes AS (
  SELECT 'order_info' AS tab,
         CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' WHEN 'P' THEN 'D' END AS op,
         CAST(o_orderkey AS VARCHAR) AS id,
         concat('{"id":', o_orderkey, ',"user_id":', o_custkey, ',"order_status":"', o_orderstatus,
                '"}') AS data FROM orders
  UNION ALL
  SELECT 'user_info',
         CASE c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'HOUSEHOLD' THEN 'I'
              WHEN 'MACHINERY' THEN 'U' WHEN 'AUTOMOBILE' THEN 'D' END,
         CAST(c_custkey AS VARCHAR),
         concat('{"id":', c_custkey, ',"name":"', c_name, '"}') FROM customer)"""


@query(f"""WITH {CHANGES} SELECT concat('DWD_', upper(tab), '_', op, '_1018') AS topic, data AS value
FROM changes WHERE tab = 'order_info' AND op IS NOT NULL""")
def change_facts(t):
    """PIP-04, JON-07, FUN-09, FUN-10."""
    return change_split.facts(change_split.parsed(change_lines(t)), table_list(t, FACT_TABLES))


@query(f"""WITH {CHANGES} SELECT concat(upper(tab), ':', id) AS dim_key, upper(tab) AS table_name, id,
       data AS value FROM changes WHERE tab = 'user_info' AND op IS NOT NULL""")
def change_dimensions(t):
    """PIP-04, SNK-10: a delete still writes its row."""
    return change_split.dimensions(change_split.parsed(change_lines(t)), table_list(t, DIM_TABLES))


@query(f"""WITH {CHANGES} SELECT tab AS "table", op, count(*) AS cnt FROM changes
WHERE op IS NOT NULL GROUP BY ALL""")
def listed_changes(t):
    """JON-07: a semi join against the lists."""
    changes = change_split.parsed(change_lines(t))
    listed = joins.in_tables(changes, table_list(t, FACT_TABLES + DIM_TABLES))
    return listed.groupBy("table", "op").agg(F.count(F.lit(1)).alias("cnt"))


DAU = f"""{PAGE_VIEWS},
{USERS},
{PROVINCES},
ranked AS (
  SELECT *, make_timestamp(ts * 1000) AS seen,
         row_number() OVER (PARTITION BY mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d')
                            ORDER BY ts, event_id) AS rn
  FROM page_views WHERE last_page_id IS NULL),
dau AS (
  SELECT mid, user_id, province_id, channel, is_new, model, operate_system, version_code, brand,
         page_id, page_item, page_item_type, "sourceType", during_time, gender AS user_gender,
         CAST({AGE} AS VARCHAR) AS user_age, name AS province_name, iso_code AS province_iso_code,
         iso_3166_2 AS province_3166_2, area_code AS province_area_code,
         strftime(seen, '%Y-%m-%d') AS dt, strftime(seen, '%H') AS hr, ts
  FROM ranked LEFT JOIN users u ON u.id = user_id LEFT JOIN provinces p ON p.id = province_id
  WHERE rn = 1)"""


def dau(t):
    return daily_users.daily_users(
        page_views(t), users(t), provinces(t), F.lit(AS_OF), tie="event_id"
    )


@query(f"WITH {DAU} SELECT * FROM dau")
def dau_enriched(t):
    """PIP-05, JON-01, JON-02."""
    return dau(t)


@query(f"""WITH {ORDER_INFOS} SELECT id, user_id, total_amount, feight_fee, expire_time, create_time,
       0.0::DOUBLE AS coupon_reduce_amount FROM order_infos""")
def order_decode(t):
    """PIP-07: JSON messages to typed records, absent numbers are 0."""
    sent = order_infos(t).withColumn("user_id", F.col("user_id").cast("string"))
    decoded, _ = decode(messages(sent.drop("coupon_reduce_amount"), "orders"), ORDER_INFO, zero_numbers=True)
    return decoded.select(
        "id", "user_id", "total_amount", "feight_fee", "expire_time", "create_time",
        "coupon_reduce_amount",
    )


def wide(t):
    return order_wide.wide_orders(
        order_infos(t), order_details(t), users(t), provinces(t), F.lit(AS_OF)
    )


@query(f"WITH {ORDER_WIDE} SELECT * FROM order_wide", name="order_wide")
def wide_orders(t):
    """PIP-06, JON-04, JON-05."""
    return wide(t)


@query(f"""WITH {ORDER_INFOS}, {ORDER_DETAILS}
SELECT coalesce(i.id, d.order_id) AS order_id, d.id AS detail_id,
       CASE WHEN d.id IS NULL THEN 'info_only' WHEN i.id IS NULL THEN 'detail_only'
            ELSE 'both' END AS match_state
FROM order_infos i FULL OUTER JOIN order_details d ON i.id = d.order_id""")
def order_match_state(t):
    """JON-06."""
    return joins.match_states(order_infos(t), order_details(t))


@query("""SELECT 1 AS source, CAST(user_id AS VARCHAR) AS id, value AS amount FROM events
UNION ALL SELECT 2, CAST(o_orderkey AS VARCHAR), o_totalprice FROM orders""")
def tagged_inputs(t):
    """JON-08."""
    return joins.connected(t.events, t.orders, {
        "id": (F.col("user_id").cast("string"), F.col("o_orderkey").cast("string")),
        "amount": (F.col("value"), F.col("o_totalprice")),
    })


@query(f"""WITH {USERS}, {PROVINCES}
SELECT count(*) FILTER (WHERE u.id IS NULL) AS missing_user_gender,
       count(*) FILTER (WHERE p.id IS NULL) AS missing_province_name
FROM supplier LEFT JOIN users u ON u.id = CAST(s_suppkey * 40 AS VARCHAR)
LEFT JOIN provinces p ON p.id = CAST(s_nationkey AS VARCHAR)""")
def missing_dimension_counts(t):
    """JON-01, JON-02: facts without a dimension row are kept and counted."""
    facts = t.supplier.select(
        (F.col("s_suppkey") * 40).alias("user_id"), F.col("s_nationkey").alias("province_id")
    )
    known = joins.with_user(facts, users(t), F.lit(AS_OF))
    placed = joins.with_province(known, provinces(t))
    return joins.missing_dimensions(placed, "user_gender", "province_name")
