"""The engine's records made from the driver's tables, in both languages.

Every record comes as a DataFrame function and as a SQL common table expression of the same
name and columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.catalog.registry import Tables
from rillflow.functions import compute_once
from rillflow.session import spread

AS_OF = "2024-02-28"


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def millis(time: str) -> Column:
    return F.unix_millis(F.col(time).cast("timestamp"))


def k_of_props() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# -- sensor readings ---------------------------------------------------------------


def readings(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.lit("sensor_"), text("user_id")).alias("id"),
        F.floor(millis("ts") / 1000).alias("timestamp"), millis("ts").alias("ms"), "ts",
        F.col("event_id").alias("seq"), F.col("value").alias("temperature"),
        F.col("event_type").alias("kind"),
    )


READINGS = """readings AS (
  SELECT concat('sensor_', user_id) AS id, epoch_us(ts) // 1000000 AS "timestamp",
         epoch_us(ts) // 1000 AS ms, ts, event_id AS seq, value AS temperature, event_type AS kind
  FROM events)"""


def delayed_readings(t: Tables) -> DataFrame:
    """Readings with the time they arrive: ``k`` minutes after they were taken."""
    return t.events.select(
        F.col("event_type").alias("source"), F.col("event_id").alias("seq"),
        F.concat(F.lit("sensor_"), text("user_id")).alias("id"), millis("ts").alias("ms"),
        (millis("ts") + 60_000 * k_of_props()).alias("arrival"),
    )


DELAYED = """delayed AS (
  SELECT event_type AS source, event_id AS seq, concat('sensor_', user_id) AS id,
         epoch_us(ts) // 1000 AS ms,
         epoch_us(ts) // 1000 + 60000 * CAST(json_extract_string(props, '$.k') AS BIGINT) AS arrival
  FROM events)"""

# -- page views and log lines ------------------------------------------------------


def page_views(t: Tables) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    return t.events.select(
        F.concat(F.lit("mid_"), text(user)).alias("mid"), text(user).alias("user_id"),
        text(user % 25).alias("province_id"), F.lit("web").alias("channel"),
        F.when(kind == "signup", "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("m"), text(user % 7)).alias("model"), F.lit("os").alias("operate_system"),
        F.lit("v1").alias("version_code"), F.concat(F.lit("b"), text(user % 5)).alias("brand"),
        kind.alias("page_id"),
        F.when(kind == "view", F.lit(None)).when(kind == "signup", "").otherwise("home")
        .alias("last_page_id"),
        text(k_of_props()).alias("page_item"), F.lit("k").alias("page_item_type"),
        k_of_props().alias("during_time"), F.lit("event").alias("sourceType"),
        millis("ts").alias("ts"), "event_id",
    )


PAGE_VIEWS = """page_views AS (
  SELECT concat('mid_', user_id) AS mid, CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id % 25 AS VARCHAR) AS province_id, 'web' AS channel,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
         concat('m', user_id % 7) AS model, 'os' AS operate_system, 'v1' AS version_code,
         concat('b', user_id % 5) AS brand, event_type AS page_id,
         CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'signup' THEN ''
              ELSE 'home' END AS last_page_id,
         json_extract_string(props, '$.k') AS page_item, 'k' AS page_item_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS during_time,
         'event' AS "sourceType", epoch_us(ts) // 1000 AS ts, event_id
  FROM events)"""


def log_lines(t: Tables) -> DataFrame:
    """Log lines: errors, page views with displays, clicks with actions, starts."""
    view, kind = page_views(t), F.col("page_id")
    common = F.struct(
        F.col("province_id").alias("ar"), F.col("user_id").alias("uid"),
        F.col("operate_system").alias("os"), F.col("channel").alias("ch"), "is_new",
        F.col("model").alias("md"), "mid", F.col("version_code").alias("vc"),
        F.col("brand").alias("ba"),
    )
    page = F.struct(
        "page_id", F.col("page_item").alias("item"), "during_time",
        F.col("page_item_type").alias("item_type"), "last_page_id",
        F.col("sourceType").alias("source_type"),
    )

    def display(order: int) -> Column:
        return F.struct(
            F.lit("promotion").alias("display_type"), F.col("page_item").alias("item"),
            F.lit("sku_id").alias("item_type"), F.lit(order).alias("order"),
            F.lit("5").alias("pos_id"),
        )

    def action(name: str, after: int) -> Column:
        return F.struct(
            F.lit(name).alias("action_id"), F.col("page_item").alias("item"),
            F.lit("sku_id").alias("item_type"), text(F.col("ts") + after).alias("ts"),
        )

    line = F.struct(
        F.when(kind == "error", F.struct(F.col("page_item").alias("code"))).alias("err"),
        common.alias("common"),
        F.when(kind != "signup", page).alias("page"),
        F.when(kind == "view", F.array(display(1), display(2)))
        .when(kind == "purchase", F.array(display(1))).alias("displays"),
        F.when(kind == "click", F.array(action("open", 1)))
        .when(kind == "purchase", F.array(action("cart", 1), action("pay", 2))).alias("actions"),
        F.when(
            kind == "signup",
            F.struct(
                F.lit("icon").alias("entry"), F.col("during_time").alias("loading_time"),
                F.lit("7").alias("open_ad_id"), text(F.col("during_time") * 2).alias("open_ad_ms"),
                F.lit(0).alias("open_ad_skip_ms"),
            ),
        ).alias("start"),
        F.col("ts"),
    )
    lines = compute_once(spread(view, large=True), "value", F.to_json(line))
    return lines.select("value", "event_id")


# -- dimensions ------------------------------------------------------------------


def users(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    return t.customer.select(
        text("c_custkey").alias("id"),
        F.when(segment.isin("BUILDING", "HOUSEHOLD"), "F")
        .when(segment.isin("MACHINERY", "AUTOMOBILE"), "M").otherwise("U").alias("gender"),
        text(F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 7919 % 24000).cast("int")))
        .alias("birthday"),
    )


USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F'
              WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'M' ELSE 'U' END AS gender,
         strftime(DATE '1950-01-01' + CAST(c_custkey * 7919 % 24000 AS INTEGER), '%Y-%m-%d')
           AS birthday
  FROM customer)"""

AGE = f"""CAST(date_diff('year', CAST(birthday AS DATE), DATE '{AS_OF}')
  - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') < strftime(CAST(birthday AS DATE), '%m%d')
         THEN 1 ELSE 0 END AS INTEGER)"""


def provinces(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("CN-"), text("n_nationkey")).alias("iso_code"),
        F.concat(F.substring("r_name", 1, 2), F.lit("-"), text("n_nationkey")).alias("iso_3166_2"),
        text(F.col("n_nationkey") + 100).alias("area_code"),
    )


PROVINCES = """provinces AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, concat('CN-', n_nationkey) AS iso_code,
         concat(substr(r_name, 1, 2), '-', n_nationkey) AS iso_3166_2,
         CAST(n_nationkey + 100 AS VARCHAR) AS area_code
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

# -- orders ------------------------------------------------------------------------


def order_infos(t: Tables) -> DataFrame:
    zero, none = F.lit(0.0), F.lit(None).cast("string")
    created = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"), zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"), F.col("o_totalprice").alias("original_total_amount"),
        zero.alias("feight_fee"), zero.alias("feight_fee_reduce"), none.alias("expire_time"),
        none.alias("refundable_time"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("o_orderpriority").alias("operate_time"),
    )


ORDER_INFOS = """order_infos AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, o_totalprice AS total_amount, 0.0::DOUBLE AS activity_reduce_amount,
         0.0::DOUBLE AS coupon_reduce_amount, o_totalprice AS original_total_amount,
         0.0::DOUBLE AS feight_fee, 0.0::DOUBLE AS feight_fee_reduce,
         CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
         strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
           AS create_time,
         o_orderpriority AS operate_time
  FROM orders)"""


def order_lines(t: Tables) -> DataFrame:
    """Details as they arrive, without the names of what was sold."""
    line_id = F.concat_ws("-", *[text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return t.lineitem.select(
        line_id.alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"), F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"),
        F.col("l_discount").alias("split_activity_amount"), F.col("l_tax").alias("split_coupon_amount"),
    )


def with_sku_name(lines: DataFrame, part: DataFrame) -> DataFrame:
    """Name of what was sold; a missing part leaves null."""
    names = part.select(F.col("p_partkey").alias("_sku"), F.col("p_name").alias("sku_name"))
    return lines.join(names, F.col("sku_id") == F.col("_sku"), "left").drop("_sku")


def order_details(t: Tables) -> DataFrame:
    return with_sku_name(order_lines(t), t.part)


ORDER_DETAILS = """order_details AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         l_orderkey AS order_id, l_partkey AS sku_id, l_extendedprice AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, p_name AS sku_name,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         l_extendedprice AS split_total_amount, l_discount AS split_activity_amount,
         l_tax AS split_coupon_amount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

ORDER_WIDE = f"""{USERS},
{PROVINCES},
{ORDER_INFOS},
{ORDER_DETAILS},
order_wide AS (
  SELECT d.id AS detail_id, d.order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
         d.split_total_amount, d.split_activity_amount, d.split_coupon_amount, i.province_id,
         i.order_status, i.user_id, i.total_amount, i.activity_reduce_amount,
         i.coupon_reduce_amount, i.original_total_amount, i.feight_fee, i.feight_fee_reduce,
         i.expire_time, i.refundable_time, d.create_time, i.operate_time,
         substr(i.create_time, 1, 10) AS create_date, substr(i.create_time, 12, 2) AS create_hour,
         p.name AS province_name, p.area_code AS province_area_code,
         p.iso_3166_2 AS province_3166_2_code, p.iso_code AS province_iso_code,
         {AGE} AS user_age, u.gender AS user_gender
  FROM order_infos i JOIN order_details d ON i.id = d.order_id
  LEFT JOIN users u ON u.id = CAST(i.user_id AS VARCHAR)
  LEFT JOIN provinces p ON p.id = CAST(i.province_id AS VARCHAR))"""

# -- change events ------------------------------------------------------------------

# Fixed values of the test mapping: what happened to a row, told by one of its columns.
ORDER_EVENTS = {"F": "insert", "O": "update", "P": "delete"}
USER_EVENTS = {
    "BUILDING": "bootstrap-insert", "HOUSEHOLD": "insert", "MACHINERY": "update",
    "AUTOMOBILE": "delete", "FURNITURE": "bootstrap-start",
}
FACT_TABLES, DIM_TABLES = ["order_info", "order_detail"], ["user_info", "base_province"]


def change_lines(t: Tables) -> DataFrame:
    """Change events of orders, customers and suppliers; nobody listens to the last."""

    def event(kind: Column, table: str, data: Column) -> Column:
        line = F.struct(kind.alias("type"), F.lit(table).alias("table"), data.alias("data"))
        return F.to_json(line).alias("value")

    def happened(column: str, events: dict[str, str]) -> Column:
        kind = F.lit(None).cast("string")
        for value, name in events.items():
            kind = F.when(F.col(column) == value, name).otherwise(kind)
        return kind

    orders = t.orders.select(
        event(
            happened("o_orderstatus", ORDER_EVENTS), "order_info",
            F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
                     F.col("o_orderstatus").alias("order_status")),
        ),
        F.col("o_orderkey").alias("seq"),
    )
    customers = t.customer.select(
        event(
            happened("c_mktsegment", USER_EVENTS), "user_info",
            F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        ),
        F.col("c_custkey").alias("seq"),
    )
    suppliers = t.supplier.select(
        event(
            F.lit("insert"), "supplier_info",
            F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        ),
        F.col("s_suppkey").alias("seq"),
    )
    return orders.unionByName(customers).unionByName(suppliers)


def table_list(t: Tables, names: list[str]) -> DataFrame:
    return t.spark.createDataFrame([(n,) for n in names], "table_name string")


# -- documents with a nested array -----------------------------------------------------


def movies(t: Tables) -> DataFrame:
    """Parts as documents: the name, a score and an array of named objects."""

    def item(i: int, name: Column) -> Column:
        return F.struct(F.lit(i).cast("bigint").alias("id"), name.alias("name"))

    brand, kind = F.lower("p_brand"), F.lower("p_type")
    first = F.split("p_name", " ")[0]
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        (F.col("p_size") / 5).alias("doubanScore"),
        F.array(item(1, brand), item(2, kind), item(3, F.concat_ws(" ", first, kind)))
        .alias("actorList"),
    )


MOVIES = """movies AS (
  SELECT p_partkey AS id, p_name AS name, p_size / 5 AS "doubanScore",
         [lower(p_brand), lower(p_type), concat(split_part(p_name, ' ', 1), ' ', lower(p_type))]
           AS actors
  FROM part)"""

# -- cells -----------------------------------------------------------------------------


def customer_cells(t: Tables) -> DataFrame:
    from rillflow.operators.widecolumn import to_cells

    rows = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
    )
    return to_cells(rows, "key", "info", 1)


CELLS = """cells AS (
  SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'info' AS family, 'name' AS qualifier,
         CAST(1 AS BIGINT) AS ts, c_name AS value FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'info', 'nation', CAST(1 AS BIGINT),
         CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'info', 'segment', CAST(1 AS BIGINT), c_mktsegment
  FROM customer WHERE c_mktsegment <> 'FURNITURE')"""
