"""Record schemas: sensor readings, application logs, change events, orders, cells."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A schema from type names; needs no running session."""
    return T.StructType([T.StructField(n, _TYPES.get(t, t)) for n, t in fields.items()])


def texts(names: str) -> T.StructType:
    return struct(**dict.fromkeys(names.split(), "string"))


SENSOR = struct(id="string", timestamp="bigint", temperature="double")

COMMON_FIELDS = [
    "mid", "user_id", "province_id", "channel", "is_new", "model",
    "operate_system", "version_code", "brand",
]
_COMMON = {name: "string" for name in COMMON_FIELDS}
_PAGE = {
    "page_id": "string", "last_page_id": "string", "page_item": "string",
    "page_item_type": "string",
}

PAGE_LOG = struct(
    **_COMMON, **_PAGE, during_time="bigint", sourceType="string", ts="bigint"
)
PAGE_DISPLAY = struct(
    **_COMMON, **_PAGE, sourceType="string", during_time="bigint",
    display_type="string", display_item="string", display_item_type="string",
    display_order="string", display_pos_id="string", ts="bigint",
)
PAGE_ACTION = struct(
    **_COMMON, **_PAGE, sourceType="string", during_time="bigint",
    action_id="string", action_item="string", action_item_type="string",
    action_ts="bigint", ts="bigint",
)
START_LOG = struct(
    **_COMMON, entry="string", open_ad_id="string", loading_time_ms="bigint",
    open_ad_ms="bigint", open_ad_skip_ms="bigint", ts="bigint",
)
DAU_INFO = struct(
    **_COMMON, page_id="string", page_item="string", page_item_type="string",
    sourceType="string", during_time="bigint", user_gender="string",
    user_age="string", province_name="string", province_iso_code="string",
    province_3166_2="string", province_area_code="string", dt="string",
    hr="string", ts="bigint",
)

ORDER_INFO = struct(
    id="bigint", province_id="bigint", order_status="string", user_id="bigint",
    total_amount="double", activity_reduce_amount="double",
    coupon_reduce_amount="double", original_total_amount="double",
    feight_fee="double", feight_fee_reduce="double", expire_time="string",
    refundable_time="string", create_time="string", operate_time="string",
)
ORDER_DETAIL = struct(
    id="bigint", order_id="bigint", sku_id="bigint", order_price="double",
    sku_num="bigint", sku_name="string", create_time="string",
    split_total_amount="double", split_activity_amount="double",
    split_coupon_amount="double",
)
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "feight_fee_reduce", "expire_time", "refundable_time",
    "create_time", "operate_time", "create_date", "create_hour",
    "province_name", "province_area_code", "province_3166_2_code",
    "province_iso_code", "user_age", "user_gender",
]

USER_DIM = texts("id gender birthday")
PROVINCE_DIM = texts("id name iso_code iso_3166_2 area_code")

# Application log line. Numbers are declared as strings and cast later: a quoted
# number must still be read as a number.
LOG_LINE = struct(
    common=texts("ar uid os ch is_new md mid vc ba"),
    ts="string",
    page=texts("page_id item during_time item_type last_page_id source_type"),
    displays=T.ArrayType(texts("display_type item item_type order pos_id")),
    actions=T.ArrayType(texts("action_id item item_type ts")),
    start=texts("entry loading_time open_ad_id open_ad_ms open_ad_skip_ms"),
    # Of any shape, kept as text.
    err="string",
)

# Database change event; `data` stays text because its shape depends on the table.
CHANGE = texts("type table data")

CELL = struct(
    row_key="string", family="string", qualifier="string", ts="bigint", value="string"
)

MOVIE = struct(
    id="bigint", name="string", doubanScore="double",
    actorList=T.ArrayType(struct(id="bigint", name="string")),
)

JDBC_TASK = struct(
    app_code="string", task_code="int", task_cells="string", task_labels="string",
    task_start_time="timestamp_ntz", task_end_time="timestamp_ntz", task_state="int",
)
