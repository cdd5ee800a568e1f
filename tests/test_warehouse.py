"""Log split, change split, daily users and wide orders on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from rillflow.plans import change_split, daily_users, log_split, order_wide, reports
from rillflow.schemas import DAU_INFO, ORDER_DETAIL, ORDER_INFO, PAGE_LOG
from rillflow.sinks.keyed import KeyedTable
from tests.conftest import rows

COMMON = {"ar": "1", "uid": "u", "os": "o", "ch": "c", "is_new": "0", "md": "m", "mid": "d", "vc": "v", "ba": "b"}
PAGE = {"page_id": "home", "item": "3", "during_time": "120", "item_type": "sku", "last_page_id": None}
SHOW = {"display_type": "promotion", "item": "5", "item_type": "sku", "order": 1, "pos_id": 2}
ACT = {"action_id": "cart", "item": "5", "item_type": "sku", "ts": "77"}
START = {"entry": "icon", "loading_time": 9, "open_ad_id": 1, "open_ad_ms": 2, "open_ad_skip_ms": 0}

LINES = [
    # line, (page, display, action, start, error, reject)
    ({"common": COMMON, "ts": 5, "page": PAGE, "displays": [SHOW, SHOW], "actions": [ACT]}, (1, 2, 1, 0, 0, 0)),
    ({"common": COMMON, "ts": 5, "page": PAGE, "displays": []}, (1, 0, 0, 0, 0, 0)),
    ({"common": COMMON, "ts": 5, "start": START}, (0, 0, 0, 1, 0, 0)),
    ({"common": COMMON, "ts": 5, "page": PAGE, "start": START}, (1, 0, 0, 1, 0, 0)),
    ({"err": {"code": 1}, "common": COMMON, "page": PAGE, "displays": [SHOW]}, (0, 0, 0, 0, 1, 0)),
    ({"err": {"code": 1}}, (0, 0, 0, 0, 1, 0)),
    ({"err": None, "common": COMMON, "ts": 5, "displays": [SHOW]}, (0, 0, 0, 0, 0, 0)),
    ({"ts": 5, "page": PAGE}, (0, 0, 0, 0, 0, 1)),
    ('{"common": {"ar": "1"}, "page": {', (0, 0, 0, 0, 0, 1)),
    ("no json", (0, 0, 0, 0, 0, 1)),
]


@pytest.mark.parametrize("line, expected", LINES)
def test_log_split(spark, line, expected):
    text = line if isinstance(line, str) else json.dumps(line)
    lines = spark.createDataFrame([(text,)], "value string")
    logs = log_split.parsed(lines)
    parts = [log_split.pages, log_split.displays, log_split.actions, log_split.starts,
             log_split.errors, log_split.rejects]
    assert tuple(part(logs).count() for part in parts) == expected
    topics = [r.topic for r in log_split.split_messages(lines).collect()]
    for kind, n in zip(("page", "display", "action", "start", "error"), expected):
        assert topics.count(log_split.TOPICS[kind]) == n


def test_log_fields(spark):
    lines = spark.createDataFrame([(json.dumps(LINES[0][0]),)], "value string")
    logs = log_split.parsed(lines)
    page = log_split.pages(logs).first()
    assert (page.mid, page.during_time, page.last_page_id, page.ts) == ("d", 120, None, 5)
    shown = log_split.displays(logs).first()
    assert (shown.display_order, shown.display_pos_id, shown.page_id) == ("1", "2", "home")
    assert log_split.actions(logs).first().action_ts == 77
    sent = [json.loads(r.value) for r in log_split.split_messages(lines).collect() if "PAGE_LOG" in r.topic]
    assert sent[0]["during_time"] == 120 and "last_page_id" not in sent[0]


def change(kind, table, row):
    return (json.dumps({"type": kind, "table": table, "data": row}),)


def test_change_split(spark):
    lines = spark.createDataFrame(
        [
            change("insert", "order_info", {"id": 1}), change("bootstrap-insert", "user_info", {"id": 2, "gender": "F"}),
            change("delete", "user_info", {"id": 3}), change("update", "order_detail", {"id": 4}),
            change("bootstrap-start", "user_info", {}), change("insert", "unknown_table", {"id": 5}),
        ],
        "value string",
    )
    lists = [spark.createDataFrame([(n,) for n in names], "table_name string") for names in (
        ["order_info", "order_detail"], ["user_info", "base_province"])]
    changes = change_split.parsed(lines)
    assert rows(change_split.facts(changes, lists[0])) == [
        ("DWD_ORDER_DETAIL_U_1018", '{"id":4}'), ("DWD_ORDER_INFO_I_1018", '{"id":1}')
    ]
    dims = change_split.dimensions(changes, lists[1])
    assert sorted(r.dim_key for r in dims.collect()) == ["USER_INFO:2", "USER_INFO:3"]
    both = spark.createDataFrame([("order_info",), ("user_info",)], "table_name string")
    assert change_split.facts(changes, both).count() == 3 and change_split.dimensions(changes, both).count() == 3


def page_log(mid, ts, last=None, user="1", province="9"):
    values = dict.fromkeys(PAGE_LOG.fieldNames())
    values |= {"mid": mid, "ts": ts, "last_page_id": last, "user_id": user, "province_id": province}
    return tuple(values.values())


@pytest.fixture
def dims(spark):
    users = spark.createDataFrame([("1", "F", "2000-01-01")], "id string, gender string, birthday string")
    provinces = spark.createDataFrame(
        [("9", "name", "iso", "3166", "area")],
        "id string, name string, iso_code string, iso_3166_2 string, area_code string",
    )
    return users, provinces, F.lit("2023-01-01")


DAY = 86_400_000


def test_daily_users(spark, dims):
    pages = spark.createDataFrame(
        [page_log("a", 2000), page_log("a", 1000), page_log("a", DAY + 5), page_log("b", 10, last="home"),
         page_log("c", 10, last=""), page_log("d", 3_700_000, user="404")], PAGE_LOG,
    )
    got = {(r.dt, r.mid): r for r in daily_users.daily_users(pages, *dims).collect()}
    assert set(got) == {("1970-01-01", "a"), ("1970-01-02", "a"), ("1970-01-01", "d")}
    assert got["1970-01-01", "a"].ts == 1000 and got["1970-01-01", "a"].user_age == "23"
    assert got["1970-01-01", "d"].hr == "01" and got["1970-01-01", "d"].user_gender is None
    assert got["1970-01-01", "a"].province_3166_2 == "3166"


def test_daily_users_in_batches_use_the_table_as_state(spark, dims, tmp_path):
    table = KeyedTable(str(tmp_path / "dau"), ("mid",), DAU_INFO, ("ts",))
    write = daily_users.batch_writer(table, *dims)
    first = spark.createDataFrame([page_log("a", 2000), page_log("b", 5)], PAGE_LOG)
    second = spark.createDataFrame([page_log("a", 1000), page_log("c", 7), page_log("a", DAY)], PAGE_LOG)
    write(first, 0)
    for _ in range(2):  # a repeated batch changes nothing
        write(second, 1)
        got = {(r.dt, r.mid): r.ts for r in table.read(spark).collect()}
        assert got == {
            ("1970-01-01", "a"): 2000, ("1970-01-01", "b"): 5, ("1970-01-01", "c"): 7, ("1970-01-02", "a"): DAY
        }
    users = table.read(spark)
    assert reports.dau_total(users, "1970-01-01").first()[0] == 3
    assert reports.dau_total(users, "1999-01-01").first()[0] == 0
    assert rows(reports.dau_by_hour(users, "1970-01-02")) == [("1970-01-01", "00", 3), ("1970-01-02", "00", 1)]


def order(i, user=1, at="2023-02-27 23:05:00"):
    values = dict.fromkeys(ORDER_INFO.fieldNames())
    values |= {"id": i, "province_id": 9, "user_id": user, "total_amount": 5.0, "create_time": at}
    return tuple(values.values())


def detail(i, order_id, name="red bolt", amount=1.0, at="2023-02-28 00:00:01"):
    return (i, order_id, 1, 2.0, 3, name, at, amount, 0.0, 0.0)


def test_wide_orders(spark, dims):
    infos = spark.createDataFrame([order(1), order(2), order(3)], ORDER_INFO)
    details = spark.createDataFrame([detail(10, 1), detail(11, 1), detail(12, 2), detail(13, 9)], ORDER_DETAIL)
    got = {r.detail_id: r for r in order_wide.wide_orders(infos, details, *dims).collect()}
    assert set(got) == {10, 11, 12}
    assert (got[10].create_time, got[10].create_date, got[10].create_hour) == (
        "2023-02-28 00:00:01", "2023-02-27", "23")
    assert (got[10].order_id, got[10].user_age, got[10].province_3166_2_code) == (1, 23, "3166")


def test_reports(spark):
    wide = spark.createDataFrame(
        [("red bolt", 19, "F", 1.1), ("bolt, red", 20, "M", 2.2), ("red bolt", 29, "M", 3.3),
         ("red bolt", 30, "U", 4.4), ("bolt", 30, "U", 9.0)],
        "sku_name string, user_age int, user_gender string, split_total_amount double",
    )
    assert dict(rows(reports.sales_by_age(wide, "red bolt"))) == {"20岁以下": 1.1, "20到29岁": 5.5, "30岁以上": 4.4}
    assert dict(rows(reports.sales_by_gender(wide, "red bolt"))) == {"女": 1.1, "男": 5.5, "U": 4.4}
    assert reports.sales_by_age(wide, "green bolt").count() == 0
    young = wide.where("user_age < 20")
    assert dict(rows(reports.sales_by_age(young, "red"))) == {"20岁以下": 1.1, "20到29岁": 0.0, "30岁以上": 0.0}


def test_log_lines_are_spread_by_size(spark, monkeypatch):
    """A table six times as large is split in more tasks, not in longer ones."""
    from rillflow import session
    from rillflow.catalog import records
    from rillflow.catalog.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for size in (200 << 20, 1200 << 20):
        monkeypatch.setattr(session, "plan_bytes", lambda df, size=size: size)
        assert size / records.log_lines(t).rdd.getNumPartitions() <= 16 << 20
