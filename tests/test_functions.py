"""Scalar functions, parsing and copying."""

import pytest
from pyspark.sql import functions as F

from rillflow import functions as fn
from rillflow.operators import aggregates, joins, relational
from rillflow.schemas import ORDER_INFO, SENSOR
from rillflow.sources.files import csv_table, from_rows, parse_lines, text_lines
from rillflow.sources.topics import broker_options, csv_topic, decode
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


@pytest.mark.parametrize("born, age", [("2004-02-29", 18), ("2004-02-28", 19), ("2004-03-01", 18)])
def test_age(spark, born, age):
    assert one(spark, fn.age_years(F.lit(born), F.lit("2023-02-28"))) == age


def test_times(spark):
    ms = F.lit(1675386123456).cast("bigint")
    assert one(spark, fn.day_of_millis(ms)) == "2023-02-03"
    assert one(spark, fn.hour_of_millis(ms)) == "01"
    text = F.lit("2023-02-27 09:14:00")
    assert one(spark, fn.day_from_text(text)) == "2023-02-27"
    assert one(spark, fn.hour_from_text(text)) == "09"
    assert one(spark, fn.previous_day(F.lit("2023-03-01"))) == "2023-02-28"


def test_keys_and_codes(spark):
    assert one(spark, fn.salted_key(F.lit("100"))) == "f89100"
    assert one(spark, fn.reversed_key(F.lit("12"))) == "21"
    kinds = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D", "bootstrap-start": None}
    for kind, code in kinds.items():
        assert one(spark, fn.op_code(F.lit(kind))) == code
    assert one(spark, fn.split_at(F.lit("a|b"), "|", 1)) == "b"
    assert one(spark, fn.split_at(F.lit("a"), "|", 1)) is None


def test_word_counts(spark):
    lines = spark.createDataFrame([(v,) for v in (
        "hello spark", "hello flink", "hello hadoop", "hello flink")], "value string")
    assert dict(rows(aggregates.word_count(lines))) == {"hello": 4, "flink": 2, "spark": 1, "hadoop": 1}
    gaps = spark.createDataFrame([(" a  b  ",)], "value string")
    assert dict(rows(aggregates.word_count(gaps))) == {"": 2, "a": 1, "b": 1}
    assert dict(rows(aggregates.word_count(gaps, keep_empty=False))) == {"a": 1, "b": 1}


def test_parse_lines_keeps_rejects(spark):
    lines = spark.createDataFrame(
        [("sensor_1,1547718199,35.8",), ("sensor_1,x,35.8",), ("only one",), ("",)], "value string"
    )
    good, bad = parse_lines(lines, SENSOR)
    assert rows(good) == [("sensor_1", 1547718199, 35.8)]
    assert sorted(r.line for r in bad.collect()) == ["", "only one", "sensor_1,x,35.8"]


def test_sources(spark, tmp_path):
    path = tmp_path / "sensor.txt"
    path.write_text("sensor_1,1547718199,35.8\nsensor_6,1547718201,15.4\n")
    assert text_lines(spark, str(path)).count() == 2
    csv_table(spark, str(path), SENSOR, "inputTable")
    assert spark.sql("SELECT id FROM inputTable WHERE temperature > 20").collect()[0].id == "sensor_1"
    assert from_rows(spark, [("a", 1, 2.0)], SENSOR).schema == SENSOR
    records, rejects = csv_topic(text_lines(spark, str(path)), SENSOR, "kafkaInputTable")
    assert records.count() == 2
    assert spark.table("kafkaInputTable").count() == 2
    assert broker_options("h:9092", "t")["startingOffsets"] == "latest"
    assert broker_options("h:9092", "t", {0: 5})["startingOffsets"] == '{"t": {"0": 5}}'


def test_decode_is_lenient_with_numbers(spark):
    sent = spark.createDataFrame([('{"id":"7","total_amount":"1.5","order_status":"x"}',), ("junk",)], "value string")
    got = decode(sent, ORDER_INFO, zero_numbers=True)[0].collect()
    assert (got[0].id, got[0].total_amount, got[0].user_id, got[0].create_time) == (7, 1.5, 0, None)
    assert decode(sent, ORDER_INFO)[0].collect()[0].user_id is None


def test_later_copy_wins(spark):
    df = spark.sql("SELECT struct(1 AS a, 2 AS b) AS x, struct(3 AS b) AS y")
    assert rows(fn.copy_fields(df, ["a", "b", "c"], "x", "y")) == [(1, 3, None)]


def test_tagged_branches(spark):
    df = spark.range(10)
    parts = relational.split_by(df, low=F.col("id") < 3, even=F.col("id") % 2 == 0)
    assert parts["low"].count() == 3 and parts["even"].count() == 5


def test_pages(spark):
    df = spark.range(50)
    assert [r.id for r in relational.page(df, [F.col("id").asc()], 3, 20).collect()] == list(range(40, 50))
    assert relational.page(df, [F.col("id").asc()]).count() == 20


def test_listed_tables_are_case_sensitive(spark):
    changes = spark.createDataFrame([("order_info", 1), ("ORDER_INFO", 2), (None, 3)], "table string, n int")
    listed = spark.createDataFrame([("order_info",), ("order_info",)], "table_name string")
    assert [r.n for r in joins.in_tables(changes, listed).collect()] == [1]


def test_unmatched_dimension_is_kept(spark):
    facts = spark.createDataFrame([("1", "9"), ("2", None)], "user_id string, province_id string")
    users = spark.createDataFrame([("1", "F", "2000-01-01")], "id string, gender string, birthday string")
    provinces = spark.createDataFrame([("9", "n", "i", "c", "a")], "id string, name string, iso_code string, iso_3166_2 string, area_code string")
    out = joins.with_province(joins.with_user(facts, users, F.lit("2023-01-01")), provinces)
    got = {r.user_id: r for r in out.collect()}
    assert (got["1"].user_age, got["1"].province_3166_2) == (23, "c")
    assert got["2"].user_gender is None and got["2"].province_name is None
    assert joins.missing_dimensions(out, "user_gender").first()[0] == 1


def test_match_states(spark):
    infos = spark.createDataFrame([(1,), (2,)], "id bigint")
    details = spark.createDataFrame([(10, 1), (11, 1), (12, 3)], "id bigint, order_id bigint")
    assert sorted(tuple(r) for r in joins.match_states(infos, details).collect() if r.detail_id) == [
        (1, 10, "both"), (1, 11, "both"), (3, 12, "detail_only")
    ]
    assert joins.match_states(infos, details).where("match_state = 'info_only'").first().order_id == 2


def test_connected(spark):
    a = spark.createDataFrame([("x", 1)], "s string, n int")
    b = spark.createDataFrame([(2.5,)], "d double")
    out = joins.connected(a, b, {"text": (F.col("s"), F.col("d").cast("string"))})
    assert rows(out) == [(1, "x"), (2, "2.5")]
