"""Wide-column rows: loads, scans, filters, mutations, key ranges."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators import keyrange
from rillflow.operators import widecolumn as wc
from tests.conftest import ids, rows

KEY = "row_key string, family string, qualifier string, ts bigint, value string"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("100", "kd", "20"), ("101", "kv", "24"), ("102", "james", "26")], "key string, name string, age string"
    )


@pytest.fixture
def cells(spark):
    wide = {
        "rowKey1": {"name": "wd", "age": "123", "sex": "男"},
        "rowKey2": {"name": "James", "age": "25", "job": "ball"},
        "rowKey3": {"name": "kd", "weight": "60kg"},
        "rowKey4": {"name": "fz", "school": "MN"},
    }
    return spark.createDataFrame(
        [(k, "info", q, 1, v) for k, row in wide.items() for q, v in row.items()], KEY
    )


def keys(df):
    return sorted({r.row_key for r in df.collect()})


def test_puts(people):
    assert keys(wc.to_cells(people, "key", "info", reverse=True)) == ["001", "101", "201"]
    plain = wc.to_cells(people, "key", "info")
    assert keys(plain) == ["100", "101", "102"] and plain.count() == 6
    assert ("100", "20_kd") in rows(wc.row_texts(wc.scan(plain, "info")))


def test_sorted_load(people, spark, tmp_path):
    loaded = wc.sorted_load(people, "key", "info")
    parts = loaded.withColumn("p", F.spark_partition_id()).collect()
    assert [(r.row_key, r.qualifier) for r in parts] == [
        ("38b101", "age"), ("38b101", "name"), ("ec8102", "age"), ("ec8102", "name"),
        ("f89100", "age"), ("f89100", "name"),
    ]
    edges = {}
    for r in parts:
        edges.setdefault(r.p, []).append((r.row_key, r.qualifier))
    ordered = [edges[p] for p in sorted(edges)]
    assert all(a[-1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_filters(cells):
    assert len(keys(wc.key_pattern(cells, "^row"))) == 4
    assert keys(wc.key_pattern(cells, "Key2$")) == ["rowKey2"]
    assert keys(wc.column_value(cells, "info", "name", "=", "James")) == ["rowKey2"]
    assert keys(wc.column_value(cells, "info", "age", "=", "25")) == ["rowKey2", "rowKey3", "rowKey4"]
    assert keys(wc.column_value(cells, "info", "age", "=", "25", keep_missing=False)) == ["rowKey2"]
    assert keys(wc.column_value(cells, "info", "age", "<>", "25", keep_missing=False)) == ["rowKey1"]
    prefixed = wc.column_prefix(cells, "age")
    assert sorted((r.row_key, r.value) for r in prefixed.collect()) == [("rowKey1", "123"), ("rowKey2", "25")]
    both = wc.row_and_column(cells, "info", "name", "=", "James", "age").collect()
    assert [(r.row_key, r.value) for r in both] == [("rowKey2", "25")]


def test_versions(spark, cells):
    newer = spark.createDataFrame([("rowKey1", "info", "name", 2, "new")], KEY)
    put = wc.put_cells(cells, newer)
    named = lambda df: wc.latest(df).where("row_key = 'rowKey1' AND qualifier = 'name'").collect()
    assert named(put)[0].value == "new"
    assert named(wc.delete_newest(put, newer))[0].value == "wd"
    assert named(wc.delete_cells(put, newer.select("row_key", "family", "qualifier"))) == []
    assert "rowKey1" not in keys(wc.delete_cells(put, newer.select("row_key")))
    assert wc.drop_family(put, "info").count() == 0
    assert wc.scan(put, start="rowKey2", stop="rowKey4").select("row_key").distinct().count() == 2


def test_split_keys_and_buckets(spark, cells):
    assert keyrange.split_keys(3, 10, "0", "10") == ["3", "6", "9"]
    assert keyrange.split_keys(4, 16, "0", "ff") == ["40", "80", "c0"]
    with pytest.raises(ValueError):
        keyrange.split_keys(20, 10, "0", "10")
    df = spark.createDataFrame([("0",), ("3",), ("5",), ("95",)], "row_key string")
    assert rows(keyrange.bucket_counts(df, "row_key", ["3", "6", "9"])) == [(0, 1), (1, 2), (3, 1)]
    cut = keyrange.bucketed(cells, ["rowKey2", "rowKey4"])
    assert {r.row_key: r.bucket for r in cut.collect()} == {"rowKey1": 0, "rowKey2": 1, "rowKey3": 1, "rowKey4": 2}


def test_wide_rows(cells):
    wide = {r.row_key: r for r in wc.to_rows(cells, ["name", "age", "weight"]).collect()}
    assert wide["rowKey3"].weight == "60kg" and wide["rowKey3"].age is None
    assert ids(wc.to_rows(cells, ["name"]), "name") == ["James", "fz", "kd", "wd"]
