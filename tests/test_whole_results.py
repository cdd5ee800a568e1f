"""Nothing is lost on the way: columns, groups, messages, records, files and keys."""

from collections import Counter

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillflow.catalog import QUERIES
from rillflow.functions import seconds_to_time
from rillflow.operators import aggregates, relational, windows
from rillflow.operators import widecolumn as wc
from rillflow.plans import daily_users, reports
from rillflow.schemas import PAGE_LOG, SENSOR, struct
from rillflow.sinks import files
from rillflow.sources import records
from rillflow.sources.topics import csv_topic, decode
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_lost_column_is_seen(spark):
    db, sql = connect(FOLDER), "SELECT r_regionkey, r_name FROM region"
    region = spark.read.parquet(f"{FOLDER}/region.parquet")
    assert compare(region.select("r_regionkey", "r_name"), db, sql) == ""
    assert "r_name" in compare(region.select("r_regionkey"), db, sql)
    assert "r_comment" in compare(
        region.select("r_regionkey", "r_name", F.lit(1).alias("r_comment")), db, sql
    )


def test_more_than_a_hundred_ages_are_summed(spark):
    wide = spark.range(150).select(
        F.col("id").cast("int").alias("user_age"), F.lit("red bolt").alias("sku_name"),
        F.lit(1.5).alias("split_total_amount"), F.lit("U").alias("user_gender"),
    )
    found = {r["name"]: r["value"] for r in reports.sales_by_age(wide, "red").collect()}
    assert list(found.values()) == [30.0, 15.0, 180.0]


def test_any_number_of_qualifiers(spark):
    cells = spark.range(10_001).select(
        F.lit("r").alias("row_key"), F.lit("info").alias("family"),
        F.format_string("q%05d", "id").alias("qualifier"), F.lit(0).cast("bigint").alias("ts"),
        F.lit("v").alias("value"),
    )
    newer = cells.limit(5).withColumns({"ts": F.lit(1).cast("bigint"), "value": F.lit("w")})
    text = wc.row_texts(cells.unionByName(newer)).first()["row_text"]
    assert Counter(text.split("_")) == {"v": 9_996, "w": 5}


def test_rows_are_scanned_with_one_shuffle(spark):
    for name in ("scan_family_rows", "scan_family_join"):
        assert plan_of(QUERIES[name](spark, FOLDER)).count("Exchange hashpartitioning") == 1


def test_tags_are_counted_in_one_scan(spark):
    assert plan_of(QUERIES["tagged_split"](spark, FOLDER)).count("FileScan") == 1
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "id int, heat double")
    found = relational.tagged(rows, hot=F.col("heat") > 10, odd=F.col("id") % 2 == 1)
    assert sorted((r["id"], r["tag"]) for r in found.collect()) == [(1, "odd"), (3, "hot"), (3, "odd")]


def test_item_filter_is_pushed_to_the_scan(spark):
    plan = plan_of(QUERIES["item_detail_page"](spark, FOLDER))
    part = next(line for line in plan.splitlines() if "part.parquet" in line)
    assert "p_name" in part


MESSAGES = ['{"id": "a", "timestamp": 1, "temperature": "2.5"}', "{broken", None, "", "[1]", "7", "null",
            '{"id": "b", "timestamp": "x"}', '  {"timestamp": 3}']


def test_messages_are_records_or_rejects(spark):
    sent = spark.createDataFrame([("t", str(i), m) for i, m in enumerate(MESSAGES)],
                                 "topic string, key string, value string")
    found, rejects = decode(sent, SENSOR)
    assert sorted(tuple(r) for r in found.fillna("", "id").fillna(-1).collect()) == [
        ("", 3, -1.0), ("a", 1, 2.5), ("b", -1, -1.0)
    ]
    assert sorted(r["key"] for r in rejects.collect()) == ["1", "2", "3", "4", "5", "6"]


def test_csv_messages_are_records_or_rejects(spark):
    lines = ["s1,1,2.5", "s2,x,3.5", "s3", "", None]
    sent = spark.createDataFrame([("t", x) for x in lines], "topic string, value string")
    found, rejects = csv_topic(sent, SENSOR)
    assert [r["id"] for r in found.collect()] == ["s1"]
    assert Counter(r["line"] for r in rejects.collect()) == Counter(lines[1:])


def test_a_bad_message_is_no_active_user(spark):
    lines = ['{"mid": "m1", "ts": 1700000000000}', "{broken", '{"mid": "m2"}', '{"ts": 1700000000000}']
    sent = spark.createDataFrame([("t", None, x) for x in lines], "topic string, key string, value string")
    pages, rejects = decode(sent, PAGE_LOG)
    assert rejects.count() == 1
    assert [r["mid"] for r in daily_users.first_per_day(daily_users.entries(pages)).collect()] == ["m1"]


@given(st.one_of(st.none(), st.text(alphabet="a\t\n\r\\Ntn ü", max_size=12)))
def test_escapes_are_undone(text):
    line = records.escaped(text)
    assert "\t" not in line and "\n" not in line and "\r" not in line
    assert records.unescaped(line) == text


def test_records_round_trip(spark, tmp_path):
    records.register(spark)
    path = str(tmp_path / "r")
    rows = [("a", "x\ny"), ("b\tc", "v"), ("d", None), (None, "\\N"), ("", ""), ("e\\", "\\t\r")]
    df = spark.createDataFrame(rows, "key string, value string").repartition(3)
    read = spark.read.format("keyed_records").option("path", path)
    df.write.format("keyed_records").mode("append").save(path)
    assert Counter(map(tuple, read.load().collect())) == Counter(rows)
    df.write.format("keyed_records").mode("append").save(path)
    assert read.load().count() == 12
    for _ in range(2):
        df.limit(2).write.format("keyed_records").mode("overwrite").save(path)
        assert read.load().count() == 2


def test_a_line_without_a_tab_is_an_error(spark, tmp_path):
    records.register(spark)
    (tmp_path / "part-1").write_text("a\t1\nbroken\n")
    with pytest.raises(Exception, match="without a tab"):
        spark.read.format("keyed_records").option("path", str(tmp_path)).load().collect()


def test_sources_lie_side_by_side(spark, tmp_path):
    for name, text in (("s1/a.txt", "1\n"), ("s2/b.txt", "2\n"), ("s3/a.txt", "3\n")):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(text)
    target = str(tmp_path / "out")

    def after(*sources):
        for source in sources:
            files.ingest_files(spark, str(tmp_path / source), target, "20240101", "01")
        return sorted(r["value"] for r in spark.read.parquet(target).collect())

    assert after("s1", "s2") == ["1", "2"]
    assert after("s1") == ["1", "2"]
    assert after("s3") == ["2", "3"]


def test_averages_are_of_whole_values(spark):
    rows = [(1, 0.004, [("a",)]), (2, 0.004, [("a",)])]
    df = spark.createDataFrame(rows, "id int, score double, items array<struct<name string>>")
    found = aggregates.terms_by_avg(df, "items", "name", "score", 5).first()
    assert found["avg_value"] == pytest.approx(0.004)


def test_null_keys_have_windows(spark):
    rows = [("a", 0), (None, 10), (None, 20), ("a", 3_700), (None, 3_800)]
    df = spark.createDataFrame(rows, "id string, s bigint").withColumn("ts", seconds_to_time(F.col("s")))

    def partial(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        return rows.groupby(by, as_index=False, dropna=False).size().rename(columns={"size": "cnt"})

    def merge(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        return rows.groupby(by, as_index=False, dropna=False)["cnt"].sum()

    found = windows.full_window(
        df, ["id"], "ts", 3600, "id string, window_start bigint, cnt bigint", partial, merge
    )
    assert Counter(tuple(r) for r in found.collect()) == {
        ("a", 0, 1): 1, (None, 0, 2): 1, ("a", 3_600_000, 1): 1, (None, 3_600_000, 1): 1
    }


def test_streams_commit_several_batches(spark, tmp_path):
    import glob

    from rillflow.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/*/resumed-*/checkpoint/commits/*"))
    assert QUERIES["stream_resumed"](spark, FOLDER).count() > 0
    new = set(glob.glob(f"{root}/*/resumed-*/checkpoint/commits/*")) - before
    assert len(new) >= 3
    assert struct(id="string").fieldNames() == ["id"]
