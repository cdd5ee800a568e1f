"""Writers: keyed day tables, topics, files, the record source, JDBC statements."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.schemas import SENSOR, struct
from rillflow.sinks import files, jdbc, keyed, topics
from rillflow.sources import records, stores
from tests.conftest import rows

ROW = struct(dt="string", id="string", value="string", n="bigint")


@pytest.fixture
def table(tmp_path):
    return keyed.KeyedTable(str(tmp_path / "table"), ("id",), ROW, ("n",))


def batch(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def current(spark, table, days=None):
    return sorted((r.dt, r.id, r.value) for r in table.read(spark, days).collect())


def test_keyed_table(spark, table, tmp_path):
    assert table.read(spark).count() == 0
    table.write_batch(batch(spark, ("d1", "a", "old", 1), ("d1", "a", "new", 2), ("d2", "b", "x", 1)), 0)
    assert current(spark, table) == [("d1", "a", "new"), ("d2", "b", "x")]
    second = batch(spark, ("d1", "a", "newer", 1), ("d1", "c", "y", 1))
    for _ in range(2):
        table.write_batch(second, 1)
        assert current(spark, table) == [("d1", "a", "newer"), ("d1", "c", "y"), ("d2", "b", "x")]
    assert table.versions(spark).count() == 4
    assert current(spark, table, ["d2"]) == [("d2", "b", "x")]
    assert [r.id for r in table.unseen(batch(spark, ("d1", "a", "", 1), ("d2", "a", "", 1)), ["dt", "id"]).collect()] == ["a"]
    small = table.compact(spark, str(tmp_path / "small"), files=1)
    assert current(spark, small) == current(spark, table) and small.versions(spark).count() == 3
    assert current(spark, table) == [("d1", "a", "newer"), ("d1", "c", "y"), ("d2", "b", "x")]


def test_mixed_days_go_to_their_own_table(spark, table):
    table.write_batch(batch(spark, ("d1", "a", "1", 1), ("d2", "a", "2", 1)), 0)
    assert current(spark, table) == [("d1", "a", "1"), ("d2", "a", "2")]
    assert rows(stores.day_field(spark, table.path, "d2", "value")) == [("2",)]
    assert stores.day_field(spark, table.path, "d9", "value").count() == 0
    assert stores.day_field(spark, table.path + "-none", "d9", "value").count() == 0


def test_append_keeps_duplicates(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",)], "id string")
    for _ in range(2):
        keyed.append_rows(df, str(tmp_path / "t"))
    saved = spark.read.parquet(str(tmp_path / "t"))
    assert saved.count() == 4 and saved.select("_id").distinct().count() == 4


def test_document_shape_and_hash_pairs(spark, sensors):
    shaped = keyed.renamed_strings(sensors, sensor_id="id", temp="temperature", ts="timestamp")
    assert {f.dataType.simpleString() for f in shaped.schema} == {"string"}
    entries = spark.createDataFrame([("k-v-lost",), ("k2-v2",), ("alone",)], "entry string")
    assert sorted(map(tuple, keyed.pairs_from_entries(entries).collect()), key=str) == [
        ("alone", None), ("k", "v"), ("k2", "v2")]


def test_topic_files(spark, sensors, tmp_path):
    sent = topics.messages(sensors.select("id", F.lit(None).cast("string").alias("gone")), "t", F.col("id"))
    topics.write_messages(sent, "json", str(tmp_path / "out"))
    back = spark.read.schema("key string, value string, topic string").json(str(tmp_path / "out"))
    assert back.where("topic = 't'").count() == 7
    assert all(set(json.loads(r.value)) == {"id"} for r in back.collect())
    line = topics.csv_messages(sensors.select("id", "temperature").limit(1), "t").first().value
    assert line == "sensor_1,26.8"


def test_csv_binds_by_position(spark, sensors, tmp_path):
    schema = struct(id="string", cnt="double")
    files.insert_by_position(sensors.select("id", F.col("temperature").alias("temp")), schema, str(tmp_path / "csv"))
    assert spark.read.schema(schema).csv(str(tmp_path / "csv")).agg(F.max("cnt")).first()[0] == 38.3
    with pytest.raises(ValueError):
        files.insert_by_position(sensors, schema, str(tmp_path / "csv"))


def test_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("1\n2\n")
    (source / "b.txt").write_text("3\n")
    for _ in range(2):
        files.ingest_files(spark, str(source), str(tmp_path / "out"), "20230101", "07")
    read = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.value for r in read.where("clndr_dt_id = 20230101 AND hour_id = 7").collect()) == ["1", "2", "3"]
    assert (source / "a.txt").exists() and {r.file_name for r in read.collect()} == {"a.txt", "b.txt"}


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_record_source_reads_ranges_whole(spark, tmp_path, size):
    records.register(spark)
    path = str(tmp_path / "records")
    data = spark.range(200).selectExpr("concat('k', id) AS key", "repeat('ü', int(id % 9)) AS value")
    data.repartition(3).write.format("keyed_records").mode("append").save(path)
    read = spark.read.format("keyed_records").option("path", path).option("rangeBytes", size).load()
    if size == 1:
        read = read.coalesce(4)
    assert rows(read) == rows(data)
    if size == 1 << 20:
        assert rows(stores.hash_entries(read.where("key = 'k1'"))) == [("k1-ü",)]


def test_jdbc_plans_without_a_database(spark):
    options = stores.jdbc_options("jdbc:x", "t", "task_code", (0, 100), 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "task_code"
    assert "partitionColumn" not in stores.jdbc_options("jdbc:x", "t")
    update, insert = jdbc.upsert_statements("temp", "stage", ["sensor"], ["sensor", "temperature"])
    assert update == (
        "UPDATE temp SET temperature = (SELECT stage.temperature FROM stage WHERE temp.sensor = stage.sensor)"
        " WHERE EXISTS (SELECT 1 FROM stage WHERE temp.sensor = stage.sensor)")
    assert insert.startswith("INSERT INTO temp (sensor, temperature) SELECT sensor, temperature FROM stage")


def test_upsert_statements_run_in_sql():
    import duckdb

    db = duckdb.connect()
    db.execute("CREATE TABLE temp (sensor VARCHAR, temperature DOUBLE); INSERT INTO temp VALUES ('a', 1), ('b', 2)")
    db.execute("CREATE TABLE stage AS SELECT * FROM (VALUES ('b', 5.0), ('c', 6.0)) AS v(sensor, temperature)")
    for statement in jdbc.upsert_statements("temp", "stage", ["sensor"], ["sensor", "temperature"]):
        db.execute(statement)
    assert sorted(db.execute("SELECT * FROM temp").fetchall()) == [("a", 1.0), ("b", 5.0), ("c", 6.0)]


def test_task_projection(spark):
    from rillflow.schemas import JDBC_TASK

    tasks = spark.createDataFrame([("a", 1, "xyz", "l", None, None, 0)], JDBC_TASK)
    assert stores.task_info(tasks).first().cells_length == 3


def test_schema_names():
    assert isinstance(SENSOR, StructType) and SENSOR.fieldNames() == ["id", "timestamp", "temperature"]


def test_console_and_schema(spark, sensors, capsys):
    assert topics.to_console(sensors.select("id"), "low") is None
    sensors.printSchema()
    printed = capsys.readouterr().out
    assert "low" in printed and "sensor_10" in printed and "temperature: double" in printed


def test_streams_that_take_rows_back_are_refused(spark, tmp_path):
    from pyspark.errors import AnalysisException

    (tmp_path / "in").mkdir()
    counts = spark.readStream.text(str(tmp_path / "in")).groupBy("value").count()
    with pytest.raises(AnalysisException):
        topics.stream_messages(
            topics.csv_messages(counts, "t"), str(tmp_path / "c"), "parquet", str(tmp_path / "out"), every=None
        )


def test_day_view_shows_declared_fields_of_all_days(spark, table):
    from rillflow.operators.views import publish_days

    table.write_batch(batch(spark, ("d1", "a", "1", 1), ("d2", "a", "2", 1)), 0)
    publish_days(spark, "every_day", table.path, struct(id="string", dt="string"))
    assert spark.table("every_day").columns == ["id", "dt"] and spark.table("every_day").count() == 2
