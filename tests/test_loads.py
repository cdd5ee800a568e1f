"""Sorted files of a load, and matching inside SQL."""

import pytest

from pyspark.sql import functions as F

from rillflow.functions.sqltext import register_text_functions
from rillflow.operators import keyrange, loads, search
from rillflow.session import scratch_path
from tests.conftest import rows


def scanned_rows(df):
    """Rows that the scan of a plan without shuffles gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def cells(spark):
    # A crowded row, cells of many versions, and one cell far more often written than others.
    key = F.when(F.col("id") % 3 == 0, "5").otherwise((F.col("id") % 4000).cast("string"))
    return spark.range(30_000).select(
        key.alias("row_key"), F.lit("info").alias("family"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 7)).alias("qualifier"),
        F.col("id").alias("ts"), F.repeat(F.col("id").cast("string"), 5).alias("value"),
    )


@pytest.mark.parametrize("splits", [None, keyrange.split_keys(3, 10, "0", "10")])
def test_files_are_ranges_and_reads_skip(spark, cells, splits):
    path = scratch_path(spark, "load")
    loads.write_load(cells, path, splits, files=6, group_bytes=1 << 12)
    load = loads.read_load(spark, path, splits)
    whole = load.select(*cells.columns)
    assert rows(whole) == rows(cells)
    assert loads.file_ranges(load).count() >= 6
    assert loads.overlapping_files(load).count() == 0
    for start, stop in (("17", "18"), ("6", None), (None, "11"), ("3", "3"), ("x", "y")):
        inside = F.lit(True)
        if start is not None:
            inside &= F.col("row_key") >= start
        if stop is not None:
            inside &= F.col("row_key") < stop
        found = loads.read_range(spark, path, start, stop, splits)
        assert rows(found.select(*cells.columns)) == rows(cells.where(inside))
    assert scanned_rows(loads.read_range(spark, path, "17", "18", splits)) < 30_000 / 4


def test_overlap_is_seen(spark, cells):
    path = scratch_path(spark, "load")
    cells.repartition(3).write.parquet(path)
    assert loads.overlapping_files(loads.read_load(spark, path)).count() == 2


def test_empty_load(spark, cells):
    path = scratch_path(spark, "load")
    loads.write_load(cells.where("false"), path)
    assert loads.read_range(spark, path, "1", "2").count() == 0
    assert loads.overlapping_files(loads.read_load(spark, path)).count() == 0


TEXTS = [
    (1, "Operation Red-Sea"), (2, "sea of the red"), (3, None), (4, ""), (5, "红海 red 海"), (6, "reds seas"),
    (7, "red sea 'quoted' \\ $1"),
]


@pytest.mark.parametrize("query", ["red sea", "红海", "RED", "", "sea red", "quoted"])
def test_sql_functions_equal_columns(spark, query):
    register_text_functions(spark)
    docs = spark.createDataFrame(TEXTS, "id int, name string")
    docs.createOrReplaceTempView("sql_texts")

    def found(condition):
        return rows(spark.sql(f"SELECT id FROM sql_texts WHERE {condition}"))

    assert found(f"match(name, '{query}')") == rows(search.match_any(docs, "name", query).select("id"))
    assert found(f"match_all(name, '{query}')") == rows(search.match_all(docs, "name", query).select("id"))
    if query:
        phrase = rows(search.match_phrase(docs, "name", query).select("id"))
        assert found(f"match_phrase(name, '{query}')") == phrase
    scores = spark.sql(f"SELECT id, match_score(name, '{query}') AS score FROM sql_texts").where("score > 0")
    assert rows(scores) == rows(search.match_any(docs, "name", query).select("id", "score"))
    assert found("match_token(name, 'sea')") == [(1,), (2,), (7,)]


def test_statement_stays_in_the_jvm(spark):
    register_text_functions(spark)
    spark.createDataFrame(TEXTS, "id int, name string").createOrReplaceTempView("sql_texts")
    df = spark.sql("SELECT id % 2 AS odd, count(*) AS n FROM sql_texts WHERE match(name, 'red sea') GROUP BY odd")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "SQLFunction" not in plan
    # The query's tokens are a constant of the plan.
    assert "[red,sea]" in plan
