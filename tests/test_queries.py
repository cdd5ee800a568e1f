"""Every registered query against its SQL twin."""

import pytest

from rillflow.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, db, ORACLES[name]) == ""
    else:
        assert df.count() >= 0


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["name", "value"]


def test_sql_and_fluent_forms_share_a_plan(spark):
    def plan(name):
        import re

        text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        return re.sub(r"#\d+L?|plan_id=\d+", "", text)

    assert plan("select_filter_sql") == plan("select_filter_fluent")
