"""Every query of the catalogue against its SQL, or at least its shape where there is none."""

from __future__ import annotations

import pytest
from oracle import differences

from leafmill.plans import catalogue, oracles

SF_DIR = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()


@pytest.mark.parametrize("name", catalogue.queries())
def test_query_equals_its_sql(spark, name):
    query = catalogue.queries()[name]
    if name in SQL:
        assert differences(spark, SF_DIR, query, SQL[name]) == ""
    else:
        assert query(spark, SF_DIR).count() > 0


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(SQL)


def test_entry_runs(spark):
    import __spark_entry__

    assert "verdict" in __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.queries()["engine_diff"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = catalogue.queries()["rare_tokens"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "Python" not in plan and "CartesianProduct" not in plan
