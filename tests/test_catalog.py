"""Every registered query with SQL equals it on the smallest tables; plan checks for the hot ones."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, data, con, name):
    assert compare(spark, con, name, data).startswith("OK")


def test_entry_and_registry(spark, data):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["token_stats", "keyword_flags", "readability", "lexicon_sentiment", "gazetteer_counts", "pair_cosine"])
def test_text_queries_stay_on_the_jvm(spark, data, name):
    plan = _plan(queries()[name](spark, data))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_column_pruning_reaches_the_scan(spark, data):
    plan = _plan(queries()["dedup_keep_first"](spark, data))
    assert "lang:string" not in plan
    plan = _plan(queries()["value_counts"](spark, data))
    assert "ReadSchema: struct<event_type:string>" in plan
