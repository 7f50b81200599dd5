"""Every registered query equals its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, oracle_connection
from clickmart import oracle
from clickmart import queries as registry
from conftest import SF

QUERIES, SQLS = registry.queries(), oracle.statements()
# learned values have no SQL twin
LEARNED = {
    "ltv_regression", "als_recommendations", "als_recommendations_unseen", "item_vectors",
    "item_similarity",
}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_all_but_the_learned_have_sql():
    assert set(QUERIES) - set(SQLS) == LEARNED and set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query(spark, con, name):
    mine, theirs, diff = compare(spark, con, SF, name, QUERIES[name], SQLS[name])
    assert diff is None
    assert mine == theirs > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_entry_holds_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQLS) <= set(entry.oracle_sql())


def test_late_runs_hold_the_whole_table(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    kept = events.filter("user_id is not null and event_type is not null and ts is not null")
    found = QUERIES["late_events_all"](spark, SF)
    assert found.count() == kept.count()
