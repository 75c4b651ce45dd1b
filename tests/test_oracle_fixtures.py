"""Every registered query equals its oracle SQL on the sf0.001 fixtures."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans import registry
from tests.conftest import SF_SMALL
from tests.helpers import multiset

TABLES = ["nation", "customer", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


QUERIES = registry.queries()
SQL = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(SQL[name])
    assert [d[0] for d in cur.description] == df.columns
    assert multiset(df.collect()) == multiset(cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["client_id", "plan_number", "participant_id", "source_cycle_date"]


def test_sorted_div_sub_order(spark):
    rows = QUERIES["div_sub_daily_sorted"](spark, SF_SMALL).select("plan_number", "div_sub_id").collect()
    keys = [(r.plan_number, r.div_sub_id) for r in rows]
    assert keys == sorted(keys, reverse=True)
