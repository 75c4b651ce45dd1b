"""T28: the status predicate keeps SQL's AND-before-OR grouping, over every
combination of zero / non-zero / NULL amounts and status values."""

import itertools
from decimal import Decimal

import duckdb

from ledgerline.operators.filters import STATUS_AMOUNTS, status_predicate
from ledgerline.plans.oracle import STATUS_PREDICATE


def test_predicate_matches_literal_sql(spark):
    values = [Decimal("0.00"), Decimal("1.00"), None]
    statuses = ["ACTIVE", "TERMINATED", None]
    rows = [(*amounts, s) for amounts in itertools.product(values, repeat=5) for s in statuses]
    cols = list(STATUS_AMOUNTS) + ["part_status_desc"]
    schema = ", ".join(f"{c} decimal(17,2)" for c in STATUS_AMOUNTS) + ", part_status_desc string"
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(status_predicate().alias("k")).collect()]

    con = duckdb.connect()
    con.execute("CREATE TABLE r (" + schema.replace("string", "varchar") + ")")
    con.executemany(f"INSERT INTO r VALUES ({', '.join('?' * len(cols))})", rows)
    sql = STATUS_PREDICATE.replace("b.part_status_desc", "r.part_status_desc")
    want = [r[0] for r in con.execute(f"SELECT {sql} FROM r").fetchall()]
    assert len(got) == 729
    # Spark and SQL agree on TRUE / not-TRUE for every combination.
    assert [g is True for g in got] == [w is True for w in want]
    # A NULL status never passes.
    assert not any(g for g, r in zip(got, rows) if r[-1] is None)
