"""The row-level division lookup and the derived balance rows: what a task holds, and the rows they give."""

import datetime as dt
from decimal import Decimal

from ledgerline.plans import reports as R
from ledgerline.sources.fixtures import derive_tables
from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
from tests.conftest import SF_SMALL
from tests.helpers import multiset, row, spark_tables

D0 = dt.date(2001, 7, 31)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_core_lookup_sorts_no_balance_rows(spark, fixture_tables, tmp_path):
    for field, name in TABLE_NAMES.items():
        getattr(fixture_tables, field).write.parquet(str(tmp_path / name))
    plan = _plan(R.core_rows_with_div_sub(read_parquet_tables(spark, str(tmp_path))))
    assert "SortMergeJoin" not in plan and "Sort [" not in plan
    assert plan.count("ShuffledHashJoin") == 1 and "LeftOuter, BuildRight" in plan   # the table holds participants
    assert plan.count("Exchange hashpartitioning") == 2 and "_k0" not in plan         # keys move once


def test_derived_balance_rows_are_not_sorted(spark):
    t = derive_tables(spark, SF_SMALL)
    for rows in (t.core_daily, t.core_monthly):
        plan = _plan(rows)
        assert "SortMergeJoin" not in plan and "Sort [" not in plan
        assert plan.count("ShuffledHashJoin") == 2 and plan.count("BuildRight") == 2


def test_core_lookup_rows(spark):
    # NULL keys never match, not even NULL; a literal '-9999' does; two participant rows repeat the balance row.
    keys = [("a", "c", "p"), ("a", "c", None), (None, "c", "p"), ("-9999", "c", "p"), ("b", "c", "p"), ("x", "c", "p")]
    core = [row("core_daily", participant_id=a, client_id=c, plan_number=p, source_cycle_date=D0, fund_iv=str(f),
                cash_value_amount=Decimal(i)) for i, (a, c, p) in enumerate(keys) for f in (1, 2)]
    held = [(*keys[0], "D1"), (*keys[0], None), (*keys[1], "D2"), (*keys[2], "D3"), (*keys[3], "D4"), (*keys[4], "")]
    part = [row("participant", participant_id=a, client_id=c, plan_number=p, div_sub_id=d) for a, c, p, d in held]
    t = spark_tables(spark, {"core_daily": core, "participant": part})
    got = R.core_rows_with_div_sub(t)
    assert got.columns == [*t.core_daily.columns, "div_sub_id"]
    want = []
    for r in core:
        k = (r["participant_id"], r["client_id"], r["plan_number"])
        divs = [d for *q, d in held if None not in k and tuple(q) == k] or [None]
        want += [(*(r[c] for c in t.core_daily.columns), d) for d in divs]
    assert multiset(got.collect()) == multiset(want)
