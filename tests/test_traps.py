"""Semantic traps of SURVEY section 1.2, with hand-computed expectations."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerline.plans import reports as R
from tests.helpers import AS_OF, D0, empty_rows, m, row, spark_tables


def test_t2_null_key_matches_literal_sentinel(spark):
    rows = empty_rows()
    rows["core_daily"] = [row("core_daily", client_id=None, source_cycle_date=D0, cash_value_amount=m(10))]
    rows["loan"] = [row("loan", client_id="-9999", source_system="PREMIER", outstanding_principal_balance=m(7))]
    got = R.client_report(spark_tables(spark, rows), "daily", AS_OF).collect()
    assert [(r.client_id, r.cash_value_amount, r.total_loan_amount) for r in got] == [("-9999", m(10), m(7))]


def test_t24_undated_core_meets_loan_dated_yesterday(spark):
    rows = empty_rows()
    rows["core_monthly"] = [row("core_monthly", participant_id="1", client_id="C", plan_number="P",
                                source_cycle_date=None, cash_value_amount=m(10))]
    rows["loan"] = [row("loan", participant_id="1", client_id="C", plan_number="P", source_cycle_date=D0,
                        source_system="VRP-PB", loan_balance=m(3))]
    got = R.participant_report(spark_tables(spark, rows), "monthly", AS_OF).collect()
    assert len(got) == 1
    assert (got[0].source_cycle_date, got[0].core_cash_value_amount, got[0].loan_cash_value_amount) == \
        (D0, m(10), m(3))


def test_t9_daily_loan_repeats_on_every_core_date(spark):
    rows = empty_rows()
    rows["core_daily"] = [row("core_daily", participant_id="1", client_id="C", plan_number="P",
                              retirement_account_id="RA0", source_cycle_date=d, cash_value_amount=m(1))
                          for d in (dt.date(2001, 7, 30), dt.date(2001, 7, 31))]
    rows["loan"] = [row("loan", participant_id="1", client_id="C", plan_number="P", retirement_account_id="RA0",
                        source_system="VRP-PB", loan_balance=m(5))]
    got = R.participant_report(spark_tables(spark, rows), "daily", AS_OF).collect()
    assert sorted(r.loan_cash_value_amount for r in got) == [m(5), m(5)]


def test_t25_loans_at_or_below_zero_are_dropped(spark):
    rows = empty_rows()
    rows["loan"] = [row("loan", client_id="C", source_system="VRP-PB", loan_balance=m(v)) for v in (0, -25, None, 4)]
    got = R.client_report(spark_tables(spark, rows), "daily", AS_OF).collect()
    assert [r.total_loan_amount for r in got] == [m(4)]


def test_t27_noncore_overflow_fails_loudly(spark):
    rows = empty_rows()
    rows["core_monthly"] = [row("core_monthly", participant_id="1", client_id="C", plan_number="P",
                                source_cycle_date=D0, sdba_cash_value_amount=Decimal("99999999999.99"))]
    rows["life"] = [row("life", participant_id="1", plan_number="P", valuation_date=D0,
                        cash_value_amt=Decimal("99999999999.99"))]
    df = R.participant_report(spark_tables(spark, rows), "monthly", AS_OF)
    with pytest.raises(Exception, match="(?i)overflow|NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        df.collect()


def test_t29_daily_blank_plan_cannot_match_status(spark):
    rows = empty_rows()
    for plan_number in ("", "P"):
        rows["core_daily"].append(row("core_daily", participant_id="1", client_id="C", plan_number=plan_number,
                                      retirement_account_id="RA0", source_cycle_date=D0, cash_value_amount=m(1)))
        rows["core_monthly"].append(row("core_monthly", participant_id="1", client_id="C", plan_number=plan_number,
                                        source_cycle_date=D0, cash_value_amount=m(1)))
        rows["participant"].append(row("participant", participant_id="1", client_id="C", plan_number=plan_number,
                                       part_status_desc="ACTIVE"))
    t = spark_tables(spark, rows)
    daily = R.participant_status_report(t, "daily", AS_OF).collect()
    monthly = R.participant_status_report(t, "monthly", AS_OF).collect()
    assert sorted(r.plan_number for r in daily) == ["P"]          # '-9999' vs '' never matches
    assert sorted(r.plan_number for r in monthly) == ["", "P"]    # monthly keeps the blank


def test_t12_t13_counts_repeat_per_client_and_need_a_date(spark):
    rows = empty_rows()
    rows["core_monthly"] = [row("core_monthly", client_id="C1", plan_number="P", source_cycle_date=d,
                                cash_value_amount=m(1)) for d in (D0, None)]
    rows["participant"] = [row("participant", participant_id=p, client_id=c, plan_number="P", source_system="PREMIER",
                               participant_status_code="A", source_cycle_date=D0)
                           for p, c in (("1", "C1"), ("2", "C2"), ("3", "C2"))]
    got = R.plan_report(spark_tables(spark, rows), "monthly", AS_OF).collect()
    counts = sorted((r.source_cycle_date, r.participant_count) for r in got if r.participant_count is not None)
    # The dated row matches counts of both clients (C1: 1, C2: 2); the undated row
    # (defaulted to yesterday in the output) gets NULL counts.
    assert counts == [(D0, 1), (D0, 2)]
    assert sum(1 for r in got if r.participant_count is None) == 1


def test_t18_div_sub_filter_drops_null_blank_and_sentinel(spark):
    rows = empty_rows()
    for i, div in enumerate(("D1", "", None, "-9999")):
        pid = str(i)
        rows["core_daily"].append(row("core_daily", participant_id=pid, client_id="C", plan_number="P",
                                      source_cycle_date=D0, cash_value_amount=m(1)))
        rows["participant"].append(row("participant", participant_id=pid, client_id="C", plan_number="P",
                                       div_sub_id=div))
    got = R.div_sub_report(spark_tables(spark, rows), AS_OF).collect()
    assert [r.div_sub_id for r in got] == ["D1"]


def test_t10_t11_daily_life_repeats_per_valuation_date_and_ignores_client(spark):
    rows = empty_rows()
    rows["core_daily"] = [row("core_daily", participant_id="1", client_id=c, plan_number="P",
                              retirement_account_id="RA0", source_cycle_date=D0, cash_value_amount=m(1))
                          for c in ("C1", "C2")]
    rows["life"] = [row("life", participant_id="1", plan_number="P", valuation_date=d, cash_value_amt=m(2))
                    for d in (dt.date(2001, 5, 31), dt.date(2001, 6, 30))]
    got = R.participant_report(spark_tables(spark, rows), "daily", AS_OF).collect()
    # 2 clients x 2 valuation dates; the same life total lands on both clients.
    assert sorted((r.client_id, r.life_valuation_date) for r in got) == [
        ("C1", dt.date(2001, 5, 31)), ("C1", dt.date(2001, 6, 30)),
        ("C2", dt.date(2001, 5, 31)), ("C2", dt.date(2001, 6, 30))]
    assert {r.life_cash_value_amount_monthly for r in got} == {m(2)}


def test_t15_plan_total_is_null_for_loan_only_rows(spark):
    rows = empty_rows()
    rows["loan"] = [row("loan", client_id="C", plan_number="P", source_cycle_date=D0, source_system="VRP-PB",
                        loan_balance=m(9))]
    got = R.plan_report(spark_tables(spark, rows), "monthly", AS_OF).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.core_cash_value_amount, r.noncore_cash_value_amount, r.total_cash_amount) == (m(0), m(9), None)


def test_t16_trim_applies_to_core_keys_only(spark):
    rows = empty_rows()
    rows["core_daily"] = [row("core_daily", client_id="C", plan_number=" P05 ", source_cycle_date=D0,
                              cash_value_amount=m(1))]
    rows["loan"] = [row("loan", client_id="C", plan_number=" P05 ", source_system="VRP-PB", loan_balance=m(4))]
    got = R.plan_report(spark_tables(spark, rows), "daily", AS_OF).collect()
    # Core plan is trimmed to 'P05', loan plan is not: two rows that never merge.
    assert sorted((r.plan_number, r.core_cash_value_amount, r.loan_cash_value_amount) for r in got) == [
        (" P05 ", m(0), m(4)), ("P05", m(1), m(0))]


def test_t20_participant_with_two_rows_doubles_div_sub_balances(spark):
    rows = empty_rows()
    rows["core_daily"] = [row("core_daily", participant_id="1", client_id="C", plan_number="P",
                              source_cycle_date=D0, cash_value_amount=m(5))]
    rows["participant"] = [row("participant", participant_id="1", client_id="C", plan_number="P", div_sub_id="D1",
                               source_cycle_date=d) for d in (dt.date(2001, 6, 30), dt.date(2001, 7, 31))]
    got = R.div_sub_report(spark_tables(spark, rows), AS_OF).collect()
    assert [(r.div_sub_id, r.core_cash_value_amount, r.participant_count) for r in got] == [("D1", m(10), 1)]


@pytest.mark.parametrize("as_of,expected", [(dt.date(2001, 8, 1), []), (dt.date(2001, 9, 15), [dt.date(2001, 9, 15)])])
def test_t21_t23_client_quarterly_tests_the_defaulted_date(spark, as_of, expected):
    rows = empty_rows()
    rows["core_monthly"] = [row("core_monthly", client_id="C", source_cycle_date=None, cash_value_amount=m(1))]
    t = spark_tables(spark, rows)
    got = R.client_report(t, "quarterly", as_of).collect()
    # An undated client row falls back to *today* and passes when today is in a quarter-end month.
    assert [r.source_cycle_date for r in got] == expected
    # The participant report tests the raw date: the undated row never passes.
    assert R.participant_report(t, "quarterly", as_of).count() == 0


def test_t26_quarterly_participant_amounts_stay_null_for_loan_only_rows(spark):
    rows = empty_rows()
    rows["loan"] = [row("loan", participant_id="1", client_id="C", plan_number="P",
                        source_cycle_date=dt.date(2001, 6, 30), source_system="PREMIER",
                        outstanding_principal_balance=m(3))]
    t = spark_tables(spark, rows)
    q = R.participant_report(t, "quarterly", AS_OF).collect()[0]
    mo = R.participant_report(t, "monthly", AS_OF).collect()[0]
    assert (q.core_cash_value_amount, q.sdba_cash_value_amount, q.ytd_contributions) == (None, None, None)
    assert (q.loan_cash_value_amount, q.noncore_cash_value_amount, q.life_cash_value_amount_monthly) == \
        (m(3), m(3), m(0))
    assert (mo.core_cash_value_amount, mo.sdba_cash_value_amount) == (m(0), m(0))
