"""The derived inputs reproduce the coverage facts recorded in FIXTURES.md section 3 (sf0.01)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import reports as R
from ledgerline.sources.fixtures import derive_tables
from tests.helpers import AS_OF

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    return derive_tables(spark, SF)


def test_core_monthly_facts(t):
    c = t.core_monthly
    row = c.agg(F.count(F.lit(1)).alias("n"), F.count("client_id").alias("cl"), F.count("plan_number").alias("pl"),
                F.count("source_cycle_date").alias("d"), F.count("money_type_description").alias("mt"),
                F.sum("cash_value_amount").alias("cash"), F.sum("sdba_cash_value_amount").alias("sdba"),
                F.sum("ytd_contributions").alias("ytd"), F.sum("total_shares").alias("shares")).collect()[0]
    assert (row.n, row.cl, row.pl, row.d, row.mt) == (60000, 59311, 58626, 59705, 42795)
    assert (row.cash, row.sdba, row.ytd, row.shares) == (
        Decimal("2725260364.74"), Decimal("443471834.91"), Decimal("1300941.00"), Decimal("1524135.0000"))


def test_other_inputs(t):
    loan = t.loan.agg(F.count(F.lit(1)).alias("n"), F.count("source_cycle_date").alias("d")).collect()[0]
    assert (loan.n, loan.d) == (15000, 14932)
    life = t.life.agg(F.count(F.lit(1)).alias("n"), F.count("valuation_date").alias("d")).collect()[0]
    assert (life.n, life.d) == (15000, 14933)
    part = t.participant.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("participant_id").alias("ids")).collect()[0]
    assert (part.n, part.ids) == (1530, 1500)
    assert t.client.where(F.col("client_name").isNotNull()).count() == 25


def test_every_source_row_is_read(spark, t):
    count = lambda name: spark.read.parquet(f"{SF}/{name}.parquet").count()
    assert t.core_daily.count() == t.core_monthly.count() == count("lineitem")
    assert t.loan.count() == t.life.count() == count("orders")
    assert t.client.count() == count("nation")


def test_unmatched_keys_exist(t):
    merged = R.participant_core_loan(t, "monthly", AS_OF)
    side = lambda core, loan: merged.where(f"core_cash_value_amount is {core} and loan_cash_value_amt is {loan}").count()
    assert (side("not null", "null"), side("null", "not null"), side("not null", "not null")) == (10932, 9594, 2913)
    assert R.client_report(t, "monthly", AS_OF).where("client_name is null").count() == 315


def test_client_monthly_rows(t):
    assert R.client_report(t, "monthly", AS_OF).count() == 2108
