"""Only dates that a changed input partition can reach are computed again, equal to a full run."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import incremental as I
from ledgerline.plans import publication as P
from ledgerline.plans.runner import ALL_REPORTS, build_report
from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
from tests.helpers import AS_OF, multiset

PERIODS = ["client_monthly", "client_quarterly", "plan_monthly", "participant_quarterly", "participant_monthly_status"]


def store(tables, root):
    for field, name in TABLE_NAMES.items():
        writer = getattr(tables, field).coalesce(1).write
        (writer.partitionBy(I.DATES[field]) if field in I.DATES else writer).parquet(f"{root}/{name}")


def test_dependencies_cover_all_reports():
    assert set(I.DEPENDS) == set(ALL_REPORTS)


def test_dates_that_a_change_reaches():
    day, old = dt.date(2001, 8, 1), dt.date(2001, 7, 31)
    month = {"core_monthly": {"1998-03-31"}}
    assert I.affected("client_monthly", month, day, day) == {dt.date(1998, 3, 31)}
    assert I.affected("client_monthly", {"loan": {I.UNDATED}}, day, day) == {dt.date(2001, 7, 31)}
    assert I.affected("client_quarterly", {"loan": {I.UNDATED}}, day, day) == {day}
    assert I.affected("client_monthly", {"life": {"1998-03-31"}}, day, day) == set()
    assert I.affected("client_monthly", {"client": {I.WHOLE}}, day, day) is None
    assert I.affected("participant_monthly_status", {"participant": {"1998-03-31"}}, day, day) is None
    assert I.affected("plan_monthly", {"participant": {"1998-03-31"}}, day, day) == {dt.date(1998, 3, 31)}
    assert I.affected("plan_daily", month, day, day) == set() and I.affected("plan_daily", {"loan": {"1998-03-31"}}, day, day) is None
    # Another day: undated rows leave the old fallback date for the new one.
    assert I.affected("client_monthly", {}, day, old) == {dt.date(2001, 7, 30), dt.date(2001, 7, 31)}
    assert I.affected("plan_daily", {}, day, old) is None


@pytest.fixture(scope="module")
def stored(spark, fixture_tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    store(fixture_tables, root)
    return root


def test_a_changed_partition_recomputes_its_dates_only(spark, stored, tmp_path):
    out = str(tmp_path / "out")
    assert I.run_changed(spark, stored, out, PERIODS, AS_OF) == dict.fromkeys(PERIODS)          # the first run: everything
    assert I.run_changed(spark, stored, out, PERIODS, AS_OF) == {}                              # nothing changed
    first = {n: P.manifest(spark, out)[1][n] for n in PERIODS}
    # One month of balances gets other amounts, one month of loans goes, the undated life rows are written again.
    month, gone = "1998-03-31", "1997-06-30"
    spark.read.parquet(f"{stored}/participant_core_balance_monthly/source_cycle_date={month}").withColumn(
        "cash_value_amount", (F.col("cash_value_amount") + 1).cast("decimal(17,2)")).write.mode("overwrite").parquet(f"{tmp_path}/new")
    for old, new in ((f"{stored}/participant_core_balance_monthly/source_cycle_date={month}", f"{tmp_path}/new"),
                     (f"{stored}/participant_loan/source_cycle_date={gone}", None)):
        for f in glob.glob(f"{old}/*") + glob.glob(f"{old}/.*.crc"):
            os.remove(f)
        for f in glob.glob(f"{new}/*.parquet") if new else []:
            os.rename(f, f"{old}/{os.path.basename(f)}")
    dates = {dt.date.fromisoformat(month), dt.date.fromisoformat(gone)}
    assert I.run_changed(spark, stored, out, PERIODS, AS_OF) == dict.fromkeys(PERIODS, dates)
    now = P.manifest(spark, out)[1]
    tables = read_parquet_tables(spark, stored)
    for name in PERIODS:
        moved = {d for d in now[name] if now[name][d] != first[name].get(d)}
        assert moved <= {f"source_cycle_date={d}" for d in dates} and moved
        want = build_report(name, tables, AS_OF)
        assert multiset(P.read_report(spark, out, name).select(*want.columns).collect()) == multiset(want.collect()), name


def test_restricted_inputs_leave_other_partitions_unread(spark, stored):
    tables = I.restricted("participant_monthly", read_parquet_tables(spark, stored), {dt.date(1998, 3, 31)}, AS_OF)
    plan = build_report("participant_monthly", tables, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) >= 3 and all("1998-03-31" in x.split("PartitionFilters: ")[1].split("PushedFilters")[0] for x in scans)


def test_the_fallback_date_moves_with_the_day(spark, stored, tmp_path):
    out, names = str(tmp_path / "out"), ["client_monthly", "participant_monthly"]
    I.run_changed(spark, stored, out, names, AS_OF)
    later = AS_OF + dt.timedelta(days=3)
    done = I.run_changed(spark, stored, out, names, later)
    assert done == dict.fromkeys(names, {AS_OF - dt.timedelta(days=1), later - dt.timedelta(days=1)})
    for name in names:
        want = build_report(name, read_parquet_tables(spark, stored), later)
        assert multiset(P.read_report(spark, out, name).select(*want.columns).collect()) == multiset(want.collect()), name
