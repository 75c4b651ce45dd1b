"""Row filters of the balance reports: quarter-end months, div/sub exclusion,
and the participant-status balance predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .joins import left_join_on, sentinel_keys

STATUS_KEYS = ("participant_id", "plan_number", "client_id")
STATUS_AMOUNTS = ("core_cash_value_amount", "life_cash_value_amount_monthly", "sdba_cash_value_amount",
                  "loan_cash_value_amount", "noncore_cash_value_amount")


def quarter_filter(df: DataFrame, date_col: str = "source_cycle_date") -> DataFrame:
    """Keep rows whose month is a quarter end; undated rows drop."""
    return df.where(C.is_quarter_month(date_col))


def div_sub_not_in(df: DataFrame, col: str = "div_sub_id") -> DataFrame:
    """``col NOT IN ('-9999', '')``: NULL fails the test and drops too."""
    return df.where(~F.col(col).isin(C.SENTINEL, ""))


def status_predicate(status: Column | None = None) -> Column:
    """The four-branch balance/status test, with SQL's AND-before-OR grouping.

    Branch 2 groups as ``core OR (life AND sdba) OR loan OR noncore``.  Every
    branch also compares the status, so a NULL status never passes.
    """
    s = F.col("part_status_desc") if status is None else status
    core, life, sdba, loan, noncore = (F.col(c) for c in STATUS_AMOUNTS)
    z = lambda c: c == F.lit(0)
    nz = lambda c: c != F.lit(0)
    active, inactive = s == F.lit(C.ACTIVE_DESC), s != F.lit(C.ACTIVE_DESC)
    all_zero = z(core) & z(life) & z(sdba) & z(loan) & z(noncore)
    some_nonzero_grouped = nz(core) | (nz(life) & nz(sdba)) | nz(loan) | nz(noncore)
    all_nonzero = nz(core) & nz(life) & nz(sdba) & nz(loan) & nz(noncore)
    any_nonzero = nz(core) | nz(life) | nz(sdba) | nz(loan) | nz(noncore)
    return ((all_zero & active) | (some_nonzero_grouped & active)
            | (all_nonzero & inactive) | (any_nonzero & inactive))


def status_filter(report: DataFrame, participant: DataFrame, keep_status: bool = False) -> DataFrame:
    """Keep report rows whose participant status and balances pass the test.

    The status lookup matches the report's output keys to the participant
    table by sentinel; a participant with several rows yields several report
    rows.  Because the predicate rejects NULL status, the lookup is run as an
    INNER join against participants with a known status (same result as the
    outer join, and lets the optimizer use an inner join).
    """
    known = participant.where(F.col("part_status_desc").isNotNull())
    joined = left_join_on(report, known, sentinel_keys(*STATUS_KEYS), sentinel_keys(*STATUS_KEYS),
                          [F.col("part_status_desc").alias("_status")], how="inner")
    kept = joined.where(status_predicate(F.col("_status")))
    extra = [F.col("_status").alias("part_status_desc")] if keep_status else []
    return kept.select(*report.columns, *extra)
