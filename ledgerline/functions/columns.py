"""Pure Column builders for the balance reports.

Everything here is a built-in Catalyst expression (coalesce, CASE, trim,
month, casts), so it stays inside whole-stage codegen; no UDFs.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values the reports depend on (must equal the reference's) ---------
SENTINEL = "-9999"                     # default for a missing key
EXCLUDED_FUNDS = ("70", "90", "91")    # funds whose cash is left out of core balance
EXEMPT_CLIENT = "NG"                   # client for which those funds still count
PREMIER = "PREMIER"                    # loans: principal balance comes from this system
VRP_PB = "VRP-PB"
VRP_SP = "VRP-SP"                      # spelling used by the active-participant test
VRP_SP_ALT = "VRP_SP"                  # spelling used by the allocated-participant test
ALLOCATED_ACCOUNT = "ALLOC"
ACTIVE_STATUS_MAX = 16                 # VRP systems: numeric status at or below this is active
PREMIER_ACTIVE_STATUS = "A"
ACTIVE_DESC = "ACTIVE"
EE, ER = "EE", "ER"                    # money types split out of core cash
QUARTER_END_MONTHS = (3, 6, 9, 12)
# ------------------------------------------------------------------------------


def sentinel(c: Column | str) -> Column:
    """``coalesce(c, '-9999')`` with a string sentinel (never a numeric one)."""
    return F.coalesce(_col(c), F.lit(SENTINEL))


def blank_to_sentinel(c: Column | str) -> Column:
    """Blank or NULL becomes the sentinel: ``coalesce(nullif(c, ''), '-9999')``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(SENTINEL))


def zero_money(c: Column | str) -> Column:
    # decimal(3,2) zero: coalesce keeps the other side's decimal type.
    return F.coalesce(_col(c), F.lit(Decimal("0.00")))


def zero_count(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def dec(c: Column | str, precision: int, scale: int) -> Column:
    """Decimal cast; under ANSI an overflow raises instead of yielding NULL."""
    return _col(c).cast(f"decimal({precision},{scale})")


def core_amount(exclude_funds: bool) -> Column:
    """Per-row core cash: NULL as zero, optionally zeroing the excluded funds.

    The exclusion test is three-valued: a NULL client keeps the amount.
    """
    cash = zero_money("cash_value_amount")
    if not exclude_funds:
        return cash
    excluded = F.col("fund_iv").isin(*EXCLUDED_FUNDS) & (F.col("client_id") != F.lit(EXEMPT_CLIENT))
    return F.when(excluded, F.lit(Decimal("0.0"))).otherwise(cash)


def money_type_amount(money_type: str) -> Column:
    """Cash of one money type, NULL for every other row (CASE without ELSE)."""
    return F.when(F.col("money_type_description") == F.lit(money_type), F.col("cash_value_amount"))


def loan_amount() -> Column:
    """Loan balance by source system: principal for PREMIER, loan balance otherwise."""
    return (F.when(F.col("source_system") == F.lit(PREMIER), F.col("outstanding_principal_balance"))
            .otherwise(F.col("loan_balance")))


# The status code is a string compared with a number.  Spark without ANSI
# mode casts it to INT: surrounding blanks trimmed, a fractional part
# truncated ('16.5' -> 16), anything else (letters, exponents, overflow) NULL.
# The same, without the ANSI error: take the integer part of a string that is
# an integer with an optional fraction, then try_cast.
STATUS_AS_INT_SQL = ("try_cast(regexp_extract(trim(participant_status_code), "
                     "'^([+-]?[0-9]+)(?:[.][0-9]*)?$', 1) as int)")


def loan_amount_positive() -> Column:
    """``loan_amount() > 0`` in a form the Parquet scan can take as a pushed filter.

    Same truth value for every row: a PREMIER row tests the principal, any
    other row (a NULL system included, as in the CASE's ELSE) the loan
    balance, and NULL amounts never pass.
    """
    system = F.col("source_system")
    premier = system == F.lit(PREMIER)
    return ((premier & (F.col("outstanding_principal_balance") > 0))
            | ((~premier | system.isNull()) & (F.col("loan_balance") > 0)))


def _status_number() -> Column:
    # A non-numeric status is "not active" rather than an error.
    return F.expr(STATUS_AS_INT_SQL)


def allocated_flag() -> Column:
    """True when the participant row counts as allocated (NULL/False otherwise)."""
    system = F.col("source_system")
    return (F.when(system.isin(VRP_PB, VRP_SP_ALT), F.col("account_type_code") == F.lit(ALLOCATED_ACCOUNT))
            .when(system == F.lit(PREMIER), F.lit(True)))


def active_flag() -> Column:
    """True when the participant row counts as active (NULL/False otherwise)."""
    system = F.col("source_system")
    return (F.when(system.isin(VRP_PB, VRP_SP), _status_number() <= F.lit(ACTIVE_STATUS_MAX))
            .when(system == F.lit(PREMIER), F.col("participant_status_code") == F.lit(PREMIER_ACTIVE_STATUS)))


def allocated_id() -> Column:
    """``participant_id`` when allocated, else NULL (input of a distinct count)."""
    return F.when(allocated_flag(), F.col("participant_id"))


def active_id() -> Column:
    return F.when(active_flag(), F.col("participant_id"))


def is_quarter_month(d: Column | str) -> Column:
    return F.month(_col(d)).isin(*QUARTER_END_MONTHS)


def quarter_candidate(d: Column | str) -> Column:
    """Rows that can still reach a quarter-end output row: undated or quarter-dated."""
    return _col(d).isNull() | is_quarter_month(d)


def report_date(as_of: _dt.date | None, days_back: int) -> Column:
    """``current_date() - days_back``, or the same relative to a fixed ``as_of``.

    A fixed ``as_of`` becomes a literal, so the whole run sees one date.
    """
    if as_of is None:
        return F.date_sub(F.current_date(), days_back)
    return F.lit(as_of - _dt.timedelta(days=days_back))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
