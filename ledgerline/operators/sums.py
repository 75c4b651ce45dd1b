"""Grouped sums over the balance, loan and life tables.

Each is one ``groupBy().agg()``: Spark plans a partial (map-side) hash
aggregate, one exchange on the grouping keys, then the final aggregate, so a
key holding a third of all rows is collapsed to one row per map task before
anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import columns as C

Key = str | tuple[str, Column]

# Output precision of every report amount; sums are narrowed to it on request.
AMOUNT_PRECISION = 17

# Row-level measure expressions of the core balance table, by output name.
CORE_MEASURES = ("core_cash_value_amount", "ee_cash_value_amount", "er_cash_value_amount",
                 "sdba_cash_value_amount", "ytd_contributions")


def _measure(name: str, exclude_funds: bool) -> Column:
    if name == "core_cash_value_amount":
        return C.core_amount(exclude_funds)
    if name == "total_client_balance":
        return C.core_amount(False)
    if name == "ee_cash_value_amount":
        return C.zero_money(C.money_type_amount(C.EE))
    if name == "er_cash_value_amount":
        return C.zero_money(C.money_type_amount(C.ER))
    if name in ("sdba_cash_value_amount", "ytd_contributions", "total_shares"):
        return C.zero_money(name)
    raise ValueError(f"unknown core measure {name!r}")


def key_columns(keys: Sequence[Key]) -> list[Column]:
    """Keys are column names or ``(name, expression)`` pairs (e.g. trimmed)."""
    return [F.col(k) if isinstance(k, str) else k[1].alias(k[0]) for k in keys]


def key_names(keys: Sequence[Key]) -> list[str]:
    return [k if isinstance(k, str) else k[0] for k in keys]


def narrowed(total: Column, scale: int, narrow: bool) -> Column:
    """Optionally cast a sum (Spark widens it to 27+ digits) to the report's
    ``decimal(17, scale)``.

    Every report casts its sums to that type anyway, and a value that does
    not fit fails that cast under ANSI, so narrowing right after the final
    aggregation changes no result.  What it changes is the representation:
    17-digit decimals are stored as 64-bit longs instead of variable-length
    big decimals, so every later exchange, join buffer and fan-out row is
    smaller and cheaper to compute.
    """
    return total.cast(DecimalType(AMOUNT_PRECISION, scale)) if narrow else total


def core_rows(core: DataFrame, keys: Sequence[Key], measures: Sequence[str] = CORE_MEASURES,
              exclude_funds: bool = True) -> DataFrame:
    """Keys and per-row core measures (never NULL), not summed."""
    return core.select(*key_columns(keys), *[_measure(m, exclude_funds).alias(m) for m in measures])


def core_sums(core: DataFrame, keys: Sequence[Key], measures: Sequence[str] = CORE_MEASURES,
              exclude_funds: bool = True, narrow: bool = False) -> DataFrame:
    """Sum the per-row core measures by ``keys``.

    Every measure is NULL-defaulted per row before summing, so a group's sum is
    never NULL; the fund exclusion applies to core cash only (EE/ER keep it).
    """
    return core.groupBy(*key_columns(keys)).agg(
        *[narrowed(F.sum(_measure(m, exclude_funds)), 4 if m == "total_shares" else 2, narrow).alias(m)
          for m in measures])


def positive_loans(loan: DataFrame) -> DataFrame:
    """Loan rows with their system-specific amount, keeping amounts above zero.

    The filter drops NULL, zero and negative amounts before any sum; it is
    written so the Parquet scan receives it as a pushed filter.
    """
    return loan.where(C.loan_amount_positive()).withColumn("loan_cash_value_amt", C.loan_amount())


def loan_rows(loan: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Keys and amount of positive loans, not summed."""
    return positive_loans(loan).select(*key_columns(keys), "loan_cash_value_amt")


def loan_sums(loan: DataFrame, keys: Sequence[Key], narrow: bool = False) -> DataFrame:
    return positive_loans(loan).groupBy(*key_columns(keys)).agg(
        narrowed(F.sum("loan_cash_value_amt"), 2, narrow).alias("loan_cash_value_amt"))


def life_sums(life: DataFrame, keys: Sequence[Key], narrow: bool = False) -> DataFrame:
    return life.groupBy(*key_columns(keys)).agg(
        narrowed(F.sum(C.zero_money("cash_value_amt")), 2, narrow).alias("life_cash_value_amount"))
