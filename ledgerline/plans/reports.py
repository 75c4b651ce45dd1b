"""The balance reports, composed from the operators.

Every report has the same five-part shape: core sums, loan sums, a FULL OUTER
merge of the two on sentinel keys, LEFT lookups (life-fund totals, participant
counts, client names), and a finish that casts, derives non-core totals,
defaults NULLs and optionally filters.  The variation between reports (grain,
cadence, date matching, defaults) is the reports' contract and is kept

``as_of`` fixes "today" for a run (``None`` means ``current_date()``).
``prefilter`` (default on) pushes the quarter-end test below the aggregates
and joins of quarterly reports: rows that are neither undated nor dated in a
quarter-end month cannot reach a quarterly output row, so they are dropped at
the scan instead of being summed, shuffled and joined first.  Why this is
exact: the snapshot date is a grouping key, so dropping a dated row removes
whole groups and never changes a kept group's sums.  In the core x loan
merge, two dated rows only meet on equal dates, and an undated row only
meets a row dated with the fallback date.  So a merged row containing a
non-quarter-dated input row carries that date (or is undated) and fails the
final test anyway.  Removing such an input row can only turn its partners
into unmatched rows that carry the same failing date, or no date.  The life
and count lookups only attach to rows, so rows whose dates cannot match a
kept row can go as well.  The final filter stays in place, and
``tests/test_equivalences.py`` plus the randomized oracle test check the
result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import counts as K
from ..operators import filters as FL
from ..operators import heat
from ..operators import joins as J
from ..operators import sums as S
from ..sources.tables import BalanceTables

D = "source_cycle_date"
CADENCES = ("daily", "monthly", "quarterly")


def _dec2(c: str | Column) -> Column:
    return C.dec(c, 17, 2)


def _noncore(*parts: str) -> Column:
    total = C.zero_money(parts[0])
    for p in parts[1:]:
        total = total + C.zero_money(p)
    return C.dec(total, 13, 2)


def _cols(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def _check(cadence: str) -> None:
    if cadence not in CADENCES:
        raise ValueError(f"cadence must be one of {CADENCES}, got {cadence!r}")


# ---------------------------------------------------------------------------
# Participant grain
# ---------------------------------------------------------------------------

PARTICIPANT_DAILY_COLUMNS = [
    "client_id", "plan_number", "participant_id", "retirement_account_id", D, "core_cash_value_amount",
    "ytd_contributions", "ee_cash_value_amount", "er_cash_value_amount", "life_cash_value_amount_monthly",
    "sdba_cash_value_amount", "loan_cash_value_amount", "noncore_cash_value_amount", "life_valuation_date"]

PARTICIPANT_PERIOD_COLUMNS = [
    "client_id", "plan_number", "participant_id", D, "core_cash_value_amount", "ee_cash_value_amount",
    "er_cash_value_amount", "life_cash_value_amount_monthly", "life_valuation_date", "sdba_cash_value_amount",
    "loan_cash_value_amount", "noncore_cash_value_amount", "ytd_contributions"]


def participant_core_loan(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                          prefilter: bool = True, narrow: bool = False) -> DataFrame:
    """Core and loan sums per participant, FULL OUTER merged (before life)."""
    _check(cadence)
    if cadence == "daily":
        keys = ["participant_id", "plan_number", "retirement_account_id", "client_id"]
        core_in, loan_in, mode, fallback = t.core_daily, t.loan, "none", None
        core_keys, loan_keys = keys + [D], list(keys)
    else:
        core_in, loan_in = t.core_monthly, t.loan
        if cadence == "quarterly" and prefilter:
            core_in, loan_in = core_in.where(C.quarter_candidate(D)), loan_in.where(C.quarter_candidate(D))
        keys = ["client_id", "participant_id", "plan_number"]
        mode, fallback = "defaulted", C.report_date(as_of, 1)
        core_keys, loan_keys = keys + [D], keys + [D]
    return J.full_outer_merge(S.core_rows(core_in, core_keys), S.loan_rows(loan_in, loan_keys), keys, mode, fallback, narrow)


def _attach_participant_life(merged: DataFrame, t: BalanceTables, cadence: str, as_of: _dt.date | None,
                             prefilter: bool, narrow: bool) -> DataFrame:
    life_in = t.life
    if cadence == "quarterly" and prefilter:
        life_in = life_in.where(C.quarter_candidate("valuation_date"))
    life = S.life_sums(life_in, ["participant_id", "plan_number", "valuation_date"], narrow=narrow)
    lkeys, rkeys = J.sentinel_keys("participant_id", "plan_number"), J.sentinel_keys("participant_id", "plan_number")
    if cadence != "daily":
        y = C.report_date(as_of, 1)
        lkeys.append(F.coalesce(F.col(D), y))
        rkeys.append(F.coalesce(F.col("valuation_date"), y))
    return J.left_join_on(merged, life, lkeys, rkeys, ["life_cash_value_amount", "valuation_date"])


def participant_with_life(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                          prefilter: bool = True, narrow: bool = False) -> DataFrame:
    """Merged core/loan rows with the participant's life-fund totals attached.

    Daily matches life on (participant, plan) only, so a row repeats once per
    valuation date; monthly also matches the defaulted snapshot date.
    """
    merged = participant_core_loan(t, cadence, as_of, prefilter, narrow)
    return _attach_participant_life(merged, t, cadence, as_of, prefilter, narrow)


def _participant_finish(m: DataFrame, cadence: str, as_of: _dt.date | None, extra: tuple = ()) -> DataFrame:
    y = C.report_date(as_of, 1)
    if cadence == "daily":
        return m.select(
            C.sentinel("client_id").alias("client_id"),
            C.blank_to_sentinel("plan_number").alias("plan_number"),
            C.sentinel("participant_id").alias("participant_id"),
            "retirement_account_id",
            F.coalesce(F.col(D), y).alias(D),
            C.zero_money(_dec2("core_cash_value_amount")).alias("core_cash_value_amount"),
            C.zero_money(_dec2("ytd_contributions")).alias("ytd_contributions"),
            C.zero_money(_dec2("ee_cash_value_amount")).alias("ee_cash_value_amount"),
            C.zero_money(_dec2("er_cash_value_amount")).alias("er_cash_value_amount"),
            C.zero_money(C.dec("life_cash_value_amount", 13, 2)).alias("life_cash_value_amount_monthly"),
            C.zero_money(_dec2("sdba_cash_value_amount")).alias("sdba_cash_value_amount"),
            C.zero_money(_dec2("loan_cash_value_amt")).alias("loan_cash_value_amount"),
            _noncore("sdba_cash_value_amount", "loan_cash_value_amt", "life_cash_value_amount")
            .alias("noncore_cash_value_amount"),
            F.col("valuation_date").alias("life_valuation_date"),
            *extra,
        )
    if cadence == "quarterly":
        m = FL.quarter_filter(m)
    # Quarterly leaves loan-only rows' core-side amounts NULL; monthly zeroes them.
    amt = (lambda c: _dec2(c)) if cadence == "quarterly" else (lambda c: C.zero_money(_dec2(c)))
    return m.select(
        C.sentinel("client_id").alias("client_id"),
        C.sentinel("plan_number").alias("plan_number"),
        C.sentinel("participant_id").alias("participant_id"),
        F.coalesce(F.col(D), y).alias(D),
        amt("core_cash_value_amount").alias("core_cash_value_amount"),
        amt("ee_cash_value_amount").alias("ee_cash_value_amount"),
        amt("er_cash_value_amount").alias("er_cash_value_amount"),
        C.dec(C.zero_money("life_cash_value_amount"), 13, 2).alias("life_cash_value_amount_monthly"),
        F.col("valuation_date").alias("life_valuation_date"),
        amt("sdba_cash_value_amount").alias("sdba_cash_value_amount"),
        C.zero_money(_dec2("loan_cash_value_amt")).alias("loan_cash_value_amount"),
        _noncore("life_cash_value_amount", "sdba_cash_value_amount", "loan_cash_value_amt")
        .alias("noncore_cash_value_amount"),
        amt("ytd_contributions").alias("ytd_contributions"),
        *extra,
    )


def participant_report(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                       prefilter: bool = True) -> DataFrame:
    """Participant balances: ``daily``, ``monthly`` or ``quarterly``."""
    m = participant_with_life(t, cadence, as_of, prefilter, narrow=True)
    return _participant_finish(m, cadence, as_of)


def participant_status_report(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                              prefilter: bool = True) -> DataFrame:
    """Participant report restricted by participant status and balances.

    The status lookup matches the report's *output* keys (sentinel ids, and
    for daily the blank-to-sentinel plan) to the participant table, and the
    predicate then tests the report's amounts (``operators.filters``).  The
    predicate rejects NULL status, so the lookup is an inner join on
    participants with a known status.

    Daily: the life join fans every merged row out per valuation date, and
    the lookup's keys are functions of the merged row alone, so the lookup is
    attached before the life join (an inner lookup and a LEFT join on other
    keys commute): same rows, but the lookup moves the merged rows instead of
    the fanned-out ones.  Monthly / quarterly life joins do not fan out, so
    the lookup runs on the finished report as written.
    """
    if cadence != "daily":
        return FL.status_filter(participant_report(t, cadence, as_of, prefilter), t.participant)
    merged = participant_core_loan(t, cadence, as_of, prefilter, narrow=True)
    out_plan = C.blank_to_sentinel("plan_number") if cadence == "daily" else C.sentinel("plan_number")
    known = t.participant.where(F.col("part_status_desc").isNotNull())
    with_status = J.left_join_on(
        merged, known, [C.sentinel("participant_id"), out_plan, C.sentinel("client_id")],
        J.sentinel_keys(*FL.STATUS_KEYS), [F.col("part_status_desc").alias("_status")], how="inner")
    m = _attach_participant_life(with_status, t, cadence, as_of, prefilter, narrow=True)
    out = _participant_finish(m, cadence, as_of, extra=(F.col("_status"),))
    return out.where(FL.status_predicate(F.col("_status"))).drop("_status")


# ---------------------------------------------------------------------------
# Plan grain
# ---------------------------------------------------------------------------

PLAN_DAILY_COLUMNS = [
    "client_id", "plan_number", "core_cash_value_amount", "noncore_cash_value_amount", "sdba_cash_value_amount",
    "life_cash_value_amount_monthly", "life_valuation_date", "loan_cash_value_amount", "ee_cash_value_amount",
    "er_cash_value_amount", "participant_count", "active_participant_count", "allocated_participant_count",
    "ytd_contributions", D, "plan_key"]


def plan_period_columns(cadence: str) -> list[str]:
    # The monthly report's published column name is misspelt; quarterly's is not.
    sdba = "sdba_cash_value_amoun" if cadence == "monthly" else "sdba_cash_value_amount"
    return ["client_id", "plan_number", D, "core_cash_value_amount", "ee_cash_value_amount",
            "er_cash_value_amount", "life_cash_value_amount", sdba, "loan_cash_value_amount",
            "noncore_cash_value_amount", "ytd_contributions", "total_shares", "allocated_participant_count",
            "active_participant_count", "participant_count", "total_cash_amount", "plan_key"]


def plan_core_loan(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                   prefilter: bool = True, narrow: bool = False) -> DataFrame:
    """Core and loan sums per (client, plan[, date]), FULL OUTER merged."""
    _check(cadence)
    if cadence == "daily":
        core = S.core_rows(t.core_daily, ["client_id", ("plan_number", F.trim("plan_number")), D])
        loan = S.loan_rows(t.loan, ["plan_number", "client_id"])
        return J.full_outer_merge(core, loan, ["client_id", "plan_number"], "none", narrow=narrow)
    core_in, loan_in = t.core_monthly, t.loan
    if cadence == "quarterly" and prefilter:
        core_in, loan_in = core_in.where(C.quarter_candidate(D)), loan_in.where(C.quarter_candidate(D))
    core = S.core_rows(core_in, ["client_id", "plan_number", D], S.CORE_MEASURES + ("total_shares",))
    loan = S.loan_rows(loan_in, ["plan_number", D, "client_id"])
    return J.full_outer_merge(core, loan, ["client_id", "plan_number"], "defaulted", C.report_date(as_of, 1), narrow)


def _hot_plans(t: BalanceTables) -> Column:
    """Heat of the daily plan lookups' key: merged rows of a plan are no more than its core rows.

    Period lookups match plan and date, where a key has one merged row a client, so
    they need no parts.
    """
    return heat.hot_parts(t.core_daily, [C.sentinel(F.trim("plan_number"))])


def plan_with_life(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                   prefilter: bool = True, narrow: bool = False) -> DataFrame:
    """Merged plan rows with life totals: by plan only when daily (one row per
    valuation date), by plan and defaulted date otherwise."""
    merged = plan_core_loan(t, cadence, as_of, prefilter, narrow)
    life_in = t.life
    if cadence == "quarterly" and prefilter:
        life_in = life_in.where(C.quarter_candidate("valuation_date"))
    life = S.life_sums(life_in, ["plan_number", "valuation_date"], narrow=narrow)
    plan, payload = J.sentinel_keys("plan_number"), ["life_cash_value_amount", "valuation_date"]
    if cadence == "daily":
        return J.left_join_on(merged, life, plan, plan, payload, hot=_hot_plans(t), spread=_cols("client_id", D))
    y = C.report_date(as_of, 1)
    return J.left_join_on(merged, life, plan + [F.coalesce(F.col(D), y)], plan + [F.coalesce(F.col("valuation_date"), y)], payload)


def plan_enriched(t: BalanceTables, cadence: str, as_of: _dt.date | None = None, prefilter: bool = True,
                  count_method: str | K.CountMaps = "two_step", narrow: bool = False) -> DataFrame:
    """Plan rows with life totals and participant counts attached.

    Daily: life and counts both match on the plan alone.  Periods: life
    matches plan and defaulted date; counts are grouped by plan, client and
    date but matched on plan and *strict* date only, so a plan shared by
    several clients repeats once per client and an undated row gets no counts.
    Strict date equality is the defaulted-date equality restricted to dated
    rows on both sides, so counts use the life join's key (one key, one join
    of the merged rows) with undated count rows dropped and a "left row is
    dated" condition.  Daily, a plan that holds most rows is spread over several
    tasks by client and date.
    """
    merged = plan_core_loan(t, cadence, as_of, prefilter, narrow)
    life_in, part_in = t.life, t.participant
    if cadence == "quarterly" and prefilter:
        life_in = life_in.where(C.quarter_candidate("valuation_date"))
        part_in = part_in.where(C.is_quarter_month(D))   # strict date match: undated never joins
    life = S.life_sums(life_in, ["plan_number", "valuation_date"], narrow=narrow)
    life_payload = ["life_cash_value_amount", "valuation_date"]
    plan = J.sentinel_keys("plan_number")
    if cadence == "daily":
        counts = K.participant_counts(part_in, ["plan_number"], count_method)
        return J.attach_all(merged, plan, [(life, plan, life_payload), (counts, plan, list(K.COUNT_COLUMNS))],
                            _cols("client_id", D), _hot_plans(t))
    y = C.report_date(as_of, 1)
    counts = K.participant_counts(part_in.where(F.col(D).isNotNull()), ["plan_number", "client_id", D], count_method)
    if isinstance(count_method, K.CountMaps):  # stored maps hold all rows
        counts = counts.where(F.col(D).isNotNull())
    return J.attach_all(merged, plan + [F.coalesce(F.col(D), y)], [
        (life, plan + [F.coalesce(F.col("valuation_date"), y)], life_payload),
        (counts, plan + [F.col(D)], list(K.COUNT_COLUMNS), F.col(D).isNotNull()),
    ])


def plan_report(t: BalanceTables, cadence: str, as_of: _dt.date | None = None, prefilter: bool = True,
                count_method: str | K.CountMaps = "two_step") -> DataFrame:
    """Plan balances: ``daily``, ``monthly`` or ``quarterly`` (rows)."""
    m = plan_enriched(t, cadence, as_of, prefilter, count_method, narrow=True)
    y = C.report_date(as_of, 1)
    plan_key = F.lit(None).cast("string").alias("plan_key")
    if cadence == "daily":
        return m.select(
            C.sentinel("client_id").alias("client_id"),
            C.blank_to_sentinel("plan_number").alias("plan_number"),
            C.zero_money(_dec2("core_cash_value_amount")).alias("core_cash_value_amount"),
            C.zero_money(_noncore("sdba_cash_value_amount", "loan_cash_value_amt", "life_cash_value_amount"))
            .alias("noncore_cash_value_amount"),
            C.zero_money(_dec2("sdba_cash_value_amount")).alias("sdba_cash_value_amount"),
            C.zero_money(C.dec("life_cash_value_amount", 13, 2)).alias("life_cash_value_amount_monthly"),
            F.col("valuation_date").alias("life_valuation_date"),
            C.zero_money(_dec2("loan_cash_value_amt")).alias("loan_cash_value_amount"),
            C.zero_money(_dec2("ee_cash_value_amount")).alias("ee_cash_value_amount"),
            C.zero_money(_dec2("er_cash_value_amount")).alias("er_cash_value_amount"),
            *[C.zero_count(F.col(c).cast("int")).alias(c)
              for c in ("participant_count", "active_participant_count", "allocated_participant_count")],
            _dec2("ytd_contributions").alias("ytd_contributions"),
            F.coalesce(F.col(D), y).alias(D),
            plan_key,
        )
    if cadence == "quarterly":
        m = FL.quarter_filter(m)
    core = _dec2("core_cash_value_amount")
    noncore = _noncore("life_cash_value_amount", "sdba_cash_value_amount", "loan_cash_value_amt")
    names = plan_period_columns(cadence)
    return m.select(
        C.sentinel("client_id").alias("client_id"),
        C.sentinel("plan_number").alias("plan_number"),
        F.coalesce(F.col(D), y).alias(D),
        C.zero_money(core).alias("core_cash_value_amount"),
        C.zero_money(_dec2("ee_cash_value_amount")).alias("ee_cash_value_amount"),
        C.zero_money(_dec2("er_cash_value_amount")).alias("er_cash_value_amount"),
        C.dec(C.zero_money("life_cash_value_amount"), 13, 2).alias("life_cash_value_amount"),
        C.zero_money(_dec2("sdba_cash_value_amount")).alias(names[7]),
        C.zero_money(_dec2("loan_cash_value_amt")).alias("loan_cash_value_amount"),
        noncore.alias("noncore_cash_value_amount"),
        C.zero_money(_dec2("ytd_contributions")).alias("ytd_contributions"),
        C.dec(C.zero_money("total_shares"), 17, 4).alias("total_shares"),
        *[F.col(c).cast("int").alias(c) for c in K.COUNT_COLUMNS],
        # No default on core: a loan-only plan's total stays NULL.
        _dec2(core + noncore).alias("total_cash_amount"),
        plan_key,
    )


def plan_quarterly_count(t: BalanceTables, as_of: _dt.date | None = None, prefilter: bool = True) -> DataFrame:
    """Row count of the quarterly plan report, as one BIGINT row."""
    return plan_report(t, "quarterly", as_of, prefilter).agg(F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------------------
# Client grain
# ---------------------------------------------------------------------------

CLIENT_COLUMNS = ["client_id", D, "client_name", "cash_value_amount", "total_loan_amount", "sdba_cash_value_amount"]


def client_core_loan(t: BalanceTables, cadence: str, prefilter: bool = True,
                     as_of: _dt.date | None = None, narrow: bool = False) -> DataFrame:
    """Client sums (no fund exclusion) merged with client loan sums."""
    _check(cadence)
    measures = ("total_client_balance", "sdba_cash_value_amount")
    if cadence == "daily":
        core = S.core_rows(t.core_daily, ["client_id", D], measures, exclude_funds=False)
        return J.full_outer_merge(core, S.loan_rows(t.loan, ["client_id"]), ["client_id"], "none", narrow=narrow)
    core_in, loan_in = t.core_monthly, t.loan
    if cadence == "quarterly" and prefilter:
        core_in, loan_in = core_in.where(C.quarter_candidate(D)), loan_in.where(C.quarter_candidate(D))
    core = S.core_rows(core_in, ["client_id", D], measures, exclude_funds=False)
    loan = S.loan_rows(loan_in, ["client_id", D])
    if cadence == "monthly":
        return J.full_outer_merge(core, loan, ["client_id"], "defaulted", C.report_date(as_of, 1), narrow)
    return J.full_outer_merge(core, loan, ["client_id"], "strict", narrow=narrow)


def client_keys_merged(t: BalanceTables, cadence: str, as_of: _dt.date | None = None,
                       prefilter: bool = True) -> DataFrame:
    """Merged client rows with the three-way key / date defaults and casts.

    Undated rows fall back to today (daily, quarterly) or yesterday (monthly).
    """
    merged = client_core_loan(t, cadence, prefilter, as_of, narrow=True)
    fallback = C.report_date(as_of, 1 if cadence == "monthly" else 0)
    return merged.select(
        C.sentinel("client_id").alias("client_id"),
        F.coalesce(F.col(D), fallback).alias(D),
        _dec2("total_client_balance").alias("total_client_balance"),
        _dec2("sdba_cash_value_amount").alias("sdba_cash_value_amount"),
        _dec2("loan_cash_value_amt").alias("client_loan_balance"))


def client_named(t: BalanceTables, cadence: str, as_of: _dt.date | None = None, prefilter: bool = True) -> DataFrame:
    """Client rows with the client name looked up by sentinel key.

    A plain join: adaptive execution broadcasts the client dimension where
    its measured size allows.
    """
    z = client_keys_merged(t, cadence, as_of, prefilter)
    return J.left_join_on(z, t.client, J.sentinel_keys("client_id"), J.sentinel_keys("client_id"), ["client_name"])


def client_report(t: BalanceTables, cadence: str, as_of: _dt.date | None = None, prefilter: bool = True) -> DataFrame:
    """Client balances with client names: ``daily``, ``monthly`` or ``quarterly``.

    The quarterly test reads the defaulted date.
    """
    out = client_named(t, cadence, as_of, prefilter)
    if cadence == "quarterly":
        out = FL.quarter_filter(out)
    return out.select(
        "client_id", D, "client_name",
        C.zero_money("total_client_balance").alias("cash_value_amount"),
        C.zero_money("client_loan_balance").alias("total_loan_amount"),
        C.zero_money("sdba_cash_value_amount").alias("sdba_cash_value_amount"))


# ---------------------------------------------------------------------------
# Division / sub-division grain (daily)
# ---------------------------------------------------------------------------

DIV_SUB_COLUMNS = [
    "client_id", "plan_number", "div_sub_id", "core_cash_value_amount", "noncore_cash_value_amount",
    "sdba_cash_value_amount", "life_cash_value_amount_monthly", "life_valuation_date", "loan_cash_value_amount",
    "ee_cash_value_amount", "er_cash_value_amount", "allocated_participant_count", "active_participant_count",
    "participant_count", "ytd_contributions", D, "plan_key"]

_ACCOUNT = ["client_id", "plan_number", "participant_id"]


def core_rows_with_div_sub(t: BalanceTables) -> DataFrame:
    """Row-level lookup: daily core rows with the participant's division.

    Plain equality on (plan, client, participant): NULL keys never match, and
    a participant with several rows repeats the balance row.
    """
    div = t.participant.select(*_ACCOUNT, "div_sub_id")
    return J.left_join_raw(t.core_daily, div, _ACCOUNT)


def usable_division(c: str | Column) -> Column:
    """The report's exclusion test on a division: not NULL, ``''`` or the sentinel."""
    return ~(F.col(c) if isinstance(c, str) else c).isin(C.SENTINEL, "")


def core_div_sub_rows(t: BalanceTables, usable: bool = False) -> DataFrame:
    """Daily core amounts with trimmed client, plan and div/sub, no fund exclusion.

    Balances are first summed per (client, plan, participant, date) and only
    then matched to the division; this is exact because sums distribute over
    the lookup's row duplication, and it moves one row per participant-date
    through the join instead of every fund / money-type row.

    ``usable``: only divisions the report keeps; then participants are
    filtered at their scan and the lookup is an inner join.
    """
    per_account = S.core_sums(t.core_daily, _ACCOUNT + [D], exclude_funds=False)
    div = t.participant.select(*_ACCOUNT, "div_sub_id")
    if usable:
        div = div.where(usable_division(F.trim("div_sub_id")))
    joined = J.left_join_on(per_account, div, [F.col(k) for k in _ACCOUNT], [F.col(k) for k in _ACCOUNT],
                            ["div_sub_id"], how="inner" if usable else "left")
    keys = [F.trim("client_id").alias("client_id"), F.trim("plan_number").alias("plan_number"),
            F.trim("div_sub_id").alias("div_sub_id"), F.col(D)]
    return joined.select(*keys, *S.CORE_MEASURES)


def core_sums_div_sub(t: BalanceTables) -> DataFrame:
    """Daily core sums per (trimmed client, plan, div/sub, date)."""
    return core_div_sub_rows(t).groupBy("client_id", "plan_number", "div_sub_id", D).agg(
        *[F.sum(m).alias(m) for m in S.CORE_MEASURES])


def loan_rows_with_div_sub(t: BalanceTables) -> DataFrame:
    """Row-level lookup: positive loans with the division (sentinel-matched keys)."""
    div = t.participant.select(*_ACCOUNT, "div_sub_id")
    loans = S.positive_loans(t.loan).select(*_ACCOUNT, "loan_cash_value_amt")
    joined = J.left_join_on(loans, div, J.sentinel_keys(*_ACCOUNT), J.sentinel_keys(*_ACCOUNT),
                            [F.col("div_sub_id").alias("_div")])
    return joined.select(*_ACCOUNT, C.blank_to_sentinel("_div").alias("div_sub_id"), "loan_cash_value_amt")


def loan_div_sub_rows(t: BalanceTables, usable: bool = False) -> DataFrame:
    """Positive loans with plan, div/sub and client; summed per account before the lookup.

    ``usable``: only divisions the report keeps (see ``core_div_sub_rows``).
    """
    per_account = S.loan_sums(t.loan, _ACCOUNT)
    div = t.participant.select(*_ACCOUNT, "div_sub_id")
    if usable:
        div = div.where(usable_division("div_sub_id"))
    joined = J.left_join_on(per_account, div, J.sentinel_keys(*_ACCOUNT), J.sentinel_keys(*_ACCOUNT),
                            [F.col("div_sub_id").alias("_div")], how="inner" if usable else "left")
    return joined.select("plan_number", C.blank_to_sentinel("_div").alias("div_sub_id"), "client_id", "loan_cash_value_amt")


def loan_sums_div_sub(t: BalanceTables) -> DataFrame:
    """Positive loans per (plan, div/sub, client)."""
    return loan_div_sub_rows(t).groupBy("plan_number", "div_sub_id", "client_id").agg(
        F.sum("loan_cash_value_amt").alias("loan_cash_value_amt"))


def participant_div_sub_distinct(t: BalanceTables) -> DataFrame:
    """Distinct (plan, participant, div/sub) rows of the participant table."""
    return t.participant.select("plan_number", "participant_id", "div_sub_id").distinct()


def life_rows_with_div_sub(t: BalanceTables) -> DataFrame:
    """Row-level lookup: life rows with the division of the distinct participant rows."""
    keys = ("plan_number", "participant_id")
    return J.left_join_on(t.life, participant_div_sub_distinct(t), J.sentinel_keys(*keys), J.sentinel_keys(*keys),
                          ["div_sub_id"])


def life_sums_div_sub(t: BalanceTables, narrow: bool = False) -> DataFrame:
    """Life totals per (plan, raw div/sub, valuation date); summed per participant first."""
    per_account = S.life_sums(t.life, ["plan_number", "participant_id", "valuation_date"])
    keys = ("plan_number", "participant_id")
    joined = J.left_join_on(per_account, participant_div_sub_distinct(t), J.sentinel_keys(*keys),
                            J.sentinel_keys(*keys), ["div_sub_id"])
    return joined.groupBy("plan_number", "div_sub_id", "valuation_date").agg(
        S.narrowed(F.sum("life_cash_value_amount"), 2, narrow).alias("life_cash_value_amount"))


def div_sub_core_loan(t: BalanceTables, narrow: bool = False, usable: bool = False) -> DataFrame:
    """Core and loan sums per (client, plan, div/sub[, date]), FULL OUTER merged.

    ``usable`` filters divisions before the merge.  Exact for a report that
    drops merged rows without a usable division: a core row with a missing,
    blank or sentinel division meets loans of the sentinel division at most
    (loan divisions are blank-to-sentinel already), so such rows only merge
    into rows that the report drops, and never into others.
    """
    return J.full_outer_merge(core_div_sub_rows(t, usable), loan_div_sub_rows(t, usable),
                              ["client_id", "plan_number", "div_sub_id"], "none", narrow=narrow)


def _hot_divisions(t: BalanceTables, usable: bool = False) -> Column:
    """Heat of the division lookups' key: a division's share of the participants."""
    rows = t.participant.where(usable_division("div_sub_id")) if usable else t.participant
    return heat.hot_parts(rows, [C.sentinel(F.trim(c)) for c in ("plan_number", "div_sub_id")])


def div_sub_with_life(t: BalanceTables, narrow: bool = False) -> DataFrame:
    keys = J.sentinel_keys("plan_number", "div_sub_id")
    return J.left_join_on(div_sub_core_loan(t, narrow), life_sums_div_sub(t, narrow), keys,
                          J.sentinel_keys("plan_number", "div_sub_id"), ["life_cash_value_amount", "valuation_date"],
                          hot=_hot_divisions(t), spread=_cols("client_id", D))


def participant_counts_div_sub(t: BalanceTables, count_method: str | K.CountMaps = "two_step") -> DataFrame:
    """Counts per (plan, client, defaulted div/sub)."""
    return K.participant_counts(
        t.participant, ["plan_number", "client_id", ("div_sub_id", C.blank_to_sentinel("div_sub_id"))],
        count_method)


def _div_sub_lists(t: BalanceTables, count_method: str, narrow: bool, prefilter: bool):
    """Merged div/sub rows, each with the lists of its life totals and of its counts."""
    keys = lambda: J.sentinel_keys("plan_number", "div_sub_id")
    merged = div_sub_core_loan(t, narrow, usable=prefilter)
    life, counts = life_sums_div_sub(t, narrow), participant_counts_div_sub(t, count_method)
    if prefilter:  # a kept merged row's division is usable, so no other lookup row can match
        life, counts = life.where(usable_division("div_sub_id")), counts.where(usable_division("div_sub_id"))
    return J.attach_lists(merged, keys(), [
        (life, keys(), ["life_cash_value_amount", "valuation_date"]),
        (counts, keys(), list(K.COUNT_COLUMNS))], _cols("client_id", D), _hot_divisions(t, prefilter))


def div_sub_enriched(t: BalanceTables, count_method: str | K.CountMaps = "two_step", narrow: bool = False) -> DataFrame:
    """Merged div/sub rows with life totals (one row per valuation date) and
    counts (grouped per client but matched without it: one row per client).

    Both lookups match on (plan, div/sub), so they share one join of the
    merged rows.
    """
    return J.unfold(*_div_sub_lists(t, count_method, narrow, prefilter=False))


def _div_sub_finish(m: DataFrame, as_of: _dt.date | None) -> DataFrame:
    y = C.report_date(as_of, 1)
    return m.select(
        C.sentinel("client_id").alias("client_id"),
        C.blank_to_sentinel("plan_number").alias("plan_number"),
        C.blank_to_sentinel("div_sub_id").alias("div_sub_id"),
        _dec2("core_cash_value_amount").alias("core_cash_value_amount"),
        _noncore("sdba_cash_value_amount", "loan_cash_value_amt", "life_cash_value_amount")
        .alias("noncore_cash_value_amount"),
        _dec2("sdba_cash_value_amount").alias("sdba_cash_value_amount"),
        C.zero_money(C.dec("life_cash_value_amount", 13, 2)).alias("life_cash_value_amount_monthly"),
        F.col("valuation_date").alias("life_valuation_date"),
        C.zero_money(_dec2("loan_cash_value_amt")).alias("loan_cash_value_amount"),
        _dec2("ee_cash_value_amount").alias("ee_cash_value_amount"),
        _dec2("er_cash_value_amount").alias("er_cash_value_amount"),
        *[C.zero_count(F.col(c).cast("int")).alias(c) for c in K.COUNT_COLUMNS],
        _dec2("ytd_contributions").alias("ytd_contributions"),
        F.coalesce(F.col(D), y).alias(D),
        F.lit(None).cast("string").alias("plan_key"),
    )


def div_sub_report(t: BalanceTables, as_of: _dt.date | None = None, sort: bool = True,
                   count_method: str | K.CountMaps = "two_step", prefilter: bool = True, by_date: bool = False) -> DataFrame:
    """Division / sub-division balances (daily), optionally sorted descending.

    The exclusion test reads the merged, un-defaulted division, so NULL, ``''``
    and ``'-9999'`` divisions all drop; ``prefilter`` drops them at the
    participant scan already (exact, see ``div_sub_core_loan``).

    Sorted output (``ORDER BY plan_number DESC, div_sub_id DESC``): the life
    and count lookups multiply every merged row (one per valuation date and
    per client), so sorting after them would shuffle, and sample, the whole
    fanned-out result.  Instead the merged rows, each with its two lists, are
    range-partitioned by the output sort keys; the lists unfold behind that
    exchange and each partition is sorted locally.  Same order, one plan at
    every size, and only the rows before the fan-out move.  Ties may come in
    any order; the extra sort keys (client, date, valuation date) let the range
    partitioner split a hot (plan, div/sub) over several tasks.  ``by_date`` sorts
    by date first, as a sink partitioned by date stores it.
    """
    rows, lists = _div_sub_lists(t, count_method, narrow=True, prefilter=prefilter)
    rows = FL.div_sub_not_in(rows)
    if not sort:
        return _div_sub_finish(J.unfold(rows, lists), as_of)
    date = F.asc(F.coalesce(F.col(D), C.report_date(as_of, 1)))
    keys = [F.desc(C.blank_to_sentinel("plan_number")), F.desc(C.blank_to_sentinel("div_sub_id")), F.asc(C.sentinel("client_id"))]
    ranged = rows.repartitionByRange(*([date, *keys] if by_date else [*keys, date]))
    order = [F.desc("plan_number"), F.desc("div_sub_id"), F.asc("client_id"), F.asc("life_valuation_date")]
    order.insert(0 if by_date else 3, F.asc(D))
    return _div_sub_finish(J.unfold(ranged, lists), as_of).sortWithinPartitions(*order)
