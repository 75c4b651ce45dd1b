"""

Each query exposes one stage of a report (a scan, a row expression, a grouped
sum, a join, a filter) over the fixture tables, paired with oracle SQL for the
same stage.  Intermediate sums keep Spark's widened decimal precision
internally; ``canon`` casts any decimal wider than the inputs' 17 digits to
``decimal(38, s)`` so the result type equals DuckDB's ``sum`` type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import columns as C
from ..operators import counts as K
from ..operators import filters as FL
from ..operators import sums as S
from ..sources.fixtures import FIXTURE_AS_OF, derive_tables
from ..sources.tables import SCHEMAS, TABLE_NAMES, BalanceTables
from . import oracle as O
from . import reports as R

AS_OF = FIXTURE_AS_OF
Y = C.report_date  # (as_of, days_back) -> Column
D = "source_cycle_date"
PDAILY_KEYS = ["participant_id", "plan_number", "retirement_account_id", "client_id"]
PMONTH_KEYS = ["client_id", "participant_id", "plan_number"]


def canon(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, DecimalType) and t.precision > 17:
            cols.append(F.col(f.name).cast(DecimalType(38, t.scale)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _yesterday():
    return Y(AS_OF, 1)


# ---------------------------------------------------------------------------
# Spark side: name -> function of the derived tables
# ---------------------------------------------------------------------------

def _spark_ops() -> dict[str, Callable[[BalanceTables], DataFrame]]:
    ops: dict[str, Callable[[BalanceTables], DataFrame]] = {}
    # 2.1 scans
    for kind in SCHEMAS:
        ops[f"scan_{kind}"] = lambda t, k=kind: getattr(t, k)

    # 2.2 scalar expressions
    ops["sentinel_default"] = lambda t: t.participant.select(
        *[C.sentinel(c).alias(c) for c in ("participant_id", "client_id", "plan_number", "div_sub_id")], D)
    ops["blank_to_sentinel"] = lambda t: t.participant.select(
        "participant_id", C.blank_to_sentinel("plan_number").alias("plan_number"),
        C.blank_to_sentinel("div_sub_id").alias("div_sub_id"), D)
    ops["zero_default"] = lambda t: t.core_monthly.select(
        "participant_id", D, *[C.zero_money(c).alias(c)
                               for c in ("cash_value_amount", "sdba_cash_value_amount", "ytd_contributions")])
    ops["cycle_date_default"] = lambda t: t.core_monthly.select(
        "participant_id", "plan_number", F.coalesce(F.col(D), _yesterday()).alias(D))
    ops["decimal_casts"] = lambda t: R.plan_core_loan(t, "monthly", AS_OF).select(
        "client_id", "plan_number", D, C.dec("core_cash_value_amount", 17, 2).alias("core_cash_value_amount"),
        C.dec("ytd_contributions", 17, 2).alias("ytd_contributions"),
        C.dec("total_shares", 17, 4).alias("total_shares"),
        C.dec(C.zero_money("sdba_cash_value_amount") + C.zero_money("loan_cash_value_amt"), 13, 2)
        .alias("sdba_loan_amount"))
    ops["core_amount_exclusion"] = lambda t: t.core_monthly.select(
        "participant_id", "fund_iv", "client_id", C.core_amount(True).alias("core_cash_value_amount"))
    ops["core_amount_plain"] = lambda t: t.core_monthly.select(
        "participant_id", "fund_iv", "client_id", C.core_amount(False).alias("core_cash_value_amount"))
    ops["ee_er_split"] = lambda t: t.core_monthly.select(
        "participant_id", "money_type_description", C.money_type_amount(C.EE).alias("ee_cash_value_amount"),
        C.money_type_amount(C.ER).alias("er_cash_value_amount"))
    ops["loan_amount"] = lambda t: t.loan.select(
        "participant_id", "source_system", C.loan_amount().alias("loan_cash_value_amt"))
    ops["noncore_amount"] = lambda t: R.participant_with_life(t, "monthly", AS_OF).select(
        "client_id", "participant_id", "plan_number", D,
        R._noncore("life_cash_value_amount", "sdba_cash_value_amount", "loan_cash_value_amt")
        .alias("noncore_cash_value_amount"))
    ops["plan_total_amount"] = lambda t: R.plan_report(t, "monthly", AS_OF).select(
        "client_id", "plan_number", D, "total_cash_amount")
    ops["allocated_flag"] = lambda t: t.participant.select(
        "participant_id", "plan_number", "source_system", C.allocated_id().alias("allocated_participant_id"))
    ops["active_flag"] = lambda t: t.participant.select(
        "participant_id", "plan_number", "source_system", C.active_id().alias("active_participant_id"))
    ops["trimmed_keys"] = lambda t: t.core_daily.select(
        "participant_id", F.trim("client_id").alias("client_id"), F.trim("plan_number").alias("plan_number"))

    # 2.3 filters
    ops["loan_positive"] = lambda t: S.positive_loans(t.loan)
    ops["quarter_filter"] = lambda t: FL.quarter_filter(R.participant_core_loan(t, "monthly", AS_OF))
    ops["quarter_filter_defaulted"] = lambda t: FL.quarter_filter(
        R.client_keys_merged(t, "quarterly", AS_OF, prefilter=False))
    ops["div_sub_not_in"] = lambda t: FL.div_sub_not_in(R.div_sub_core_loan(t))
    for cad in R.CADENCES:
        ops[f"status_filter_{cad}"] = lambda t, c=cad: FL.status_filter(
            R.participant_report(t, c, AS_OF), t.participant, keep_status=True)

    # 2.4 joins
    ops["core_loan_full_outer"] = lambda t: R.participant_core_loan(t, "monthly", AS_OF)
    for cad in ("daily", "monthly"):
        ops[f"core_loan_participant_{cad}"] = lambda t, c=cad: R.participant_core_loan(t, c, AS_OF)
        ops[f"core_loan_plan_{cad}"] = lambda t, c=cad: R.plan_core_loan(t, c, AS_OF)
        ops[f"life_participant_{cad}"] = lambda t, c=cad: R.participant_with_life(t, c, AS_OF)
        ops[f"life_plan_{cad}"] = lambda t, c=cad: R.plan_with_life(t, c, AS_OF)
    ops["core_loan_div_sub"] = R.div_sub_core_loan
    for cad in R.CADENCES:
        ops[f"core_loan_client_{cad}"] = lambda t, c=cad: R.client_core_loan(t, c, prefilter=False, as_of=AS_OF)
    ops["merge_keys_client"] = lambda t: R.client_keys_merged(t, "monthly", AS_OF)
    ops["life_div_sub"] = R.div_sub_with_life
    ops["core_with_div_sub"] = lambda t: R.core_rows_with_div_sub(t).select(
        "participant_id", "client_id", "plan_number", D, "fund_iv", "cash_value_amount", "div_sub_id")
    ops["loan_with_div_sub"] = R.loan_rows_with_div_sub
    ops["life_with_div_sub"] = R.life_rows_with_div_sub
    ops["client_name_lookup"] = lambda t: R.client_named(t, "monthly", AS_OF)

    # 2.5 aggregations
    ops["core_sums_participant_daily"] = lambda t: S.core_sums(t.core_daily, PDAILY_KEYS + [D])
    ops["core_sums_participant_monthly"] = lambda t: S.core_sums(t.core_monthly, PMONTH_KEYS + [D])
    ops["core_sums_plan_daily"] = lambda t: S.core_sums(
        t.core_daily, ["client_id", ("plan_number", F.trim("plan_number")), D])
    ops["core_sums_plan_monthly"] = lambda t: S.core_sums(
        t.core_monthly, ["client_id", "plan_number", D], S.CORE_MEASURES + ("total_shares",))
    ops["core_sums_div_sub"] = R.core_sums_div_sub
    ops["core_sums_client"] = lambda t: S.core_sums(
        t.core_monthly, ["client_id", D], ("total_client_balance", "sdba_cash_value_amount"), exclude_funds=False)
    ops["loan_sums_participant_daily"] = lambda t: S.loan_sums(t.loan, PDAILY_KEYS)
    ops["loan_sums_participant_monthly"] = lambda t: S.loan_sums(t.loan, PMONTH_KEYS + [D])
    ops["loan_sums_plan_daily"] = lambda t: S.loan_sums(t.loan, ["plan_number", "client_id"])
    ops["loan_sums_plan_monthly"] = lambda t: S.loan_sums(t.loan, ["plan_number", D, "client_id"])
    ops["loan_sums_div_sub"] = R.loan_sums_div_sub
    ops["loan_sums_client_daily"] = lambda t: S.loan_sums(t.loan, ["client_id"])
    ops["loan_sums_client_monthly"] = lambda t: S.loan_sums(t.loan, ["client_id", D])
    ops["life_sums_participant"] = lambda t: S.life_sums(t.life, ["participant_id", "plan_number", "valuation_date"])
    ops["life_sums_plan"] = lambda t: S.life_sums(t.life, ["plan_number", "valuation_date"])
    ops["life_sums_div_sub"] = R.life_sums_div_sub
    ops["participant_counts_plan"] = lambda t: K.participant_counts(t.participant, ["plan_number"])
    ops["participant_counts_plan_month"] = lambda t: K.participant_counts(
        t.participant, ["plan_number", "client_id", D])
    ops["participant_counts_div_sub"] = R.participant_counts_div_sub
    ops["participant_div_sub_distinct"] = R.participant_div_sub_distinct
    return ops


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, f=fn: canon(f(derive_tables(s, d)))) for name, fn in _spark_ops().items()}


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------

def _sel(*ctes: str, body: str) -> str:
    return O.with_fixtures(*ctes, body=body)


def _cols(kind: str) -> str:
    return ", ".join(f.name for f in SCHEMAS[kind].fields)


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for kind, table in TABLE_NAMES.items():
        sql[f"scan_{kind}"] = _sel(body=f"SELECT {_cols(kind)} FROM {table}")
    sk, YD = O.sk, O.YESTERDAY
    P = O.PART
    sql["sentinel_default"] = _sel(body=(
        f"SELECT {sk('participant_id')} AS participant_id, {sk('client_id')} AS client_id, "
        f"{sk('plan_number')} AS plan_number, {sk('div_sub_id')} AS div_sub_id, source_cycle_date FROM {P}"))
    sql["blank_to_sentinel"] = _sel(body=(
        f"SELECT participant_id, coalesce(nullif(plan_number, ''), {O.S}) AS plan_number, "
        f"coalesce(nullif(div_sub_id, ''), {O.S}) AS div_sub_id, source_cycle_date FROM {P}"))
    sql["zero_default"] = _sel(body=(
        f"SELECT participant_id, source_cycle_date, coalesce(cash_value_amount, 0.00) AS cash_value_amount, "
        f"coalesce(sdba_cash_value_amount, 0.00) AS sdba_cash_value_amount, "
        f"coalesce(ytd_contributions, 0.00) AS ytd_contributions FROM {O.CORE_M}"))
    sql["cycle_date_default"] = _sel(body=(
        f"SELECT participant_id, plan_number, coalesce(source_cycle_date, {YD}) AS source_cycle_date "
        f"FROM {O.CORE_M}"))
    plan_m = O.plan_enriched_ctes("monthly")
    sql["decimal_casts"] = _sel(*plan_m, body=(
        "SELECT client_id, plan_number, source_cycle_date, "
        "CAST(core_cash_value_amount AS DECIMAL(17,2)) AS core_cash_value_amount, "
        "CAST(ytd_contributions AS DECIMAL(17,2)) AS ytd_contributions, "
        "CAST(total_shares AS DECIMAL(17,4)) AS total_shares, "
        "CAST(coalesce(sdba_cash_value_amount, 0.00) + coalesce(loan_cash_value_amt, 0.00) AS DECIMAL(13,2)) "
        "AS sdba_loan_amount FROM xt"))
    for name, excl in (("core_amount_exclusion", True), ("core_amount_plain", False)):
        sql[name] = _sel(body=(f"SELECT participant_id, fund_iv, client_id, {O.core_expr(excl)} "
                               f"AS core_cash_value_amount FROM {O.CORE_M}"))
    sql["ee_er_split"] = _sel(body=(
        f"SELECT participant_id, money_type_description, {O.money_type_expr(C.EE)} AS ee_cash_value_amount, "
        f"{O.money_type_expr(C.ER)} AS er_cash_value_amount FROM {O.CORE_M}"))
    sql["loan_amount"] = _sel(body=f"SELECT participant_id, source_system, {O.LOAN_EXPR} AS loan_cash_value_amt "
                                   f"FROM {O.LOAN}")
    part_m = O.participant_enriched_ctes("monthly")
    sql["noncore_amount"] = _sel(*part_m, body=(
        "SELECT client_id, participant_id, plan_number, source_cycle_date, "
        f"{O.noncore('life_cash_value_amount', 'sdba_cash_value_amount', 'loan_cash_value_amt')} "
        "AS noncore_cash_value_amount FROM pm"))
    sql["plan_total_amount"] = _sel(*plan_m, body=(
        f"SELECT client_id, plan_number, source_cycle_date, total_cash_amount FROM ({O.plan_select('monthly')}) r"))
    sql["allocated_flag"] = _sel(body=(
        f"SELECT participant_id, plan_number, source_system, {O.ALLOC_ID} AS allocated_participant_id FROM {P}"))
    sql["active_flag"] = _sel(body=(
        f"SELECT participant_id, plan_number, source_system, {O.ACTIVE_ID} AS active_participant_id FROM {P}"))
    sql["trimmed_keys"] = _sel(body=(
        f"SELECT participant_id, trim(client_id) AS client_id, trim(plan_number) AS plan_number FROM {O.CORE_D}"))

    # filters
    loan_cols = _cols("loan")
    sql["loan_positive"] = _sel(O.loan_rows("loan_pos"), body=f"SELECT {loan_cols}, loan_cash_value_amt FROM loan_pos")
    sql["quarter_filter"] = _sel(*part_m, body=f"SELECT * FROM pt WHERE {O.quarter_pred('source_cycle_date')}")
    sql["quarter_filter_defaulted"] = _sel(*O.client_ctes("quarterly"),
                                           body=f"SELECT * FROM cz WHERE {O.quarter_pred('source_cycle_date')}")
    ds = O.div_sub_ctes()
    sql["div_sub_not_in"] = _sel(*ds, body=f"SELECT * FROM dt WHERE div_sub_id NOT IN ({O.S}, '')")
    for cad in R.CADENCES:
        stmt = O.status_report(cad)
        sql[f"status_filter_{cad}"] = stmt.replace("SELECT r.* FROM rep r", "SELECT r.*, b.part_status_desc FROM rep r")

    # joins
    sql["core_loan_full_outer"] = _sel(*part_m, body="SELECT * FROM pt")
    for cad in ("daily", "monthly"):
        pe, pl = O.participant_enriched_ctes(cad), O.plan_enriched_ctes(cad)
        sql[f"core_loan_participant_{cad}"] = _sel(*pe, body="SELECT * FROM pt")
        sql[f"life_participant_{cad}"] = _sel(*pe, body="SELECT * FROM pm")
        sql[f"core_loan_plan_{cad}"] = _sel(*pl, body="SELECT * FROM xt")
        life_on = O.s_on("t", "f", ["plan_number"])
        if cad == "monthly":
            life_on += (f" AND coalesce(t.source_cycle_date, {YD}) = coalesce(f.valuation_date, {YD})")
        sql[f"life_plan_{cad}"] = _sel(*pl, body=(
            f"SELECT t.*, f.life_cash_value_amount, f.valuation_date FROM xt t LEFT JOIN xf f ON {life_on}"))
    sql["core_loan_div_sub"] = _sel(*ds, body="SELECT * FROM dt")
    for cad in R.CADENCES:
        table = O.CORE_D if cad == "daily" else O.CORE_M
        keys = ["client_id"] if cad == "daily" else ["client_id", "source_cycle_date"]
        mode = {"daily": "none", "monthly": "defaulted", "quarterly": "strict"}[cad]
        sql[f"core_loan_client_{cad}"] = _sel(
            f"cc AS (SELECT client_id, source_cycle_date, sum(coalesce(cash_value_amount, 0.00)) AS "
            f"total_client_balance, sum(coalesce(sdba_cash_value_amount, 0.00)) AS sdba_cash_value_amount "
            f"FROM {table} GROUP BY client_id, source_cycle_date)",
            O.loan_rows("loan_pos"), O.loan_sums("cl", keys),
            O.merge("cm", "cc", "cl", ["client_id"], ["total_client_balance", "sdba_cash_value_amount"], mode),
            body="SELECT * FROM cm")
    sql["merge_keys_client"] = _sel(*O.client_ctes("monthly"), body="SELECT * FROM cz")
    sql["life_div_sub"] = _sel(*ds, body=(
        f"SELECT t.*, f.life_cash_value_amount, f.valuation_date FROM dt t LEFT JOIN df f "
        f"ON {O.s_on('t', 'f', ['plan_number', 'div_sub_id'])}"))
    sql["core_with_div_sub"] = _sel(body=(
        f"SELECT b.participant_id, b.client_id, b.plan_number, b.source_cycle_date, b.fund_iv, b.cash_value_amount, "
        f"p.div_sub_id FROM {O.CORE_D} b LEFT JOIN {P} p ON b.plan_number = p.plan_number "
        f"AND b.client_id = p.client_id AND b.participant_id = p.participant_id"))
    sql["loan_with_div_sub"] = _sel(O.loan_rows("loan_pos"), body=(
        f"SELECT x.client_id, x.plan_number, x.participant_id, coalesce(nullif(p.div_sub_id, ''), {O.S}) AS div_sub_id, "
        f"x.loan_cash_value_amt FROM loan_pos x LEFT JOIN {P} p "
        f"ON {O.s_on('p', 'x', ['client_id', 'plan_number', 'participant_id'])}"))
    sql["life_with_div_sub"] = _sel(body=(
        f"SELECT f.participant_id, f.plan_number, f.valuation_date, f.cash_value_amt, p.div_sub_id "
        f"FROM {O.LIFE} f LEFT JOIN (SELECT plan_number, participant_id, div_sub_id FROM {P} "
        f"GROUP BY plan_number, participant_id, div_sub_id) p ON {O.s_on('p', 'f', ['plan_number', 'participant_id'])}"))
    sql["client_name_lookup"] = _sel(*O.client_ctes("monthly"), body=(
        f"SELECT z.*, n.client_name FROM cz z LEFT JOIN client n ON {O.s_on('z', 'n', ['client_id'])}"))

    # aggregations
    sql["core_sums_participant_daily"] = _sel(
        O.core_sums("a", O.CORE_D, PDAILY_KEYS + [D]), body="SELECT * FROM a")
    sql["core_sums_participant_monthly"] = _sel(
        O.core_sums("a", O.CORE_M, PMONTH_KEYS + [D]), body="SELECT * FROM a")
    sql["core_sums_plan_daily"] = _sel(
        O.core_sums("a", O.CORE_D, ["client_id", "trim(plan_number) AS plan_number", D]), body="SELECT * FROM a")
    sql["core_sums_plan_monthly"] = _sel(
        O.core_sums("a", O.CORE_M, ["client_id", "plan_number", D], shares=True), body="SELECT * FROM a")
    sql["core_sums_div_sub"] = _sel(*ds, body="SELECT * FROM dc")
    sql["core_sums_client"] = _sel(body=(
        f"SELECT client_id, source_cycle_date, sum(coalesce(cash_value_amount, 0.00)) AS total_client_balance, "
        f"sum(coalesce(sdba_cash_value_amount, 0.00)) AS sdba_cash_value_amount FROM {O.CORE_M} "
        f"GROUP BY client_id, source_cycle_date"))
    loan_keys = {
        "loan_sums_participant_daily": PDAILY_KEYS, "loan_sums_participant_monthly": PMONTH_KEYS + [D],
        "loan_sums_plan_daily": ["plan_number", "client_id"], "loan_sums_plan_monthly": ["plan_number", D, "client_id"],
        "loan_sums_client_daily": ["client_id"], "loan_sums_client_monthly": ["client_id", D]}
    for name, keys in loan_keys.items():
        sql[name] = _sel(O.loan_rows("loan_pos"), O.loan_sums("a", keys), body="SELECT * FROM a")
    sql["loan_sums_div_sub"] = _sel(*ds, body="SELECT * FROM dl")
    sql["life_sums_participant"] = _sel(O.life_sums("a", ["participant_id", "plan_number", "valuation_date"]),
                                        body="SELECT * FROM a")
    sql["life_sums_plan"] = _sel(O.life_sums("a", ["plan_number", "valuation_date"]), body="SELECT * FROM a")
    sql["life_sums_div_sub"] = _sel(*ds, body="SELECT * FROM df")
    sql["participant_counts_plan"] = _sel(O.counts("a", ["plan_number"]), body="SELECT * FROM a")
    sql["participant_counts_plan_month"] = _sel(O.counts("a", ["plan_number", "client_id", D]),
                                                body="SELECT * FROM a")
    sql["participant_counts_div_sub"] = _sel(*ds, body="SELECT * FROM dk")
    sql["participant_div_sub_distinct"] = _sel(body=(
        f"SELECT plan_number, participant_id, div_sub_id FROM {P} GROUP BY plan_number, participant_id, div_sub_id"))
    return sql
