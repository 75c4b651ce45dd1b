"""Oracle SQL (DuckDB dialect, also plain ANSI) for every registered query.

Each statement starts with the fixture CTEs (``sources.fixtures``), then states
the report with set-based SQL only: ``count(DISTINCT CASE ...)`` for the
participant counts, explicit ``coalesce(key, '-9999')`` join conditions, fixed
report dates.  It shares no code path with the DataFrame operators, which is
what makes it an oracle.
"""

from __future__ import annotations

from ..sources.fixtures import FIXTURE_AS_OF, fixture_ctes_sql

TODAY = f"DATE '{FIXTURE_AS_OF.isoformat()}'"
YESTERDAY = f"(DATE '{FIXTURE_AS_OF.isoformat()}' - INTERVAL 1 DAY)"
YESTERDAY = f"CAST({YESTERDAY} AS DATE)"
Q = "(3, 6, 9, 12)"
S = "'-9999'"

CORE_D, CORE_M = "participant_core_balance", "participant_core_balance_monthly"
LOAN, LIFE, PART = "participant_loan", "participant_life_fund_monthly", "participant"


def with_fixtures(*ctes: str, body: str) -> str:
    parts = [fixture_ctes_sql(), *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def without_fixtures(sql: str) -> str:
    """The same statement over real input tables instead of fixture CTEs."""
    prefix = "WITH " + fixture_ctes_sql() + ",\n"
    if not sql.startswith(prefix):
        raise ValueError("statement does not start with the fixture CTEs")
    return "WITH " + sql[len(prefix):]


def sk(expr: str) -> str:
    """Sentinel-defaulted key."""
    return f"coalesce({expr}, {S})"


def on(pairs: list[tuple[str, str]]) -> str:
    return " AND ".join(f"{a} = {b}" for a, b in pairs)


def s_on(left: str, right: str, keys: list[str]) -> str:
    return on([(sk(f"{left}.{k}"), sk(f"{right}.{k}")) for k in keys])


# --- Row-level amounts (fixed values are written out here, apart from those of the plans) -----------------

def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


FUNDS = "'70', '90', '91'"


def core_expr(exclude: bool) -> str:
    if not exclude:
        return "coalesce(cash_value_amount, 0.00)"
    return (f"CASE WHEN fund_iv IN ({FUNDS}) AND client_id <> 'NG' THEN 0.0 "
            "ELSE coalesce(cash_value_amount, 0.00) END")


def money_type_expr(money_type: str) -> str:
    return f"CASE WHEN money_type_description = {lit(money_type)} THEN cash_value_amount END"


EE_EXPR = f"coalesce({money_type_expr('EE')}, 0.00)"
ER_EXPR = f"coalesce({money_type_expr('ER')}, 0.00)"
LOAN_EXPR = (f"CASE WHEN source_system = 'PREMIER' THEN outstanding_principal_balance "
             "ELSE loan_balance END")
ALLOC_ID = (f"CASE WHEN source_system = 'VRP-PB' OR source_system = 'VRP_SP' THEN "
            f"CASE WHEN account_type_code = 'ALLOC' THEN participant_id END "
            f"WHEN source_system = 'PREMIER' THEN participant_id END")
# The status code as a whole number, written without the engine's expression: a sign, digits and a dot are the only
# characters, a digit comes first, and there is one dot at most; what stands before the dot is the number.
_CODE = "trim(participant_status_code)"
_DIGITS = f"ltrim({_CODE}, '+-')"
STATUS_NUMBER = (f"CASE WHEN length({_CODE}) - length({_DIGITS}) <= 1 AND {_DIGITS} <> '' AND translate({_DIGITS}, '0123456789.', '') = '' "
                 f"AND substr({_DIGITS}, 1, 1) <> '.' AND length({_DIGITS}) - length(replace({_DIGITS}, '.', '')) <= 1 "
                 f"THEN try_cast(split_part({_CODE}, '.', 1) AS INTEGER) END")
ACTIVE_ID = (f"CASE WHEN source_system = 'VRP-PB' OR source_system = 'VRP-SP' THEN "
             f"CASE WHEN {STATUS_NUMBER} <= 16 "
             f"THEN participant_id END WHEN source_system = 'PREMIER' THEN "
             f"CASE WHEN participant_status_code = 'A' THEN participant_id END END")


def core_sums(name: str, table: str, keys: list[str], exclude: bool = True, shares: bool = False,
              where: str = "") -> str:
    """CTE summing core measures; ``keys`` are SQL expressions ``expr AS name`` or names."""
    exprs = [k.split(" AS ")[0] for k in keys]
    shares_col = ", sum(coalesce(total_shares, 0.00)) AS total_shares" if shares else ""
    return (f"{name} AS (SELECT {', '.join(keys)}, "
            f"sum({core_expr(exclude)}) AS core_cash_value_amount, "
            f"sum({EE_EXPR}) AS ee_cash_value_amount, sum({ER_EXPR}) AS er_cash_value_amount, "
            f"sum(coalesce(sdba_cash_value_amount, 0.00)) AS sdba_cash_value_amount, "
            f"sum(coalesce(ytd_contributions, 0.00)) AS ytd_contributions{shares_col} "
            f"FROM {table} {where} GROUP BY {', '.join(exprs)})")


def loan_rows(name: str, where: str = "") -> str:
    extra = f" AND {where}" if where else ""
    return (f"{name} AS (SELECT * FROM (SELECT *, {LOAN_EXPR} AS loan_cash_value_amt FROM {LOAN}) x "
            f"WHERE loan_cash_value_amt > 0{extra})")


def loan_sums(name: str, keys: list[str], src: str = "loan_pos") -> str:
    return (f"{name} AS (SELECT {', '.join(keys)}, sum(loan_cash_value_amt) AS loan_cash_value_amt "
            f"FROM {src} GROUP BY {', '.join(keys)})")


def life_sums(name: str, keys: list[str], where: str = "") -> str:
    return (f"{name} AS (SELECT {', '.join(keys)}, sum(coalesce(cash_value_amt, 0.00)) AS life_cash_value_amount "
            f"FROM {LIFE} {where} GROUP BY {', '.join(keys)})")


def counts(name: str, keys: list[str], table: str = PART, where: str = "") -> str:
    """Conditional distinct counts; ``keys`` may be ``expr AS name``."""
    exprs = [k.split(" AS ")[0] for k in keys]
    return (f"{name} AS (SELECT {', '.join(keys)}, count(DISTINCT {ALLOC_ID}) AS allocated_participant_count, "
            f"count(DISTINCT {ACTIVE_ID}) AS active_participant_count, "
            f"count(DISTINCT participant_id) AS participant_count FROM {table} {where} "
            f"GROUP BY {', '.join(exprs)})")


def merge(name: str, core: str, loan: str, keys: list[str], core_cols: list[str], date_mode: str) -> str:
    """FULL OUTER core x loan on sentinel keys; ``date_mode`` none/defaulted/strict."""
    cond = s_on("c", "l", keys)
    if date_mode == "defaulted":
        cond += (f" AND coalesce(c.source_cycle_date, {YESTERDAY}) = "
                 f"coalesce(l.source_cycle_date, {YESTERDAY})")
    elif date_mode == "strict":
        cond += " AND c.source_cycle_date = l.source_cycle_date"
    date = ("c.source_cycle_date" if date_mode == "none"
            else "coalesce(c.source_cycle_date, l.source_cycle_date)")
    merged = ", ".join(f"coalesce(c.{k}, l.{k}) AS {k}" for k in keys)
    measures = ", ".join(f"c.{m}" for m in core_cols)
    return (f"{name} AS (SELECT {merged}, {date} AS source_cycle_date, {measures}, l.loan_cash_value_amt "
            f"FROM {core} c FULL OUTER JOIN {loan} l ON {cond})")


CORE5 = ["core_cash_value_amount", "ee_cash_value_amount", "er_cash_value_amount", "sdba_cash_value_amount",
         "ytd_contributions"]


def d2(x: str) -> str:
    return f"CAST({x} AS DECIMAL(17,2))"


def d13(x: str) -> str:
    return f"CAST({x} AS DECIMAL(13,2))"


def z(x: str) -> str:
    return f"coalesce({x}, 0.00)"


def noncore(*xs: str) -> str:
    return d13(" + ".join(z(x) for x in xs))


def quarter_pred(col: str) -> str:
    return f"month({col}) IN {Q}"


# --- Participant grain ------------------------------------------------------------

def participant_enriched_ctes(cadence: str) -> list[str]:
    """CTEs ending in ``pm`` = merged core/loan rows with life attached."""
    if cadence == "daily":
        keys = ["participant_id", "plan_number", "retirement_account_id", "client_id"]
        return [
            core_sums("pc", CORE_D, keys + ["source_cycle_date"]),
            loan_rows("loan_pos"),
            loan_sums("pl", keys),
            merge("pt", "pc", "pl", keys, CORE5, "none"),
            life_sums("pf", ["participant_id", "plan_number", "valuation_date"]),
            f"pm AS (SELECT t.*, f.life_cash_value_amount, f.valuation_date FROM pt t LEFT JOIN pf f "
            f"ON {s_on('t', 'f', ['participant_id', 'plan_number'])})",
        ]
    keys = ["client_id", "participant_id", "plan_number"]
    return [
        core_sums("pc", CORE_M, keys + ["source_cycle_date"]),
        loan_rows("loan_pos"),
        loan_sums("pl", keys + ["source_cycle_date"]),
        merge("pt", "pc", "pl", keys, CORE5, "defaulted"),
        life_sums("pf", ["participant_id", "plan_number", "valuation_date"]),
        f"pm AS (SELECT t.*, f.life_cash_value_amount, f.valuation_date FROM pt t LEFT JOIN pf f "
        f"ON {s_on('t', 'f', ['participant_id', 'plan_number'])} AND coalesce(t.source_cycle_date, {YESTERDAY}) "
        f"= coalesce(f.valuation_date, {YESTERDAY}))",
    ]


def participant_select(cadence: str) -> str:
    if cadence == "daily":
        return (f"SELECT {sk('client_id')} AS client_id, coalesce(nullif(plan_number, ''), {S}) AS plan_number, "
                f"{sk('participant_id')} AS participant_id, retirement_account_id, "
                f"coalesce(source_cycle_date, {YESTERDAY}) AS source_cycle_date, "
                f"{z(d2('core_cash_value_amount'))} AS core_cash_value_amount, "
                f"{z(d2('ytd_contributions'))} AS ytd_contributions, "
                f"{z(d2('ee_cash_value_amount'))} AS ee_cash_value_amount, "
                f"{z(d2('er_cash_value_amount'))} AS er_cash_value_amount, "
                f"{z(d13('life_cash_value_amount'))} AS life_cash_value_amount_monthly, "
                f"{z(d2('sdba_cash_value_amount'))} AS sdba_cash_value_amount, "
                f"{z(d2('loan_cash_value_amt'))} AS loan_cash_value_amount, "
                f"{noncore('sdba_cash_value_amount', 'loan_cash_value_amt', 'life_cash_value_amount')} "
                f"AS noncore_cash_value_amount, valuation_date AS life_valuation_date FROM pm")
    amt = d2 if cadence == "quarterly" else (lambda x: z(d2(x)))
    where = f" WHERE {quarter_pred('source_cycle_date')}" if cadence == "quarterly" else ""
    return (f"SELECT {sk('client_id')} AS client_id, {sk('plan_number')} AS plan_number, "
            f"{sk('participant_id')} AS participant_id, "
            f"coalesce(source_cycle_date, {YESTERDAY}) AS source_cycle_date, "
            f"{amt('core_cash_value_amount')} AS core_cash_value_amount, "
            f"{amt('ee_cash_value_amount')} AS ee_cash_value_amount, "
            f"{amt('er_cash_value_amount')} AS er_cash_value_amount, "
            f"{d13(z('life_cash_value_amount'))} AS life_cash_value_amount_monthly, "
            f"valuation_date AS life_valuation_date, "
            f"{amt('sdba_cash_value_amount')} AS sdba_cash_value_amount, "
            f"{z(d2('loan_cash_value_amt'))} AS loan_cash_value_amount, "
            f"{noncore('life_cash_value_amount', 'sdba_cash_value_amount', 'loan_cash_value_amt')} "
            f"AS noncore_cash_value_amount, {amt('ytd_contributions')} AS ytd_contributions FROM pm{where}")


def participant_report(cadence: str) -> str:
    return with_fixtures(*participant_enriched_ctes(cadence), body=participant_select(cadence))


def _status_predicate() -> str:
    amounts = ["r.core_cash_value_amount", "r.life_cash_value_amount_monthly", "r.sdba_cash_value_amount",
               "r.loan_cash_value_amount", "r.noncore_cash_value_amount"]
    core, life, sdba, loan, noncore = amounts
    active, inactive = f"b.part_status_desc = 'ACTIVE'", f"b.part_status_desc <> 'ACTIVE'"
    zero = " AND ".join(f"{a} = 0" for a in amounts)
    nonzero_all = " AND ".join(f"{a} <> 0" for a in amounts)
    nonzero_any = " OR ".join(f"{a} <> 0" for a in amounts)
    grouped = f"{core} <> 0 OR ({life} <> 0 AND {sdba} <> 0) OR {loan} <> 0 OR {noncore} <> 0"
    return (f"(({zero} AND {active}) OR (({grouped}) AND {active}) "
            f"OR ({nonzero_all} AND {inactive}) OR (({nonzero_any}) AND {inactive}))")


STATUS_PREDICATE = _status_predicate()


def status_report(cadence: str) -> str:
    """Literal LEFT JOIN + predicate (no inner-join rewrite on the oracle side)."""
    rep = f"rep AS ({participant_select(cadence)})"
    body = (f"SELECT r.* FROM rep r LEFT JOIN (SELECT participant_id, plan_number, client_id, part_status_desc "
            f"FROM {PART}) b ON {s_on('r', 'b', ['participant_id', 'plan_number', 'client_id'])} "
            f"WHERE {STATUS_PREDICATE}")
    return with_fixtures(*participant_enriched_ctes(cadence), rep, body=body)


# --- Plan grain --------------------------------------------------------------------

def plan_enriched_ctes(cadence: str) -> list[str]:
    """CTEs ending in ``xm`` = merged plan rows with life and counts."""
    if cadence == "daily":
        return [
            core_sums("xc", CORE_D, ["client_id", "trim(plan_number) AS plan_number", "source_cycle_date"]),
            loan_rows("loan_pos"),
            loan_sums("xl", ["plan_number", "client_id"]),
            merge("xt", "xc", "xl", ["client_id", "plan_number"], CORE5, "none"),
            life_sums("xf", ["plan_number", "valuation_date"]),
            counts("xk", ["plan_number"]),
            f"xm AS (SELECT t.*, f.life_cash_value_amount, f.valuation_date, k.allocated_participant_count, "
            f"k.active_participant_count, k.participant_count FROM xt t "
            f"LEFT JOIN xf f ON {s_on('t', 'f', ['plan_number'])} "
            f"LEFT JOIN xk k ON {s_on('t', 'k', ['plan_number'])})",
        ]
    return [
        core_sums("xc", CORE_M, ["client_id", "plan_number", "source_cycle_date"], shares=True),
        loan_rows("loan_pos"),
        loan_sums("xl", ["plan_number", "source_cycle_date", "client_id"]),
        merge("xt", "xc", "xl", ["client_id", "plan_number"], CORE5 + ["total_shares"], "defaulted"),
        life_sums("xf", ["plan_number", "valuation_date"]),
        counts("xk", ["plan_number", "client_id", "source_cycle_date"]),
        f"xm AS (SELECT t.*, f.life_cash_value_amount, f.valuation_date, k.allocated_participant_count, "
        f"k.active_participant_count, k.participant_count FROM xt t "
        f"LEFT JOIN xf f ON {s_on('t', 'f', ['plan_number'])} AND coalesce(t.source_cycle_date, {YESTERDAY}) "
        f"= coalesce(f.valuation_date, {YESTERDAY}) "
        f"LEFT JOIN xk k ON {s_on('t', 'k', ['plan_number'])} AND t.source_cycle_date = k.source_cycle_date)",
    ]


def plan_select(cadence: str) -> str:
    if cadence == "daily":
        cnt = ", ".join(f"coalesce(CAST({c} AS INTEGER), 0) AS {c}"
                        for c in ("participant_count", "active_participant_count", "allocated_participant_count"))
        return (f"SELECT {sk('client_id')} AS client_id, coalesce(nullif(plan_number, ''), {S}) AS plan_number, "
                f"{z(d2('core_cash_value_amount'))} AS core_cash_value_amount, "
                f"{z(noncore('sdba_cash_value_amount', 'loan_cash_value_amt', 'life_cash_value_amount'))} "
                f"AS noncore_cash_value_amount, {z(d2('sdba_cash_value_amount'))} AS sdba_cash_value_amount, "
                f"{z(d13('life_cash_value_amount'))} AS life_cash_value_amount_monthly, "
                f"valuation_date AS life_valuation_date, {z(d2('loan_cash_value_amt'))} AS loan_cash_value_amount, "
                f"{z(d2('ee_cash_value_amount'))} AS ee_cash_value_amount, "
                f"{z(d2('er_cash_value_amount'))} AS er_cash_value_amount, {cnt}, "
                f"{d2('ytd_contributions')} AS ytd_contributions, "
                f"coalesce(source_cycle_date, {YESTERDAY}) AS source_cycle_date, "
                f"CAST(NULL AS VARCHAR) AS plan_key FROM xm")
    sdba = "sdba_cash_value_amoun" if cadence == "monthly" else "sdba_cash_value_amount"
    where = f" WHERE {quarter_pred('source_cycle_date')}" if cadence == "quarterly" else ""
    nc = noncore("life_cash_value_amount", "sdba_cash_value_amount", "loan_cash_value_amt")
    return (f"SELECT {sk('client_id')} AS client_id, {sk('plan_number')} AS plan_number, "
            f"coalesce(source_cycle_date, {YESTERDAY}) AS source_cycle_date, "
            f"{z(d2('core_cash_value_amount'))} AS core_cash_value_amount, "
            f"{z(d2('ee_cash_value_amount'))} AS ee_cash_value_amount, "
            f"{z(d2('er_cash_value_amount'))} AS er_cash_value_amount, "
            f"{d13(z('life_cash_value_amount'))} AS life_cash_value_amount, "
            f"{z(d2('sdba_cash_value_amount'))} AS {sdba}, "
            f"{z(d2('loan_cash_value_amt'))} AS loan_cash_value_amount, {nc} AS noncore_cash_value_amount, "
            f"{z(d2('ytd_contributions'))} AS ytd_contributions, "
            f"CAST(coalesce(total_shares, 0.00) AS DECIMAL(17,4)) AS total_shares, "
            f"CAST(allocated_participant_count AS INTEGER) AS allocated_participant_count, "
            f"CAST(active_participant_count AS INTEGER) AS active_participant_count, "
            f"CAST(participant_count AS INTEGER) AS participant_count, "
            f"{d2(d2('core_cash_value_amount') + ' + ' + nc)} AS total_cash_amount, "
            f"CAST(NULL AS VARCHAR) AS plan_key FROM xm{where}")


def plan_report(cadence: str) -> str:
    return with_fixtures(*plan_enriched_ctes(cadence), body=plan_select(cadence))


def plan_quarterly_count() -> str:
    return with_fixtures(*plan_enriched_ctes("quarterly"),
                         body=f"SELECT count(*) AS row_count FROM ({plan_select('quarterly')}) q")


# --- Client grain ------------------------------------------------------------------

def client_ctes(cadence: str) -> list[str]:
    table = CORE_D if cadence == "daily" else CORE_M
    core = (f"cc AS (SELECT client_id, source_cycle_date, sum(coalesce(cash_value_amount, 0.00)) "
            f"AS total_client_balance, sum(coalesce(sdba_cash_value_amount, 0.00)) AS sdba_cash_value_amount "
            f"FROM {table} GROUP BY client_id, source_cycle_date)")
    if cadence == "daily":
        loan = loan_sums("cl", ["client_id"])
        cond, date = s_on("c", "l", ["client_id"]), f"coalesce(c.source_cycle_date, {TODAY})"
    else:
        loan = loan_sums("cl", ["client_id", "source_cycle_date"])
        if cadence == "monthly":
            cond = (s_on("c", "l", ["client_id"]) + f" AND coalesce(c.source_cycle_date, {YESTERDAY}) = "
                    f"coalesce(l.source_cycle_date, {YESTERDAY})")
            date = f"coalesce(c.source_cycle_date, l.source_cycle_date, {YESTERDAY})"
        else:
            cond = s_on("c", "l", ["client_id"]) + " AND c.source_cycle_date = l.source_cycle_date"
            date = f"coalesce(c.source_cycle_date, l.source_cycle_date, {TODAY})"
    zz = (f"cz AS (SELECT coalesce(c.client_id, l.client_id, {S}) AS client_id, {date} AS source_cycle_date, "
          f"{d2('c.total_client_balance')} AS total_client_balance, "
          f"{d2('c.sdba_cash_value_amount')} AS sdba_cash_value_amount, "
          f"{d2('l.loan_cash_value_amt')} AS client_loan_balance FROM cc c FULL OUTER JOIN cl l ON {cond})")
    return [core, loan_rows("loan_pos"), loan, zz]


def client_report(cadence: str) -> str:
    where = f" WHERE {quarter_pred('z.source_cycle_date')}" if cadence == "quarterly" else ""
    body = (f"SELECT z.client_id, z.source_cycle_date, n.client_name, "
            f"{z('z.total_client_balance')} AS cash_value_amount, {z('z.client_loan_balance')} AS total_loan_amount, "
            f"{z('z.sdba_cash_value_amount')} AS sdba_cash_value_amount FROM cz z LEFT JOIN client n "
            f"ON {s_on('z', 'n', ['client_id'])}{where}")
    return with_fixtures(*client_ctes(cadence), body=body)


# --- Division / sub-division grain ------------------------------------------------

def div_sub_ctes() -> list[str]:
    core_rows = (f"dr AS (SELECT trim(b.client_id) AS client_id, trim(b.plan_number) AS plan_number, "
                 f"trim(p.div_sub_id) AS div_sub_id, b.source_cycle_date, "
                 f"coalesce(b.cash_value_amount, 0.00) AS core_v, "
                 f"{EE_EXPR} AS ee_v, {ER_EXPR} AS er_v, "
                 f"coalesce(b.sdba_cash_value_amount, 0.00) AS sdba_v, coalesce(b.ytd_contributions, 0.00) AS ytd_v "
                 f"FROM {CORE_D} b LEFT JOIN {PART} p ON b.plan_number = p.plan_number "
                 f"AND b.client_id = p.client_id AND b.participant_id = p.participant_id)")
    core = ("dc AS (SELECT client_id, plan_number, div_sub_id, source_cycle_date, "
            "sum(core_v) AS core_cash_value_amount, sum(ee_v) AS ee_cash_value_amount, "
            "sum(er_v) AS er_cash_value_amount, sum(sdba_v) AS sdba_cash_value_amount, "
            "sum(ytd_v) AS ytd_contributions FROM dr GROUP BY client_id, plan_number, div_sub_id, source_cycle_date)")
    loan = (f"dl AS (SELECT x.plan_number, coalesce(nullif(p.div_sub_id, ''), {S}) AS div_sub_id, x.client_id, "
            f"sum(x.loan_cash_value_amt) AS loan_cash_value_amt FROM loan_pos x LEFT JOIN {PART} p "
            f"ON {s_on('p', 'x', ['client_id', 'plan_number', 'participant_id'])} "
            f"GROUP BY x.plan_number, coalesce(nullif(p.div_sub_id, ''), {S}), x.client_id)")
    life = (f"df AS (SELECT f.plan_number, p.div_sub_id, f.valuation_date, "
            f"sum(coalesce(f.cash_value_amt, 0.00)) AS life_cash_value_amount FROM {LIFE} f "
            f"LEFT JOIN (SELECT plan_number, participant_id, div_sub_id FROM {PART} "
            f"GROUP BY plan_number, participant_id, div_sub_id) p "
            f"ON {s_on('p', 'f', ['plan_number', 'participant_id'])} "
            f"GROUP BY f.plan_number, p.div_sub_id, f.valuation_date)")
    cnt = counts("dk", ["plan_number", "client_id", f"coalesce(nullif(div_sub_id, ''), {S}) AS div_sub_id"])
    merged = merge("dt", "dc", "dl", ["client_id", "plan_number", "div_sub_id"], CORE5, "none")
    enriched = (f"dm AS (SELECT t.*, f.life_cash_value_amount, f.valuation_date, k.allocated_participant_count, "
                f"k.active_participant_count, k.participant_count FROM dt t "
                f"LEFT JOIN df f ON {s_on('t', 'f', ['plan_number', 'div_sub_id'])} "
                f"LEFT JOIN dk k ON {s_on('t', 'k', ['plan_number', 'div_sub_id'])})")
    return [core_rows, core, loan_rows("loan_pos"), loan, life, cnt, merged, enriched]


def div_sub_select(order: bool) -> str:
    cnt = ", ".join(f"coalesce(CAST({c} AS INTEGER), 0) AS {c}"
                    for c in ("allocated_participant_count", "active_participant_count", "participant_count"))
    sel = (f"SELECT {sk('client_id')} AS client_id, coalesce(nullif(plan_number, ''), {S}) AS plan_number, "
           f"coalesce(nullif(div_sub_id, ''), {S}) AS div_sub_id_out, "
           f"{d2('core_cash_value_amount')} AS core_cash_value_amount, "
           f"{noncore('sdba_cash_value_amount', 'loan_cash_value_amt', 'life_cash_value_amount')} "
           f"AS noncore_cash_value_amount, {d2('sdba_cash_value_amount')} AS sdba_cash_value_amount, "
           f"{z(d13('life_cash_value_amount'))} AS life_cash_value_amount_monthly, "
           f"valuation_date AS life_valuation_date, {z(d2('loan_cash_value_amt'))} AS loan_cash_value_amount, "
           f"{d2('ee_cash_value_amount')} AS ee_cash_value_amount, "
           f"{d2('er_cash_value_amount')} AS er_cash_value_amount, {cnt}, "
           f"{d2('ytd_contributions')} AS ytd_contributions, "
           f"coalesce(source_cycle_date, {YESTERDAY}) AS source_cycle_date, "
           f"CAST(NULL AS VARCHAR) AS plan_key FROM dm WHERE div_sub_id NOT IN ({S}, '')")
    cols = ("client_id, plan_number, div_sub_id_out AS div_sub_id, core_cash_value_amount, "
            "noncore_cash_value_amount, sdba_cash_value_amount, life_cash_value_amount_monthly, life_valuation_date, "
            "loan_cash_value_amount, ee_cash_value_amount, er_cash_value_amount, allocated_participant_count, "
            "active_participant_count, participant_count, ytd_contributions, source_cycle_date, plan_key")
    tail = " ORDER BY plan_number DESC, div_sub_id DESC" if order else ""
    return f"SELECT {cols} FROM ({sel}) s{tail}"


def div_sub_report(order: bool = True) -> str:
    return with_fixtures(*div_sub_ctes(), body=div_sub_select(order))


def reports() -> dict[str, str]:
    out = {}
    for cad in ("daily", "monthly", "quarterly"):
        out[f"client_{cad}"] = client_report(cad)
        out[f"plan_{cad}"] = plan_report(cad)
        out[f"participant_{cad}"] = participant_report(cad)
        out[f"participant_{cad}_status"] = status_report(cad)
    out["plan_quarterly_count"] = plan_quarterly_count()
    out["div_sub_daily"] = div_sub_report(order=False)
    return out
