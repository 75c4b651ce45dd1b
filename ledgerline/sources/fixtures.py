"""Balance-table fixtures derived from the driver's TPC-H-style Parquet tables.

The reference ships no data, so the six input tables of the reports are
derived from ``customer``, ``orders``, ``lineitem`` and ``nation`` (see
FIXTURES.md).  Every derived column is written once, as SQL expression text
valid in both Spark SQL (ANSI on) and DuckDB; Spark evaluates it through
``F.expr`` and the oracle pastes the same text into its CTE prefix, so the two
engines read identical inputs.

Every table is derived with joins and aggregations on Spark, so the work grows
with the source tables; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import BalanceTables, conform

# Fixed value: the report date used by fixtures and oracle (replaces today).
FIXTURE_AS_OF = _dt.date(2001, 8, 1)

# One row per customer; the account attributes every other table reuses.
ACCT_COLUMNS: list[tuple[str, str]] = [
    ("c_custkey", "c_custkey"),
    ("participant_id", "lpad(cast(c_custkey as string),9,'0')"),
    ("client_id", "case when c_custkey % 97 = 0 then null when c_nationkey = 3 then 'NG' "
                  "else 'C' || lpad(cast(c_nationkey as string),2,'0') end"),
    ("plan_number", "case when c_custkey % 43 = 0 then null when c_custkey % 41 = 0 then '' "
                    "when c_custkey % 37 = 0 then ' P05 ' else 'P' || lpad(cast(c_custkey % 20 as string),2,'0') end"),
    ("div_sub_id", "case when c_custkey % 13 = 0 then null when c_custkey % 17 = 0 then '' "
                   "when c_custkey % 19 = 0 then ' D1 ' else 'D' || cast(c_custkey % 4 as string) end"),
    ("source_system", "case when c_custkey % 4 = 0 then 'VRP-PB' when c_custkey % 4 = 1 then 'VRP-SP' "
                      "when c_custkey % 8 = 2 then 'VRP_SP' else 'PREMIER' end"),
    ("account_type_code", "case when c_mktsegment in ('HOUSEHOLD','MACHINERY') then 'UNALLOC' else 'ALLOC' end"),
    ("participant_status_code", "case when c_custkey % 4 in (0,1) or c_custkey % 8 = 2 "
                                "then cast(c_custkey % 30 as string) when c_custkey % 8 = 3 then 'A' else 'T' end"),
    ("part_status_desc", "case when c_custkey % 23 = 0 then null when c_custkey % 3 = 0 then 'TERMINATED' "
                         "else 'ACTIVE' end"),
]

_CORE_COMMON: list[tuple[str, str]] = [
    # One customer in eleven has balances under another participant id, so their loans stand alone.
    ("participant_id", "case when o_custkey % 11 = 0 then 'X' || a.participant_id else a.participant_id end"),
    ("client_id", "a.client_id"),
    ("plan_number", "a.plan_number"),
    ("retirement_account_id", "'RA' || cast(o_orderkey % 2 as string)"),
    ("fund_iv", "cast(l_partkey % 100 as string)"),
    ("money_type_description", "case when l_linenumber % 3 = 0 then 'EE' when l_linenumber % 3 = 1 then 'ER' "
                               "else null end"),
    ("cash_value_amount", "case when l_linenumber = 7 then null else cast(l_extendedprice as decimal(17,2)) end"),
    ("sdba_cash_value_amount", "case when l_linenumber = 4 then cast(l_extendedprice as decimal(17,2)) "
                               "when l_linenumber = 5 then null else cast(0 as decimal(17,2)) end"),
    ("ytd_contributions", "case when l_linenumber = 6 then null else cast(l_quantity as decimal(17,2)) end"),
]

CORE_MONTHLY_COLUMNS: list[tuple[str, str]] = _CORE_COMMON + [
    ("source_cycle_date", "case when l_orderkey % 211 = 0 then null else last_day(cast(o_orderdate as date)) end"),
    ("total_shares", "cast(l_quantity as decimal(17,4))"),
]

CORE_DAILY_COLUMNS: list[tuple[str, str]] = _CORE_COMMON + [
    ("source_cycle_date", "case when l_orderkey % 211 = 0 then null else case when l_linenumber % 2 = 0 "
                          "then date '2001-07-30' else date '2001-07-31' end end"),
]

LOAN_COLUMNS: list[tuple[str, str]] = [
    # Two orders in three become loans of participants without balances.
    ("participant_id", "case when o_orderkey % 3 = 0 then a.participant_id else 'L' || a.participant_id end"),
    ("client_id", "a.client_id"),
    ("plan_number", "a.plan_number"),
    ("source_system", "a.source_system"),
    ("retirement_account_id", "'RA' || cast(o_orderkey % 2 as string)"),
    ("source_cycle_date", "case when o_orderkey % 223 = 0 then null else last_day(cast(o_orderdate as date)) end"),
    ("outstanding_principal_balance", "case when o_orderkey % 10 = 0 then null "
                                      "else cast(o_totalprice as decimal(17,2)) end"),
    ("loan_balance", "case when o_orderkey % 9 = 0 then cast(0 as decimal(17,2)) when o_orderkey % 15 = 0 "
                     "then cast(-25 as decimal(17,2)) else cast(o_totalprice as decimal(17,2)) end"),
]

LIFE_COLUMNS: list[tuple[str, str]] = [
    # Four orders in five become life-fund rows of participants without balances.
    ("participant_id", "case when o_orderkey % 5 = 0 then a.participant_id else 'F' || a.participant_id end"),
    ("plan_number", "a.plan_number"),
    ("valuation_date", "case when o_orderkey % 227 = 0 then null else last_day(cast(o_orderdate as date)) end"),
    ("cash_value_amt", "case when o_orderkey % 8 = 0 then null else cast(o_totalprice as decimal(17,2)) end"),
]

PARTICIPANT_ATTRS = ["participant_id", "client_id", "plan_number", "div_sub_id", "source_system",
                     "account_type_code", "participant_status_code", "part_status_desc"]
# Month-end of an order date; the participant snapshot dates derive from it.
ORDER_MONTH_END = "last_day(cast(o_orderdate as date))"
PARTICIPANT_SECOND_ROW_WHERE = "o_custkey % 50 = 0"

CLIENT_COLUMNS: list[tuple[str, str]] = [
    # One nation in eight is listed under another client id, so its clients have no name.
    ("client_id", "case when n_nationkey = 3 then 'NG' when n_nationkey % 8 = 7 then 'X' || lpad(cast(n_nationkey as string),2,'0') "
                  "else 'C' || lpad(cast(n_nationkey as string),2,'0') end"),
    ("client_name", "n_name"),
]


def _select(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns])


def _acct(customer: DataFrame) -> DataFrame:
    return _select(customer, ACCT_COLUMNS).alias("a")


def derive_tables(spark: SparkSession, sf_dir: str) -> BalanceTables:
    """Build the six report inputs from the TPC-H-style tables under ``sf_dir``."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    customer, orders, lineitem, nation = (read(n) for n in ("customer", "orders", "lineitem", "nation"))
    acct = _acct(customer)

    # Lines are by far the most rows.  They stream past hash tables of their partition's orders and customers and
    # are not sorted, so a task holds a share of those; the account attributes are computed behind the joins, so
    # the tables' rows are a few numbers wide.
    lines = (lineitem.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(customer.hint("shuffle_hash"), F.col("c_custkey") == F.col("o_custkey")))
    line_acct = lines.select("*", *[F.expr(e).alias(n) for n, e in ACCT_COLUMNS if n != e]).alias("a")
    order_acct = orders.join(acct, F.col("a.c_custkey") == F.col("o_custkey"))

    month_end = F.expr(ORDER_MONTH_END)
    latest = orders.groupBy("o_custkey").agg(F.max(month_end).alias("d"))
    earliest = (orders.where(PARTICIPANT_SECOND_ROW_WHERE)
                .groupBy("o_custkey").agg(F.min(month_end).alias("d")))
    snapshots = latest.unionByName(earliest).alias("m")
    participant = (acct.join(snapshots, F.col("m.o_custkey") == F.col("a.c_custkey"))
                   .select(*[F.col(f"a.{c}") for c in PARTICIPANT_ATTRS],
                           F.col("m.d").alias("source_cycle_date")))

    return BalanceTables(
        core_daily=conform(_select(line_acct, CORE_DAILY_COLUMNS), "core_daily"),
        core_monthly=conform(_select(line_acct, CORE_MONTHLY_COLUMNS), "core_monthly"),
        loan=conform(_select(order_acct, LOAN_COLUMNS), "loan"),
        life=conform(_select(order_acct, LIFE_COLUMNS), "life"),
        participant=conform(participant, "participant"),
        client=conform(_select(nation, CLIENT_COLUMNS), "client"),
    )


# ---------------------------------------------------------------------------
# The same derivation as SQL text: the CTE prefix of every oracle query.
# ---------------------------------------------------------------------------

def _cols_sql(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns)


def fixture_ctes_sql() -> str:
    """``name AS (...)`` CTE list defining the six inputs over the raw views."""
    acct = f"acct AS (SELECT {_cols_sql(ACCT_COLUMNS)} FROM customer)"
    line = ("FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
            "JOIN acct a ON a.c_custkey = o_custkey")
    core_m = f"participant_core_balance_monthly AS (SELECT {_cols_sql(CORE_MONTHLY_COLUMNS)} {line})"
    core_d = f"participant_core_balance AS (SELECT {_cols_sql(CORE_DAILY_COLUMNS)} {line})"
    loan = (f"participant_loan AS (SELECT {_cols_sql(LOAN_COLUMNS)} FROM orders JOIN acct a "
            "ON a.c_custkey = o_custkey)")
    life = (f"participant_life_fund_monthly AS (SELECT {_cols_sql(LIFE_COLUMNS)} FROM orders JOIN acct a "
            "ON a.c_custkey = o_custkey)")
    snaps = (f"snap AS (SELECT o_custkey, max({ORDER_MONTH_END}) AS d FROM orders GROUP BY o_custkey "
             f"UNION ALL SELECT o_custkey, min({ORDER_MONTH_END}) AS d FROM orders "
             f"WHERE {PARTICIPANT_SECOND_ROW_WHERE} GROUP BY o_custkey)")
    attrs = ", ".join(f"a.{c}" for c in PARTICIPANT_ATTRS)
    participant = (f"participant AS (SELECT {attrs}, m.d AS source_cycle_date FROM acct a "
                   "JOIN snap m ON m.o_custkey = a.c_custkey)")
    client = f"client AS (SELECT {_cols_sql(CLIENT_COLUMNS)} FROM nation)"
    return ",\n".join([acct, core_m, core_d, loan, life, snaps, participant, client])
