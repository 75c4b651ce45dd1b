"""Input tables of the balance reports: schemas, readers, and the bundle type.

The reports read six relational tables.  Their schemas are fixed here so that
every reader (Parquet paths, catalog tables, derived fixtures) hands the
operators the same column types: string ids and codes, ``date`` snapshot
dates, ``decimal(17,2)`` money and ``decimal(17,4)`` shares.  A timestamp
snapshot column would silently widen the date fallbacks, so dates are cast.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, StringType, StructField, StructType

MONEY = DecimalType(17, 2)
SHARES = DecimalType(17, 4)


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_S, _D = StringType(), DateType()

SCHEMAS: dict[str, StructType] = {
    "core_daily": _schema(
        ("participant_id", _S), ("client_id", _S), ("plan_number", _S), ("retirement_account_id", _S),
        ("source_cycle_date", _D), ("fund_iv", _S), ("money_type_description", _S),
        ("cash_value_amount", MONEY), ("sdba_cash_value_amount", MONEY), ("ytd_contributions", MONEY)),
    "core_monthly": _schema(
        ("participant_id", _S), ("client_id", _S), ("plan_number", _S), ("source_cycle_date", _D),
        ("fund_iv", _S), ("money_type_description", _S), ("cash_value_amount", MONEY),
        ("sdba_cash_value_amount", MONEY), ("ytd_contributions", MONEY), ("total_shares", SHARES)),
    "loan": _schema(
        ("participant_id", _S), ("client_id", _S), ("plan_number", _S), ("retirement_account_id", _S),
        ("source_cycle_date", _D), ("source_system", _S), ("outstanding_principal_balance", MONEY),
        ("loan_balance", MONEY)),
    "life": _schema(
        ("participant_id", _S), ("plan_number", _S), ("valuation_date", _D), ("cash_value_amt", MONEY)),
    "participant": _schema(
        ("participant_id", _S), ("client_id", _S), ("plan_number", _S), ("div_sub_id", _S),
        ("source_system", _S), ("account_type_code", _S), ("participant_status_code", _S),
        ("part_status_desc", _S), ("source_cycle_date", _D)),
    "client": _schema(("client_id", _S), ("client_name", _S)),
}

# Catalog table names used by the reports, per bundle field.
TABLE_NAMES: dict[str, str] = {
    "core_daily": "participant_core_balance",
    "core_monthly": "participant_core_balance_monthly",
    "loan": "participant_loan",
    "life": "participant_life_fund_monthly",
    "participant": "participant",
    "client": "client",
}


def conform(df: DataFrame, kind: str) -> DataFrame:
    """Project ``df`` onto the schema of ``kind``: pruned, ordered and cast.

    Selecting only the schema's columns lets Catalyst prune every other column
    from the scan; the casts are no-ops when the storage type already matches.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[kind].fields])


@dataclass(frozen=True)
class BalanceTables:
    """The six inputs of the balance reports, already conformed."""

    core_daily: DataFrame
    core_monthly: DataFrame
    loan: DataFrame
    life: DataFrame
    participant: DataFrame
    client: DataFrame

    def with_(self, **changes: DataFrame) -> "BalanceTables":
        return replace(self, **changes)


def read_parquet_tables(spark: SparkSession, root: str) -> BalanceTables:
    """Read ``<root>/<table name>`` Parquet datasets (directories or files).

    Datasets partitioned by ``source_cycle_date`` / ``valuation_date`` get
    partition pruning for free from the quarter pre-filter.
    """
    return BalanceTables(**{k: conform(spark.read.parquet(f"{root}/{name}"), k) for k, name in TABLE_NAMES.items()})


def read_catalog_tables(spark: SparkSession, database: str | None = None) -> BalanceTables:
    """Read the inputs as catalog tables, optionally qualified by ``database``."""
    qual = (lambda n: f"{database}.{n}") if database else (lambda n: n)
    return BalanceTables(**{k: conform(spark.table(qual(name)), k) for k, name in TABLE_NAMES.items()})
