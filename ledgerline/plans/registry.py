"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are the report tables derived on Spark from the TPC-H-style Parquet
tables under ``sf_dir`` (``sources.fixtures``), with the fixture report date.
``oracle_sql()`` returns, for the same names, DuckDB SQL over the raw views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import FIXTURE_AS_OF, derive_tables
from . import oracle as O
from . import reports as R

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = FIXTURE_AS_OF


def _report_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for cad in R.CADENCES:
        q[f"client_{cad}"] = lambda s, d, c=cad: R.client_report(derive_tables(s, d), c, AS_OF)
        q[f"plan_{cad}"] = lambda s, d, c=cad: R.plan_report(derive_tables(s, d), c, AS_OF)
        q[f"participant_{cad}"] = lambda s, d, c=cad: R.participant_report(derive_tables(s, d), c, AS_OF)
        q[f"participant_{cad}_status"] = (
            lambda s, d, c=cad: R.participant_status_report(derive_tables(s, d), c, AS_OF))
    q["plan_quarterly_count"] = lambda s, d: R.plan_quarterly_count(derive_tables(s, d), AS_OF)
    q["div_sub_daily"] = lambda s, d: R.div_sub_report(derive_tables(s, d), AS_OF, sort=False)
    q["div_sub_daily_sorted"] = lambda s, d: R.div_sub_report(derive_tables(s, d), AS_OF, sort=True)
    return q


def queries() -> dict[str, Query]:
    from . import operator_queries
    return {**_report_queries(), **operator_queries.queries()}


def oracle_sql() -> dict[str, str]:
    from . import operator_queries
    sql = O.reports()
    sql["div_sub_daily_sorted"] = O.div_sub_report(order=True)
    return {**sql, **operator_queries.oracle_sql()}
