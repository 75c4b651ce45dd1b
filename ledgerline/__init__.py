"""ledgerline: retirement-plan balance reports as Spark DataFrame plans.

Reports (client, plan, division/sub-division and participant grain; daily,
monthly and quarter-end cadence; participant-status variants) are composed
from small operators in ``operators`` over the inputs in ``sources``, using
only built-in Catalyst expressions.  ``plans.reports`` holds the reports,
``plans.registry`` the named queries the driver runs.
"""

from .plans.runner import ALL_REPORTS, build_report, register_report_views  # noqa: F401
from .sources.tables import BalanceTables, read_catalog_tables, read_parquet_tables  # noqa: F401

__all__ = ["ALL_REPORTS", "BalanceTables", "build_report", "read_catalog_tables", "read_parquet_tables",
           "register_report_views"]
