"""Print a report's formatted physical plan.

Usage: python tools/explain.py REPORT [sf_dir | --stored ROOT] [--no-static-broadcast]

With ``sf_dir`` the inputs are derived from the TPC-H-style tables (as the
registered queries do); with ``--stored ROOT`` they are read from Parquet
datasets under ROOT (one per input table, as the batch runner reads them).
``--no-static-broadcast`` shows the plan a large input would get.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.runner import ALL_REPORTS, build_report  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.fixtures import FIXTURE_AS_OF, derive_tables  # noqa: E402
from ledgerline.sources.tables import read_parquet_tables  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("report", choices=ALL_REPORTS)
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--stored")
    ap.add_argument("--no-static-broadcast", action="store_true")
    args = ap.parse_args()
    spark = build_session()
    if args.no_static_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = read_parquet_tables(spark, args.stored) if args.stored else derive_tables(spark, args.sf_dir)
    build_report(args.report, tables, FIXTURE_AS_OF).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
