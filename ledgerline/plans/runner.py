"""Batch job: build and write a set of reports.

    python -m ledgerline.plans.runner --input <root> --output <root> \
        [--database db] [--as-of YYYY-MM-DD] [--reports name,name,...] [--publish | --changed]

Inputs are read either from Parquet datasets under ``--input`` (one directory
per table name) or from catalog tables in ``--database``.  Each report is
written to ``<output>/<report>``, partitioned by snapshot date, so a run
replaces the dates it computes and leaves all others as they are.  With
``--publish`` that happens for all reports at once, through a manifest
(``publication``), and a run that fails changes nothing.  Every
report, the status-filtered ones included, is built from this run's inputs
alone, never from what earlier runs have written.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..session import configure, database_bytes, size_for_input, stored_bytes, today
from ..sources.sinks import write_ordered, write_report
from ..sources.tables import BalanceTables, read_catalog_tables, read_parquet_tables
from . import publication
from . import reports as R


def report_builders(as_of: _dt.date | None) -> dict[str, object]:
    b: dict[str, object] = {}
    for cad in R.CADENCES:
        b[f"client_{cad}"] = lambda t, c=cad: R.client_report(t, c, as_of)
        b[f"plan_{cad}"] = lambda t, c=cad: R.plan_report(t, c, as_of)
        b[f"participant_{cad}"] = lambda t, c=cad: R.participant_report(t, c, as_of)
    b["plan_quarterly_count"] = lambda t: R.plan_quarterly_count(t, as_of)
    b["div_sub_daily"] = lambda t: R.div_sub_report(t, as_of, sort=False)
    b["div_sub_daily_sorted"] = lambda t: R.div_sub_report(t, as_of, sort=True)
    return b


STATUS_REPORTS = {f"participant_{c}_status": f"participant_{c}" for c in R.CADENCES}
ALL_REPORTS = list(report_builders(None)) + list(STATUS_REPORTS)
# Order of a date's rows on disk, across its files.
SORTED_BY = {"div_sub_daily_sorted": ("plan_number", "div_sub_id")}


def build_report(name: str, tables: BalanceTables, as_of: _dt.date | None = None) -> DataFrame:
    """Any report by name (see ``ALL_REPORTS``), as a lazy DataFrame."""
    if name in STATUS_REPORTS:
        return R.participant_status_report(tables, STATUS_REPORTS[name].rsplit("_", 1)[1], as_of)
    builders = report_builders(as_of)
    if name not in builders:
        raise ValueError(f"unknown report {name!r}; expected one of {ALL_REPORTS}")
    return builders[name](tables)


def register_report_views(spark: SparkSession, tables: BalanceTables, as_of: _dt.date | None = None,
                          names: list[str] | None = None, prefix: str = "") -> list[str]:
    """Register reports as temporary views (``<prefix><report>``) for SQL users.

    Views are lazy: ``spark.sql("SELECT ... FROM participant_monthly WHERE ...")``
    plans the report together with the query, so filters and column choices
    of the SQL reach the report's scans.
    """
    as_of = as_of or today(spark)
    registered = []
    for name in names or ALL_REPORTS:
        build_report(name, tables, as_of).createOrReplaceTempView(prefix + name)
        registered.append(prefix + name)
    return registered


def write(name: str, tables: BalanceTables, as_of: _dt.date, path: str) -> None:
    if name in SORTED_BY:
        write_ordered(R.div_sub_report(tables, as_of, sort=True, by_date=True), path, SORTED_BY[name])
    else:
        write_report(build_report(name, tables, as_of), path)


def run(spark: SparkSession, tables: BalanceTables, output: str, names: list[str] | None = None,
        as_of: _dt.date | None = None, publish: bool = False) -> dict[str, str]:
    """Write each requested report; returns report name -> output path.

    With ``as_of=None`` the date is fixed once for the whole run (the
    session's current date), so every report of the run agrees on "today" and
    "yesterday".  With ``publish``, the reports are written to a folder of this run
    and become visible together, when all are written (``publication``).
    """
    as_of = as_of or today(spark)
    names = names or ALL_REPORTS
    unknown = set(names) - set(ALL_REPORTS)
    if unknown:
        raise ValueError(f"unknown reports: {sorted(unknown)}")
    root = publication.new_run(output) if publish else output
    written = {name: f"{root}/{name}" for name in names}
    for name, path in written.items():
        write(name, tables, as_of, path)
    if publish:
        publication.commit(spark, output, written)
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="root folder with one Parquet dataset per input table")
    src.add_argument("--database", help="catalog database holding the input tables")
    ap.add_argument("--output", required=True)
    ap.add_argument("--as-of", type=_dt.date.fromisoformat, default=None)
    ap.add_argument("--reports", default=",".join(ALL_REPORTS))
    ap.add_argument("--changed", action="store_true",
                    help="with --input: compute and publish only dates that changed input partitions can reach")
    ap.add_argument("--publish", action="store_true", help="make all reports of the run visible together")
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())
    tables = read_parquet_tables(spark, args.input) if args.input else read_catalog_tables(spark, args.database)
    size_for_input(spark, stored_bytes(spark, args.input) if args.input else database_bytes(spark, args.database, tables))
    if args.changed:
        if not args.input:
            ap.error("--changed compares the files under --input")
        from .incremental import run_changed

        for name, dates in run_changed(spark, args.input, args.output, args.reports.split(","), args.as_of).items():
            print(f"{name}\t{'all dates' if dates is None else ','.join(sorted(map(str, dates)))}")
        return
    for name, path in run(spark, tables, args.output, args.reports.split(","), args.as_of, args.publish).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
