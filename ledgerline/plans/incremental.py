"""Recompute what changed: report dates follow the date partitions of the inputs.

A row of a period report (monthly, quarterly) for date d is made of balance and
loan rows dated d, life rows valued at d and, for plan counts, participant rows
dated d.  Undated rows count for the report's fallback date, which moves with
the day of the run.  Client names and participant statuses carry no date: a
change there concerns every date.  Daily reports match loans, life totals and
counts without a date, so any change concerns all of their dates.
``DEPENDS`` states this for each report.

``input_state`` lists the files of every input table by date partition, with
Spark's distributed file listing, and folds name, length and time of
modification into one fingerprint a partition; no data is read.  The state of
the last run is kept beside the published reports.  ``run_changed`` compares
both, restricts the inputs to the dates that a change can reach, builds the
reports for those dates alone and publishes them (``publication``), all other
dates keeping the files they have.  What reaches the driver is one row a
table and date.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import today
from ..sources.sinks import DATE_COLUMN, write_report
from ..sources.tables import TABLE_NAMES, BalanceTables, read_parquet_tables
from . import publication
from .runner import ALL_REPORTS, build_report, write

# Date column of each input that is stored by date.
DATES = {"core_daily": "source_cycle_date", "core_monthly": "source_cycle_date", "loan": "source_cycle_date",
         "life": "valuation_date", "participant": "source_cycle_date"}
# Partition folder of rows without a date, and the key of files outside any partition.
UNDATED, WHOLE = "__HIVE_DEFAULT_PARTITION__", "*"
STATE = "_inputs"


@dataclass(frozen=True)
class Depends:
    """Inputs that a report's dates follow, inputs that concern all dates, and days from the run to the fallback date."""

    dated: tuple[str, ...]
    whole: tuple[str, ...] = ()
    days_back: int = 1


_BALANCES = ("core_monthly", "loan")
DEPENDS: dict[str, Depends] = {
    "client_monthly": Depends(_BALANCES, ("client",)),
    "client_quarterly": Depends(_BALANCES, ("client",), days_back=0),
    "plan_monthly": Depends((*_BALANCES, "life", "participant")),
    "plan_quarterly": Depends((*_BALANCES, "life", "participant")),
    "participant_monthly": Depends((*_BALANCES, "life")),
    "participant_quarterly": Depends((*_BALANCES, "life")),
    "participant_monthly_status": Depends((*_BALANCES, "life"), ("participant",)),
    "participant_quarterly_status": Depends((*_BALANCES, "life"), ("participant",)),
    "client_daily": Depends((), ("core_daily", "loan", "client")),
    "plan_daily": Depends((), ("core_daily", "loan", "life", "participant")),
    "div_sub_daily": Depends((), ("core_daily", "loan", "life", "participant")),
    "div_sub_daily_sorted": Depends((), ("core_daily", "loan", "life", "participant")),
    "participant_daily": Depends((), ("core_daily", "loan", "life")),
    "participant_daily_status": Depends((), ("core_daily", "loan", "life", "participant")),
    "plan_quarterly_count": Depends((), (*_BALANCES, "life", "participant")),
}


def input_state(spark: SparkSession, root: str) -> DataFrame:
    """(input, date, files, fingerprint) of every date partition of the inputs under ``root``."""
    parts = []
    for field, name in TABLE_NAMES.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        files = files.load(f"{root}/{name}").select("path", "length", "modificationTime")
        folder = F.regexp_extract("path", rf"/{DATES.get(field, '')}=([^/]+)/", 1) if field in DATES else F.lit("")
        rows = files.select(F.lit(field).alias("input"), F.when(folder == "", F.lit(WHOLE)).otherwise(folder).alias("date"),
                            F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
        parts.append(rows.groupBy("input", "date").agg(F.count(F.lit(1)).alias("files"), F.sum("h").alias("fingerprint")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def changes(before: DataFrame | None, now: DataFrame) -> dict[str, set[str]]:
    """input -> dates whose files differ (``WHOLE``: files outside any date)."""
    if before is None:
        rows = now.select("input", "date").collect()
    else:
        old = before.select("input", "date", F.struct("files", "fingerprint").alias("old"))
        both = now.select("input", "date", F.struct("files", "fingerprint").alias("new")).join(old, ["input", "date"], "full")
        rows = both.where(~F.col("old").eqNullSafe(F.col("new"))).select("input", "date").collect()
    out: dict[str, set[str]] = {}
    for r in rows:
        out.setdefault(r["input"], set()).add(r["date"])
    return out


def affected(name: str, changed: dict[str, set[str]], as_of: _dt.date, previous: _dt.date | None) -> set[_dt.date] | None:
    """Dates of report ``name`` to compute again; None for all of them."""
    need = DEPENDS[name]
    moved = previous != as_of
    if any(changed.get(t) for t in need.whole) or (not need.dated and moved):
        return None
    back = _dt.timedelta(days=need.days_back)
    out = {as_of - back, previous - back} if moved and previous else set()
    for table in need.dated:
        for date in changed.get(table, ()):
            if date == WHOLE:
                return None
            out.add(as_of - back if date == UNDATED else _dt.date.fromisoformat(date))
    return out


def restricted(name: str, t: BalanceTables, dates: set[_dt.date], as_of: _dt.date) -> BalanceTables:
    """The inputs that dates ``dates`` of report ``name`` are made of: partitions of other dates are not read."""
    need = DEPENDS[name]
    fallback = as_of - _dt.timedelta(days=need.days_back)

    def keep(df: DataFrame, column: str) -> DataFrame:
        wanted = F.col(column).isin(*dates)
        return df.where(wanted | F.col(column).isNull() if fallback in dates else wanted)

    return t.with_(**{table: keep(getattr(t, table), DATES[table]) for table in need.dated})


def run_changed(spark: SparkSession, root: str, output: str, names: list[str] | None = None,
                as_of: _dt.date | None = None) -> dict[str, set[_dt.date] | None]:
    """Bring the published reports up to date with the inputs under ``root``; returns what was computed (None: all dates)."""
    as_of = as_of or today(spark)
    names = names or ALL_REPORTS
    last = publication.manifest(spark, output)[1].get(STATE, {})
    before = spark.read.parquet(last["path"]) if last else None
    previous = _dt.date.fromisoformat(last["as_of"]) if last else None
    tables, folder = read_parquet_tables(spark, root), publication.new_run(output)
    input_state(spark, root).write.parquet(f"{folder}/{STATE}")  # before the reports: later changes count as changes
    changed = changes(before, spark.read.parquet(f"{folder}/{STATE}"))
    known = set(publication.manifest(spark, output)[1])
    todo = {n: affected(n, changed, as_of, previous) if n in known else None for n in names}
    todo = {n: dates for n, dates in todo.items() if dates is None or dates}
    for name, dates in todo.items():
        if dates is None:
            write(name, tables, as_of, f"{folder}/{name}")
        else:
            report = build_report(name, restricted(name, tables, dates, as_of), as_of)
            write_report(report.where(F.col(DATE_COLUMN).isin(*dates)), f"{folder}/{name}")
    publication.commit(spark, output, {n: f"{folder}/{n}" for n in todo}, replaced=todo,
                       notes={STATE: {"path": f"{folder}/{STATE}", "as_of": as_of.isoformat()}})
    return todo
