"""Benchmark the balance reports.

Runs every report at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line.

The six report inputs are first derived from the TPC-H-style tables and
written once as Parquet, two files per core (time reported as
``fixtures_sec``), as a production deployment would read stored multi-file
tables.  Each report is then executed in full
through the ``noop`` sink (every row computed, nothing collected to Python);
one warm-up pass, then the median of ``$BENCH_RUNS`` (default 3) timed runs
of build + execute.  ``value`` is the sum of the per-report medians;
``build_sec`` shows the driver-side construction share of each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans import reports as R  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.fixtures import FIXTURE_AS_OF, derive_tables  # noqa: E402
from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables  # noqa: E402

AS_OF = FIXTURE_AS_OF


def report_plans():
    plans = {}
    for cad in R.CADENCES:
        plans[f"client_{cad}"] = lambda t, c=cad: R.client_report(t, c, AS_OF)
        plans[f"plan_{cad}"] = lambda t, c=cad: R.plan_report(t, c, AS_OF)
        plans[f"participant_{cad}"] = lambda t, c=cad: R.participant_report(t, c, AS_OF)
        plans[f"participant_{cad}_status"] = lambda t, c=cad: R.participant_status_report(t, c, AS_OF)
    plans["plan_quarterly_count"] = lambda t: R.plan_quarterly_count(t, AS_OF)
    plans["div_sub_daily"] = lambda t: R.div_sub_report(t, AS_OF, sort=False)
    plans["div_sub_daily_sorted"] = lambda t: R.div_sub_report(t, AS_OF, sort=True)
    return plans


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="ledgerline-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), driver_memory="16g")

    t0 = time.perf_counter()
    derived = derive_tables(spark, sf_dir)
    # Stored like a multi-file table (two files per core) so scans run in
    # parallel; one file with one row group would make every scan one task.
    for field, name in TABLE_NAMES.items():
        getattr(derived, field).repartition(2 * cpus).write.mode("overwrite").parquet(f"{scratch}/{name}")
    fixtures_sec = time.perf_counter() - t0
    tables = read_parquet_tables(spark, scratch)

    timings: dict[str, float] = {}
    builds: dict[str, float] = {}
    for name, build in report_plans().items():
        build(tables).write.format("noop").mode("overwrite").save()  # warm-up
        samples, build_samples = [], []
        for _ in range(runs):
            t = time.perf_counter()
            df = build(tables)
            built = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
            build_samples.append(built - t)
        timings[name] = round(statistics.median(samples), 3)
        builds[name] = round(statistics.median(build_samples), 3)
    spark.stop()

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "balance_reports_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "fixtures_sec": round(fixtures_sec, 3),
        # Part of each query's time spent building the DataFrame on the driver (py4j calls, analysis).
        "build_sec": builds,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
