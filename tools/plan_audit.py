"""Print a markdown table of each report's physical plan shape.

Usage: python tools/plan_audit.py [sf_dir]

Counts hash / range / single-partition exchanges, sort-merge and broadcast
joins, hash aggregates and Expand nodes in the executed plan, with static
broadcasting switched off so plans look as they would on large inputs.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.runner import ALL_REPORTS, build_report  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.fixtures import FIXTURE_AS_OF, derive_tables  # noqa: E402
from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables  # noqa: E402

PATTERNS = {
    "hash exchanges": r"Exchange hashpartitioning",
    "range/single exchanges": r"Exchange (rangepartitioning|SinglePartition)",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "hash aggregates": r"HashAggregate",
    "Expand": r"Expand",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = derive_tables(spark, sf_dir)
    # Count only the report's own operators: read the inputs as stored tables.
    root = tempfile.mkdtemp(prefix="ledgerline-audit-")
    for field, name in TABLE_NAMES.items():
        getattr(t, field).write.mode("overwrite").parquet(f"{root}/{name}")
    t = read_parquet_tables(spark, root)
    print("| report | " + " | ".join(PATTERNS) + " |")
    print("|---|" + "---|" * len(PATTERNS))
    for name in ALL_REPORTS:
        plan = build_report(name, t, FIXTURE_AS_OF)._jdf.queryExecution().executedPlan().toString()
        print(f"| {name} | " + " | ".join(str(len(re.findall(p, plan))) for p in PATTERNS.values()) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
