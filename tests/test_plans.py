"""Plan guards: the scale properties the reports are designed around."""

import pytest

from pyspark.sql import functions as F

from ledgerline.operators import joins as J
from ledgerline.operators import sums as S
from ledgerline.plans.runner import report_builders
from ledgerline.plans import reports as R
from tests.helpers import AS_OF

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "Expand"]


def _plans(spark, t):
    builders = report_builders(AS_OF)
    for c in R.CADENCES:
        builders[f"participant_{c}_status"] = lambda t, c=c: R.participant_status_report(t, c, AS_OF)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # plans as they look on big inputs
    try:
        return {n: b(t)._jdf.queryExecution().executedPlan().toString() for n, b in builders.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def plans(spark, fixture_tables):
    return _plans(spark, fixture_tables)


def test_no_cartesian_udf_or_expand(plans):
    for name, plan in plans.items():
        for op in FORBIDDEN:
            assert op not in plan, f"{name} plans {op}"


def test_every_sum_is_partially_aggregated(plans):
    for name, plan in plans.items():
        assert plan.count("partial_sum") >= 1 or "sum" not in plan, name


def test_no_static_broadcasts(plans):
    # Broadcasts are adaptive execution's choice alone, from measured sizes.
    for name, plan in plans.items():
        assert "BroadcastHashJoin" not in plan, name


def test_sorted_div_sub_moves_rows_before_the_fan_out_only(plans):
    plan = plans["div_sub_daily_sorted"]
    lines = plan.splitlines()
    ranges = [i for i, x in enumerate(lines) if "rangepartitioning" in x and "Exchange" in x]
    unfolds = [i for i, x in enumerate(lines) if "Generate explode(_list" in x]
    assert len(ranges) == 1 and len(unfolds) == 2
    assert max(unfolds) < ranges[0]            # printed from the top: the lists unfold above the range exchange
    # Each lookup is computed once: one collected list a lookup, final and partial.
    assert plan.count("collect_list") == plans["div_sub_daily"].count("collect_list")
    assert plan.count("valuation_date") and "FullOuter" not in plan


def test_core_and_loan_merge_in_one_exchange(spark, fixture_tables, tmp_path):
    # On plain Parquet: one hash exchange, by sentinel key alone, with partial sums in front of it, and no join.
    from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
    for field, name in TABLE_NAMES.items():
        getattr(fixture_tables, field).write.parquet(str(tmp_path / name))
    t = read_parquet_tables(spark, str(tmp_path))
    keys = {R.participant_core_loan: 3, R.plan_core_loan: 2, R.client_core_loan: 1}
    for build, n in keys.items():
        for cad in R.CADENCES:
            plan = build(t, cad, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            at = [i for i, x in enumerate(lines) if "Exchange " in x]
            assert len(at) == 1 and "Join" not in plan, (build.__name__, cad)
            assert "hashpartitioning(_j_" in lines[at[0]]
            assert "partial_sum" in lines[at[0] + 1] and "partial_sum" not in "".join(lines[:at[0]])


def test_merge_keeps_the_raw_keys_of_one_sentinel_key_apart(spark):
    # Every NULL / literal pattern of two keys and of the date, several rows each, both sides, all date modes.
    import datetime as dt
    import itertools
    from decimal import Decimal
    from tests.helpers import multiset
    day, other = dt.date(2001, 7, 31), dt.date(2001, 6, 30)
    values = list(itertools.product([None, "-9999", "a"], [None, "-9999"], [None, day, other]))
    core = [(a, b, d, Decimal(i + r)) for i, (a, b, d) in enumerate(values) for r in (0, 100)]
    loan = [(a, b, d, Decimal(i + r)) for i, (a, b, d) in enumerate(values) if i % 3 for r in (1000, 2000)] + [("z", None, None, Decimal(7))]
    kinds = "a string, b string, source_cycle_date date, {} decimal(17,2)"
    c, x = spark.createDataFrame(core, kinds.format("core")), spark.createDataFrame(loan, kinds.format("loan"))
    s = lambda v: "-9999" if v is None else v

    def want(mode):
        def total(rows, dated):
            out = {}
            for *k, v in rows:
                k = tuple(k) if dated else (*k[:2], None)
                out[k] = out.get(k, 0) + v
            return out

        cs, ls, rows, met = total(core, True), total(loan, mode != "none"), [], set()
        for (a, b, d), v in cs.items():
            dates = {"none": lambda e: True, "defaulted": lambda e, d=d: (d or day) == (e or day), "strict": lambda e, d=d: d is not None and d == e}
            pairs = [(k, w) for k, w in ls.items() if (s(a), s(b)) == (s(k[0]), s(k[1])) and dates[mode](k[2])]
            met |= {k for k, _ in pairs}
            for k, w in pairs or [((None, None, None), None)]:
                rows.append((a if a is not None else k[0], b if b is not None else k[1], d if d is not None or mode == "none" else k[2], v, w))
        return rows + [(*k, None, w) for k, w in ls.items() if k not in met]

    for mode in ("none", "defaulted", "strict"):
        rows = J.full_outer_merge(c, x.drop("source_cycle_date") if mode == "none" else x, ["a", "b"], mode, F.lit(day)).collect()
        assert multiset(rows) == multiset(want(mode)), mode


def test_parts_of_a_key_follow_its_share(spark):
    # Nine rows in ten have one key; with adaptive execution off, nobody else splits it.
    from ledgerline.operators import heat
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1999)).alias("k"), "id")
    lookup = rows.select("k").distinct().select("k", F.length("k").alias("v"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, ("false", "-1", "40")):
            spark.conf.set(k, v)
        hot = heat.hot_parts(rows.repartition(7), [F.col("k")])
        key = [F.col("k")]
        parts = {r["k"]: r["p"] for r in lookup.select("k", heat.parts_of(hot, key).alias("p")).collect()}
        assert parts.pop("hot") == 36 and set(parts.values()) == {1}
        # The lookup's copies: one a cold key, one a part of the hot one.
        copies = lookup.select("k", F.explode(heat.all_parts(hot, key)).alias("part"))
        assert copies.count() == len(parts) + 36
        out = J.left_join_on(rows, lookup, key, key, ["v"], hot=hot, spread=[F.col("id")])
        assert out.where("v = length(k)").count() == 20_000
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) < 20_000 / 6 and len(tasks) > 20
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_hot_plan_is_dealt_to_several_tasks(spark, fixture_tables):
    # Nine rows in ten belong to one plan; the plan reports' lookups are joined by part, equal to plain joins.
    from tests.helpers import multiset
    t = fixture_tables
    hot = lambda df: df.withColumn("plan_number", F.when(F.rand(3) < 0.9, F.lit("P01")).otherwise(F.col("plan_number")))
    tables = t.with_(core_daily=hot(t.core_daily), core_monthly=hot(t.core_monthly), loan=hot(t.loan))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from ledgerline.operators import heat
        parts = tables.core_daily.limit(1).select(heat.parts_of(R._hot_plans(tables), [F.lit("P01")])).first()[0]
        assert parts >= 0.85 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        life = S.life_sums(tables.life, ["plan_number", "valuation_date"])
        plain = J.left_join_on(R.plan_core_loan(tables, "daily", AS_OF), life, J.sentinel_keys("plan_number"),
                               J.sentinel_keys("plan_number"), ["life_cash_value_amount", "valuation_date"])
        dealt = R.plan_with_life(tables, "daily", AS_OF)
        assert "_part" in dealt._jdf.queryExecution().executedPlan().toString()
        assert multiset(dealt.collect()) == multiset(plain.collect())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_adaptive_execution_splits_a_hot_part_further(spark, fixture_tables):
    # The final plan of a skewed plan report shows the split (one join over two plain exchanges).
    t = fixture_tables
    hot = lambda df: df.withColumn("plan_number", F.when(F.rand(3) < 0.9, F.lit("P01")).otherwise(F.col("plan_number")))
    many = t.core_monthly.crossJoin(spark.range(6)).withColumn("client_id", F.concat("client_id", F.col("id").cast("string"))).drop("id")
    tables = t.with_(core_monthly=hot(many))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    keep = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = R.plan_enriched(tables, "monthly", AS_OF)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_division_filter_reaches_the_participant_scan(spark, tmp_path, fixture_tables):
    from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
    for field, name in TABLE_NAMES.items():
        getattr(fixture_tables, field).write.parquet(str(tmp_path / name))
    stored = read_parquet_tables(spark, str(tmp_path))
    plan = R.div_sub_report(stored, AS_OF, sort=False)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and "div_sub_id" in x]
    assert len(scans) >= 5          # core, loan and life lookups, counts, heat of the divisions
    for i in scans:
        assert any("Filter" in x and "div_sub_id" in x for x in lines[i - 3:i]), lines[i]


def test_quarter_reports_prune_date_partitions(spark, tmp_path, fixture_tables):
    from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
    from tests.helpers import multiset
    dates = {"core_daily": "source_cycle_date", "core_monthly": "source_cycle_date", "loan": "source_cycle_date", "life": "valuation_date"}
    for field, name in TABLE_NAMES.items():
        writer = getattr(fixture_tables, field).coalesce(1).write
        (writer.partitionBy(dates[field]) if field in dates else writer).parquet(str(tmp_path / name))
    stored = read_parquet_tables(spark, str(tmp_path))
    for build, inputs in ((R.participant_report, 3), (R.plan_report, 3), (R.client_report, 2)):
        plan = build(stored, "quarterly", AS_OF)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan" in x and any(f"{d}#" in x for d in ("source_cycle_date", "valuation_date"))]
        dated = [x for x in scans if "PartitionFilters: []" not in x and "PartitionFilters: [" in x]
        assert len(dated) >= inputs, build.__name__
        assert all("month(" in x for x in dated), build.__name__
    assert multiset(R.client_report(stored, "quarterly", AS_OF).collect()) == \
        multiset(R.client_report(fixture_tables, "quarterly", AS_OF).collect())


def test_scans_read_only_needed_columns(spark, fixture_tables):
    df = R.participant_report(fixture_tables, "monthly", AS_OF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "total_shares" not in text          # dead column never read
    assert "retirement_account_id" not in text
    df = R.client_report(fixture_tables, "monthly", AS_OF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "money_type_description" not in text and "fund_iv" not in text


def test_kept_participants_reach_the_balance_scans(spark, tmp_path, fixture_tables):
    # Spark's runtime Bloom filter sits at the core and loan scans, below the partial sums, and changes nothing.
    from ledgerline.sources.tables import TABLE_NAMES, read_parquet_tables
    from tests.helpers import multiset
    for field, name in TABLE_NAMES.items():
        getattr(fixture_tables, field).write.parquet(str(tmp_path / name))
    t = read_parquet_tables(spark, str(tmp_path))
    few = t.with_(participant=t.participant.where(F.col("div_sub_id") == "D1"))
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    keep = {k: spark.conf.get(k) for k in settings}
    want = multiset(R.div_sub_report(few, AS_OF, sort=False).collect())
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        report = R.div_sub_report(few, AS_OF, sort=False)
        assert multiset(report.collect()) == want
        for rows, name in ((R.core_div_sub_rows(few, usable=True), "participant_core_balance"), (R.loan_div_sub_rows(few, usable=True), "participant_loan")):
            lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
            probes = [i for i, x in enumerate(lines) if "might_contain" in x]
            sums = [i for i, x in enumerate(lines) if "partial_sum" in x]
            assert probes and sums and min(sums) < min(probes), name    # printed from the top: the filter is below
        before = few.core_daily.count()
        kept = few.core_daily.join(few.participant.select("participant_id").distinct(), "participant_id", "left_semi").count()
        assert kept < before / 2
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
