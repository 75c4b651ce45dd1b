"""The batch runner writes reports by date, each from its own run's inputs."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans import reports as R
from ledgerline.plans.runner import run
from tests.helpers import AS_OF, multiset


def test_runner_writes_reports(spark, fixture_tables, tmp_path):
    out = run(spark, fixture_tables, str(tmp_path), ["client_monthly", "participant_monthly_status"], AS_OF)
    assert set(out) == {"client_monthly", "participant_monthly_status"}
    got = spark.read.parquet(out["participant_monthly_status"]).select(*R.PARTICIPANT_PERIOD_COLUMNS)
    want = R.participant_status_report(fixture_tables, "monthly", AS_OF)
    assert multiset(got.collect()) == multiset(want.collect())
    got = spark.read.parquet(out["client_monthly"]).select(*R.CLIENT_COLUMNS)
    assert multiset(got.collect()) == multiset(R.client_report(fixture_tables, "monthly", AS_OF).collect())


def test_build_report_and_sql_views(spark, fixture_tables):
    from ledgerline.plans.runner import ALL_REPORTS, build_report, register_report_views
    assert len(ALL_REPORTS) == 15
    names = register_report_views(spark, fixture_tables, AS_OF, ["plan_monthly", "participant_daily_status"],
                                  prefix="t_")
    assert names == ["t_plan_monthly", "t_participant_daily_status"]
    got = spark.sql("SELECT count(*) AS n FROM t_plan_monthly").collect()[0].n
    assert got == build_report("plan_monthly", fixture_tables, AS_OF).count()
    want = R.participant_status_report(fixture_tables, "daily", AS_OF)
    assert multiset(spark.table("t_participant_daily_status").collect()) == multiset(want.collect())


def test_size_for_input(spark):
    from ledgerline.session import MB, size_for_input, stored_bytes
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        assert size_for_input(spark, 10 * MB) == 200                      # floor
        assert size_for_input(spark, 100 * 1024 ** 4) == 100_000          # 100 TB: capped
        assert size_for_input(spark, 1024 ** 4) == 1024                    # 1 TB -> 256 GB of partials / 256 MB
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1024"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert stored_bytes(spark, "/root/testdata/sf0.001/nation.parquet") > 0


def test_runner_cli_end_to_end(spark, fixture_tables, tmp_path, capsys):
    from ledgerline.plans.runner import main
    from ledgerline.sources.tables import TABLE_NAMES
    inp, out = tmp_path / "in", tmp_path / "out"
    for field, name in TABLE_NAMES.items():
        getattr(fixture_tables, field).write.parquet(str(inp / name))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        main(["--input", str(inp), "--output", str(out), "--as-of", AS_OF.isoformat(),
              "--reports", "client_quarterly,participant_quarterly_status"])
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    printed = capsys.readouterr().out.split()
    assert "client_quarterly" in printed and "participant_quarterly_status" in printed
    got = spark.read.parquet(str(out / "client_quarterly")).select(*R.CLIENT_COLUMNS)
    assert multiset(got.collect()) == multiset(R.client_report(fixture_tables, "quarterly", AS_OF).collect())


def test_report_output_columns_are_the_documented_api(fixture_tables):
    t = fixture_tables
    expected = {
        "client_daily": R.CLIENT_COLUMNS, "client_monthly": R.CLIENT_COLUMNS, "client_quarterly": R.CLIENT_COLUMNS,
        "plan_daily": R.PLAN_DAILY_COLUMNS, "plan_monthly": R.plan_period_columns("monthly"),
        "plan_quarterly": R.plan_period_columns("quarterly"), "div_sub_daily": R.DIV_SUB_COLUMNS,
        "div_sub_daily_sorted": R.DIV_SUB_COLUMNS,
        "participant_daily": R.PARTICIPANT_DAILY_COLUMNS, "participant_monthly": R.PARTICIPANT_PERIOD_COLUMNS,
        "participant_quarterly": R.PARTICIPANT_PERIOD_COLUMNS,
        "participant_daily_status": R.PARTICIPANT_DAILY_COLUMNS,
        "participant_monthly_status": R.PARTICIPANT_PERIOD_COLUMNS,
        "participant_quarterly_status": R.PARTICIPANT_PERIOD_COLUMNS,
        "plan_quarterly_count": ["row_count"],
    }
    from ledgerline.plans.runner import ALL_REPORTS, build_report
    assert set(expected) == set(ALL_REPORTS)
    for name, cols in expected.items():
        assert build_report(name, t, AS_OF).columns == cols, name


def _one_day(t, day):
    from pyspark.sql import functions as F
    return t.with_(core_daily=t.core_daily.withColumn("source_cycle_date", F.lit(day)))


def test_a_later_run_leaves_earlier_dates_alone(spark, fixture_tables, tmp_path):
    from pyspark.sql import functions as F
    from ledgerline.plans.runner import build_report
    names = ["participant_daily_status", "div_sub_daily"]
    d1, d2 = dt.date(2001, 7, 30), dt.date(2001, 7, 31)
    first, second = _one_day(fixture_tables, d1), _one_day(fixture_tables, d2)
    # On the second day every participant has two rows, so its status report has more rows.
    second = second.with_(participant=second.participant.unionByName(second.participant))
    out = run(spark, first, str(tmp_path), names, d2)
    dated = lambda name, day: spark.read.parquet(out[name]).where(F.col("source_cycle_date") == F.lit(day))
    before = {n: multiset(dated(n, d1).collect()) for n in names}
    run(spark, second, str(tmp_path), names, d2 + dt.timedelta(days=1))
    for n in names:
        assert before[n] and multiset(dated(n, d1).collect()) == before[n], n
        want = build_report(n, second, d2 + dt.timedelta(days=1)).where(F.col("source_cycle_date") == F.lit(d2))
        got = dated(n, d2).select(*want.columns)
        assert multiset(got.collect()) == multiset(want.collect()), n


def test_sink_files_are_bounded_by_dates_and_large_dates_are_split(spark, tmp_path):
    from pyspark.sql import functions as F
    from ledgerline.sources.sinks import write_report
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 40_000, 0).otherwise(F.col("id") % 30).cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    rows = rows.select(F.date_add(F.lit(dt.date(2001, 1, 1)), F.col("k")).alias("source_cycle_date"), "v").repartition(16)
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    keep = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        write_report(rows, str(tmp_path / "r"), order=("v",))
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "r").iterdir() if d.is_dir()}
    assert len(files) == 30
    assert files.pop("source_cycle_date=2001-01-01") > 1          # the large date is split
    assert sum(files.values()) <= 2 * len(files)                  # the others are in a file or two
    assert multiset(spark.read.parquet(str(tmp_path / "r")).select(*rows.columns).collect()) == multiset(rows.collect())


def test_runner_reads_a_catalog_database_like_parquet(spark, fixture_tables, tmp_path):
    from ledgerline.plans.runner import main
    from ledgerline.sources.tables import TABLE_NAMES, read_catalog_tables
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.sql(f"CREATE DATABASE balances_db LOCATION '{tmp_path / 'db'}'")
    try:
        for field, name in TABLE_NAMES.items():
            getattr(fixture_tables, field).write.parquet(str(tmp_path / "in" / name))
            spark.read.parquet(str(tmp_path / "in" / name)).write.saveAsTable(f"balances_db.{name}")
        reports = "plan_quarterly_count,participant_monthly_status"
        main(["--database", "balances_db", "--output", str(tmp_path / "a"), "--as-of", AS_OF.isoformat(), "--reports", reports])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"     # sized from the stored tables: the floor
        main(["--input", str(tmp_path / "in"), "--output", str(tmp_path / "b"), "--as-of", AS_OF.isoformat(), "--reports", reports])
        for name in reports.split(","):
            a, b = (spark.read.parquet(str(tmp_path / x / name)) for x in "ab")
            assert a.count() and multiset(a.select(*b.columns).collect()) == multiset(b.collect())
        spark.sql("USE balances_db")
        assert read_catalog_tables(spark).client.count() == fixture_tables.client.count()
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE balances_db CASCADE")
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_ordered_report_is_in_order_across_its_files(spark, fixture_tables, tmp_path):
    # Several files a date; by name they give plan DESC, div_sub DESC, and their key ranges follow each other.
    import glob
    import pyarrow.parquet as pq
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        path = run(spark, fixture_tables, str(tmp_path), ["div_sub_daily_sorted"], AS_OF)["div_sub_daily_sorted"]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    ranges = {r["file"].rsplit("/", 1)[1] + str(r["source_cycle_date"]): r for r in spark.read.parquet(f"{path}/_key_ranges").collect()}
    n, several = 0, 0
    for folder in glob.glob(f"{path}/source_cycle_date=*"):
        files, keys = sorted(glob.glob(f"{folder}/*.parquet")), []
        for f in files:
            rows = pq.read_table(f, columns=["plan_number", "div_sub_id"]).to_pylist()
            here = [(r["plan_number"], r["div_sub_id"]) for r in rows]
            r = ranges[f.rsplit("/", 1)[1] + folder.rsplit("=", 1)[1]]
            assert (tuple(r["first"]), tuple(r["last"]), r["rows"]) == (here[0], here[-1], len(here))
            keys += here
        assert keys == sorted(keys, reverse=True)
        n, several = n + len(keys), several + (len(files) > 1)
    assert several and n == R.div_sub_report(fixture_tables, AS_OF, sort=False).count()
    got = spark.read.parquet(path).select(*R.DIV_SUB_COLUMNS)
    assert multiset(got.collect()) == multiset(R.div_sub_report(fixture_tables, AS_OF, sort=False).collect())


def test_a_run_is_published_whole_or_not_at_all(spark, fixture_tables, tmp_path, monkeypatch):
    import pytest
    from ledgerline.plans import publication as P
    from ledgerline.plans import runner
    names, out = ["client_monthly", "plan_quarterly_count"], str(tmp_path)
    run(spark, fixture_tables, out, names, AS_OF, publish=True)
    first = {n: multiset(P.read_report(spark, out, n).collect()) for n in names}
    assert multiset(P.read_report(spark, out, "client_monthly").select(*R.CLIENT_COLUMNS).collect()) == \
        multiset(R.client_report(fixture_tables, "monthly", AS_OF).collect())
    # The next run has one month only, and fails between its two reports: readers still see the run before.
    month = F.col("source_cycle_date") == F.lit(dt.date(1998, 3, 31))
    less = fixture_tables.with_(core_monthly=fixture_tables.core_monthly.where(month).withColumn("cash_value_amount", F.col("cash_value_amount") * 0 + 1),
                                loan=fixture_tables.loan.where(month))
    write, done = runner.write, []

    def failing(name, *args):
        if done:
            raise RuntimeError("lost")
        write(name, *args)
        done.append(name)

    monkeypatch.setattr(runner, "write", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, less, out, names, AS_OF, publish=True)
    monkeypatch.undo()
    assert done == ["client_monthly"]
    assert {n: multiset(P.read_report(spark, out, n).collect()) for n in names} == first
    # Run again: its date is replaced in all reports at once, the other dates stay.
    run(spark, less, out, names, AS_OF, publish=True)
    assert P.manifest(spark, out)[0] == 2
    new, old = P.read_report(spark, out, "client_monthly"), spark.read.parquet(P.manifest(spark, out)[1]["client_monthly"]["source_cycle_date=1998-02-28"])
    want = multiset(R.client_report(less, "monthly", AS_OF).collect())
    assert multiset(new.where(month).select(*R.CLIENT_COLUMNS).collect()) == want
    february = F.col("source_cycle_date") == F.lit(dt.date(1998, 2, 28))
    assert new.where(february).count() == old.where(february).count() > 0


def test_two_writers_publish_one_after_the_other(spark, tmp_path):
    from ledgerline.plans import publication as P
    for n, report in enumerate(("a", "b", "a"), 1):
        path = f"{P.new_run(str(tmp_path))}/{report}"
        spark.range(n).write.parquet(path)
        assert P.commit(spark, str(tmp_path), {report: path}) == n
    assert P.read_report(spark, str(tmp_path), "a").count() == 3 and P.read_report(spark, str(tmp_path), "b").count() == 2
