"""Stored bit maps give the distinct counts of the two-step form, and are built once a date."""

import glob
import os

from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import counts as K
from ledgerline.plans import reports as R
from tests.helpers import AS_OF, multiset

GRAINS = (["plan_number"], ["plan_number", "client_id", "source_cycle_date"],
          ["plan_number", "client_id", ("div_sub_id", C.blank_to_sentinel)], ["client_id"])


def keys_of(grain):
    return [k if isinstance(k, str) else (k[0], k[1](k[0])) for k in grain]


def test_maps_equal_the_two_step_counts_and_are_reused(spark, fixture_tables, tmp_path):
    p = fixture_tables.participant
    # Rows without an id, in a plan of their own too, and ids that appear on several dates and in several plans.
    p = p.unionByName(p.limit(40).withColumn("participant_id", F.lit(None).cast("string")).withColumn(
        "plan_number", F.when(F.col("client_id") > "C10", F.lit("only null ids")).otherwise(F.col("plan_number"))))
    p = p.unionByName(p.limit(60).withColumn("plan_number", F.lit("second plan")).withColumn("source_cycle_date", F.lit("1999-01-31").cast("date")))
    p = p.unionByName(p.limit(20).withColumn("source_cycle_date", F.lit(None).cast("date")))
    p.write.parquet(str(tmp_path / "p"))
    p = spark.read.parquet(str(tmp_path / "p"))
    days = sorted(r[0].isoformat() for r in p.select("source_cycle_date").distinct().collect() if r[0])
    maps = K.CountMaps(spark, str(tmp_path / "maps"))
    early = p.where(F.col("source_cycle_date").cast("string") < days[len(days) // 2])
    assert maps.refresh(early) == set(days[:len(days) // 2])
    for grain in GRAINS:
        assert multiset(maps.counts(keys_of(grain)).collect()) == multiset(K.participant_counts(early, keys_of(grain)).collect()), grain
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/maps/maps/day=*/*.parquet")}
    # The other dates, and undated rows: earlier maps and numbers stay as they are.
    assert maps.refresh(p) == set(days[len(days) // 2:]) | {maps.UNDATED} and maps.refresh(p) == set()
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    numbers = [r.number for r in spark.read.parquet(str(tmp_path / "maps" / "numbers")).collect()]
    assert sorted(numbers) == list(range(p.select("participant_id").where("participant_id is not null").distinct().count()))
    for grain in GRAINS:
        assert multiset(maps.counts(keys_of(grain)).collect()) == multiset(K.participant_counts(p, keys_of(grain)).collect()), grain
    # In the reports.
    t = fixture_tables.with_(participant=p)
    for build in (lambda m: R.plan_report(t, "daily", AS_OF, count_method=m), lambda m: R.plan_report(t, "quarterly", AS_OF, count_method=m),
                  lambda m: R.div_sub_report(t, AS_OF, sort=False, count_method=m)):
        assert multiset(build(maps).collect()) == multiset(build("two_step").collect())
