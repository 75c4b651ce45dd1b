"""Conditional distinct participant counts (allocated, active, all).

``count(DISTINCT CASE ...)`` three times over different expressions makes
Spark plan an Expand that triples every row before two aggregations.  The
default here is the equivalent two-step group: first one row per
(keys, participant_id) carrying "any row allocated / active" flags, then sums
of those flags and a count of non-NULL ids.  Both steps get map-side partial
aggregation, and the first exchange is keyed by participant id, so a plan
holding a third of all participants still spreads over every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .sums import Key, key_columns, key_names

COUNT_COLUMNS = ("allocated_participant_count", "active_participant_count", "participant_count")


def participant_counts(participant: DataFrame, keys: Sequence[Key], method: str | CountMaps = "two_step") -> DataFrame:
    """Distinct allocated / active / all participant ids per ``keys`` (BIGINT); from stored maps if given some."""
    if isinstance(method, CountMaps):
        return method.counts(keys)
    rows = participant.select(*key_columns(keys), "participant_id",
                              C.allocated_flag().alias("_alloc"), C.active_flag().alias("_active"))
    names = key_names(keys)
    if method == "distinct":
        pid = F.col("participant_id")
        return rows.groupBy(*names).agg(
            F.countDistinct(F.when(F.col("_alloc"), pid)).alias(COUNT_COLUMNS[0]),
            F.countDistinct(F.when(F.col("_active"), pid)).alias(COUNT_COLUMNS[1]),
            F.countDistinct(pid).alias(COUNT_COLUMNS[2]))
    if method != "two_step":
        raise ValueError(f"unknown count method {method!r}")
    flag = lambda c: F.max(F.when(F.col(c), F.lit(1)).otherwise(F.lit(0)))
    per_id = rows.groupBy(*names, "participant_id").agg(flag("_alloc").alias("_a"), flag("_active").alias("_b"))
    known = F.col("participant_id").isNotNull()
    return per_id.groupBy(*names).agg(
        F.sum(F.when(known, F.col("_a")).otherwise(F.lit(0))).alias(COUNT_COLUMNS[0]),
        F.sum(F.when(known, F.col("_b")).otherwise(F.lit(0))).alias(COUNT_COLUMNS[1]),
        F.count("participant_id").alias(COUNT_COLUMNS[2]))


class CountMaps:
    """Exact distinct counts from stored bit maps, which unite over dates, clients and divisions.

    Every participant id has a number, kept in ``<path>/numbers``: ids are
    numbered in the order of their plan, so the participants of a plan are
    neighbours and its bits lie in few maps.  For every (plan, client,
    division, date) and 32,768 numbers, one 4 KB map a count is built by aggregation
    (``bitmap_construct_agg``) and stored by date.  A count at any grain above
    is the union of maps (``bitmap_or_agg``, with partial aggregation) and its bits.  So a
    new date shuffles its own participants once, and the dates before are
    read as maps: ids are not shuffled again.
    """

    GRAIN = ("plan_number", "client_id", "div_sub_id", "source_cycle_date")
    DATE = "source_cycle_date"
    UNDATED = "undated"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def _stored(self, name: str) -> DataFrame | None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return self.spark.read.parquet(f"{self.path}/{name}") if fs.exists(at) else None

    def dates(self) -> set[str]:
        maps = self._stored("maps")
        return set() if maps is None else {r[0] for r in maps.select(F.col("day").cast("string")).distinct().collect()}

    def _number(self, rows: DataFrame) -> None:
        """Number the ids that have none: places in a range sort by plan and id, behind the largest number so far."""
        ids = rows.where(F.col("participant_id").isNotNull()).groupBy("participant_id").agg(F.min("plan_number").alias("plan_number"))
        known, start = self._stored("numbers"), 0
        if known is not None:
            ids = ids.join(known, "participant_id", "left_anti")
            start = known.agg(F.max("number")).first()[0] + 1
        ranged = ids.repartitionByRange("plan_number", "participant_id").sortWithinPartitions("plan_number", "participant_id")
        scratch = f"{self.path}/numbering/{start}"
        ranged.select("participant_id", F.monotonically_increasing_id().alias("at")).write.mode("overwrite").parquet(scratch)
        ranged = self.spark.read.parquet(scratch).withColumn("range", F.shiftright("at", 33))
        sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = sizes.select("range", (before - F.col("first") + start).alias("shift"))     # one row a range
        numbered = ranged.join(offsets, "range").select("participant_id", (F.col("at") + F.col("shift")).alias("number"))
        numbered.write.mode("append").parquet(f"{self.path}/numbers")

    def refresh(self, participant: DataFrame, dates: set[str] | None = None) -> set[str]:
        """Build the maps of ``dates`` (ISO, or ``UNDATED``; default: those not stored yet); returns them."""
        day = F.coalesce(F.col(self.DATE).cast("string"), F.lit(self.UNDATED))
        if dates is None:
            dates = {r[0] for r in participant.select(day).distinct().collect()} - self.dates()
        if not dates:
            return set()
        rows = participant.where(day.isin(*dates))
        self._number(rows)
        flags = rows.select(*self.GRAIN, "participant_id", C.allocated_flag().alias("_a"), C.active_flag().alias("_b"))
        numbered = flags.join(self._stored("numbers"), "participant_id", "left")
        # Rows without an id have no bit, but their key is counted (as 0).
        place, always = F.bitmap_bit_position("number"), F.col("number").isNotNull()
        maps = numbered.groupBy(*self.GRAIN, F.bitmap_bucket_number("number").alias("bucket")).agg(
            *[F.bitmap_construct_agg(F.when(cond & always, place)).alias(name)
              for name, cond in zip(COUNT_COLUMNS, (F.col("_a"), F.col("_b"), F.lit(True)))])
        maps = maps.withColumn("day", day).hint("rebalance", F.col("day"))
        maps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.path}/maps")
        return dates

    def counts(self, keys: Sequence[Key]) -> DataFrame:
        """The three counts per ``keys``: names of ``GRAIN`` or (name, expression over them)."""
        maps, names = self._stored("maps"), key_names(keys)
        united = maps.groupBy(*key_columns(keys), "bucket").agg(*[F.bitmap_or_agg(c).alias(c) for c in COUNT_COLUMNS])
        return united.groupBy(*names).agg(*[F.sum(F.bitmap_count(c)).alias(c) for c in COUNT_COLUMNS])
