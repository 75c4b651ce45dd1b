"""How many parts the rows of a join key are dealt to, measured from the data.

``hot_parts`` summarises the keys of some rows with bounded counters: Spark's
``approx_top_k`` keeps ``TRACKED`` counters a map task, and the summaries merge,
so what meets in the end is a few KB a map task.  The result is a scalar subquery, a
map from key hash to a number of parts: as many as the key's share of all rows
fills shuffle partitions.  Keys below one partition's share are not in it and
stay in one part, so only lookups of hot keys are repeated, each as often as
its key is split.  A key is counted wrongly by no more than about one part in ``TRACKED``
of the rows; adaptive execution may split the partitions of keys below that.  Two
keys with one hash share a number of parts, which changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Counters a summary holds.
TRACKED = 256


def key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*keys)


def hot_parts(rows: DataFrame, keys: Sequence[Column], partitions: int | None = None) -> Column:
    """Map of key hash -> parts (above 1) as a scalar subquery over ``rows``.

    ``partitions`` (default: the session's shuffle partitions) is the number of
    parts that all rows together would be dealt to.
    """
    if partitions is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counters = rows.select(key_hash(keys).alias("k")).agg(
        F.expr(f"approx_top_k(k, {TRACKED}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    parts = lambda x: F.ceil(x["count"] * partitions / F.col("n")).cast("int")
    hot = F.filter("top", lambda x: x["count"] * partitions > F.col("n"))
    return counters.select(F.map_from_entries(F.transform(hot, lambda x: F.struct(x["item"], parts(x)))).alias("hot")).scalar()


def parts_of(hot: Column, keys: Sequence[Column]) -> Column:
    """Number of parts of the key (1 unless it is hot)."""
    return F.coalesce(F.try_element_at(hot, key_hash(keys)), F.lit(1))


def part_of(hot: Column, keys: Sequence[Column], spread: Sequence[Column]) -> Column:
    """The part of a row: drawn from ``spread``, columns that differ inside a key."""
    return F.pmod(F.xxhash64(*spread), parts_of(hot, keys)).cast("int")


def all_parts(hot: Column, keys: Sequence[Column]) -> Column:
    """Every part of the key, to repeat a lookup's row for."""
    return F.sequence(F.lit(0), parts_of(hot, keys) - 1)
