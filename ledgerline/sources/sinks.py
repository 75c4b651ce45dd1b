"""Report sinks.

Reports are DataFrames; callers may write them anywhere.  ``write_report``
is the default: Parquet, partitioned by the report's snapshot date so a
re-run for some dates overwrites only those partitions (dynamic partition
overwrite), and so later readers prune by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_COLUMN = "source_cycle_date"


# Folder of the key ranges of an ordered report's files (readers of the report skip names with an underscore).
RANGES = "_key_ranges"


def write_report(df: DataFrame, path: str, partition_by_date: bool = True, mode: str = "overwrite",
                 order: Sequence[str] = ()) -> None:
    """Write ``df`` under ``path``.

    Rows are rebalanced by date first: a date's rows meet in one task, so a
    task does not open a file for every date, and adaptive execution splits a
    large date over several tasks and joins small ones.  ``order`` (columns,
    descending) sorts the rows inside each file; ``write_ordered`` keeps an order across files.
    """
    writer_options = {"partitionOverwriteMode": "dynamic"}
    if partition_by_date and DATE_COLUMN in df.columns:
        df = df.hint("rebalance", F.col(DATE_COLUMN))
        df = df.sortWithinPartitions(F.col(DATE_COLUMN), *[F.desc(c) for c in order])
        df.write.mode(mode).options(**writer_options).partitionBy(DATE_COLUMN).parquet(path)
    else:
        df.write.mode(mode).options(**writer_options).parquet(path)


def write_ordered(df: DataFrame, path: str, order: Sequence[str], mode: str = "overwrite") -> None:
    """Write ``df``, range-partitioned by date and sorted by date and ``order`` (descending) already, in that order.

    Files are named by partition, and partitions are in the order of their
    ranges, so the files of a date read by name give ``order``; a task
    holds few dates.  The first and last key and the number of rows of every
    file are written beside them, for readers that look for one key or merge dates.
    """
    rows = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DATE_COLUMN)
    rows.parquet(path)
    spark, key = df.sparkSession, F.struct(*order)
    written = spark.read.parquet(path).groupBy(DATE_COLUMN, F.input_file_name().alias("file"))
    written = written.agg(F.max(key).alias("first"), F.min(key).alias("last"), F.count(F.lit(1)).alias("rows"))
    written.select("file", DATE_COLUMN, "first", "last", "rows").write.mode("overwrite").parquet(f"{path}/{RANGES}")
