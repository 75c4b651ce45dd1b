"""Spark session settings for the reports.

On a cluster the session normally exists already; ``configure`` only applies
the SQL settings the plans rely on.  ``build_session`` is for local runs and
tests.  For batch report jobs also set the static
``spark.python.sql.dataFrameDebugging.enabled=false`` in the job's Spark
configuration: it stops PySpark from capturing the Python call site of every
Column call, which roughly halves the time to build a report's plan.
"""

from __future__ import annotations

import datetime as _dt
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import TABLE_NAMES

# Settings the report plans are designed around.
SQL_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # sort-merge join partitions, and turn a join into a broadcast when the
    # measured (not estimated) size of a side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only from proven sizes: never from compile-time estimates,
    # only when AQE has measured a side's shuffle output (or an explicit,
    # row-count-checked hint in the plans).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # Reports that keep some participants meet balances behind their sums.  Spark's runtime Bloom filter
    # takes the kept keys to the balance scans, in front of the sums, where the balances are large
    # (10 GB, Spark's default) and the filtered participants at most this large.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(256 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(32 * 1024 * 1024),
    # ANSI stays on: a DECIMAL(13,2) overflow must fail loudly, not become NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


MB = 1024 * 1024


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 * MB,
                   shuffle_ratio: float = 0.25, min_partitions: int = 200,
                   max_partitions: int = 100_000) -> int:
    """Size shuffles and scan splits for ``input_bytes`` of stored input.

    The first exchange of every report carries partial aggregates of the
    balance rows, at most ``shuffle_ratio`` of the input in practice; the
    initial partition count gives each reducer about
    ``target_partition_bytes`` of it, so partitions fit in executor memory
    without spilling, and AQE then coalesces the later, smaller exchanges
    toward the same advisory size.  Returns the partition count set.
    """
    n = int(min(max_partitions, max(min_partitions, -(-int(input_bytes * shuffle_ratio) // target_partition_bytes))))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(target_partition_bytes, 512 * MB)))
    return n


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FileSystem metadata call)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def frames_bytes(spark: SparkSession, frames: list[DataFrame]) -> int:
    """Total size of the folders that hold the files behind ``frames`` (each folder once)."""
    jvm, total = spark.sparkContext._jvm, 0
    files = {f for frame in frames for f in frame.inputFiles()}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        total += int(path.getFileSystem(conf).getContentSummary(path).getLength())
    return total


def database_bytes(spark: SparkSession, database: str, tables) -> int:
    """Stored size of a database's input tables, without a list of their files.

    A table counts with its catalog statistics (``ANALYZE TABLE``) where it has them, else with
    what its location holds.  Only a view has neither and is sized by the files behind it.
    """
    total = 0
    for field, name in TABLE_NAMES.items():
        facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").collect()}
        if facts.get("Statistics"):
            total += int(facts["Statistics"].split(" bytes")[0])
        elif facts.get("Location"):
            total += stored_bytes(spark, facts["Location"])
        else:
            total += frames_bytes(spark, [getattr(tables, field)])
    return total


def today(spark: SparkSession) -> _dt.date:
    """The session's current date (its time zone, not the driver machine's)."""
    return spark.sql("SELECT current_date()").first()[0]


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  driver_memory: str = "16g", event_log_dir: str | None = None) -> SparkSession:
    """Local session: UI off, AQE on, shuffle partitions sized to the cores."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         # Batch jobs: skip capturing the Python call site of every Column
         # call for error messages (several py4j round-trips per call).
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    When the session leaves it unset, a private scratch folder is created and
    registered only for a local master (tests, single-machine runs); on a
    cluster ``None`` is returned, since a machine-local folder would not
    survive the loss of that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; use the setting as is
        return configured
    d = configured or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
        return d
    return None
