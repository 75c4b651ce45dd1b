"""Helpers shared by the training-data operators: tables, staging, words."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# A word is a maximal run of anything but these white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
SPACES = "\x20\x09\x0A\x0B\x0C\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (a private one for a local master only)."""
    found = checkpoint_dir(spark)
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found.rstrip("/")


def _shared_folder(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/ledgerline-{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The folder goes when the session's file system closes.
    """
    spark = df.sparkSession
    path = _shared_folder(spark, label)
    df.write.parquet(path)
    _file_system(spark, path).deleteOnExit(_path(spark, path))
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package, packed = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    folder = _shared_folder(spark, "package")
    stream = _file_system(spark, folder).create(_path(spark, f"{folder}/ledgerline_package.zip"))
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    _file_system(spark, folder).deleteOnExit(_path(spark, folder))
    context.addPyFile(f"{folder}/ledgerline_package.zip")
    _shipped.add(context.applicationId)


def map_arrow(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def is_learned(doc_id: Column, modulus: int, held: int) -> Column:
    """True for rows to learn from: crc32 of the id as text leaves another remainder than ``held``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus != held


def duckdb_crc32(text: str) -> str:
    """SQL for DuckDB, which has no such function: the unsigned crc32 of an ASCII text, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda a, b: {step}), CAST(4294967295 AS BIGINT))"


def slices(batches: Iterator[pa.RecordBatch], chars: int = 4_000_000, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``chars`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.nan_to_num(np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.float64)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, before + chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound (only speed depends on it)."""

    LIMIT = 300_000

    def __missing__(self, word: str | bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass"))
        self[word] = value
        return value

    def array(self, words: list[str] | list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
