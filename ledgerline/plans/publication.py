"""One run, one publication: reports of a run become visible together.

A run writes its reports to a folder of its own, ``<output>/runs/<id>/<report>``.
When all are written, a manifest is published that says, for every report
and snapshot date, which run's folder holds it.  Dates that the run did not
compute keep their entry, so a run replaces the dates it computes, as the
plain sink does, but in all reports at once.  A run that fails publishes
nothing, and readers go on with the manifest before.

Manifests are numbered, ``<output>/_manifests/<number>.json``, and never
changed.  One is published by renaming a finished file to the next number,
which one of several writers can do; the others read it and try again.
Readers take the highest number.  A manifest has one entry a report and date:
it grows with the dates that are kept, not with the data.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import DATE_COLUMN

FOLDER = "_manifests"
# Key of a report without dates.
UNDATED = ""
ATTEMPTS = 20


def new_run(output: str) -> str:
    return f"{output}/runs/{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def manifest(spark: SparkSession, output: str) -> tuple[int, dict[str, dict[str, str]]]:
    """(number, report -> date -> folder of the run's report) of the newest manifest; (0, {}) before the first."""
    fs, folder = _fs(spark, f"{output}/{FOLDER}")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = [int(n[:-len(".json")]) for n in names if n.endswith(".json")]
    if not numbers:
        return 0, {}
    stream = fs.open(_path(spark, f"{output}/{FOLDER}/{max(numbers):010d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), json.loads(text)


def _dates(spark: SparkSession, path: str) -> list[str]:
    """Partition folders of a written report; the undated key if it has none."""
    fs, at = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    dated = [n for n in names if n.startswith(f"{DATE_COLUMN}=")]
    return dated or ([UNDATED] if any(n.endswith(".parquet") for n in names) else [])


def commit(spark: SparkSession, output: str, written: dict[str, str],
           replaced: dict[str, set | None] | None = None, notes: dict[str, dict[str, str]] | None = None) -> int:
    """Publish ``written`` (report -> folder); returns the number of the new manifest.

    Dates in ``replaced`` (report -> dates, None for all) that the run wrote no rows for are gone from the
    report.  ``notes`` are entries that are kept as they are.
    """
    fs, folder = _fs(spark, f"{output}/{FOLDER}")
    fs.mkdirs(folder)
    found = {name: {date: path for date in _dates(spark, path)} for name, path in written.items()}
    for _ in range(ATTEMPTS):
        number, entries = manifest(spark, output)
        for name, dates in found.items():
            gone = (replaced or {}).get(name, set())
            kept = {} if gone is None else {d: p for d, p in entries.get(name, {}).items() if d not in {f"{DATE_COLUMN}={x}" for x in gone}}
            entries[name] = {**kept, **dates}
        entries.update(notes or {})
        draft = _path(spark, f"{output}/{FOLDER}/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(entries, sort_keys=True).encode()))
        stream.close()
        target = _path(spark, f"{output}/{FOLDER}/{number + 1:010d}.json")
        if not fs.exists(target) and fs.rename(draft, target):
            return number + 1
        fs.delete(draft, False)
    raise RuntimeError(f"no manifest could be published in {ATTEMPTS} attempts: other runs publish to {output}")


def read_report(spark: SparkSession, output: str, name: str) -> DataFrame:
    """A published report: each date from the run that computed it last."""
    _, entries = manifest(spark, output)
    if name not in entries:
        raise ValueError(f"report {name!r} is not published in {output}")
    folders: dict[str, list[str]] = {}
    for date, path in entries[name].items():
        folders.setdefault(path, []).append(f"{path}/{date}" if date != UNDATED else path)
    parts = [spark.read.option("basePath", path).parquet(*dates) for path, dates in folders.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
