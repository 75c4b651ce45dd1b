"""Hand-made input tables for unit tests, built for both Spark and DuckDB."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb
import pyarrow as pa

from ledgerline.sources.tables import SCHEMAS, TABLE_NAMES, BalanceTables

_ARROW = {"string": pa.string(), "date": pa.date32()}


def _arrow_type(t):
    s = t.simpleString()
    if s.startswith("decimal"):
        p, sc = s[8:-1].split(",")
        return pa.decimal128(int(p), int(sc))
    return _ARROW[s]


def empty_rows() -> dict[str, list[dict]]:
    return {k: [] for k in SCHEMAS}


def row(kind: str, **values) -> dict:
    names = [f.name for f in SCHEMAS[kind].fields]
    unknown = set(values) - set(names)
    assert not unknown, unknown
    return {n: values.get(n) for n in names}


def spark_tables(spark, rows: dict[str, list[dict]]) -> BalanceTables:
    dfs = {}
    for kind, schema in SCHEMAS.items():
        data = [tuple(r[f.name] for f in schema.fields) for r in rows.get(kind, [])]
        dfs[kind] = spark.createDataFrame(data, schema)
    return BalanceTables(**dfs)


def duck_connection(rows: dict[str, list[dict]]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for kind, schema in SCHEMAS.items():
        arrow_schema = pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema.fields])
        cols = {f.name: [r[f.name] for r in rows.get(kind, [])] for f in schema.fields}
        table = pa.table(cols, schema=arrow_schema)
        con.register(f"_t_{kind}", table)
        con.execute(f"CREATE VIEW {TABLE_NAMES[kind]} AS SELECT * FROM _t_{kind}")
    return con


def norm(v):
    if isinstance(v, Decimal):
        return v.normalize()
    return v


def multiset(rows) -> Counter:
    return Counter(tuple(norm(v) for v in r) for r in rows)


D0 = dt.date(2001, 7, 31)   # fixture "yesterday"
AS_OF = dt.date(2001, 8, 1)


def m(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))
