"""Sentinel-keyed joins of the balance reports.

The reports match keys by ``coalesce(key, '-9999')`` equality, so NULL matches
NULL and also a literal ``'-9999'``; that is not ``<=>``.  Join keys are
therefore materialised as sentinel-defaulted columns on both sides and joined
by name, which keeps them plain equi-join keys (sort-merge or broadcast-hash,
AQE picks at runtime) instead of a non-equi condition.  Core and loan balances
are merged without a join, inside their aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DecimalType

from ..functions import columns as C
from . import heat
from .sums import narrowed

DATE = "source_cycle_date"

# ``full_outer_merge``: seconds between two points in time, length of a session, and the day number of
# 1970-01-01 (days of all years from 1 to 9999 are above 1, which stands for undated).
POINT, SESSION, DAY_ONE = 4, "1 second", 1_000_000


def full_outer_merge(core: DataFrame, loan: DataFrame, keys: Sequence[str], date_mode: str = "none",
                     fallback: Column | None = None, narrow: bool = False) -> DataFrame:
    """Sums of core and loan rows by raw key, FULL OUTER joined by sentinel key, in one exchange.

    ``core`` and ``loan`` are rows (raw, or summed before): string ``keys`` on
    both sides, ``source_cycle_date`` (not in ``loan`` for mode ``"none"``), and measures,
    which are all their other columns.  ``date_mode`` says how the date takes part:

    * ``"none"``: loan carries no date; the merged date is the core date.
    * ``"defaulted"``: dates match after ``coalesce(d, fallback)``, so an undated
      row meets a row dated ``fallback``; merged date is ``coalesce(core, loan)``.
    * ``"strict"``: plain date equality (NULL never matches); merged as above.

    Rows of one sentinel key may have several raw keys (NULL and a literal
    ``'-9999'``, an undated row and one dated ``fallback``, any date in mode
    ``"none"``).  Each is a group of its own, and the groups of both sides are paired.  Grouping
    by the raw key and then joining by the sentinel key would move each side
    twice.  Here a row's raw key is written as a point in time, and the rows are
    grouped by sentinel key and session window: groups of one key are sessions
    too far apart to merge, Spark sums them before the exchange, and exchanges sessions
    by key alone.  So all groups of a key are then in one place, and pairing
    them is local.  A key has one group for each raw key (and date in mode ``"none"``),
    whatever its number of rows; these few are listed and unfolded.
    """
    if date_mode not in ("none", "defaulted", "strict"):
        raise ValueError(f"unknown date_mode {date_mode!r}")
    bits = len(keys) + (date_mode == "defaulted")
    date = F.col(DATE)

    def side(rows: DataFrame, tag: str, measures: list[str]) -> DataFrame:
        nulls = [F.col(k).isNull() for k in keys] + ([date.isNull()] if date_mode == "defaulted" else [])
        point = sum((F.when(n, F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(nulls)), F.lit(0).cast("long"))
        cols = [C.sentinel(k).alias(f"_j_{k}") for k in keys]
        if date_mode == "none":
            days = F.coalesce(F.unix_date(date) + F.lit(DAY_ONE), F.lit(1)) if tag == "c" else F.lit(0)
            point = days.cast("long") * (1 << bits) + point
        elif date_mode == "defaulted":
            cols.append(F.coalesce(date, fallback).alias("_j_date"))
        else:  # undated rows of the two sides are keys of their own
            cols += [date.alias("_j_date"), F.when(date.isNull(), F.lit(tag)).alias("_j_side")]
        return rows.select(*cols, F.timestamp_seconds(point * POINT).alias("_at"), F.lit(True).alias(f"_{tag}"), *measures)

    measures = {tag: [c for c in rows.columns if c not in (*keys, DATE)] for tag, rows in (("c", core), ("l", loan))}
    rows = side(core, "c", measures["c"]).unionByName(side(loan, "l", measures["l"]), allowMissingColumns=True)
    on = [c for c in rows.columns if c.startswith("_j_")]
    scale = {f.name: f.dataType.scale for f in rows.schema.fields if isinstance(f.dataType, DecimalType)}
    groups = rows.groupBy(*on, F.session_window("_at", SESSION).alias("_at")).agg(
        F.max("_c").alias("_c"), F.max("_l").alias("_l"),
        *[narrowed(F.sum(m), scale[m], narrow).alias(m) for ms in measures.values() for m in ms])
    point = (F.unix_seconds(F.col("_at")["start"]) / POINT).cast("long").alias("point")
    listed = groups.groupBy(*on).agg(*[
        F.collect_list(F.when(F.col(f"_{tag}"), F.struct(point, *measures[tag]))).alias(f"_{tag}") for tag in "cl"])
    paired = listed.select(*on, "_l", F.explode_outer("_c").alias("_c"))
    paired = paired.select(*on, "_c", F.explode_outer("_l").alias("_l"))

    def known(bit: int) -> Column:
        """The key has a value in one of the paired groups (then both of them mean the sentinel key's)."""
        has = [F.col(f"_{tag}").isNotNull() & (F.col(f"_{tag}")["point"].bitwiseAND(F.lit(1 << bit)) == 0) for tag in "cl"]
        return has[0] | has[1]

    if date_mode == "none":
        days = F.shiftright(F.col("_c")["point"], bits)
        merged = F.when(days > 1, F.date_from_unix_date((days - F.lit(DAY_ONE)).cast("int")))
    else:
        merged = F.when(known(len(keys)), F.col("_j_date")) if date_mode == "defaulted" else F.col("_j_date")
    return paired.select(*[F.when(known(i), F.col(f"_j_{k}")).alias(k) for i, k in enumerate(keys)], merged.alias(DATE),
                         *[F.col(f"_{tag}")[m].alias(m) for tag in "cl" for m in measures[tag]])


def left_join_on(left: DataFrame, right: DataFrame, left_keys: Sequence[Column],
                 right_keys: Sequence[Column], payload: Sequence[Column | str], how: str = "left",
                 hot: Column | None = None, spread: Sequence[Column] = ()) -> DataFrame:
    """LEFT (or inner) join on pairwise-equal key expressions, adding ``payload``.

    The key expressions are projected as named columns first so the join stays
    a plain equi-join on those names.  With ``hot`` (``heat.hot_parts``), the left rows of a
    hot key are dealt to its parts by ``spread`` and its right rows repeated for each.
    """
    names = [f"_k{i}" for i in range(len(left_keys))]
    lhs = left.select("*", *[k.alias(n) for k, n in zip(left_keys, names)])
    rhs = right.select(*[k.alias(n) for k, n in zip(right_keys, names)], *payload)
    if hot is not None:
        key = [F.col(n) for n in names]
        lhs = lhs.withColumn("_part", heat.part_of(hot, key, spread))
        rhs = rhs.withColumn("_part", F.explode(heat.all_parts(hot, key)))
        names = [*names, "_part"]
    return lhs.join(rhs, on=names, how=how).drop(*names)


def left_join_raw(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT join of many raw rows on equal ``keys`` (NULL never matches), adding ``right``'s other columns.

    For a lookup with far fewer rows than ``left``, few of them a key: the left
    rows stream past a hash table of their partition's lookup rows and are not
    sorted, so what a task holds grows with the lookup alone.  The keys are the
    rows' own columns, so they move once.
    """
    added = [c for c in right.columns if c not in keys]
    return left.join(right.hint("shuffle_hash"), on=list(keys), how="left").select(*left.columns, *added)


def attach_lists(left: DataFrame, left_keys: Sequence[Column], lookups: Sequence[tuple],
                 spread: Sequence[Column] = (), hot: Column | None = None) -> tuple[DataFrame, list[tuple[str, list[str]]]]:
    """Several LEFT lookups on the same key in one join, without their fan-out.

    ``lookups`` holds ``(right, right_keys, payload)`` or
    ``(right, right_keys, payload, left_condition)``; a left condition (a
    predicate on left columns only) must also hold for a row to match.  Each
    lookup's rows are first collected into one list a key (keys have one row
    a date or a client, so the lists are short where their product is not),
    and all lists of a key sit in one row.  So the left rows move once, each
    meets at most one row, and what moves is the sum of the lookups' rows, not
    their product.  ``unfold`` then makes the rows the plain joins would give.

    A key may hold most of the left rows.  ``hot`` (``heat.hot_parts``) says
    how many parts a key needs: its left rows are dealt to them by ``spread``
    (left columns) and its one lookup row is repeated for each.  All other
    keys stay in one part.  It is a single join over two exchanges, so
    adaptive execution may split its partitions further.
    """
    names = [f"_k{i}" for i in range(len(left_keys))]
    parts = None
    for i, (right, right_keys, payload, *_) in enumerate(lookups):
        rows = right.select(*[k.alias(n) for k, n in zip(right_keys, names)], F.struct(*payload).alias(f"_list{i}"))
        parts = rows if parts is None else parts.unionByName(rows, allowMissingColumns=True)
    lists = [f"_list{i}" for i in range(len(lookups))]
    lookup = parts.groupBy(*names).agg(*[F.collect_list(c).alias(c) for c in lists])
    out = left_join_on(left, lookup, left_keys, [F.col(n) for n in names], lists, hot=hot, spread=spread)
    for c, (_, _, _, *cond) in zip(lists, lookups):
        if cond:
            out = out.withColumn(c, F.when(cond[0], F.col(c)))
    fields = [[p if isinstance(p, str) else _name_of(right.select(p)) for p in payload] for right, _, payload, *_ in lookups]
    return out, list(zip(lists, fields))


def _name_of(one: DataFrame) -> str:
    return one.columns[0]


def unfold(rows: DataFrame, lists: Sequence[tuple[str, list[str]]]) -> DataFrame:
    """One row for each combination of list elements (an empty or missing list gives NULLs)."""
    for name, fields in lists:
        kept = [c for c in rows.columns if c != name]
        rows = rows.select(*kept, F.explode_outer(name).alias(name))
        rows = rows.select(*kept, *[F.col(f"{name}.{f}").alias(f) for f in fields])
    return rows


def attach_all(left: DataFrame, left_keys: Sequence[Column], lookups: Sequence[tuple],
               spread: Sequence[Column] = (), hot: Column | None = None) -> DataFrame:
    """Several LEFT lookups on the same key: ``attach_lists``, unfolded."""
    return unfold(*attach_lists(left, left_keys, lookups, spread, hot))


def sentinel_keys(*cols: str | Column) -> list[Column]:
    return [C.sentinel(c) for c in cols]
