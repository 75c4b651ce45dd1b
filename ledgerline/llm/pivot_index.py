"""Exact top-k search by inner product over a pivot-distance index.

Components become integers, floor(1024 * x).  With one more coordinate,
sqrt(M^2 - |x|^2) for rows (M: the longest row) and 0 for queries, the largest
inner products are the nearest rows: |q - x|^2 = |q|^2 + M^2 - 2 q.x.  Pivots
are centres of a bounded sample; every row is keyed by its nearest pivot and
the distance to it, and the distances of a pivot are cut into annuli.  By the
triangle inequality no row of an annulus [a, b] is nearer to a query at
distance d from the pivot than max(0, a - d, d - b).  A query expands over the
annuli in the order of that bound, in rounds, and stops at those whose bound
cannot reach its k-th score so far: the result is exact.

An annulus is stored in blocks of at most about ``BLOCK`` rows (a hash of the id),
and a round meets queries and rows by (pivot, annulus, block, query block), so a
vector that a third of all rows share is spread over many tasks.  Only blocks that
queries visit are moved, once for each block of queries that visits them.  Pivots grow with the
rows, from ``PIVOTS`` to ``MOST_PIVOTS``.  What reaches the driver is bounded by
parameters: the sample, the pivots and the annuli.

Integers are exact whatever their size: products that may pass 2^53 are summed in 64-bit integers, those that
may pass 2^63 in Python's.  A result whose score does not fit its 64-bit column fails the
query instead of wrapping.

Vectors that are null or hold null or non-finite components take no part, nor
do rows without an id.  Shorter vectors count as padded by zeros.  Ties of the
score go to the smaller id.  A query row's own id is no candidate; of rows that
repeat an id, each is a candidate of the others' queries, and the query takes
the least vector.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

# The scale of components, and the result's depth.
SCALE, TOP = 1024, 10
# Bounds of the index: pivots at least and at most, annuli a pivot, rows a block, queries a block, rows of the sample.
PIVOTS, MOST_PIVOTS, RINGS, BLOCK, QUERY_BLOCK, SAMPLE = 32, 512, 8, 2048, 2048, 8192
# Rows for which there is one more pivot.
PIVOT_ROWS = 20_000
# Annuli that a query has met after each round (the last round meets all that its bound leaves).
EXPAND = (4, 24, None)
RESULT = "query_id long, vec_id long, score long"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (integers, as doubles, which hold them exactly) and n2 (squared length) of the rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # A double from 2^52 on is an integer already; its floor would not fit 64 bits from 2^63 on.
    ints = F.transform(e, lambda x: F.when(F.abs(x.cast("double") * SCALE) < float(2 ** 52), F.floor(x.cast("double") * SCALE).cast("double"))
                       .otherwise(x.cast("double") * SCALE))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & e.isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"))
    return rows.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column, padded by zeros to ``dim``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    if len(values) == len(column) * dim:
        return values.reshape(len(column), dim)
    sizes = np.asarray(pc.list_value_length(column), dtype=np.int64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = values
    return out


class Geometry:
    """Pivots in the space with one more coordinate, and annulus borders by pivot."""

    def __init__(self, dim: int, longest2: float, sample: np.ndarray, largest: float, rows: int):
        self.dim, self.longest2 = dim, longest2
        bound = int(largest) ** 2 * dim  # no sum of products passes it
        self.sums_in = np.float64 if bound < 2 ** 53 else np.int64 if bound < 2 ** 63 else object
        points = self.lift(sample)
        rng = np.random.default_rng(7)
        k = min(max(PIVOTS, min(MOST_PIVOTS, rows // PIVOT_ROWS)), len(points))
        self.pivots = points[rng.choice(len(points), k, replace=False)]
        for _ in range(8):
            near = self.distances(points).argmin(axis=1)
            for p in range(k):
                if (near == p).any():
                    self.pivots[p] = points[near == p].mean(axis=0)
        d = self.distances(points)
        near, least = d.argmin(axis=1), d.min(axis=1)
        cuts = np.linspace(0, 1, RINGS + 1)[1:-1]
        self.borders = np.array([np.quantile(least[near == p], cuts) if (near == p).any() else np.zeros(RINGS - 1)
                                 for p in range(k)])

    def lift(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        rows = rows.astype(np.float64)
        last = np.zeros(len(rows)) if query else np.sqrt(np.maximum(0.0, self.longest2 - (rows * rows).sum(axis=1)))
        return np.hstack([rows, last[:, None]])

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points * points).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))

    def scores(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.sums_in is object:
            queries, rows = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (queries, rows))
            return queries @ rows.T
        return (queries.astype(self.sums_in) @ rows.astype(self.sums_in).T).astype(np.int64)


def _keys(geometry: Geometry):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = geometry.distances(geometry.lift(matrix(batch.column(1), geometry.dim)))
                pivot, least = d.argmin(axis=1), d.min(axis=1)
                ring = (least[:, None] > geometry.borders[pivot]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(pivot, pa.int32()), pa.array(ring, pa.int32()),
                     pa.array(least, pa.float64())], names=["vec_id", "v", "pivot", "ring", "dist"])

    return run


def _route(geometry: Geometry, rings: list[tuple], first: int, last: int | None):
    """Query rows -> a row for each block of the annuli that the query meets in this round."""
    ring = np.array([(p, r, lo, hi) for p, r, lo, hi, _, _ in rings], dtype=np.float64).reshape(-1, 4)
    blocks = [b for *_, b in rings]
    pivot = ring[:, 0].astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                q = geometry.lift(matrix(part.column(1), geometry.dim), query=True)
                d = geometry.distances(q)[:, pivot]
                near = np.maximum(0.0, np.maximum(ring[:, 2] - d, d - ring[:, 3]))
                best = ((q * q).sum(axis=1)[:, None] + geometry.longest2 - near * near) / 2
                order = np.argsort(near, axis=1, kind="stable")
                place = np.argsort(order, axis=1, kind="stable")
                floor = np.array([-math.inf if f is None else f for f in part.column(2).to_pylist()], dtype=np.float64)
                slack = 1e-6 * (1 + np.abs(best))  # far above the rounding of these sums, far below what prunes
                meets = (place >= first) & (place < (len(rings) if last is None else last)) & (best + slack >= floor[:, None])
                at, which = np.nonzero(meets)
                rows = [(i, w, b) for i, w in zip(at.tolist(), which.tolist()) for b in range(blocks[w])]
                if rows:
                    i, w, b = (np.array(x) for x in zip(*rows))
                    chosen = part.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pivot[w], pa.int32()), pa.array(ring[w, 1].astype(int), pa.int32()), pa.array(b, pa.int32()),
                         *chosen.columns], names=["pivot", "ring", "block", "query_id", "q", "floor", "query_block"])

    return run


def _meet(geometry: Geometry, top: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by("vec_id")
            ids = rows.column("vec_id").to_numpy()
            v = matrix(rows.column("v"), geometry.dim)
            for start in range(0, queries.num_rows, 256):
                part = queries.slice(start, 256)
                own = part.column("query_id").to_numpy()
                found = geometry.scores(matrix(part.column("q"), geometry.dim), v)
                floor = part.column("floor").to_pylist()
                for i, scores in enumerate(found):
                    allowed = np.flatnonzero((ids != own[i]) & ((scores >= floor[i]) if floor[i] is not None else True))
                    order = allowed[np.argsort(-scores[allowed], kind="stable")[:top]]
                    if len(order) and not -2 ** 63 <= min(scores[order]) <= max(scores[order]) < 2 ** 63:
                        raise OverflowError(f"a score of query {own[i]} does not fit 64 bits")
                    out["query_id"].append(np.full(len(order), own[i]))
                    out["vec_id"].append(ids[order])
                    out["score"].append(scores[order].astype(np.int64))
        return pa.table({k: pa.array(np.concatenate(x) if x else np.zeros(0, dtype=np.int64), pa.int64()) for k, x in out.items()})

    return run


def best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query with their rank: highest score first, then the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def build_index(vectors: DataFrame) -> tuple[Geometry, DataFrame, list[tuple]] | None:
    """(geometry, keyed rows, annuli as (pivot, ring, least, most, rows, blocks)); None for no vectors."""
    facts = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("n2"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not facts[0]:
        return None
    dim = max(1, facts[1])
    sample = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    geometry = Geometry(dim, facts[2], matrix(sample.column("v"), dim), facts[3] or 0, facts[0])
    keyed = common.staged(common.map_arrow(
        vectors.select("vec_id", "v"), _keys(geometry), "vec_id long, v array<double>, pivot int, ring int, dist double"), "pivot-index")
    rings = [(r["pivot"], r["ring"], r["lo"], r["hi"], r["n"], math.ceil(r["n"] / BLOCK))
             for r in keyed.groupBy("pivot", "ring").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"),
                                                         F.count(F.lit(1)).alias("n")).orderBy("pivot", "ring").collect()]
    blocks = vectors.sparkSession.createDataFrame([(p, r, b) for p, r, _, _, _, b in rings], "pivot int, ring int, blocks int")
    index = keyed.join(F.broadcast(blocks), ["pivot", "ring"])  # MOST_PIVOTS * RINGS rows at most
    return geometry, index.withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).drop("blocks"), rings


def visited(index: DataFrame, routed: DataFrame) -> DataFrame:
    """Rows of the blocks that a round visits, a copy for each block of queries that does."""
    keys = routed.select("pivot", "ring", "block", F.col("query_block").alias("query_block")).distinct()
    return index.join(keys, ["pivot", "ring", "block"])


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` rows of ``vectors`` for each row of ``queries`` (vec_id, v)."""
    spark = vectors.sparkSession
    built = build_index(vectors)
    if built is None:
        return best(spark.createDataFrame([], RESULT), top)
    geometry, index, rings = built
    keys = ["pivot", "ring", "block", "query_block"]
    asked = common.staged(queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "pivot-queries")
    n_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int"))

    found, first = None, 0
    for last in EXPAND:
        floors = asked.withColumn("floor", F.lit(None).cast("long"))
        if found is not None:
            kth = found.filter(F.col("rank") == top).select("query_id", F.col("score").alias("floor"))
            floors = asked.join(kth, "query_id", "left")
        routed = common.staged(common.map_arrow(
            floors.select("query_id", "q", "floor", "query_block"), _route(geometry, rings, first, last),
            "pivot int, ring int, block int, query_id long, q array<double>, floor long, query_block int"), "pivot-routed")
        met = visited(index, routed).groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(_meet(geometry, top), RESULT)
        if found is not None:
            met = met.unionByName(found.select("query_id", "vec_id", "score"))
        found, first = common.staged(best(met, top), "pivot-found"), last
    return found


def query(spark, sf_dir: str) -> DataFrame:
    """op7: rows whose id is divisible by 100 against all others."""
    vectors = common.staged(integer_vectors(common.read_table(spark, sf_dir, "embeddings")), "vectors")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


ORACLE = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
