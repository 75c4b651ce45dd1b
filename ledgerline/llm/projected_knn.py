"""Approximate nearest neighbours by stable projections, a kd-tree, and a chi-square stopping test.

Vectors are projected to ``DIMS`` dimensions by independent normal (2-stable)
directions: the squared projected distance of two vectors, divided by their
squared distance, is chi-square distributed with ``DIMS`` degrees of freedom.  A
query meets its projected neighbours incrementally, nearest first, and verifies
each by its true distance.  It stops at the projected distance r where the test

    chi2_cdf(r^2 / d_k^2) >= CONFIDENCE       (d_k: the k-th distance so far)

holds: a vector nearer than d_k would have been met before with at least that
probability.  There is no cap on the vectors that a query verifies.

The index is a kd-tree over projected vectors in two levels.  The upper tree is
fitted on the projections of a bounded sample; its cells, as many as the rows need up to
``CELLS``, hold every row, and a crowded cell is cut into blocks of about ``BLOCK`` rows by a
hash of the id.  The tree of a block is built where the block is searched.  A
query expands over cells in the order of their distance, in rounds, and the test
prunes whole cells between rounds, buckets and rows inside a block.  A round
meets rows and queries by (cell, block, part of the block's queries): only visited blocks
are moved, once for each ``QUERIES`` queries that visit them.

A vector that a third of all rows share is one entry: of rows with equal vectors
the smallest ids are kept that any result can hold (one more than ``top``, as a
query is no neighbour of itself), which loses nothing, since equal distances are
ordered by id.  What reaches the driver is bounded by parameters: the sample's
projections, the upper tree, a row a cell.

Vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without an id.  Shorter vectors count as padded by zeros.  Components are
read in double precision; a distance beyond its range is infinite.  Ties go to
the smaller id.  Rows that repeat id and vector count once; of rows that repeat an id only, each is
a candidate of the others' queries, and the query takes the least vector.  An
empty table gives an empty result.  Columns other than those named are not read.
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

# Depth of the result, projected dimensions (even), probability of the stopping test.
TOP, DIMS, CONFIDENCE = 10, 8, 0.9
# Bounds: rows of the sample, cells of the upper tree, rows a block, queries a task, rows a bucket of a block's tree.
SAMPLE, CELLS, BLOCK, QUERIES, BUCKET = 32_768, 4096, 2048, 1024, 64
# Cells that a query has met after each round (the last round meets all that the test leaves).
EXPAND = (1, 8, None)
SEED = 20
FOUND = "query_id long, vec_id long, score double"


def chi2_cdf(x: float, dims: int) -> float:
    """Of an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for i in range(dims // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1.0 - math.exp(-x / 2) * total


def chi2_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, dims) < p else (low, middle)
    return high


def finite_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and v of the rows that take part; rows that repeat both count once."""
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = embeddings.filter(F.col("vec_id").isNotNull() & e.isNotNull() & sound)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("v")).dropDuplicates()


def kind_of(vectors: DataFrame) -> str:
    return vectors.schema["v"].dataType.simpleString()


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column in double precision, padded by zeros to ``dim``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) == len(column) * dim:
        return values.reshape(len(column), dim)
    sizes = np.asarray(pc.list_value_length(column), dtype=np.int64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < sizes[:, None]] = values
    return out


def lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))


class Tree:
    """A balanced kd-tree of ``2 ** levels`` cells: the widest dimension is split at the median."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.axis, self.cut = np.zeros(2 ** levels - 1, dtype=np.int64), np.zeros(2 ** levels - 1)
        cells = [np.arange(len(points))]
        for node in range(2 ** levels - 1):
            rows = cells[node]
            if len(rows):
                here = points[rows]
                self.axis[node] = np.ptp(here, axis=0).argmax()
                self.cut[node] = np.median(here[:, self.axis[node]])
            right = points[rows, self.axis[node]] > self.cut[node]
            cells += [rows[~right], rows[right]]
            cells[node] = None

    def cell(self, points: np.ndarray) -> np.ndarray:
        at, line = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        for _ in range(self.levels):
            at = 2 * at + 1 + (points[line, self.axis[at]] > self.cut[at])
        return at - (2 ** self.levels - 1)


class Projection:
    """Normal directions, the same for every input of a dimension."""

    def __init__(self, dim: int, dims: int = DIMS, confidence: float = CONFIDENCE):
        self.dim, self.dims = dim, dims
        self.directions = np.random.default_rng(SEED).standard_normal((dim, dims))
        self.reach = chi2_quantile(confidence, dims)  # the test holds from r^2 = reach * d_k^2 on

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d][:, None]
        out += np.maximum(0.0, np.maximum(low[:, d] - x, x - high[:, d])) ** 2
    return out


class Block:
    """Rows of a block with their own kd-tree, ready to be searched."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection, bucket: int = BUCKET):
        points = projection(vectors)
        at = Tree(points, max(0, math.ceil(math.log2(max(1, len(ids)) / bucket)))).cell(points)
        order = np.lexsort((ids, at))
        self.ids, self.vectors, self.points, self.projection = ids[order], vectors[order], points[order], projection
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        self.starts, self.stops = starts, np.append(starts[1:], len(ids))
        self.low = np.minimum.reduceat(self.points, starts, axis=0)
        self.high = np.maximum.reduceat(self.points, starts, axis=0)

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, top: int):
        """(query number, id, distance) of the ``top`` nearest met by each query within its bound so far."""
        projected = self.projection(queries)
        boxes = box_distances(projected, self.low, self.high)
        for i, near in enumerate(boxes):
            order, bound = np.argsort(near, kind="stable"), bounds[i] ** 2
            ids, found, start, step = np.zeros(0, dtype=np.int64), np.zeros(0), 0, 1
            while start < len(order):
                taken = order[start:start + step]
                reach = self.projection.reach * bound
                taken = taken[near[taken] <= reach]
                if not len(taken):
                    break  # the test holds for all that is left
                rows = np.concatenate([np.arange(self.starts[b], self.stops[b]) for b in taken])
                rows = rows[self.ids[rows] != own[i]]
                if np.isfinite(reach):
                    rows = rows[((self.points[rows] - projected[i]) ** 2).sum(axis=1) <= reach]
                squares = ((self.vectors[rows] - queries[i]) ** 2).sum(axis=1)
                ids, found = np.concatenate([ids, self.ids[rows]]), np.concatenate([found, squares])
                keep = np.lexsort((ids, found))[:top]
                ids, found = ids[keep], found[keep]
                if len(found) == top:
                    bound = min(bound, found[-1])
                start, step = start + step, 2 * step
            yield i, ids, np.sqrt(found)


def nearest(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query with their rank: smallest distance first, then the smaller id."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _project(projection: Projection):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), lists(projection(matrix(batch.column(1), projection.dim)))], names=["vec_id", "p"])

    return run


def _place(projection: Projection, tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = projection(matrix(batch.column(1), projection.dim))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists(points), pa.array(tree.cell(points), pa.int32())],
                                                 names=["vec_id", "v", "p", "cell"])

    return run


def _route(projection: Projection, cells: list[tuple], first: int, last: int | None):
    """Queries -> a row for each block of the cells that the query meets in this round."""
    low, high = (np.array([c[k] for c in cells], dtype=np.float64).reshape(-1, projection.dims) for k in (2, 3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                near = box_distances(projection(matrix(part.column(1), projection.dim)), low, high)
                place = np.argsort(np.argsort(near, axis=1, kind="stable"), axis=1, kind="stable")
                bound = np.array([math.inf if b is None else b for b in part.column(2).to_pylist()])
                # A slack far above the rounding of these sums: no cell is left out that the test would keep.
                meets = (place >= first) & (near <= projection.reach * (bound * (1 + 1e-9))[:, None] ** 2)
                if last is not None:
                    meets &= place < last
                rows = [(i, cells[w][0], b) for i, w in zip(*(x.tolist() for x in np.nonzero(meets))) for b in range(cells[w][1])]
                if rows:
                    i, cell, block = zip(*rows)
                    chosen = part.take(pa.array(i))
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(block, pa.int32()), *chosen.columns],
                                                     names=["cell", "block", "query_id", "q", "bound"])

    return run


def _meet(projection: Projection, top: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [np.zeros(0, dtype=np.int64)], "vec_id": [np.zeros(0, dtype=np.int64)], "score": [np.zeros(0)]}
        if rows.num_rows and queries.num_rows:
            block = Block(rows.column("vec_id").to_numpy(), matrix(rows.column("v"), projection.dim), projection)
            for start in range(0, queries.num_rows, 256):
                part = queries.slice(start, 256)
                own = part.column("query_id").to_numpy()
                bounds = np.array([math.inf if b is None else b for b in part.column("bound").to_pylist()])
                for i, ids, found in block.search(matrix(part.column("q"), projection.dim), own, bounds, top):
                    out["query_id"].append(np.full(len(ids), own[i]))
                    out["vec_id"].append(ids)
                    out["score"].append(found)
        return pa.table({k: np.concatenate(v) for k, v in out.items()})

    return run


def build_index(vectors: DataFrame, top: int = TOP, block: int = BLOCK) -> tuple[Projection, DataFrame, list[tuple]] | None:
    """(projection, rows with cell and block, cells as (cell, blocks, low, high)); None for no vectors.  ``vectors`` is staged."""
    n, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return None
    projection = Projection(dim)
    sample = common.map_arrow(vectors.select("vec_id", "v"), _project(projection), "vec_id long, p array<double>")
    sample = matrix(sample.orderBy(F.xxhash64("vec_id"), "vec_id", "p").limit(SAMPLE).select("p").toArrow().column("p"), DIMS)
    tree = Tree(sample, min(CELLS.bit_length() - 1, max(0, math.ceil(math.log2(n / block)))))

    # Of equal vectors, the ids that any result can hold; Spark ranks before the shuffle too.
    same = Window.partitionBy("_h", "v").orderBy("vec_id")
    kept = vectors.withColumn("_h", F.xxhash64("v")).withColumn("_rank", F.row_number().over(same)).filter(F.col("_rank") <= top + 1)
    placed = common.staged(common.map_arrow(kept.select("vec_id", "v"), _place(projection, tree),
                                            f"vec_id long, v {kind_of(vectors)}, p array<double>, cell int"), "knn-rows")
    edges = [f(F.element_at("p", d + 1)).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(DIMS)]
    facts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *edges).orderBy("cell").collect()  # CELLS rows at most
    cells = [(r["cell"], math.ceil(r["n"] / block), [r[f"low{d}"] for d in range(DIMS)], [r[f"high{d}"] for d in range(DIMS)]) for r in facts]
    blocks = vectors.sparkSession.createDataFrame([(c, b) for c, b, _, _ in cells], "cell int, blocks int")
    index = placed.select("vec_id", "v", "cell").join(F.broadcast(blocks), "cell")
    return projection, index.withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).drop("blocks"), cells


def visited(index: DataFrame, routed: DataFrame, queries: int = QUERIES) -> tuple[DataFrame, DataFrame]:
    """(rows of the blocks that queries visit, a copy for each part; routed queries with their part)."""
    visits = routed.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("parts"))
    rows = index.join(visits, ["cell", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    asked = routed.join(visits, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("query_id"), "parts").cast("int")).drop("parts")
    return rows, asked


def search(vectors: DataFrame, queries: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (distance) of the nearest found among ``vectors`` for each row of ``queries`` (vec_id, v)."""
    spark = vectors.sparkSession
    built = build_index(vectors, top, block)
    if built is None:
        return nearest(spark.createDataFrame([], FOUND), top)
    projection, index, cells = built
    kind = kind_of(vectors)
    asked = common.staged(queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "knn-queries")

    found, first, keys = None, 0, ["cell", "block", "part"]
    for last in EXPAND:
        bounds = asked.withColumn("bound", F.lit(None).cast("double"))
        if found is not None:
            kth = found.filter(F.col("rank") == top).select("query_id", F.col("score").alias("bound"))
            bounds = asked.join(kth, "query_id", "left")
        routed = common.staged(common.map_arrow(bounds.select("query_id", "q", "bound"), _route(projection, cells, first, last),
                                                f"cell int, block int, query_id long, q {kind}, bound double"), "knn-routed")
        rows, visitors = visited(index, routed)
        met = rows.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(_meet(projection, top), FOUND)
        if found is not None:
            met = met.unionByName(found.select("query_id", "vec_id", "score"))
        found, first = common.staged(nearest(met, top), "knn-found"), last
    return found


def query(spark, sf_dir: str) -> DataFrame:
    """op13: rows whose id is divisible by 100 against all others."""
    vectors = common.staged(finite_vectors(common.read_table(spark, sf_dir, "embeddings")), "knn-vectors")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
