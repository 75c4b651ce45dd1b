"""Merkle manifest of a dataset, by cogrouped subtree exchange.

Every document is a leaf: SHA-256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and its value.  The leaves of a group (language) stand
in the order of ``doc_id``; every two neighbours become the digest of their
hexadecimal digests, a node without a neighbour the digest of its own, until
one is left: the group's subroot.  Subroots, ordered by group, give the root in
the same way.

A superblock is ``2 ** HEIGHT`` neighbouring nodes.  Going up, each superblock
of a tier is reduced to one node of the next tier, so a tier is a thousandth of
the one below and a tree of 10^12 leaves has four.  Going down, the nodes of a
superblock are cogrouped with the outer nodes that it needs: the one row of
siblings between its own root and the tree's.  At the leaves that exchange
finishes everything in one function call a superblock: local reduction, proof
and folding of the claimed leaf.  The tree over groups is built by the same code.

Places come from a range sort by (group, order): a hot group is spread over many
ranges, the ranges' row counts are summed before a range, and no task sorts or
holds a group.  A superblock is bounded by its size, whatever the data.

Nulls: a null field is ``-``, a null id comes first, a null group is a group of
its own and comes first.  Empty and very long texts are hashed whole, by Spark,
where they are read; from then on a document is two digests.  Rows that tie in
``doc_id`` are ordered by leaf; repeated rows are leaves of their own with equal
digests.  One document alone is its subroot and the root, its proof is empty.
An empty table gives an empty result.  Columns other than those named are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# A superblock is 2 ** HEIGHT nodes.
HEIGHT = 10
# Fields of a leaf in order; a document is tampered with where this divides the crc32 of its id.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7
# Rows up to which the counts of ranges (one row a range and group) are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 100_000

NODE = "grp string, n long, pos long, digest string"
OUTER = "grp string, pos long, subroot string, path array<string>"
PROVED = ("doc_id long, leaf string, subroot string, root string, siblings array<string>, proof_sha256 string, "
          "folded_root string, verified boolean")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a document's fields."""
    def framed(col: Column) -> Column:
        value = col.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[framed(fields[f]) for f in FIELDS]), 256)


def group_key(col: Column) -> Column:
    """A key without nulls that orders like the group itself, null first."""
    return F.when(col.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), col.cast("string")))


def levels_of(nodes: list[str], height: int) -> list[list[str]]:
    """The nodes of a superblock, level by level, up to ``height``."""
    levels = [nodes]
    for _ in range(height):
        row = levels[-1]
        levels.append([digest("".join(row[i:i + 2])) for i in range(0, len(row), 2)])
    return levels


def siblings_of(levels: list[list[str]], place: int) -> list[str]:
    """The sibling on each level, as side (``<`` left, ``>`` right) and digest; empty where the node stands alone."""
    path = []
    for row in levels[:-1]:
        beside = place ^ 1
        path.append("" if beside >= len(row) else ("<" if beside < place else ">") + row[beside])
        place >>= 1
    return path


def fold(node: str, path) -> str:
    for step in path:
        node = digest(step[1:] + node if step[:1] == "<" else node + step[1:])
    return node


def height_of(n: int, most: int) -> int:
    """Levels that a superblock of a tier with ``n`` nodes is reduced by."""
    return min(most, max(0, n - 1).bit_length())


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos (place in its ``grp``, from 0) and n (rows of the group), staged."""
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    ranged = common.staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-ranges")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_range", "grp").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    by_range = Window.partitionBy("grp").orderBy("_range")
    before = F.coalesce(F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = common.staged(sizes.select("_range", "grp", (before - F.col("_first")).alias("_shift"),
                                         F.sum("_n").over(Window.partitionBy("grp")).alias("n")), "merkle-offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = ranged.join(offsets, ["_range", "grp"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _reduce(height: int):
    """Nodes of a superblock -> its one node of the next tier."""
    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        n = int(nodes["n"].iloc[0])
        top = levels_of(nodes.sort_values("pos")["digest"].tolist(), height_of(n, height))[-1][0]
        return pd.DataFrame({"grp": [key[0]], "n": [-(-n >> height)], "pos": [key[1]], "digest": [top]})

    return run


def _paths(height: int):
    """Nodes of a superblock and the path above it -> the path above each node."""
    def run(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        levels = levels_of(nodes["digest"].tolist(), height_of(int(nodes["n"].iloc[0]), height))
        above = list(outer["path"].iloc[0])
        return pd.DataFrame({"grp": nodes["grp"], "pos": nodes["pos"], "subroot": outer["subroot"].iloc[0],
                             "path": [siblings_of(levels, i) + above for i in range(len(nodes))]})

    return run


def _finish(height: int, root: str, keep_siblings: bool):
    """Leaves of a superblock and the path above it -> proof and folded root of each leaf."""
    def run(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("pos")
        levels = levels_of(leaves["digest"].tolist(), height_of(int(leaves["n"].iloc[0]), height))
        above = list(outer["path"].iloc[0])
        paths = [siblings_of(levels, i) + above for i in range(len(leaves))]
        folded = [fold(claimed, path) for claimed, path in zip(leaves["claimed"], paths)]
        return pd.DataFrame({
            "doc_id": leaves["doc_id"].astype("Int64"), "leaf": leaves["digest"], "subroot": outer["subroot"].iloc[0], "root": root,
            "siblings": [[s[1:] for s in path if s] if keep_siblings else None for path in paths],
            "proof_sha256": [digest("".join(s[1:] for s in path)) for path in paths],
            "folded_root": folded, "verified": [f == root for f in folded]})

    return run


def _with_outer(nodes: DataFrame, outer: DataFrame, height: int, run, schema: str) -> DataFrame:
    """Nodes cogrouped by superblock with the path above it."""
    inner = nodes.withColumn("block", F.shiftright("pos", height)).groupBy("grp", "block")
    return inner.cogroup(outer.withColumnRenamed("pos", "block").groupBy("grp", "block")).applyInPandas(run, schema)


def climb(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(tiers, lowest first; one node a group) of ``nodes`` (grp, n, pos, digest)."""
    most, tiers = nodes.agg(F.max("n")).first()[0] or 0, []
    nodes = nodes.select("grp", "n", "pos", "digest")
    while most > 1:
        tiers.append(nodes)
        blocks = nodes.groupBy("grp", F.shiftright("pos", height).alias("block"))
        nodes = common.staged(blocks.applyInPandas(_reduce(height), NODE), "merkle-tier")
        most = -(-most >> height)
    return tiers, nodes


def hand_down(tiers: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Paths above the nodes of the lowest of ``tiers``, from those above the groups' roots (``outer``)."""
    for nodes in reversed(tiers):
        outer = common.staged(_with_outer(nodes, outer, height, _paths(height), OUTER), "merkle-paths")
    return outer


def manifest(leaves: DataFrame, height: int = HEIGHT, keep_siblings: bool = True) -> DataFrame:
    """Proofs of ``leaves`` (doc_id, grp from ``group_key``, digest, claimed): one row a leaf.

    ``claimed`` is the leaf that is folded through the proof, ``verified`` says whether it leads to
    the root.  ``siblings`` are the proof's digests, bottom up (null without ``keep_siblings``).
    """
    spark = leaves.sparkSession
    common.ship(spark)
    leaves = common.staged(leaves.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = common.staged(positions(leaves, ["doc_id", "digest", "_row"]).drop("_row"), "merkle-placed")
    tiers, subroots = climb(placed, height)

    # The tree over groups: one group whose nodes are the subroots, ordered by their group.
    over = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    over = common.staged(positions(over, ["member"]), "merkle-groups")
    group_tiers, top = climb(over, height)
    root = top.first()
    if root is None:
        return spark.createDataFrame([], PROVED)
    here = top.select("grp", "pos", F.lit("").alias("subroot"), F.array().cast("array<string>").alias("path"))
    paths = hand_down(group_tiers, here, height).select("pos", "path")
    outer = over.join(paths, "pos").select(F.col("member").alias("grp"), F.lit(0).cast("long").alias("pos"),
                                           F.col("digest").alias("subroot"), "path")

    # Down to the superblocks of leaves, and the last exchange with the leaves themselves.
    outer = hand_down(tiers[1:], common.staged(outer, "merkle-outer"), height)
    return _with_outer(placed, outer, height, _finish(height, root["digest"], keep_siblings), PROVED)


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, grp, digest and claimed: the leaf with 1 added to n_chars where ``tampered`` holds."""
    fields = {f: F.col(f) for f in FIELDS}
    changed = leaf(fields | {"n_chars": F.col("n_chars") + 1})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), group_key(F.col("lang")).alias("grp"), leaf(fields).alias("digest"),
                       F.when(tampered, changed).alias("claimed")).withColumn("claimed", F.coalesce("claimed", "digest"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: manifest of all documents; where 7 divides the crc32 of the id, n_chars was tampered with."""
    tampered = ~common.is_learned(F.col("doc_id"), TAMPER, 0) & F.col("doc_id").isNotNull()
    leaves = document_leaves(common.read_table(spark, sf_dir, "documents"), tampered)
    return manifest(leaves, keep_siblings=False).drop("siblings")


ORACLE = r"""
WITH RECURSIVE f AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '0') AS g, n_chars,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a,
    coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS b,
    coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') AS b1,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS c,
    coalesce(%CRC% % 7 = 0, false) AS tampered
  FROM documents),
l AS (SELECT r, doc_id, g, sha256(a || b || c) AS leaf, CASE WHEN tampered THEN sha256(a || b1 || c) ELSE sha256(a || b || c) END AS claimed FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos FROM l),
tree(g, lvl, i, h, n) AS (
  SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM p
  UNION ALL
  SELECT g, lvl + 1, i // 2, h, (n + 1) // 2
  FROM (SELECT g, lvl, i, n, sha256(h || coalesce(lead(h) OVER (PARTITION BY g ORDER BY i), '')) AS h FROM tree WHERE n > 1)
  WHERE i % 2 = 0),
sub AS (SELECT g, h AS subroot, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree WHERE n = 1),
top(lvl, i, h, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, i // 2, h, (n + 1) // 2
  FROM (SELECT lvl, i, n, sha256(h || coalesce(lead(h) OVER (ORDER BY i), '')) AS h FROM top WHERE n > 1)
  WHERE i % 2 = 0),
fold(r, g, lvl, i, cur, proof) AS (
  SELECT r, g, 0, pos, claimed, '' FROM p
  UNION ALL
  SELECT f.r, f.g, f.lvl + 1, f.i // 2, sha256(CASE WHEN s.i < f.i THEN s.h || f.cur ELSE f.cur || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
  FROM fold f JOIN sub ON sub.g = f.g AND f.lvl < sub.height
  LEFT JOIN tree s ON s.g = f.g AND s.lvl = f.lvl AND s.i = xor(f.i, 1)),
folded AS (SELECT f.r, sub.pos, f.cur, f.proof FROM fold f JOIN sub ON sub.g = f.g AND sub.height = f.lvl),
whole(r, lvl, i, cur, proof) AS (
  SELECT r, 0, pos, cur, proof FROM folded
  UNION ALL
  SELECT f.r, f.lvl + 1, f.i // 2, sha256(CASE WHEN s.i < f.i THEN s.h || f.cur ELSE f.cur || coalesce(s.h, '') END), f.proof || coalesce(s.h, '')
  FROM whole f JOIN (SELECT max(lvl) AS height FROM top) m ON f.lvl < m.height
  LEFT JOIN top s ON s.lvl = f.lvl AND s.i = xor(f.i, 1)),
root AS (SELECT lvl AS height, h AS root FROM top WHERE n = 1)
SELECT p.doc_id, p.leaf, sub.subroot, root.root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root, w.cur = root.root AS verified
FROM p JOIN sub ON sub.g = p.g CROSS JOIN root JOIN whole w ON w.r = p.r AND w.lvl = root.height
""".replace("%CRC%", common.duckdb_crc32("CAST(doc_id AS VARCHAR)"))
