"""MinHash near-dedup by an inverted join of signature coordinates.

A document's set is its distinct shingles.  Its signature has ``COORDINATES``
coordinates of two minimum hashes each, so two sets of similarity s agree in a
coordinate with probability s^2.  Documents of equal sets form a class; below,
a class stands for all of them.

Posting lists hold the classes of each (coordinate, value).  A pair that may be
linked agrees in ``least_matches`` coordinates at least (less agree with
probability below ``LOSS``: 10 at similarity 0.85, fewer below).  So values that one class alone has are skipped,
as are classes with fewer shared values than that; of the others' shared
values, ordered by how many classes share them (then by the value), all but
that number - 1 most frequent form the prefix: a pair with that many matches
must meet in both prefixes, and the lists of very common values are hardly
ever read.

Links only matter up to connectivity.  Each list ties its classes to its hub, the
smallest class; classes so tied form clusters, and a pair with a common list
is inside one cluster.  A cluster is held against itself in blocks of at most
about ``BLOCK_BYTES`` of sets, each with the cluster's centre (the class with
the most common values).  First the
centre: classes linked with it are one component, and need not be compared
with each other.  Every other class of a block is then compared with all of
the block: an inverted index counts common coordinates, pairs with
fewer are out, and the others are confirmed on the full shingle sets (counted
through an inverted index too).  Only links leave the task, so a large group
of near copies gives about a link a class, and no list of all pairs is written.
No link between different components is lost.

Components are found by alternating star contraction on staged links.

Texts of any length are shingled whole.  Nulls: a null or empty text has the empty set and is linked with nothing; a
row without id is linked with nothing, has no component and is kept.  Rows that
repeat an id share no more than their texts do.  Repeated rows are copies.  An
empty table gives an empty result.  Columns other than those named are not
read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Fixed values of the op10 query: words of a shingle, and the similarity of a link in percent.
SHINGLE, PERCENT = 3, 85
# Coordinates of a signature, and how probable it may be that a linked pair is not found.
COORDINATES, LOSS = 32, 1e-6
# Bytes of sets in a block of a cluster.
BLOCK_BYTES = 4 << 20
# Bits of the filter of ids whose sets are needed (its size is fixed; fuller, it only lets more through).
FILTER_BITS, PIECE = 1 << 22, 1 << 15

_WORDS = re.compile(common.WORD.encode()).findall
_PARTS = np.random.default_rng(2024).integers(1, 1 << 63, 2 * COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(percent: int) -> int:
    """The most coordinates of which a pair at the similarity of a link has fewer with probability below ``LOSS``."""
    p, below, m = (percent / 100) ** 2, 0.0, 0
    while (below := below + math.comb(COORDINATES, m) * p ** m * (1 - p) ** (COORDINATES - m)) < LOSS:
        m += 1
    return max(1, m)


def shingles(words: np.ndarray, lengths: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted inside it: (hashes, number of each document's)."""
    n = len(words)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)  # words from here to the document's end
    size = np.minimum(np.repeat(lengths, lengths), shingle)
    hashed = common.mix64(words + np.uint64(1))
    for k in range(1, shingle):
        follow = np.append(words[k:], np.zeros(min(k, n), dtype=np.uint64))
        hashed = np.where(size > k, common.mix64(hashed * np.uint64(3) + follow + np.uint64(k)), hashed)
    use = left >= size
    doc, hashed = doc[use], hashed[use] >> np.uint64(16)  # 48 bits
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])) if len(doc) else np.zeros(0, dtype=bool)
    return hashed[new], np.bincount(doc[new], minlength=len(lengths))


def fingerprints(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint of each non-empty set."""
    starts = np.append(0, np.cumsum(counts))[:-1][counts > 0]
    sums = np.add.reduceat(common.mix64(hashes + np.uint64(0x51ED27)), starts)
    return common.mix64(sums + counts[counts > 0].astype(np.uint64))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Coordinate tokens of each non-empty set; a token names its coordinate and value."""
    starts = np.append(0, np.cumsum(counts))[:-1][counts > 0]
    spread = common.mix64(hashes)
    tokens = np.empty((len(starts), COORDINATES), dtype=np.uint64)
    for c in range(COORDINATES):
        a, b = (np.minimum.reduceat(spread * _PARTS[2 * c + k], starts) for k in (0, 1))
        tokens[:, c] = common.mix64(common.mix64(a + np.uint64(c)) + b)
    return tokens


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch stream (last column: text) with their shingle sets."""
    cache = common.WordHashes()
    for part in common.slices(batches, 2_000_000):
        words, lengths = [], []
        for text in part.column(part.num_columns - 1).to_pylist():
            found = _WORDS((text or "").encode("utf-8", "surrogatepass").lower())
            words.append(cache.array(found))
            lengths.append(len(found))
        yield (part, *shingles(np.concatenate(words), np.array(lengths), shingle))


def _signed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes, counts in _sets(batches, shingle):
            key = np.zeros(part.num_rows, dtype=np.uint64)
            tokens = np.zeros((part.num_rows, COORDINATES), dtype=np.uint64)
            if len(hashes):
                key[counts > 0], tokens[counts > 0] = fingerprints(hashes, counts), signatures(hashes, counts)
            offsets = pa.array(np.arange(0, tokens.size + 1, COORDINATES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(counts.astype(np.int64)), pa.array(key.view(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(tokens.reshape(-1).view(np.int64)))],
                names=["doc_id", "text_hash", "n_shingles", "key", "tokens"])

    return run


def _full(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes, counts in _sets(batches, shingle):
            some = counts > 0
            if some.any():
                raw = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)
                offsets = np.append(0, 6 * np.cumsum(counts[some])).astype(np.int32)
                sets = pa.Array.from_buffers(pa.binary(), int(some.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(hashes, counts).view(np.int64)), sets], names=["key", "set"])

    return run


def _unpack(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(flat), 8), dtype=np.uint8)
    out[:, :6] = flat
    return out.reshape(-1).view("<u8")


class _Index:
    """Inverted index of many sorted arrays: how many values each shares with another array."""

    def __init__(self, arrays: Sequence[np.ndarray]):
        self.sizes = np.array([len(x) for x in arrays])
        values = np.concatenate(arrays)
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], np.repeat(np.arange(len(arrays)), self.sizes)[order]

    def shared(self, found: np.ndarray) -> np.ndarray:
        low, high = (np.searchsorted(self.values, found, side=x) for x in ("left", "right"))
        count = high - low
        at = np.repeat(high - np.cumsum(count), count) + np.arange(count.sum())
        return np.bincount(self.owners[at], minlength=len(self.sizes))


class _Block:
    """One block of a cluster: the told rows as inverted indexes, and the cluster's centre."""

    def __init__(self, name: tuple, centre: tuple[int, np.ndarray, np.ndarray], percent: int):
        self.percent, self.matches = percent, least_matches(percent)
        self.name, self.centre, self.keys, self.tokens, self.sets = name, centre, [], [], []
        self.beside_centre = None

    def _build(self) -> None:
        self.token_index, self.set_index = _Index(self.tokens), _Index(self.sets)
        self.tokens, self.sets = [], []
        _, own, own_tokens = self.centre
        self.beside_centre = np.zeros(len(self.keys), dtype=bool)
        self.beside_centre[self._linked(own, own_tokens)] = True

    def _linked(self, found: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Places of the told rows that match often enough and are linked by their full sets."""
        near = self.token_index.shared(tokens) >= self.matches
        if not near.any():
            return np.zeros(0, dtype=np.int64)
        both = self.set_index.shared(found)
        return np.flatnonzero(near & (100 * both >= self.percent * (len(found) + self.set_index.sizes - both)))

    def _beside(self, a: np.ndarray, a_tokens: np.ndarray, b: np.ndarray, b_tokens: np.ndarray) -> bool:
        if len(np.intersect1d(a_tokens, b_tokens, assume_unique=True)) < self.matches:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def links(self, key: int, found: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
        """Links of one asking row: with the centre (told once), else with the told rows, one of those beside the centre."""
        centre, own, own_tokens = self.centre
        if key == centre:
            return []
        if self._beside(found, tokens, own, own_tokens):
            return [(key, centre)] if self.name[2] == 0 else []
        if not self.keys:
            return []
        if self.beside_centre is None:
            self._build()
        hit = self._linked(found, tokens)
        with_centre = self.beside_centre[hit]
        return [(key, self.keys[k]) for k in [*hit[~with_centre].tolist(), *hit[with_centre][:1].tolist()] if self.keys[k] != key]


CENTRE, TOLD, ASKS = 0, 1, 2


def _cluster_links(percent: int):
    """Rows sorted by block and role (the centre, one side, the other side) -> links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            links: list[tuple[int, int]] = []
            for k, (cluster, x, y, role, key, tokens) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(6)))):
                found, tokens = _unpack(batch.column(6)[k].as_py()), np.array(sorted(tokens), dtype=np.int64)
                if role == CENTRE:
                    block = _Block((cluster, x, y), (key, found, tokens), percent)
                elif role == TOLD:
                    block.keys.append(key)
                    block.tokens.append(tokens)
                    block.sets.append(found)
                else:
                    links += block.links(key, found, tokens)
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, component: its smallest node) of all nodes in ``links`` (a, b), by alternating star contraction.

    In a round each node's larger neighbours are tied to its smallest neighbour, then
    its smaller ones; it ends when no edge moved, with one edge a node.  Both steps are
    windows over a node's edges, so a round is two shuffles.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    node, ordered = Window.partitionBy("u"), Window.partitionBy("u").orderBy("v", F.desc("moved"))
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", F.min("v").over(node))).filter("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") != F.col("u")).alias("moved"))
        small = large.select("u", "v", "moved", F.row_number().over(ordered).alias("place"), F.first("v").over(ordered).alias("m"),
                             F.lag("v").over(ordered).alias("before"))
        own = F.col("place") == 1  # a node's own edge; the others tie its further neighbours, each once
        small = small.filter(own | ((F.col("v") != F.col("m")) & (F.col("v") != F.col("before"))))
        edges = common.staged(small.select(F.when(own, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"),
                                           F.when(own, F.col("moved")).otherwise(F.lit(True)).alias("moved")), "edges")
        if not edges.agg(F.max("moved")).first()[0]:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class NearDuplicates:
    """The stages of one run; ``signed`` is its only full table, with a signature a row.

    Sets of shingles of so many words are linked at a similarity of so many percent.
    """

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT):
        self.shingle, self.percent, self.matches = shingle, percent, least_matches(percent)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
        self.signed = common.staged(common.map_arrow(
            self.docs, _signed(shingle), "doc_id long, text_hash long, n_shingles long, key long, tokens array<long>"), "signatures")
        self.linked = self.signed.filter("n_shingles > 0 and doc_id is not null")
        self.classes = self.linked.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                                                      F.first("tokens").alias("tokens"))
        self.candidates = common.staged(self._candidates(), "candidates")
        self.sets = self._needed_sets()

    def _candidates(self) -> DataFrame:
        """(key, rep, n, tokens: shared ones by frequency, common: how often they are shared) of classes with enough of them."""
        tokens = self.classes.select("key", "rep", "n", F.explode("tokens").alias("token"))
        shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
        ranked = tokens.join(shared, "token").groupBy("key").agg(
            F.first("rep").alias("rep"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "token"))).alias("t"))
        return ranked.filter(F.size("t") >= self.matches).select(
            "key", "rep", "n", F.transform("t", lambda x: x["token"]).alias("tokens"),
            F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["f"]).alias("common"))

    def _ties(self) -> DataFrame:
        """(a, b): each class of a prefix list with the list's hub."""
        prefix = F.slice("tokens", F.lit(1), F.size("tokens") - (self.matches - 1))
        lists = self.candidates.select(F.explode(prefix).alias("token"), "key")
        hubs = lists.groupBy("token").agg(F.min("key").alias("a"))
        return lists.join(hubs, "token").filter(F.col("a") != F.col("key")).select("a", F.col("key").alias("b"))

    def _needed_sets(self) -> DataFrame:
        """(key, set) of the classes in any list, made from their smallest documents' texts.

        A bit map of fixed size names the needed ids, so that other texts stay out
        of the Python workers; keys decide exactly.
        """
        place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
        needed = self.candidates.select(F.col("rep").alias("doc_id"), "key")
        bits = needed.groupBy(F.floor(place / PIECE).cast("int").alias("_piece")).agg(
            F.bitmap_construct_agg((place % PIECE).cast("long")).alias("_bits"))
        spot = (place % PIECE).cast("int")
        byte = F.conv(F.hex(F.substring("_bits", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        rows = self.docs.filter("doc_id is not null").withColumn("_piece", F.floor(place / PIECE).cast("int"))
        rows = rows.join(F.broadcast(bits), "_piece")  # at most FILTER_BITS / PIECE rows of PIECE bits
        rows = rows.filter(F.getbit(byte, spot % 8) == 1)
        sets = common.map_arrow(rows.select("doc_id", "text"), _full(self.shingle), "key long, set binary")
        sets = sets.join(needed.select("key"), "key", "left_semi").groupBy("key").agg(F.first("set").alias("set"))
        return common.staged(sets, "sets")

    def _cluster_rows(self, cluster: DataFrame) -> DataFrame:
        """Rows of the clusters, dealt to blocks: told rows to every x, asking rows to every y, the centre to all."""
        facts = self.candidates.select("key", "n", "tokens", "common").join(
            cluster.select(F.col("node").alias("key"), F.col("component").alias("cluster")), "key")
        whole = facts.groupBy("cluster").agg(F.max_by("key", F.struct("common", "key")).alias("centre"),
                                             F.ceil(6 * F.sum("n") / BLOCK_BYTES).cast("int").alias("blocks"))
        rows = facts.drop("n", "common").join(whole, "cluster").join(self.sets, "key")
        own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        columns = ["cluster", "x", "y", "role", "key", "tokens", "set"]
        told = rows.withColumn("y", own).withColumn("x", every).withColumn("role", F.lit(TOLD))
        asks = rows.withColumn("x", own).withColumn("y", every).withColumn("role", F.lit(ASKS))
        centre = rows.filter(F.col("key") == F.col("centre")).withColumn("x", every).withColumn("y", every).withColumn("role", F.lit(CENTRE))
        return told.select(*columns).unionByName(asks.select(*columns)).unionByName(centre.select(*columns))

    def links(self) -> DataFrame:
        """(node, component) of the linked classes."""
        rows = self._cluster_rows(components(self._ties()))
        rows = rows.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "role", "key")
        return components(common.map_arrow(rows, _cluster_links(self.percent), "a long, b long"))

    def rows(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept, text_hash: one row a document."""
        member = self.links().withColumnRenamed("node", "key").join(self.candidates.select("key", "rep"), "key")
        least = member.groupBy("component").agg(F.min("rep").alias("_least"))
        reps = self.linked.groupBy("key").agg(F.min("doc_id").alias("rep")).join(
            member.join(least, "component").select("key", "_least"), "key", "left")
        reps = reps.select("key", F.coalesce("_least", "rep").alias("_component"))
        rows = self.signed.select("doc_id", "text_hash", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
                                                                 F.col("key")).alias("key"))
        rows = rows.join(reps, "key", "left")
        component = F.coalesce("_component", "doc_id")
        return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                           F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_hash")


def one_of_each(docs: DataFrame, columns: Sequence[str] = common.DOCUMENT_COLUMNS, shingle: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The documents to keep, with ``columns``: those of a component's smallest id, repeated rows once; all without id."""
    rows = docs.select(*columns).withColumn("_hash", F.xxhash64("text")).withColumn("_doc", F.col("doc_id").cast("long"))
    gone = NearDuplicates(docs, shingle, percent).rows().filter(~F.col("kept")).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
    left = rows.join(gone.distinct(), ["_doc", "_hash"], "left_anti")
    again = Window.partitionBy("_doc", "_hash").orderBy(*columns)
    left = left.withColumn("_again", F.when(F.col("_doc").isNull(), 1).otherwise(F.row_number().over(again)))
    return left.filter("_again = 1").select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: near-duplicate components of all documents."""
    return NearDuplicates(common.read_table(spark, sf_dir, "documents")).rows().drop("text_hash")


ORACLE = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
g AS MATERIALIZED (SELECT DISTINCT rid, doc_id, s FROM (
    SELECT rid, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM t)),
n AS (SELECT t.rid, t.doc_id, count(g.s) AS n FROM t LEFT JOIN g USING (rid) GROUP BY ALL),
p AS (SELECT a.rid AS ra, b.rid AS rb, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
l AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM p JOIN n a ON a.rid = ra JOIN n b ON b.rid = rb WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT u, v FROM l UNION SELECT v, u FROM l),
r(u, v) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c ON c.u = n.doc_id
"""
