"""Trie of conversation prefixes by time-forward processing.

A node is a distinct sequence of first turns.  It is named by a chain of 128-bit
digests, name(d) = digest(name(d - 1), turn d), so one ordered pass over the rows
of a conversation names all its prefixes without a round a level.  Spark counts
the members of every node and finds the smallest.  The conversation that is the
smallest member stands for the node: a second ordered pass emits each node once,
with its parent's name and smallest member.

Subtree totals then travel upward by time-forward processing.  Nodes are dealt
to shards and sorted by shard in reverse level order (deepest first) by Spark's
external sort.  A task runs through them with a priority queue of messages that
are addressed to nodes further on: it takes the messages of the node at hand,
adds them up, and sends the node's totals to its parent.  A shard is a piece of a
subtree: nodes with up to ``WIDTH`` members belong to band 0, up to ``WIDTH ** 2``
to band 1, and so on, and a shard is the part of a band below one topmost node.
So a shard has at most ``WIDTH`` nodes a level, whatever the data; a first turn
shared by a third of all conversations lies in a high band and its subtrees in
many shards.  The totals of shard roots are summed by receiver and enter the
queues of the next bands: as many rounds as ``WIDTH`` has powers below the number of
conversations (six for 10^9).  The queue holds ``QUEUE`` messages; beyond, sorted
runs go to the folders that Spark gives its workers for spilling, which only the
task itself reads.

The digest of a node's own conversations is made in two steps: ids are range
sorted by (node, id) and joined to pieces, so a node where a third of all
conversations end is spread over many tasks, and the pieces, thousands of ids each, are
hashed in order as a stream.

Nulls: a null role or text is empty, a null turn comes first, rows without a
conversation id take part nowhere.  Rows that tie in turn are ordered by the
digest of role and text; repeated rows are repeated turns.  Empty and very long texts are
hashed and counted whole by Spark where they are read and travel no further.
One conversation is one sorted stream of narrow rows in one task, never held.
An empty table gives no nodes.  Columns other than those named are not read.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, mixing

# Fixed values of the rebuilding: conversations by base, turns taken from the base (crc32 of the id modulo this).
BASE, HEADS = 20, 4
# Members of a node of band 0, and the factor from band to band.
WIDTH = 64
# Messages that a queue holds in memory; a part of a run that is read at a time.
QUEUE, RUN = 100_000, 1_000
# A node with more than this part of all rows is joined by broadcast: there can be no more than so many.
HOT = 1024
# Characters of a piece of joined ids.
PIECE = 32_768

ROOT = bytes(16)
NAMED = "conv_id long, depth long, node binary, parent binary, words long, last boolean"
NODES = ("node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, words long, "
         "band int, shard binary, parent_band int, parent_shard binary")
PASSED = ("kind int, band int, shard binary, depth long, node binary, conv_id long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long")
PASSED_TYPES = pa.schema([("kind", pa.int32()), ("band", pa.int32()), ("shard", pa.binary()), ("depth", pa.int64()), ("node", pa.binary()),
                          ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                          ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])
MESSAGE, NODE = 0, 1


def _emit(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of role and text."""
    return F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_id (digest) and words of every turn."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("turn_id"), mixing.n_words(text).alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    return rows.select("conv_id", "turn_id", "words", F.row_number().over(order).cast("long").alias("place"))


def rebuilt(own: DataFrame, base: int = BASE, heads: int = HEADS) -> DataFrame:
    """Conversations that begin with the first turns of their base: conv_id, depth, turn_id, words; depth 0 for each.

    ``own`` is staged.  The heads of a base are at most ``heads`` - 1 turns in one row, and go to fewer than ``2 * base``
    conversations.
    """
    turn = F.struct(F.col("place").alias("depth"), "turn_id", "words")
    at_base = F.col("conv_id") - F.col("conv_id") % base
    first = own.filter((F.col("conv_id") % base == 0) & (F.col("place") < heads)).groupBy(F.col("conv_id").alias("_base"))
    first = first.agg(F.sort_array(F.collect_list(turn)).alias("_heads"))
    takes = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = own.filter("place = 1").select("conv_id", at_base.alias("_base"), takes.cast("int").alias("_takes"))
    convs = convs.join(first, "_base", "left")
    shared = F.slice(F.coalesce("_heads", F.array().cast("array<struct<depth:long,turn_id:binary,words:long>>")), F.lit(1), F.col("_takes"))
    convs = convs.select("conv_id", "_takes", shared.alias("_shared"))
    top = F.array(F.struct(F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("words")))
    begun = convs.select("conv_id", F.inline(F.concat(top, "_shared")))
    rest = own.join(convs, "conv_id").filter(F.col("place") > F.col("_takes"))
    rest = rest.select("conv_id", (F.col("place") - F.col("_takes") + F.size("_shared")).alias("depth"), "turn_id", "words")
    return begun.unionByName(rest)


def _name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, depth) -> the same with the names of node and parent."""
    types = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                       ("words", pa.int64()), ("last", pa.bool_())])
    held = None
    for batch in batches:
        out = []
        for conv_id, depth, turn_id, words in zip(*(c.to_pylist() for c in batch.columns)):
            same = held is not None and held[0] == conv_id
            if held is not None:
                out.append((*held, not same))
            node = blake2b(held[2] + turn_id, digest_size=16).digest() if same else ROOT
            held = (conv_id, depth, node, held[2] if same else None, words)
        if out:
            yield _emit(out, types)
    if held is not None:
        yield _emit([(*held, True)], types)


def named(rows: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, node, parent, words (of the last turn), last; staged."""
    sorted_rows = rows.select("conv_id", "depth", "turn_id", "words").repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return common.staged(common.map_arrow(sorted_rows, _name, NAMED), "trie-prefixes")


def _stand_for(width: int):
    """Prefixes with their node's members, sorted by (conv_id, depth) -> each node once, from its smallest member."""
    types = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                       ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("words", pa.int64()), ("band", pa.int32()),
                       ("shard", pa.binary()), ("parent_band", pa.int32()), ("parent_shard", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, above, band, shard = None, None, None, None
        for batch in batches:
            out = []
            for conv_id, depth, node, parent, words, n, least in zip(*(c.to_pylist() for c in batch.columns)):
                if conv_id != conv:
                    conv, above, band, shard = conv_id, None, None, None
                before = (band, shard)
                here = band_of(n, width)
                if here != band:
                    band, shard = here, node
                if least == conv_id:
                    out.append((node, parent, depth, conv_id, above, n, words, band, shard, *before))
                above = least
            if out:
                yield _emit(out, types)

    return run


def band_of(members: int, width: int = WIDTH) -> int:
    band, most = 0, width
    while members > most:
        band, most = band + 1, most * width
    return band


def nodes_of(prefixes: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each node once, with members, parent, band and shard; staged."""
    members = prefixes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    members = common.staged(members, "trie-members")
    bound = prefixes.count() // HOT
    hot = F.broadcast(members.filter(F.col("n") > bound))  # at most HOT rows: their counts add up to all rows
    # Rows of hot nodes meet their counts where they are; only the others are shuffled by node.
    met = prefixes.join(hot, "node").unionByName(
        prefixes.join(hot, "node", "left_anti").join(members.filter(F.col("n") <= bound), "node"))
    met = met.select("conv_id", "depth", "node", "parent", "words", "n", "least")
    met = met.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return common.staged(common.map_arrow(met, _stand_for(width), NODES), "trie-nodes")


class SpillingQueue:
    """A priority queue of tuples; beyond ``limit`` in memory, sorted runs go to the worker's spill folder."""

    def __init__(self, limit: int):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    def __len__(self) -> int:
        return len(self.heap) + len(self.runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def least(self) -> tuple | None:
        best = self.heap[0] if self.heap else None
        if self.runs and (best is None or self.runs[0][0] < best):
            best = self.runs[0][0]
        return best

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, number, rest = self.runs[0]
            follows = next(rest, None)
            if follows is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (follows, number, rest))
            return item
        return heapq.heappop(self.heap)

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)  # without a name: it goes with the task
        items = sorted(self.heap)
        for start in range(0, len(items), RUN):
            pickle.dump(items[start:start + RUN], file)
        file.seek(0)
        self.heap, self.spilled = [], self.spilled + 1
        rest = self._read(file)
        heapq.heappush(self.runs, (next(rest), self.spilled, rest))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return


def _forward(limit: int):
    """Messages and nodes sorted by (shard, depth from the deepest, node, kind) -> nodes with totals, and messages of shard roots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, current = SpillingQueue(limit), None
        for batch in batches:
            out = []
            for (kind, depth, node, parent, shard, conv_id, parent_conv_id, n, words, parent_band, parent_shard,
                 children, leaves, saved) in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if len(queue):
                        raise ValueError("a message reached no node of its shard")
                    current = shard
                if kind == MESSAGE:
                    queue.push((-depth, node, children, leaves, saved))
                    continue
                children = leaves = 0
                saved = (n - 1) * words
                while (first := queue.least()) is not None and first[:2] == (-depth, node):
                    _, _, c, f, s = queue.pop()
                    children, leaves, saved = children + c, leaves + f, saved + s
                leaves = leaves or 1
                out.append((NODE, None, None, depth, node, conv_id, parent_conv_id, n, children, leaves, saved))
                if parent is None:
                    continue
                if shard == node:
                    out.append((MESSAGE, parent_band, parent_shard, depth - 1, parent, None, None, None, 1, leaves, saved))
                else:
                    queue.push((1 - depth, parent, 1, leaves, saved))
            if out:
                yield _emit(out, PASSED_TYPES)
        if len(queue):
            raise ValueError("a message reached no node of its shard")

    return run


def subtree_totals(nodes: DataFrame, width: int = WIDTH, queue: int = QUEUE) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens of their subtrees: band after band, shards side by side."""
    last = nodes.agg(F.max("band")).first()[0]
    totals, mail = None, None
    none = F.lit(None)
    for band in range(-1 if last is None else last + 1):
        rows = nodes.filter(F.col("band") == band).select(
            F.lit(NODE).alias("kind"), "depth", "node", "parent", "shard", "conv_id", "parent_conv_id", "n_convs", "words", "parent_band",
            "parent_shard", *[none.cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
        if mail is not None:
            here = mail.filter(F.col("band") == band).groupBy("shard", "depth", "node").agg(
                *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
            rows = rows.unionByName(here.select(
                F.lit(MESSAGE).alias("kind"), "depth", "node", none.cast("binary").alias("parent"), "shard",
                *[none.cast("long").alias(c) for c in ("conv_id", "parent_conv_id", "n_convs", "words")], none.cast("int").alias("parent_band"),
                none.cast("binary").alias("parent_shard"), "n_children", "n_leaves", "saved_tokens"))
        rows = rows.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "node", "kind")
        passed = common.staged(common.map_arrow(rows, _forward(queue), PASSED), "trie-band")
        done, sent = passed.filter(F.col("kind") == NODE), passed.filter(F.col("kind") == MESSAGE)
        totals = done if totals is None else totals.unionByName(done)
        mail = sent if mail is None else mail.unionByName(sent)
    if totals is None:
        totals = nodes.sparkSession.createDataFrame([], PASSED)
    return totals.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def _pieces(limit: int):
    """(node, conv_id) sorted -> (node, first id, ids joined by commas) of at most about ``limit`` characters."""
    types = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0
        for batch in batches:
            out = []
            for key, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (key != node or size > limit):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                node, size = key, size + 20
                ids.append(conv_id)
            if out:
                yield _emit(out, types)
        if ids:
            yield _emit([(node, ids[0], ",".join(map(str, ids)))], types)

    return run


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, running = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key == node:
                running.update(b",")
            else:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = key, sha256()
            running.update(ids.encode())
        if out:
            yield _emit(out, types)
    if node is not None:
        yield _emit([(node, running.hexdigest())], types)


def ends(prefixes: DataFrame, piece: int = PIECE) -> DataFrame:
    """node, ends_sha256 of the nodes where conversations end."""
    rows = prefixes.filter("last").select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = common.map_arrow(rows, _pieces(piece), "node binary, first long, ids string")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "first")
    return common.map_arrow(pieces, _hash_pieces, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, width: int = WIDTH, queue: int = QUEUE, piece: int = PIECE) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    own = common.staged(own_turns(conversations), "trie-turns")
    prefixes = named(rebuilt(own))
    totals = subtree_totals(nodes_of(prefixes, width), width, queue)
    return totals.join(ends(prefixes, piece), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the trie of all conversations."""
    return trie(common.read_table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(text, '') AS text,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS tok
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, tok, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
               row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tok) AS place FROM t),
convs AS (SELECT c, c - c % 20 AS base, %CRC% % 4 AS h FROM own WHERE place = 1),
m AS (SELECT convs.c, base, h, count(own.c) AS m FROM convs LEFT JOIN own ON own.c = base AND own.place <= h GROUP BY convs.c, base, h),
r AS (SELECT c, 0 AS d, 'root' AS tok, 0 AS words FROM m
      UNION ALL SELECT m.c, own.place, own.tok, own.words FROM m JOIN own ON own.c = m.base AND own.place <= m.h
      UNION ALL SELECT m.c, own.place - m.h + m.m, own.tok, own.words FROM m JOIN own ON own.c = m.c AND own.place > m.h),
k AS (SELECT c, d, words, sha256(string_agg(tok, ',') OVER (PARTITION BY c ORDER BY d)) AS node, d = max(d) OVER (PARTITION BY c) AS last FROM r),
n AS (SELECT node, d, min(k.c) AS c, count(*) AS n, min(words) AS words,
             string_agg(CASE WHEN k.last THEN CAST(k.c AS VARCHAR) END, ',' ORDER BY k.c) AS ends FROM k GROUP BY node, d),
p AS (SELECT n.*, up.node AS parent FROM n LEFT JOIN k up ON up.c = n.c AND up.d = n.d - 1),
kids AS (SELECT parent, count(*) AS kids FROM p WHERE parent IS NOT NULL GROUP BY parent),
f AS (SELECT p.*, coalesce(kids, 0) AS kids FROM p LEFT JOIN kids ON kids.parent = p.node),
s AS (SELECT up.node, sum((f.n - 1) * f.words) AS saved, count(*) FILTER (WHERE f.kids = 0) AS leaves
      FROM f JOIN k up ON up.c = f.c AND up.d <= f.d GROUP BY up.node)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, pn.c AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs, CAST(f.kids AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN s ON s.node = f.node LEFT JOIN n pn ON pn.node = f.parent
""".replace("%CRC%", common.duckdb_crc32("CAST(c AS VARCHAR)"))
