"""Substring dedup by recompression.

A text is a sequence of words.  Rounds rename it: a run round turns a maximal
run of one symbol into one symbol, a pair round joins each neighbouring pair
whose left symbol falls on the left side and whose right symbol on the right
side of a partition drawn from the symbols themselves.  Names are 64-bit
fingerprints of what they stand for, so every task of every partition gives
equal sequences equal names without a lookup.  In a round of limit l only
symbols of at most l words take part; whether a border stands at a place thus
depends on the ``REACH`` words to either side at most (the sum of the limits).

So of two equal windows of ``WINDOW`` words, every symbol at least ``REACH``
words inside is the same.  The longest of these (ties: largest name, then the
leftmost) is the window's key symbol, at the same offset in both.  Windows with the same key symbol
occurrence travel as one row under its name; rows meet by name, and windows of
equal offset and equal 48-bit fingerprint count as equal: 112 bits of name and fingerprint are compared, not the words.
Names are made where a slice of the input is read; one shuffle by name is what makes them
meet, and there is no shuffle a round.  Those that also start in
a document of a smaller id are removed with all words they cover.

Skew: rows of equal name and windows inside one slice of the input travel once
(the others are settled on the spot, and dealt by document); equal windows
of a long run are one row; a name with more than ``GROUP`` rows is
settled window by window with Spark's own aggregation and join instead of in
memory.  Nothing is dropped.

Nulls: a null text has no words; a document without id is never smaller, so it
removes nothing, and loses nothing.  Rows that repeat an id are told apart by their text and are never
smaller than each other.  Texts of fewer than ``WINDOW`` words are left alone.
Very long texts are read whole, one at a time.  An empty table gives an empty result.  Columns other than
those carried are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 50
# Rounds: (kind, most words of a symbol that takes part).
ROUNDS = (("run", 1), ("pair", 1), ("pair", 1), ("run", 2), ("pair", 2), ("pair", 2), ("pair", 4))
REACH = sum(limit for _, limit in ROUNDS)
# Rows of one name that are settled in memory.
GROUP = 20_000

_WORDS = re.compile(common.WORD).findall
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
ROW = "name long, doc_id long, text_hash long, place int, offset int, prints binary, settled boolean"
ROW_NAMES = [c.split()[0] for c in ROW.split(", ")]
FOUND = "doc_id long, text_hash long, first int, last int, key long"
FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def parse(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first places of the symbols after all rounds; ``doc`` numbers the document of each word."""
    name, start, doc = words, np.arange(len(words)), doc
    for k, (kind, limit) in enumerate(ROUNDS):
        if len(name) < 2:
            break
        size = np.diff(np.append(start, len(words)))
        active = size <= limit
        near = active[:-1] & active[1:] & (doc[:-1] == doc[1:])
        if kind == "run":
            head = np.append(True, ~(near & (name[:-1] == name[1:])))
            first = np.flatnonzero(head)
            count = np.diff(np.append(first, len(name))).astype(np.uint64)
            one = name[first]
            name = np.where(count == 1, one, common.mix64(one * np.uint64(3) + common.mix64(count + np.uint64(1 + k))))
        else:
            side = (common.mix64(name + np.uint64(977 * (k + 1))) >> np.uint64(40)) & np.uint64(1)
            joined = np.append(near & (side[:-1] == 0) & (side[1:] == 1), False)
            head = np.append(True, ~joined[:-1])
            first = np.flatnonzero(head)
            pair = joined[first]
            right = name[np.minimum(first + 1, len(name) - 1)]
            both = common.mix64(common.mix64(name[first] + np.uint64(2 * k + 1)) * np.uint64(5) + right)
            name = np.where(pair, both, name[first])
        start, doc = start[first], doc[first]
    return name, start


def window_prints(words: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the window from each place (garbage where it leaves the document)."""
    n = len(words) - WINDOW + 1
    power = np.cumprod(np.append(np.uint64(1), np.full(len(words) - 1, _BASE, dtype=np.uint64)))
    sums = np.append(np.uint64(0), np.cumsum(words * power))
    back = np.cumprod(np.append(np.uint64(1), np.full(n - 1, _BASE_INVERSE, dtype=np.uint64)))
    return common.mix64((sums[WINDOW:] - sums[:n]) * back)


def key_symbols(name: np.ndarray, start: np.ndarray, total: int, places: np.ndarray) -> np.ndarray:
    """Index of the key symbol of the window at each place; -1 where no symbol lies far enough inside."""
    stop = np.append(start[1:], total)
    low = np.searchsorted(start, places + REACH)
    high = np.searchsorted(stop, places + WINDOW - REACH, side="right")
    rank = (np.minimum(stop - start, 15).astype(np.uint64) << np.uint64(60)) | (name >> np.uint64(4))
    best = np.where(high > low, 0, -1)
    levels = [np.arange(len(name))]
    width = 1
    while 2 * width <= WINDOW - 2 * REACH:
        a = levels[-1][:-width] if len(levels[-1]) > width else levels[-1][:0]
        b = levels[-1][width:]
        levels.append(np.where(rank[b] > rank[a], b, a))
        width *= 2
    some = np.flatnonzero(high > low)
    span = (high - low)[some]
    level = np.int64(np.log2(span))
    for k, table in enumerate(levels):
        at = some[level == k]
        if len(at):
            a, b = table[low[at]], table[high[at] - (1 << k)]
            best[at] = np.where(rank[b] > rank[a], b, a)
    return best


def _packed(prints: np.ndarray) -> np.ndarray:
    """The low 48 bits of each fingerprint as bytes."""
    return np.ascontiguousarray(prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _unpacked(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _binary(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def _rows(words: np.ndarray, lengths: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> list[np.ndarray] | None:
    """Key-symbol rows of a slice of documents: columns of ROW, with ``prints`` as (bytes, ends)."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    first_of = np.append(0, np.cumsum(lengths))
    if len(words) < WINDOW:
        return None
    places = np.flatnonzero(doc[:len(words) - WINDOW + 1] == doc[WINDOW - 1:])
    if not len(places):
        return None
    prints = window_prints(words)[places]
    name, start = parse(words, doc)
    key = key_symbols(name, start, len(words), places)
    # Windows without a key symbol (inside long runs) stand under their own fingerprint; equal neighbours are one row.
    alone = key < 0
    apart = (prints[1:] != prints[:-1]) | (places[1:] != places[:-1] + 1)
    head = np.append(True, (key[1:] != key[:-1]) | (alone[1:] & apart))
    first = np.flatnonzero(head)
    at, alone = places[first], alone[first]
    named = np.where(alone, prints[first], name[key[first]])
    count = np.diff(np.append(first, len(places)))
    offset = np.where(alone, -count, start[key[first]] - at)
    owner = doc[at]
    carried = np.repeat(~alone, count) | head  # the windows whose fingerprints travel
    # Inside the slice, rows of equal name, offset and windows travel once, for the smallest id.
    inside = np.where(carried, common.mix64(prints ^ (places - np.repeat(at, count)).astype(np.uint64)), np.uint64(0))
    whole = common.mix64(np.add.reduceat(inside, first) + named * np.uint64(7) + np.where(alone, -1, offset).astype(np.uint64)
                         * np.uint64(13) + np.where(alone, 1, count).astype(np.uint64))
    order = np.lexsort((ids[owner], whole))
    new = np.append(True, whole[order][1:] != whole[order][:-1])
    smallest = ids[owner][order][np.flatnonzero(new)][np.cumsum(new) - 1]
    settled = np.zeros(len(first), dtype=bool)
    settled[order] = ids[owner][order] > smallest
    # Settled rows say how many windows go; neighbours are joined, and they are dealt by document, not by name.
    offset = np.where(settled, count, offset)
    join = np.append(False, settled[1:] & settled[:-1] & (at[1:] == at[:-1] + count[:-1]))
    rows = np.flatnonzero(~join)
    offset = np.where(settled[rows], np.add.reduceat(count, rows), offset[rows])
    sent = np.where(settled, 0, np.where(alone, 1, count))[rows]
    raw = prints[np.repeat(~settled, count) & carried]
    own = common.mix64(ids[owner].astype(np.uint64) ^ hashes[owner].view(np.uint64))
    named = np.where(settled, own, named)
    columns = [named.view(np.int64), ids[owner], hashes[owner], (at - first_of[owner]).astype(np.int32)]
    return [*(c[rows] for c in columns), offset.astype(np.int32), (_packed(raw), 6 * np.cumsum(sent)), settled[rows]]


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) -> key-symbol rows.

    A settled row has its number of windows as offset; a row of equal windows without key symbol minus their number.
    """
    cache = common.WordHashes()
    for part in common.slices(batches, 2_000_000):
        words, lengths = [], []
        for text in part.column(2).to_pylist():
            found = _WORDS(text)
            words.append(cache.array(found))
            lengths.append(len(found))
        made = _rows(np.concatenate(words), np.array(lengths), np.asarray(part.column(0), dtype=np.int64),
                     np.asarray(part.column(1), dtype=np.int64))
        if made is not None:
            name, ids, hashes, place, offset, (raw, ends), settled = made
            yield pa.RecordBatch.from_arrays(
                [pa.array(name), pa.array(ids), pa.array(hashes), pa.array(place), pa.array(offset), _binary(raw, ends),
                 pa.array(settled)], names=ROW_NAMES)


class Rows:
    """Columns of key-symbol rows, sorted by name and id."""

    def __init__(self, batch: pa.RecordBatch):
        self.name, self.doc, self.text_hash = (np.asarray(batch.column(k), dtype=np.int64) for k in range(3))
        self.place, self.offset = (np.asarray(batch.column(k), dtype=np.int64) for k in (3, 4))
        self.equal = np.maximum(1, -self.offset)  # windows that one fingerprint stands for
        self.offset = np.maximum(-1, self.offset)
        self.prints = batch.column(5)
        self.settled = np.asarray(batch.column(6).to_numpy(zero_copy_only=False), dtype=bool)

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number in the row, fingerprint) of all windows of the rows asked for."""
        chosen = self.prints.take(pa.array(rows))
        chunks = np.frombuffer(b"".join(chosen.to_pylist()), dtype=np.uint8)
        counts = np.fromiter((len(x) // 6 for x in chosen.to_pylist()), dtype=np.int64, count=len(rows))
        row = np.repeat(rows, counts)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        return row, inside, _unpacked(chunks)

    def keys(self, row: np.ndarray, inside: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """One 64-bit key for name, offset and fingerprint."""
        name = self.name[row].view(np.uint64)
        return common.mix64(common.mix64(name) * np.uint64(3) + ((self.offset[row] - inside + 64).astype(np.uint64) << np.uint64(48)) + prints)

    def found(self, row: np.ndarray, inside: np.ndarray) -> pa.RecordBatch:
        """Runs of removed windows: places of the first and the last one."""
        new = np.append(True, (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1)) if len(row) else np.zeros(0, dtype=bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1 if len(first) else first
        at = self.place[row] + inside
        return _found(self.doc[row][first], self.text_hash[row][first], at[first], (at + self.equal[row] - 1)[last], None)


def _found(doc: np.ndarray, text_hash: np.ndarray, first: np.ndarray, last: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
    keys = pa.array(key.view(np.int64)) if key is not None else pa.nulls(len(doc), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(text_hash, pa.int64()), pa.array(first.astype(np.int32)),
                                       pa.array(last.astype(np.int32)), keys], names=FOUND_NAMES)


def _settle(group_rows: int):
    """Rows sorted by name and id -> runs of removed windows, and open windows (with a key) of names with more rows than that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last name so far
        open_name: int | None = None  # a name that has outgrown memory

        def whole(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = Rows(part)
            new = np.append(True, rows.name[1:] != rows.name[:-1])
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(new)) - 1
            shared = (rows.doc[first] < rows.doc[last])[group]  # ids are sorted inside a name
            chosen = np.flatnonzero(shared)
            if len(chosen):
                row, inside, prints = rows.windows(chosen)
                key = rows.keys(row, inside, prints)
                order = np.argsort(key, kind="stable")  # rows stay sorted by id
                head = np.append(True, key[order][1:] != key[order][:-1])
                smallest = rows.doc[row[order]][np.flatnonzero(head)][np.cumsum(head) - 1]
                removed = np.zeros(len(row), dtype=bool)
                removed[order] = rows.doc[row[order]] > smallest
                yield rows.found(row[removed], inside[removed])

        def unsettled(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = Rows(part)
            row, inside, prints = rows.windows(np.arange(part.num_rows))
            at = rows.place[row] + inside
            return _found(rows.doc[row], rows.text_hash[row], at, at + rows.equal[row] - 1, rows.keys(row, inside, prints))

        for batch in batches:
            settled = batch.column(6)
            done = batch.filter(settled)
            if done.num_rows:
                place, count = (np.asarray(done.column(k), dtype=np.int64) for k in (3, 4))
                yield _found(np.asarray(done.column(1)), np.asarray(done.column(2)), place, place + count - 1, None)
            batch = batch.filter(pc.invert(settled))
            if open_name is not None and batch.num_rows:
                lead = int(np.searchsorted(np.asarray(batch.column(0)), open_name, side="right"))
                if lead:
                    yield unsettled(batch.slice(0, lead))
                    batch = batch.slice(lead)
            if not batch.num_rows:
                continue
            open_name = None
            batch = _joined([*held, batch])
            names = np.asarray(batch.column(0))
            tail = int(np.searchsorted(names, names[-1]))
            if tail:
                yield from whole(batch.slice(0, tail))
            held = [batch.slice(tail)]
            if held[0].num_rows > group_rows:
                yield unsettled(held[0])
                held, open_name = [], int(names[-1])
        if held:
            yield from whole(held[0])

    return run


def _joined(parts: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(list(parts)).combine_chunks()
    return table.to_batches()[0] if table.num_rows else parts[0]


def key_rows(docs: DataFrame) -> DataFrame:
    """Windows under the names of their key symbols, with the rows of a name together."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    symbols = common.map_arrow(rows, _symbols, ROW)
    return symbols.repartition("name").sortWithinPartitions("name", "doc_id")


def repeated_windows(docs: DataFrame, group_rows: int = GROUP) -> DataFrame:
    """doc_id, text_hash, first, last: runs of windows (by the place of their first word) to remove."""
    found = common.staged(common.map_arrow(key_rows(docs), _settle(group_rows), FOUND), "repeats")
    unsettled = found.filter("key is not null")
    smallest = unsettled.groupBy("key").agg(F.min("doc_id").alias("_least"))
    late = unsettled.join(smallest, "key").filter(F.col("doc_id") > F.col("_least"))
    return found.filter("key is null").drop("key").unionByName(late.select("doc_id", "text_hash", "first", "last"))


def _cut(carry: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, 2_000_000, "_text"):
            out, totals, gone = [], [], []
            n = part.num_columns
            for text, runs in zip(part.column(n - 2).to_pylist(), part.column(n - 1).to_pylist()):
                words = _WORDS(text or "")
                if runs:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    for r in runs:
                        edge[r["first"]] += 1
                        edge[r["last"] + WINDOW] -= 1
                    kept = [w for w, cover in zip(words, np.cumsum(edge).tolist()) if not cover]
                else:
                    kept = words
                out.append(" ".join(kept))
                totals.append(len(words))
                gone.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays([*part.columns[:n - 2], pa.array(out, pa.string()), pa.array(totals, pa.int64()),
                                              pa.array(gone, pa.int64())], names=[*carry, "kept", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, carry: Sequence[str] = ("doc_id",), group_rows: int = GROUP) -> DataFrame:
    """The carried columns, ``kept`` (words left, joined by a space), ``n_words`` and ``n_removed`` of each document."""
    if {"kept", "n_words", "n_removed"} & set(carry):
        raise ValueError("rename carried columns called kept, n_words or n_removed")
    found = repeated_windows(docs, group_rows).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("first", "last")).alias("_runs"))
    rows = docs.select(*carry, F.col("text").alias("_text"), F.col("doc_id").cast("long").alias("_doc"),
                       F.xxhash64("text").alias("_text_hash"))
    joined = rows.join(found, (F.col("_doc") == F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left")
    joined = joined.select(*[F.col(c) for c in carry], "_text", "_runs")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:len(carry)]]
    return common.map_arrow(joined, _cut(list(carry)), ", ".join([*kept, "kept string, n_words long, n_removed long"]))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: repeated windows of 50 words over all documents."""
    out = remove_repeats(common.read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t),
g AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
r AS (SELECT g.rid, g.i FROM g JOIN m USING (s) WHERE g.doc_id > m.least),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS i FROM r),
x AS (SELECT rid, list(i) AS gone FROM c GROUP BY rid)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(len(x.gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN x.gone IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda a, i: NOT list_contains(x.gone, i)), ' ') END) AS kept_sha256
FROM t LEFT JOIN x USING (rid)
"""
