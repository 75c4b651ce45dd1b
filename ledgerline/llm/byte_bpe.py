"""Byte-level BPE encoding and decoding.

A text is cut by the vocabulary's pattern and each match is merged on its own:
a segment tree over the match's byte positions holds, at its root, the smallest
(rank, position) of all neighbouring pairs, so the leftmost pair of the lowest
rank.  A merge writes three leaves (the merged token, its left neighbour and
the swallowed position) and their paths to the root.  Short matches of a batch
are merged side by side, a row of a numpy array each; long ones one by one.
What a match becomes is remembered up to a bound; only speed depends on that.

A null text is encoded as the empty one (no ids).  Texts of any length are
encoded whole; repeated rows give repeated results; an empty table gives an
empty one.  Columns other than those carried are not read.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

NONE = 1 << 60
# Matches of more bytes than this are merged one by one.
SIDE_BY_SIDE = 64
# Cells of one side-by-side array, and matches remembered a generation.
CELLS = 1 << 18
REMEMBERED = 150_000
# Places of the pair table.
SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS
# Fixed value: Unicode white space.  A text is first cut into words with at most one space in front, and runs of
# white space; no match of the public pattern crosses such a cut, so words can be remembered whole.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def vocabulary(path: str) -> bytes:
    """The rank file's content; it is small and fixed, so it is sent to the tasks as it is."""
    with open(path, "rb") as f:
        return f.read()


def _slots(keys: np.ndarray) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Tokenizer:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, content: bytes, pattern: str, words: str = WORDS):
        import regex

        self.find = regex.compile(pattern).findall
        self.words = re.compile(words).findall
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.slot_keys = np.full(SLOTS, -1, dtype=np.int64)
        self.slot_ranks = np.full(SLOTS, NONE, dtype=np.int64)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        ranks = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        slot = _slots(keys)
        while len(keys):  # of the keys that want a free slot one gets it; the others move on
            free = np.flatnonzero(self.slot_keys[slot] < 0)
            self.slot_keys[slot[free]] = keys[free]
            won = self.slot_keys[slot] == keys
            self.slot_ranks[slot[won]] = ranks[won]
            keys, ranks, slot = keys[~won], ranks[~won], (slot[~won] + 1) & (SLOTS - 1)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs (NONE: no such token), from an open-addressing table."""
        key = left << 32 | right  # negative, so absent, where one side is missing
        slot = _slots(key)
        found = self.slot_keys[slot]
        rank = np.where(found == key, self.slot_ranks[slot], NONE)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            slot_ = (slot[open_] + 1) & (SLOTS - 1)
            slot[open_] = slot_
            found = self.slot_keys[slot_]
            hit = found == key[open_]
            rank[open_[hit]] = self.slot_ranks[slot_[hit]]
            open_ = open_[~hit & (found >= 0)]
        return rank

    def _merge_rows(self, pieces: Sequence[bytes], width: int) -> list[bytes]:
        """Merge many pieces of at most ``width`` bytes (a power of two): row r of each array is piece r."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        place = np.arange(width)
        tok2 = np.full((n, width + 1), -1, dtype=np.int64)  # the last column stands behind the end
        tok2[:, :width][place < sizes[:, None]] = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        tree2 = np.full((n, 2 * width), NONE, dtype=np.int64)
        rank = self._rank_of(tok2[:, :width].ravel(), tok2[:, 1:].ravel()).reshape(n, width)
        tree2[:, width:] = np.where(rank < NONE, rank * width + place, NONE)
        level = width
        while level > 1:
            tree2[:, level // 2:level] = np.minimum(tree2[:, level:2 * level:2], tree2[:, level + 1:2 * level:2])
            level //= 2
        tok, tree = tok2.ravel(), tree2.ravel()
        after = np.tile(np.minimum(np.arange(1, width + 2), width), n)
        before = np.tile(np.arange(-1, width), n)

        rows = np.flatnonzero(tree2[:, 1] < NONE)
        while len(rows):
            row, root = rows * (width + 1), rows * (2 * width)
            best = tree[root + 1]
            at, merged = best & (width - 1), best >> (width.bit_length() - 1)
            gone = after[row + at]
            then = after[row + gone]
            tok[row + at] = merged
            tok[row + gone] = -1
            after[row + at] = then
            before[row + then] = at
            prev = before[row + at]
            has = prev >= 0
            prev = np.where(has, prev, at)
            rank = self._rank_of(merged, tok[row + then])
            leaf = np.where(rank < NONE, rank * width + at, NONE)
            rank = self._rank_of(np.where(has, tok[row + prev], -1), merged)
            leaf_prev = np.where(rank < NONE, rank * width + prev, NONE)
            a, b, c = root + gone + width, root + prev + width, root + at + width
            tree[a], tree[b] = NONE, leaf_prev
            tree[c] = leaf  # last: without a left neighbour, b is c
            a, b, c = gone + width, prev + width, at + width
            for _ in range(width.bit_length() - 1):
                a, b, c = a >> 1, b >> 1, c >> 1
                for node in (a, b, c):
                    child = root + 2 * node
                    tree[root + node] = np.minimum(tree[child], tree[child + 1])
            rows = rows[tree[root + 1] < NONE]
        left = tok2 >= 0
        ids = tok2[left].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
        return [ids[i:j] for i, j in zip([0, *ends[:-1]], ends)]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same tree for one long piece."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        tok = [int(self.single[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * width)
        for i in range(n - 1):
            rank = self.pairs.get(tok[i] << 32 | tok[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, j: int) -> None:
            rank = self.pairs.get(tok[i] << 32 | tok[j]) if j < n else None
            node, value = width + i, NONE if rank is None else rank * width + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] < NONE:
            merged, at = divmod(tree[1], width)
            gone = after[at]
            tok[at], then = merged, after[gone]
            after[at] = then
            if then < n:
                before[then] = at
            put(gone, n)
            tok[gone] = -1
            put(at, then)
            if before[at] >= 0:
                put(before[at], at)
        return [t for t in tok if t >= 0]

    def merge(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = defaultdict(list)
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(p) > SIDE_BY_SIDE:
                out[k] = np.array(self._merge_long(p), dtype="<u4").tobytes()
            else:
                by_width[1 << (len(p) - 1).bit_length()].append(k)
        for width, group in by_width.items():
            step = max(1, CELLS // width)
            for start in range(0, len(group), step):
                part = group[start:start + step]
                for k, ids in zip(part, self._merge_rows([pieces[k] for k in part], width)):
                    out[k] = ids
        return out

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text, as bytes (see ``merge``)."""
        found = [self.words(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = []
        for word in set().union(*found):
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    known[word] = ids
        cut = [self.find(word) for word in new]
        pieces = list(set().union(*cut))
        merged = dict(zip(pieces, self.merge([p.encode() for p in pieces])))
        known.update(zip(new, [b"".join(map(merged.__getitem__, c)) for c in cut]))
        return [b"".join(map(known.__getitem__, words)) for words in found]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _worker(content: bytes, pattern: str, carry: Sequence[str], decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(content, pattern)
        for part in common.slices(batches, 2_000_000):
            ids = tokenizer.encode_batch(part.column(part.num_columns - 1).to_pylist())
            columns = [part.column(k) for k in range(len(carry))] + [pa.array(ids, pa.binary())]
            names = [*carry, "ids"]
            if decoded:
                columns.append(pa.array([tokenizer.decode(x) for x in ids], pa.binary()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, path: str, pattern: str, carry: Sequence[str] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The carried columns, ``ids`` (little-endian unsigned 32-bit) and, if asked, ``decoded`` (bytes made from the ids)."""
    if {"ids", "decoded"} & set(carry):
        raise ValueError("rename carried columns called ids or decoded")
    rows = docs.select(*carry, F.col("text").alias("text") if "text" not in carry else F.col("text").alias("_text"))
    kept = rows.schema.fields[:len(carry)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["ids binary"] + ["decoded binary"] * decoded)
    return common.map_arrow(rows, _worker(vocabulary(path), pattern, list(carry), decoded), schema)


def decode(encoded: DataFrame, path: str, pattern: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``decoded``: the bytes of column ``ids`` (null: none)."""
    content = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(content, pattern)
        for batch in batches:
            ids = batch.column(batch.num_columns - 1).to_pylist()
            done = pa.array([tokenizer.decode(x or b"") for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], done], names=[*carry, "decoded"])

    rows = encoded.select(*carry, "ids")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["decoded binary"])
    return common.map_arrow(rows, run, schema)


def public_vocabulary() -> tuple[str, str]:
    """(path, pattern) of the public rank file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def digests(encoded: DataFrame, *columns: str) -> DataFrame:
    return encoded.select(*columns, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: ids of all documents, decoded again."""
    docs = common.read_table(spark, sf_dir, "documents")
    return digests(encode(docs, *public_vocabulary(), decoded=True), "doc_id")
