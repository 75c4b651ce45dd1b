"""Hierarchical Pitman-Yor language model, and scores of texts under it.

Tokens are the words of a text (A-Z lowered) and one end.  A token sits in the
restaurant of its context: the word before it (or the start), hashed into
``CONTEXTS`` restaurants, a fixed number.  All of them share one parent, the
restaurant without context, whose base is uniform over the V known tokens and
one unknown.  With c customers and t tables of a token in a restaurant of C and T,

    P(token | context) = (c - d t) / (s + C) + (s + d T) / (s + C) * P_parent(token),

and the parent's customers are the contexts' tables.

Seating is sampled in sweeps.  A sweep seats all customers of a token and context anew: with
weight w = (s + d T) * P_parent(token) of a new table, T and P_parent those of the last sweep, t
tables have odds S(c, t) w^t (S: generalised Stirling numbers).  These are the odds that
steps of one customer, who leaves and joins tables with c - d t or a new one with w, settle at.  The
parent's customers, the tables, are seated anew likewise.  Probabilities are averaged
over the last ``SAMPLES`` of ``SWEEPS`` seatings.

Counts go to buckets of tokens, where all contexts of a token meet, and the pairs with more than one
customer are staged, a row a bucket.  A sweep is one Spark job over them: restaurants' tables and the
parent's customers and tables are summed over all buckets, so every sweep uses the exact totals of the
one before.  A draw is a hash of token, context and sweep put through the quantiles of its odds.  So a seating
follows from counts and totals alone: tasks repeat it instead of storing it, and neither the number of buckets nor
the order of rows changes a score (beyond rounding).  The totals are a table of fixed size.

Counts are pre-aggregated by slice of the input and merged as they arrive, so a task holds the
distinct pairs of its bucket and no more (a token has at most ``CONTEXTS`` of them).  The last pass sends counts and
positions to the buckets and returns sums per document; positions stream through and are never held, and a bucket
with a very frequent token is dealt to several tasks, each with the counts.

Texts of any length are handled whole.  Null texts are empty: one end token.  Rows without id are learned from and
scored like others.  Repeated rows get equal scores and count as often as they
appear.  An empty table gives an empty result; where nothing is learned, every
token is unknown.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The fold that is held out.
FOLDS, HELD = 7, 2
# Restaurants (a context has 16 bits), and discount and strength of contexts and parent.
CONTEXTS = 65_536
DISCOUNT, STRENGTH = 0.8, 20.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 10.0
# Sweeps, and how many of the last ones are samples.
SWEEPS, SAMPLES = 8, 3
# Tokens a bucket, characters a slice, rows a slice (places in a slice have 16 bits).
BUCKET_TOKENS, SLICE_CHARS, SLICE_ROWS = 3_000_000, 8_000_000, 60_000
# Counts waiting to be merged (or as many as are merged already, if those are more).
WAITING = 4_000_000
# Up to so many customers odds come from Stirling numbers, above from their limits.
STIRLING = 128
# Buckets with more than this share of all tokens may be dealt to several tasks; there are at most 1024.
LARGE = 1024

_WORDS = re.compile(common.WORD.encode()).findall
END, START = np.uint64(0x8F1BBCDC62A0E3B1), np.uint64(0x2545F4914F6CDD1D)
SENT = "bucket long, part int, kind int, slice long, data binary"
SENT_NAMES = [c.split()[0] for c in SENT.split(", ")]
COUNTS, POSITIONS, HEADER = 0, 1, 2


def pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], dtype="<i8").tobytes()
    return b"".join([sizes, *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(raw: bytes, *dtypes: str) -> list[np.ndarray]:
    at, out = 8 * len(dtypes), []
    for size, dtype in zip(np.frombuffer(raw, dtype="<i8", count=len(dtypes)).tolist(), dtypes):
        out.append(np.frombuffer(raw, dtype=dtype, count=size // np.dtype(dtype).itemsize, offset=at))
        at += size
    return out


def bucket_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (common.mix64(tokens ^ START) >> np.uint64(11)).astype(np.int64) % buckets


class _Places(dict):
    """Places of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class _Slice:
    """Tokens of a slice of documents: keys (place of the token, context), with tokens placed by bucket."""

    def __init__(self, part: pa.RecordBatch, buckets: int):
        places, arrays = _Places(), []
        places[None] = 0  # the end
        end = np.zeros(1, dtype=np.int64)
        for text in part.column(2).to_pylist():
            words = _WORDS(text.encode("utf-8", "surrogatepass").lower()) if text else []
            arrays += [np.fromiter(map(places.__getitem__, words), dtype=np.int64, count=len(words)), end]
        token = np.concatenate(arrays)
        self.lengths = np.fromiter(map(len, arrays), dtype=np.int64, count=len(arrays)).reshape(-1, 2).sum(axis=1)
        self.learned = np.asarray(part.column(1).to_numpy(zero_copy_only=False), dtype=bool)
        del places[None]
        word = np.append(END, np.fromiter(map(xxhash.xxh3_64_intdigest, places), dtype=np.uint64, count=len(places)))
        bucket = bucket_of(word, buckets)
        order = np.argsort(bucket, kind="stable")
        self.word, self.bucket, rank = word[order], bucket[order], np.empty(len(word), dtype=np.int64)
        rank[order] = np.arange(len(word))
        restaurant = (common.mix64(np.append(word, START)) >> np.uint64(17)).astype(np.int64) % CONTEXTS
        before = np.append(len(word), token[:-1])
        before[np.cumsum(self.lengths) - self.lengths] = len(word)  # the start
        self.key = rank[token] * CONTEXTS + restaurant[before]

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys in order, their documents)."""
        order = np.argsort(self.key)
        return self.key[order], np.repeat(np.arange(len(self.lengths)), self.lengths)[order]

    def learned_keys(self) -> np.ndarray:
        return np.sort(self.key[np.repeat(self.learned, self.lengths)])

    def counts(self, key: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(bucket, counts of tokens by context) for each bucket, of learned keys in order."""
        new = np.append(True, key[1:] != key[:-1])[:len(key)]
        new[::60_000] = True  # a count has 16 bits; entries that repeat are summed later
        first = np.flatnonzero(new)
        count, key = np.diff(np.append(first, len(key))).astype("<u2"), key[first]
        for b, x in self._parts(key):
            yield b, pack(*self._tokens(key[x]), (key[x] % CONTEXTS).astype("<u2"), count[x])

    def positions(self, key: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for b, x in self._parts(key):
            yield b, pack(*self._tokens(key[x]), (key[x] % CONTEXTS).astype("<u2"), doc[x].astype("<u2"))

    def _tokens(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _runs(self.word[key // CONTEXTS])

    def _parts(self, key: np.ndarray) -> Iterator[tuple[int, slice]]:
        first = np.flatnonzero(np.append(True, self.bucket[1:] != self.bucket[:-1]))
        ends = np.searchsorted(key, np.append(first[1:], len(self.bucket)) * CONTEXTS).tolist()
        for b, start, end in zip(self.bucket[first].tolist(), [0, *ends], ends):
            if end > start:
                yield b, slice(start, end)


def _runs(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    return token[first].astype("<u8"), np.diff(np.append(first, len(token))).astype("<u4")


def _sent(rows: Sequence[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=SENT_NAMES)


def _send(buckets: int, tasks: dict[int, int] | None):
    """(doc_id, learned, text) -> counts by bucket; with ``tasks`` (tasks of large buckets) positions and headers as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        here = TaskContext.get().partitionId() << 32  # the same again when a task is repeated
        for large in common.slices(batches, SLICE_CHARS):
            for start in range(0, large.num_rows, SLICE_ROWS):
                part = large.slice(start, SLICE_ROWS)
                tokens, name = _Slice(part, buckets), here + ordinal
                ordinal += 1
                if tasks is None:
                    yield _sent([(b, 0, COUNTS, name, data) for b, data in tokens.counts(tokens.learned_keys())])
                else:
                    key, doc = tokens.order()
                    rows = []
                    for b, data in tokens.counts(key[tokens.learned[doc]]):
                        rows += [(b, k, COUNTS, name, data) for k in range(tasks.get(b, 1))]
                    rows += [(b, name % tasks.get(b, 1), POSITIONS, name, data) for b, data in tokens.positions(key, doc)]
                    ids = part.column(0)
                    known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), dtype=np.uint8)
                    header = pack(np.asarray(ids.fill_null(0), dtype="<i8"), known, tokens.lengths.astype("<i8"))
                    rows.append((-1 - name, 0, HEADER, name, header))
                    yield _sent(rows)

    return run


def _stirling(discount: float, known: dict = {}) -> np.ndarray:  # noqa: B006  (remembered by discount)
    """Logarithms of the generalised Stirling numbers S(c, t)."""
    if discount not in known:
        log = np.full((STIRLING + 1, STIRLING + 1), -np.inf)
        log[0, 0] = 0.0
        t = np.arange(STIRLING + 1)
        for c in range(1, STIRLING + 1):
            join = np.where(c - 1 - discount * t > 0, c - 1 - discount * t, np.nan)
            log[c, 1:] = log[c - 1, :-1]
            log[c] = np.logaddexp(log[c], np.where(np.isnan(join), -np.inf, log[c - 1] + np.log(np.where(np.isnan(join), 1, join))))
        known[discount] = log
    return known[discount]


def draws(word: np.ndarray, context: np.ndarray | int, step: int) -> np.ndarray:
    """Numbers in (0, 1) by token, context (-1: the parent) and sweep."""
    place = common.mix64(np.atleast_1d(context).astype(np.int64).astype(np.uint64) * np.uint64(1024) + np.uint64(step))
    return ((common.mix64(word ^ place) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def seat(draw: np.ndarray, c: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Tables of c customers at quantile ``draw`` of the odds S(c, t) weight^t: exactly up to ``STIRLING`` customers.

    Above, the limit: S(c, t) weight^t / c! is the part x^c of (weight g(x))^t / t! with g(x) = (1 -
    (1-x)^d) / d, so beside one customer's table there are about Poisson(weight g(x)) others, with the x
    at which c customers are expected, less spread as c is given.  Means are right within a few percent.
    """
    t = np.minimum(c, 1)
    order = np.argsort(c, kind="stable")
    ends = np.searchsorted(c[order], np.arange(1, STIRLING + 1), side="right")
    for n in range(2, STIRLING + 1):
        log, places = _stirling(discount)[n, 1:n + 1], np.arange(1, n + 1)
        for start in range(ends[n - 2], ends[n - 1], 2_000_000 // n):
            use = order[start:min(start + 2_000_000 // n, ends[n - 1])]
            odds = log + np.log(weight[use])[:, None] * places
            odds = np.cumsum(np.exp(odds - odds.max(axis=1, keepdims=True)), axis=1)
            t[use] = 1 + (odds < (draw[use] * odds[:, -1])[:, None]).sum(axis=1)
    use = order[ends[-1]:]
    if len(use):
        n, w = c[use].astype(float), weight[use]
        low, high = np.full(len(use), -700.0), np.zeros(len(use))  # of log(1 - x)
        for _ in range(64):
            middle = (low + high) / 2
            more = w * -np.expm1(middle) > n * np.exp((1 - discount) * middle)  # w x (1-x)^(d-1) customers are expected
            low, high = np.where(more, middle, low), np.where(more, high, middle)
        x, rest = -np.expm1(high), np.exp(high)
        mean = -w * np.expm1(discount * high) / discount
        p = np.clip(n * rest / (rest + x * (1 - discount)) / mean, 0.0, 1.0)  # spread lost
        t[use] = np.minimum(c[use], 1 + _others(draw[use], mean, p))
    return t


def _others(draw: np.ndarray, mean: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Quantiles of a binomial of this mean and odds p (Poisson where p is small), of its normal limit above a mean of 50."""
    whole = np.floor(draw * 2.0 ** 24)
    angle = draw * 2.0 ** 24 - whole
    normal = np.sqrt(-2 * np.log((whole + 0.5) / 2.0 ** 24)) * np.cos(2 * np.pi * angle)
    out = np.maximum(0, np.rint(mean + normal * np.sqrt(mean * (1 - p)))).astype(np.int64)
    few = np.flatnonzero(mean <= 50)
    mean, p, draw = mean[few], p[few], draw[few]
    poisson = p < 0.01
    tries = np.where(poisson, np.inf, np.maximum(1, np.round(mean / np.maximum(p, 0.01))))
    p = np.where(poisson, 0.0, np.minimum(0.999, mean / tries))
    with np.errstate(invalid="ignore"):
        term = np.exp(np.where(poisson, -mean, np.where(poisson, 0.0, tries) * np.log1p(-p)))
        below, t, k = term.copy(), np.zeros(len(few), dtype=np.int64), 0
        while (more := (below < draw) & (k < tries)).any() and k < 1000:
            term = np.where(poisson, term * mean / (k + 1), np.where(more, term * (tries - k) / (k + 1) * p / (1 - p), 0.0))
            below, t, k = below + term, t + more, k + 1
    out[few] = t
    return out


class Totals:
    """What is known over all buckets after a sweep: a fixed number of sums."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, parent: tuple[int, int], words: int):
        self.customers, self.tables, self.parent, self.words = customers, tables, parent, words
        self.tokens = int(customers.sum())
        self.uniform = 1.0 / (words + 1)
        # A new table's weight in the parent, the parent's denominator, and the share of the parent by context.
        self.new = (PARENT_STRENGTH + PARENT_DISCOUNT * parent[1]) * self.uniform
        self.everyone = PARENT_STRENGTH + parent[0]
        self.back = (STRENGTH + DISCOUNT * tables) / (STRENGTH + customers)

    def next(self, tables: np.ndarray, parent: tuple[int, int]) -> Totals:
        return Totals(self.customers, tables, parent, self.words)


class Counts:
    """Distinct (token, context) pairs of one bucket with their customers, merged as they arrive."""

    def __init__(self, blobs: Iterable[bytes] = ()):
        self.words, self.key, self.c = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self._waiting, self._size = [], 0
        for blob in blobs:
            self.add(blob)

    def add(self, blob: bytes) -> None:
        word, runs, context, count = unpack(blob, "<u8", "<u4", "<u2", "<u2")
        self._waiting.append((word, runs, context, count))
        self._size += len(context)
        if self._size > max(WAITING, len(self.key)):
            self.merge()

    def merge(self) -> Counts:
        if not self._waiting:
            return self
        old = np.bincount(self.key // CONTEXTS, minlength=len(self.words))
        words, runs, context, count = (np.concatenate(x) for x in zip(
            (self.words, old, self.key % CONTEXTS, self.c), *((w, r, u, n.astype(np.int64)) for w, r, u, n in self._waiting)))
        self._waiting, self._size = [], 0
        self.words, word = np.unique(words, return_inverse=True)
        key = np.repeat(word, runs.astype(np.int64)) * CONTEXTS + context.astype(np.int64)
        order = np.argsort(key)
        key, count = key[order], count[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.key, self.c = key[first], np.add.reduceat(count, first)
        return self


def start(c: np.ndarray, discount: float) -> np.ndarray:
    """Tables before the first sweep."""
    return np.minimum(c, np.maximum(1, np.round(c ** (discount / 2)).astype(np.int64)))


class Seating:
    """Sampled tables of one bucket: of the pairs with more than one customer, the others have one table."""

    def __init__(self, words: np.ndarray, once: np.ndarray, word: np.ndarray, context: np.ndarray, c: np.ndarray):
        self.words, self.once, self.word, self.context, self.c = words, once.astype(np.int64), word, context, c
        self.t = start(c, DISCOUNT)
        self.sat = self._sat()
        self.parent_t = start(self.sat, PARENT_DISCOUNT)

    @staticmethod
    def of(counts: Counts) -> Seating:
        many, word = counts.c > 1, counts.key // CONTEXTS
        return Seating(counts.words, np.bincount(word[~many], minlength=len(counts.words)), word[many],
                       counts.key[many] % CONTEXTS, counts.c[many])

    def more(self) -> np.ndarray:
        """Tables by context beyond those before the first sweep."""
        return np.bincount(self.context, weights=self.t - start(self.c, DISCOUNT), minlength=CONTEXTS).astype(np.int64)

    def _sat(self) -> np.ndarray:
        return self.once + np.bincount(self.word, weights=self.t, minlength=len(self.words)).astype(np.int64)

    def sweeps(self, history: Sequence[Totals]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables of the pairs, the parent's customers and tables) after each sweep, each by the totals before it."""
        for step, totals in enumerate(history):
            parent = (self.sat - PARENT_DISCOUNT * self.parent_t + totals.new) / totals.everyone
            weight = (STRENGTH + DISCOUNT * totals.tables[self.context]) * parent[self.word]
            self.t = seat(draws(self.words[self.word], self.context, step), self.c, weight, DISCOUNT)
            self.sat = self._sat()
            self.parent_t = seat(draws(self.words, -1, step), self.sat, np.full(len(self.words), totals.new), PARENT_DISCOUNT)
            yield self.t, self.sat, self.parent_t


class Scorer:
    """Average probabilities of one bucket's tokens."""

    def __init__(self, counts: Counts, history: Sequence[Totals]):
        """``history``: totals before the first sweep and after each."""
        self.words, self.key, self.last = counts.words, counts.key, history[-1]
        word, context = counts.key // CONTEXTS, counts.key % CONTEXTS
        self.total = np.bincount(word, weights=counts.c, minlength=len(self.words)).astype(np.int64)
        self.samples = history[-SAMPLES:]
        self.unknown = np.array([s.new / s.everyone for s in self.samples])
        self.parent = np.zeros((SAMPLES, len(self.words)))
        tables, many = np.ones(len(counts.c)), counts.c > 1
        tables[many] = 0
        for step, (t, sat, parent_t) in enumerate(Seating.of(counts).sweeps(history[:-1])):
            k = step - (len(history) - 1 - SAMPLES)
            if k >= 0:
                tables[many] += t / SAMPLES
                self.parent[k] = (sat - PARENT_DISCOUNT * parent_t) / self.samples[k].everyone + self.unknown[k]
        self.own = (counts.c - DISCOUNT * tables) / (STRENGTH + self.last.customers[context])

    def sums(self, data: bytes) -> bytes:
        """Packed (places of documents, known tokens, base sums, score sums) of one slice's positions."""
        word, runs, context, doc = unpack(data, "<u8", "<u4", "<u2", "<u2")
        context = context.astype(np.int64)
        at, seen = np.zeros(len(word), dtype=np.int64), np.zeros(len(word), dtype=bool)
        count, parent = np.zeros(len(word), dtype=np.int64), np.repeat(self.unknown[:, None], len(word), axis=1)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            seen = self.words[at] == word
            count, parent = np.where(seen, self.total[at], 0), np.where(seen, self.parent[:, at], parent)
        index = np.repeat(np.arange(len(word)), runs)
        p = np.zeros(len(index))
        for s, sample in enumerate(self.samples):
            p += sample.back[context] * parent[s][index]
        p /= SAMPLES
        if len(self.key):
            key = at[index] * CONTEXTS + context
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            p += np.where(seen[index] & (self.key[place] == key), self.own[place], 0.0)
        base = np.log10((count + 1) / (self.last.tokens + self.last.words + 1))[index]
        docs = doc.astype(np.int64)
        n = int(docs.max()) + 1
        there = np.flatnonzero(np.bincount(docs, minlength=n))
        sums = [np.bincount(docs, weights=x, minlength=n)[there] for x in (seen[index], base, np.log10(p))]
        return pack(there.astype("<u2"), sums[0].astype("<u4"), sums[1].astype("<f8"), sums[2].astype("<f8"))


SUMS = "kind int, place long, value long"
# Kinds of sums: customers and tables by context (tables of sweeps: beyond the first), the parent's both and words, tokens of a bucket.
CUSTOMERS, TABLES, PARENT, SIZE = range(4)


def _sums(kind: int, values: np.ndarray, places: np.ndarray | None = None) -> pa.RecordBatch:
    places = np.flatnonzero(values) if places is None else places
    values = values[places] if len(values) != len(places) else values
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(places), kind, dtype=np.int32)), pa.array(places.astype(np.int64)),
                                       pa.array(values.astype(np.int64))], names=["kind", "place", "value"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts sorted by bucket -> a row a bucket, with what its sweeps and the first totals need."""
    name, counts = None, None

    def done() -> pa.RecordBatch:
        counts.merge()
        s = Seating.of(counts)
        pairs = counts.key % CONTEXTS
        by_context = (np.bincount(pairs, weights=x, minlength=CONTEXTS).astype(np.int64) for x in (counts.c, start(counts.c, DISCOUNT)))
        data = pack(s.words, s.once.astype("<u4"), s.word.astype("<u4"), s.context.astype("<u2"), s.c.astype("<i8"))
        first = pack(*by_context, np.array([s.sat.sum(), s.parent_t.sum(), len(s.words), counts.c.sum()]))
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([first], pa.binary()), pa.array([data], pa.binary())],
                                          names=["bucket", "first", "data"])

    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != name:
                if counts is not None:
                    yield done()
                name, counts = bucket, Counts()
            counts.add(data.as_py())
    if counts is not None:
        yield done()


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, first) -> sums before the first sweep, added up over the buckets of a task."""
    by_context, parent = np.zeros((2, CONTEXTS), dtype=np.int64), np.zeros(3, dtype=np.int64)
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            *two, (*sums, tokens) = unpack(data.as_py(), "<i8", "<i8", "<i8")
            by_context += two
            parent += sums
            yield _sums(SIZE, np.array([tokens]), np.array([bucket]))
    yield _sums(CUSTOMERS, by_context[0])
    yield _sums(TABLES, by_context[1])
    yield _sums(PARENT, parent)


def _sweep(history: Sequence[Totals]):
    """Staged buckets -> sums after one more sweep, added up over the buckets of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, parent = np.zeros(CONTEXTS, dtype=np.int64), np.zeros(3, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0):
                words, once, word, context, c = unpack(data.as_py(), "<u8", "<u4", "<u4", "<u2", "<i8")
                context = context.astype(np.int64)
                seating = Seating(words, once, word.astype(np.int64), context, c)
                for _ in seating.sweeps(history):
                    pass
                tables += seating.more()
                parent += seating.sat.sum(), seating.parent_t.sum(), 0
        yield _sums(TABLES, tables)
        yield _sums(PARENT, parent)

    return run


def _collected(sums: DataFrame) -> dict[int, np.ndarray]:
    """Sums by kind, of a fixed number of places."""
    out = {CUSTOMERS: np.zeros(CONTEXTS, dtype=np.int64), TABLES: np.zeros(CONTEXTS, dtype=np.int64), PARENT: np.zeros(3, dtype=np.int64)}
    got = sums.groupBy("kind", "place").agg(F.sum("value").alias("value")).toArrow()
    kind, place, value = (c.to_numpy() for c in got.columns)
    for k, array in out.items():
        array[place[kind == k]] = value[kind == k]
    return out


def _score(history: Sequence[Totals]):
    """Rows sorted by bucket, part and kind -> (slice, kind, data): headers and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, counts, scorer = None, None, None
        for batch in batches:
            out = []
            for k, (bucket, part, kind, slice_) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                data = batch.column(4)[k].as_py()
                if kind == HEADER:
                    out.append((slice_, 0, data))
                    continue
                if (bucket, part) != name:
                    name, counts, scorer = (bucket, part), Counts(), None
                if kind == COUNTS:
                    counts.add(data)
                    continue
                if scorer is None:
                    scorer, counts = Scorer(counts.merge(), history), None
                out.append((slice_, 1, scorer.sums(data)))
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))],
                                             names=["slice", "kind", "data"])

    return run


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice, header first -> a row a document."""
    ids = known_ids = lengths = sums = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=known_ids == 0), pa.array(lengths), pa.array(sums[0].astype(np.int64)),
             pa.array(sums[1]), pa.array(sums[2])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        for kind, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if kind == 0:
                if ids is not None:
                    yield done()
                ids, known_ids, lengths = unpack(data, "<i8", "u1", "<i8")
                sums = np.zeros((3, len(ids)))
            else:
                at, *parts = unpack(data, "<u2", "<u4", "<f8", "<f8")
                sums[:, at] += parts
    if ids is not None:
        yield done()


def learn(rows: DataFrame, buckets: int) -> tuple[list[Totals], dict[int, int]]:
    """Totals before the first sweep and after each, and the number of tasks of large buckets."""
    counts = common.map_arrow(rows, _send(buckets, None), SENT).select("bucket", "slice", "data")
    counts = counts.repartition("bucket").sortWithinPartitions("bucket", "slice").select("bucket", "data")
    merged = common.staged(common.map_arrow(counts, _merge, "bucket long, first binary, data binary"), "buckets")
    first = common.staged(common.map_arrow(merged.select("bucket", "first"), _first, SUMS), "restaurants")
    got = _collected(first.filter(F.col("kind") != SIZE))
    history = [Totals(got[CUSTOMERS], got[TABLES], tuple(got[PARENT][:2].tolist()), int(got[PARENT][2]))]
    for _ in range(SWEEPS):
        got = _collected(common.map_arrow(merged.select("data"), _sweep(history), SUMS))
        history.append(history[0].next(history[0].tables + got[TABLES], tuple(got[PARENT][:2].tolist())))
    large = first.filter(F.col("kind") == SIZE).filter(
        (F.col("value") > 2 * BUCKET_TOKENS) & (F.col("value") * LARGE > history[0].tokens))
    return history, {r["place"]: math.ceil(r["value"] / BUCKET_TOKENS) for r in large.collect()}


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    learned = common.is_learned(F.col("doc_id"), FOLDS, HELD)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), learned.alias("learned"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(chars / 6 / BUCKET_TOKENS))
    history, tasks = learn(rows, buckets)

    sent = common.map_arrow(rows, _send(buckets, tasks), SENT).repartition("bucket", "part")
    sent = sent.sortWithinPartitions("bucket", "part", "kind", "slice")
    back = common.map_arrow(sent, _score(history), "slice long, kind int, data binary")
    back = back.repartition("slice").sortWithinPartitions("slice", "kind")
    out = common.map_arrow(back, _collect, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", (~common.is_learned(F.col("doc_id"), FOLDS, HELD)).alias("held_out"), "n_tokens", "n_known",
                      F.lit(history[0].tokens).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: scores of all documents."""
    return score(common.read_table(spark, sf_dir, "documents"))
