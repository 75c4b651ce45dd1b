"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words hashed into ``BUCKETS`` places (square roots of
counts, scaled to length 1), statistics of its structure (shares of character classes, lines,
repeats, lengths) and the stored n_chars against the true length.  The score is
the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],

all pairwise interactions of rank ``RANK`` in time linear in the features.

The machine is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled rows
open to learning, taken in hash order.  Scoring reads every whole text, in one
pass without shuffle.  Labels, language, source and id are no features.

Texts of any length are read whole.  Null texts count as empty; empty texts are scored by their structure; a null
n_chars counts as matching.  Rows without a quality label teach nothing; a
document labelled twice counts once, by its lowest label; without any labelled
row every score is 0.5.  Repeated rows get equal scores; an empty table gives
an empty result.  Columns other than those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Bounds and shape of the model.
TRAIN_ROWS = 8_000
BUCKETS, RANK = 4096, 8
EPOCHS, BATCH, RATE, DECAY = 8, 128, 0.01, 1e-5
# Folds: rows of this remainder are held out.
FOLDS, HELD = 3, 1

_WORDS = re.compile(common.WORD).findall
_ALPHABET = np.arange(256)
# Classes of bytes whose shares are features.
CLASSES = {
    "upper": (_ALPHABET >= 65) & (_ALPHABET <= 90),
    "lower": (_ALPHABET >= 97) & (_ALPHABET <= 122),
    "digit": (_ALPHABET >= 48) & (_ALPHABET <= 57),
    "stops": np.isin(_ALPHABET, [ord(c) for c in ".,;:"]),
    "marks": np.isin(_ALPHABET, [ord(c) for c in "!?"]),
    "symbol": np.isin(_ALPHABET, [ord(c) for c in "#*$%&|<>@=_+~^{}[]\\/"]),
    "quotes": np.isin(_ALPHABET, [ord(c) for c in "\"'()-"]),
    "space": _ALPHABET == 32,
    "line": _ALPHABET == 10,
    "wide": _ALPHABET >= 128,
}
_CLASS_MATRIX = np.array(list(CLASSES.values()), dtype=np.float64)
STATISTICS = (*CLASSES, "log_words", "word_length", "distinct_words", "repeat_windows", "log_lines", "dup_lines", "line_words",
              "ends_sentence", "chars_off")
WIDTH = BUCKETS + len(STATISTICS)


class Features:
    """Sparse features of texts: (places, values) of the words and the dense statistics."""

    def __init__(self):
        self.hashes = common.WordHashes()

    def of(self, text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
        words = _WORDS(text.lower())
        n = len(words)
        if n:
            h = self.hashes.array(words)
            counts = np.bincount((h % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            places = np.flatnonzero(counts)
            values = np.sqrt(counts[places])
            values /= np.sqrt(n)
            distinct = len(np.unique(h)) / n
            grams = common.mix64(h[:-2]) + common.mix64(h[1:-1] ^ np.uint64(1)) * np.uint64(3) + h[2:] if n > 2 else h[:0]
            repeats = 1 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0
        else:
            places, values, distinct, repeats = np.zeros(0, dtype=np.int64), np.zeros(0), 1.0, 0.0
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        shares = _CLASS_MATRIX @ np.bincount(raw, minlength=256) / max(1, len(raw))
        lines = [x for x in text.split("\n") if x.strip()]
        dense = [*shares.tolist(), np.log1p(n), len(text) / max(1, n), distinct, repeats, np.log1p(len(lines)),
                 1 - len(set(lines)) / len(lines) if lines else 0.0, n / max(1, len(lines)),
                 sum(x.rstrip()[-1] in ".!?" for x in lines) / max(1, len(lines)),
                 0.0 if n_chars is None else float(n_chars != len(text))]
        return places, values, dense


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, n_chars, text) -> (label, places, values, dense)."""
    features = Features()
    for part in common.slices(batches):
        rows = [features.of(t or "", c) for c, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([p.astype(np.int32) for p, _, _ in rows], pa.list_(pa.int32())),
             pa.array([v.astype(np.float32) for _, v, _ in rows], pa.list_(pa.float32())),
             pa.array([d for *_, d in rows], pa.list_(pa.float64()))], names=["label", "places", "values", "dense"])


class Machine:
    """Weights of the factorisation machine."""

    def __init__(self):
        self.bias, self.linear, self.factors = 0.0, np.zeros(WIDTH), np.zeros((WIDTH, RANK))
        self.mean, self.scale = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))

    def _matrix(self, places: Sequence, values: Sequence, dense: np.ndarray) -> np.ndarray:
        x = np.zeros((len(places), WIDTH))
        for r, (p, v) in enumerate(zip(places, values)):
            x[r, p] = v
        x[:, BUCKETS:] = np.clip((dense - self.mean) / self.scale, -5, 5)
        return x

    def _logit(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x @ self.factors
        squares = (x * x) @ (self.factors * self.factors)
        return self.bias + x @ self.linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, places: Sequence, values: Sequence, dense: np.ndarray) -> np.ndarray:
        logit, _ = self._logit(self._matrix(places, values, dense))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, places: Sequence, values: Sequence, dense: np.ndarray, label: np.ndarray) -> "Machine":
        """Adam on the logistic loss, minibatches in a fixed random order."""
        n = len(label)
        if not n:
            return self
        rng = np.random.default_rng(11)
        self.mean, self.scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
        self.factors = rng.normal(0, 0.02, (WIDTH, RANK))
        good = min(max(label.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(good / (1 - good)))
        first = [np.zeros(WIDTH), np.zeros((WIDTH, RANK))]
        second = [np.zeros(WIDTH), np.zeros((WIDTH, RANK))]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(n)
            for start in range(0, n, BATCH):
                rows = order[start:start + BATCH]
                x = self._matrix([places[r] for r in rows], [values[r] for r in rows], dense[rows])
                logit, sums = self._logit(x)
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[rows]) / len(rows)
                gradients = (x.T @ error + DECAY * self.linear,
                             x.T @ (error[:, None] * sums) - ((x * x).T @ error)[:, None] * self.factors + DECAY * self.factors)
                step += 1
                self.bias -= RATE * float(error.sum())
                for weights, g, m, s in zip((self.linear, self.factors), gradients, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    weights -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        return self


def learnable(labels: DataFrame, column: str = "quality", learned: Column | None = None) -> DataFrame:
    """(doc_id, label): at most TRAIN_ROWS labelled documents open to learning, in hash order."""
    open_ = common.is_learned(F.col("doc_id"), FOLDS, HELD) if learned is None else learned
    rows = labels.filter(open_ & F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    rows = rows.groupBy("doc_id").agg(F.min(column).cast("int").alias("_label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on the sample; the broadcast side has at most TRAIN_ROWS rows of two numbers."""
    sample = docs.select("doc_id", "n_chars", "text").join(F.broadcast(learnable(labels)), "doc_id")
    # Repeated rows of a document teach once.
    rows = sample.groupBy("doc_id").agg(F.min("_label").alias("_label"), F.min(F.struct("text", "n_chars")).alias("_d"))
    rows = rows.orderBy("doc_id").select("_label", F.col("_d.n_chars").alias("n_chars"), F.col("_d.text").alias("text"))
    table = common.map_arrow(rows, _sparse, "label int, places array<int>, values array<float>, dense array<double>").toArrow()
    lists = [[np.asarray(x.values) for x in table.column(c)] for c in ("places", "values")]
    dense = np.array(table.column("dense").to_pylist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return Machine().fit(*lists, dense, np.asarray(table.column("label"), dtype=np.float64))


def score(docs: DataFrame, machine: Machine, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``score`` (0 to 1) of each row's whole text."""
    if "score" in carry:
        raise ValueError("rename the carried column score")
    rows = docs.select(*carry, F.col("n_chars").cast("long").alias("_n"), F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for part in common.slices(batches, 1_000_000, "_text"):
            done = []
            for start in range(0, part.num_rows, 256):
                piece = part.slice(start, 256)
                found = [features.of(t or "", c) for c, t in zip(*(piece.column(len(carry) + k).to_pylist() for k in (0, 1)))]
                dense = np.array([d for *_, d in found])
                done.append(machine.score([p for p, _, _ in found], [v for _, v, _ in found], dense))
            scores = pa.array(np.concatenate(done), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[:len(carry)], scores], names=[*carry, "score"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(carry)]]
    return common.map_arrow(rows, run, ", ".join([*kept, "score double"]))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: quality scores of all documents."""
    docs = common.read_table(spark, sf_dir, "documents")
    machine = train(docs, common.read_table(spark, sf_dir, "labels"))
    return score(docs, machine).select("doc_id", (~common.is_learned(F.col("doc_id"), FOLDS, HELD)).alias("held_out"), "score",
                                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
