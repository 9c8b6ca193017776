"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordhash as W
from .common import held_out, sample_by_id, table, within_bytes

#: Labelled rows that the model is fitted on (about so many); everything is scored.
TRAIN_ROWS = 8000
#: ... and bytes of their terms (eight each) that reach the driver at most.
TRAIN_BYTES = 256 << 20
BITS, FACTORS = 20, 8
#: Words count whole and by their first so many bytes, so that rare forms of one stem are known.
STEMS = (5, 7)
#: A term's value is its share of the text's words times this, 1 at most.
SHARE = 50.0
#: Terms of fewer training rows than this have no weight: they would only name those rows. There is
#: no bound on the number of terms.
LEAST_ROWS = 4
THRESHOLD = 0.5


def terms(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed term and value of each different term of whole texts, by row. Words are runs of
    letters, A-Z lower-cased; terms are words and their stems."""
    starts, ends, first = W.spans(buf, bounds, W.IS_BREAK)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first)) << BITS
    bucket = lambda h: (h >> np.uint64(64 - BITS)).astype(np.int64)
    keys = [row | bucket(W.span_hash(buf, starts, ends, W.LOWER))]
    for n in STEMS:
        at = np.flatnonzero(ends - starts > n)
        keys.append(row[at] | bucket(W.mix64(W.span_hash(buf, starts[at], starts[at] + n, W.LOWER) + np.uint64(n))))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row = key >> BITS
    return row, key & ((1 << BITS) - 1), np.minimum(1.0, SHARE * count / np.diff(first)[row]).astype(np.float32)


@dataclass
class FactorMachine:
    """value = bias + sum of linear[t] x[t] + sum over pairs of (factors[s] . factors[t]) x[s] x[t]."""

    buckets: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def __post_init__(self):
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[self.buckets] = np.arange(len(self.buckets))

    def score(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row, bucket, x = terms(buf, bounds)
        known = np.flatnonzero(self.place[bucket] >= 0)
        return sigmoid(value(row[known], self.place[bucket[known]], x[known], len(bounds) - 1, self.bias, self.linear, self.factors)[0])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def value(row, term, x, n, bias, linear, factors):
    """The machine's value of each of n rows, and each row's sum of factors times values. Rows come
    in order. Pairs are summed as half the square of the sum less the sum of the squares."""
    v = factors[term] * x[:, None]
    total, square = np.zeros((n, factors.shape[1]), v.dtype), np.zeros((n, factors.shape[1]), v.dtype)
    cut = np.searchsorted(row, np.arange(n + 1))
    some = np.flatnonzero(np.diff(cut))
    if len(some):
        total[some] = np.add.reduceat(v, cut[:-1][some], axis=0)
        square[some] = np.add.reduceat(v * v, cut[:-1][some], axis=0)
    return bias + np.bincount(row, linear[term] * x, n) + 0.5 * (total**2 - square).sum(axis=1), total


def gradient(row, term, x, total, slope, factors):
    """(terms, by linear weight, by factors): how a sum of values, each times its slope, changes."""
    used, at = np.unique(term, return_inverse=True)
    by = slope[row] * x
    linear = np.bincount(at, by, len(used))
    inner = by[:, None] * (total[row] - factors[term] * x[:, None])
    return used, linear, np.stack([np.bincount(at, inner[:, k], len(used)) for k in range(factors.shape[1])], axis=1)


def fit(each: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 8, batch: int = 64, positive: float = 3.0, sparse: float = 1e-3, ridge: float = 1e-3) -> FactorMachine:
    """The machine of rows (buckets, values) and labels of 0 and 1.

    Linear weights follow the regularized leader with an absolute penalty, so that most stay exactly
    0 and chance words of few rows don't count; factors take adaptive steps with a ridge.
    """
    if not len(y) or y.min() == y.max():
        return FactorMachine(np.zeros(0, np.int64), -4.0 if not len(y) or y[0] == 0 else 4.0, np.zeros(0), np.zeros((0, FACTORS), np.float32))
    rows_of = np.bincount(np.concatenate([t for t, _ in each]), minlength=1 << BITS)
    model = FactorMachine(np.flatnonzero(rows_of >= LEAST_ROWS), 0.0, np.zeros(0), np.zeros(0))
    each = [(model.place[t][known], x[known]) for t, x in each for known in (model.place[t] >= 0,)]
    m, rng = len(model.buckets), np.random.default_rng(1)
    w, lead, seen_w = np.zeros(m), np.zeros(m), np.full(m, 1e-2)
    v, seen_v = rng.normal(0, 0.02, (m, FACTORS)).astype(np.float32), np.full((m, FACTORS), 1e-2, np.float32)
    bias, seen_b = np.log(y.mean() / (1 - y.mean())), 1e-2
    order = rng.permutation(len(y))
    penalty = sparse * -(-len(y) // batch)
    for _ in range(epochs):
        rng.shuffle(order)
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            row = np.repeat(np.arange(len(some)), [len(each[i][0]) for i in some])
            term, x = (np.concatenate([each[i][j] for i in some]) for j in (0, 1))
            raw, total = value(row, term, x, len(some), bias, w, v)
            # Toxic rows are few and missing one costs more, so they weigh more.
            slope = (sigmoid(raw) - y[some]) * np.where(y[some] > 0, positive, 1.0) / len(some)
            used, gw, gv = gradient(row, term, x, total, slope, v)
            before = np.sqrt(seen_w[used])
            seen_w[used] += gw * gw
            rate = np.sqrt(seen_w[used])
            lead[used] += gw - 2 * (rate - before) * w[used]
            w[used] = -np.sign(lead[used]) * np.maximum(0, np.abs(lead[used]) - penalty) / (2 * rate)
            gv += ridge * v[used]
            seen_v[used] += gv * gv
            v[used] -= 0.05 * gv / np.sqrt(seen_v[used])
            seen_b += slope.sum() ** 2
            bias -= 0.3 * slope.sum() / np.sqrt(seen_b)
    return FactorMachine(model.buckets, float(bias), w, v)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, buf, bounds in W.chunks(batch.column(1)):
            row, bucket, x = terms(buf, bounds)
            cut = np.searchsorted(row, np.arange(j - i + 1))
            packed = [pa.array([col[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for col in (bucket.astype(np.int32), x)]
            yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), *packed], ["doc_id", "label", "terms", "values"])


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of about `rows` ids whose label may be learnt from: one row for each id,
    the least text of a repeated one. The sample of labels is bounded by `rows`, so it is broadcast;
    only the chosen texts are shuffled, after copies of one id have fallen together."""
    usable = labels.where(F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = sample_by_id(usable, rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).select("doc_id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label: str = "toxic", **options) -> FactorMachine:
    """Fits on the rows of `labelled`, as far as their terms have TRAIN_BYTES, eight bytes each."""
    packed = labelled(docs, labels, label, rows).mapInArrow(_features, "doc_id bigint, label int, terms binary, values binary")
    got = within_bytes(packed, ["terms", "values"], TRAIN_BYTES).toArrow().sort_by("doc_id")
    y = got.column("label").to_numpy().astype(float)
    each = [(np.frombuffer(t, np.int32), np.frombuffer(x, np.float32)) for t, x in zip(got.column("terms").to_pylist(), got.column("values").to_pylist(), strict=True)]
    return fit(each, y, **options)


def score(docs: DataFrame, model: FactorMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row, from its whole text. Null and empty texts have no
    terms and get the score of the bias alone. Repeated rows and repeated or null ids each come back;
    other columns are not read, whatever their names. A row needs no other row, so nothing is
    shuffled. Ids are bigint or cast to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(1)):
                s = model.score(buf, bounds)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, score double, predicted int")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
