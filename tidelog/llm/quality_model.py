"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordhash as W
from .common import held_out, table, within_bytes
from .toxicity import labelled

#: Labelled rows that the model is fitted on (about so many); everything is scored.
TRAIN_ROWS = 3000
#: ... and bytes of their lines' features (36 a line) that reach the driver at most.
TRAIN_BYTES = 64 << 20
THRESHOLD = 0.3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
STEPS = (0.02, 0.1, 0.3, 0.6)
N_RAW = 8
N_FEATURES = 1 + 3 * N_RAW * len(STEPS) + 2


def lines(buf: np.ndarray, bounds: np.ndarray):
    """Each \\n-split line's start, end and weight (bytes and one), and each row's first line."""
    feed = np.flatnonzero(buf == 10)
    n = np.diff(np.searchsorted(feed, bounds)) + 1
    first = np.concatenate([[0], np.cumsum(n)])
    end = np.empty(first[-1], np.int64)
    last = np.zeros(first[-1], bool)
    last[first[1:] - 1] = True
    end[last], end[~last] = bounds[1:], feed
    start = np.empty_like(end)
    start[1:] = end[:-1] + 1
    start[first[:-1]] = bounds[:-1]
    return start, end, first


def raw_features(buf: np.ndarray, bounds: np.ndarray):
    """Per line N_RAW shares between 0 and 1, its weight, and each row's first line."""
    start, end, first = lines(buf, bounds)
    edge = np.stack([start, end])
    of = lambda what: np.diff(np.concatenate([[0], np.cumsum(what[buf])])[edge], axis=0)[0]
    ws, we, wfirst = W.spans(buf, bounds)
    word_edge = np.searchsorted(ws, edge)
    words = np.diff(word_edge, axis=0)[0]
    n, size = np.maximum(1, words), np.maximum(1, end - start)
    h = W.span_hash(buf, ws, we, W.LOWER)
    again = np.zeros(len(h) + 1, np.int64)
    if len(h):
        again[2:] = np.cumsum(h[1:] == h[:-1])
    lone = np.concatenate([[0], np.cumsum(_SYMBOL[buf[ws]] & (we - ws == 1))])
    bang = np.concatenate([[0], np.cumsum(buf[np.maximum(we, 1) - 1] == 33)])
    lh, row = W.span_hash(buf, start, end), np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    order = np.lexsort((lh, row))
    same = np.zeros(len(lh), bool)
    same[order[1:]] = (lh[order][1:] == lh[order][:-1]) & (row[order][1:] == row[order][:-1])
    letters = np.maximum(1, of(~W.IS_BREAK))
    x = np.stack(
        [
            of(_SYMBOL) / n / 2, (lone[word_edge[1]] - lone[word_edge[0]]) / n, of(_CAPITAL) / letters, (bang[word_edge[1]] - bang[word_edge[0]]) / n,
            np.where(words > 1, again[word_edge[1]] - again[np.minimum(word_edge[0] + 1, len(h))], 0) / n, same & (words > 0), of(_DIGIT) / size, words < 3,
        ],
        axis=1,
    )
    return np.clip(x, 0, 1).astype(np.float32), (size + 1).astype(np.float32), first


def features(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Steps of the line's, the previous and the next line's shares, and whether it is an end."""
    own = np.concatenate([x > s for s in STEPS], axis=1)
    ahead, behind = np.zeros_like(own), np.zeros_like(own)
    ahead[:-1], behind[1:] = own[1:], own[:-1]
    start, last = np.zeros(len(x), bool), np.zeros(len(x), bool)
    start[first[:-1]], last[first[1:] - 1] = True, True
    ahead[last], behind[start] = False, False
    return np.concatenate([np.ones((len(x), 1), bool), own, behind, ahead, start[:, None], last[:, None]], axis=1).astype(np.float32)


def marginals(score: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Forward-backward over all rows at once. score: per line the log weight of `good` over `bad`;
    trans[a, b]: log weight of label b after a. Returns each line's chance of `good`, the summed
    chances of each pair of neighbouring labels by row, and each row's log partition sum."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    at, size = first[:-1][order], size[order]
    emit = np.stack([np.zeros_like(score), score], axis=1)
    alpha, beta = np.zeros((len(score), 2)), np.zeros((len(score), 2))
    alpha[at] = emit[at]
    longest = int(size[0]) if len(size) else 0
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(longest + 1)]  # rows longer than t
    for t in range(1, longest):
        here = at[: live[t]] + t
        before = alpha[here - 1]
        alpha[here] = emit[here] + np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
    for t in range(longest - 2, -1, -1):
        here = at[: live[t + 1]] + t
        after = emit[here + 1] + beta[here + 1]
        beta[here] = np.logaddexp(trans[:, 0] + after[:, :1], trans[:, 1] + after[:, 1:])
    end = first[1:] - 1
    log_z = np.logaddexp(alpha[end, 0], alpha[end, 1])
    z = np.repeat(log_z, np.diff(first))
    good = np.exp(np.minimum(0, alpha[:, 1] + beta[:, 1] - z))
    inner = np.ones(len(score), bool)
    inner[first[:-1]] = False
    k = np.flatnonzero(inner)
    pair = np.exp(np.minimum(0, alpha[k - 1][:, :, None] + trans + (emit[k] + beta[k])[:, None, :] - z[k][:, None, None]))
    return good, pair, log_z


@dataclass
class LineField:
    theta: np.ndarray
    trans: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def document(self, x: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log odds of the length-weighted mean chance of `good`."""
        good = marginals(features(x, first) @ self.theta, self.trans, first)[0]
        p = np.clip(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]), 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def score(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.document(*raw_features(buf, bounds)) + self.shift, -40, 40)))


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, buf, bounds in W.chunks(batch.column(1)):
            x, w, first = raw_features(buf, bounds)
            cut = list(zip(first[:-1], first[1:], strict=True))
            yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([w[a:b].tobytes() for a, b in cut], pa.binary())], ["doc_id", "label", "x", "w"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = 12, label: str = "quality") -> LineField:
    """Every line of a training row takes the row's label; the field's weights and transitions are
    fitted by stochastic gradient steps on its likelihood, then the document score is calibrated."""
    lines_ = labelled(docs, labels, label, rows).mapInArrow(_lines_of, "doc_id bigint, label int, x binary, w binary")
    got = within_bytes(lines_, ["x", "w"], TRAIN_BYTES).collect()
    got = sorted(got, key=lambda r: (r.doc_id, bytes(r.x)))
    y = np.array([r.label for r in got])
    model = LineField(np.zeros(N_FEATURES), np.zeros((2, 2)))
    if not len(y) or y.min() == y.max():
        model.scale, model.shift = 0.0, -4.0 if len(y) and y[0] == 0 else 4.0
        return model
    xs = [np.frombuffer(r.x, np.float32).reshape(-1, N_RAW) for r in got]
    ws = [np.frombuffer(r.w, np.float32) for r in got]
    rng = np.random.default_rng(1)
    order = np.argsort([len(x) for x in xs], kind="stable")
    batches = [order[k : k + 64] for k in range(0, len(order), 64)]
    ready = []
    for some in batches:
        first = np.concatenate([[0], np.cumsum([len(xs[i]) for i in some])])
        ready.append((features(np.concatenate([xs[i] for i in some]), first), first, np.repeat(y[some], np.diff(first)).astype(float), 1 / np.repeat(np.diff(first), np.diff(first))))
    seen_t, seen_a = np.full(N_FEATURES, 1e-2), np.full((2, 2), 1e-2)
    for _ in range(epochs):
        for b in rng.permutation(len(ready)):
            f, first, want, even = ready[b]
            good, pair, _ = marginals(f @ model.theta, model.trans, first)
            inner = np.ones(len(f), bool)
            inner[first[:-1]] = False
            # Each row counts once, however many lines it has.
            g = f.T @ ((good - want) * even) / len(first) + 1e-4 * model.theta
            k = want[inner].astype(int)
            true = np.zeros_like(pair)
            true[np.arange(len(k)), k, k] = 1
            a = ((pair - true) * even[inner][:, None, None]).sum(axis=0) / len(first) + 1e-3 * model.trans
            seen_t += g * g
            seen_a += a * a
            model.theta -= 0.3 * g / np.sqrt(seen_t)
            model.trans -= 0.1 * a / np.sqrt(seen_a)
    odds = np.array([model.document(x, w, np.array([0, len(x)]))[0] for x, w in zip(xs, ws, strict=True)])
    design, beta = np.stack([odds, np.ones(len(odds))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):  # Newton's steps of a logistic regression with a little ridge
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        h = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        beta -= np.linalg.solve(h, design.T @ (p - y) + 1e-3 * (beta - [1.0, 0.0]))
    model.scale, model.shift = float(beta[0]), float(beta[1])
    return model


def score(docs: DataFrame, model: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row, from all lines of its whole text. A null or empty text
    is one empty line and gets that line's score. Repeated rows and repeated or null ids each come
    back; other columns are not read, whatever their names. Ids are bigint or cast to it. A row needs
    no other row, so nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(1)):
                s = model.score(buf, bounds)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], [id_col, "score", "predicted"])

    return docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).alias("text")).mapInArrow(run, f"{id_col} bigint, score double, predicted int")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
