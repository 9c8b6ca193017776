"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordhash as W
from .common import PIECES, checkpoint, held_out, pieces, sample_by_id, summed, table

BITS, DIM = 13, 16
#: Passes over all training rows, and rows of a step. Where a pass has fewer than VISITS rows a task steps
#: over the same rows again, at most MOST_AGAIN times, HELD steps' rows at once.
ROUNDS, STEP, VISITS, MOST_AGAIN, HELD = 2, 128, 20_000, 15, 24
#: Texts that hold a 3- or 4-gram (of three bytes or more).
HAS_GRAM = r"(?s).[A-Za-z].|[^\x00-\x7F].|.[^\x00-\x7F]|[\x{800}-\x{10FFFF}]"
UNKNOWN = "und"
#: The rejection threshold is this quantile of the log odds of calibration rows, or so many standard
#: deviations below their mean where that is less, as few rows don't show such a quantile.
REJECTED, DEVIATIONS = 0.001, 3.1
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def subwords(buf: np.ndarray, bounds: np.ndarray):
    """Yields (bucket of each byte position's 3- or 4-gram, whether it is one). Grams lie in one row;
    only their first and last byte may be a break between words."""
    folded = _FOLD[buf].astype(np.uint32)
    full = folded != 0x20
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(buf))
    for n in (3, 4):
        m = len(buf) - n + 1
        if m <= 0:
            continue
        code = folded[:m].copy()
        good = left[:m] >= n
        for k in range(1, n):
            code |= folded[k : k + m] << np.uint32(8 * k)
            if k < n - 1:
                good &= full[k : k + m]
        yield (code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS), good


def has_letter(texts: pa.Array, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    plain = np.zeros(256, bool)
    plain[ord("a") : ord("z") + 1] = plain[ord("A") : ord("Z") + 1] = True
    found = W.per_row(plain[buf], bounds) > 0
    for k in np.flatnonzero(~found & (W.per_row(buf >= 128, bounds) > 0)):
        found[k] = any(c.isalpha() for c in texts[int(k)].as_py())
    return found


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # per bucket and language: embedding times output weights
    bias: np.ndarray
    heat: float
    least: float  # a prediction with a lower score is rejected

    def logits(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        total, count = np.zeros((n, len(self.langs))), np.zeros(n)
        for bucket, good in subwords(buf, bounds):
            at = np.flatnonzero(good)
            cut = np.searchsorted(at, bounds)
            some = np.flatnonzero(np.diff(cut))
            if len(some):
                total[some] += np.add.reduceat(self.table[bucket[at]], cut[:-1][some], axis=0)
                count += np.diff(cut)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: pa.Array, buf: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        p = _softmax(self.logits(buf, bounds) / self.heat)
        best, letters = p.argmax(axis=1), has_letter(texts, buf, bounds)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], np.where(letters, p[np.arange(len(p)), best], 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _odds(scores: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(1e-12, scores)) - np.log(np.maximum(1e-12, 1 - scores))


def _least(low: float, mean: float, std: float) -> float:
    return float(1 / (1 + np.exp(-min(low, mean - DEVIATIONS * std))))


def threshold(scores: np.ndarray) -> float:
    """The least score that is accepted, from the scores of calibration rows."""
    odds = _odds(scores)
    return _least(np.quantile(odds, REJECTED, method="lower"), odds.mean(), odds.std())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(text, lang) -> each row's share of its grams by bucket, of at most STEP rows at once, and their langs.
    Neighbours are often alike (sorted by language, say), so a step's rows come from all of the batch."""
    for batch in batches:
        order = np.random.default_rng(batch.num_rows).permutation(batch.num_rows)
        for k in range(0, len(order), STEP):
            some = batch.take(pa.array(order[k : k + STEP]))
            for i, j, buf, bounds in W.chunks(some.column(0)):
                at = np.repeat(np.arange(j - i) << BITS, np.diff(bounds))
                keys = [(at[: len(bucket)] | bucket)[good] for bucket, good in subwords(buf, bounds)]
                x = np.bincount(np.concatenate([*keys, np.zeros(0, np.int64)]), minlength=j - i << BITS).reshape(j - i, 1 << BITS).astype(np.float32)
                x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
                yield x, some.column(1).slice(i, j - i)


class _State:
    """Embeddings, output weights and biases, and the squared gradients seen by each (AdaGrad): one flat
    array, so that what tasks have learnt can be averaged."""

    def __init__(self, langs: int, flat: np.ndarray | None = None):
        shapes = [(1 << BITS, DIM), (DIM, langs), (langs,)] * 2
        if flat is None:
            rng = np.random.default_rng(1)
            # Embeddings start small; the shares of a row are small, so both layers take large steps.
            flat = np.concatenate([rng.normal(0, 0.1, (1 << BITS) * DIM + DIM * langs), np.zeros(langs), np.full(sum(int(np.prod(x)) for x in shapes[:3]), 1e-8)])
        self.flat = flat.astype(np.float32)
        cut = np.cumsum([int(np.prod(x)) for x in shapes])[:-1]
        self.emb, self.out, self.bias, *self.seen = (x.reshape(s) for x, s in zip(np.split(self.flat, cut), shapes, strict=True))

    def step(self, x: np.ndarray, want: np.ndarray, whole: np.ndarray, part: np.ndarray) -> None:
        """One step over some rows and the mean row of each language (`whole`), in which each language
        weighs its part of all rows: a task whose rows are of one language keeps the others apart too."""
        x, want = np.vstack([x, whole]), np.append(want, np.arange(len(whole)))
        h = x @ self.emb
        d = _softmax(h @ self.out + self.bias)
        d[np.arange(len(want)), want] -= 1
        d *= (part / np.bincount(want))[want, None]
        grads = (x.T @ (d @ self.out.T) + 1e-7 * self.emb, h.T @ d, d.sum(axis=0))
        for a, seen, g in zip((self.emb, self.out, self.bias), self.seen, grads, strict=True):
            seen += g * g
            a -= 0.1 * g / np.sqrt(seen)


def _means(usable: DataFrame, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The mean row of each language, and each language's part of all rows."""
    number = {v: k for k, v in enumerate(langs)}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), (1 << BITS) + 1))
        for x, named in _texts(batches):
            own = np.zeros((len(langs), len(x)), np.float32)
            own[[number[v] for v in named.to_pylist()], np.arange(len(x))] = 1
            total[:, :-1] += own @ x
            total[:, -1] += own.sum(axis=1)
        yield pieces(total)

    total = summed(usable.select("text", "lang").mapInArrow(add, PIECES), len(langs) * ((1 << BITS) + 1)).reshape(len(langs), -1)
    n = np.maximum(total[:, -1:], 1)
    return (total[:, :-1] / n).astype(np.float32), (n[:, 0] / n.sum()).astype(np.float32)


def _learnt(usable: DataFrame, langs: list[str], n: int) -> _State:
    """Rounds over all rows: every task goes on by SGD from the same state over its own rows, and the
    states are averaged by the number of rows. In the last round a task gives the mean of its steps."""
    number, state = {v: k for k, v in enumerate(langs)}, _State(len(langs))
    whole, part = _means(usable, langs)
    again = min(MOST_AGAIN, max(1, -(-VISITS // max(1, n))))
    for round_ in range(ROUNDS):
        sent = usable.sparkSession.sparkContext.broadcast((state.flat, whole, part))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, last=round_ == ROUNDS - 1) -> Iterator[pa.RecordBatch]:
            flat, whole, part = sent.value
            own, mean, rows, steps = _State(len(langs), flat.copy()), np.zeros(len(flat)), 0, 0
            held: list = []

            def go() -> None:
                nonlocal steps
                for _ in range(again):
                    for x, want in held:
                        own.step(x, want, whole, part)
                        steps += 1
                        if last:
                            mean[:] += own.flat
                held.clear()

            for x, named in _texts(batches):
                held.append((x, np.array([number[v] for v in named.to_pylist()])))
                rows += len(x)
                if again == 1 or len(held) == HELD:
                    go()
            go()
            if rows:
                yield pieces(np.append(mean / max(1, steps) if last else own.flat, 1.0) * rows)

        total = summed(usable.select("text", "lang").mapInArrow(learn, PIECES), len(state.flat) + 1)
        sent.destroy()  # else the driver's JVM holds it until it happens to collect its garbage
        state = _State(len(langs), total[:-1] / total[-1])
    return state


def train(docs: DataFrame, rows: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fits on every row whose label may be learnt from (or on about `rows` of them, where that is given).
    By a hash of the id a fifth of them is kept aside: it sets the temperature (by likelihood) and the
    rejection threshold, which about one in a thousand of such rows falls below. What reaches the driver
    is the model's own size, and of the fifth's scores some sums and the threshold."""
    usable = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable = usable.where(F.col("text").rlike(HAS_GRAM) & (F.octet_length("text") >= 3))
    if rows is not None:
        usable = sample_by_id(usable, rows)
    aside = F.pmod(F.xxhash64(F.lit(19), "doc_id"), F.lit(5)) == 0
    known = usable.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(aside).alias("aside")).orderBy("lang").collect()  # a row for each language
    langs, n = sorted(r.lang for r in known), sum(r.n for r in known)
    if not langs:
        return LanguageModel([UNKNOWN], np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    few = n < 50
    fit, dev = (usable, usable) if few else (usable.where(~aside), usable.where(aside))
    state = _learnt(fit, langs, n if few else n - sum(r.aside for r in known))
    model = LanguageModel(langs, (state.emb @ state.out).astype(np.float32), state.bias.astype(np.float64), 1.0, 0.0)
    number = {v: k for k, v in enumerate(langs)}

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(0)):
                want = [number[v] for v in batch.column(1).slice(i, j - i).to_pylist()]
                yield pa.record_batch({"logits": pa.array(list(model.logits(buf, bounds)), pa.list_(pa.float64())), "want": pa.array(want, pa.int32())})

    judged = checkpoint(dev.select("text", "lang").mapInArrow(logits, "logits array<double>, want int"))
    heats = 2.0 ** np.arange(-4, 4.25, 0.25)

    def loss(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(heats))
        for batch in batches:
            x, want = batch.column(0).flatten().to_numpy().reshape(-1, len(langs)), batch.column(1).to_numpy()
            total += [-np.log(np.maximum(1e-12, _softmax(x / t)[np.arange(len(want)), want])).sum() for t in heats]
        yield pieces(total)

    model.heat = float(heats[summed(judged.mapInArrow(loss, PIECES), len(heats)).argmin()])
    heat = model.heat

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"odds": pa.array(_odds(_softmax(batch.column(0).flatten().to_numpy().reshape(-1, len(langs)) / heat).max(axis=1)))})

    sure = judged.mapInArrow(odds, "odds double")
    r = sure.agg(F.count("*").alias("n"), F.avg("odds").alias("mean"), F.stddev_pop("odds").alias("std")).first()
    if r.n:
        low = sure.orderBy("odds").offset(int(REJECTED * (r.n - 1))).limit(1).first().odds
        model.least = _least(low, r.mean, r.std)
    return model


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds lang_pred, lang_score and lang_accepted to every row; other columns stay (of the same
    names are replaced).

    A null text and one without a letter are `und` with score 0 and not accepted; so is nothing else.
    A score below the calibrated threshold is not accepted. Whole texts count. A row needs no other
    row, so nothing is shuffled; repeated rows and repeated or null ids each come back.
    """
    docs = docs.drop("lang_pred", "lang_score", "lang_accepted")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(at)):
                part = batch.slice(i, j - i)
                pred, score = model.predict(part.column(at), buf, bounds)
                ok = np.array([x != UNKNOWN for x in pred]) & (score >= model.least)
                yield pa.record_batch([*part.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(ok)], [*part.schema.names, "lang_pred", "lang_score", "lang_accepted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_accepted", T.BooleanType())])
    return docs.mapInArrow(run, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_accepted")
