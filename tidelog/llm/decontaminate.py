"""Benchmark decontamination: latent semantic search, then common-subsequence and answer checks."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordhash as W
from .common import PIECES, checkpoint, pieces, summed, table

BITS, RANK = 14, 64
#: Words of passages that are multiplied at once where the latent space is fitted; they stay in the cache.
FIT_WORDS = 1 << 12
#: Items and words of one block of the benchmark, which a task holds at once (about 16 MB of words and
#: 8 MB of vectors); of more blocks each is a job of its own over the texts.
ITEM_BLOCK, BLOCK_WORDS = 1 << 15, 1 << 21
#: Words of items whose places a task keeps at hand; leaks of several blocks that are broadcast (of 48
#: bytes each), more are joined by a shuffle.
MASK_WORDS, BROADCAST_LEAKS = 1 << 18, 1 << 18
#: Passages times items whose cosines are computed at once; bits of the table of regions' words.
AT_ONCE, PLACES = 1 << 22, 21
STRIDE, WINDOWS = 8, (2, 4)  # passages of 16 words every 8, and of 32 words every 16, for all items
#: Items of fewer words than this are also searched for by passages of 1, 2, 4 and 8 words, which fit
#: into them; items of more words than the passages above by doubled ones, up to their own length.
SHORT, SHORT_WINDOWS, SLICE = 12, {1: (1, 1), 2: (2, 7), 4: (4, 11), 8: (8, 11)}, 1 << 14
#: A passage is a candidate for an item from this share of the item's cosine with itself on. In both
#: cosines the full norm counts, so what the latent space does not hold lowers them.
COSINE = 0.5
#: How much the items weigh against the documents' passages where the latent space is fitted.
ITEM_WEIGHT = 3.0
#: An item is leaked where so much of it is a common subsequence with the passage, or with all of
#: its answer words present, so much.
LCS_ALONE, LCS_WITH_ANSWER, ANSWER_WORDS, ANSWER_SHARE = 0.75, 0.5, 3, 1.0
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("lcs", T.DoubleType()), T.StructField("answer", T.DoubleType())]))


def words_of(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters, A-Z lower-cased, and each row's first word."""
    starts, ends, first = W.spans(buf, bounds, W.IS_BREAK)
    return W.span_hash(buf, starts, ends, W.LOWER), first


def bucket_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def idf_weights(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Inverse document frequency of each hashed term, counted over all documents. One small count
    table per task is summed by term; its size does not depend on the data."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(0)):
                words, first = words_of(buf, bounds)
                row = np.repeat(np.arange(j - i), np.diff(first))
                n += np.bincount(np.unique(row << BITS | bucket_of(words)) & ((1 << BITS) - 1), minlength=1 << BITS)
                rows += j - i
        at = np.flatnonzero(n)
        yield pa.record_batch({"bucket": pa.array(np.append(at, -1), pa.int32()), "n": pa.array(np.append(n[at], rows))})

    got = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = np.zeros((1 << BITS) + 1)
    for r in got:
        n[r.bucket] = r.n
    return (np.log((n[-1] + 1) / (n[:-1] + 1)) + 1).astype(np.float32)


def _passages(words: np.ndarray, first: np.ndarray, size: int = 32):
    """(row of each word, number of rows): consecutive passages of `size` words within texts."""
    within = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    new = np.zeros(len(words), bool)
    new[within % size == 0] = True
    return np.cumsum(new) - 1, int(new.sum())


def _add_gram(total: np.ndarray, words: np.ndarray, row: np.ndarray, idf: np.ndarray, base: np.ndarray) -> None:
    """Adds A^T (A base) of these passages' unit TF-IDF rows A; row: the passage of each word, ascending."""
    start = np.flatnonzero(np.diff(row, prepend=-1))
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + FIT_WORDS, side="right")) - 1)
        first, last = start[i], start[j] if j < len(start) else len(words)
        b, r, cut = bucket_of(words[first:last]), row[first:last] - row[first], start[i:j] - first
        w = idf[b]
        w = w / np.sqrt(np.add.reduceat(w * w, cut))[r]
        y = np.add.reduceat(base[b] * w[:, None], cut, axis=0)
        order = np.argsort(b.astype(np.uint16), kind="stable")
        at = np.flatnonzero(np.diff(b[order], prepend=-1))
        total[b[order][at]] += np.add.reduceat(y[r[order]] * w[order, None], at, axis=0)
        i = j


@dataclass
class Items:
    ids: list[int]
    words: list[np.ndarray]
    answers: list[set]


@dataclass
class Latent:
    idf: np.ndarray
    base: np.ndarray  # terms by RANK, orthonormal


def read_items(benchmark: DataFrame, idf: np.ndarray, id_col: str = "item_id", text_col: str = "text", answer_col: str | None = None) -> Iterator[Items]:
    """The benchmark in blocks of at most ITEM_BLOCK items and about BLOCK_WORDS words, so that what the
    driver holds and a task is sent is bounded. The words of an item's answer are those of the answer
    column, else the item's rarest three."""
    cols = [F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"), (F.col(answer_col) if answer_col else F.lit(None).cast("string")).alias("answer")]
    block: list = []

    def made(rows):
        ids, words, answers = [], [], []
        for r in rows:
            buf = np.frombuffer((r.text or "").encode(), np.uint8)
            w, _ = words_of(buf, np.array([0, len(buf)]))
            if not len(w):
                continue
            said = np.frombuffer((r.answer or "").encode(), np.uint8)
            a = set(words_of(said, np.array([0, len(said)]))[0].tolist()) or set(w[np.argsort(-idf[bucket_of(w)], kind="stable")[:ANSWER_WORDS]].tolist())
            ids.append(r.item_id), words.append(w), answers.append(a)
        return Items(ids, words, answers)

    size = 0
    for r in benchmark.select(*cols).orderBy("item_id", "text").toLocalIterator():
        block.append(r)
        size += len(r.text or "") // 6
        if len(block) == ITEM_BLOCK or size >= BLOCK_WORDS:
            yield made(block)
            block, size = [], 0
    if block:
        yield made(block)


def _multiplied(texts: DataFrame, idf: np.ndarray, base: np.ndarray) -> np.ndarray:
    """A^T (A base) over the passages of all these texts, divided by their number. Each task multiplies its
    own passages; the terms-by-RANK products, four megabytes a task, are summed in pieces by tasks."""
    sent = texts.sparkSession.sparkContext.broadcast((idf, base))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, base = sent.value
        total, count = np.zeros_like(base), 0
        for batch in batches:
            for _, _, buf, bounds in W.chunks(batch.column(0)):
                words, first = words_of(buf, bounds)
                row, n = _passages(words, first)
                _add_gram(total, words, row, idf, base)
                count += n
        if count:
            yield pieces(np.append(total, np.float32(count)))

    out = summed(texts.mapInArrow(multiply, PIECES), base.size + 1)
    sent.destroy()  # else the driver's JVM holds it until it happens to collect its garbage
    out[:-1] /= max(1.0, out[-1])
    return out[:-1].reshape(base.shape)


def fit(docs: DataFrame, benchmark: DataFrame, idf: np.ndarray, rounds: int = 2, text_col: str = "text", item_col: str = "text") -> Latent:
    """Randomised SVD of the TF-IDF passages: subspace iteration V <- orth(A^T A V). Rounds over all items
    alone lead to their space; the last one is over the passages of all documents and all items. What
    reaches the driver is a product of the size of the space, whatever the number of texts."""
    rng = np.random.default_rng(3)
    base = np.linalg.qr(rng.normal(size=(1 << BITS, RANK)))[0].astype(np.float32)
    asked = benchmark.select(F.col(item_col).alias("text"))
    for last in [False] * rounds + [True]:
        total = _multiplied(asked, idf, base)
        total *= ITEM_WEIGHT
        if last:
            total += _multiplied(docs.select(F.col(text_col).alias("text")), idf, base)
        noise = rng.normal(size=base.shape)
        noise *= 1e-12
        total += noise
        del noise
        base = np.linalg.qr(total)[0].astype(np.float32)
    return Latent(idf, base)


def lcs(a_masks: dict, n: int, b: list) -> int:
    """Length of the longest common subsequence by bit-parallel steps; a_masks: positions by word."""
    v, full = (1 << n) - 1, (1 << n) - 1
    for w in b:
        if (m := a_masks.get(w)) is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


class Search:
    """Finds the items of one block in whole texts."""

    def __init__(self, latent: Latent, items: Items):
        self.items = items
        self.project = np.vstack([latent.base * latent.idf[:, None], np.zeros((1, RANK), np.float32)])
        self.square = latent.idf**2
        self.vectors = np.zeros((len(items.ids), RANK), np.float32)
        self.lengths = np.array([len(w) for w in items.words])
        self.masks: dict = {}
        self.masked = 0
        energy = np.zeros(len(items.ids))
        for k, w in enumerate(items.words):
            x, q = self.project[bucket_of(w)].sum(axis=0), float(self.square[bucket_of(w)].sum())
            # Scaled so that the item's product with itself over its full norm is 1.
            self.vectors[k] = x / max(1e-9, float(x @ x)) * q**0.5
            energy[k] = COSINE * float(x @ x) ** 0.5 / q**0.5
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.concatenate([*items.words, np.zeros(0, np.uint64)])
        # The items that passages of a number of words are held against, their vectors and least energy.
        # A passage of s of an item's n words has about sqrt(s / n) of its cosine, so 4 s >= n is needed.
        fits = lambda few, most: np.flatnonzero((self.lengths >= few) & (self.lengths <= most))
        chosen = {s: fits(*n) for s, n in SHORT_WINDOWS.items()} | {s * STRIDE: np.arange(len(items.ids)) for s in WINDOWS}
        size = 2 * STRIDE * WINDOWS[-1]
        while size <= self.lengths.max(initial=0):
            chosen[size] = fits(size, 4 * size)
            size *= 2
        self.groups = {s: (k, np.ascontiguousarray(self.vectors[k].T), float(energy[k].min())) for s, k in chosen.items() if len(k)}

    def near(self, x: np.ndarray, q: np.ndarray, size: int):
        """Of these passages' sums, so many words long each: passage, item and cosine where near."""
        of, vectors, energy = self.groups[size]
        # No cosine passes the share of its norm that the latent space holds of a passage.
        lead = np.flatnonzero(np.einsum("ij,ij->i", x, x) >= energy**2 * q)
        some, found = max(1, AT_ONCE // len(of)), []
        for k in range(0, max(1, len(lead)), some):
            part = lead[k : k + some]
            cosine = x[part] @ vectors
            cosine /= np.sqrt(np.maximum(q[part], 1e-9))[:, None]
            hit, item = np.nonzero(cosine >= COSINE)
            found.append((part[hit], of[item], cosine[hit, item]))
        return tuple(np.concatenate(v) for v in zip(*found, strict=True))

    def promising(self, words: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which regions may hold enough of their item: no common subsequence is longer than the number of
        the item's words that are in the region. The regions' words are marked in one table of bits, each
        where it hashes to with its region; words that only hash alike make the bound weaker."""
        out, total = np.zeros(len(item), bool), np.concatenate([[0], np.cumsum(end - begin)])
        held, shift = np.zeros(1 << PLACES, bool), np.uint64(64 - PLACES)

        def spread(first: np.ndarray, size: np.ndarray, source: np.ndarray) -> np.ndarray:
            """Where these runs of a word array hash to, each with the number of its run."""
            start = np.cumsum(size) - size
            at = np.arange(size.sum()) - np.repeat(start - first, size)
            with np.errstate(over="ignore"):
                return ((source[at] ^ np.repeat(W.mix64(np.arange(1, len(size) + 1, dtype=np.uint64)), size)) * np.uint64(0x9E3779B97F4A7C15)) >> shift

        i = 0
        while i < len(item):
            j = max(i + 1, int(np.searchsorted(total, total[i] + (1 << PLACES - 4), side="right")) - 1)
            marks = spread(begin[i:j], end[i:j] - begin[i:j], words)
            held[marks] = True
            size = self.lengths[item[i:j]]
            there = held[spread(self.first[item[i:j]], size, self.flat)]
            out[i:j] = W.per_row(there, np.concatenate([[0], np.cumsum(size)])) >= LCS_WITH_ANSWER * size
            held[marks] = False
            i = j
        return out

    def mask(self, item: int) -> dict:
        """Where each word of an item stands, as bits; made when a passage is first held against it."""
        if item not in self.masks:
            self.masked += int(self.lengths[item])
            if self.masked > MASK_WORDS:
                self.masks, self.masked = {}, int(self.lengths[item])
            made: dict = {}
            for i, h in enumerate(self.items.words[item].tolist()):
                made[h] = made.get(h, 0) | 1 << i
            self.masks[item] = made
        return self.masks[item]

    def short_candidates(self, words: np.ndarray, first: np.ndarray):
        """As candidates, by the passages that fit into short items; slice by slice, to need little memory."""
        sizes = [s for s in SHORT_WINDOWS if s in self.groups]
        if not sizes:
            return
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for i in range(0, len(words), SLICE):
            j = min(len(words), i + SLICE + sizes[-1] - 1)
            b, r = bucket_of(words[i:j]), row[i:j]
            x, q, size = self.project[b], self.square[b], 1
            at = np.arange(i, j)
            while True:
                if size in self.groups:
                    # Within the text, and every half passage; a shorter passage fits where this does not.
                    lead = np.flatnonzero((at < i + SLICE) & (at + size <= first[r + 1]) & ((at - first[r]) % max(1, size // 2) == 0))
                    k, item, cosine = self.near(x[lead], q[lead], size)
                    yield r[lead[k]], item, at[lead[k]], at[lead[k]] + size, cosine
                if size == sizes[-1] or len(x) <= size:
                    break
                x, q = x[:-size] + x[size:], q[:-size] + q[size:]
                at, r = at[:-size], r[:-size]
                size *= 2

    def candidates(self, words: np.ndarray, first: np.ndarray):
        """Arrays of row, item, first word, one past the last word and cosine of passages near an item."""
        n = np.diff(first)
        blocks = -(-n // STRIDE)
        cut = np.concatenate([[0], np.cumsum(blocks)])
        row = np.repeat(np.arange(len(n)), blocks)
        within = np.arange(cut[-1]) - cut[row]
        start = first[row] + within * STRIDE
        if not len(start):
            return
        yield from self.short_candidates(words, first)
        # Sums over blocks of STRIDE words; windows are sums of neighbouring blocks of a text, and the
        # last ones of a text are shorter.
        b = bucket_of(words)
        q = np.add.reduceat(self.square[b], start)
        # Term by term of all blocks at once; past a text's end the term is the empty last row.
        x, stop = np.zeros((len(start), RANK), np.float32), first[row + 1]
        b = np.append(b, len(self.project) - 1)
        for k in range(STRIDE):
            x += self.project[b[np.where(start + k < stop, start + k, len(words))]]
        size, last = 1, max(self.groups) // STRIDE
        while size < last:
            more = np.flatnonzero(within + size < blocks[row])
            x[more] += x[more + size]
            q[more] += q[more + size]
            size *= 2
            if size * STRIDE not in self.groups:
                continue
            lead = np.flatnonzero(within % (size // 2) == 0)
            k, item, cosine = self.near(x[lead], q[lead], size * STRIDE)
            k = lead[k]
            r = row[k]
            yield r, item, start[k], np.minimum(start[k] + size * STRIDE, first[r + 1]), cosine

    def leaks(self, buf: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
        words, first = words_of(buf, bounds)
        out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
        hits = list(self.candidates(words, first))
        if not any(len(h[0]) for h in hits):
            return out
        r, k, a, b, c = (np.concatenate(v) for v in zip(*hits, strict=True))
        order = np.lexsort((a, k, r))
        r, k, a, b, c = r[order], k[order], a[order], b[order], c[order]
        # With room for a whole item on either side, regions of a row and an item that overlap are one.
        a, b = np.maximum(first[r], a - self.lengths[k]), np.minimum(first[r + 1], b + self.lengths[k])
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1]) | (a[1:] > b[:-1])
        at = np.flatnonzero(new)
        merged = [r[at], k[at], a[at], np.maximum.reduceat(b, at), np.maximum.reduceat(c, at)]
        some = self.promising(words, *merged[1:4])
        regions = zip(*(v[some].tolist() for v in merged), strict=True)
        best: dict = {}
        for row, item, begin, end, cosine in regions:
            n = int(self.lengths[item])
            # A long region is taken in overlapping pieces, so that no common subsequence is pieced
            # together from far apart.
            most = 4 * n + (2 * STRIDE * WINDOWS[-1] if n >= STRIDE else 4 * n)
            for piece in range(begin, max(begin + 1, end - most // 2), most // 2):
                here = words[piece : min(end, piece + most)].tolist()
                there = set(here)
                # Words that are not there are in no common subsequence.
                masks = self.mask(item)
                if sum(m.bit_count() for w, m in masks.items() if w in there) < LCS_WITH_ANSWER * n:
                    continue
                share = lcs(masks, n, here) / n
                said = len(self.items.answers[item] & there) / len(self.items.answers[item])
                if (share >= LCS_ALONE or (share >= LCS_WITH_ANSWER and said >= ANSWER_SHARE)) and share > best.get((row, item), {"lcs": 0})["lcs"]:
                    best[row, item] = {"item_id": self.items.ids[item], "cosine": cosine, "lcs": share, "answer": said}
        for (row, _), leak in best.items():
            out[row].append(leak)
        return out


def _searching(docs: DataFrame, text_col: str, search: Search, keep_all: bool) -> DataFrame:
    """docs with the leaks of one block of items; only the rows that have some, unless all are to be kept."""
    names, at = docs.columns, docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(at)):
                leaks = search.leaks(buf, bounds)
                out = pa.record_batch([*batch.slice(i, j - i).columns, pa.array(leaks, kind)], [*names, "leaks"])
                yield out if keep_all else out.filter(pa.array([bool(x) for x in leaks]))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("leaks", LEAKS)]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """Adds `leaks` (item_id, cosine, lcs, answer) to every row: the benchmark items that its whole
    text holds; empty where there are none. Other columns stay (one named leaks is replaced).

    Null and empty texts, and items without a letter, leak nothing. Repeated items are reported each;
    repeated rows and repeated or null ids each come back. After the latent space is fitted, a row
    needs no other row, so the texts are never shuffled.

    A benchmark of one block is searched for in one pass. Of more blocks each is a job of its own: rows
    get a mark in a checkpoint, a block's leaks are written with it, and all of them meet the rows once.
    """
    docs = docs.drop("leaks")
    none = F.array().cast(LEAKS)
    idf = idf_weights(docs, text_col)
    latent = fit(docs, benchmark, idf, text_col=text_col)
    blocks = (b for b in read_items(benchmark, idf, answer_col=answer_col) if b.ids)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs.withColumn("leaks", none)
    if second is None:
        return _searching(docs, text_col, Search(latent, first), True)
    marked = checkpoint(docs.withColumn("_mark", F.monotonically_increasing_id()))
    found, at = None, 0
    for block in itertools.chain((first, second), blocks):
        some = _searching(marked.select("_mark", text_col), text_col, Search(latent, block), False)
        some = checkpoint(some.select("_mark", F.explode("leaks").alias("leak"), F.lit(at).alias("_block")))
        found, at = some if found is None else found.unionByName(some), at + 1
    many = found.limit(BROADCAST_LEAKS + 1).count() > BROADCAST_LEAKS
    # In the order of the items, as one pass would give them.
    leaks = found.groupBy("_mark").agg(F.sort_array(F.collect_list(F.struct("_block", "leak"))).alias("x")).select("_mark", F.col("x.leak").alias("leaks"))
    return marked.join(leaks if many else F.broadcast(leaks), "_mark", "left").select(*docs.columns, F.coalesce("leaks", none).alias("leaks"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks: a row for each document and benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.cosine", "leak.lcs", "leak.answer")
