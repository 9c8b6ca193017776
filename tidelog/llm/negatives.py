"""Hard-negative mining by an inverted multi-index, exact.

Each half of a vector has a codebook; a pair of codewords is a cell. With an anchor, no row of a cell has
a larger inner product than the sum of two half-scores: the codeword's product with the anchor's half and
the half's norm times the codeword's radius. Cells are visited by falling sums with a heap, and a search
ends when the next sum is below what the answer already holds.

Cells are packed into blocks of rows. An anchor goes to its most promising block first, and then only to
those blocks that may still hold something: that is what the first visit certifies.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import checkpoint, table

#: Codewords of a half at most; rows of a cell on average while there are fewer.
MOST_WORDS, CELL_ROWS = 64, 128
#: Rows of visited cells that are looked at together; a block is scored in one product where at least this
#: share of it lies in cells that may be visited, else cell by cell.
GATHER, MOSTLY = 1024, 0.25
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: How much sums of half-scores are rounded up, as a share of the norms' product.
SLACK = 1e-9
#: Fixed values of the contract: the window's ends as shares of the positive's score, by whole numbers.
LEAST, MOST, OF = 50, 95, 100


def encoded(x: np.ndarray) -> list[bytes]:
    """Whole numbers as bytes, each row by two, four or eight to a component, as its largest one needs
    (eight: as doubles)."""
    size = np.abs(x).max(axis=1, initial=0)
    out: list = [None] * len(x)
    for dtype, fits in (("<i2", size < 1 << 15), ("<i4", (size >= 1 << 15) & (size < 1 << 31)), ("<f8", size >= 1 << 31)):
        rows = np.flatnonzero(fits)
        raw, step = x[rows].astype(dtype).tobytes(), np.dtype(dtype).itemsize * x.shape[1]
        for n, i in enumerate(rows.tolist()):
            out[i] = raw[n * step : (n + 1) * step]
    return out


def decoded(raw: list, dim: int) -> np.ndarray:
    out = np.zeros((len(raw), dim))
    width = np.array([len(r) for r in raw]) // max(1, dim)
    for w, dtype in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
        if len(rows := np.flatnonzero(width == w)):
            out[rows] = np.frombuffer(b"".join(raw[i] for i in rows), dtype).reshape(len(rows), dim)
    return out


def scores(x: np.ndarray, q: np.ndarray, most: float | None = None) -> np.ndarray:
    """Exact inner products as longs. Doubles are exact while no partial sum passes 2^53 (`most`: the
    largest component of x and of others with it), else whole numbers of any size are used; beyond a
    long's ends a score is that end."""
    most = float(np.abs(x).max(initial=0)) if most is None else most
    if most * float(np.abs(q).max(initial=0)) * len(q) < 2**53:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q]
    return np.array([min(HIGHEST, max(LOWEST, sum(int(a) * b for a, b in zip(row, whole, strict=True)))) for row in x], np.int64)


def codebook(x: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """k-means of the sample's halves."""
    rng = np.random.default_rng(9)
    c = np.unique(x[rng.choice(len(x), min(words, len(x)), replace=False)], axis=0)
    for _ in range(rounds):
        of = nearest_word(x, c)
        n = np.bincount(of, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, of, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], c)
    return c


def nearest_word(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin(np.einsum("ij,ij->i", c, c) - 2 * x @ c.T, axis=1)


@dataclass
class Cells:
    """What every task knows of the index: codebooks, radii, the cells in order and their blocks."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: np.ndarray  # pairs of codewords
    first: np.ndarray
    many: np.ndarray
    blocks: int

    def __post_init__(self):
        cell = np.repeat(np.arange(len(self.cells)), self.many)
        block = self.first[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(self.many) - self.many, self.many)
        order = np.argsort(block, kind="stable")
        self.held, self.at = cell[order], np.searchsorted(block[order], np.arange(self.blocks))  # cells, block by block
        self.number = {tuple(c): n for n, c in enumerate(self.cells.tolist())}

    def halves(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-scores of anchors (rows) with each codeword: no row's half has more."""
        d = len(self.books[0][0])
        norm = np.linalg.norm(q, axis=1, keepdims=True)
        out = []
        for part, c, r in zip((q[:, :d], q[:, d:]), self.books, self.radii, strict=True):
            own = np.linalg.norm(part, axis=1, keepdims=True)
            out.append(part @ c.T + own * r + SLACK * norm * (np.linalg.norm(c, axis=1) + r + 1) + SLACK)
        return out[0], out[1]

    def block_bounds(self, q: np.ndarray) -> np.ndarray:
        a, b = self.halves(q)
        return np.maximum.reduceat((a[:, self.cells[:, 0]] + b[:, self.cells[:, 1]])[:, self.held], self.at, axis=1)


class Block:
    """One block's rows, cell by cell."""

    def __init__(self, cells: Cells, dim: int, batch: pa.RecordBatch):
        of = batch.column("more").to_pylist()
        of = np.frombuffer(b"".join(of), "<i4").reshape(len(of), 2)
        number = np.array([cells.number[tuple(c)] for c in of.tolist()])
        order = np.lexsort((batch.column("id").to_numpy(), number))
        self.x = decoded([batch.column("vec")[i].as_py() for i in order.tolist()], dim)
        self.ids, self.labels = batch.column("id").to_numpy()[order], batch.column("label").to_numpy()[order]
        self.most = float(np.abs(self.x).max(initial=0))
        here, start = np.unique(number[order], return_index=True)
        ends = np.append(start[1:], len(order))
        self.rows = {tuple(c): (i, j) for c, i, j in zip(cells.cells[here].tolist(), start.tolist(), ends.tolist(), strict=True)}
        self.left, self.right = np.unique(cells.cells[here, 0]), np.unique(cells.cells[here, 1])
        self.cells, self.sizes = cells.cells[here], ends - start

    def visits(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """(bound, first row and one past the last) of this block's cells by falling sum of half-scores.
        Each half's codewords are a falling sequence; the heap holds the border of what was visited."""
        left, right = self.left[np.argsort(-a[self.left], kind="stable")], self.right[np.argsort(-b[self.right], kind="stable")]
        a, b, left, right = a[left].tolist(), b[right].tolist(), left.tolist(), right.tolist()
        heap, met = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if (rows := self.rows.get((left[i], right[j]))) is not None:
                yield -bound, rows
            for m, n in ((i + 1, j), (i, j + 1)):
                if m < len(left) and n < len(right) and (m, n) not in met:
                    met.add((m, n))
                    heapq.heappush(heap, (-(a[m] + b[n]), m, n))

    def search(self, q: np.ndarray, a: np.ndarray, b: np.ndarray, want) -> None:
        """Hands rows and scores to `want` until no cell to come can hold what it still needs."""
        open_ = int(self.sizes[a[self.cells[:, 0]] + b[self.cells[:, 1]] >= want.need()].sum())
        if not open_:
            return
        whole = scores(self.x, q, self.most) if open_ >= MOSTLY * len(self.ids) else None
        of = lambda v, parts: np.concatenate([v[i:j] for i, j in parts])

        def look(parts: list) -> None:
            found = of(whole, parts) if whole is not None else np.concatenate([scores(self.x[i:j], q, self.most) for i, j in parts])
            want.take(found, of(self.ids, parts), of(self.labels, parts))

        gathered, n = [], 0
        for bound, (i, j) in self.visits(a, b):
            if bound < want.need():
                break
            gathered.append((i, j))
            n += j - i
            if n >= GATHER:
                look(gathered)
                gathered, n = [], 0
        if gathered:
            look(gathered)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the k highest scores are, ties to smaller ids."""
    some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k]) if len(score) > k else np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))][:k]


class Positives:
    """The first k rows of the anchor's own label. `floor`: a score that k rows are known to reach."""

    def __init__(self, label: int, k: int, floor: int = LOWEST):
        self.label, self.k, self.floor = label, k, floor
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def need(self) -> int:
        return max(self.floor, int(self.score[-1])) if len(self.score) == self.k else self.floor

    def take(self, score, ids, labels) -> None:
        some = np.flatnonzero((labels == self.label) & (score >= self.need()))
        if not len(some):
            return
        score, ids = np.append(self.score, score[some]), np.append(self.ids, ids[some])
        best = _first(score, ids, self.k)
        self.score, self.ids = score[best], ids[best]

    def found(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.score, self.ids)]


class Windows:
    """For each positive's score the first k rows of other labels whose scores lie in its window. One pool
    of rows serves all windows; a row stays in it while it is among the first k of one of them."""

    def __init__(self, label: int, k: int, of: list[int], floors: list[int]):
        self.label, self.k = label, k
        self.low = np.array([-(-LEAST * p // OF) for p in of], np.int64)  # of whole numbers, so these are exact
        self.high = np.array([MOST * p // OF for p in of], np.int64)
        self.floor = np.maximum(self.low, np.array(floors, np.int64))
        self.open = self.low <= self.high
        self.top = int(self.high[self.open].max(initial=LOWEST))
        self.least = int(self.floor[self.open].min(initial=HIGHEST))
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def need(self) -> int:
        return self.least

    def _held(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in the pool of each window's first rows, and which of them there are."""
        at = np.searchsorted(-self.score, -self.high)[:, None] + np.arange(self.k)
        there = at < len(self.score)
        at = np.where(there, at, 0)
        return at, there & self.open[:, None] & (self.score[at] >= self.low[:, None]) if len(self.score) else there

    def take(self, score, ids, labels) -> None:
        some = np.flatnonzero((score >= self.least) & (score <= self.top) & (labels != self.label))
        if not len(some):
            return
        score, ids = np.append(self.score, score[some]), np.append(self.ids, ids[some])
        order = np.lexsort((ids, -score))
        self.score, self.ids = score[order], ids[order]
        at, there = self._held()
        known = np.where(there[:, -1], self.score[at[:, -1]], LOWEST)
        self.least = int(np.maximum(self.floor, known)[self.open].min(initial=HIGHEST))
        kept = np.unique(at[there])
        self.score, self.ids = self.score[kept], self.ids[kept]

    def found(self) -> list[tuple[np.ndarray, np.ndarray]]:
        at, there = self._held()
        return [(self.score[a[t]], self.ids[a[t]]) for a, t in zip(at, there, strict=True)]


def _index(rows: DataFrame, dim: int) -> tuple[DataFrame, Cells]:
    """The rows with their cells, and the cells. The codebooks are fitted on a bounded sample; radii and
    counts are of all rows (a row for each cell, MOST_WORDS squared at most, reaches the driver)."""
    total, d = rows.count(), (dim + 1) // 2
    sample = V.sample_of(rows, total, dim, lambda raw: decoded(raw, dim), most=8192)
    words = int(min(MOST_WORDS, max(1, (total / CELL_ROWS) ** 0.5)))
    books = codebook(sample[:, :d], words), codebook(sample[:, d:], words)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = decoded(batch.column(2).to_pylist(), dim)
            at = [nearest_word(part, c) for part, c in zip((x[:, :d], x[:, d:]), books, strict=True)]
            far = [np.linalg.norm(part - c[k], axis=1) for part, c, k in zip((x[:, :d], x[:, d:]), books, at, strict=True)]
            yield pa.record_batch([*batch.columns, *map(pa.array, at), *map(pa.array, far)], ["id", "label", "vec", "i", "j", "far_i", "far_j"])

    put_ = checkpoint(rows.mapInArrow(put, "id bigint, label bigint, vec binary, i bigint, j bigint, far_i double, far_j double"))
    met = put_.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("far_i").alias("far_i"), F.max("far_j").alias("far_j")).orderBy("i", "j").collect()
    radii = np.zeros(len(books[0])), np.zeros(len(books[1]))
    for r in met:
        radii[0][r.i], radii[1][r.j] = max(radii[0][r.i], r.far_i), max(radii[1][r.j], r.far_j)
    first, many, blocks = V.dealt_blocks(np.array([r.n for r in met]), V.BLOCK_ROWS)
    return put_, Cells(books, radii, np.array([(r.i, r.j) for r in met]), first, many, blocks)


def _dealt(put: DataFrame, cells: Cells) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.stack([batch.column(3).to_numpy(), batch.column(4).to_numpy()], axis=1)
            n = np.array([cells.number[tuple(c)] for c in of.tolist()], np.int64)
            block = cells.first[n] + (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % cells.many[n]
            raw = [r.tobytes() for r in of.astype("<i4")]
            yield pa.record_batch([pa.array(block), pa.array(np.zeros(len(n), np.int32)), batch.column(0), batch.column(1), batch.column(2), pa.array(raw, pa.binary())], V._names())

    return put.mapInArrow(deal, V.MET)


def _asked(anchors: DataFrame, cells: Cells, dim: int, rest: bool, need) -> DataFrame:
    """Anchors (id, label, vec, more) for each block they go to: their most promising one or, with `rest`,
    all others that may hold a score of need(more) or above."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                bounds = cells.block_bounds(decoded(part.column(2).to_pylist(), dim))
                best = bounds.argmax(axis=1)
                if rest:
                    go = bounds >= np.array([need(m) for m in part.column(3).to_pylist()], dtype=float)[:, None]
                    go[np.arange(len(best)), best] = False
                    row, block = np.nonzero(go)
                else:
                    row, block = np.arange(len(best)), best
                at = pa.array(row)
                yield pa.record_batch([pa.array(block.astype(np.int64)), pa.array(np.ones(len(row), np.int32)), *[part.column(k).take(at) for k in range(4)]], V._names())

    return anchors.select("id", "label", "vec", "more").mapInArrow(ask, V.MET)


def _searched(index: DataFrame, asked: DataFrame, cells: Cells, dim: int, made) -> DataFrame:
    """(anchor, which, id, score): what `made(label, more)` has taken after the block's visits; which: the
    number of the window (0 for positives)."""

    def answer(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        q = decoded(batch.column("vec").to_pylist(), dim)
        a, b = cells.halves(q)
        out: list[list] = [[], [], [], []]
        for n, (anchor, label, more) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("id", "label", "more")], strict=True)):
            want = made(label, more)
            block.search(q[n], a[n], b[n], want)
            for which, (score, ids) in enumerate(want.found()):
                out[0] += [anchor] * len(ids)
                out[1] += [which] * len(ids)
                out[2] += ids.tolist()
                out[3] += score.tolist()
        return pa.record_batch([pa.array(v, pa.int64()) for v in out], ["anchor", "which", "id", "score"])

    return V.meet(index, asked, cells.blocks, lambda batch: Block(cells, dim, batch), answer, "anchor bigint, which bigint, id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "which").orderBy(F.desc("score"), "id")
    return found.withColumn("k", F.row_number().over(w)).where(F.col("k") <= k)


def _floor(more: bytes | None) -> int:
    return LOWEST if more is None else int.from_bytes(more, "big", signed=True)


def _packed(longs):
    """An array of longs as big-endian bytes, for `more`."""
    return F.unhex(F.array_join(F.transform(longs, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def _longs(more: bytes) -> list[int]:
    return np.frombuffer(more, ">i8").tolist()


def hard_negatives(df: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, id_col: str = "vec_id", vec_col: str = "embedding", label=None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    Components are floor(256 x). A score is the inner product with the anchor; higher come first, ties by
    smaller id. An anchor (a row for which `is_anchor`, a column of id_col, holds) has its first
    `positives` other rows of the same label; each of those has the first `negatives` rows of other
    labels with 50 positive <= 100 negative <= 95 positive. `label`: a column, that of this name if not given.

    Rows with a null id, label or vector take no part, nor vectors with null or non-finite components or
    of another length than most; of rows of one id one does (`one_of_each_id`). Scores beyond a long
    are given as its ends. Equal vectors of one label are searched for once; of them the smallest ids
    are indexed, as many as anyone's answer can hold. An empty table, or one without labels, gives no
    rows. Other columns are ignored."""
    label = F.col("label") if label is None else label
    dim = V.dimension(df, vec_col)

    def encode(x: np.ndarray):
        q = np.floor(256.0 * x) + 0.0  # no negative zeros: equal vectors have equal bytes
        good = np.flatnonzero(np.isfinite(q).all(axis=1))
        return good, encoded(q[good])

    rows = V.prepared(df.withColumn("_label", label.cast("bigint")).where("_label is not null"), dim, encode, id_col, vec_col, F.col("_label"))
    spark = df.sparkSession
    if rows.limit(1).count() == 0:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    put, cells = _index(V.smallest_copies(rows, positives + 1), dim)
    index = _dealt(put, cells)
    anchors = rows.where(is_anchor(F.col("id")))
    leads = checkpoint(anchors.groupBy("label", "vec").agg(F.min("id").alias("id")))

    # One more than is asked for, since among equal anchors each leaves itself out.
    k = positives + 1
    start = leads.withColumn("more", F.lit(None).cast("binary"))
    for_positives = lambda label, more: Positives(label, k, _floor(more))
    near = checkpoint(_searched(index, _asked(start, cells, dim, False, _floor), cells, dim, for_positives))
    known = near.groupBy("anchor").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k).withColumn("more", _packed(F.array("least")))
    on = leads.join(known.select(F.col("anchor").alias("id"), "more"), "id", "left")
    far = _searched(index, _asked(on, cells, dim, True, _floor), cells, dim, for_positives)
    best = checkpoint(_best(near.unionByName(far), k))

    # An anchor's windows: the different scores of its positives, highest first, and then as many floors.
    of = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score"), asc=False).alias("of"))
    of = leads.join(of.withColumnRenamed("anchor", "id"), "id")
    def for_windows(label, more):
        both = _longs(more)
        return Windows(label, negatives, both[: len(both) // 2], both[len(both) // 2 :])

    def least_needed(more) -> int:
        return for_windows(0, more).need()

    asked = of.withColumn("more", _packed(F.concat("of", F.transform("of", lambda _: F.lit(LOWEST)))))
    near = checkpoint(_searched(index, _asked(asked, cells, dim, False, least_needed), cells, dim, for_windows))
    known = near.groupBy("anchor", "which").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == negatives)
    known = known.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("which", "least"))).alias("floors"))
    asked = of.join(known.withColumnRenamed("anchor", "id"), "id", "left")
    floors = F.transform("of", lambda _, n: F.coalesce(F.col("floors")[n.cast("bigint")], F.lit(LOWEST)))
    asked = asked.withColumn("more", _packed(F.concat("of", floors)))
    far = _searched(index, _asked(asked, cells, dim, True, least_needed), cells, dim, for_windows)
    hard = _best(near.unionByName(far), negatives)
    hard = hard.join(of.select(F.col("id").alias("anchor"), "of"), "anchor").select("anchor", F.expr("of[cast(which as int)]").alias("positive_score"), F.col("k").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    own = anchors.join(leads.withColumnRenamed("id", "anchor"), ["label", "vec"]).select(F.col("id").alias("anchor_id"), "anchor")
    chosen = own.join(best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "anchor").where("positive_id <> anchor_id")
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = chosen.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= positives)
    out = chosen.join(hard, ["anchor", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: Rows whose id is divisible by this are anchors; where it is divisible by SHIFTED the label moves on.
EVERY, SHIFTED, LABELS = 50, 7, 10


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings, after every seventh row's label has moved on."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % SHIFTED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(rows, lambda i: i % EVERY == 0, label=label)
