"""Approximate nearest neighbours by balanced posting lists.

Vectors lie in lists around centroids; a vector near a border lies in several. The centroids are few
enough to be held by every task, with a graph over them by which the lists near a vector are found. A
query looks into the lists whose centroids are not much farther from it than the nearest one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import checkpoint, table

#: Vectors of a list on average, while there are fewer than MOST_LISTS lists; longer lists are dealt to
#: several blocks, so no task ever holds more than a block's rows.
LIST_ROWS, MOST_LISTS = 400, 4096
#: A vector lies in its nearest list and in up to MOST_HOMES - 1 more whose centroid is at most BORDER times
#: as far, unless one is nearer than CLOSE of that to a list already taken. A query looks into its
#: LOOK nearest lists and all others within REACH times its nearest one, however many they are.
MOST_HOMES, BORDER, CLOSE, REACH = 3, 1.1, 0.3, 1.2
LOOK = 16
#: Neighbours of a centroid in the graph; centroids that a search expands at least; where it starts;
#: vectors that are searched for together.
DEGREE, BEAM, ENTRIES, SLICE = 32, 24, 16, 512
#: Vectors times centroids whose distances are held at once.
AT_ONCE = 1 << 22
FOUND = "query bigint, id bigint, score double"


def decoded(raw: list, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), dim).astype(np.float64)


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of `lists` equal shares of the sample: halved again and again at the median along the line
    between two means, so neighbouring lists have neighbouring numbers."""
    rng = np.random.default_rng(5)

    def split(rows: np.ndarray, want: int) -> list[np.ndarray]:
        if want <= 1 or len(rows) < 2:
            return [x[rows].mean(axis=0)]
        own = x[rows]
        a, b = own[rng.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = own @ (b - a) > (b - a) @ (a + b) / 2
            if side.all() or not side.any():
                break
            a, b = own[~side].mean(axis=0), own[side].mean(axis=0)
        cut = max(1, min(len(rows) - 1, len(rows) * (want // 2) // want))
        order = np.argsort(own @ (b - a), kind="stable")
        return split(rows[order[:cut]], want // 2) + split(rows[order[cut:]], want - want // 2)

    return np.stack(split(np.arange(len(x)), min(lists, len(x))))


@dataclass
class Graph:
    """Centroids and, for each, neighbours by which a search goes on."""

    centroids: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @staticmethod
    def over(centroids: np.ndarray) -> Graph:
        n = len(centroids)
        m = min(DEGREE, n - 1)
        edges = np.zeros((n, max(1, m)), np.int32)
        square = np.einsum("ij,ij->i", centroids, centroids)
        some = max(1, AT_ONCE // n)
        for i in range(0, n, some):
            d = square[None, :] - 2 * centroids[i : i + some] @ centroids.T
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            if m:
                edges[i : i + len(d)] = np.argpartition(d, m - 1, axis=1)[:, :m]
        return Graph(centroids, edges, np.unique(np.linspace(0, n - 1, ENTRIES).astype(np.int64)))

    def near(self, x: np.ndarray, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of these vectors: (their rows, distances to every centroid that the search came by),
        infinite for those it didn't. Vectors with the same nearest entry are in one slice and go on
        together: each expands the centroids within `ratio` of its nearest one so far, and its BEAM
        nearest; the distances to all that the slice has come to are one matrix product."""
        c, n = self.centroids, len(self.centroids)
        square = np.einsum("ij,ij->i", c, c)
        start = np.argsort(np.argmin(square[self.entries] - 2 * x @ c[self.entries].T, axis=1), kind="stable")
        for i in range(0, len(x), SLICE):
            part = x[start[i : i + SLICE]]
            norm = np.einsum("ij,ij->i", part, part)[:, None]
            d, done, new = np.full((len(part), n), np.inf), np.zeros((len(part), n), bool), np.zeros((len(part), n), bool)
            new[:, self.entries] = True
            while True:
                some = np.flatnonzero(new.any(axis=0))
                d[:, some] = np.where(new[:, some], norm + square[some] - 2 * part @ c[some].T, d[:, some])
                far = np.partition(d, min(BEAM, n) - 1, axis=1)[:, min(BEAM, n) - 1]
                wide = np.maximum(far, d.min(axis=1) * ratio**2)
                row, at = np.nonzero(~done & (d <= wide[:, None]) & np.isfinite(d))
                if not len(row):
                    break
                done[row, at] = True
                new[:] = False
                new[row[:, None], self.edges[at]] = True
                new &= np.isinf(d)
            yield start[i : i + SLICE], np.sqrt(np.maximum(d, 0))

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): where vectors lie: in the nearest list, and in up to MOST_HOMES - 1 more of those
        within BORDER, in order of distance, but for those close to a list already taken."""
        rows, lists = [], []
        for at, d in self.near(x, BORDER):
            order = np.argsort(d, axis=1, kind="stable")[:, :MOST_HOMES]
            dist = np.take_along_axis(d, order, axis=1)
            taken = dist <= BORDER * dist[:, :1]
            for j in range(1, order.shape[1]):
                for i in range(j):
                    apart = np.linalg.norm(self.centroids[order[:, j]] - self.centroids[order[:, i]], axis=1)
                    taken[:, j] &= ~(taken[:, i] & (apart < CLOSE * dist[:, j]))
            r, k = np.nonzero(taken)
            rows.append(at[r]), lists.append(order[r, k])
        return _joined(rows), _joined(lists)

    def wanted(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): what queries look into."""
        rows, lists = [], []
        for at, d in self.near(x, REACH):
            few = min(LOOK, d.shape[1]) - 1
            wide = np.maximum(np.partition(d, few, axis=1)[:, few], REACH * d.min(axis=1))
            r, k = np.nonzero((d <= wide[:, None]) & np.isfinite(d))
            rows.append(at[r]), lists.append(k)
        return _joined(rows), _joined(lists)


def _joined(parts: list) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _least(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the k least scores are, ties to smaller ids."""
    if len(score) > k:
        edge = np.partition(score, k - 1)[k - 1]
        some = np.flatnonzero(score <= edge)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], score[some]))][:k]


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which `is_query` (a column of id_col) holds, its k
    nearest other rows that the index finds, by Euclidean distance, ties to smaller ids.

    Rows with a null id take no part, nor vectors that are null, zero, hold null or non-finite
    components, or have another length than most. Of rows of one id one takes part (`one_of_each_id`).
    Exact copies are searched for once and all are found: of equal vectors the k + 1 smallest ids are
    indexed, as no more can be among anyone's first. An empty table gives no rows; where there are
    fewer than k others, all that are found. Other columns are ignored.

    The centroids are fitted on a bounded sample (vectors.SAMPLE_ROWS, SAMPLE_BYTES); all rows are
    indexed and all candidate lists are searched whole.
    """
    dim = V.dimension(df, vec_col)
    dtype = "<f4" if df.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"
    width = np.dtype(dtype).itemsize

    def encode(x: np.ndarray):
        keep = np.flatnonzero((x != 0).any(axis=1))
        raw = x[keep].astype(dtype).tobytes()
        return keep, [raw[i : i + width * dim] for i in range(0, len(raw), max(1, width * dim))]

    rows = V.prepared(df, dim, encode, id_col, vec_col)
    total = rows.count()
    sample = V.sample_of(rows, total, dim, lambda raw: decoded(raw, dim, dtype))
    if not len(sample):
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = np.unique(sample, axis=0)  # a hot vector is one
    graph = Graph.over(balanced_centroids(sample, int(min(MOST_LISTS, max(1, total // LIST_ROWS)))))
    lists = len(graph.centroids)

    def house(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, of = graph.homes(decoded(batch.column(2).to_pylist(), dim, dtype)) if batch.num_rows else (np.zeros(0, np.int64),) * 2
            at = pa.array(at)
            yield pa.record_batch([pa.array(of.astype(np.int64)), batch.column(0).take(at), batch.column(2).take(at)], ["list", "id", "vec"])

    housed = checkpoint(V.smallest_copies(rows, k + 1).select("id", "label", "vec").mapInArrow(house, "list bigint, id bigint, vec binary"))
    counts = np.zeros(lists, np.int64)
    for r in housed.groupBy("list").count().collect():  # a row for each list
        counts[r["list"]] = r["count"]
    first, many, blocks = V.dealt_blocks(counts, V.BLOCK_ROWS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            block = first[of] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % many[of]
            yield pa.record_batch([pa.array(block), pa.array(np.zeros(len(of), np.int32)), batch.column(1), batch.column(0), batch.column(2), pa.nulls(len(of), pa.binary())], V._names())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and block, with the lists there that it looks into."""
        for batch in batches:
            if not batch.num_rows:
                continue
            row, of = graph.wanted(decoded(batch.column(1).to_pylist(), dim, dtype))
            n = many[of]
            row, of, block = np.repeat(row, n), np.repeat(of, n), np.repeat(first[of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            order = np.lexsort((of, block, row))
            row, of, block = row[order], of[order].astype("<i8"), block[order]
            cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(block) != 0)) + 1
            start = np.concatenate([[0], cut])
            more = [of[i:j].tobytes() for i, j in zip(start, [*cut, len(of)], strict=True)]
            at = pa.array(row[start])
            yield pa.record_batch([pa.array(block[start]), pa.array(np.ones(len(start), np.int32)), batch.column(0).take(at), pa.nulls(len(start), pa.int64()), batch.column(1).take(at), pa.array(more, pa.binary())], V._names())

    def build(batch: pa.RecordBatch):
        x, of = decoded(batch.column("vec").to_pylist(), dim, dtype), batch.column("label").to_numpy()
        return x, np.einsum("ij,ij->i", x, x), batch.column("id").to_numpy(), {int(v): np.flatnonzero(of == v) for v in np.unique(of)}

    def answer(built, batch: pa.RecordBatch) -> pa.RecordBatch:
        x, square, ids, held = built
        q, asking = decoded(batch.column("vec").to_pylist(), dim, dtype), batch.column("id").to_numpy()
        by_list: dict[int, list[int]] = {}
        for n, raw in enumerate(batch.column("more").to_pylist()):
            for of in np.frombuffer(raw, "<i8").tolist():
                by_list.setdefault(of, []).append(n)
        found: list[list] = [[] for _ in asking]
        for of, who in by_list.items():
            if (rows := held.get(of)) is None:
                continue
            some = max(1, AT_ONCE // len(rows))
            for i in range(0, len(who), some):
                part = who[i : i + some]
                rough = square[rows] - 2 * q[part] @ x[rows].T
                top = min(k + 1, len(rows)) - 1
                edge = np.partition(rough, top, axis=1)[:, top]
                # What rounding could have put behind the edge is looked at too.
                slack = 1e-9 * (square[rows].max() + np.einsum("ij,ij->i", q[part], q[part]))
                for n, line, most in zip(part, rough, edge + slack, strict=True):
                    found[n].append(rows[line <= most])
        query, other, score = [], [], []
        for n, parts in enumerate(found):
            if parts:
                some = np.unique(np.concatenate(parts))
                exact = np.sqrt(((x[some] - q[n]) ** 2).sum(axis=1))
                # A vector that several lists hold is one.
                order = np.lexsort((exact, ids[some]))
                some, exact = some[order], exact[order]
                once = np.concatenate([[True], np.diff(ids[some]) != 0])
                some, exact = some[once], exact[once]
                best = _least(exact, ids[some], k + 1)
                query.append(np.full(len(best), asking[n])), other.append(ids[some[best]]), score.append(exact[best])
        flat = lambda v, t: pa.array(np.concatenate(v) if v else np.zeros(0), t)
        return pa.record_batch([flat(query, pa.int64()), flat(other, pa.int64()), flat(score, pa.float64())], ["query", "id", "score"])

    index = housed.mapInArrow(deal, V.MET)
    queries = rows.where(is_query(F.col("id"))).select("id", "vec")
    # Equal queries are one search, under the least of their ids.
    leads = queries.groupBy("vec").agg(F.min("id").alias("lead"))
    asked = leads.select(F.col("lead").alias("id"), "vec").mapInArrow(ask, V.MET)
    met = V.meet(index, asked, blocks, build, answer, FOUND)
    once = met.groupBy("query", "id").agg(F.min("score").alias("score"))  # border vectors come from several lists
    order = lambda *by: Window.partitionBy(*by).orderBy("score", "id")
    top = once.withColumn("_k", F.row_number().over(order("query"))).where(F.col("_k") <= k + 1)
    of_each = queries.join(leads, "vec").select(F.col("id").alias("query_id"), F.col("lead").alias("query"))
    out = of_each.join(top.select("query", "id", "score"), "query").where("id <> query_id")
    out = out.withColumn("rank", F.row_number().over(order("query_id"))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


#: Rows whose id is divisible by this are queries.
EVERY = 100


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours that the index finds of every row whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % EVERY == 0)
