"""Helpers shared by the corpus operators: reading, sampling, sums of arrays, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.checkpoints import checkpoint

#: Labels may be learnt only from rows whose crc32(doc_id as text) mod FOLDS is not 0.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """True where the row's label must not be learnt from; null ids count as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample_by_id(df: DataFrame, rows: int, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """About `rows` rows of different keys, chosen by a hash of the key, so reruns choose the same keys.
    Of a repeated (or null) key one row is taken, and copies fall away before the shuffle, so a hot
    key doesn't swell the sample. Only for fitting models and cost estimates; results never come from it."""
    total = max(1, df.count())
    scale = 1 << 30
    keep = min(scale, int(scale * rows / total) + 1)
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(scale)) < keep).dropDuplicates([key])


def within_bytes(packed: DataFrame, sizes: list[str], most: int, key: str = "doc_id") -> DataFrame:
    """Of rows that a model is to be fitted on those of the smallest hashes of `key` that together have at
    most so many bytes in these columns; one that does not fit any more is left out whole. What is
    decided on are two numbers a row, of a sample that is bounded in rows."""
    packed = checkpoint(packed)
    size = sum((F.octet_length(c) for c in sizes), F.lit(0)).cast("bigint")
    left, chosen = most, []
    for r in packed.select(key, F.xxhash64(F.lit(13), key).alias("h"), size.alias("n")).orderBy("h", key).collect():
        if r.n <= left:
            left -= r.n
            chosen.append(r[key])
    kept = packed.sparkSession.createDataFrame([(c,) for c in chosen], f"{key} bigint")
    return packed.join(F.broadcast(kept), key, "left_semi")  # of bounded rows


#: Numbers of a piece in which arrays are summed, so that a task that adds a piece up holds little.
PIECE = 1 << 13


def pieces(values: np.ndarray) -> pa.RecordBatch:
    """One task's array, in pieces, as `summed` takes it."""
    flat = np.ascontiguousarray(values, np.float32).ravel()
    cut = range(0, len(flat), PIECE)
    return pa.record_batch({"piece": pa.array(range(len(cut)), pa.int32()), "sums": pa.array([flat[k : k + PIECE].tobytes() for k in cut], pa.binary())})


PIECES = "piece int, sums binary"


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' arrays of this size: pieces are added up in tasks, in the order of their bytes so
    that reruns agree, and one array reaches the driver."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(PIECE)
        for x in sorted(rows.column("sums").to_pylist()):
            total[: len(x) // 4] += np.frombuffer(x, np.float32)
        return pa.table({"piece": rows.column("piece").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(-(-size // PIECE) * PIECE)
    for r in parts.groupBy("piece").applyInArrow(add, PIECES).toLocalIterator():
        out[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(r.sums)
    return out[:size]


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of an undirected graph: (a, b) bigint edges -> (node, component), the
    component being the smallest node reachable. Nodes without an edge are absent; null ends are
    ignored.

    Alternates the large-star and small-star steps: each is an aggregation with map-side combine
    and a join that adaptive execution can split, so a hub with many edges never has to fit in one
    task, and the number of edges does not grow. Each round is checkpointed.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct()
    e = checkpoint(e)
    last = None
    for _ in range(max_rounds):
        both = e.select(F.col("b").alias("u"), F.col("a").alias("v")).union(e.select(F.col("a").alias("u"), F.col("b").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.withColumnRenamed("b", "u").join(low, "u").select(F.col("m").alias("a"), F.explode(F.array("a", "u")).alias("b"))
        e = checkpoint(small.where("a <> b").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    low = e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    roots = e.select(F.col("a").alias("node")).distinct().join(low, "node", "left_anti")
    return low.union(roots.select("node", F.col("node").alias("component")))
