"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import wordhash as W
from .common import checkpoint, table

#: Rows of one source that one task balances together.
BLOCK = 2000
#: Open units of a block that are rounded by trying all ways.
LANDING = 12
MOST = 3


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): words of each whole text, 0 for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(1)):
                part = batch.slice(i, j - i)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(np.diff(W.spans(buf, bounds)[2]), pa.int64())], ["doc_id", "source", "size"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    return rows.mapInArrow(run, "doc_id bigint, source string, size bigint")


def targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(source, source_size, n, target): sources by code point, null last, take the weights in turn
    and share the sum of all sizes by them; no target passes `most` times its source's size, and what
    is over is shared again by weight among the rest.

    Sources are ranked by slices of a range partitioning, and each sharing is one sum over all of
    them, so no task holds every source. A sharing stops at least one more source at its cap and in
    practice most of them; it ends when none is above.
    """
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    s = s.withColumn("slot", F.struct(F.col("source").isNull().alias("last"), "source"))
    s = checkpoint(s.repartitionByRange("slot").withColumn("slice", F.spark_partition_id()))
    # One row for each slice: how many sources lie in slices before it.
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = s.groupBy("slice").agg(F.count("*").alias("m")).select("slice", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    turn = F.col("base") + F.row_number().over(Window.partitionBy("slice").orderBy("slot")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights)).cast("int") + 1)
    s = s.join(base, "slice").select("source", "source_size", "n", weight.alias("weight"), (F.col("source_size").cast("double") * most).alias("cap"))
    s = checkpoint(s)
    level, stopped = 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        r = s.agg(F.sum(F.col("source_size").cast("double")).alias("whole"), F.sum(F.when(above, F.col("cap"))).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("open"), F.count_if(above).alias("stopped")).first()
        if r.open is None or r.stopped == stopped:
            break
        level, stopped = (r.whole - (r.capped or 0.0)) / r.open, r.stopped
    return s.select("source", "source_size", "n", F.least("cap", F.lit(level) * F.col("weight") if level and r.open is not None else F.col("cap")).alias("target"))


def flight(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves inclusion chances along the null space of the two constraints (number of documents and
    tokens) until at most two are neither 0 nor 1. Three open units at a time span a null vector."""
    p, open_ = chance.astype(float).copy(), []
    todo = iter(np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9)))
    scale = max(1.0, float(size.max())) if len(size) else 1.0
    z, draws = (size / scale).tolist(), iter(rng.random(2 * len(p) + 8).tolist())
    while True:
        while len(open_) < 3:
            k = next(todo, None)
            if k is None:
                return p
            open_.append(int(k))
        a, b, c = open_
        u = [z[c] - z[b], z[a] - z[c], z[b] - z[a]]
        if max(map(abs, u)) < 1e-12:
            u = [1.0, -1.0, 0.0]
        up = down = float("inf")
        for k, d in zip(open_, u):
            if d > 1e-15:
                up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
            elif d < -1e-15:
                up, down = min(up, -p[k] / d), min(down, (p[k] - 1) / d)
        step = up if next(draws) * (up + down) < down else -down
        for k, d in zip(open_, u):
            p[k] += step * d
            if p[k] < 1e-9:
                p[k] = 0.0
            elif p[k] > 1 - 1e-9:
                p[k] = 1.0
        open_ = [k for k in open_ if 0 < p[k] < 1]


def land(p: np.ndarray, size: np.ndarray, owed: float = 0.0) -> np.ndarray:
    """Rounds the few open units so that their tokens, with those owed, miss least, then their
    documents. All roundings of at most LANDING units are tried at once."""
    left = np.flatnonzero((p > 0) & (p < 1))
    took = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    tokens = np.abs((took - p[left]) @ size[left] - owed)
    documents = np.abs((took - p[left]).sum(axis=1))
    p = p.copy()
    p[left] = took[np.lexsort((documents, np.round(tokens, 6)))[0]]
    return p


def settle(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decides all units: the larger half flies, its at most two open units are rounded, and the tokens
    that this misses are owed by the smaller half, whose chances move a little to make up for them.
    Then that half is settled in the same way, so only a handful of the smallest are left to land.
    Sizes are in descending order."""
    p, owed, begin = chance.astype(float).copy(), 0.0, 0
    while len(p) - begin > LANDING:
        middle = begin + (len(p) - begin + 1) // 2
        head = flight(p[begin:middle], size[begin:middle], rng)
        done = land(head, size[begin:middle])
        owed += float(((p[begin:middle] - done) * size[begin:middle]).sum())
        p[begin:middle] = done
        rest, weight = p[middle:], size[middle:]
        open_ = (rest > 0) & (rest < 1)
        room = float((weight * np.where(open_, 1 - rest if owed > 0 else rest, 0)).sum())
        if room > 0:
            move = np.sign(owed) * min(1.0, abs(owed) / room) * np.where(open_, 1 - rest if owed > 0 else rest, 0)
            p[middle:] = np.clip(rest + move, 0, 1)
            owed -= float((move * weight).sum())
        begin = middle
    p[begin:] = land(p[begin:], size[begin:], owed)
    return p


def _flown(last: bool):
    def run(rows: pa.Table) -> pa.Table:
        col = {n: rows.column(n).to_numpy() for n in ("mark", "size", "chance")}
        rng = np.random.default_rng(int(col["mark"].min()) & (1 << 63) - 1)
        order = np.lexsort((col["chance"], col["mark"], -col["size"] if last else col["mark"]))
        size, chance = col["size"][order], col["chance"][order]
        out = np.empty(len(order))
        out[order] = settle(chance, size, rng) if last else flight(chance, size, rng)
        return rows.set_column(rows.schema.get_field_index("chance"), "chance", pa.array(out))

    return run


def marked(rows: DataFrame) -> DataFrame:
    """Adds mark, a hash by which rows are dealt to blocks. Rows of equal id, source and size are told
    apart by their number among themselves, so even a third of all rows being equal is dealt evenly;
    which of them has which number doesn't matter, so reruns agree. Needs checkpointed rows: they are
    numbered partition by partition, from a base for each partition and key."""
    key = ["doc_id", "source", "size"]
    mark = lambda number: F.xxhash64(F.lit(11), "doc_id", "size", number).alias("mark")
    twins = checkpoint(rows.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1").select(*[F.col(c).alias(f"of_{c}") for c in key]))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    lone = rows.join(twins, same, "left_anti").select(*key, mark(F.lit(0)))
    again = rows.withColumn("slice", F.spark_partition_id()).join(twins, same, "left_semi")
    before = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = again.groupBy(*key, "slice").agg(F.count("*").alias("m")).select(*[F.col(c).alias(f"of_{c}") for c in key], F.col("slice").alias("at"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("slice", *key).orderBy("slice")
    number = F.row_number().over(own) - 1 + F.col("base")
    return lone.unionByName(again.join(base, same & (F.col("slice") == F.col("at"))).select(*key, mark(number)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each input row: doc_id, source, size, source_size, target, taken.

    taken is size times how often the mix takes the document: each source is repeated target /
    source_size times, the whole part for every document and the fraction by cube sampling, which
    keeps the source's number of documents and of tokens. A source's blocks of rows fly in parallel;
    the at most two rows that each leaves open meet in fewer blocks, until one small block of each
    source is left, which is settled from the largest document to the smallest. So no task holds more
    than about `block` rows of a source, however large it is. Which documents are taken follows from
    hashes of their ids, so reruns agree.

    Null and empty texts have size 0 and are taken with 0 words; a null source is a source, the last.
    Repeated rows, repeated and null ids each come back. Ids are bigint or cast to it. Other columns
    are not read, whatever their names.
    """
    rows = checkpoint(sized(docs, id_col, text_col, source_col))
    t = targets(rows, weights)
    t = t.select(F.col("source").alias("of"), "source_size", "n", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ratio = F.when(F.abs(ratio - F.round(ratio)) < 1e-9, F.round(ratio)).otherwise(ratio)
    base = marked(rows).join(t, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "source", "size", "source_size", "target", "n", F.floor(ratio).cast("bigint").alias("whole"), (ratio - F.floor(ratio)).alias("chance"), "mark",
    )
    # Whole repeats and texts without words need no draw.
    base = checkpoint(base.withColumn("chance", F.when(F.col("size") > 0, F.col("chance")).otherwise(0.0)))
    decided, rest, level = base.where("chance <= 0"), base.where("chance > 0"), 0
    while True:
        level += 1
        last = not rest.where(F.col("n") > block).limit(1).count()
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("bigint")
        lot = rest.withColumn("lot", F.pmod(F.xxhash64(F.lit(level), "mark"), blocks))
        flown = checkpoint(lot.groupBy("source", "lot").applyInArrow(_flown(last), lot.schema).drop("lot"))
        settled = flown if last else flown.where("chance <= 0 or chance >= 1")
        decided = decided.unionByName(settled)
        if last:
            break
        rest = flown.where("chance > 0 and chance < 1")
        counts = rest.groupBy("source").agg(F.count("*").alias("m")).select(F.col("source").alias("of"), "m")
        rest = rest.drop("n").join(counts, F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("m", "n")
    return decided.select("doc_id", "source", "size", F.coalesce("source_size", F.lit(0)).alias("source_size"), "target", (F.col("size") * (F.col("whole") + F.col("chance").cast("bigint"))).alias("taken"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
