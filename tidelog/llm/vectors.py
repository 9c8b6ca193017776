"""Vectors as bytes, and index blocks that queries stream past."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Rows of an index block, which a task holds at once.
BLOCK_ROWS = 4096
#: Bytes and rows of the sample that an index is fitted on, which the driver holds at once.
SAMPLE_BYTES, SAMPLE_ROWS = 32 << 20, 1 << 15
#: Tasks that the blocks of an index are dealt to at most; a task takes one block after the other.
MOST_PARTS = 4096
#: What goes through `meet`: rows of the index (asked = 0) and queries (asked = 1) of a block.
MET = "block bigint, asked int, id bigint, label bigint, vec binary, more binary"


def dimension(df: DataFrame, vec_col: str) -> int:
    """The most frequent length of the vectors (of equally frequent ones the least); 0 where there are none."""
    top = df.where(F.size(vec_col) > 0).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return top.d if top else 0


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors): where the vector has `dim` components, none of them null or not finite; as float64."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(rows)).flatten() if len(rows) else pa.array([], pa.float64())
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)  # nulls are nan here
    good = np.isfinite(x).all(axis=1)
    return rows[good], x[good]


def one_of_each_id(df: DataFrame) -> DataFrame:
    """df of (id, label, vec): of rows that share an id the one of the least label and vector. Ids alone are
    counted first, so vectors are moved only where an id is repeated."""
    if df.groupBy("id").count().where("count > 1").limit(1).count() == 0:
        return df
    return df.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x")).select("id", "x.label", "x.vec")


def prepared(df: DataFrame, dim: int, encode: Callable[[np.ndarray], tuple[np.ndarray, list[bytes]]], id_col: str, vec_col: str, label=None) -> DataFrame:
    """(id, label, vec) of the rows that take part, checkpointed: `encode` gives which of the vectors do, and
    their bytes. Rows without an id take no part."""
    named = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), (F.lit(None) if label is None else label).cast("bigint").alias("label"), F.col(vec_col).alias("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = matrix(batch.column(2), dim)
            keep, raw = encode(x)
            at = pa.array(rows[keep])
            yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(raw, pa.binary())], ["id", "label", "vec"])

    return checkpoint(one_of_each_id(named.mapInArrow(run, "id bigint, label bigint, vec binary")))


def smallest_copies(df: DataFrame, n: int) -> DataFrame:
    """Of rows of the same label and vector those of the n smallest ids: no more of them can be among the
    first n. Spark drops the others before the shuffle too, so a hot vector is few rows there."""
    from pyspark.sql import Window

    copies = Window.partitionBy("label", "vec").orderBy("id")
    return df.withColumn("_k", F.row_number().over(copies)).where(F.col("_k") <= n).drop("_k")


def sample_of(df: DataFrame, total: int, dim: int, decode: Callable[[list], np.ndarray], most: int = SAMPLE_ROWS) -> np.ndarray:
    """About so many vectors, by a hash of their ids, within SAMPLE_BYTES: to fit an index on."""
    want = min(most, max(1, SAMPLE_BYTES // (8 * max(1, dim))))
    scale = 1 << 30
    share = min(scale, int(scale * want / max(1, total)) + 1)
    got = df.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(scale)) < share).select("id", "vec").limit(2 * want).collect()
    return decode([r.vec for r in sorted(got, key=lambda r: r.id)])


def meet(index: DataFrame, asked: DataFrame, blocks: int, build: Callable, answer: Callable[[object, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Every query meets the rows of its block. Both come as MET; `build(rows)` makes what a block's rows
    are searched by, `answer(built, queries)` a batch of results. A task holds one block at a time and
    queries stream past it, however many they are."""
    both = index.select(*_names()).unionByName(asked.select(*_names()))
    dealt = both.repartition(max(1, min(blocks, MOST_PARTS)), "block").sortWithinPartitions("block", "asked", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, built = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.diff(key)) + 1
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
                part, kind = batch.slice(i, j - i), int(key[i])
                if kind >> 1 != block:
                    block, parts, built = kind >> 1, [], None
                if not kind & 1:
                    parts.append(part)
                elif parts:
                    if built is None:
                        built = build(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
                    yield answer(built, part)

    return dealt.mapInArrow(run, schema)


def _names() -> list[str]:
    return [c.split()[0] for c in MET.split(", ")]


def dealt_blocks(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Groups of these sizes, in order, packed into blocks of about `size` rows: each group's first block,
    over how many blocks it is dealt, and the number of blocks. A group over `size` has its own blocks."""
    first, many, block, room = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, size
    for k, n in enumerate(counts.tolist()):
        if n > room and room < size:
            block, room = block + 1, size
        first[k] = block
        if n > size:
            many[k] = -(-n // size)
            block, room = block + int(many[k]), size
        else:
            room -= n
    return first, many, max(1, block + (room < size))
