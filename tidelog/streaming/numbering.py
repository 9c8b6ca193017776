"""Dense offsets and turns on a stream: counters that go from one commit to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import records as R
from tidelog.operators.placement import keyed_partition
from tidelog.sources.logs import number_rows
from tidelog.streaming.commits import CommitLog


def _counters(store: CommitLog, names: list[str]) -> DataFrame | None:
    """The highest value that any commit has of each counter."""
    known = store.read("counters")
    return known if known is None else known.groupBy(*names).agg(F.max("next").alias("next"))


def _numbered(rows: DataFrame, known: DataFrame | None, groups: list[str], order: list[str], name: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """rows with `name`: their rank within groups, going on from the counters of this kind; and the
    counters after them. A group's rows are spread over all tasks; counters are a row a group."""
    out = number_rows(rows, groups, order, "_rank")
    base = None if known is None else known.where(F.col("kind") == kind).select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("next").alias("_base"))
    if base is None:
        out = out.withColumn("_base", F.lit(0).cast("bigint"))
    elif not groups:
        out = out.join(F.broadcast(base.agg(F.max("_base").alias("_base"))))  # one row
    else:
        on = F.lit(True)
        for g in groups:
            on = on & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        out = out.join(base, on, "left").drop(*[f"_of_{g}" for g in groups])
    out = out.withColumn(name, F.coalesce("_base", F.lit(0)) + F.col("_rank")).drop("_rank", "_base")
    ends = out.groupBy(*groups).agg((F.max(name) + 1).alias("next"))
    full = {"topic": F.lit(None).cast("string"), "partition": F.lit(None).cast("int")}
    counters = ends.select(F.lit(kind).alias("kind"), *[(F.col(c) if c in groups else v).alias(c) for c, v in full.items()], "next")
    return out, counters.where("next is not null")


def stream_topic_log(stream: DataFrame, target: str, checkpoint: str, order: list[str], partitions: int = 4, **trigger) -> StreamingQuery:
    """Stream form of topic_log: rows (topic, key, value, timestamp, optional pin) become a log under
    `target`, placed on partitions, with dense offsets and a global sequence that go on from micro-batch
    to micro-batch; keyless rows take turns by topic. Within a micro-batch rows come by `order`, a total
    order; micro-batches come in the order that the stream gives them.

    A batch's rows and counters are one commit (see `commits`), so a batch that runs again after it was
    committed changes nothing, and one that failed leaves nothing behind. Read it with read_streamed_log."""
    store = CommitLog(stream.sparkSession, target)
    run = store.start(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if run.is_committed(batch_id):
            return
        known = _counters(store, ["kind", "topic", "partition"])
        pin = F.col("pin") if "pin" in batch.columns else F.lit(None).cast("int")
        pinned = F.when(pin.between(0, partitions - 1), pin.cast("int"))
        free = pin.isNull() & keyed_partition("key", partitions).isNull()
        turned, turns = _numbered(batch.where(free), known, ["topic"], order, "_turn", "turn")
        turned = turned.withColumn("partition", F.pmod("_turn", F.lit(partitions)).cast("int")).drop("_turn")
        fixed = batch.where(~free).withColumn("partition", F.when(pin.isNotNull(), pinned).otherwise(keyed_partition("key", partitions)))
        placed, offsets = _numbered(fixed.unionByName(turned), known, ["topic", "partition"], order, "offset", "offset")
        numbered, sequence = _numbered(placed, known, [], order, "sequence", "sequence")
        run.commit(batch_id, {"data": numbered, "counters": turns.unionByName(offsets).unionByName(sequence)})

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_streamed_log(spark: SparkSession, target: str) -> DataFrame | None:
    """The committed rows of stream_topic_log; None before the first commit."""
    out = CommitLog(spark, target).read("data")
    return out if out is None else out.drop("commit")


def stream_round_robin(stream: DataFrame, target: str, checkpoint: str, partitions: int, order: list[str], headers: str = "headers", **trigger) -> StreamingQuery:
    """Stream form of round_robin: each row without a key header and without a pin gets the next of
    `partitions` pins, and the turn goes on over micro-batches. Written and read as stream_topic_log."""
    if partitions < 1:
        raise ValueError("round robin needs at least one partition")
    store = CommitLog(stream.sparkSession, target)
    run = store.start(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if run.is_committed(batch_id):
            return
        free = F.col("pin").isNull() & ~F.exists(F.coalesce(F.col(headers), R.no_headers()), lambda h: F.lower(h["key"]) == R.KEY_HEADER)
        turned, turns = _numbered(batch.where(free), _counters(store, ["kind", "topic", "partition"]), [], order, "_turn", "turn")
        turned = turned.withColumn("pin", F.pmod("_turn", F.lit(partitions)).cast("int")).drop("_turn")
        run.commit(batch_id, {"data": batch.where(~free).unionByName(turned), "counters": turns})

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
