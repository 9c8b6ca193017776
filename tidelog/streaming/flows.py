"""Structured Streaming forms of the log operators.

A micro-batch is the unit of commit: its output and its source positions move together through the
checkpoint. Operators that are plain projections, filters or aggregations run on a stream as they are;
here is what needs state, a sink or a trigger.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidelog.operators import models
from tidelog.sources.logs import SCHEMA, read_log
from tidelog.sources.stream_source import register
from tidelog.streaming.commits import CommitLog


def read_bounded(spark: SparkSession, source, size: int, fmt: str = "tidelog", **options) -> DataFrame:
    """A log stream whose micro-batches hold at most `size` records: with the log's own source (a path;
    it needs the option `progress`, and takes start, reset and topics, see sources.stream_source) or with
    the connector. A file format (`parquet`) can only bound files: then at most `size` of them."""
    if fmt == "tidelog":
        register(spark)
        return spark.readStream.format(fmt).options(path=source, records=size, **options).load()
    bound = {"maxOffsetsPerTrigger": size} if fmt == "kafka" else {"maxFilesPerTrigger": size}
    return read_log(spark, source, fmt, streaming=True, **bound, **options)


#: Copies that are due within the same so many milliseconds share a timer; none is given out before it is due.
DUE_MS = 100


class _Deferral(StatefulProcessor):
    """Holds a lane's copies until they are due. Held rows are state, so they survive a restart. A
    micro-batch's rows that share a timer are one piece of state, written once and read once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "due bigint", "n bigint")
        self.pieces = handle.getMapState("pieces", "due bigint, number bigint", "rows array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timerValues.getCurrentProcessingTimeInMs()
        part = pd.concat(list(rows))
        wait = part["delay_ms"] > 0
        due = -((now + part["delay_ms"][wait]) // -DUE_MS) * DUE_MS
        for at, texts in part["row"][wait].groupby(due):
            at = int(at)
            held = self.counts.getValue((at,))[0] if self.counts.containsKey((at,)) else 0
            if not held:
                self.handle.registerTimer(at)
            self.pieces.updateValue((at, held), (texts.tolist(),))
            self.counts.updateValue((at,), (held + 1,))
        yield pd.DataFrame({"row": part["row"][~wait]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        due = int(expiredTimerInfo.getExpiryTimeInMs())
        for n in range(self.counts.getValue((due,))[0] if self.counts.containsKey((due,)) else 0):
            yield pd.DataFrame({"row": pd.Series(list(self.pieces.getValue((due, n))[0]), dtype=object)})
            self.pieces.removeKey((due, n))
        self.counts.removeKey((due,))

    def close(self) -> None:
        pass


#: Lanes that rows without a key are dealt to, by a hash of the row.
FREE_LANES = 64
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def deferred(stream: DataFrame, lane: str = "key") -> DataFrame:
    """Gives each row of a stream out `delay_ms` after it came (at once for 0 or null); rows behind do not
    wait. Needs the RocksDB state store. Rows come back in their own columns, timestamps to the
    microsecond. Rows without a key have no lane to keep, so they are spread over FREE_LANES."""
    cols = [c for c in stream.columns if c != "delay_ms"]
    row = F.to_json(F.struct(*cols), _EXACT)
    free = F.concat(F.lit("free-"), F.pmod(F.xxhash64(row), F.lit(FREE_LANES)))
    own = F.concat(F.lit("key-"), F.col(lane).cast("string"))
    packed = stream.select(F.coalesce(own, free).alias("lane"), row.alias("row"), F.coalesce(F.col("delay_ms"), F.lit(0)).cast("bigint").alias("delay_ms"))
    out = packed.groupBy("lane").transformWithStateInPandas(statefulProcessor=_Deferral(), outputStructType="row string", outputMode="Append", timeMode="ProcessingTime")
    schema = stream.select(*cols).schema
    return out.select(F.from_json("row", schema, _EXACT).alias("r")).select("r.*")


class _Ledger(StatefulProcessor):
    """Running balance of a key in offset order, across micro-batches; older offsets are replays."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "balance double, last bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        balance, last = self.state.get() if self.state.exists() else (0.0, -1)
        part = pd.concat(list(rows)).sort_values("offset")
        part = part[part["offset"] > last]
        if len(part):
            part = part.assign(balance=balance + part["amount"].cumsum())
            self.state.update((float(part["balance"].iloc[-1]), int(part["offset"].iloc[-1])))
            yield part[["key", "offset", "amount", "balance"]]

    def close(self) -> None:
        pass


def ordered_ledger(stream: DataFrame) -> DataFrame:
    """Stream form of the running ledger: (key, offset, amount) -> also balance, each key's rows in offset
    order, replayed offsets ignored. A key lives in one partition of the log, so its offsets order it."""
    return stream.groupBy("key").transformWithStateInPandas(statefulProcessor=_Ledger(), outputStructType="key string, offset bigint, amount double, balance double", outputMode="Append", timeMode="None")


def eos_sink(
    stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet", dedupe_downstream: bool = False, ordered: bool = False, **trigger
) -> StreamingQuery:
    """Writes output rows and source positions together: a micro-batch's rows and the positions it came to
    are one commit of the target's commit log (see `commits`), read with committed_output and
    committed_positions. Nothing of a batch that failed is read; one that runs again after its commit
    writes nothing; a run that another has followed is stopped.

    With an empty checkpoint the source is read again from its start. Where each partition's offsets come
    in order (`ordered`), rows that the committed positions have passed are left out then; else all
    are written. The connector's sink is at least once, so it is refused unless the reader deduplicates
    by source (dedupe_by_source)."""
    if fmt == "kafka":
        if not dedupe_downstream:
            raise ValueError("this sink is at least once; deduplicate downstream by source, and say so with dedupe_downstream=True")
        out = transform(stream) if transform else stream
        return out.writeStream.format("kafka").option("checkpointLocation", checkpoint).options(**json.loads(target)).trigger(**(trigger or {"availableNow": True})).start()
    log = CommitLog(stream.sparkSession, target)
    run = log.start(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if run.is_committed(batch_id):
            return
        batch.persist()
        try:
            known = committed_positions(batch.sparkSession, target) if ordered else None
            rows = batch if known is None else batch.join(known, ["topic", "partition"], "left").where("next_offset is null or offset >= next_offset").select(*batch.columns)
            ends = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
            run.commit(batch_id, {"data": transform(rows) if transform else rows, "positions": ends})
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def committed_output(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of all commits of an eos_sink, with the number of their commit as `commit`; None before the
    first."""
    return CommitLog(spark, target).read("data")


def committed_positions(spark: SparkSession, target: str) -> DataFrame | None:
    """(topic, partition, next_offset): the group's positions after all commits of an eos_sink; None before
    the first."""
    known = CommitLog(spark, target).read("positions")
    return known if known is None else known.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


#: Commits after which a model is written whole again.
COMPACT_EVERY = 16


def model_now(spark: SparkSession, target: str, account: str = "account") -> DataFrame | None:
    """(account, balance, revision) after all commits of a rebuilding_model: its last base and what later
    commits changed, each account as its last one has it."""
    log = CommitLog(spark, target)
    known = log.read("model", since=log.last_base())
    if known is None:
        return None
    return known.groupBy(account).agg(F.max_by(F.struct("balance", "revision"), "commit").alias("x")).select(account, "x.balance", "x.revision")


def rebuilding_model(
    stream: DataFrame, log: Callable[[], DataFrame], target: str, checkpoint: str, account: str = "account", amount: str = "amount", compact_every: int = COMPACT_EVERY, **trigger
) -> StreamingQuery:
    """Keeps the balance of each account, and starts over whenever a batch brings a newer revision: then
    the model is computed again from the log's start up to where the stream has come, else the batch's
    sums are added to it. `log` gives the retained log as it is now (topic, partition, offset, revision,
    account, amount).

    A commit holds the accounts that its batch changed, so what is written follows the batch. A rebuild,
    and every `compact_every`-th commit, holds the whole model and is a base; what was before it goes.
    Positions are in each base too. Read it with model_now."""
    store = CommitLog(stream.sparkSession, target)
    run = store.start(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        if run.is_committed(batch_id):
            return
        spark = batch.sparkSession
        batch.persist()
        try:
            base = store.last_base()
            model, known = model_now(spark, target, account), store.read("positions", since=base)
            ends = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
            all_ends = ends if known is None else known.select(*ends.columns).unionByName(ends).groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))
            kind = models.project_balances(batch, account, amount).schema["balance"].dataType
            revision = None if model is None else model.agg(F.max("revision")).first()[0]
            whole = models.needs_rebuild(revision, batch) or run.n - base >= compact_every
            if models.needs_rebuild(revision, batch):
                behind = log().join(all_ends, ["topic", "partition"]).where("offset < next_offset")
                out = models.rebuild_on_revision(behind, account, amount).select(account, "balance", "revision")
            else:
                added = batch.groupBy(account).agg(F.sum(amount).alias("balance"))
                if model is not None:
                    old = model.select(account, F.col("balance").alias("_old"))
                    added = added.join(old, account, "full" if whole else "left")
                    # A null sum adds nothing, and stays null where there is no other.
                    added = added.select(account, F.when(F.col("balance").isNull(), F.col("_old")).when(F.col("_old").isNull(), F.col("balance")).otherwise(F.col("balance") + F.col("_old")).alias("balance"))
                out = added.withColumn("revision", F.lit(revision).cast(batch.schema["revision"].dataType))
            out = out.withColumn("balance", F.col("balance").cast(kind))  # a sum of decimals would grow by a digit with each commit
            if run.commit(batch_id, {"model": out, "positions": all_ends if whole else ends}, base=whole) and whole:
                store.vacuum(("model", "positions"), before=run.n)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hands every micro-batch to `handle` until what is there now is read: the batch form of a handler."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


__all__ = ["SCHEMA", "committed_output", "committed_positions", "deferred", "eos_sink", "model_now", "ordered_ledger", "read_bounded", "rebuilding_model", "run_batches"]
