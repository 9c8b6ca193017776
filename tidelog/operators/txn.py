"""Transactions and exactly-once bookkeeping.

Transactional records carry transactional_id, epoch and txn (which transaction of the producer); markers
are (transactional_id, epoch, txn, marker) with marker commit or abort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.operators.settle import merge_offsets
from tidelog.sources.logs import PLACE

TXN = ["transactional_id", "epoch", "txn"]


def resolve_transactions(log: DataFrame, markers: DataFrame) -> DataFrame:
    """Adds txn_state: committed or aborted by the transaction's marker, pending without one; records
    outside a transaction are committed."""
    m = markers.groupBy(*TXN).agg(F.min("marker").alias("marker"))
    state = F.when(F.col("transactional_id").isNull(), "committed").when(F.col("marker") == "commit", "committed").when(F.col("marker") == "abort", "aborted").otherwise("pending")
    return log.join(m, TXN, "left").withColumn("txn_state", state).drop("marker")


def fence(log: DataFrame, markers: DataFrame) -> DataFrame:
    """txn_state after fencing, and `fenced`: a newer epoch of an id, in records or in markers, aborts what
    an older one left open."""
    newest = log.where("transactional_id is not null").select("transactional_id", "epoch").unionByName(markers.select("transactional_id", "epoch"))
    newest = newest.groupBy("transactional_id").agg(F.max("epoch").alias("newest"))
    out = resolve_transactions(log, markers).join(newest, "transactional_id", "left")
    old = F.coalesce((F.col("epoch") < F.col("newest")) & (F.col("txn_state") == "pending"), F.lit(False))
    return out.withColumn("fenced", old).withColumn("txn_state", F.when(old, "aborted").otherwise(F.col("txn_state"))).drop("newest")


def refuse_fenced_writes(writes: DataFrame, epochs: DataFrame) -> DataFrame:
    """Adds refused: a write of an epoch below its id's newest (transactional_id, epoch)."""
    newest = epochs.groupBy("transactional_id").agg(F.max("epoch").alias("newest"))
    return writes.join(newest, "transactional_id", "left").withColumn("refused", F.coalesce(F.col("epoch") < F.col("newest"), F.lit(False))).drop("newest")


def expire_transactions(log: DataFrame, now, timeout_ms: int) -> DataFrame:
    """Pending transactions whose first record is at least the timeout old are aborted. Adds expired."""
    began = log.where("txn_state = 'pending'").groupBy(*TXN).agg(F.min("timestamp").alias("began"))
    out = log.join(began, TXN, "left")
    old = (F.col("txn_state") == "pending") & (F.unix_millis(F.lit(now).cast("timestamp")) - F.unix_millis("began") >= timeout_ms)
    old = F.coalesce(old, F.lit(False))
    return out.withColumn("expired", old).withColumn("txn_state", F.when(old, "aborted").otherwise(F.col("txn_state"))).drop("began")


def commit_with_offsets(stored: DataFrame, sent: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The group table after transactions: positions sent within a transaction (group, topic, partition,
    epoch, next_offset and TXN without its epoch as transactional_id, txn) count only if it committed."""
    good = outcomes.where("txn_state = 'committed'").select("transactional_id", "txn").distinct()
    return merge_offsets(stored, sent.join(good, ["transactional_id", "txn"], "left_semi"))


def eos_windows(df: DataFrame) -> DataFrame:
    """(window, n, committed): a commit window commits when all that it enrolled has settled up to the
    highest enrolled offset of each partition and nothing failed; else all of it aborts."""
    return df.groupBy("window").agg(F.count("*").alias("n"), (F.every("settled") & ~F.bool_or("failed")).alias("committed"))


def committed_output(df: DataFrame) -> DataFrame:
    """The rows of committed windows."""
    return df.join(eos_windows(df).where("committed").select("window"), "window", "left_semi")


def dedupe_by_source(df: DataFrame) -> DataFrame:
    """Batch: drops replayed output: the first of each (topic, partition, offset, ordinal), where `seq`
    orders the writes."""
    w = Window.partitionBy("source_topic", "source_partition", "source_offset", "ordinal").orderBy("seq")
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def dedupe_stream_by_source(df: DataFrame, time_col: str = "timestamp", within: str = "1 hour") -> DataFrame:
    """The same on a stream, for replays that come within a time of each other."""
    return df.withWatermark(time_col, within).dropDuplicatesWithinWatermark(["source_topic", "source_partition", "source_offset", "ordinal"])


def rewind_aborted(enrolled: DataFrame, committed: DataFrame, repositioned: DataFrame | None = None) -> DataFrame:
    """(topic, partition, rewind_to): after an abort each enrolled partition returns to its committed next
    offset, else to the first offset it ever enrolled; partitions that were repositioned meanwhile are
    left alone."""
    low = enrolled.groupBy(*PLACE).agg(F.min("offset").alias("low"))
    out = low.join(committed.select(*PLACE, "next_offset"), PLACE, "left")
    if repositioned is not None:
        out = out.join(repositioned.select(*PLACE), PLACE, "left_anti")
    return out.select(*PLACE, F.coalesce("next_offset", "low").alias("rewind_to"))


def partition_transactions(df: DataFrame, base: str) -> DataFrame:
    """Adds transactional_id `{base}-p{n}` and txn_state: each source partition has a transaction of its
    own, so a failure aborts that partition's rows of the window only."""
    out = df.withColumn("transactional_id", F.concat(F.lit(f"{base}-p"), F.col("partition")))
    bad = out.groupBy("transactional_id", "window").agg(F.bool_or("failed").alias("bad"))
    return out.join(bad, ["transactional_id", "window"]).withColumn("txn_state", F.when(F.col("bad"), "aborted").otherwise("committed")).drop("bad")


def missing_source(df: DataFrame, source: str = "source") -> DataFrame:
    """Replies that name no source record: they must not leave outside the transaction."""
    return df.where(R.parse_source(source).isNull())
