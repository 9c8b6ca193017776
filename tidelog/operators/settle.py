"""Outcomes to settlement: commits, retries, dead letters.

Deliveries carry `outcome` (ack, drop, retry, retry_after) and, for retry_after, `delay_ms`; both come
from the user's column expressions. An outcome that is not known (null), as of a handler that was cut
off, is a retry everywhere: the record stays open, and gets its copy or its dead letter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.sources.checkpoints import checkpoint
from tidelog.sources.logs import PLACE, slices

MODES = ("auto", "tracked", "transactional")


def settle(df: DataFrame, mode: str = "tracked", outcome: str = "outcome") -> DataFrame:
    """Adds settled, aborts_window and unsupported. Tracked and transactional: ack and drop settle, a
    retry stays open (and aborts a transactional window). Auto: every record counts as settled, and a
    retry cannot be given."""
    if mode not in MODES:
        raise ValueError(f"unknown commit mode {mode!r}")
    again = _retrying(outcome)
    settled = F.lit(True) if mode == "auto" else ~again
    return df.withColumns({"settled": settled, "aborts_window": again & F.lit(mode == "transactional"), "unsupported": again & F.lit(mode == "auto")})


def committed_tracked(df: DataFrame) -> DataFrame:
    """(topic, partition, next_offset): the lowest unsettled offset, else one past the highest delivered.
    A partition stores nothing before something has settled, or when that position is 0. Gaps in the
    offsets never block."""
    out = df.groupBy(*PLACE).agg(F.min(F.when(~F.col("settled"), F.col("offset"))).alias("open"), F.max("offset").alias("high"), F.count_if("settled").alias("done"))
    out = out.withColumn("next_offset", F.coalesce("open", F.col("high") + 1))
    return out.where("done > 0 and next_offset > 0").select(*PLACE, "next_offset")


def committed_auto(df: DataFrame) -> DataFrame:
    """(topic, partition, next_offset): one past the highest delivered, settled or not."""
    return df.groupBy(*PLACE).agg((F.max("offset") + 1).alias("next_offset"))


def read_epochs(df: DataFrame, seq: str = "delivery_seq") -> DataFrame:
    """Batch: adds epoch and current. In delivery order, an offset not above the one before it starts a
    new epoch; a changed `generation` (where there is such a column) starts one too. current marks the
    deliveries of a partition's last epoch.

    No partition of the log is put in one task: restarts are counted within slices of the delivery order
    and summed over a table of one row for each slice and partition, which also compares each slice's
    first delivery with the last one of the slice before it."""
    facts = ["offset"] + (["generation"] if "generation" in df.columns else [])
    ranged = slices(df, [*PLACE, seq])
    own, over = Window.partitionBy("_slice", *PLACE).orderBy(seq), Window.partitionBy(*PLACE).orderBy("_slice")

    def restarts(now: Callable[[str], Column], before: Callable[[str], Column]) -> Column:
        changed = [F.coalesce(now("offset") <= before("offset"), F.lit(False))] + [F.coalesce(now(c) != before(c), F.lit(False)) for c in facts[1:]]
        return reduce(lambda a, b: a | b, changed).cast("int")

    ranged = ranged.withColumn("_back", restarts(F.col, lambda c: F.lag(c).over(own)))
    ends = ranged.groupBy("_slice", *PLACE).agg(F.min_by(F.struct(*facts), seq).alias("first"), F.max_by(F.struct(*facts), seq).alias("last"), F.sum("_back").alias("n"))
    ends = ends.withColumn("start", restarts(lambda c: F.col(f"first.{c}"), lambda c: F.lag(F.col(f"last.{c}")).over(over)))
    ends = ends.withColumn("_base", F.sum(F.col("start") + F.col("n")).over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    ends = ends.withColumn("_top", F.max(F.col("_base") + F.col("n")).over(Window.partitionBy(*PLACE))).select("_slice", *PLACE, "_base", "_top")
    out = ranged.join(ends, ["_slice", *PLACE]).withColumn("epoch", (F.col("_base") + F.sum("_back").over(own.rowsBetween(Window.unboundedPreceding, 0))).cast("bigint"))
    return out.withColumn("current", F.col("epoch") == F.col("_top")).select(*df.columns, "epoch", "current")


def committed_after_replay(df: DataFrame, seq: str = "delivery_seq") -> DataFrame:
    """Tracked positions after re-reads: what the last epoch delivered, where a settle of the same offset
    under the same generation counts from whichever epoch it came, and one of an older generation is
    void."""
    e = read_epochs(df, seq)
    gen = [*PLACE, "offset"] + (["generation"] if "generation" in df.columns else [])
    once = e.groupBy(*gen).agg(F.bool_or("settled").alias("ever"), F.bool_or("current").alias("current"))
    return committed_tracked(once.where("current").withColumnRenamed("ever", "settled"))


def redelivered_after_crash(df: DataFrame, committed: DataFrame) -> DataFrame:
    """What a restart reads again: every delivered record at or after its partition's committed offset (all
    where none is), with already_acked for those that had settled."""
    at = df.join(committed.select(*PLACE, "next_offset"), PLACE, "left")
    return at.where("next_offset is null or offset >= next_offset").withColumn("already_acked", F.col("settled")).drop("next_offset")


def merge_offsets(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The group table after a commit: (group, topic, partition, epoch, next_offset). Within an epoch a
    position never goes back; a higher epoch (a seek) replaces."""
    cols = ["group", *PLACE]
    both = stored.select(*cols, "epoch", "next_offset").unionByName(new.select(*cols, "epoch", "next_offset"))
    best = both.groupBy(*cols).agg(F.max(F.struct("epoch", "next_offset")).alias("s"))
    return best.select(*cols, "s.epoch", "s.next_offset")


def ordinal(headers="headers") -> Column:
    return R.delivery_ordinal(headers)


def _retrying(outcome: str = "outcome") -> Column:
    return F.coalesce(F.col(outcome).isin("retry", "retry_after"), F.lit(True))


def retry_copies(df: DataFrame, cap: int, target: str = "own", topic: str | None = None) -> DataFrame:
    """The copy that a retried record below the cap publishes: key, value and other headers unchanged, the
    retry count set to its delivery ordinal. target: `own` topic of the delivery, a `fixed` topic, or
    the `source` topic named in the exactly-once source header (its own where there is none)."""
    if target not in ("own", "fixed", "source") or (target == "fixed" and not topic):
        raise ValueError(f"unknown retry target {target!r}")
    n = R.delivery_ordinal("headers")
    source = R.parse_source(R.header_value("headers", R.SOURCE_HEADER))["topic"]
    to = {"own": F.col("topic"), "fixed": F.lit(topic), "source": F.coalesce(source, F.col("topic"))}[target]
    out = df.where(_retrying() & (n < cap))
    keep = [c for c in out.columns if c not in ("topic", "headers")]
    return out.select(*keep, to.alias("topic"), R.with_retry_count("headers", n).alias("headers"))


def dead_letters(df: DataFrame, cap: int, topic: str) -> DataFrame:
    """Records whose retry at the cap sends them to the dead-letter topic, once: payload and other headers
    unchanged, the count the cap. Dropped records go nowhere."""
    n = R.delivery_ordinal("headers")
    out = df.where(_retrying() & (n >= cap))
    keep = [c for c in out.columns if c not in ("topic", "headers")]
    return out.select(*keep, F.lit(topic).alias("topic"), R.with_retry_count("headers", n).alias("headers"))


def deferred_copies(df: DataFrame, now) -> DataFrame:
    """Batch form of retry_after: copies with available_at, and whether they are due at `now`. Records
    behind do not wait. Copies are rows, so unlike in-memory timers they survive a restart."""
    delay = F.coalesce("delay_ms", F.lit(0))
    at = F.timestamp_micros(F.unix_micros("timestamp") + 1000 * delay)
    return df.where("outcome = 'retry_after'").withColumn("available_at", at).withColumn("due", F.col("available_at") <= F.lit(now).cast("timestamp"))


def process_with_retries(backlog: DataFrame, outcome: Column, cap: int, dead_topic: str) -> DataFrame:
    """Batch: every delivery of a backlog until nothing is left: columns of the backlog plus round,
    outcome and result (settled, copied, dead). A backlog row has headers; `outcome` may use `ordinal`.

    Each round is one pass over what the round before copied; there are at most `cap` rounds, each
    checkpointed. A copy goes to the end of the log: it keeps its source's coordinates here and its
    order follows from (round, topic, partition, offset)."""
    todo, rounds = backlog, []
    for k in range(1, cap + 1):
        seen = todo.withColumn("ordinal", R.delivery_ordinal("headers")).withColumn("round", F.lit(k)).withColumn("outcome", outcome)
        result = F.when(~_retrying(), "settled").when(F.col("ordinal") < cap, "copied").otherwise("dead")
        seen = checkpoint(seen.withColumn("result", result))
        rounds.append(seen)
        todo = seen.where("result = 'copied'").withColumn("headers", R.with_retry_count("headers", F.col("ordinal"))).select(*backlog.columns)
        if todo.limit(1).count() == 0:
            break
    out = reduce(DataFrame.unionByName, rounds)
    return out.withColumn("dead_topic", F.when(F.col("result") == "dead", F.lit(dead_topic)))


def batch_outcomes(df: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Adds outcome: that of the row's batch where `whole` (batch, outcome) has one, else the row's own
    (`row_outcome`), so that only a failing record returns."""
    if whole is None:
        return df.withColumn("outcome", F.col("row_outcome"))
    w = whole.select("batch", F.col("outcome").alias("_whole"))
    return df.join(w, "batch", "left").withColumn("outcome", F.coalesce("_whole", "row_outcome")).drop("_whole")


def dead_letter_report(df: DataFrame) -> DataFrame:
    """(topic, deliveries, n) of a dead-letter topic; deliveries is "1" where the header is absent."""
    n = F.coalesce(R.header_value("headers", R.RETRY_HEADER), F.lit("1"))
    return df.groupBy("topic", n.alias("deliveries")).agg(F.count("*").alias("n"))


def group_coverage(log: DataFrame, deliveries: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, read, unread, twice) of each named group: every group has its own copy of each record.
    Deliveries are counted first, so a record read often is one row in the join."""
    cols = [*PLACE, "offset"]
    per = deliveries.groupBy("group", *cols).agg(F.count("*").alias("times"))
    met = per.join(log.select(*cols), cols)
    read = met.groupBy("group").agg(F.count("*").alias("read"), F.count_if(F.col("times") > 1).alias("twice"))
    total = log.agg(F.count("*").alias("total"))
    return groups.select("group").distinct().join(read, "group", "left").join(F.broadcast(total)).select(
        "group", F.coalesce("read", F.lit(0)).alias("read"), (F.col("total") - F.coalesce("read", F.lit(0))).alias("unread"), F.coalesce("twice", F.lit(0)).alias("twice"))
