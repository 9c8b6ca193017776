"""Logs as DataFrames: reading, subscribing, positions, isolation and bounds.

A log row has topic, partition, offset, timestamp, key, value, headers and, where it is known,
sequence, transactional_id, epoch and txn_state. Every function takes and returns DataFrames; those
that say `batch` need a static one. Small per-partition tables are joined without a forced broadcast:
Spark broadcasts them by their measured size.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.sources.checkpoints import checkpoint

SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary, headers array<struct<key:string,value:binary>>"
PLACE = ["topic", "partition"]


def read_log(spark: SparkSession, source: str | dict, fmt: str = "parquet", streaming: bool = False, **options) -> DataFrame:
    """The records of a log table (a path) or, with fmt="kafka", of topics by the connector's options,
    with key, headers, timestamp and full coordinates."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        return reader.format("kafka").option("includeHeaders", "true").options(**source, **options).load().drop("timestampType")
    if streaming:
        reader = reader.schema(options.pop("schema", SCHEMA))
    return reader.format(fmt).options(**options).load(source)


def slices(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows range-partitioned and checkpointed, so that each stays in the slice (`_slice`) it was put in."""
    return checkpoint(df.repartitionByRange(*[F.col(c) for c in by]).withColumn("_slice", F.spark_partition_id()))


#: Steps of a prefix scan: the total of a slice's rows, and what a row makes of all slices before its own
#: (`carry`) and of its slice up to itself (`own`). `last` is the last value that is not null.
_STEPS = {
    "sum": (F.sum, lambda carry, own: F.when(carry.isNull(), own).when(own.isNull(), carry).otherwise(carry + own)),
    "max": (F.max, F.greatest), "min": (F.min, F.least),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carry, own: F.coalesce(own, carry)),
}


def _scanned(ranged: DataFrame, groups: list[str], order: list[str], steps: dict, before: bool) -> DataFrame:
    """A prefix scan of sliced rows in two levels: each slice's totals are scanned over a table of one row
    for each slice and group, rows within a slice go on from there. No task has more of a group than
    its own slice's rows."""
    # Slices follow the order, so within a group they come one after the other.
    end = 0 if not before else -1
    own = Window.partitionBy("_slice", *groups).orderBy(*order)
    totals = ranged.withColumns({f"_v{i}": c for i, (_, c) in enumerate(steps.values())})
    lasts = [i for i, (kind, _) in enumerate(steps.values()) if kind == "last"]
    place = F.struct(*order)
    totals = totals.groupBy("_slice", *groups).agg(*[
        (F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), place)) if i in lasts else _STEPS[kind][0](F.col(f"_v{i}"))).alias(f"_t{i}") for i, (kind, _) in enumerate(steps.values())
    ])
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("_slice").alias("_at"), *[F.col(g).alias(f"_of_{g}") for g in groups], *[_STEPS[kind][0](F.col(f"_t{i}")).over(earlier).alias(f"_c{i}") for i, (kind, _) in enumerate(steps.values())])
    on = F.col("_slice") == F.col("_at")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    made = {name: _STEPS[kind][1](F.col(f"_c{i}"), _STEPS[kind][0](c).over(own.rowsBetween(Window.unboundedPreceding, end))) for i, (name, (kind, c)) in enumerate(steps.items())}
    return ranged.join(totals, on).withColumns(made).drop("_at", *[f"_of_{g}" for g in groups], *[f"_c{i}" for i in range(len(steps))])


def prefix_scan(df: DataFrame, groups: list[str], order: list[str], steps: dict, before: bool = False) -> DataFrame:
    """Batch: adds for each `name: (kind, column)` of steps the column's running sum, max, min or last value
    within `groups` by `order` (a total order), up to a row or, with `before`, up to the one in front of
    it (null for the first). A group of any share of the rows is spread over all tasks."""
    return _scanned(slices(df, [*groups, *order]), groups, order, steps, before).drop("_slice")


def _ranked(ranged: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Ranks from 0 of sliced rows: how many are in front of each."""
    out = _scanned(ranged, groups, order, {name: ("sum", F.lit(1).cast("bigint"))}, True)
    return out.withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def number_rows(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Batch: adds `name`, the row's rank from 0 by `order` (a total order) within `groups`, without
    putting a whole group in one task."""
    return _ranked(slices(df, [*groups, *order]), groups, order, name).drop("_slice")


def topic_log(df: DataFrame, order: list[str], partitions: int = 4) -> DataFrame:
    """Batch: turns rows (topic, key, value, timestamp, optional pin and headers) into a log: placed on
    partitions, with dense offsets and a global sequence in publish order. One set of slices, in
    publish order, serves both numberings."""
    from tidelog.operators.placement import place

    sliced = slices(place(df, partitions, order), order)
    return _ranked(_ranked(sliced, PLACE, order, "offset"), [], order, "sequence").drop("_slice")


def _names(names) -> list[str]:
    names = [names] if isinstance(names, str) else list(names)
    if not names or any(not n for n in names):
        raise ValueError("a subscription names at least one topic, and no empty one")
    if any(n.startswith("^") for n in names):
        raise ValueError("a pattern is subscribed to with subscribe_pattern")
    return names


def subscribe_topics(log: DataFrame, names) -> DataFrame:
    """One or several named topics. Prunes files where the log is partitioned by topic."""
    return log.where(F.col("topic").isin(_names(names)))


def subscribe_pattern(log: DataFrame, *patterns: str) -> DataFrame:
    """Every topic that matches any of the patterns, each of which starts with ^."""
    if not patterns or any(not p.startswith("^") for p in patterns):
        raise ValueError("a pattern starts with ^")
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.col("topic").rlike(p)
    return log.where(hit)


def subscribe_partitions(log: DataFrame, topic: str, partitions: list[int]) -> DataFrame:
    """Named partitions of one topic."""
    if not partitions:
        raise ValueError("no partition is named")
    return log.where((F.col("topic") == _names(topic)[0]) & F.col("partition").isin(list(partitions)))


def log_bounds(log: DataFrame) -> DataFrame:
    """(topic, partition, earliest, end): the first offset and one past the last."""
    return log.groupBy(*PLACE).agg(F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("end"))


def resume_positions(bounds: DataFrame, committed: DataFrame, reset: str = "earliest") -> DataFrame:
    """(topic, partition, start, reset_used): where a group resumes: at its committed offset if that is
    within 0..end, else at the reset: earliest (0), latest (end) or error (start is null)."""
    if reset not in ("earliest", "latest", "error"):
        raise ValueError(f"unknown reset {reset!r}")
    other = {"earliest": F.lit(0).cast("bigint"), "latest": F.col("end"), "error": F.lit(None).cast("bigint")}[reset]
    ok = F.coalesce(F.col("next_offset").between(0, F.col("end")), F.lit(False))
    return bounds.join(committed.select(*PLACE, "next_offset"), PLACE, "left").select(*PLACE, F.when(ok, F.col("next_offset")).otherwise(other).alias("start"), (~ok).alias("reset_used"))


def starting_offsets(positions: DataFrame) -> str:
    """The connector's startingOffsets JSON of (topic, partition, start): one entry for each partition."""
    out: dict = {}
    for r in positions.orderBy(*PLACE).collect():
        out.setdefault(r.topic, {})[str(r.partition)] = -2 if r.start is None else r.start
    return json.dumps(out)


def start_positions(log: DataFrame, position: str, value=None, reset: str = "earliest", topic: str | None = None, partition: int | None = None) -> DataFrame:
    """(topic, partition, start) of a position: `earliest`, `latest`, `timestamp` (first offset at or
    after value, else the end; records of any visibility count), `offset` (value in the named
    partition) or `topic_offset` (in the named partition of the named topic). An offset outside the
    log falls to the reset; a partition that is not named keeps the reset too."""
    ends = log.groupBy(*PLACE).agg((F.max("offset") + 1).alias("end"), F.min(F.when(F.col("timestamp") >= F.lit(value), F.col("offset"))).alias("at") if position == "timestamp" else F.lit(None).cast("bigint").alias("at"))
    if position in ("earliest", "latest"):
        start = F.lit(0).cast("bigint") if position == "earliest" else F.col("end")
    elif position == "timestamp":
        start = F.coalesce("at", "end")
    elif position in ("offset", "topic_offset"):
        if partition is None or (position == "topic_offset" and topic is None):
            raise ValueError("an offset position names its partition")
        named = (F.col("partition") == partition) & (F.lit(True) if topic is None else F.col("topic") == topic)
        fall = F.lit(0).cast("bigint") if reset == "earliest" else F.col("end")
        start = F.when(named & F.lit(value).between(0, F.col("end")), F.lit(value).cast("bigint")).otherwise(fall)
    else:
        raise ValueError(f"unknown position {position!r}")
    return ends.select(*PLACE, start.alias("start"))


def from_positions(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Records at or after their partition's start; partitions without one are left out."""
    return log.join(positions.select(*PLACE, "start"), PLACE).where("offset >= start").drop("start")


def start_at(log: DataFrame, position: str, value=None, **named) -> DataFrame:
    return from_positions(log, start_positions(log, position, value, **named))


def txn_state() -> Column:
    """A record's state; one whose state is not known (null) is outside any transaction, so committed."""
    return F.coalesce("txn_state", F.lit("committed"))


def read_isolated(log: DataFrame, level: str = "read_committed", positions: DataFrame | None = None) -> DataFrame:
    """Records visible from each partition's position (0 where none is given). read_committed leaves out
    aborted records and stops in front of the first pending one at or after the position;
    read_uncommitted gives every data record. Control entries are never given. See `txn_state` for nulls."""
    here = log if positions is None else from_positions(log, positions)
    here = here.withColumn("txn_state", txn_state())
    if level == "read_uncommitted":
        return here.where("txn_state <> 'control'")
    if level != "read_committed":
        raise ValueError(f"unknown isolation {level!r}")
    stop = here.groupBy(*PLACE).agg(F.min(F.when(F.col("txn_state") == "pending", F.col("offset"))).alias("stop"))
    return here.join(stop, PLACE).where("txn_state = 'committed' and (stop is null or offset < stop)").drop("stop")


def lag(log: DataFrame, committed: DataFrame, level: str = "read_committed") -> DataFrame:
    """(topic, partition, lag): records that a group is still to be handed; 0 where none."""
    places = log.select(*PLACE).distinct()
    start = places.join(committed.select(*PLACE, "next_offset"), PLACE, "left").select(*PLACE, F.coalesce("next_offset", F.lit(0)).alias("start"))
    n = read_isolated(log, level, start).groupBy(*PLACE).agg(F.count("*").alias("lag"))
    return places.join(n, PLACE, "left").select(*PLACE, F.coalesce("lag", F.lit(0)).alias("lag"))


def published_order(log: DataFrame, topic: str) -> DataFrame:
    """Committed records of a topic in publish order over its partitions. See `txn_state` for nulls."""
    return log.where((F.col("topic") == topic) & (txn_state() == "committed")).orderBy("sequence")


def bounded_batches(log: DataFrame, size: int) -> DataFrame:
    """Batch: adds `batch`, so that each partition's records come in order in batches of at most `size`,
    none of them empty."""
    if size < 1:
        raise ValueError("a batch holds at least one record")
    first = log.groupBy(*PLACE).agg(F.min("offset").alias("first"))
    return log.join(first, PLACE).withColumn("batch", F.floor((F.col("offset") - F.col("first")) / size)).drop("first")


# ---- projections ----


def with_context(log: DataFrame) -> DataFrame:
    """The metadata a handler sees as plain columns."""
    return log.select(*PLACE, "offset", F.unix_millis("timestamp").alias("timestamp_millis"), F.col("key").cast("string").alias("key"), R.source_text().alias("source"), F.struct("topic", "partition", "offset").alias("position"))


def archive_index(log: DataFrame, *patterns: str) -> DataFrame:
    """One index row for each record of the matched topics."""
    return subscribe_pattern(log, *patterns).select(*PLACE, "offset")


def tag_origin(frames: dict[str, DataFrame], id_col: str) -> DataFrame:
    """History of several frames, each row with its origin."""
    parts = [df.select(F.col(id_col).alias("id"), F.lit(name).alias("topic")) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def flag(log: DataFrame, over, valid=None) -> DataFrame:
    """Keeps valid records and flags those for which `over` holds (null counts as no)."""
    kept = log if valid is None else log.where(F.coalesce(valid, F.lit(False)))
    return kept.withColumn("flagged", F.coalesce(over, F.lit(False)))


def size_profile(log: DataFrame) -> DataFrame:
    """(topic, n, total_bytes, largest) of the records' sizes as the broker's limit counts them."""
    return log.withColumn("_s", R.record_size()).groupBy("topic").agg(F.count("*").alias("n"), F.sum("_s").alias("total_bytes"), F.max("_s").alias("largest"))


def source_lineage(outputs: DataFrame, log: DataFrame) -> DataFrame:
    """(output_id, topic, partition, offset, status): outputs (output_id, source) with the record their
    coordinates name: `found`, `lost` (the log has no such record) or, with a null output_id, `silent`
    for records that no output names."""
    parsed = outputs.select("output_id", R.parse_source("source").alias("s")).select("output_id", "s.*")
    known = log.select(*PLACE, "offset", F.lit(True).alias("held"))
    both = parsed.withColumn("named", F.lit(True)).join(known, [*PLACE, "offset"], "full_outer")
    status = F.when(F.col("named").isNull(), "silent").when(F.col("held").isNull(), "lost").otherwise("found")
    return both.select("output_id", *PLACE, "offset", status.alias("status"))
