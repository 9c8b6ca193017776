"""Placing and refusing outgoing records; replies and fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.sources.logs import number_rows


def keyed_partition(key, partitions: int) -> Column:
    """CRC-32 of a non-empty key modulo the partitions; null for a null or empty key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.octet_length(key) > 0, F.pmod(F.crc32(key.cast("binary")), F.lit(partitions)).cast("int"))


def place(df: DataFrame, partitions: int, order: list[str], key: str = "key", pin: str | None = None) -> DataFrame:
    """Adds `partition`: the pin where there is one (null if the topic has no such partition), else by the
    key, else in turn over the topic's keyless records in `order`. A stream has no turn to take, so
    there keyless records are dealt by a hash of `order`, which tells them apart."""
    if partitions < 1:
        raise ValueError("a topic has at least one partition")
    by_key = keyed_partition(key, partitions)
    pinned = F.col(pin) if pin else F.lit(None).cast("int")
    eligible = pinned.isNull() & by_key.isNull()
    df = df.withColumn("_turn", eligible)
    keyed = df.where(~F.col("_turn")).withColumn("partition", F.when(pinned.isNotNull(), F.when(pinned.between(0, partitions - 1), pinned.cast("int"))).otherwise(by_key))
    if df.isStreaming:
        dealt = df.where("_turn").withColumn("partition", F.pmod(F.xxhash64(*order), F.lit(partitions)).cast("int"))
        return keyed.unionByName(dealt).drop("_turn")
    if df.where("_turn").limit(1).count() == 0:
        return keyed.drop("_turn")
    turned = number_rows(df.where("_turn"), ["topic"], order, "_n").withColumn("partition", F.pmod("_n", F.lit(partitions)).cast("int")).drop("_n")
    return keyed.unionByName(turned).drop("_turn")


def round_robin(df: DataFrame, partitions: int, order: list[str], headers: str = "headers", pin: str = "pin") -> DataFrame:
    """Batch: gives each record without a key header and without a pin the next of `partitions` pins; any
    key header, an empty one too, leaves a record alone."""
    if partitions < 1:
        raise ValueError("round robin needs at least one partition")
    free = R.wire_key(headers).isNull() & ~F.exists(F.coalesce(F.col(headers), R.no_headers()), lambda h: F.lower(h["key"]) == R.KEY_HEADER) & F.col(pin).isNull()
    df = df.withColumn("_free", free)
    turned = number_rows(df.where("_free"), [], order, "_n").withColumn(pin, F.pmod("_n", F.lit(partitions)).cast("int")).drop("_n")
    return df.where(~F.col("_free")).unionByName(turned).drop("_free")


def refuse(df: DataFrame, partitions: int, max_bytes: int = 1048576, fenced: str | None = None, pin: str | None = None) -> DataFrame:
    """Adds `reason`, null where the record is accepted; the first that holds of: illegal topic, too
    large, fenced or closed transaction, unknown partition."""
    no = F.lit(False)
    bad_pin = F.coalesce(~F.col(pin).between(0, partitions - 1), no) if pin else no
    reason = F.when(~R.legal_topic("topic"), "illegal_topic").when(R.record_size() > max_bytes, "too_large")
    reason = reason.when(F.coalesce(F.col(fenced), no) if fenced else no, "fenced").when(bad_pin, "unknown_partition")
    return df.withColumn("reason", reason)


def placement_balance(df: DataFrame) -> DataFrame:
    """(topic, partition, n, skew): rows of each partition against its topic's mean over used ones."""
    n = df.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    mean = n.groupBy("topic").agg(F.avg("n").alias("mean"))
    return n.join(mean, "topic").select("topic", "partition", "n", (F.col("n") / F.col("mean")).alias("skew"))


def reply(df: DataFrame, topic: str, *fields, key=None) -> DataFrame:
    """One output record for each input: the fields as JSON, the key carried where one is given."""
    carried = (F.col(key) if isinstance(key, str) else key) if key is not None else F.lit(None)
    return df.select(F.lit(topic).alias("topic"), carried.cast("binary").alias("key"), F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def fan_out(df: DataFrame, items, keep: list[str]) -> DataFrame:
    """Several records for each input: one for each element of an array, with its place in the set."""
    return df.select(*keep, F.posexplode(items).alias("ordinal", "item"))


def all_or_nothing(df: DataFrame, items, bad, keep: list[str]) -> DataFrame:
    """Fan-out of inputs none of whose elements is bad; an input with a bad element gives nothing."""
    return fan_out(df.where(~F.exists(items, bad)), items, keep)


def all_or_nothing_rows(rows: DataFrame, key: str, bad) -> DataFrame:
    """The same where elements are rows: a key with a bad row loses all its rows."""
    spoiled = rows.where(F.coalesce(bad, F.lit(False))).select(key).distinct()
    return rows.join(spoiled, key, "left_anti")


def write_log(df: DataFrame, target: str | dict, fmt: str = "parquet", mode: str = "append") -> None:
    """Publishes records: by the connector with fmt="kafka" (at least once), else as files partitioned by
    topic, so that reading one topic prunes the others."""
    if fmt == "kafka":
        df.select(*[c for c in ("topic", "key", "value", "headers", "partition") if c in df.columns]).write.format("kafka").option("includeHeaders", "true").options(**target).save()
    else:
        df.write.format(fmt).mode(mode).partitionBy("topic").save(target)
