"""Log tables derived from the given tables, and the same as SQL for the oracles.

The logs come with their offsets here, as stored logs do. Where a table has to be turned into a log,
sources.logs.topic_log does it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import records as R

PARTITIONS = 4


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def event_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    key = F.col("user_id").cast("string").cast("binary")
    return e.select("event_id", "user_id", "event_type", F.col("value").alias("amount"), F.col("props"), F.concat(F.lit("events."), "event_type").alias("topic"), key.alias("key"), F.col("props").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"), R.no_headers().alias("headers"))


def event_log(spark: SparkSession, d: str) -> DataFrame:
    """The events with offsets. They are numbered within each hour of a partition, from a base that a small
    table of one row for each hour and partition gives, so no task holds a whole partition of the log."""
    rows = event_rows(spark, d).withColumn("partition", F.pmod(F.crc32("key"), F.lit(PARTITIONS)).cast("int"))
    rows = rows.withColumn("_hour", F.floor(F.unix_micros("timestamp") / 3_600_000_000))
    place = ["topic", "partition", "_hour"]
    before = Window.partitionBy("topic", "partition").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*place).agg(F.count("*").alias("_n")).select(*[F.col(c).alias(f"_of_{c}") for c in place], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    same = F.lit(True)
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    own = Window.partitionBy(*place).orderBy("timestamp", "event_id")
    out = rows.withColumn("_number", F.row_number().over(own) - 1).join(base, same)
    return out.withColumn("offset", (F.col("_base") + F.col("_number")).cast("bigint")).withColumn("sequence", F.col("event_id")).drop("_hour", "_number", "_base", *[f"_of_{c}" for c in place])


def outcomes(log: DataFrame) -> DataFrame:
    outcome = F.when(F.col("event_id") % 97 == 5, "retry").when(F.col("event_type") == "error", "drop").otherwise("ack")
    return log.withColumn("outcome", outcome).withColumn("delay_ms", F.lit(0).cast("bigint"))


def group_offsets(bounds: DataFrame) -> DataFrame:
    """The committed offsets of group g1: half way where the partition is even, past the end in 1, none in 3."""
    nxt = F.when(F.col("partition") % 2 == 0, F.floor(F.col("end") / 2)).otherwise(F.col("end") + 10)
    return bounds.where("partition <> 3").select("topic", "partition", nxt.cast("bigint").alias("next_offset"))


def transactions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The event log with transactional_id, epoch and txn, and its markers."""
    log = event_log(spark, d)
    top = log.agg(F.floor(F.max("event_id") / 50).alias("top"))
    log = log.join(F.broadcast(top)).withColumn("n", F.floor(F.col("event_id") / 50)).withColumn("uid", F.concat(F.lit("user-"), F.col("user_id") % 8))
    last = F.col("n") == F.col("top")
    outside = last & (F.col("uid") != "user-0")
    log = log.withColumns({"transactional_id": F.when(~outside, F.col("uid")), "epoch": F.when(~outside, F.when(last, 2).otherwise(1)).cast("bigint"), "txn": F.when(~outside, F.col("n")).cast("bigint")})
    marked = log.where("transactional_id is not null and n <> top - 1").select("transactional_id", "epoch", "txn", F.when((F.col("n") % 5 == 0) & (F.col("n") < F.col("top")), "abort").otherwise("commit").alias("marker")).distinct()
    return log.drop("n", "uid", "top"), marked


def framed(spark: SparkSession, d: str) -> DataFrame:
    log = event_log(spark, d)
    k = F.get_json_object("props", "$.k").cast("bigint")
    return log.withColumn("value", F.when(F.col("event_id") % 50 == 0, F.col("value")).otherwise(R.add_envelope(1 + F.pmod(k, F.lit(3)), "value")))


#: Registry of the framed events: ids 1 to 3 are known in two subjects, 3 is Avro.
SCHEMAS = [
    (1, "events-value", 1, "JSON", '{"title":"EventOne","type":"object"}'),
    (2, "events-value", 2, "JSON", '{"title":"EventTwo","type":"object"}'),
    (4, "events.view-value", 1, "AVRO", '{"type":"record","name":"View","namespace":"acme","fields":[{"name":"k","type":"long"}]}'),
    (5, "events.click-value", 1, "JSON", '{"title":"Click","type":"object"}'),
]
SCHEMA_DDL = "id bigint, subject string, version int, schema_type string, definition string"


def schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCHEMAS, SCHEMA_DDL)


# ---- SQL ----

_CRC = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(k)+1), lambda i: ascii(substr(k, i::int, 1))::UBIGINT)), lambda a, b: list_reduce(list_prepend(xor(a,b), [0::UBIGINT,0,0,0,0,0,0,0]), lambda x, y: CASE WHEN (x & 1)=1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT)"

LOG = f"""keys AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS k FROM events),
placed AS (SELECT k, CAST(({_CRC}) % 4 AS INTEGER) AS partition FROM keys),
log AS (SELECT event_id, user_id, event_type, value AS amount, props, 'events.' || event_type AS topic, k AS key, props AS payload, ts, partition,
  row_number() OVER (PARTITION BY event_type, partition ORDER BY ts, event_id) - 1 AS "offset", event_id AS sequence
  FROM events JOIN placed ON k = CAST(user_id AS VARCHAR)),
bounds AS (SELECT topic, partition, min("offset") AS earliest, max("offset") + 1 AS "end" FROM log GROUP BY ALL),
committed AS (SELECT topic, partition, CASE WHEN partition % 2 = 0 THEN "end" // 2 ELSE "end" + 10 END AS next_offset FROM bounds WHERE partition <> 3)"""

OUT = f"""{LOG}, out AS (SELECT *, CASE WHEN event_id % 97 = 5 THEN 'retry' WHEN event_type = 'error' THEN 'drop' ELSE 'ack' END AS outcome FROM log)"""

TXN = f"""{LOG}, top AS (SELECT max(event_id) // 50 AS t FROM events),
tx AS (SELECT log.*, event_id // 50 AS n, t,
  CASE WHEN event_id // 50 = t AND user_id % 8 <> 0 THEN NULL ELSE 'user-' || (user_id % 8) END AS transactional_id,
  CASE WHEN event_id // 50 = t THEN 2 ELSE 1 END AS epoch FROM log, top),
stated AS (SELECT *, CASE WHEN transactional_id IS NULL THEN 'committed' WHEN n = t - 1 THEN 'pending' WHEN n % 5 = 0 AND n < t THEN 'aborted' ELSE 'committed' END AS txn_state FROM tx)"""

FRAMED = f"""{LOG}, framed AS (SELECT *, event_id % 50 <> 0 AS is_framed, CASE WHEN event_id % 50 <> 0 THEN 1 + CAST(json_extract(props, '$.k') AS BIGINT) % 3 END AS schema_id FROM log)"""
