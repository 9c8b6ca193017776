"""Registered queries of the streaming forms: each runs its stream to the end of what there is, in several
micro-batches, and is held against the same SQL as the batch form."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.operators import placement as K
from tidelog.operators import readers as D
from tidelog.operators import settle as C
from tidelog.operators import txn as X
from tidelog.plans.fixtures import LOG, OUT, event_log, event_rows, outcomes, table
from tidelog.sources import logs as L
from tidelog.sources.checkpoints import checkpoint, shared_folder
from tidelog.sources.stream_source import register
from tidelog.streaming import flows, numbering, tracking
from tidelog.streaming.commits import _Files

QUERIES: dict = {}
ORACLES: dict = {}
PARTS = 3


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


@contextmanager
def _folder(s):
    """A shared folder of this run, gone at its end."""
    target = f"{shared_folder(s)}/{uuid.uuid4().hex}"
    try:
        yield target
    finally:
        _Files(s).delete(target)


@contextmanager
def _rocksdb(s):
    """The state store that keyed state needs, for as long as a query runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    had = s.conf.get(name, None)
    s.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        s.conf.set(name, had) if had else s.conf.unset(name)


def _stored(s, d, folder):
    """The event log as write_log stores it, each record's event in a header."""
    log = event_log(s, d).withColumn("headers", F.array(R.header("event", F.col("event_id").cast("string"))))
    K.write_log(log.select("topic", "partition", "offset", "timestamp", "key", "value", "headers"), f"{folder}/log")
    return f"{folder}/log"


def _event():
    return R.header_value("headers", "event").cast("bigint")


def _bounded(s, d, folder):
    """The stored log as a stream of PARTS micro-batches or more."""
    path = _stored(s, d, folder)
    n = s.read.parquet(path).count()
    return flows.read_bounded(s, path, max(1, -(-n // PARTS)), progress=f"{folder}/planned")


def _run(stream, folder, write):
    """Runs a stream until its source has no more than is there now: a bounded source goes on over triggers."""
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def _told(log):
    return log.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("payload"), F.unix_micros("timestamp").alias("micros"))


@query(f"""WITH {LOG} SELECT topic, partition, "offset", key, payload, epoch_us(ts) AS micros FROM log""")
def write_log(s, d):
    """What is read back of a log that was written."""
    with _folder(s) as folder:
        return checkpoint(_told(L.read_log(s, _stored(s, d, folder))))


@query(f"""WITH {LOG} SELECT topic, partition, max("offset") + 1 AS next_offset, count(*) AS n FROM log GROUP BY ALL""")
def eos_sink(s, d):
    """Positions and rows of the exactly-once sink, after a batch that died between its output and its
    commit, and a second run of an empty checkpoint that reads the first one's records again."""
    with _folder(s) as folder:
        path, out = _stored(s, d, folder), f"{folder}/out"
        register(s)
        read = lambda **o: s.readStream.format("tidelog").options(path=path, **o).load()
        flows.eos_sink(read(topics="events.view,events.click"), out, f"{folder}/c1", _told).awaitTermination()
        half = f"{out}/data/attempt=e1-lost-7-x"
        _told(s.read.parquet(path).limit(50)).write.parquet(half)
        flows.eos_sink(read(), out, f"{folder}/c2", _told, ordered=True).awaitTermination()
        n = flows.committed_output(s, out).groupBy("topic", "partition").agg(F.count("*").alias("n"))
        return checkpoint(flows.committed_positions(s, out).join(n, ["topic", "partition"]))


@query(f"""WITH {LOG}, begun AS (SELECT topic, partition, coalesce(min("offset") FILTER (WHERE ts >= TIMESTAMP '2024-01-15'), max("offset") + 1) AS start FROM log GROUP BY ALL)
SELECT event_id, topic, partition, "offset" FROM log JOIN begun USING (topic, partition) WHERE "offset" >= start""")
def log_source(s, d):
    """The log's own source from a moment on, in micro-batches of a bounded number of records."""
    with _folder(s) as folder:
        path = _stored(s, d, folder)
        size = max(1, s.read.parquet(path).count() // PARTS)
        stream = flows.read_bounded(s, path, size, progress=f"{folder}/planned", start="timestamp:1705276800000")
        _run(stream.select(_event().alias("event_id"), "topic", "partition", "offset"), folder, lambda b, k: b.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"))
        return checkpoint(s.read.parquet(f"{folder}/out").drop("batch"))


@query(f"""WITH {OUT} SELECT topic, partition, coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) AS next_offset FROM out GROUP BY ALL
HAVING count(*) FILTER (WHERE outcome <> 'retry') > 0 AND coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) > 0""")
def tracked_stream(s, d):
    """Tracked positions as keyed state, over micro-batches; what settles does so right after its delivery."""
    with _folder(s) as folder, _rocksdb(s):
        log = _bounded(s, d, folder)
        settles = F.when(_event() % 97 == 5, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        events = log.withColumn("settles", F.explode(settles)).select("topic", "partition", (F.col("offset") * 2 + F.col("settles").cast("int")).alias("seq"), "offset", F.lit(0).alias("generation"), "settles")
        _run(tracking.tracked_positions(events), folder, lambda b, k: b.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"))
        last = s.read.parquet(f"{folder}/out").groupBy("topic", "partition").agg(F.max_by(F.struct("next_offset"), "batch").alias("x"))
        return checkpoint(last.select("topic", "partition", "x.next_offset").where("next_offset is not null"))


@query(f"""WITH {OUT}, win AS (SELECT *, event_id // 40 AS "window", amount > 400 AS failed FROM out)
SELECT "window", count(*) AS n, NOT bool_or(failed) AS committed FROM win GROUP BY 1 HAVING bool_or(failed) OR bool_and(outcome <> 'retry')""")
def windows_stream(s, d):
    """Commit windows as keyed state: records are enrolled as they come, settled or failed a batch later. A
    window with a record that is still to be retried stays open."""
    with _folder(s) as folder, _rocksdb(s):
        # Numbered once, not anew for each part of it.
        C.settle(outcomes(event_log(s, d))).select(F.floor(F.col("event_id") / 40).alias("window"), "topic", "partition", "offset", "settled", "amount").write.parquet(f"{folder}/log")
        log = s.read.parquet(f"{folder}/log")
        enrolled = log.select("window", "topic", "partition", "offset", F.lit("enrolled").alias("event"))
        ended = log.where("settled or amount > 400").select("window", "topic", "partition", "offset", F.when(F.col("amount") > 400, "failed").otherwise("settled").alias("event"))
        closed = log.groupBy("window").agg(F.count("*").alias("offset")).select("window", F.lit("").alias("topic"), F.lit(0).alias("partition"), "offset", F.lit("closed").alias("event"))
        for k, part in enumerate((ended.where("offset % 2 = 0"), enrolled, closed.unionByName(ended.where("offset % 2 = 1")))):
            part.write.mode("append").parquet(f"{folder}/in")
            stream = s.readStream.schema(enrolled.schema).parquet(f"{folder}/in")
            _run(tracking.commit_windows(stream), folder, lambda b, k: b.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"))
        return checkpoint(s.read.parquet(f"{folder}/out").drop("batch"))


@query(f'WITH {LOG} SELECT event_id, topic, partition, "offset", row_number() OVER (ORDER BY ts, event_id) - 1 AS sequence FROM log')
def topic_log_stream(s, d):
    """A log numbered over several starts of a stream, each of one part of the events."""
    with _folder(s) as folder:
        rows = event_rows(s, d).select("event_id", "topic", "key", "value", "timestamp")
        cut = rows.select(F.percentile_approx(F.unix_micros("timestamp"), F.array(*[F.lit((k + 1) / PARTS) for k in range(PARTS - 1)])).alias("q")).first().q
        part = sum((F.unix_micros("timestamp") > q).cast("int") for q in cut)
        for k in range(PARTS):
            rows.where(part == k).write.mode("append").parquet(f"{folder}/in")
            stream = s.readStream.schema(rows.schema).parquet(f"{folder}/in")
            numbering.stream_topic_log(stream, f"{folder}/out", f"{folder}/c", ["timestamp", "event_id"]).awaitTermination()
        return checkpoint(numbering.read_streamed_log(s, f"{folder}/out").select("event_id", "topic", "partition", "offset", "sequence"))


@query("""WITH t AS (SELECT event_id, row_number() OVER (ORDER BY event_id % 2, event_id) - 1 AS turn FROM events WHERE event_id % 3 = 0 AND event_id % 5 > 0)
SELECT event_id, CAST(coalesce(CASE WHEN event_id % 5 = 0 THEN 9 ELSE turn % 4 END, -1) AS INTEGER) AS pin FROM events LEFT JOIN t USING (event_id)""")
def round_robin_stream(s, d):
    """Turns that go on from one start of a stream to the next: even events first, then odd ones."""
    with _folder(s) as folder:
        keyed = F.array(R.header(R.KEY_HEADER, F.lit("")))
        rows = event_rows(s, d).select("event_id", "topic", F.when(F.col("event_id") % 3 == 0, R.no_headers()).otherwise(keyed).alias("headers"), F.when(F.col("event_id") % 5 == 0, 9).cast("int").alias("pin"))
        for k in range(2):
            rows.where(F.col("event_id") % 2 == k).write.mode("append").parquet(f"{folder}/in")
            stream = s.readStream.schema(rows.schema).parquet(f"{folder}/in")
            numbering.stream_round_robin(stream, f"{folder}/out", f"{folder}/c", 4, ["event_id"]).awaitTermination()
        return checkpoint(numbering.read_streamed_log(s, f"{folder}/out").select("event_id", F.coalesce("pin", F.lit(-1)).alias("pin")))


@query("SELECT event_id FROM events")
def dedupe_stream(s, d):
    """Each source record's output once, though every eleventh came twice, within the watermark."""
    with _folder(s) as folder:
        log = event_log(s, d).select("event_id", "timestamp", F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"), F.lit(0).alias("ordinal"))
        log.unionByName(log.where("event_id % 11 = 0")).write.parquet(f"{folder}/in")
        stream = X.dedupe_stream_by_source(s.readStream.schema(log.schema).parquet(f"{folder}/in"))
        _run(stream, folder, lambda b, k: b.select("event_id").write.mode("overwrite").parquet(f"{folder}/out/batch={k}"))
        return checkpoint(s.read.parquet(f"{folder}/out").drop("batch"))


@query("""WITH o AS (SELECT o_custkey AS account, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderkey % 3 AS part FROM orders)
SELECT account, CAST(sum(amount) AS DOUBLE) AS balance, 2 AS revision FROM o GROUP BY 1""")
def rebuild_stream(s, d):
    """A read model kept over three micro-batches; the second brings a new revision, so it starts over there."""
    with _folder(s) as folder:
        o = table(s, d, "orders").select(F.lit("ledger").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").cast("bigint").alias("offset"), F.col("o_custkey").alias("account"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), (F.col("o_orderkey") % 3).alias("part"))
        rows = o.withColumns({"offset": F.col("part") * 10_000_000_000 + F.col("offset"), "revision": F.when(F.col("part") == 0, 1).otherwise(2)})
        for k in range(3):
            rows.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{folder}/in")
            stream = s.readStream.schema(rows.drop("part").schema).parquet(f"{folder}/in")
            flows.rebuilding_model(stream, lambda: s.read.parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/c").awaitTermination()
        return checkpoint(flows.model_now(s, f"{folder}/out").select("account", F.col("balance").cast("double").alias("balance"), "revision"))


_FIRST = '{"type":"record","name":"E","fields":[{"name":"k","type":"int"}]}'
_SECOND = '{"type":"object","properties":{"k":{"type":"integer"},"currency":{"$ref":"#/$defs/c"}},"required":["k","currency"],"$defs":{"c":{"type":"string"}}}'
_THIRD = '{"type":"record","name":"E","fields":[{"name":"k","type":"long"},{"name":"currency","type":["null","string"],"default":null},{"name":"tags","type":{"type":"map","values":"string"}}]}'
_READER = '{"type":"record","name":"E","fields":[{"name":"k","type":"long"},{"name":"currency","type":"string","default":"EUR"}]}'


@query("""SELECT event_id, CASE WHEN event_id % 10 IN (3, 9) OR event_id % 20 = 18 OR (event_id % 10 = 7) THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
CASE WHEN event_id % 10 IN (3, 7, 9) OR event_id % 20 = 18 THEN NULL WHEN event_id % 10 < 5 THEN 'EUR' ELSE 'USD' END AS currency,
CASE event_id % 10 WHEN 9 THEN 'unknown_id' WHEN 3 THEN 'unreadable: a union of 2 types' WHEN 7 THEN 'null for a field that is not nullable' ELSE CASE WHEN event_id % 20 = 18 THEN 'bad_json' END END AS failure FROM events""")
def fanin_registered(s, d):
    """Writers and reader from the registry's table alone."""
    versions = [(1, "AVRO", _FIRST), (2, "JSON", _SECOND), (3, "AVRO", _FIRST.replace('"int"', '["int","string"]')), (4, "AVRO", _THIRD), (7, "AVRO", _READER)]
    schemas = s.createDataFrame([(i, "events-value", i, kind, text) for i, kind, text in versions], "id bigint, subject string, version bigint, schema_type string, definition string")
    k, e = F.get_json_object("props", "$.k"), F.col("event_id")
    dollars = F.when(e % 20 == 18, '{"k": oops').otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "currency": "USD"}')))
    none = F.concat(F.lit('{"k": '), k, F.lit(', "currency": null, "tags": {"a": "b"}}'))
    at = e % 10
    value = F.when(at == 3, R.add_envelope(3, "props")).when(at == 7, R.add_envelope(4, none)).when(at < 5, R.add_envelope(1, "props")).when(at < 9, R.add_envelope(2, dollars)).otherwise(R.add_envelope(9, "props"))
    out = D.fanin_registered(event_log(s, d).withColumn("value", value), schemas, 7)
    return out.select("event_id", F.coalesce("evolved.k", F.lit(-1).cast("bigint")).alias("k"), "evolved.currency", "failure")
