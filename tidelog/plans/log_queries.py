"""Registered queries of the log operators: sources, records, settlement, placement, transactions, models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.operators import models as M
from tidelog.operators import placement as K
from tidelog.operators import settle as C
from tidelog.operators import txn as X
from tidelog.plans.fixtures import LOG, OUT, TXN, event_log, event_rows, group_offsets, outcomes, table, transactions
from tidelog.sources import logs as L

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def key_text(df):
    return df.withColumn("key", F.col("key").cast("string"))


# ---- sources ----


@query("SELECT event_id, event_type, epoch_us(ts) // 1000 AS millis FROM events")
def read_log(s, d):
    return L.read_log(s, f"{d}/events.parquet").select("event_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"))


@query(f'WITH {LOG} SELECT event_id, topic, key, partition, "offset", row_number() OVER (ORDER BY ts, event_id) - 1 AS sequence FROM log')
def topic_log(s, d):
    return key_text(L.topic_log(event_rows(s, d), ["timestamp", "event_id"])).select("event_id", "topic", "key", "partition", "offset", "sequence")


@query(f"WITH {LOG} SELECT topic, partition, count(*) AS n FROM log WHERE topic IN ('events.view', 'events.error') GROUP BY ALL")
def subscribe_topics(s, d):
    return L.subscribe_topics(event_log(s, d), ["events.view", "events.error"]).groupBy("topic", "partition").agg(F.count("*").alias("n"))


@query(f"WITH {LOG} SELECT topic, partition, count(*) AS n FROM log WHERE topic IN ('events.view', 'events.click', 'events.purchase') GROUP BY ALL")
def subscribe_pattern(s, d):
    return L.subscribe_pattern(event_log(s, d), r"^events\.(view|click)$", "^events.purch").groupBy("topic", "partition").agg(F.count("*").alias("n"))


@query(f"""WITH {LOG} SELECT event_id, partition, "offset" FROM log WHERE topic = 'events.view' AND partition IN (0, 3)""")
def subscribe_partitions(s, d):
    return L.subscribe_partitions(event_log(s, d), "events.view", [0, 3]).select("event_id", "partition", "offset")


@query(f"WITH {LOG} SELECT * FROM bounds")
def log_bounds(s, d):
    return L.log_bounds(event_log(s, d))


@query(f"""WITH {LOG} SELECT b.topic, b.partition, CASE WHEN next_offset BETWEEN 0 AND "end" THEN next_offset ELSE "end" END AS start,
NOT coalesce(next_offset BETWEEN 0 AND "end", false) AS reset_used FROM bounds b LEFT JOIN committed USING (topic, partition)""")
def resume_positions(s, d):
    bounds = L.log_bounds(event_log(s, d))
    return L.resume_positions(bounds, group_offsets(bounds), "latest")


@query(f"""WITH {LOG}, begun AS (SELECT topic, partition, coalesce(min("offset") FILTER (WHERE ts >= TIMESTAMP '2024-01-15'), max("offset") + 1) AS start FROM log GROUP BY ALL)
SELECT event_id, topic, partition, "offset" FROM log JOIN begun USING (topic, partition) WHERE "offset" >= start""")
def start_at(s, d):
    return L.start_at(event_log(s, d), "timestamp", "2024-01-15").select("event_id", "topic", "partition", "offset")


@query(f"""WITH {LOG} SELECT topic, partition, CASE WHEN topic = 'events.view' AND partition = 2 AND 5 <= "end" THEN 5 ELSE "end" END AS start FROM bounds""")
def start_at_offset(s, d):
    return L.start_positions(event_log(s, d), "topic_offset", 5, reset="latest", topic="events.view", partition=2)


@query(f"""WITH {TXN}, c AS (SELECT *, "offset" >= 10 AS here FROM stated), stop AS (SELECT topic, partition, min("offset") FILTER (WHERE txn_state = 'pending') AS s FROM c WHERE here GROUP BY ALL)
SELECT event_id, topic, partition, "offset" FROM c JOIN stop USING (topic, partition) WHERE here AND txn_state = 'committed' AND (s IS NULL OR "offset" < s)""")
def read_isolated(s, d):
    log, marks = transactions(s, d)
    # Where no transaction wrote a record its state is not known.
    stated = X.resolve_transactions(log, marks).withColumn("txn_state", F.expr("CASE WHEN transactional_id IS NOT NULL THEN txn_state END"))
    start = L.log_bounds(log).select("topic", "partition", F.lit(10).cast("bigint").alias("start"))
    return L.read_isolated(stated, "read_committed", start).select("event_id", "topic", "partition", "offset")


@query(f"""WITH {TXN} SELECT event_id, sequence, row_number() OVER (ORDER BY sequence) - 1 AS place
FROM stated WHERE topic = 'events.view' AND txn_state = 'committed'""")
def published_order(s, d):
    """place: where the operator's result really has the row, from its partition and its place there."""
    out = L.published_order(X.resolve_transactions(*transactions(s, d)), "events.view").select("event_id", "sequence")
    return L.number_rows(out.withColumn("at", F.monotonically_increasing_id()), [], ["at"], "place").drop("at")


@query(f"""WITH {LOG}, b AS (SELECT topic, partition, CAST("offset" // 64 AS BIGINT) AS batch FROM log) SELECT topic, partition, batch, count(*) AS n FROM b GROUP BY ALL""")
def bounded_batches(s, d):
    return L.bounded_batches(event_log(s, d), 64).groupBy("topic", "partition", "batch").agg(F.count("*").alias("n"))


@query(f"""WITH {TXN}, st AS (SELECT s.*, coalesce(next_offset, 0) AS nx FROM stated s LEFT JOIN committed USING (topic, partition)),
stop AS (SELECT topic, partition, min("offset") FILTER (WHERE txn_state = 'pending' AND "offset" >= nx) AS s FROM st GROUP BY ALL)
SELECT topic, partition, count(*) FILTER (WHERE txn_state = 'committed' AND "offset" >= nx AND (s IS NULL OR "offset" < s)) AS lag FROM st JOIN stop USING (topic, partition) GROUP BY ALL""")
def lag(s, d):
    stated = X.resolve_transactions(*transactions(s, d))
    return L.lag(stated, group_offsets(L.log_bounds(stated)))


# ---- records ----


@query(f"""WITH {LOG} SELECT topic, partition, "offset", epoch_us(ts) // 1000 AS timestamp_millis, key, partition || ':' || "offset" || ':' || topic AS source FROM log""")
def with_context(s, d):
    return L.with_context(event_log(s, d)).drop("position")


def _headed(s, d):
    note = F.when(F.col("event_id") % 2 == 0, F.lit("n")).cast("binary")
    rows = event_rows(s, d).withColumn("headers", F.array(R.header("Kafka-Partition-Key", F.lit("stale")), F.struct(F.lit("note").alias("key"), note.alias("value")), R.header(R.RETRY_HEADER, (F.col("event_id") % 3).cast("string")), R.header(R.SOURCE_HEADER, F.lit("1:2:a:b"))))
    return rows.withColumn("key", F.when(F.col("event_id") % 5 > 0, F.col("key")))


_TEXT = lambda h: F.array_join(F.transform(h, lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ";")


@query("""SELECT event_id, 'note=' || CASE WHEN event_id % 2 = 0 THEN 'n' ELSE '' END || ';retry-count=' || (event_id % 3) || ';kafka-eos-source=1:2:a:b' ||
CASE WHEN event_id % 5 > 0 THEN ';kafka-partition-key=' || user_id ELSE '' END AS headers FROM events""")
def normalize_headers(s, d):
    return _headed(s, d).select("event_id", _TEXT(R.normalize_headers("headers", "key")).alias("headers"))


@query("""SELECT event_id, 'stale' AS key, 2 AS n_headers, CAST(event_id % 3 AS VARCHAR) AS retry FROM events""")
def split_headers(s, d):
    h = R.wire_headers("headers")
    return _headed(s, d).select("event_id", R.wire_key("headers").cast("string").alias("key"), F.size(h).alias("n_headers"), R.header_value(h, R.RETRY_HEADER).alias("retry"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'n' END AS note, NULL::VARCHAR AS absent FROM events""")
def header_value(s, d):
    return _headed(s, d).select("event_id", R.header_value("headers", "note").alias("note"), R.header_value("headers", "absent").alias("absent"))


@query(f"""WITH {LOG} SELECT event_id, CAST(partition AS VARCHAR) AS by_partition, key AS by_key FROM log""")
def lane_key(s, d):
    return event_log(s, d).select("event_id", R.lane_key("partition").cast("string").alias("by_partition"), R.lane_key("record_key").cast("string").alias("by_key"))


@query("""SELECT p_partkey, p_name AS name, regexp_full_match(p_name, '[a-zA-Z0-9._-]{1,249}') AS legal, regexp_full_match(replace(p_name, ' ', '-'), '[a-zA-Z0-9._-]{1,249}') AS dashed FROM part""")
def legal_topic(s, d):
    return table(s, d, "part").select("p_partkey", F.col("p_name").alias("name"), R.legal_topic("p_name").alias("legal"), R.legal_topic(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))).alias("dashed"))


@query("""WITH s AS (SELECT 'events.' || event_type AS topic, 36 + CASE WHEN event_id % 5 > 0 THEN length(CAST(user_id AS VARCHAR)) ELSE 0 END + length(props)
+ (19 + 1 + 5 + 1) + (4 + 1 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END + 1) + (11 + 1 + 1 + 1) + (16 + 1 + 7 + 1) AS b FROM events)
SELECT topic, count(*) AS n, CAST(sum(b) AS BIGINT) AS total_bytes, CAST(max(b) AS BIGINT) AS largest FROM s GROUP BY 1""")
def record_size(s, d):
    return L.size_profile(_headed(s, d))


@query(f"""WITH {LOG}, o AS (SELECT event_id AS output_id, topic, partition, "offset" + CASE WHEN event_id % 7 = 0 THEN 1000000 ELSE 0 END AS "offset" FROM log WHERE event_id % 3 = 0)
SELECT coalesce(output_id, -1) AS output_id, coalesce(o.topic, l.topic) AS topic, coalesce(o.partition, l.partition) AS partition, coalesce(o."offset", l."offset") AS "offset",
CASE WHEN o.output_id IS NULL THEN 'silent' WHEN l.event_id IS NULL THEN 'lost' ELSE 'found' END AS status
FROM o FULL JOIN log l ON o.topic = l.topic AND o.partition = l.partition AND o."offset" = l."offset" """)
def source_lineage(s, d):
    log = event_log(s, d)
    at = F.col("offset") + F.when(F.col("event_id") % 7 == 0, 1000000).otherwise(0)
    out = log.where("event_id % 3 = 0").select(F.col("event_id").alias("output_id"), R.source_text("topic", "partition", at).alias("source"))
    return L.source_lineage(out, log).withColumn("output_id", F.coalesce("output_id", F.lit(-1).cast("bigint"))).withColumn("offset", F.coalesce("offset", F.lit(-1).cast("bigint"))).withColumn("partition", F.coalesce("partition", F.lit(-1)))


@query(f"""WITH {LOG} SELECT topic, partition, "offset" FROM log WHERE topic IN ('events.signup', 'events.error')""")
def archive_index(s, d):
    return L.archive_index(event_log(s, d), "^events.s", "^events.e")


@query("SELECT o_orderkey AS id, 'orders' AS topic FROM orders UNION ALL SELECT l_orderkey, 'cancellations' FROM lineitem WHERE l_returnflag = 'R'")
def tag_origin(s, d):
    lines = table(s, d, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return L.tag_origin({"orders": table(s, d, "orders"), "cancellations": lines}, "o_orderkey")


@query("SELECT event_id, value > 100 AS flagged FROM events WHERE value > 1")
def flag(s, d):
    return L.flag(table(s, d, "events"), F.col("value") > 100, F.col("value") > 1).select("event_id", "flagged")


# ---- settlement ----


@query(f"""WITH {OUT} SELECT event_id, outcome <> 'retry' AS settled, outcome = 'retry' AS aborts_window, false AS unsupported FROM out""")
def settle(s, d):
    return C.settle(outcomes(event_log(s, d)), "transactional").select("event_id", "settled", "aborts_window", "unsupported")


_TRACKED = """tracked AS (SELECT topic, partition, coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) AS next_offset FROM out GROUP BY ALL
HAVING count(*) FILTER (WHERE outcome <> 'retry') > 0 AND coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) > 0)"""


@query(f"WITH {OUT}, {_TRACKED} SELECT * FROM tracked")
def committed_positions(s, d):
    return C.committed_tracked(C.settle(outcomes(event_log(s, d))))


@query(f"""WITH {LOG} SELECT topic, partition, "end" AS next_offset FROM bounds""")
def committed_auto(s, d):
    return C.committed_auto(event_log(s, d))


_DELIVER = f"""{OUT}, sent AS (SELECT *, event_id AS delivery_seq, 0 AS generation FROM out UNION ALL SELECT *, 1000000000 + event_id, 1 FROM out WHERE "offset" >= 20 AND topic = 'events.view')"""


def _replayed(s, d):
    log = C.settle(outcomes(event_log(s, d))).withColumns({"delivery_seq": F.col("event_id"), "generation": F.lit(0)})
    again = log.where("offset >= 20 and topic = 'events.view'").withColumns({"delivery_seq": F.col("event_id") + 1000000000, "generation": F.lit(1)})
    return log.unionByName(again)


@query(f"""WITH {_DELIVER}, e AS (SELECT *, sum(CASE WHEN b THEN 1 ELSE 0 END) OVER w AS epoch FROM (SELECT *, coalesce("offset" <= lag("offset") OVER w2 OR generation <> lag(generation) OVER w2, false) AS b FROM sent WINDOW w2 AS (PARTITION BY topic, partition ORDER BY delivery_seq))
WINDOW w AS (PARTITION BY topic, partition ORDER BY delivery_seq))
SELECT topic, partition, CAST(epoch AS BIGINT) AS epoch, count(*) AS n, epoch = max(epoch) OVER (PARTITION BY topic, partition) AS current FROM e GROUP BY topic, partition, epoch""")
def read_epochs(s, d):
    return C.read_epochs(_replayed(s, d)).groupBy("topic", "partition", "epoch", "current").agg(F.count("*").alias("n"))


@query(f"""WITH {_DELIVER}, last AS (SELECT * FROM sent WHERE topic <> 'events.view' OR generation = 1)
SELECT topic, partition, coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) AS next_offset FROM last GROUP BY ALL
HAVING count(*) FILTER (WHERE outcome <> 'retry') > 0 AND coalesce(min("offset") FILTER (WHERE outcome = 'retry'), max("offset") + 1) > 0""")
def committed_after_replay(s, d):
    return C.committed_after_replay(_replayed(s, d))


@query(f"""WITH {OUT}, {_TRACKED} SELECT event_id, topic, partition, "offset", outcome <> 'retry' AS already_acked FROM out LEFT JOIN tracked USING (topic, partition) WHERE next_offset IS NULL OR "offset" >= next_offset""")
def redelivered_after_crash(s, d):
    log = C.settle(outcomes(event_log(s, d)))
    return C.redelivered_after_crash(log, C.committed_tracked(log)).select("event_id", "topic", "partition", "offset", "already_acked")


@query(f"""WITH {OUT}, {_TRACKED}, st AS (SELECT 'g1' AS "group", topic, partition, 0 AS epoch, next_offset FROM committed UNION ALL SELECT 'g1', topic, partition, CASE WHEN topic = 'events.view' THEN 1 ELSE 0 END, next_offset FROM tracked)
SELECT "group", topic, partition, CAST(max(epoch) AS INTEGER) AS epoch, arg_max(next_offset, epoch * 1000000000 + next_offset) AS next_offset FROM st GROUP BY ALL""")
def merge_offsets(s, d):
    log = C.settle(outcomes(event_log(s, d)))
    named = lambda df, e: df.select(F.lit("g1").alias("group"), "topic", "partition", e.alias("epoch"), "next_offset")
    return C.merge_offsets(named(group_offsets(L.log_bounds(log)), F.lit(0)), named(C.committed_tracked(log), F.when(F.col("topic") == "events.view", 1).otherwise(0)))


def _attempted(s, d):
    log = outcomes(event_log(s, d))
    return log.withColumn("headers", F.array(R.header("note", F.lit("n")), R.header(R.RETRY_HEADER, (F.col("event_id") % 4).cast("string")), R.header(R.SOURCE_HEADER, F.concat(F.lit("0:1:src."), "event_type"))))


@query(f"""WITH {OUT} SELECT event_id, 'src.' || event_type AS topic, CAST(event_id % 4 + 1 AS VARCHAR) AS retries, 3 AS n_headers FROM out WHERE outcome = 'retry' AND event_id % 4 + 1 < 3""")
def retry_copies(s, d):
    return C.retry_copies(_attempted(s, d), 3, "source").select("event_id", "topic", R.header_value("headers", R.RETRY_HEADER).alias("retries"), F.size("headers").alias("n_headers"))


@query(f"""WITH {OUT} SELECT event_id, 'events.dlq' AS topic, payload, CAST(event_id % 4 + 1 AS VARCHAR) AS retries FROM out WHERE outcome = 'retry' AND event_id % 4 + 1 >= 3""")
def dead_letters(s, d):
    return C.dead_letters(_attempted(s, d), 3, "events.dlq").select("event_id", "topic", F.col("value").cast("string").alias("payload"), R.header_value("headers", R.RETRY_HEADER).alias("retries"))


@query("""SELECT event_id, epoch_us(ts) + (event_id % 7) * 60000000 AS available_us, epoch_us(ts) + (event_id % 7) * 60000000 <= epoch_us(TIMESTAMP '2024-01-15') AS due FROM events WHERE event_id % 97 = 5""")
def deferred_copies(s, d):
    log = outcomes(event_log(s, d)).withColumns({"outcome": F.when(F.col("outcome") == "retry", "retry_after").otherwise(F.col("outcome")), "delay_ms": F.col("event_id") % 7 * 60000})
    return C.deferred_copies(log, "2024-01-15").select("event_id", F.unix_micros("available_at").alias("available_us"), "due")


_ROUNDS = f"""{OUT}, r AS (SELECT *, unnest([1, 2, 3]) AS round FROM out), seen AS (SELECT *, CASE WHEN event_id % 97 <> 5 THEN 1 ELSE least(3, event_id % 4 + 1) END AS last FROM r)"""


@query(f"""WITH {_ROUNDS} SELECT event_id, round, CASE WHEN event_id % 97 <> 5 OR event_id % 4 < round THEN 'settled' WHEN round < 3 THEN 'copied' ELSE 'dead' END AS result FROM seen WHERE round <= last""")
def process_with_retries(s, d):
    acked = (F.col("event_id") % 97 != 5) | (F.col("event_id") % 4 < F.col("ordinal"))
    return C.process_with_retries(event_log(s, d), F.when(acked, "ack").otherwise("retry"), 3, "events.dlq").select("event_id", "round", "result")


@query(f"""WITH {LOG} SELECT event_id, CASE WHEN event_id // 64 % 10 = 3 THEN 'retry' WHEN amount > 300 THEN 'drop' ELSE 'ack' END AS outcome FROM log""")
def batch_outcomes(s, d):
    log = event_log(s, d).withColumns({"batch": F.floor(F.col("event_id") / 64), "row_outcome": F.when(F.col("amount") > 300, "drop").otherwise("ack")})
    whole = log.where("batch % 10 = 3").select("batch", F.lit("retry").alias("outcome")).distinct()
    return C.batch_outcomes(log, whole).select("event_id", "outcome")


@query(f"""WITH {OUT} SELECT 'events.dlq' AS topic, CAST(event_id % 4 + 1 AS VARCHAR) AS deliveries, count(*) AS n FROM out WHERE outcome = 'retry' AND event_id % 4 + 1 >= 3 GROUP BY ALL""")
def dead_letter_report(s, d):
    return C.dead_letter_report(C.dead_letters(_attempted(s, d), 3, "events.dlq"))


@query(f"""WITH {LOG}, dl AS (SELECT 'a' AS g, event_id FROM log UNION ALL SELECT 'a', event_id FROM log WHERE event_id % 11 = 0 UNION ALL SELECT 'b', event_id FROM log WHERE event_id % 2 = 0),
per AS (SELECT g, event_id, count(*) AS c FROM dl GROUP BY ALL), gs AS (SELECT unnest(['a', 'b', 'c']) AS "group")
SELECT "group", count(event_id) AS read, (SELECT count(*) FROM log) - count(event_id) AS unread, count(*) FILTER (WHERE c > 1) AS twice FROM gs LEFT JOIN per ON g = "group" GROUP BY 1""")
def group_coverage(s, d):
    log = event_log(s, d)
    a, b = log.withColumn("group", F.lit("a")), log.where("event_id % 2 = 0").withColumn("group", F.lit("b"))
    return C.group_coverage(log, a.unionByName(a.where("event_id % 11 = 0")).unionByName(b), s.createDataFrame([("a",), ("b",), ("c",)], "group string"))


# ---- placement ----


@query("""SELECT o_orderkey, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS payload, CAST(o_custkey AS VARCHAR) AS key FROM orders""")
def reply(s, d):
    o = table(s, d, "orders")
    out = K.reply(o, "placed", F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), key=F.col("o_custkey").cast("string"))
    return out.select(F.get_json_object(F.col("value").cast("string"), "$.id").cast("bigint").alias("o_orderkey"), F.col("value").cast("string").alias("payload"), F.col("key").cast("string").alias("key"))


def _order_items(s, d):
    return table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("quantity")))).alias("items"))


@query("SELECT l_orderkey AS id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) - 1 AS INTEGER) AS ordinal, l_partkey AS sku, l_quantity AS quantity FROM lineitem")
def fan_out(s, d):
    return K.fan_out(_order_items(s, d), "items", ["id"]).select("id", "ordinal", "item.sku", "item.quantity")


@query("SELECT l_orderkey AS id, l_partkey AS sku, l_quantity AS quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 3)")
def all_or_nothing(s, d):
    return K.all_or_nothing(_order_items(s, d), "items", lambda i: i["quantity"] < 3, ["id"]).select("id", "item.sku", "item.quantity")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 3)")
def all_or_nothing_rows(s, d):
    return K.all_or_nothing_rows(table(s, d, "lineitem"), "l_orderkey", F.col("l_quantity") < 3).select("l_orderkey", "l_partkey", "l_quantity")


@query(f"""WITH {LOG}, p AS (SELECT event_id, topic, CASE WHEN event_id % 10 = 0 THEN CAST(event_id // 10 % 5 AS INTEGER) END AS pin, partition AS keyed, event_id % 10 IN (1, 2) AS bare FROM log),
t AS (SELECT event_id, row_number() OVER (PARTITION BY topic ORDER BY event_id) - 1 AS turn FROM p WHERE bare)
SELECT p.event_id, CAST(coalesce(CASE WHEN pin IS NOT NULL THEN CASE WHEN pin < 4 THEN pin END WHEN bare THEN turn % 4 ELSE keyed END, -1) AS INTEGER) AS partition FROM p LEFT JOIN t USING (event_id)""")
def place(s, d):
    rows = event_rows(s, d).withColumns({"pin": F.when(F.col("event_id") % 10 == 0, F.floor(F.col("event_id") / 10) % 5).cast("int"), "key": F.when(F.col("event_id") % 10 == 1, F.lit(b"")).when(F.col("event_id") % 10 != 2, F.col("key"))})
    return K.place(rows, 4, ["event_id"], pin="pin").select("event_id", F.coalesce("partition", F.lit(-1)).alias("partition"))


@query("""WITH t AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS turn FROM events WHERE event_id % 3 = 0 AND event_id % 5 > 0)
SELECT event_id, CAST(coalesce(CASE WHEN event_id % 5 = 0 THEN 9 ELSE turn % 4 END, -1) AS INTEGER) AS pin FROM events LEFT JOIN t USING (event_id)""")
def round_robin(s, d):
    keyed = F.array(R.header(R.KEY_HEADER, F.lit("")))
    rows = event_rows(s, d).withColumns({"headers": F.when(F.col("event_id") % 3 == 0, R.no_headers()).otherwise(keyed), "pin": F.when(F.col("event_id") % 5 == 0, 9).cast("int")})
    return K.round_robin(rows, 4, ["event_id"]).select("event_id", F.coalesce("pin", F.lit(-1)).alias("pin"))


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'illegal_topic' WHEN 36 + length(CAST(user_id AS VARCHAR)) + length(props) > 47 THEN 'too_large' WHEN event_id % 13 = 0 THEN 'fenced' WHEN event_id % 6 > 3 THEN 'unknown_partition' END AS reason FROM events""")
def refuse(s, d):
    rows = event_rows(s, d).withColumns({"topic": F.when(F.col("event_id") % 11 == 0, "bad topic").otherwise(F.col("topic")), "fenced": F.col("event_id") % 13 == 0, "pin": (F.col("event_id") % 6).cast("int")})
    return K.refuse(rows, 4, 47, "fenced", "pin").select("event_id", "reason")


@query(f"""WITH {LOG}, n AS (SELECT topic, partition, count(*) AS n FROM log GROUP BY ALL) SELECT topic, partition, n, n / avg(n) OVER (PARTITION BY topic) AS skew FROM n""")
def placement_balance(s, d):
    return K.placement_balance(event_log(s, d))


# ---- transactions ----


@query(f"WITH {TXN} SELECT event_id, txn_state FROM stated")
def resolve_transactions(s, d):
    return X.resolve_transactions(*transactions(s, d)).select("event_id", "txn_state")


@query(f"WITH {TXN} SELECT event_id, CASE WHEN txn_state = 'pending' AND transactional_id IN (SELECT transactional_id FROM stated WHERE epoch = 2 AND transactional_id IS NOT NULL) THEN 'aborted' ELSE txn_state END AS txn_state, txn_state = 'pending' AND transactional_id IN (SELECT transactional_id FROM stated WHERE epoch = 2 AND transactional_id IS NOT NULL) AS fenced FROM stated")
def fence(s, d):
    return X.fence(*transactions(s, d)).select("event_id", "txn_state", "fenced")


@query(f"WITH {TXN} SELECT event_id, epoch = 1 AND transactional_id IN (SELECT transactional_id FROM stated WHERE epoch = 2 AND transactional_id IS NOT NULL) AS refused FROM stated WHERE transactional_id IS NOT NULL")
def refuse_fenced_writes(s, d):
    log, marks = transactions(s, d)
    return X.refuse_fenced_writes(log.where("transactional_id is not null"), log.where("transactional_id is not null").select("transactional_id", "epoch")).select("event_id", "refused")


@query(f"""WITH {TXN}, b AS (SELECT transactional_id, min(ts) AS began FROM stated WHERE txn_state = 'pending' GROUP BY 1), m AS (SELECT max(ts) AS now FROM events)
SELECT event_id, coalesce(txn_state = 'pending' AND epoch_ms(TIMESTAMP '2024-02-01') - (epoch_us(began) // 1000) >= 172800000, false) AS expired,
CASE WHEN txn_state = 'pending' AND epoch_ms(TIMESTAMP '2024-02-01') - (epoch_us(began) // 1000) >= 172800000 THEN 'aborted' ELSE txn_state END AS txn_state FROM stated LEFT JOIN b USING (transactional_id)""")
def expire_transactions(s, d):
    return X.expire_transactions(X.resolve_transactions(*transactions(s, d)), "2024-02-01", 172800000).select("event_id", "expired", "txn_state")


@query(f"""WITH {TXN} SELECT 'g' AS "group", topic, partition, CAST(0 AS INTEGER) AS epoch, max(CASE WHEN txn_state = 'committed' AND transactional_id IS NOT NULL THEN "offset" + 1 ELSE 0 END) AS next_offset FROM stated GROUP BY ALL""")
def commit_with_offsets(s, d):
    stated = X.resolve_transactions(*transactions(s, d))
    place_ = [F.lit("g").alias("group"), "topic", "partition", F.lit(0).alias("epoch")]
    stored = L.log_bounds(stated).select(*place_, F.lit(0).cast("bigint").alias("next_offset"))
    sent = stated.where("transactional_id is not null").groupBy("topic", "partition", "transactional_id", "txn").agg((F.max("offset") + 1).alias("next_offset")).select(*place_, "next_offset", "transactional_id", "txn")
    return X.commit_with_offsets(stored, sent, stated.where("transactional_id is not null"))


def _windows(s, d):
    log = C.settle(outcomes(event_log(s, d)))
    return log.withColumns({"window": F.floor(F.col("event_id") / 40), "failed": F.col("amount") > 400})


_WIN = f"""{OUT}, win AS (SELECT *, event_id // 40 AS "window", amount > 400 AS failed FROM out), ok AS (SELECT "window", count(*) AS n, bool_and(outcome <> 'retry') AND NOT bool_or(failed) AS committed FROM win GROUP BY 1)"""


@query(f"WITH {_WIN} SELECT * FROM ok")
def eos_windows(s, d):
    return X.eos_windows(_windows(s, d))


@query(f"""WITH {_WIN} SELECT event_id, "window" FROM win JOIN ok USING ("window") WHERE ok.committed""")
def committed_output(s, d):
    return X.committed_output(_windows(s, d)).select("event_id", "window")


@query("SELECT event_id, 0 AS seq FROM events")
def dedupe_by_source(s, d):
    log = event_log(s, d).withColumns({"source_topic": F.col("topic"), "source_partition": F.col("partition"), "source_offset": F.col("offset"), "ordinal": F.lit(0), "seq": F.lit(0)})
    again = log.where("event_id % 11 = 0").withColumn("seq", F.lit(1))
    return X.dedupe_by_source(log.unionByName(again)).select("event_id", "seq")


@query(f"""WITH {OUT}, {_TRACKED} SELECT topic, partition, coalesce(next_offset, low) AS rewind_to FROM (SELECT topic, partition, min("offset") AS low FROM out WHERE event_id % 2 = 0 GROUP BY ALL) LEFT JOIN (SELECT * FROM tracked WHERE partition < 2) USING (topic, partition) WHERE topic <> 'events.view'""")
def rewind_aborted(s, d):
    log = C.settle(outcomes(event_log(s, d)))
    return X.rewind_aborted(log.where("event_id % 2 = 0"), C.committed_tracked(log).where("partition < 2"), log.where("topic = 'events.view'").select("topic", "partition").distinct())


@query(f"""WITH {_WIN}, bad AS (SELECT partition, "window", bool_or(failed) AS b FROM win GROUP BY ALL) SELECT event_id, 'job-p' || partition AS transactional_id, CASE WHEN b THEN 'aborted' ELSE 'committed' END AS txn_state FROM win JOIN bad USING (partition, "window")""")
def partition_transactions(s, d):
    return X.partition_transactions(_windows(s, d), "job").select("event_id", "transactional_id", "txn_state")


@query("SELECT event_id FROM events WHERE event_id % 9 = 0")
def missing_source(s, d):
    rows = event_log(s, d).withColumn("source", F.when(F.col("event_id") % 9 > 0, R.source_text()).when(F.col("event_id") % 2 == 0, "broken"))
    return X.missing_source(rows).select("event_id")


# ---- read models ----


@query(f"""WITH {LOG} SELECT key, event_id, row_number() OVER (PARTITION BY key ORDER BY topic, "offset") AS place, true AS together FROM log""")
def ordered_lanes(s, d):
    """place: where the operator's result really has the row in its lane; together: in one task."""
    dealt = M.ordered_lanes(key_text(event_log(s, d)), "key", ["topic", "offset"])
    dealt = dealt.withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    lane = Window.partitionBy("key")
    return dealt.select("key", "event_id", F.row_number().over(lane.orderBy("at")).cast("bigint").alias("place"), (F.min("task").over(lane) == F.max("task").over(lane)).alias("together"))


@query(f"""WITH {LOG}, p AS (SELECT key, coalesce(ts - INTERVAL 1 HOUR * (event_id % 3) < lag(ts - INTERVAL 1 HOUR * (event_id % 3)) OVER (PARTITION BY key, topic, partition ORDER BY "offset"), false) AS bad FROM log) SELECT key, count(*) AS violations FROM p WHERE bad GROUP BY 1""")
def order_violations(s, d):
    log = key_text(event_log(s, d)).withColumn("processed_at", F.timestamp_micros(F.unix_micros("timestamp") - F.col("event_id") % 3 * 3600000000))
    return M.order_violations(log)


def _ledger(s, d):
    return table(s, d, "orders").select(F.col("o_custkey").alias("account"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), "o_orderkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("revision"))


@query("SELECT o_custkey AS account, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM orders GROUP BY 1")
def project_balances(s, d):
    return M.project_balances(_ledger(s, d)).withColumn("balance", F.col("balance").cast("double"))


@query("SELECT o_custkey AS account, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS balance, (SELECT max(year(o_orderdate) * 12 + month(o_orderdate)) FROM orders) AS revision FROM orders GROUP BY 1")
def rebuild_on_revision(s, d):
    return M.rebuild_on_revision(_ledger(s, d)).withColumn("balance", F.col("balance").cast("double")).withColumn("revision", F.col("revision").cast("bigint"))


@query("SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS DOUBLE) AS balance FROM orders")
def running_ledger(s, d):
    return M.running_ledger(_ledger(s, d), "account", "amount", ["o_orderkey"]).select("o_orderkey", F.col("balance").cast("double").alias("balance"))


@query("SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS units FROM lineitem GROUP BY 1")
def enrich_totals(s, d):
    return M.enrich_totals(table(s, d, "lineitem"), "l_orderkey", "l_quantity")


@query("SELECT l_orderkey AS id, count(*) AS lines, sum(l_quantity) AS units FROM lineitem GROUP BY 1")
def enrich_totals_nested(s, d):
    return M.enrich_totals_nested(_order_items(s, d), "items", "quantity").select("id", "lines", "units")


@query("SELECT user_id, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1")
def count_views(s, d):
    return M.count_views(table(s, d, "events").where("event_type = 'view'"), "user_id")


@query("SELECT event_id // 100 AS batch, count(*) FILTER (WHERE floor(value / 10) <> 0) AS acked, count(*) FILTER (WHERE floor(value / 10) = 0) AS dropped, CAST(sum(CASE WHEN floor(value / 10) <> 0 THEN floor(value / 10) END) AS DOUBLE) AS total FROM events GROUP BY 1")
def reconcile(s, d):
    e = table(s, d, "events").select(F.floor(F.col("event_id") / 100).alias("batch"), F.floor(F.col("value") / 10).cast("double").alias("amount"))
    return M.reconcile(e, "batch", "amount")


@query(f"""WITH {LOG}, begun AS (SELECT topic, partition, coalesce(min("offset") FILTER (WHERE ts >= TIMESTAMP '2024-01-24'), max("offset") + 1) AS start FROM log GROUP BY ALL)
SELECT key, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM log JOIN begun USING (topic, partition) WHERE "offset" >= start GROUP BY 1""")
def replay_since(s, d):
    log = key_text(event_log(s, d)).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return M.replay_since(log, "2024-01-24", "key", "amount").withColumn("total", F.col("total").cast("double"))

