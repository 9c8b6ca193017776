"""Static and streaming runs of the same operator agree; sinks survive a restart."""

import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.functions import runs
from tidelog.operators import models, placement, readers, settle, txn
from tidelog.plans.fixtures import event_log
from tidelog.sources import logs
from tidelog.sources.stream_source import register
from tidelog.streaming import commits, flows, numbering, tracking

SF = "/root/testdata/sf0.001"


def stored(spark, tmp_path):
    log = event_log(spark, SF).select("topic", "partition", "offset", "timestamp", "key", "value", "headers")
    log.repartition(4).write.parquet(f"{tmp_path}/log")
    return f"{tmp_path}/log"


def test_stateless_and_aggregating_operators_agree(spark, tmp_path):
    path = stored(spark, tmp_path)
    read = lambda streaming: logs.subscribe_pattern(logs.read_log(spark, path, streaming=streaming), "^events\\.(view|click)$").select("topic", R.record_size().alias("size"))
    query = models.project_balances(read(True), "topic", "size").writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("totals").collect())) == sorted(map(tuple, models.project_balances(read(False), "topic", "size").collect()))


def test_exactly_once_output_and_positions(spark, tmp_path):
    path = stored(spark, tmp_path)
    for _ in range(2):  # the second run finds everything committed
        stream = flows.read_bounded(spark, path, 1, "parquet")
        flows.eos_sink(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", lambda b: b.select("topic", "partition", "offset")).awaitTermination(120)
    out = flows.committed_output(spark, f"{tmp_path}/out")
    assert out.count() == spark.read.parquet(path).count() == out.select("topic", "partition", "offset").distinct().count()
    assert out.select("commit").distinct().count() == len([f for f in os.listdir(path) if f.endswith(".parquet")])
    want = {(r.topic, r.partition): r.end for r in logs.log_bounds(spark.read.parquet(path)).collect()}
    assert {(r.topic, r.partition): r.next_offset for r in flows.committed_positions(spark, f"{tmp_path}/out").collect()} == want


def log_rows(spark, path, first, n, topic="t", partition=0):
    spark.range(first, first + n).select(F.lit(topic).alias("topic"), F.lit(partition).alias("partition"), F.col("id").alias("offset"), F.timestamp_millis(F.col("id") * 1000).alias("timestamp"), F.lit(b"k").alias("key"), F.lit(b"v").alias("value"), R.no_headers().alias("headers")).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def sunk(spark, target):
    out = flows.committed_output(spark, target)
    return [] if out is None else sorted((r.topic, r.partition, r.offset) for r in out.collect())


def test_nothing_of_a_failed_batch_is_read(spark, tmp_path, monkeypatch):
    log_rows(spark, f"{tmp_path}/log", 0, 20)
    run = lambda **more: flows.eos_sink(flows.read_bounded(spark, f"{tmp_path}/log", 1, "parquet"), f"{tmp_path}/out", f"{tmp_path}/c", **more).awaitTermination(120)
    publish = commits._Files.publish

    def fails(self, text, content):
        """The output and its positions are written; their manifest is not."""
        if json.loads(content).get("batch", -1) >= 0:
            raise OSError("gone")
        return publish(self, text, content)

    monkeypatch.setattr(commits._Files, "publish", fails)
    with pytest.raises(Exception, match="gone"):
        run()
    assert os.listdir(f"{tmp_path}/out/data") and sunk(spark, f"{tmp_path}/out") == [] and flows.committed_positions(spark, f"{tmp_path}/out").count() == 0
    monkeypatch.setattr(commits._Files, "publish", publish)
    run()
    assert sunk(spark, f"{tmp_path}/out") == [("t", 0, i) for i in range(20)] and flows.committed_positions(spark, f"{tmp_path}/out").first().next_offset == 20
    store = commits.CommitLog(spark, f"{tmp_path}/out")
    assert len(os.listdir(f"{tmp_path}/out/data")) == 2 and store.vacuum() == 2 and len(os.listdir(f"{tmp_path}/out/data")) == 1
    assert len(sunk(spark, f"{tmp_path}/out")) == 20


def test_an_empty_checkpoint_loses_nothing(spark, tmp_path):
    log_rows(spark, f"{tmp_path}/a", 0, 20)
    log_rows(spark, f"{tmp_path}/b", 20, 5)
    for k, part in enumerate("ab"):
        flows.eos_sink(flows.read_bounded(spark, f"{tmp_path}/{part}", 1, "parquet"), f"{tmp_path}/out", f"{tmp_path}/c{k}").awaitTermination(120)
    assert sunk(spark, f"{tmp_path}/out") == [("t", 0, i) for i in range(25)]
    # Read again from the start, the committed positions leave out what is there.
    log_rows(spark, f"{tmp_path}/a", 25, 3)
    flows.eos_sink(flows.read_bounded(spark, f"{tmp_path}/a", 1, "parquet"), f"{tmp_path}/out", f"{tmp_path}/c3", ordered=True).awaitTermination(120)
    assert sunk(spark, f"{tmp_path}/out") == [("t", 0, i) for i in range(28)] and flows.committed_positions(spark, f"{tmp_path}/out").first().next_offset == 28


def test_a_stale_run_is_refused(spark, tmp_path):
    store, rows = commits.CommitLog(spark, f"{tmp_path}/out"), spark.range(3)
    old = store.start(f"{tmp_path}/c1")
    assert old.commit(0, {"data": rows}) and not old.commit(0, {"data": rows})
    new = store.start(f"{tmp_path}/c2")
    with pytest.raises(commits.StaleRun):
        old.commit(1, {"data": rows})
    assert new.commit(0, {"data": rows}) and store.read("data").count() == 6
    again = store.start(f"{tmp_path}/c2")  # the same writer knows its batch
    assert again.is_committed(0) and not again.is_committed(1) and again.epoch == 3


def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def told(stream, name, checkpoint, mode="append"):
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(180)
    return stream.sparkSession.table(name)


def test_tracked_positions_follow_every_micro_batch(spark, tmp_path):
    rocks(spark)
    rng = random.Random(3)
    schema = "topic string, partition int, seq bigint, offset bigint, generation bigint, settles boolean"
    events, delivered, seq = [], [], 0
    for partition in range(3):
        at, generation = 0, 0
        for step in range(120):
            chance = rng.random()
            if chance < 0.04:
                at = rng.randrange(max(1, at))  # read again
            elif chance < 0.06:
                at, generation = rng.randrange(at + 1), generation + 1
            seq += 1
            events.append(("t", partition, seq, at, generation, False))
            delivered.append((partition, at, generation))
            at += 1 if rng.random() < 0.9 else 3
            for _ in range(rng.randrange(3)):
                p, o, g = rng.choice(delivered[-25:])  # late, out of order, repeated, of older generations too
                seq += 1
                events.append(("t", p, seq, o, g, True))
    events.sort(key=lambda e: e[2])
    parts = [events[i : i + 130] for i in range(0, len(events), 130)]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    seen: dict = {}

    def each(batch, k):
        seen.setdefault(k, []).extend(batch.collect())

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    tracking.tracked_positions(stream).writeStream.foreachBatch(each).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(180)
    now: dict = {}
    for k in range(len(parts)):
        now |= {(r.topic, r.partition): r.next_offset for r in seen.get(k, [])}
        so_far = [e for part in parts[: k + 1] for e in part]
        # A settle before its delivery has come is of nothing yet.
        settled = {(e[1], e[3], e[4]) for e in so_far if e[5]}
        rows = [(t, p, q, o, g, (p, o, g) in settled) for t, p, q, o, g, s in so_far if not s]
        df = spark.createDataFrame(rows, "topic string, partition int, delivery_seq bigint, offset bigint, generation bigint, settled boolean")
        want = {(r.topic, r.partition): r.next_offset for r in settle.committed_after_replay(df).collect()}
        assert {p: v for p, v in now.items() if v is not None} == want, k


def test_runs_are_sets():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ({rng.randrange(30) for _ in range(rng.randrange(20))} for _ in "ab")
        x, y = runs.of(list(a)), runs.of(list(b))
        spelled = lambda r: {i for s, e in r.tolist() for i in range(s, e)}
        assert spelled(runs.union(x, y)) == a | b and spelled(runs.minus(x, y)) == a - b and runs.size(x) == len(a)
        assert (runs.unpacked(runs.packed(x)) == x).all() and all(e < s for (_, e), (s, _) in zip(x.tolist(), x.tolist()[1:]))
    assert len(runs.union(runs.of(range(0, 10000, 2)), runs.of(range(1, 10000, 2)))) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_commit_windows_in_any_order_of_arrival(spark, tmp_path, seed):
    rocks(spark)
    rng = random.Random(seed)
    schema = "window bigint, topic string, partition int, offset bigint, event string"
    rows, events = [], []
    for w in range(12):
        n = rng.randint(1, 20)
        bad = w % 4 == 1
        for i in range(n):
            rows.append((w, not (bad and i == 0), bad and i == 0))
            place = ("t", i % 3, w * 100 + i)
            events += [(w, *place, "enrolled"), (w, *place, "failed" if bad and i == 0 else "settled")]
        events.append((w, None, None, n, "closed"))
    events += rng.sample(events, 20)  # repeated
    rng.shuffle(events)
    for k in range(0, len(events), 90):
        spark.createDataFrame(events[k : k + 90], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = sorted(map(tuple, told(tracking.commit_windows(stream), f"windows{seed}", f"{tmp_path}/c").collect()))
    want = sorted(map(tuple, txn.eos_windows(spark.createDataFrame(rows, "window bigint, settled boolean, failed boolean")).collect()))
    assert got == want


def test_a_window_that_never_settles_aborts_in_time(spark, tmp_path):
    rocks(spark)
    rows = [(1, "t", 0, 5, "enrolled"), (1, None, None, 1, "closed"), (2, "t", 0, 6, "enrolled"), (2, "t", 0, 6, "settled"), (2, None, None, 1, "closed"), (3, "t", 0, 7, "enrolled")]
    spark.createDataFrame(rows, "window bigint, topic string, partition int, offset bigint, event string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("window bigint, topic string, partition int, offset bigint, event string").parquet(f"{tmp_path}/in")
    query = tracking.commit_windows(stream, timeout_ms=1500).writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    end = time.time() + 90
    while time.time() < end and spark.table("late").count() < 2:
        time.sleep(0.5)
    query.stop()
    assert [tuple(r) for r in spark.table("late").collect()] == [(2, 1, True), (1, 1, False)]


def test_the_log_starts_at_every_position_and_admits_so_many_records(spark, tmp_path):
    path = f"{tmp_path}/log"
    log = event_log(spark, SF).select("topic", "partition", "offset", "timestamp", "key", "value", "headers")
    placement.write_log(log.repartition(3), path)
    register(spark)
    every = {(r.topic, r.partition, r.offset): r.timestamp for r in log.select("topic", "partition", "offset", "timestamp").collect()}
    ends: dict = {}
    for t, p, o in every:
        ends[t, p] = max(ends.get((t, p), 0), o + 1)
    place = sorted(ends)[0]
    middle = sorted(every.values())[len(every) // 2]
    moment = middle.replace(tzinfo=__import__("datetime").timezone.utc) if middle.tzinfo is None else middle
    starts = {
        "earliest": lambda t, p: 0, "latest": lambda t, p: ends[t, p], f"timestamp:{int(moment.timestamp() * 1000)}": None,
        json.dumps({place[0]: {str(place[1]): 3}}): lambda t, p: 3 if (t, p) == place else 0, json.dumps({place[0]: {str(place[1]): 10**6}}): lambda t, p: 0,
    }
    for k, (start, first) in enumerate(starts.items()):
        stream = spark.readStream.format("tidelog").options(path=path, start=start).load()
        got = {(r.topic, r.partition, r.offset) for r in told(stream.select("topic", "partition", "offset"), f"from{k}", f"{tmp_path}/c{k}").collect()}
        if first is None:
            at = logs.start_positions(log, "timestamp", moment.replace(microsecond=moment.microsecond // 1000 * 1000))
            low = {(r.topic, r.partition): r.start for r in at.collect()}
            first = lambda t, p, low=low: low[t, p]
        assert got == {x for x in every if x[2] >= first(x[0], x[1])}, start
    sizes: dict = {}
    for run in range(2):  # bounded, and again from where it was, with more in the log
        stream = flows.read_bounded(spark, path, 150, progress=f"{tmp_path}/planned")
        stream.writeStream.foreachBatch(lambda b, k: sizes.setdefault(k, []).extend(b.select("topic", "partition", "offset").collect())).option("checkpointLocation", f"{tmp_path}/cb").trigger(processingTime="0 seconds").start().processAllAvailable()
        for q in spark.streams.active:
            q.stop()
        if not run:
            assert sum(map(len, sizes.values())) == len(every)
            placement.write_log(log.where("topic = 'events.view'").withColumn("offset", F.col("offset") + 10_000), path)
    rows = [tuple(r) for part in sizes.values() for r in part]
    assert len(rows) == len(set(rows)) == len(every) + len([x for x in every if x[0] == "events.view"])
    assert len(sizes) >= len(every) // 150 and all(0 < len(v) <= 150 for v in sizes.values())
    with pytest.raises(Exception, match="progress"):
        spark.readStream.format("tidelog").options(path=path, records=5).load().writeStream.format("noop").trigger(availableNow=True).start().awaitTermination(60)


def test_a_log_streamed_in_batches_equals_the_log_of_all(spark, tmp_path):
    rows = spark.range(600).select(F.concat(F.lit("t"), F.col("id") % 3).alias("topic"), F.when(F.col("id") % 4 > 0, (F.col("id") % 17).cast("string").cast("binary")).alias("key"), F.lit(b"v").alias("value"), F.timestamp_millis(F.col("id")).alias("timestamp"), "id")
    for k in range(4):
        rows.where(F.floor(F.col("id") / 150) == k).repartition(2, "id").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    fields = ("id", "topic", "partition", "offset", "sequence")
    want = sorted(tuple(r[f] for f in fields) for r in logs.topic_log(rows, ["id"], 4).collect())
    for _ in range(2):  # a second start changes nothing
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        numbering.stream_topic_log(stream, f"{tmp_path}/out", f"{tmp_path}/c", ["id"]).awaitTermination(180)
        got = numbering.read_streamed_log(spark, f"{tmp_path}/out")
        assert sorted(tuple(r[f] for f in fields) for r in got.collect()) == want
    pins = rows.withColumns({"pin": F.when(F.col("id") % 5 == 0, 1), "headers": F.when(F.col("id") % 7 == 0, F.array(R.header(R.KEY_HEADER, F.lit(b"")))).otherwise(R.no_headers())})
    pins.repartition(3).write.parquet(f"{tmp_path}/pins")
    stream = spark.readStream.schema(pins.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/pins")
    numbering.stream_round_robin(stream, f"{tmp_path}/robin", f"{tmp_path}/cr", 4, ["id"]).awaitTermination(180)
    turned = numbering.read_streamed_log(spark, f"{tmp_path}/robin").where("id % 5 > 0 and id % 7 > 0").groupBy("pin").count().collect()
    whole = [i for i in range(600) if i % 5 and i % 7]
    assert sorted((r.pin, r["count"]) for r in turned) == [(k, len(whole[k::4])) for k in range(4)]


def test_replays_are_dropped_on_a_stream(spark, tmp_path):
    rows = spark.range(50).select(F.lit("t").alias("source_topic"), F.lit(0).alias("source_partition"), (F.col("id") % 20).alias("source_offset"), F.lit(0).alias("ordinal"), F.timestamp_seconds(F.col("id")).alias("timestamp"))
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = told(txn.dedupe_stream_by_source(stream), "once", f"{tmp_path}/c").collect()
    assert sorted(r.source_offset for r in got) == list(range(20))


def test_lineage_on_a_stream_equals_the_batch_form(spark, tmp_path):
    log = spark.range(40).select(F.lit("a:b").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds(1000 + F.col("id")).alias("timestamp"))
    names = F.concat((F.col("id") % 2).cast("string"), F.lit(":"), F.col("id").cast("string"), F.lit(":a:b"))
    outputs = spark.range(20, 60).select(F.concat(F.lit("o"), "id").alias("output_id"), names.alias("source"), F.timestamp_seconds(1001 + F.col("id")).alias("at"))
    outputs = outputs.select("output_id", "source", R.parse_source("source").alias("s"), "at").select("output_id", "source", "s.*", "at")
    want = [tuple(r) for r in logs.source_lineage(outputs.select("output_id", "source"), log).select("output_id", "topic", "partition", "offset", "status").collect()]
    assert {r[4] for r in want} == {"found", "lost", "silent"}
    end = spark.createDataFrame([("z", 9, 9, 10**6)], "topic string, partition int, offset bigint, s bigint")
    for k, (one, two) in enumerate([(outputs, log), (end.select(F.lit("end").alias("output_id"), F.lit("9:8:z").alias("source"), "topic", "partition", F.lit(8).cast("bigint").alias("offset"), F.timestamp_seconds("s").alias("at")), end.select("topic", "partition", "offset", F.timestamp_seconds("s").alias("timestamp")))] ):
        one.coalesce(1).write.mode("append").parquet(f"{tmp_path}/o")
        two.coalesce(1).write.mode("append").parquet(f"{tmp_path}/l")
        time.sleep(0.1)
    read = lambda df, p: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{p}")
    got = told(tracking.lineage_as_it_settles(read(outputs, "o"), read(log, "l"), "1 minute"), "lineage", f"{tmp_path}/c").where("topic <> 'z'").collect()
    assert sorted(((r.output_id, r.topic, r.partition, r.offset, r.status) for r in got), key=str) == sorted(want, key=str)


def test_connector_sink_is_refused_without_dedupe(spark, tmp_path):
    try:
        flows.eos_sink(None, "{}", "x", fmt="kafka")
    except ValueError as e:
        assert "at least once" in str(e)
    else:
        raise AssertionError


def test_ledger_state_and_deferral(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = [("a", i, float(i)) for i in range(6)] + [("b", 9, 1.0)]
    for k, part in enumerate((rows[:3], rows[2:])):  # offset 2 comes again
        spark.createDataFrame(part, "key string, offset bigint, amount double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    stream = spark.readStream.schema("key string, offset bigint, amount double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    flows.ordered_ledger(stream).writeStream.format("memory").queryName("ledger").outputMode("append").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start().awaitTermination(180)
    got = {(r.key, r.offset): r.balance for r in spark.table("ledger").collect()}
    assert got == {**{("a", i): sum(range(i + 1)) for i in range(6)}, ("b", 9): 1.0}
    waits = spark.readStream.schema("key string, offset bigint, amount double").parquet(f"{tmp_path}/in").withColumn("delay_ms", F.when(F.col("key") == "b", 0).otherwise(1500).cast("bigint"))
    query = flows.deferred(waits).writeStream.format("memory").queryName("due").outputMode("append").option("checkpointLocation", f"{tmp_path}/c2").trigger(processingTime="200 milliseconds").start()
    end = time.time() + 120
    while time.time() < end and spark.table("due").count() < 8:
        time.sleep(1)
    query.stop()
    due = [(r.key, r.offset) for r in spark.table("due").collect()]
    assert due[0] == ("b", 9) and sorted(due) == sorted([(k, o) for k, o, _ in rows] + [("a", 2)])


def test_deferral_keeps_microseconds_and_spreads_keyless_rows(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.range(40).select(F.when(F.col("id") < 2, "k").alias("key"), "id", F.expr("timestamp_micros(1700000000123456 + id)").alias("at"), F.encode(F.lit("é"), "UTF-8").alias("value"), (F.col("id") % 2 * 800).alias("delay_ms"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = flows.deferred(stream).writeStream.format("memory").queryName("waited").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    end = time.time() + 120
    while time.time() < end and spark.table("waited").count() < 40:
        time.sleep(1)
    query.stop()
    out = spark.table("waited")
    assert sorted(out.select("id", F.unix_micros("at").alias("us")).collect()) == [(i, 1700000000123456 + i) for i in range(40)]
    assert out.where("value = X'C3A9'").count() == 40


def test_placement_on_a_stream_keeps_every_row(spark, tmp_path):
    rows = spark.range(200).select(F.lit("t").alias("topic"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string").cast("binary")).alias("key"), F.when(F.col("id") % 10 == 1, 3).alias("pin"), "id")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    placement.place(stream, 4, ["id"], pin="pin").writeStream.format("memory").queryName("placed").outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    got = {r.id: r for r in spark.table("placed").collect()}
    assert len(got) == 200 and all(g.partition == 3 for g in got.values() if g.pin) and {g.partition for g in got.values() if not g.pin and not g.key} == {0, 1, 2, 3}
    same = {r.id: r.partition for r in placement.place(rows, 4, ["id"], pin="pin").collect()}
    assert all(got[i].partition == same[i] for i in got if got[i].key or got[i].pin)


def test_model_starts_over_on_a_newer_revision(spark, tmp_path):
    schema = "topic string, partition int, offset bigint, revision int, account string, amount double"
    parts = [[(0, 1, "a", 5.0), (1, 1, "b", 1.0)], [(2, 1, "a", 2.0)], [(3, 2, "a", 1.0)], [(4, 2, "b", 4.0)], [(5, 2, "c", None)], [(6, 2, "a", 1.0)]]
    want = [{"a": 5.0, "b": 1.0}, {"a": 7.0, "b": 1.0}, {"a": 8.0, "b": 1.0}, {"a": 8.0, "b": 5.0}, {"a": 8.0, "b": 5.0, "c": None}, {"a": 9.0, "b": 5.0, "c": None}]
    store, written = commits.CommitLog(spark, f"{tmp_path}/out"), []
    for k, part in enumerate(parts):
        spark.createDataFrame([("t", 0, *r) for r in part], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        time.sleep(0.1)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
        flows.rebuilding_model(stream, lambda: spark.read.parquet(f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination(180)
        model = flows.model_now(spark, f"{tmp_path}/out").collect()
        assert {r.account: r.balance for r in model} == want[k] and {r.revision for r in model} == {1 if k < 2 else 2}
        newest = store.read("model").agg(F.max("commit")).first()[0]
        written.append(store.read("model", since=newest).count())
    # A base where the revision is new, and else what changed; what lies before the last base is gone.
    assert written == [2, 1, 2, 1, 1, 1] and store.read("model").count() == 5 and len(os.listdir(f"{tmp_path}/out/model")) == 4


def test_a_model_is_compacted(spark, tmp_path):
    schema = "topic string, partition int, offset bigint, revision int, account string, amount double"
    for k in range(7):
        spark.createDataFrame([("t", 0, k, 1, f"a{k % 3}", 1.0)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    flows.rebuilding_model(stream, lambda: spark.read.parquet(f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/c", compact_every=3).awaitTermination(180)
    assert {r.account: r.balance for r in flows.model_now(spark, f"{tmp_path}/out").collect()} == {"a0": 3.0, "a1": 2.0, "a2": 2.0}
    assert len(os.listdir(f"{tmp_path}/out/model")) <= 4


def test_rebuild_gate(spark):
    batch = spark.createDataFrame(pd.DataFrame({"revision": [3, 5]}))
    assert models.needs_rebuild(4, batch) and not models.needs_rebuild(5, batch) and models.needs_rebuild(None, batch)


def test_a_version_that_is_registered_later_is_read(spark, tmp_path):
    first = '{"type":"record","name":"E","fields":[{"name":"k","type":"int"}]}'
    second = '{"type":"record","name":"E","fields":[{"name":"k","type":"long"},{"name":"c","type":"string","default":"EUR"}]}'
    registry, seen = [(1, "s", 1, "AVRO", first), (2, "s", 2, "AVRO", second)], {}
    schemas = lambda: spark.createDataFrame(registry, "id bigint, subject string, version int, schema_type string, definition string")
    envelope = lambda i, text: b"\x00" + i.to_bytes(4, "big") + text.encode()
    parts = [[envelope(1, '{"k": 1}'), envelope(3, '{"k": 3, "c": "X"}')], [envelope(3, '{"k": 4, "c": "Y"}'), envelope(2, '{"k": 5, "c": "Z"}'), b"bare"]]
    for k, part in enumerate(parts):
        spark.createDataFrame([(v,) for v in part], "value binary").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("value binary").parquet(f"{tmp_path}/in")
        readers.fanin_stream(stream, schemas, 2, f"{tmp_path}/c", lambda b, n: seen.setdefault(n, []).extend((r.schema_id, r.evolved and tuple(r.evolved), r.failure) for r in b.collect())).awaitTermination(120)
        registry.append((3, "s", 3, "JSON", '{"type":"object","properties":{"k":{"type":"integer"},"c":{"type":"string"}},"required":["k","c"]}'))
    assert sorted(seen[0], key=str) == [(1, (1, "EUR"), None), (3, None, "unknown_id")]
    assert sorted(seen[1], key=str) == [(2, (5, "Z"), None), (3, (4, "Y"), None), (None, None, "unframed")]
