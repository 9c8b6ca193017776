"""Commit windows that share a state: many windows in few calls, sets side by side, odd numbers and coordinates."""

import json
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.functions import runs
from tidelog.streaming import tracking

SCHEMA = "window bigint, topic string, partition int, offset bigint, event string"


@pytest.fixture(autouse=True)
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ran(spark, tmp_path, parts, name, **options):
    """The rows that the stream gave over one micro-batch for each part, and its last state's rows."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = tracking.commit_windows(stream, **options).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None and not query.isActive
    told = [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in told if p["stateOperators"]]
    return [tuple(r) for r in spark.table(name).collect()], kept[-1]


def test_many_windows_are_few_states(spark, tmp_path):
    """Python and the store are called once for a state, so this number is what a batch costs."""
    enrolled = spark.range(768).select((F.col("id") / 3).cast("bigint").alias("window"), F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"), F.lit("enrolled").alias("event"))
    closed = spark.range(256).select(F.col("id").alias("window"), F.lit(None).cast("string").alias("topic"), F.lit(None).cast("int").alias("partition"), F.lit(3).cast("bigint").alias("offset"), F.lit("closed").alias("event"))
    settled = enrolled.where("window < 200").withColumn("event", F.lit("settled"))
    rows, kept = ran(spark, tmp_path, [settled, enrolled.unionByName(closed)], "few")
    assert sorted(rows) == [(w, 3, True) for w in range(200)]
    assert kept == 64


def test_windows_of_any_number_with_odd_coordinates(spark, tmp_path):
    rng = random.Random(5)
    windows = [0, 64, 128, 1, 63, 4095, 4096, -1, -64, -4097, 2**62, -(2**63), 2**63 - 1, 10**15, None]
    events, want = [], []
    for k, w in enumerate(windows):
        places = [(rng.choice(["t", "u", ""]), rng.choice([0, 1, 2**31 - 1, -1]), rng.choice([0, 2**53, 2**62]) + i // 2) for i in range(rng.randint(1, 12))]
        places = list(dict.fromkeys(places))
        fate = ["commits", "fails", "waits"][k % 3]
        for i, place in enumerate(places):
            events.append((w, *place, "enrolled"))
            if i or fate == "commits":
                events.append((w, *place, "settled"))
        if fate == "fails":
            events.append((w, None, None, None, "failed"))
        if fate != "waits":
            want.append((w, len(places), fate == "commits"))
        events.append((w, None, None, len(places), "closed"))
        # Told of nothing: no full coordinates, no number, no such event; settled under another window, never enrolled.
        events += [(w, None, 1, 5, "enrolled"), (w, "t", None, 5, "enrolled"), (w, "t", 1, None, "settled"), (w, "t", 1, None, "closed"), (w, "t", 1, 5, "other"), (w, "t", 1, 5, None), (w, "s", 1, 5, "settled")]
    events += rng.sample(events, 30)
    rng.shuffle(events)
    parts = [spark.createDataFrame(events[k : k + 120], SCHEMA) for k in range(0, len(events), 120)]
    rows, _ = ran(spark, tmp_path, parts, "odd")
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows, key=order) == sorted(want, key=order)


def test_windows_of_one_state_have_deadlines_of_their_own(spark, tmp_path):
    first = [(0, "t", 0, 5, "enrolled"), (0, None, None, 1, "closed"), (64, "t", 0, 6, "enrolled"), (128, "t", 0, 7, "enrolled"), (128, "t", 0, 7, "settled"), (128, None, None, 1, "closed")]
    later = [(64, None, None, 1, "closed"), (192, "t", 0, 9, "enrolled")]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    query = tracking.commit_windows(stream, timeout_ms=2000).writeStream.format("memory").queryName("deadlines").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()

    def until(n):
        end = time.time() + 90
        while time.time() < end and spark.table("deadlines").count() < n:
            time.sleep(0.2)
        return [tuple(r) for r in spark.table("deadlines").collect()]

    try:
        assert until(2) == [(128, 1, True), (0, 1, False)]
        spark.createDataFrame(later, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assert until(3) == [(128, 1, True), (0, 1, False), (64, 1, False)]
    finally:
        query.stop()


def test_runs_of_many_sets_are_sets():
    rng = random.Random(3)

    def made(n):
        rows = [(rng.randrange(4) << 56, rng.randrange(30) - 15) for _ in range(n)]
        x = np.array(rows, np.int64).reshape(-1, 2)
        return set(rows), runs.of_many(x[:, 0], x[:, 1])

    spelled = lambda r: [(s, i) for s, a, b in r.tolist() for i in range(a, b)]
    for _ in range(300):
        (a, x), (b, y) = made(rng.randrange(60)), made(rng.randrange(60))
        both = runs.union_many(x, y)
        assert sorted(a) == spelled(x) and sorted(a | b) == spelled(both)
        assert all(s != t or e < f for (s, _, e), (t, f, _) in zip(both.tolist(), both.tolist()[1:]))
        assert runs.inside_many(x, y).tolist() == [all((s, i) in b for i in range(p, q)) for s, p, q in x.tolist()]
        assert (runs.unpacked_many(runs.packed_many(both)) == both).all()
