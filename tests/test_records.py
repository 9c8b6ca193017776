"""Literal cases with known answers, and operators whose results are rows rather than tables."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import records as R
from tidelog.operators import audit, framing, models, placement, readers, settle, txn
from tidelog.sources import logs


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_record_size(spark):
    null = F.lit(None).cast("binary")
    head = lambda k, v: F.array(R.header(k, F.lit(v)))
    assert one(spark, R.record_size(null, null, R.no_headers())) == 36
    assert one(spark, R.record_size(F.lit(b"key"), null, head("n", "v" * 63))) == 36 + 3 + 1 + 63 + 1 + 1
    assert one(spark, R.record_size(null, null, head("n", "v" * 64))) == 36 + 1 + 64 + 1 + 2


def test_crc_and_envelope(spark):
    assert one(spark, F.crc32(F.lit(b"123456789"))) == 0xCBF43926
    framed = R.add_envelope(1234, F.lit(b"datum"))
    assert one(spark, R.envelope_id(framed)) == 1234 and bytes(one(spark, R.envelope_datum(framed))) == b"datum"
    assert one(spark, R.is_framed(F.lit(b"\x00\x00\x00"))) is False and one(spark, R.envelope_id(F.lit(b"\x01abcd"))) is None


def test_varints(spark):
    case = lambda h: one(spark, R.union_branch(F.unhex(F.lit(h))))
    assert [case(h) for h in ("042a", "022a", "00", "06", "", "8001", "80", "01")] == [2, 1, 0, 3, None, 64, None, None]
    path = one(spark, R.message_path(F.unhex(F.lit("00AA"))))
    assert path.path == [0] and bytes(path.message) == b"\xaa"
    assert one(spark, R.message_path(F.unhex(F.lit("040200BB")))).path == [1, 0] and one(spark, R.message_path(F.unhex(F.lit("0402")))) is None
    long = [2, 300, 0, 0, 0, 0, 0, 0, 0, 70000, 2**31 - 1]
    there = one(spark, R.message_path(F.concat(R.write_path(F.array(*[F.lit(i) for i in long])), F.lit(b"\xbb"))))
    assert there.path == long and bytes(there.message) == b"\xbb" and one(spark, R.write_path(F.array(F.lit(-1)))) is None
    assert one(spark, R.message_path(F.unhex(F.lit("FEFFFFFF0F")))) is None and one(spark, R.message_path(F.unhex(F.lit("0100")))) is None
    assert one(spark, F.hex(R.write_path(F.array(F.lit(0))))) == "00" and one(spark, F.hex(R.write_path(F.array(F.lit(1), F.lit(0))))) == "040200"


def test_topic_names(spark):
    names = ["orders.eu-1_v2", "", ".", "..", "orders eu", "orders/eu", "x" * 250, "x" * 249, "a\n", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, topic string")
    assert [r.ok for r in df.orderBy("i").select(R.legal_topic("topic").alias("ok")).collect()] == [True, False, False, False, False, False, False, True, False, False]


LOG = "topic string, partition int, offset bigint, txn_state string, settled boolean, timestamp timestamp"


def test_isolation_and_lag(spark):
    states = ["committed", "aborted", "control", "committed", "pending", "committed"]
    log = spark.createDataFrame([("t", 0, i, s, True, None) for i, s in enumerate(states)], LOG)
    at = lambda n: spark.createDataFrame([("t", 0, n)], "topic string, partition int, start bigint")
    first = lambda n: (lambda r: min(r) if r else None)([x.offset for x in logs.read_isolated(log, "read_committed", at(n)).collect()])
    assert [first(0), first(1), first(4), first(5)] == [0, 3, None, 5]
    none = spark.createDataFrame([], "topic string, partition int, next_offset bigint")
    assert logs.lag(log, none).first().lag == 2 and logs.lag(log, none, "read_uncommitted").first().lag == 5


def test_tracked_positions(spark):
    def position(rows):
        df = spark.createDataFrame([("t", 0, o, "", s, None) for o, s in rows], LOG)
        got = settle.committed_tracked(df).collect()
        return got[0].next_offset if got else None

    assert position([(3, True), (4, False), (5, True)]) == 4
    assert position([(5, False), (6, True)]) == 5
    assert position([(0, False), (1, True)]) is None and position([(7, False)]) is None
    assert position([(2, True), (9, True)]) == 10


def test_placing_and_refusing(spark):
    rows = [(0, "t", b"k", 3), (1, "t", b"k", 4), (2, "t", b"k", -1), (3, "t", None, None), (4, "t", b"", None), (5, "t", None, None), (6, "t", None, None), (7, "t", b"123456789", None)]
    df = spark.createDataFrame(rows, "i int, topic string, key binary, pin int")
    got = {r.i: r.partition for r in placement.place(df, 4, ["i"], pin="pin").collect()}
    assert got == {0: 3, 1: None, 2: None, 3: 0, 4: 1, 5: 2, 6: 3, 7: 0xCBF43926 % 4}
    for parts in (1, 4, 7):
        assert {r.i: r.partition for r in placement.place(df.repartition(parts), 4, ["i"], pin="pin").collect()} == got
    with pytest.raises(ValueError):
        placement.place(df, 0, ["i"])


def test_offsets_are_dense_and_do_not_depend_on_partitions(spark):
    rows = spark.range(2000).select(F.concat(F.lit("t"), F.col("id") % 3).alias("topic"), (F.col("id") % 17).cast("string").cast("binary").alias("key"), ((F.col("id") * 7919) % 2003).alias("at"))
    want = None
    for parts in (1, 4, 7):
        got = sorted((r.topic, r.partition, r.offset, r.sequence, r["at"]) for r in logs.topic_log(rows.repartition(parts), ["at"]).collect())
        by: dict = {}
        for t, p, o, _, _ in got:
            by.setdefault((t, p), []).append(o)
        assert all(v == list(range(len(v))) for v in by.values()) and sorted(g[3] for g in got) == list(range(2000))
        assert want is None or got == want
        want = got


def test_capped_retries(spark):
    empty = spark.createDataFrame([(1,)], "i int").withColumn("headers", R.no_headers())
    out = settle.process_with_retries(empty, F.lit("retry"), 3, "dlq").orderBy("round").collect()
    assert [(r.ordinal, r.result, r.dead_topic) for r in out] == [(1, "copied", None), (2, "copied", None), (3, "dead", "dlq")]
    assert [[h.value.decode() for h in r.headers] for r in out] == [[], ["1"], ["2"]]
    letters = settle.dead_letters(spark.createDataFrame([(1, "t", "retry")], "i int, topic string, outcome string").withColumn("headers", F.array(R.header(R.RETRY_HEADER, F.lit("2")))), 3, "dlq").first()
    assert letters.topic == "dlq" and letters.headers[0].value == b"3"
    with pytest.raises(ValueError):
        settle.retry_copies(empty, 2, "fixed")


def test_unknown_outcomes_are_retries(spark):
    df = spark.createDataFrame([(0, "ack"), (1, None), (2, "retry"), (3, "drop")], "offset bigint, outcome string").withColumns({"topic": F.lit("t"), "partition": F.lit(0), "headers": R.no_headers()})
    assert [r.settled for r in settle.settle(df).orderBy("offset").collect()] == [True, False, False, True]
    assert sorted(r.offset for r in settle.retry_copies(df, 3).collect()) == [1, 2] and sorted(r.offset for r in settle.dead_letters(df, 1, "dlq").collect()) == [1, 2]
    assert settle.committed_tracked(settle.settle(df)).first().next_offset == 1


def test_unknown_states_are_committed_everywhere(spark):
    log = spark.createDataFrame([("t", 0, 0, None, True, None), ("t", 0, 1, "committed", True, None), ("t", 0, 2, "aborted", True, None)], LOG).withColumn("sequence", F.col("offset"))
    assert [r.offset for r in logs.published_order(log, "t").collect()] == [0, 1] == sorted(r.offset for r in logs.read_isolated(log).collect())


def test_copies_are_due_to_the_microsecond(spark):
    df = spark.sql("SELECT timestamp_micros(1700000000123456) AS timestamp, 'retry_after' AS outcome, 7 AS delay_ms")
    got = settle.deferred_copies(df, "2023-11-14 22:13:20.130455").select(F.unix_micros("available_at").alias("us"), "due").first()
    assert (got.us, got.due) == (1700000000130456, False)


def test_subscriptions_refuse_bad_names(spark):
    log = spark.createDataFrame([("t", 0, 0, "", True, None)], LOG)
    for bad in (lambda: logs.subscribe_topics(log, []), lambda: logs.subscribe_topics(log, ["a", ""]), lambda: logs.subscribe_topics(log, "^a"), lambda: logs.subscribe_pattern(log, "a"), lambda: logs.subscribe_partitions(log, "t", []), lambda: logs.start_positions(log, "offset", 3)):
        with pytest.raises(ValueError):
            bad()
    assert logs.starting_offsets(spark.createDataFrame([("t", 0, 5), ("t", 1, None)], "topic string, partition int, start bigint")) == '{"t": {"0": 5, "1": -2}}'


def test_source_coordinates_keep_colons(spark):
    got = one(spark, R.parse_source(F.lit("3:17:a:b")))
    assert (got.topic, got.partition, got.offset) == ("a:b", 3, 17) and one(spark, R.parse_source(F.lit("x"))) is None


def test_evolution_flaws(spark):
    df = spark.createDataFrame([(1, ("a", [(1,)]))], "i int, w struct<s:string,l:array<struct<n:int>>>")
    inner = T.StructType([T.StructField("n", T.LongType())])
    ok = T.StructType([T.StructField("s", T.BinaryType()), T.StructField("l", T.ArrayType(inner))])
    got = framing.evolve_onto(df, "w", ok).first()
    assert got.failure is None and bytes(got.evolved.s) == b"a" and got.evolved.l[0].n == 1
    lacking = T.StructType([T.StructField("z", T.LongType())])
    assert "no default" in framing.evolve_onto(df, "w", lacking).first().failure
    narrow = T.StructType([T.StructField("s", T.LongType())])
    assert "is not read as" in framing.evolve_onto(df, "w", narrow).first().failure


ORDER_1 = '{"type":"record","name":"Order","fields":[{"name":"id","type":"long"}]}'
ORDER_2 = '{"type":"record","name":"Order","fields":[{"name":"id","type":"long"},{"name":"item","type":{"type":"record","name":"Item","fields":[{"name":"sku","type":"string"}]}},{"name":"note","type":["null","string"],"default":null}]}'
TREE = '{"type":"record","name":"Node","fields":[{"name":"kids","type":{"type":"array","items":{"type":"record","name":"Node","fields":[{"name":"kids","type":{"type":"array","items":"Node"}}]}}}]}'


def test_a_new_field_without_default_is_a_break(spark):
    schemas = spark.createDataFrame([(1, "orders-value", 1, "AVRO", ORDER_1), (2, "orders-value", 2, "AVRO", ORDER_2)], "id int, subject string, version int, schema_type string, definition string")
    levels = spark.createDataFrame([("orders-value", "BACKWARD_TRANSITIVE")], "subject string, level string")
    got = audit.compatibility_audit(schemas, levels).collect()
    assert [(r.direction, r.ok, r.problems) for r in got] == [("backward", False, ["item: the writer lacks it and it has no default"])]


def versions(spark, kind, *definitions):
    return spark.createDataFrame([(k, "s", k, kind, d if isinstance(d, str | None) else json.dumps(d)) for k, d in enumerate(definitions, 1)], "id int, subject string, version int, schema_type string, definition string")


def verdict(spark, kind, writer, reader, level="BACKWARD"):
    levels = spark.createDataFrame([("s", level)], "subject string, level string")
    return [(r.direction, r.ok, r.problems) for r in sorted(audit.compatibility_audit(versions(spark, kind, writer, reader), levels).collect())]


def record(name, *fields):
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t, **(more[0] if more else {})} for n, t, *more in fields]}


def test_recursive_schemas_stop(spark):
    rows = audit.schema_fields(versions(spark, "AVRO", TREE, "{oops", None)).collect()
    assert {(r.version, r.path, r.type) for r in rows} == {(1, "", "record Node"), (1, "kids", "array"), (1, "kids[]", "record Node"), (1, "kids[].kids", "array"), (1, "kids[].kids[]", "record Node"), (2, "", "unparsable"), (3, "", "unparsable")}
    node = {"$ref": "#/$defs/n", "$defs": {"n": {"type": "object", "properties": {"v": {"enum": ["b", "a"]}, "next": {"anyOf": [{"$ref": "#/$defs/n"}, {"type": "null"}]}}, "required": ["v"]}}}
    rows = audit.schema_fields(versions(spark, "JSON", node)).collect()
    assert {(r.path, r.type, r.nullable, r.has_default, r.symbols) for r in rows} == {("", "object", False, False, None), ("v", "string", False, False, "a,b"), ("next", "object", True, True, None)}


def test_what_is_not_compared_is_never_ok(spark):
    assert verdict(spark, "AVRO", "{oops", "{oops")[0][1] is False
    assert verdict(spark, "AVRO", record("R", ("x", "other.T")), record("R", ("x", "other.T"))) == [("backward", None, ["x: type other.T, which is defined elsewhere is not compared"])]
    stamp = lambda unit: record("R", ("t", {"type": "long", "logicalType": f"timestamp-{unit}"}))
    assert verdict(spark, "AVRO", stamp("millis"), stamp("micros"))[0][1] is None and verdict(spark, "AVRO", stamp("micros"), stamp("micros"))[0][1] is True
    no = {"type": "string", "not": {"const": "x"}}
    assert verdict(spark, "JSON", no, no) == [("backward", True, [])] and verdict(spark, "JSON", {"type": "string"}, no)[0][1] is None
    assert verdict(spark, "JSON", no, {"type": "integer"})[0][1] is None  # what the writer leaves out may be all that differs
    assert verdict(spark, "JSON", {"$ref": "other.json"}, {"$ref": "other.json"})[0][1] is None


def test_sets_of_values(spark):
    span = lambda **x: {"type": "integer"} | x
    cases = [
        (span(maximum=5), span(maximum=10), True), (span(maximum=10), span(maximum=5), False), (span(exclusiveMinimum=0), span(minimum=1), True), ({"type": "number", "minimum": 0}, {"type": "number", "exclusiveMinimum": 0}, False),
        (span(format="int32"), span(format="int64"), True), (span(format="uint64"), span(format="int64"), False), (span(multipleOf=6), span(multipleOf=3), True), (span(multipleOf=3), span(multipleOf=6), False),
        ({"enum": [1, 2]}, span(maximum=2), True), ({"enum": [1, 3]}, span(maximum=2), False), ({"const": "a"}, {"enum": ["a", "b"]}, True), ({"enum": ["a", "b"]}, {"const": "a"}, False),
        ({"type": "string", "maxLength": 3}, {"type": "string", "maxLength": 4}, True), ({"type": "string"}, {"type": "string", "minLength": 1}, False),
        ({"type": "array"}, {"type": "array", "items": {"type": "integer"}}, False), ({"type": "array", "items": {"type": "integer"}}, {"type": "array", "items": {"type": "number"}}, True),
        ({"type": "array", "uniqueItems": True}, {"type": "array"}, True), ({"type": "array"}, {"type": "array", "uniqueItems": True}, False), ({"type": "array", "maxItems": 2}, {"type": "array", "maxItems": 1}, False),
        (False, {"type": "string"}, True), (True, {"type": "string"}, False), ({"type": ["integer", "null"]}, {"anyOf": [{"type": "number"}, {"type": "null"}]}, True),
        ({"allOf": [{"type": "integer"}, {"maximum": 5}]}, span(maximum=5), True), ({"type": "string", "format": "uuid"}, {"type": "string"}, True), ({"type": "string"}, {"type": "string", "format": "uuid"}, False),
        ({"type": "object", "properties": {"a": {"type": "string"}}}, {"type": "object", "additionalProperties": {"type": "integer"}}, False),
    ]
    rows = [(k * 2 + n, f"s{k:02}", n + 1, "JSON", json.dumps(c[n])) for k, c in enumerate(cases) for n in (0, 1)]
    got = audit.compatibility_audit(spark.createDataFrame(rows, "id int, subject string, version int, schema_type string, definition string"), spark.createDataFrame([], "subject string, level string")).collect()
    assert {r.subject: r.ok for r in got} == {f"s{k:02}": c[2] for k, c in enumerate(cases)}


def test_branches_and_types_that_come_back(spark):
    tag = lambda t, **p: {"type": "object", "properties": {"t": {"const": t}, **p}, "required": ["t"]}
    a, b = tag("a", x={"type": "integer"}), tag("b")
    assert verdict(spark, "JSON", {"oneOf": [a, b]}, {"oneOf": [b, tag("a", x={"type": "string"})]}) == [("backward", False, ["<1>.x: integer is not read as string"])]
    one = lambda t: {"type": "object", "properties": {"x": {"type": t}}, "required": ["x"]}
    assert verdict(spark, "JSON", one("integer"), {"anyOf": [one("string"), one("number")]}) == [("backward", True, [])]
    assert verdict(spark, "JSON", one("boolean"), {"anyOf": [one("string"), one("number")]}) == [("backward", False, [": object is read by no branch"])]
    assert verdict(spark, "JSON", {"type": "integer"}, {"oneOf": [{"type": "integer"}, {"type": "number"}]})[0][1] is None  # both branches admit it
    # A list whose items are lists of the same kind or numbers: branches that come back to themselves.
    tree = lambda leaf: {"$ref": "#/$defs/n", "$defs": {"n": {"anyOf": [{"type": "array", "items": {"$ref": "#/$defs/n"}}, {"type": leaf}]}}}
    deep = lambda leaf: {"$ref": "#/$defs/n", "$defs": {"n": {"anyOf": [one("string") | {"properties": {"x": {"$ref": "#/$defs/n"}}}, one("string") | {"properties": {"x": {"type": leaf}}}]}}}
    assert [verdict(spark, "JSON", f("integer"), f("number"))[0][1] for f in (tree, deep)] == [True, True]
    assert [verdict(spark, "JSON", f("number"), f("integer"))[0][1] for f in (tree, deep)] == [False, False]
    linked = lambda kind: record("P", ("q", ["null", record("Q", ("p", ["null", "P"]), ("n", kind))]))
    assert verdict(spark, "AVRO", linked("int"), linked("long"), "FULL") == [("backward", True, []), ("forward", False, ["q.n: long is not read as int"])]
    old, new = record("Old", ("a", "int")), record("New", ("b", "int", {"aliases": ["a"]})) | {"aliases": ["x.Old"]}
    assert verdict(spark, "AVRO", old, new) == [("backward", True, [])] and verdict(spark, "AVRO", new, old)[0][1] is False


def test_definitions_are_compared_once(spark, monkeypatch):
    """Ten thousand subjects of two definitions are two pairs."""
    rows = spark.range(20000).select(F.col("id"), F.concat(F.lit("s"), F.floor(F.col("id") / 2)).alias("subject"), (F.col("id") % 2 + 1).alias("version"), F.lit("AVRO").alias("schema_type"), F.when(F.col("id") % 2 == 0, ORDER_1).otherwise(ORDER_2).alias("definition"))
    met, compared = [], audit._compared
    monkeypatch.setattr(audit, "_compared", lambda roots, nodes: met.append(roots.count()) or compared(roots, nodes))
    out = audit.compatibility_audit(rows, spark.createDataFrame([], "subject string, level string"))
    assert out.where("not ok").count() == 10000 and met == [1]


def test_a_task_orders_a_bounded_part_of_the_versions(spark, monkeypatch):
    """The tasks that order versions follow their bytes, and verdicts meet the versions without a shuffle."""
    monkeypatch.setattr(audit, "TASK_BYTES", 1 << 17, raising=False)
    rows = spark.range(20000).select(F.col("id"), F.concat(F.lit("s"), F.floor(F.col("id") / 2)).alias("subject"), (F.col("id") % 2 + 1).alias("version"), F.lit("AVRO").alias("schema_type"), F.when(F.col("id") % 2 == 0, ORDER_1).otherwise(ORDER_2).alias("definition"))
    levels = spark.range(0, 10000, 2).select(F.concat(F.lit("s"), "id").alias("subject"), F.lit("FULL_TRANSITIVE").alias("level"))
    pairs = audit._versions_to_compare(audit._keyed(rows), levels)
    held = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 15000 and max(held) < 2000
    out = audit.compatibility_audit(rows, levels)
    assert out.where("not ok").count() == 10000 and out.where("ok").count() == 5000
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_lanes_and_violations(spark):
    rows = spark.createDataFrame([("a", "t", 0, o, p) for o, p in ((0, 1), (1, 3), (2, 2))] + [("b", "t", 0, 3, 1)], "key string, topic string, partition int, offset bigint, processed_at int")
    assert [tuple(r) for r in models.order_violations(rows).collect()] == [("a", 1)]
    lanes = models.ordered_lanes(rows, "key", ["offset"], 3)

    def seen(it):
        for pdf in it:
            yield pdf.assign(n=range(len(pdf)))[["key", "offset"]]

    assert sorted(map(tuple, lanes.mapInPandas(seen, "key string, offset bigint").collect())) == [("a", 0), ("a", 1), ("a", 2), ("b", 3)]


@pytest.mark.parametrize("parts", [1, 5])
def test_scans_of_a_hot_group(spark, parts):
    rng = __import__("random").Random(1)
    rows = [(0 if rng.random() < 0.5 else rng.choice([1, 2, 3, None]), i, rng.choice([None, 1, 2, 9]), rng.randint(-5, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, at int, a int, b int").repartition(parts)
    steps = {"total": ("sum", F.col("b")), "top": ("max", F.col("a")), "low": ("min", F.col("b")), "held": ("last", F.col("a"))}
    for before in (False, True):
        got = {r["at"]: (r.total, r.top, r.low, r.held) for r in logs.prefix_scan(df, ["g"], ["at"], steps, before).collect()}
        for g, at, _, _ in rows:
            own = [r for r in rows if r[0] == g and (r[1] < at or (r[1] == at and not before))]
            known = [r[2] for r in own if r[2] is not None]
            assert got[at] == ((sum(r[3] for r in own), max(known, default=None), min(r[3] for r in own), known[-1] if known else None) if own else (None,) * 4)
    # Half of all rows are of one group; no task of the scan's windows has more than its slice of them.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sliced = logs.slices(df.withColumn("g", F.lit(7)), ["g", "at"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] < 250


def test_fencing_and_exactly_once_rows(spark):
    log = spark.createDataFrame([("p", 1, 1), ("p", 2, 2), (None, None, None)], "transactional_id string, epoch bigint, txn bigint")
    marks = spark.createDataFrame([("p", 2, 2, "commit")], "transactional_id string, epoch bigint, txn bigint, marker string")
    assert sorted((r.txn or 0, r.txn_state, r.fenced) for r in txn.fence(log, marks).collect()) == [(0, "committed", False), (1, "aborted", True), (2, "committed", False)]


def test_written_logs_come_back_and_prune_by_topic(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, 0, b"k", b"v"), ("b", 1, 0, None, b"w")], "topic string, partition int, offset bigint, key binary, value binary")
    placement.write_log(rows, f"{tmp_path}/log")
    back = logs.read_log(spark, f"{tmp_path}/log")
    assert sorted((r.topic, r.offset, bytes(r.value)) for r in back.collect()) == [("a", 0, b"v"), ("b", 0, b"w")]
    plan = logs.subscribe_topics(back, "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan or "PartitionFilters: [(topic" in plan
    assert logs.subscribe_topics(back, "a").count() == 1


def test_types_of_definitions(spark):
    of = lambda kind, d: readers.spark_type(json.dumps(d), kind)
    avro = record("R", ("i", "int"), ("n", ["null", "long"], {"default": None}), ("e", {"type": "enum", "name": "E", "symbols": ["A"]}), ("f", {"type": "fixed", "name": "F", "size": 4}), ("l", {"type": "array", "items": ["null", "string"]}), ("m", {"type": "map", "values": "E"}), ("s", record("S", ("x", "double", {"default": 1.5}))), ("again", "S"))
    got = of("AVRO", avro)
    assert got.simpleString() == "struct<i:int,n:bigint,e:string,f:binary,l:array<string>,m:map<string,string>,s:struct<x:double>,again:struct<x:double>>"
    assert [f.nullable for f in got] == [False, True] + [False] * 6 and got["n"].metadata == {"default": None} and got["s"].dataType["x"].metadata == {"default": 1.5}
    doc = {"type": "object", "properties": {"a": {"$ref": "#/$defs/x"}, "b": {"type": ["integer", "null"], "default": 3}, "c": {"anyOf": [{"type": "string"}, {"type": "null"}]}, "d": {"type": "object", "additionalProperties": {"type": "number"}}, "l": {"type": "array", "items": {"type": "boolean"}}}, "required": ["a", "b"], "$defs": {"x": {"enum": ["q"]}}}
    got = of("JSON", doc)
    assert got.simpleString() == "struct<a:string,b:bigint,c:string,d:map<string,double>,l:array<boolean>>"
    assert [f.nullable for f in got] == [False, True, True, True, True] and got["b"].metadata == {"default": 3}
    for kind, bad in (("AVRO", ["int", "string"]), ("AVRO", record("R", ("x", ["int", "string"]))), ("AVRO", record("R", ("x", ["null", "R"]))), ("AVRO", record("R", ("x", "Other"))), ("JSON", {"type": "object", "properties": {"a": {}}}), ("JSON", {"type": "object", "properties": {"n": {"$ref": "#/properties/n"}}}), ("JSON", True)):
        with pytest.raises(readers.NoSuchType):
            of(kind, bad)
    with pytest.raises(readers.NoSuchType):
        readers.spark_type("{oops", "JSON")
