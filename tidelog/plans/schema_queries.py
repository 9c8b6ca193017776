"""Registered queries of framing, evolution and audits."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import records as R
from tidelog.operators import audit as A
from tidelog.operators import framing as G
from tidelog.plans.fixtures import FRAMED, LOG, event_log, framed, schemas, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_NONE = lambda c: F.coalesce(c, F.lit(-1).cast("bigint"))


@query(f"WITH {FRAMED} SELECT event_id, is_framed AS framed, coalesce(schema_id, -1) AS schema_id, CASE WHEN is_framed THEN payload END AS datum FROM framed")
def split_envelope(s, d):
    return G.split_envelope(framed(s, d)).select("event_id", "framed", _NONE(F.col("schema_id")).alias("schema_id"), F.col("datum").cast("string").alias("datum"))


@query("""SELECT event_id, '00' || printf('%08X', event_id + 1234) || hex(encode(props)) AS bytes FROM events""")
def add_envelope(s, d):
    return event_log(s, d).select("event_id", F.hex(R.add_envelope(F.col("event_id") + 1234, "value")).alias("bytes"))


@query(f"""WITH {FRAMED} SELECT event_id, CASE schema_id WHEN 1 THEN 'events-value' WHEN 2 THEN 'events-value' END AS subject,
CASE WHEN NOT is_framed THEN 'unframed' WHEN schema_id = 3 THEN 'unknown_id' END AS failure FROM framed""")
def resolve_schema(s, d):
    return G.resolve_schema(framed(s, d), schemas(s)).select("event_id", "subject", "failure")


@query(f"""WITH {FRAMED} SELECT event_id, CASE WHEN is_framed AND event_id % 13 > 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE -1 END AS k,
CASE WHEN NOT is_framed THEN 'unframed' WHEN event_id % 13 = 0 THEN 'bad_json' END AS failure FROM framed""")
def decode_json(s, d):
    broken = framed(s, d).withColumn("value", F.when(F.col("event_id") % 13 == 0, F.concat("value", F.lit(b"}{x"), F.lit(b"\x01"))).otherwise(F.col("value")))
    broken = broken.withColumn("value", F.when(F.col("event_id") % 13 == 0, F.when(R.is_framed("value"), R.add_envelope(1, F.lit("{\"k\": oops"))).otherwise(F.col("value"))).otherwise(F.col("value")))
    return G.decode_json(broken, "k bigint", "strict").select("event_id", _NONE(F.col("decoded.k")).alias("k"), "failure")


@query(f"""WITH {FRAMED} SELECT event_id, CASE WHEN is_framed AND schema_id = 3 THEN '0000000003' ELSE '' END || hex(encode(payload)) AS plain,
CASE WHEN NOT is_framed THEN 'unframed' WHEN schema_id = 3 THEN 'unknown_id' END AS passed FROM framed""")
def to_plain_json(s, d):
    return G.to_plain_json(framed(s, d), schemas(s)).select("event_id", F.hex("plain").alias("plain"), "passed")


@query(f"""WITH {LOG} SELECT event_id, CASE event_type WHEN 'view' THEN '0000000004' WHEN 'click' THEN '0000000005' ELSE '' END || hex(encode(payload)) AS bytes FROM log""")
def frame_by_subject(s, d):
    return G.frame_by_subject(event_log(s, d), schemas(s), G.subject_name("topic_name")).select("event_id", F.hex("value").alias("bytes"))


@query("""SELECT DISTINCT event_type, 'events.' || event_type || '-value' AS by_topic, 'acme.' || event_type AS by_record, CASE WHEN event_type = 'view' THEN 'pinned' ELSE 'events.' || event_type || '-acme.' || event_type END AS by_both FROM events""")
def subject_name(s, d):
    rows = event_log(s, d).select("event_type", "topic", F.concat(F.lit("acme."), "event_type").alias("record"), F.when(F.col("event_type") == "view", "pinned").alias("pin")).distinct()
    return rows.select("event_type", G.subject_name("topic_name").alias("by_topic"), G.subject_name("record_name").alias("by_record"), G.subject_name("topic_record_name", pin="pin").alias("by_both"))


@query("""WITH u AS (SELECT DISTINCT 'events.' || event_type || '-value' AS subject FROM events WHERE event_type NOT IN ('view', 'click')) SELECT subject, 'registered' AS action, 5 + row_number() OVER (ORDER BY subject) AS id FROM u""")
def missing_subject(s, d):
    used = event_log(s, d).select(G.subject_name("topic_name").alias("subject"), F.lit("{}").alias("definition")).distinct()
    return G.missing_subject(used, schemas(s), "auto_register")


@query(f"""WITH {FRAMED} SELECT event_id, CASE WHEN is_framed THEN 'already_framed' WHEN event_type NOT IN ('view', 'click') THEN 'no_subject' WHEN event_type = 'view' THEN 'other_flavor' END AS passed FROM framed""")
def frame_once(s, d):
    return G.frame_once(framed(s, d), schemas(s), G.subject_name("topic_name"), "JSON").select("event_id", "passed")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'acme.Order' || o_orderstatus WHEN 1 THEN 'Title' || o_orderstatus WHEN 2 THEN 'x.A' || o_orderstatus || ',x.B' || o_orderstatus END AS names FROM orders""")
def record_name(s, d):
    o, st = table(s, d, "orders"), F.col("o_orderstatus")
    k = F.col("o_orderkey") % 4
    rec = lambda n, space: F.concat(F.lit('{"type":"record","name":"' + n), st, F.lit(f'","namespace":"{space}","fields":[]}}'))
    text = F.when(k == 0, rec("Order", "acme")).when(k == 1, F.concat(F.lit('{"title":"Title'), st, F.lit('","type":"object"}'))).when(k == 2, F.concat(F.lit('["null",'), rec("A", "x"), F.lit(","), rec("B", "x"), F.lit("]"))).otherwise(F.lit("not json"))
    made = o.select("o_orderkey", F.col("o_orderkey").alias("id"), F.lit("s").alias("subject"), F.lit(1).alias("version"), F.when(k == 1, "JSON").otherwise("AVRO").alias("schema_type"), text.alias("definition"))
    names = F.array_join(F.filter("names", lambda n: n.isNotNull()), ",")
    return G.record_names(made).select("o_orderkey", F.when(names != "", names).alias("names"))


@query("""SELECT 'events.' || event_type AS topic, coalesce(CASE WHEN event_id % 4 < 3 THEN event_id % 4 END, -1) AS branch, count(*) AS n FROM events GROUP BY ALL""")
def branch_profile(s, d):
    head = F.when(F.col("event_id") % 4 < 3, F.unhex(F.lpad(F.hex(F.col("event_id") % 4 * 2), 2, "0"))).otherwise(F.lit(b"\x80"))
    rows = event_log(s, d).withColumn("datum", F.when(F.col("event_id") % 4 < 3, F.concat(head, "value")).otherwise(head))
    return G.branch_profile(rows).withColumn("branch", _NONE(F.col("branch")))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'acme.View' WHEN 1 THEN 'acme.Click' END AS record FROM events""")
def split_by_record(s, d):
    rows = event_log(s, d).withColumn("value", R.add_envelope(F.when(F.col("event_id") % 3 == 0, 4).when(F.col("event_id") % 3 == 1, 5).otherwise(1), "value"))
    return G.split_by_record(rows, schemas(s), ["acme.View", "acme.Click"]).select("event_id", "record")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Order' WHEN 1 THEN 'Line' END AS message_type, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 0 THEN '0' WHEN event_id % 4 = 1 THEN '1' ELSE '2,300,0,0,0,0,0,0,0,70000,1' END AS path, CASE WHEN event_id % 4 < 3 THEN props END AS message FROM events""")
def route_by_message(s, d):
    k = F.col("event_id") % 4
    path = F.when(k == 0, F.array(F.lit(0))).when(k == 1, F.array(F.lit(1))).otherwise(F.array(*[F.lit(i) for i in (2, 300, *[0] * 7, 70000, 1)]))
    rows = event_log(s, d).withColumn("datum", F.when(k == 3, F.lit(b"\x04\x02")).otherwise(F.concat(R.write_path(path), "value")))
    out = G.route_by_message(rows, {"Order": [0], "Line": [1]})
    return out.select("event_id", "message_type", F.array_join("path", ",").alias("path"), F.col("message").cast("string").alias("message"))


def _reader(**extra) -> T.StructType:
    fields = [T.StructField("id", T.DoubleType(), False), T.StructField("name", T.BinaryType()), T.StructField("currency", T.StringType(), False, {"default": "EUR"}), T.StructField("sizes", T.MapType(T.StringType(), T.LongType(), False))]
    return T.StructType(fields)


@query("""SELECT o_orderkey, CASE WHEN NOT bad THEN CAST(o_custkey AS DOUBLE) END AS id, CASE WHEN NOT bad THEN 'EUR' END AS currency, CASE WHEN NOT bad THEN o_orderstatus END AS name,
CASE WHEN NOT bad THEN CAST(o_orderkey % 7 AS BIGINT) END AS rest, CASE WHEN bad THEN 'null for a field that is not nullable' END AS failure
FROM (SELECT *, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS bad FROM orders)""")
def evolve_onto(s, d):
    rest = (F.col("o_orderkey") % 7).cast("int")
    sizes = F.create_map(F.lit("rest"), F.when(rest > 0, rest))
    w = F.struct(F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_totalprice").alias("extra"), sizes.alias("sizes"))
    out = G.evolve_onto(table(s, d, "orders").withColumn("w", w), "w", _reader())
    return out.select("o_orderkey", "evolved.id", "evolved.currency", F.col("evolved.name").cast("string").alias("name"), F.col("evolved.sizes")["rest"].alias("rest"), "failure")


@query("""SELECT event_id, CASE WHEN event_id % 10 = 9 OR event_id % 20 = 18 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
CASE WHEN event_id % 10 = 9 OR event_id % 20 = 18 THEN NULL WHEN event_id % 10 < 5 THEN 'EUR' ELSE 'USD' END AS currency,
CASE WHEN event_id % 10 = 9 THEN 'unknown_id' WHEN event_id % 20 = 18 THEN 'bad_json' END AS failure FROM events""")
def fanin_versions(s, d):
    k = F.get_json_object("props", "$.k")
    v2 = F.when(F.col("event_id") % 20 == 18, '{"k": oops').otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "currency": "USD"}')))
    rows = event_log(s, d).withColumn("value", F.when(F.col("event_id") % 10 < 5, R.add_envelope(1, "props")).when(F.col("event_id") % 10 < 9, R.add_envelope(2, v2)).otherwise(R.add_envelope(9, "props")))
    reader = T.StructType([T.StructField("k", T.LongType()), T.StructField("currency", T.StringType(), True, {"default": "EUR"})])
    writers = {1: T.StructType.fromDDL("k int"), 2: T.StructType.fromDDL("k bigint, currency string")}
    return G.fanin_versions(rows, writers, reader).select("event_id", _NONE(F.col("evolved.k")).alias("k"), "evolved.currency", "failure")


# ---- audits: one subject for each order, so the work grows with the table ----


def _fleet(s, d):
    """Two versions of a schema for each order: version 2 adds a field, without a default where the key is
    odd, widens `n` where it is a multiple of 3, and narrows it otherwise."""
    o = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("order-"), "o_orderkey").alias("subject"))
    k = F.col("o_orderkey")
    v1 = F.when(k % 3 == 0, '{"type":"record","name":"O","fields":[{"name":"id","type":"long"},{"name":"n","type":"int"}]}').otherwise('{"type":"record","name":"O","fields":[{"name":"id","type":"long"},{"name":"n","type":["null","long"]}]}')
    add = F.when(k % 2 == 1, '{"name":"item","type":{"type":"record","name":"I","fields":[{"name":"sku","type":"string"}]}}').otherwise('{"name":"note","type":["null","string"],"default":null}')
    v2 = F.concat(F.lit('{"type":"record","name":"O","fields":[{"name":"id","type":"long"},{"name":"n","type":"long"},'), add, F.lit("]}"))
    base = o.select("o_orderkey", "subject", F.lit("AVRO").alias("schema_type"), F.explode(F.array(F.struct(F.lit(1).alias("version"), v1.alias("definition")), F.struct(F.lit(2).alias("version"), v2.alias("definition")))).alias("x"))
    return base.select("o_orderkey", "subject", "schema_type", "x.version", "x.definition", (F.col("o_orderkey") * 2 + F.col("x.version")).alias("id"))


def _record(*fields: tuple, name: str = "O") -> dict:
    return {"type": "record", "name": name, "fields": [{"name": n, "type": t} for n, t in fields]}


def _object(required: list, closed: bool = False, **properties) -> dict:
    return {"type": "object", "properties": properties, "required": required} | ({"additionalProperties": False} if closed else {})


def _deep(leaf: str, levels: int = 5) -> dict:
    return _record(("a", _deep(leaf, levels - 1) if levels else leaf), name=f"D{levels}")


def _linked(kind: str) -> dict:
    """Two records, each of which may hold the other."""
    return _record(("q", ["null", _record(("p", ["null", "P"]), ("n", kind), name="Q")]), name="P")


def _tagged(name: str, **more) -> dict:
    return _object(["kind"], kind={"const": name}, **more)


def _decimal(scale: int) -> dict:
    return {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": scale}


def _list_of(kind: str) -> dict:
    node = _object([], v={"type": kind}, next={"anyOf": [{"$ref": "#/$defs/node"}, {"type": "null"}]})
    return {"$ref": "#/$defs/node", "$defs": {"node": node}}


_P = _record(("q", "int"), name="P")
#: By order key modulo their number: flavor, version 1 and version 2 of a subject's schema.
KINDS = [
    ("AVRO", _record(("x", ["int", "string"])), _record(("x", ["int", "boolean"]))),
    ("AVRO", _record(("c", {"type": "enum", "name": "C", "symbols": ["B", "A"]})), _record(("c", {"type": "enum", "name": "C", "symbols": ["A"]}))),
    ("AVRO", _deep("int"), _deep("string")),
    ("JSON", _object(["a"], a={"type": "integer"}), _object(["a"], a={"type": "number"}, b={"type": "string"})),
    ("JSON", _object([], a={"type": "integer"}, z={"type": "string"}), _object([], closed=True, a={"type": "integer"})),
    ("JSON", _object([], b={"type": "string"}, e={"enum": ["x", "y"]}), _object(["b"], b={"type": ["string"]}, e={"enum": ["x"]})),
    ("AVRO", _record(("p", _P)), _record(("p", ["null", _P]))),
    ("AVRO", _record(("p", _P), ("u", "P")), _record(("p", _P), ("u", "acme.P"))),
    ("AVRO", "{oops", "{oops"),
    # The named type stands in another place on either side.
    ("AVRO", _record(("x", _record(("k", "int"), name="A")), ("y", "A")), _record(("y", _record(("k", "int"), ("z", "string"), name="A")), ("x", "A"))),
    ("AVRO", _linked("int"), _linked("long")),
    ("JSON", _object([], n={"type": "integer", "maximum": 10}, s={"type": "string"}), _object([], n={"type": "integer", "maximum": 5}, s={"type": "string", "maxLength": 9})),
    ("JSON", {"$ref": "#/$defs/a", "$defs": {"a": _object([], v={"type": "integer"})}}, {"$ref": "#/$defs/b", "$defs": {"b": _object([], v={"type": "string"})}}),
    ("JSON", {"oneOf": [{"type": "integer"}, {"type": "boolean"}]}, {"oneOf": [{"type": "string"}, {"type": "boolean"}]}),
    ("JSON", {"oneOf": [_tagged("card", n={"type": "integer"}), _tagged("cash")]}, {"oneOf": [_tagged("cash"), _tagged("card", n={"type": "number"})]}),
    ("AVRO", _record(("d", _decimal(2)), ("old", "int")), {**_record(("d", _decimal(4))), "fields": [{"name": "d", "type": _decimal(4)}, {"name": "new", "type": "int", "aliases": ["old"]}]}),
    ("JSON", _object([], a={"type": "string"}), _object([], a={"type": "string", "not": {"const": "x"}})),
    ("JSON", _object(["x"], x={"type": "integer"}), {"anyOf": [_object(["x"], x={"type": "string"}), _object(["x"], x={"type": "number"})]}),
    ("JSON", _list_of("integer"), _list_of("number")),
    ("JSON", _object([]), "{oops"),
]


def _kinds(s, d):
    """Two versions of a schema of the order's kind, for each order."""
    k = F.col("o_orderkey") % len(KINDS)
    pick = lambda at: F.element_at(F.array(*[F.lit(x[at] if at == 0 or isinstance(x[at], str) else json.dumps(x[at])) for x in KINDS]), (k + 1).cast("int"))
    two = F.array(*[F.struct(F.lit(n).alias("version"), pick(n).alias("definition")) for n in (1, 2)])
    rows = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("kind-"), "o_orderkey").alias("subject"), pick(0).alias("schema_type"), F.explode(two).alias("x"))
    return rows.select("o_orderkey", "subject", "schema_type", "x.version", "x.definition", (F.col("o_orderkey") * 2 + F.col("x.version")).alias("id"))


@query("""SELECT 'order-' || o_orderkey AS subject, v.version, v.path, v.type, v.nullable, v.has_default, CAST(NULL AS VARCHAR) AS symbols FROM (SELECT o_orderkey, unnest([
{'version': 1, 'path': '', 'type': 'record O', 'nullable': false, 'has_default': false}, {'version': 1, 'path': 'id', 'type': 'long', 'nullable': false, 'has_default': false},
{'version': 1, 'path': 'n', 'type': CASE WHEN o_orderkey % 3 = 0 THEN 'int' ELSE 'long' END, 'nullable': o_orderkey % 3 > 0, 'has_default': false},
{'version': 2, 'path': '', 'type': 'record O', 'nullable': false, 'has_default': false}, {'version': 2, 'path': 'id', 'type': 'long', 'nullable': false, 'has_default': false}, {'version': 2, 'path': 'n', 'type': 'long', 'nullable': false, 'has_default': false},
{'version': 2, 'path': CASE WHEN o_orderkey % 2 = 1 THEN 'item' ELSE 'note' END, 'type': CASE WHEN o_orderkey % 2 = 1 THEN 'record I' ELSE 'string' END, 'nullable': o_orderkey % 2 = 0, 'has_default': o_orderkey % 2 = 0},
CASE WHEN o_orderkey % 2 = 1 THEN {'version': 2, 'path': 'item.sku', 'type': 'string', 'nullable': false, 'has_default': false} END]) AS v FROM orders) WHERE v IS NOT NULL""")
def schema_fields(s, d):
    return A.schema_fields(_fleet(s, d))


@query("""SELECT 'order-' || o_orderkey AS subject, 2 AS new_version, 1 AS old_version, w AS direction,
CASE WHEN w = 'backward' THEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 ELSE o_orderkey % 3 > 0 END AS ok,
CASE WHEN w = 'backward' THEN concat_ws('; ', CASE WHEN o_orderkey % 2 = 1 THEN 'item: the writer lacks it and it has no default' END, CASE WHEN o_orderkey % 3 > 0 THEN 'n: the writer may write null' END)
ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'n: long is not read as int' ELSE '' END END AS problems
FROM orders, (VALUES ('backward'), ('forward')) AS ways(w) WHERE o_orderkey % 4 > 0 AND (w = 'backward' OR o_orderkey % 4 = 1)
UNION ALL SELECT 'kind-' || o_orderkey, 2, 1, v.direction, v.ok, v.problems FROM orders JOIN (VALUES
(0, 'backward', false, 'x: string is not read as int|boolean'), (0, 'forward', false, 'x: boolean is not read as int|string'),
(1, 'backward', false, 'c: symbol B is not read'), (1, 'forward', true, ''),
(2, 'backward', false, 'a.a.a.a.a.a: int is not read as string'), (2, 'forward', false, 'a.a.a.a.a.a: string is not read as int'),
(3, 'backward', true, ''), (3, 'forward', false, 'a: number is not read as integer'),
(4, 'backward', false, ': the reader''s object is closed and the writer''s is open; z: the reader''s object is closed and lacks it'), (4, 'forward', true, ''),
(5, 'backward', false, 'b: the writer may leave it out; e: symbol y is not read'), (5, 'forward', true, ''),
(6, 'backward', true, ''), (6, 'forward', false, 'p: the writer may write null'), (7, 'backward', true, ''), (7, 'forward', true, ''),
(8, 'backward', false, ': the reader''s definition does not parse'), (8, 'forward', false, ': the reader''s definition does not parse'),
(9, 'backward', false, 'x.z: the writer lacks it and it has no default; y.z: the writer lacks it and it has no default'), (9, 'forward', true, ''),
(10, 'backward', true, ''), (10, 'forward', false, 'q.n: long is not read as int'),
(11, 'backward', false, 'n: (,10] is not within (,5]; s: length 0 to any is not within 0 to 9'), (11, 'forward', true, ''),
(12, 'backward', false, 'v: integer is not read as string'), (12, 'forward', false, 'v: string is not read as integer'),
(13, 'backward', false, '<1>: integer is read by no branch'), (13, 'forward', false, '<1>: string is read by no branch'),
(14, 'backward', true, ''), (14, 'forward', false, '<2>.n: number is not read as integer'),
(15, 'backward', false, 'd: decimal(9,2) is not read as decimal(9,4)'), (15, 'forward', false, 'd: decimal(9,4) is not read as decimal(9,2); old: the writer lacks it and it has no default'),
(16, 'backward', NULL, 'a: not is not compared'), (16, 'forward', true, ''),
(17, 'backward', true, ''), (17, 'forward', false, '<1>.x: string is not read as integer; <2>.x: number is not read as integer'),
(18, 'backward', true, ''), (18, 'forward', false, 'v: number is not read as integer'),
(19, 'backward', false, ': the reader''s definition does not parse'), (19, 'forward', false, ': the writer''s definition does not parse')
) AS v(kind, direction, ok, problems) ON o_orderkey % 20 = v.kind""")
def compatibility_audit(s, d):
    fleet = _fleet(s, d)
    kinds = _kinds(s, d)
    full = kinds.where("version = 1").select("subject", F.lit("FULL").alias("level"))
    levels = fleet.where("version = 1").select("subject", F.when(F.col("o_orderkey") % 4 == 0, "NONE").when(F.col("o_orderkey") % 4 == 1, "FULL").when(F.col("o_orderkey") % 4 == 2, "BACKWARD_TRANSITIVE").alias("level"))
    return A.compatibility_audit(fleet.unionByName(kinds), levels.where("level is not null").unionByName(full)).withColumn("problems", F.array_join("problems", "; "))


@query("""SELECT 'events.' || event_type AS topic, side, 'events.' || event_type || '-' || side AS subject, CASE WHEN side = 'key' OR event_type = 'click' THEN 'ok' WHEN event_type = 'view' THEN 'namespace' ELSE 'absent' END AS finding
FROM (SELECT DISTINCT event_type FROM events), (VALUES ('key'), ('value')) AS sides(side)""")
def topic_coverage(s, d):
    null = F.lit(None).cast("string")
    topics = event_log(s, d).select("topic").distinct().select("topic", F.lit("other").alias("namespace"), null.alias("value_subject"), null.alias("key_subject"))
    return A.topic_coverage(topics, schemas(s))


@query("""SELECT DISTINCT 'events.' || event_type AS topic, CASE WHEN event_type IN ('view', 'purchase') THEN 'first' WHEN event_type = 'error' THEN 'second' END AS "set" FROM events""")
def schema_sets(s, d):
    sets = s.createDataFrame([(1, r"^events\.(view|purchase)$", "first"), (2, r"^events\.[ep]", "second")], "ordinal int, pattern string, set string")
    return A.schema_sets(event_log(s, d).select("topic").distinct(), sets)


@query("""WITH m AS (SELECT l_orderkey AS subject, l_linenumber AS number, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(CASE WHEN l_partkey % 10 = 1 THEN 1 ELSE l_linenumber END AS INTEGER) END AS version, l_partkey FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL)),
w AS (SELECT *, coalesce(bool_or(version IS NULL) OVER p, false) AS pending, last_value(version IGNORE NULLS) OVER p AS prior FROM m WINDOW p AS (PARTITION BY subject ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT subject, CASE WHEN version IS NULL THEN 'lost' WHEN pending THEN 'out_of_order' ELSE 'order_differs' END AS kind, number, CAST(coalesce(version, number) AS INTEGER) AS version FROM w
WHERE version IS NULL OR pending OR version <= prior UNION ALL SELECT subject, 'undescribed', -1, 99 FROM (SELECT DISTINCT l_orderkey AS subject FROM lineitem WHERE l_orderkey % 7 = 0)""")
def drift(s, d):
    li = table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    fp = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey")
    held = F.when(F.col("l_partkey") % 10 == 1, 1).otherwise(F.col("l_linenumber"))
    migrations = li.select(F.col("l_orderkey").alias("subject"), F.col("l_linenumber").alias("number"), fp.alias("fingerprint"), F.col("l_linenumber").alias("recorded_version"))
    versions = li.where("l_partkey % 10 > 0").select(F.col("l_orderkey").alias("subject"), held.alias("version"), fp.alias("fingerprint"))
    extra = li.where("l_orderkey % 7 = 0").select(F.col("l_orderkey").alias("subject"), F.lit(99).alias("version"), F.lit("unknown").alias("fingerprint")).distinct()
    return A.drift(migrations, versions.unionByName(extra)).withColumn("number", F.coalesce("number", F.lit(-1)))


@query("""SELECT event_id, sha256('{"a":"' || event_type || '","k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}') AS fingerprint FROM events""")
def fingerprint(s, d):
    text = F.concat(F.lit('{ "k" :'), F.get_json_object("props", "$.k"), F.lit(',\r\n  "a": "'), "event_type", F.lit('"}'))
    return event_log(s, d).select("event_id", A.fingerprint(text, F.lit("JSON")).alias("fingerprint"))


@query("""SELECT sha256(props_) AS fingerprint, n, first_id FROM (SELECT '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS props_, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1) WHERE n > 1""")
def equal_schemas(s, d):
    return A.equal_schemas(event_log(s, d).select(F.col("event_id").alias("id"), F.col("props").alias("definition"), F.lit("JSON").alias("schema_type")))


@query("""WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, 'k' AS path, 'range' AS problem FROM e WHERE (k > 90 OR event_id % 17 = 0) AND event_id % 5 > 0
UNION ALL SELECT event_id, 'o.b', 'undeclared' FROM e WHERE event_id % 11 = 1 UNION ALL SELECT event_id, 'm', 'item' FROM e WHERE event_id % 11 = 2
UNION ALL SELECT event_id, 'big', 'range' FROM e WHERE event_id % 11 = 3 UNION ALL SELECT event_id, 'k', 'kind' FROM e WHERE event_id % 5 = 0
UNION ALL SELECT event_id, 'who', 'missing' FROM e WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'who', 'null' FROM e WHERE event_id % 3 = 1 UNION ALL SELECT event_id, 'who', 'enum' FROM e WHERE event_id % 3 = 2 AND event_id % 2 = 0
UNION ALL SELECT event_id, 'more', 'undeclared' FROM e WHERE event_id % 11 = 0""")
def payload_conformance(s, d):
    e = F.col("event_id")
    # 20 digits where the key is a multiple of 17; one above 2^53 + 1 as `big`.
    k = F.when(e % 17 == 0, "18446744073709551615").otherwise(F.get_json_object("props", "$.k"))
    more = F.when(e % 11 == 0, ',"more":1').when(e % 11 == 1, ',"o":{"a":1,"b":2}').when(e % 11 == 2, ',"m":{"x":1,"y":"no"}').when(e % 11 == 3, ',"big":9007199254740994').when(e % 11 == 4, ',"o":{"a":1},"m":{"x":1},"big":9007199254740993')
    body = F.concat(
        F.lit('{"k":'), F.when(e % 5 == 0, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k),
        F.when(e % 3 == 0, "").when(e % 3 == 1, ',"who":null').when(e % 2 == 0, ',"who":"nobody"').otherwise(',"who":"user"'), F.coalesce(more, F.lit("")), F.lit("}"))
    shape = [
        {"path": "k", "type": "int", "required": True, "max": 90}, {"path": "who", "type": "string", "required": True, "enum": ["user", "assistant"]},
        {"path": "o", "type": "object", "closed": True}, {"path": "o.a", "type": "int"}, {"path": "m", "type": "map", "values": "int"}, {"path": "big", "type": "int", "max": 9007199254740993},
    ]
    return A.payload_conformance(event_log(s, d).withColumn("value", body), shape, closed=True, ids=("event_id",))


@query("""SELECT conv_id, turn, 'role' AS path, 'enum' AS problem FROM conversations WHERE role NOT IN ('user', 'assistant')""")
def role_conformance(s, d):
    rows = table(s, d, "conversations").withColumn("value", F.to_json(F.struct("role")))
    return A.payload_conformance(rows, [{"path": "role", "type": "string", "required": True, "enum": ["user", "assistant"]}], ids=("conv_id", "turn"))


@query(f"""WITH {FRAMED} SELECT topic, coalesce(schema_id, -1) AS schema_id, count(*) AS n, min("offset") AS first_offset, max("offset") AS last_offset, coalesce(schema_id < 3, true) AS known FROM framed GROUP BY ALL""")
def usage_by_schema(s, d):
    return A.usage_by_schema(framed(s, d), schemas(s)).withColumn("schema_id", _NONE(F.col("schema_id")))
