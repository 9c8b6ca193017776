"""Schema and payload audits over registry exports: fields, compatibility, coverage, drift, conformance."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.operators import schema_types as T
from tidelog.operators.framing import _text, latest, record_names
from tidelog.sources.checkpoints import checkpoint

LEVELS = ("NONE", "BACKWARD", "BACKWARD_TRANSITIVE", "FORWARD", "FORWARD_TRANSITIVE", "FULL", "FULL_TRANSITIVE")

def _keyed(schemas: DataFrame) -> DataFrame:
    """Avro and JSON versions with the key of their definition, which equal definitions share."""
    text = F.coalesce("definition", F.lit(""))
    return schemas.where("schema_type in ('AVRO', 'JSON')").withColumns({"definition": text, "fp": F.unhex(F.sha2(F.concat("schema_type", F.lit(":"), text), 256))})


def _compiled(keyed: DataFrame, make: Callable[[bytes, list[dict]], list[dict]], schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows that `make` gives of each distinct definition's nodes; a definition is read once, however many
    versions and subjects have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for r in batch.to_pylist() for x in make(r["fp"], T.nodes_of(r["schema_type"], r["definition"]))]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return keyed.select("fp", "schema_type", "definition").distinct().mapInArrow(run, ddl)


_BODIES = pa.schema([("fp", pa.binary()), ("body", pa.string())])
_FIELDS = pa.schema([("fp", pa.binary()), ("path", pa.string()), ("type", pa.string()), ("nullable", pa.bool_()), ("has_default", pa.bool_()), ("symbols", pa.string())])


def schema_fields(schemas: DataFrame) -> DataFrame:
    """(subject, version, path, type, nullable, has_default, symbols) of every Avro and JSON version.

    Items of arrays and values of maps have the path `x[]` and `x{}`, what lies in a branch of a union
    `x|record Name`, in a branch of oneOf or anyOf `x<1>`. type: the types but null, joined by `|`, with
    named types, `$ref` and allOf followed; symbols: an enum's, sorted, joined by commas. has_default:
    of JSON properties whether they may be absent. A type is unfolded where it is first met, so a
    recursive one ends where it comes back; a definition that does not parse is one row of type
    `unparsable`."""
    keyed = _keyed(schemas)
    fields = _compiled(keyed, lambda fp, nodes: [{"fp": fp} | f for f in T.fields_of(nodes)], _FIELDS, "fp binary, path string, type string, nullable boolean, has_default boolean, symbols string")
    return keyed.select("subject", "version", "fp").join(fields, "fp").drop("fp")


#: Schema sets are written by hand; more than this are refused.
MOST_SETS = 10_000

#: Bytes of all compiled definitions that are broadcast; more are joined by a shuffle.
BROADCAST_DEFINITIONS = 8 << 20

#: Bytes of versions that one task sorts, and what a row has besides its subject. Rows are narrow and shrink
#: well in a shuffle, so a task that is cut by the bytes shuffled would hold many times as many.
TASK_BYTES, ROW_BYTES = 32 << 20, 128
_ROOT = ["reader", "writer", "root_r", "root_w"]
_MET = "reader binary, writer binary, root_r int, root_w int, problems array<string>, unknown array<string>, choices array<struct<text:string,pairs:array<struct<r:int,w:int>>>>"
_MET_ARROW = pa.schema([("reader", pa.binary()), ("writer", pa.binary()), ("root_r", pa.int32()), ("root_w", pa.int32()), ("problems", pa.list_(pa.string())), ("unknown", pa.list_(pa.string())), ("choices", pa.list_(pa.struct([("text", pa.string()), ("pairs", pa.list_(pa.struct([("r", pa.int32()), ("w", pa.int32())])))])))])


def _versions_to_compare(schemas: DataFrame, levels: DataFrame) -> DataFrame:
    """(subject, new_version, old_version, direction, reader, writer), the last two as definitions' keys."""
    v, levels = schemas.select("subject", "version", "fp"), levels.select("subject", "level")
    tasks = -(-(schemas.agg(F.sum(F.coalesce(F.octet_length("subject"), F.lit(0)) + ROW_BYTES)).first()[0] or 0) // TASK_BYTES)
    if tasks > (spark := schemas.sparkSession).sparkContext.defaultParallelism:
        tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))  # with fewer than these all would be shuffled again
        v, levels = v.repartition(tasks, "subject"), levels.repartition(tasks, "subject")
    v = v.join(levels, "subject", "left")
    v = v.withColumn("level", F.coalesce("level", F.lit("BACKWARD"))).where("level <> 'NONE'")
    every, w = F.col("level").endswith("_TRANSITIVE"), Window.partitionBy("subject").orderBy("version")
    latest_ = v.where(~every).withColumns({"old_version": F.lag("version").over(w), "old_fp": F.lag("fp").over(w)}).where("old_version is not null")
    earlier = v.where(every).select("subject", F.col("version").alias("old_version"), F.col("fp").alias("old_fp"))
    all_ = v.where(every).join(earlier, "subject").where("old_version < version")
    ways = F.when(F.col("level").startswith("FULL"), F.array(F.lit("backward"), F.lit("forward"))).when(F.col("level").startswith("FORWARD"), F.array(F.lit("forward"))).otherwise(F.array(F.lit("backward")))
    pairs = latest_.unionByName(all_).withColumn("direction", F.explode(ways))
    back = F.col("direction") == "backward"
    return pairs.select("subject", F.col("version").alias("new_version"), "old_version", "direction", F.when(back, F.col("fp")).otherwise(F.col("old_fp")).alias("reader"), F.when(back, F.col("old_fp")).otherwise(F.col("fp")).alias("writer"))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each root (a pair of nodes of two definitions) all that is said on the pairs it leads to. A pair
    is taken once, where it is first met, so recursive types end."""
    body = lru_cache(256)(json.loads)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            mine, theirs = body(row.pop("r_body")), body(row.pop("w_body"))
            said: dict = {"problem": [], "unknown": [], "any": []}
            todo, seen = [(row["root_r"], row["root_w"], "")], {(row["root_r"], row["root_w"])}
            for r, w, path in todo:
                for tag, *x in T.compare(mine[r], theirs[w] if w >= 0 else T.ANYTHING, (r, w), path):
                    if tag != "pair":
                        said[tag].append(x[0] if tag != "any" else {"text": x[0], "pairs": [{"r": a, "w": b} for a, b, _ in x[1]]})
                    elif (x[0], x[1]) not in seen:
                        seen.add((x[0], x[1]))
                        todo.append(tuple(x))
            out.append(row | {"problems": sorted(set(said["problem"])), "unknown": sorted(set(said["unknown"])), "choices": said["any"]})
        yield pa.RecordBatch.from_pylist(out, _MET_ARROW)


def _compared(roots: DataFrame, definitions: DataFrame) -> DataFrame:
    """What the comparison of these roots (reader, writer, root_r, root_w) says, and of all others that it
    hangs on: where a writer's branch may be read by one of several of the reader's, each of those pairs
    is a root of its own. Rounds are semi-naive: each takes the roots that the one before brought up
    and that are not done yet, so branches that come back to themselves end too."""
    size = definitions.agg(F.sum(F.length("body"))).first()[0] or 0
    definitions = F.broadcast(definitions) if size <= BROADCAST_DEFINITIONS else definitions
    side = lambda name: definitions.select(F.col("fp").alias(name), F.col("body").alias(f"{name[0]}_body"))
    todo, done = roots, None
    while True:
        out = checkpoint(todo.join(side("reader"), "reader").join(side("writer"), "writer").select(*_ROOT, "r_body", "w_body").mapInArrow(_meet, _MET))
        done = out if done is None else done.unionByName(out)
        if out.where(F.size("choices") > 0).limit(1).count() == 0:
            return done
        below = out.select("reader", "writer", F.explode(F.flatten("choices.pairs")).alias("x")).select("reader", "writer", F.col("x.r").alias("root_r"), F.col("x.w").alias("root_w")).distinct()
        todo = checkpoint(below.join(done.select(*_ROOT), _ROOT, "left_anti"))


def _settled(met: DataFrame) -> DataFrame:
    """(reader, writer, problems, unknown) of the whole definitions. Where one of several branches will do,
    the verdict hangs on those of other roots: all start as good and fall until nothing changes."""
    own = met.select(*_ROOT, "problems", "unknown")
    choices = met.select(*_ROOT, F.explode("choices").alias("x")).select(*_ROOT, "x.text", F.explode("x.pairs").alias("p")).select(*_ROOT, "text", F.col("p.r").alias("alt_r"), F.col("p.w").alias("alt_w")).distinct()
    if choices.limit(1).count():
        choices = checkpoint(choices)
        base = F.when(F.size("problems") > 0, 0).when(F.size("unknown") > 0, 1).otherwise(2)
        state = checkpoint(own.select(*_ROOT, base.alias("good")))
        total = -1
        while (now := state.agg(F.sum("good")).first()[0]) != total:
            total = now
            group = choices.join(state.select("reader", "writer", F.col("root_r").alias("alt_r"), F.col("root_w").alias("alt_w"), "good"), ["reader", "writer", "alt_r", "alt_w"]).groupBy(*_ROOT, "text").agg(F.max("good").alias("good"))
            worst = group.groupBy(*_ROOT).agg(F.min("good").alias("least"))
            state = checkpoint(state.join(worst, _ROOT, "left").select(*_ROOT, F.least("good", F.coalesce("least", F.lit(2))).alias("good")))
        pick = lambda n, c: F.collect_list(F.when(F.col("good") == n, F.col("text"))).alias(c)
        more = group.groupBy(*_ROOT).agg(pick(0, "failed"), pick(1, "unsure"))
        own = own.join(more, _ROOT, "left")
        with_ = lambda c, x: F.array_sort(F.array_distinct(F.concat(c, F.coalesce(x, F.array().cast("array<string>"))))).alias(c)
        own = own.select(*_ROOT, with_("problems", "failed"), with_("unknown", F.transform("unsure", lambda t: F.concat(t, F.lit(", for all that is compared")))))
    return own.where("root_r = 0 and root_w = 0").select("reader", "writer", "problems", "unknown")


def compatibility_audit(schemas: DataFrame, levels: DataFrame) -> DataFrame:
    """(subject, new_version, old_version, direction, ok, problems): each version against the earlier ones
    its subject's level names (the latest of them, or all where transitive; undeclared: BACKWARD; NONE:
    no rows). backward: the new schema reads what the old wrote; forward: the other way round. A
    resolution that fails for only some values fails. A definition that does not parse is a problem.

    Avro: every branch of a writer's union has to be read by some type of the reader, every symbol by
    the reader's enum unless that has a default; records match by unqualified name or alias, fields by
    name or alias, decimals by precision and scale. JSON: all that the writer's schema admits has to be
    admitted by the reader's: types, null, enum and const, ranges, multiples, lengths and counts,
    formats, required and undeclared properties, and each branch of its oneOf or anyOf by one of the
    reader's. Properties that the writer does not declare count as not written, unless the reader is
    closed. Whatever a schema says besides (`schema_types.COMPARED`), a reference that leads out of it
    and logical types that differ are not compared: `ok` is null then, and the problems name it, unless
    there is a problem for certain.

    Definitions are compiled and compared once, however many versions have them; a pair of types is
    compared once for a pair of definitions, and reported at its first path. A subject's versions are
    ordered in one task: a registry holds few of them."""
    keyed = _keyed(schemas)
    definitions = checkpoint(_compiled(keyed, lambda fp, nodes: [{"fp": fp, "body": json.dumps(nodes)}], _BODIES, "fp binary, body string"))
    pairs = checkpoint(_versions_to_compare(keyed, levels))
    roots = pairs.select("reader", "writer", F.lit(0).alias("root_r"), F.lit(0).alias("root_w")).distinct()
    verdicts = _settled(_compared(roots, definitions))
    sure = F.size("problems") > 0
    ok = F.when(sure, False).when(F.size("unknown") > 0, F.lit(None).cast("boolean")).otherwise(True)
    verdicts = checkpoint(verdicts.select("reader", "writer", ok.alias("ok"), F.when(sure, F.col("problems")).otherwise(F.col("unknown")).alias("problems")))
    # Many versions share few pairs of definitions, and a shuffle would bring all of a pair's into one task.
    size = verdicts.agg(F.sum(F.lit(ROW_BYTES) + F.coalesce(F.octet_length(F.array_join("problems", "")), F.lit(0)))).first()[0] or 0
    verdicts = F.broadcast(verdicts) if size <= BROADCAST_DEFINITIONS else verdicts
    return pairs.join(verdicts, ["reader", "writer"]).drop("reader", "writer")


def topic_coverage(topics: DataFrame, schemas: DataFrame) -> DataFrame:
    """(topic, side, subject, finding) for topics (topic, namespace, value_subject, key_subject), where a
    null subject is the topic's own. finding: ok, absent, or namespace where the newest schema declares
    no record of the topic's namespace. An absent key subject is ok unless it was named; JSON is checked
    for presence only; a key subject without records is ok."""
    side = lambda s, given: topics.select("topic", "namespace", F.lit(s).alias("side"), F.coalesce(given, F.concat("topic", F.lit(f"-{s}"))).alias("subject"), F.col(given).isNotNull().alias("named"))
    asked = side("value", "value_subject").unionByName(side("key", "key_subject"))
    newest = record_names(latest(schemas)).select("subject", "schema_type", "names")
    space = lambda n: F.when(n.contains("."), F.regexp_extract(n, r"^(.*)\.[^.]*$", 1)).otherwise("")
    inside = F.exists("names", lambda n: F.coalesce(space(n) == F.col("namespace"), F.lit(False)))
    absent = F.col("schema_type").isNull()
    optional = (F.col("side") == "key") & ~F.col("named")
    bare_key = (F.col("side") == "key") & (F.size(F.filter("names", lambda n: n.isNotNull())) == 0)
    finding = F.when(absent & optional, "ok").when(absent, "absent").when((F.col("schema_type") == "JSON") | bare_key | inside, "ok").otherwise("namespace")
    return asked.join(newest, "subject", "left").select("topic", "side", "subject", finding.alias("finding"))


def schema_sets(topics: DataFrame, sets: DataFrame) -> DataFrame:
    """(topic, set): the first set, by ordinal, whose pattern the topic matches; null: unchecked. The
    sets are a list written by hand: up to MOST_SETS are gathered in one row that goes to every topic;
    more is an error, as a pattern can only be tried against each topic."""
    if sets.limit(MOST_SETS + 1).count() > MOST_SETS:
        raise ValueError(f"more than {MOST_SETS} schema sets")
    known = sets.agg(F.array_sort(F.collect_list(F.struct("ordinal", "pattern", "set"))).alias("_sets"))
    rows = topics.select("topic").distinct().join(F.broadcast(known))
    first = F.expr("get(filter(_sets, s -> topic rlike s.pattern), 0)")
    return rows.select("topic", first["set"].alias("set"))


def drift(migrations: DataFrame, versions: DataFrame) -> DataFrame:
    """(subject, kind, number, version): registry versions (subject, version, fingerprint) against migrations
    (subject, number, fingerprint, recorded_version). kind: `undescribed` version; `lost`: recorded and no
    longer held; `out_of_order`: registered while an earlier one is not; `order_differs`: not above the
    version of the migration before it."""
    v = versions.groupBy("subject", "fingerprint").agg(F.min("version").alias("version"))
    both = migrations.join(v, ["subject", "fingerprint"], "left")
    w = Window.partitionBy("subject").orderBy("number")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumns({"pending": F.coalesce(F.bool_or(F.col("version").isNull()).over(before), F.lit(False)), "last": F.last("version", ignorenulls=True).over(before)})
    kind = F.when(F.col("version").isNull() & F.col("recorded_version").isNotNull(), "lost").when(F.col("version").isNotNull() & F.col("pending"), "out_of_order").when(F.col("version") <= F.col("last"), "order_differs")
    of_migrations = both.withColumn("kind", kind).where("kind is not null").select("subject", "kind", "number", F.coalesce("version", "recorded_version").alias("version"))
    unknown = versions.join(migrations.select("subject", "fingerprint"), ["subject", "fingerprint"], "left_anti")
    return of_migrations.unionByName(unknown.select("subject", F.lit("undescribed").alias("kind"), F.lit(None).cast(migrations.schema["number"].dataType).alias("number"), "version"))


def fingerprint(definition, schema_type) -> Column:
    """SHA-256 of the normalized text: LF line ends; AVRO and JSON minified with sorted keys."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    text = F.replace(c(definition), F.lit("\r\n"), F.lit("\n"))
    plain = F.when(c(schema_type).isin("AVRO", "JSON"), F.coalesce(F.to_json(F.try_parse_json(text)), text)).otherwise(text)
    return F.sha2(plain, 256)


def equal_schemas(schemas: DataFrame) -> DataFrame:
    """(fingerprint, n, first_id): schemas registered more than once."""
    return schemas.groupBy(fingerprint("definition", "schema_type").alias("fingerprint")).agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


def payload_conformance(df: DataFrame, shape: list[dict], closed: bool = False, value: str = "value", ids: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """(ids, path, problem): a row for each violation of a declared shape.

    shape: dicts with path (top-level or dotted), type (int, number, string, bool, array, object, map),
    required, nullable, min, max, enum, closed. Problems: not_json, missing, null, kind, range, enum,
    item and, where the object is closed, undeclared: `closed` is for the document, a shape's own for
    the object at its path. For an array `items` names the type of its items, for a map `values` that of
    its values. Integers are whole numbers up to 20 digits and bounds compare as decimals, so that
    neither loses digits.
    """
    doc = df.withColumn("_v", F.try_parse_json(F.col(value).cast("string")))
    kinds = {"number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "string": ("STRING",), "bool": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",), "map": ("OBJECT",)}
    no = F.lit(None).cast("string")

    def is_kind(v: Column, kind: str) -> Column:
        said = F.schema_of_variant(v)
        if kind == "int":
            return (said == "BIGINT") | F.coalesce(said.rlike(r"^DECIMAL\(\d+,0\)$") & F.try_variant_get(v, "$", "decimal(20,0)").isNotNull(), F.lit(False))
        return reduce(lambda a, b: a | b, [said.startswith(k) for k in kinds[kind]])

    def beyond(v: Column, low, high) -> Column:
        """As decimals where the number is one of 38 digits, else as doubles."""
        exact, rough = F.try_variant_get(v, "$", "decimal(38,6)"), F.try_variant_get(v, "$", "double")
        out = F.lit(False)
        for bound, below in ((low, True), (high, False)):
            if bound is not None:
                held = F.lit(str(bound)).cast("decimal(38,6)")
                out = out | F.coalesce(exact < held if below else exact > held, rough < float(bound) if below else rough > float(bound))
        return out

    def keys(path: str) -> Column:
        text = F.col(value).cast("string")
        return F.coalesce(F.json_object_keys(F.get_json_object(text, f"$.{path}") if path else text), F.array().cast("array<string>"))

    found = [F.when(F.col("_v").isNull(), F.struct(F.lit("$").alias("path"), F.lit("not_json").alias("problem")))]
    lists = []
    for s in shape:
        v = F.try_variant_get("_v", f"$.{s['path']}", "variant")
        bad = F.when(v.isNull(), F.lit("missing") if s.get("required") else no).when(F.is_variant_null(v), no if s.get("nullable") else F.lit("null")).when(~is_kind(v, s["type"]), "kind")
        if "min" in s or "max" in s:
            bad = bad.when(beyond(v, s.get("min"), s.get("max")), "range")
        if "enum" in s:
            bad = bad.when(~_text(v, "$").isin(s["enum"]), "enum")
        parts = {"items": lambda v: F.try_variant_get(v, "$", "array<variant>"), "values": lambda v: F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))}
        for name, of in parts.items():
            if name in s:
                bad = bad.when(_some_bad(of(v), is_kind, s[name]), "item")
        found.append(F.when(F.col("_v").isNotNull() & bad.isNotNull(), F.struct(F.lit(s["path"]).alias("path"), bad.alias("problem"))))
    objects = ([""] if closed else []) + [s["path"] for s in shape if s.get("closed")]
    for path in objects:
        lead = f"{path}." if path else ""
        names = {s["path"][len(lead) :].split(".")[0] for s in shape if s["path"].startswith(lead) and s["path"] != path}
        extra = F.filter(keys(path), _outside(sorted(names)))
        lists.append(F.transform(extra, _undeclared(lead)))
    all_ = F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), *lists)
    return doc.select(*ids, F.explode(all_).alias("x")).select(*ids, "x.path", "x.problem")


def _some_bad(values: Column, is_kind, kind: str) -> Column:
    return F.exists(values, lambda x: F.is_variant_null(x) | ~is_kind(x, kind))


def _outside(names: list[str]):
    return lambda k: ~k.isin(names) if names else F.lit(True)


def _undeclared(lead: str):
    return lambda k: F.struct(F.concat(F.lit(lead), k).alias("path"), F.lit("undeclared").alias("problem"))


def usage_by_schema(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """(topic, schema_id, n, first_offset, last_offset, known): framed records by schema id (null:
    unframed, which is known)."""
    use = df.groupBy("topic", R.envelope_id("value").alias("schema_id")).agg(F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    ids = schemas.select(F.col("id").cast("bigint").alias("schema_id"), F.lit(True).alias("held")).distinct()
    return use.join(ids, "schema_id", "left").select("topic", "schema_id", "n", "first_offset", "last_offset", (F.coalesce("held", F.lit(False)) | F.col("schema_id").isNull()).alias("known"))
