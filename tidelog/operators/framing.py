"""Framed payloads: schema resolution, decoding, routing and evolution.

The registry is a table schemas(id, subject, version, schema_type, definition), exported once a job (or
micro-batch) and joined by id; Spark broadcasts it by its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import records as R

NAMING = ("topic_name", "record_name", "topic_record_name")


def split_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds framed, schema_id and datum."""
    return df.withColumns({"framed": R.is_framed(value), "schema_id": R.envelope_id(value), "datum": R.envelope_datum(value)})


def resolve_schema(df: DataFrame, schemas: DataFrame, lenient: bool = False) -> DataFrame:
    """Adds framed, schema_id, datum, subject, version, schema_type, definition and failure: in strict mode
    `unframed` or `unknown_id`; in lenient mode such payloads pass with a null schema."""
    s = schemas.select(F.col("id").cast("bigint").alias("schema_id"), "subject", "version", "schema_type", "definition")
    out = split_envelope(df).join(s, "schema_id", "left")
    failure = F.when(~F.col("framed"), "unframed").when(F.col("subject").isNull(), "unknown_id")
    return out.withColumn("failure", F.lit(None).cast("string") if lenient else failure)


_CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _marking(schema: T.StructType) -> T.StructType:
    """The schema with a column for the text of a record that doesn't parse."""
    return T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])


def decode_json(df: DataFrame, schema: str | T.StructType, mode: str, value: str = "value") -> DataFrame:
    """Adds decoded and failure. mode `strict` refuses an unframed payload, `plain` reads bare JSON, and
    `lenient` reads either. A bad payload is a failure, not an exception."""
    if mode not in ("strict", "plain", "lenient"):
        raise ValueError(f"unknown mode {mode!r}")
    framed = R.is_framed(value)
    datum = F.when(framed, R.envelope_datum(value)) if mode == "strict" else F.col(value) if mode == "plain" else F.coalesce(R.envelope_datum(value), F.col(value))
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = df.withColumn("_p", F.from_json(datum.cast("string"), _marking(schema), _CORRUPT))
    bad = F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
    failure = F.when(~framed, "unframed") if mode == "strict" else F.when(F.lit(False), "")
    failure = failure.when(bad, "bad_json")
    good = F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])
    return out.withColumn("failure", failure).withColumn("decoded", F.when(F.col("failure").isNull(), good)).drop("_p")


def to_plain_json(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds plain: the JSON of a framed JSON payload. Anything else passes through as it is, with `passed`
    saying why: unframed, unknown_id, not_convertible (other flavors need Spark's optional packages)."""
    r = resolve_schema(df, schemas, lenient=True)
    why = F.when(~F.col("framed"), "unframed").when(F.col("schema_type").isNull(), "unknown_id").when(F.col("schema_type") != "JSON", "not_convertible")
    return r.withColumn("passed", why).withColumn("plain", F.when(F.col("passed").isNull(), F.col("datum")).otherwise(F.col("value")))


def subject_name(strategy: str, topic="topic", record="record", pin=None) -> Column:
    """The subject of a topic's values under a naming strategy; a pinned subject wins."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    if strategy not in NAMING:
        raise ValueError(f"unknown naming strategy {strategy!r}")
    name = {"topic_name": lambda: F.concat(c(topic), F.lit("-value")), "record_name": lambda: c(record), "topic_record_name": lambda: F.concat(c(topic), F.lit("-"), c(record))}[strategy]()
    return F.coalesce(c(pin), name) if pin is not None else name


def latest(schemas: DataFrame) -> DataFrame:
    """(subject, id, version, schema_type, definition) of each subject's newest version."""
    best = schemas.groupBy("subject").agg(F.max(F.struct("version", "id", "schema_type", "definition")).alias("s"))
    return best.select("subject", "s.id", "s.version", "s.schema_type", "s.definition")


def frame_by_subject(df: DataFrame, schemas: DataFrame, subject: Column) -> DataFrame:
    """Frames outgoing values with the id of their subject's newest version; without one they stay as they
    are. Adds subject and schema_id."""
    newest = latest(schemas).select("subject", F.col("id").alias("schema_id"))
    out = df.withColumn("subject", subject).join(newest, "subject", "left")
    return out.withColumn("value", F.when(F.col("schema_id").isNull(), F.col("value")).otherwise(R.add_envelope("schema_id", "value")))


def missing_subject(used: DataFrame, schemas: DataFrame, policy: str = "refuse") -> DataFrame:
    """What happens to used subjects (subject, definition) that the registry lacks: (subject, action, id).
    refuse: action `refused`; auto_register: `registered` with the next free ids in subject order;
    publish_unframed: `unframed`."""
    if policy not in ("refuse", "auto_register", "publish_unframed"):
        raise ValueError(f"unknown policy {policy!r}")
    absent = used.select("subject").distinct().join(schemas.select("subject").distinct(), "subject", "left_anti")
    if policy != "auto_register":
        return absent.select("subject", F.lit("refused" if policy == "refuse" else "unframed").alias("action"), F.lit(None).cast("bigint").alias("id"))
    from tidelog.sources.logs import number_rows

    top = schemas.agg(F.coalesce(F.max("id").cast("bigint"), F.lit(0)).alias("top"))
    return number_rows(absent, [], ["subject"], "_n").join(F.broadcast(top)).select("subject", F.lit("registered").alias("action"), (F.col("top") + 1 + F.col("_n")).alias("id"))


def frame_once(df: DataFrame, schemas: DataFrame, subject: Column, flavor: str) -> DataFrame:
    """Frames only unframed values of a subject of the expected flavor; else `passed` says why not:
    already_framed, no_subject, other_flavor."""
    newest = latest(schemas).select("subject", F.col("id").alias("schema_id"), "schema_type")
    out = df.withColumn("subject", subject).join(newest, "subject", "left")
    why = F.when(R.is_framed("value"), "already_framed").when(F.col("schema_id").isNull(), "no_subject").when(F.col("schema_type") != flavor, "other_flavor")
    return out.withColumn("passed", why).withColumn("value", F.when(F.col("passed").isNull(), R.add_envelope("schema_id", "value")).otherwise(F.col("value")))


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def full_name(v: Column) -> Column:
    """Full name of a named Avro type: its name if that has a dot, else namespace and name."""
    name, space = _text(v, "$.name"), _text(v, "$.namespace")
    return F.when(name.contains(".") | space.isNull() | (space == ""), name).otherwise(F.concat(space, F.lit("."), name))


def record_names(schemas: DataFrame) -> DataFrame:
    """Adds names ARRAY<STRING>: of an Avro record its full name, of a union one for each branch (null for
    branches that are no record), of JSON its title, else empty."""
    v = F.try_parse_json("definition")
    branches = F.try_variant_get(v, "$", "array<variant>")
    record = lambda b: F.when(_text(b, "$.type") == "record", full_name(b))
    avro = F.when(branches.isNotNull(), F.transform(branches, record)).when(_text(v, "$.type") == "record", F.array(record(v)))
    title = _text(v, "$.title")
    names = F.when(F.col("schema_type") == "AVRO", avro).when((F.col("schema_type") == "JSON") & title.isNotNull(), F.array(title))
    return schemas.withColumn("is_union", (F.col("schema_type") == "AVRO") & branches.isNotNull()).withColumn("names", F.coalesce(names, F.array().cast("array<string>")))


def branch_profile(df: DataFrame, datum: str = "datum") -> DataFrame:
    """(topic, branch, n) of union payloads; branch is null where the index is truncated or negative."""
    return df.groupBy("topic", R.union_branch(datum).alias("branch")).agg(F.count("*").alias("n"))


def split_by_record(df: DataFrame, schemas: DataFrame, wanted: list[str]) -> DataFrame:
    """Adds record: which wanted record a framed value holds, null for a decode failure. Avro names match
    exactly; a JSON title without a dot matches a wanted name's last part."""
    named = record_names(schemas).select(F.col("id").cast("bigint").alias("schema_id"), "schema_type", "is_union", "names")
    out = split_envelope(df).join(named, "schema_id", "left")
    branch = R.union_branch("datum")
    said = F.when(F.col("is_union"), F.get("names", branch.cast("int"))).otherwise(F.get("names", F.lit(0)))
    match = F.lit(None).cast("string")
    for w in reversed(wanted):
        exact = said == w
        loose = (F.col("schema_type") == "JSON") & ~said.contains(".") & (said == w.split(".")[-1])
        match = F.when(exact | loose, F.lit(w)).otherwise(match)
    return out.withColumn("record", match).drop("is_union", "names", "schema_type")


def route_by_message(df: DataFrame, paths: dict[str, list[int]], datum: str = "datum") -> DataFrame:
    """Adds message_type (null where the path is truncated or in no route), path and message."""
    out = df.withColumn("_m", R.message_path(datum)).withColumns({"path": F.col("_m.path"), "message": F.col("_m.message")}).drop("_m")
    kind = F.lit(None).cast("string")
    for name, path in paths.items():
        kind = F.when(F.col("path") == F.array(*[F.lit(p) for p in path]), F.lit(name)).otherwise(kind)
    return out.withColumn("message_type", kind)


# ---- evolution ----

_WIDER = {
    T.IntegerType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.LongType, T.FloatType, T.DoubleType),
    T.FloatType: (T.FloatType, T.DoubleType),
    T.StringType: (T.StringType, T.BinaryType),
    T.BinaryType: (T.BinaryType, T.StringType),
}


def _onto(col: Column, writer: T.DataType, reader: T.DataType, path: str) -> tuple[Column, list[Column], list[str]]:
    """(value, row conditions that fail, failures of the schemas themselves)."""
    if isinstance(reader, T.StructType) and isinstance(writer, T.StructType):
        has = {f.name: f for f in writer.fields}
        parts, rows, flaws = [], [], []
        for f in reader.fields:
            here = f"{path}.{f.name}" if path else f.name
            if f.name in has:
                v, r, s = _onto(col[f.name], has[f.name].dataType, f.dataType, here)
                rows += [col.isNotNull() & x for x in r]
                flaws += s
                if not f.nullable:
                    rows.append(col.isNotNull() & col[f.name].isNull())
            elif "default" in (f.metadata or {}):
                v = F.lit(f.metadata["default"]).cast(f.dataType)
            else:
                v = F.lit(None).cast(f.dataType)
                flaws.append(f"{here}: no such field in the writer and no default")
            parts.append(v.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*parts)), rows, flaws
    if isinstance(reader, T.ArrayType) and isinstance(writer, T.ArrayType):
        _, r, s = _onto(F.lit(None).cast(writer.elementType), writer.elementType, reader.elementType, f"{path}[]")
        inner = lambda x: _onto(x, writer.elementType, reader.elementType, f"{path}[]")
        rows = [F.exists(col, lambda x: F.coalesce(_any(inner(x)[1]), F.lit(False)))] if r else []
        if not reader.containsNull:
            rows.append(F.exists(col, lambda x: x.isNull()))
        return F.transform(col, lambda x: inner(x)[0]), rows, s
    if isinstance(reader, T.MapType) and isinstance(writer, T.MapType):
        _, r, s = _onto(F.lit(None).cast(writer.valueType), writer.valueType, reader.valueType, f"{path}{{}}")
        inner = lambda x: _onto(x, writer.valueType, reader.valueType, f"{path}{{}}")
        values = F.map_values(col)
        rows = [F.exists(values, lambda x: F.coalesce(_any(inner(x)[1]), F.lit(False)))] if r else []
        if not reader.valueContainsNull:
            rows.append(F.exists(values, lambda x: x.isNull()))
        return F.transform_values(col, lambda k, x: inner(x)[0]), rows, s
    if type(reader) in _WIDER.get(type(writer), (type(writer),)):
        return col.cast(reader), [], []
    return F.lit(None).cast(reader), [], [f"{path}: {writer.simpleString()} is not read as {reader.simpleString()}"]


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def evolve_onto(df: DataFrame, column: str, reader: T.StructType, writer: T.StructType | None = None) -> DataFrame:
    """Reads a struct column written under one schema onto a reader schema: adds evolved and failure.

    Numbers widen, string and bytes read each other, a field the writer lacks takes the reader's default
    (its field metadata), a field the reader lacks is ignored. A missing default or an unreadable type
    fails every row; a null for a field that is not nullable fails that row.
    """
    writer = writer or df.schema[column].dataType
    value, rows, flaws = _onto(F.col(column), writer, reader, "")
    if flaws:
        return df.withColumn("failure", F.lit("; ".join(flaws))).withColumn("evolved", F.lit(None).cast(reader))
    out = df.withColumn("failure", F.when(_any(rows), "null for a field that is not nullable"))
    return out.withColumn("evolved", F.when(F.col("failure").isNull(), value))


def fanin_versions(df: DataFrame, writers: dict[int, T.StructType], reader: T.StructType, value: str = "value") -> DataFrame:
    """One topic with several writer versions: each framed JSON value decoded with its own schema and read
    onto the reader's. Adds schema_id, evolved and failure: unframed, unknown_id, bad_json or what
    evolve_onto says. One pass: each row takes its id's branch."""
    out = split_envelope(df, value)
    evolved, failure = F.lit(None).cast(reader), F.when(F.col("framed"), "unknown_id").otherwise("unframed")
    for n, (key, schema) in enumerate(writers.items()):
        parsed = f"_w{n}"
        mine = F.col("schema_id") == key
        out = out.withColumn(parsed, F.from_json(F.when(mine, F.col("datum").cast("string")), _marking(schema), _CORRUPT))
        v, rows, flaws = _onto(F.col(parsed), schema, reader, "")
        broken = F.col(parsed).isNull() | F.col(f"{parsed}._corrupt").isNotNull()
        bad = F.lit("; ".join(flaws)) if flaws else F.when(broken, "bad_json").when(_any(rows), "null for a field that is not nullable")
        failure = F.when(mine, bad).otherwise(failure)
        evolved = F.when(mine & bad.isNull(), v).otherwise(evolved)
    return out.withColumn("failure", failure).withColumn("evolved", evolved).drop(*[f"_w{n}" for n in range(len(writers))], "framed", "datum")
