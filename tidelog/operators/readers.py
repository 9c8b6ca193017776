"""Readers made from a registry's definitions: Spark types with defaults, and decoding by what a batch holds."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.framing import fanin_versions, split_envelope

#: Types of the two formats that have one Spark type.
AVRO = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(), "enum": T.StringType(), "fixed": T.BinaryType()}
JSON = {"boolean": T.BooleanType(), "integer": T.LongType(), "number": T.DoubleType(), "string": T.StringType()}
#: Versions that one batch may hold; each is a branch of the plan.
MOST_VERSIONS = 500


class NoSuchType(ValueError):
    """A definition that has no Spark type."""


def _field(name: str, kind: T.DataType, nullable: bool, owner: dict, key: str = "default") -> T.StructField:
    return T.StructField(name, kind, nullable, {"default": owner[key]} if owner.get(key) is not None else {"default": None} if key in owner else None)


def _avro(t, named: dict, space: str, inside: tuple) -> tuple[T.DataType, bool]:
    """(type, nullable) of an Avro type. A union is one type or null; a record inside itself has no type."""
    if isinstance(t, list):
        kinds = [b for b in t if b != "null"]
        if len(kinds) != 1:
            raise NoSuchType(f"a union of {len(kinds)} types")
        return _avro(kinds[0], named, space, inside)[0], "null" in t
    if isinstance(t, str):
        if t in AVRO and t not in ("enum", "fixed"):
            return AVRO[t], False
        own = named.get(t if "." in t or not space else f"{space}.{t}") or named.get(t)
        if own is None:
            raise NoSuchType(f"type {t}, which is defined elsewhere")
        return _avro(own, named, space, inside)
    kind = t.get("type")
    if kind in ("record", "enum", "fixed"):
        name = t["name"] if "." in t["name"] or not t.get("namespace", space) else f"{t.get('namespace', space)}.{t['name']}"
        named[name] = t
        if kind != "record":
            return AVRO[kind], False
        if name in inside:
            raise NoSuchType(f"record {name} inside itself")
        below = name.rpartition(".")[0]
        fields = []
        for f in t["fields"]:
            own, nullable = _avro(f["type"], named, below, (*inside, name))
            fields.append(_field(f["name"], own, nullable, f))
        return T.StructType(fields), False
    if kind == "array":
        own, nullable = _avro(t["items"], named, space, inside)
        return T.ArrayType(own, nullable), False
    if kind == "map":
        own, nullable = _avro(t["values"], named, space, inside)
        return T.MapType(T.StringType(), own, nullable), False
    return _avro(kind, named, space, inside)


def _json(s, doc: dict, inside: tuple) -> tuple[T.DataType, bool]:
    """(type, nullable) of a JSON Schema: a `$ref` within it is followed, oneOf and anyOf are one type or null."""
    if not isinstance(s, dict):
        raise NoSuchType("a schema of any value")
    if "$ref" in s:
        ref = s["$ref"]
        if not ref.startswith("#/") or ref in inside:
            raise NoSuchType(f"$ref {ref}")
        to = doc
        for part in ref[2:].split("/"):
            to = to.get(part.replace("~1", "/").replace("~0", "~")) if isinstance(to, dict) else None
        return _json(to, doc, (*inside, ref))
    for choice in ("oneOf", "anyOf"):
        if choice in s:
            kinds = [b for b in s[choice] if b != {"type": "null"}]
            if len(kinds) != 1:
                raise NoSuchType(f"{choice} of {len(kinds)} types")
            return _json(kinds[0], doc, inside)[0], len(kinds) < len(s[choice])
    types = s.get("type", "object" if "properties" in s else "string" if "enum" in s else None)
    types = types if isinstance(types, list) else [types]
    kinds, nullable = [t for t in types if t != "null"], "null" in types
    if len(kinds) != 1:
        raise NoSuchType("a schema of no or several types")
    if kinds[0] in JSON:
        return JSON[kinds[0]], nullable
    if kinds[0] == "array":
        own, some = _json(s.get("items"), doc, inside)
        return T.ArrayType(own, some), nullable
    if kinds[0] == "object" and "properties" not in s and isinstance(s.get("additionalProperties"), dict):
        own, some = _json(s["additionalProperties"], doc, inside)
        return T.MapType(T.StringType(), own, some), nullable
    if kinds[0] == "object":
        fields = []
        for name, child in s.get("properties", {}).items():
            own, some = _json(child, doc, inside)
            # What may be left out is null where it is.
            fields.append(_field(name, own, some or name not in s.get("required", []), child))
        return T.StructType(fields), nullable
    raise NoSuchType(f"type {kinds[0]}")


def spark_type(definition: str, schema_type: str) -> T.StructType:
    """The Spark type of a definition's values, with nullability and, in the fields' metadata, defaults;
    NoSuchType where it has none: unions of several types, recursive ones, and what is no record."""
    try:
        doc = json.loads(definition)
        kind, _ = _json(doc, doc, ()) if schema_type == "JSON" else _avro(doc, {}, "", ())
    except (ValueError, TypeError, KeyError, AttributeError) as e:
        if isinstance(e, NoSuchType):
            raise
        raise NoSuchType("a definition that does not parse") from e
    if not isinstance(kind, T.StructType):
        raise NoSuchType("a definition that is no record")
    return kind


def fanin_registered(df: DataFrame, schemas: DataFrame, reader: int | T.StructType, value: str = "value") -> DataFrame:
    """Batch: framed JSON values of any writer versions decoded each with its own definition, and read onto
    the reader's (a schema id, or a type). Adds schema_id, evolved and failure, as fanin_versions; a
    definition that has no Spark type fails its rows with `unreadable: ...`.

    The writers are what the rows' ids are found to be, so only the registry's table is given. The ids of
    a batch and their definitions reach the driver, MOST_VERSIONS at most."""
    ids = split_envelope(df, value).where("framed").select("schema_id").distinct()
    known = schemas.select(F.col("id").cast("bigint").alias("schema_id"), "schema_type", "definition").where("schema_type in ('AVRO', 'JSON')")
    found = {r.schema_id: r for r in known.join(ids, "schema_id", "left_semi").limit(MOST_VERSIONS + 1).collect()}
    if len(found) > MOST_VERSIONS:
        raise ValueError(f"more than {MOST_VERSIONS} versions in one batch")
    if isinstance(reader, int):
        own = known.where(F.col("schema_id") == reader).first()
        if own is None:
            raise ValueError(f"no schema {reader} in the registry")
        reader = spark_type(own.definition, own.schema_type)
    writers, unreadable = {}, {}
    for key, r in sorted(found.items()):
        try:
            writers[key] = spark_type(r.definition, r.schema_type)
        except NoSuchType as e:
            unreadable[key] = f"unreadable: {e}"
    out = fanin_versions(df, writers, reader, value)
    for key, why in unreadable.items():
        out = out.withColumn("failure", F.when(F.col("schema_id") == key, why).otherwise(F.col("failure")))
    return out


def fanin_stream(stream: DataFrame, schemas: Callable[[], DataFrame], reader: int | T.StructType, checkpoint: str, handle: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """The same on a stream: each micro-batch is decoded with the registry as it is then, so a version that
    is registered later is read when it comes. `handle` gets the decoded batch and its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            handle(fanin_registered(batch, schemas(), reader), batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
