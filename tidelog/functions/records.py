"""Column expressions over log records: headers, sizes, names, lanes and binary framing.

Headers are ARRAY<STRUCT<key STRING, value BINARY>>; a column argument may be a name or a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header names of the record format.
KEY_HEADER = "kafka-partition-key"
SOURCE_HEADER = "kafka-eos-source"
RETRY_HEADER = "retry-count"
HEADERS = "array<struct<key:string,value:binary>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def header(key: str, value) -> Column:
    return F.struct(F.lit(key).alias("key"), _c(value).cast("binary").alias("value"))


def no_headers() -> Column:
    return F.array().cast(HEADERS)


def without_headers(headers, *names: str) -> Column:
    """The headers but those of these names, in any case."""
    return F.filter(F.coalesce(_c(headers), no_headers()), lambda h: ~F.lower(h["key"]).isin([n.lower() for n in names]))


def header_bytes(headers, name: str) -> Column:
    """Value of the first header of exactly this name; null where there is none."""
    return F.get(F.filter(F.coalesce(_c(headers), no_headers()), lambda h: h["key"] == name), F.lit(0))["value"]


def header_value(headers, name: str) -> Column:
    """The header as text; null where it is missing (a decode failure where a contract needs it)."""
    return header_bytes(headers, name).cast("string")


def normalize_headers(headers, key) -> Column:
    """Headers as a handler sees them: a foreign partition-key header goes, a null value is empty, and
    the record's own key, if it has one, comes as the partition-key header."""
    own = F.transform(without_headers(headers, KEY_HEADER), lambda h: F.struct(h["key"].alias("key"), F.coalesce(h["value"], F.lit(b"")).alias("value")))
    return F.when(_c(key).isNull(), own).otherwise(F.concat(own, F.array(header(KEY_HEADER, key))))


def wire_key(headers) -> Column:
    """The native key of an outgoing record: its partition-key header."""
    return F.get(F.filter(F.coalesce(_c(headers), no_headers()), lambda h: F.lower(h["key"]) == KEY_HEADER), F.lit(0))["value"]


def wire_headers(headers) -> Column:
    """What of the outgoing headers rides the wire: not the key and not the exactly-once source."""
    return without_headers(headers, KEY_HEADER, SOURCE_HEADER)


def lane_key(mode: str, partition="partition", key="key") -> Column:
    """The lane that a record runs in: its partition in decimal text, or its key (null: no lane)."""
    if mode not in ("partition", "record_key"):
        raise ValueError(f"unknown lane mode {mode!r}")
    return _c(partition).cast("string").cast("binary") if mode == "partition" else _c(key).cast("binary")


def legal_topic(topic) -> Column:
    """1 to 249 characters of [a-zA-Z0-9._-], and neither `.` nor `..`."""
    return F.coalesce(_c(topic).rlike(r"\A[a-zA-Z0-9._-]{1,249}\z") & ~_c(topic).isin(".", ".."), F.lit(False))


def varint_width(n) -> Column:
    """Bytes of a zig-zag varint of a length: 1 up to 63, then 7 bits a byte."""
    n = _c(n)
    return F.when(n < 1 << 6, 1).when(n < 1 << 13, 2).when(n < 1 << 20, 3).when(n < 1 << 27, 4).otherwise(5)


def record_size(key="key", value="value", headers="headers") -> Column:
    """Size of a record as the broker's limit counts it: 36, key, payload, and for each header its name
    and value with their varint lengths."""
    size = lambda x: F.coalesce(F.octet_length(x), F.lit(0))
    each = F.transform(F.coalesce(_c(headers), no_headers()), lambda h: size(h["key"]) + varint_width(size(h["key"])) + size(h["value"]) + varint_width(size(h["value"])))
    return (36 + size(_c(key)) + size(_c(value)) + F.aggregate(each, F.lit(0), lambda a, x: a + x)).cast("bigint")


def source_text(topic="topic", partition="partition", offset="offset") -> Column:
    return F.concat_ws(":", _c(partition), _c(offset), _c(topic))


def parse_source(text) -> Column:
    """STRUCT<topic, partition, offset> of `partition:offset:topic`; the topic may hold colons."""
    part = F.split(_c(text), ":", 3)
    ok = F.size(part) == 3
    return F.when(ok, F.struct(F.get(part, F.lit(2)).alias("topic"), F.get(part, F.lit(0)).try_cast("int").alias("partition"), F.get(part, F.lit(1)).try_cast("bigint").alias("offset")))


# ---- envelope: magic byte 0, big-endian schema id, datum ----


def is_framed(value) -> Column:
    v = _c(value)
    return F.coalesce((F.octet_length(v) >= 5) & (F.substring(v, 1, 1) == F.lit(b"\x00")), F.lit(False))


def envelope_id(value) -> Column:
    return F.when(is_framed(value), F.conv(F.hex(F.substring(_c(value), 2, 4)), 16, 10).cast("bigint"))


def envelope_datum(value) -> Column:
    v = _c(value)
    return F.when(is_framed(value), v.substr(F.lit(6), F.octet_length(v)))


def add_envelope(schema_id, datum) -> Column:
    return F.concat(F.lit(b"\x00"), F.unhex(F.lpad(F.hex(_c(schema_id).cast("bigint")), 8, "0")), _c(datum).cast("binary"))


def byte_at(data, pos) -> Column:
    """The unsigned byte at a 1-based position; null past the end."""
    return F.conv(F.hex(_c(data).substr(pos, F.lit(1))), 16, 10).cast("bigint")


def _once(x, use) -> Column:
    """use(x), with x evaluated once: within a lambda each mention of a column is evaluated again."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def read_zigzag(data, start=1) -> Column:
    """STRUCT<value BIGINT, next INT> of the zig-zag varint at a 1-based position, null where it is
    truncated or longer than ten bytes. Bits past 64 fall away."""
    data, start = _c(data), start if isinstance(start, Column) else F.lit(start)
    seed = F.struct(F.lit(0).cast("bigint").alias("v"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(acc, i):
        more = lambda b: F.struct((acc["v"].bitwiseOR(F.call_function("shiftleft", b.bitwiseAND(F.lit(127).cast("bigint")), i * 7))).alias("v"), (acc["n"] + 1).alias("n"), (b < 128).alias("done"))
        return F.when(acc["done"] | (acc["n"] < i), acc).otherwise(_once(byte_at(data, start + i), lambda b: F.when(b.isNull(), acc).otherwise(more(b))))

    def finish(out):
        value = F.call_function("shiftrightunsigned", out["v"], F.lit(1)).bitwiseXOR(-(out["v"].bitwiseAND(F.lit(1).cast("bigint"))))
        return F.when(out["done"], F.struct(value.alias("value"), (start + out["n"]).cast("int").alias("next")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(9)), seed, step, finish)


def union_branch(datum) -> Column:
    """Branch index that heads the datum of a union; null where it is truncated or negative."""
    v = read_zigzag(datum)["value"]
    return F.when(v >= 0, v)


def message_path(datum) -> Column:
    """STRUCT<path ARRAY<INT>, message BINARY> of a message-index path and what follows it; a count of
    0 means [0]; null where the path is truncated or its count is negative. Each step takes a byte at
    least, so a count beyond the datum's bytes is known to be truncated."""
    datum = _c(datum)

    def step(acc, _):
        grown = lambda v: F.struct(F.concat(acc["path"], F.array(v["value"].cast("int"))).alias("path"), v["next"].alias("next"), v.isNotNull().alias("ok"))
        return F.when(acc["ok"], _once(read_zigzag(datum, acc["next"]), grown)).otherwise(acc)

    def rest(path, start):
        return F.struct(path.alias("path"), datum.substr(start, F.octet_length(datum) + 1).alias("message"))

    def whole(head):
        seed = F.struct(F.array().cast("array<int>").alias("path"), head["next"].alias("next"), F.lit(True).alias("ok"))
        steps = F.aggregate(F.sequence(F.lit(1), head["value"].cast("int")), seed, step, lambda out: F.when(out["ok"], rest(out["path"], out["next"])))
        fits = (head["value"] > 0) & (head["value"] <= F.octet_length(datum))
        return F.when(head["value"] == 0, rest(F.array(F.lit(0)), head["next"])).when(fits, steps)

    return _once(read_zigzag(datum), whole)


def write_zigzag(n) -> Column:
    """The zig-zag varint of a bigint: seven bits a byte, the lowest first."""
    n = _c(n).cast("bigint")
    bits = F.call_function("shiftleft", n, F.lit(1)).bitwiseXOR(F.call_function("shiftright", n, F.lit(63)))
    left = lambda i: F.call_function("shiftrightunsigned", bits, i * 7)
    byte = lambda i: left(i).bitwiseAND(F.lit(127).cast("bigint")).bitwiseOR(F.when((i < 9) & (left(i + 1) != 0), F.lit(128)).otherwise(F.lit(0)).cast("bigint"))
    some = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda i: (i == 0) | (left(i) != 0))
    return F.unhex(F.array_join(F.transform(some, lambda i: F.lpad(F.hex(byte(i)), 2, "0")), ""))


def write_path(path) -> Column:
    """The path's bytes: its length and its indexes as varints; [0] is one zero byte. Null where an index
    is negative."""
    path = _c(path)
    whole = F.concat(write_zigzag(F.size(path)), F.unhex(F.array_join(F.transform(path, lambda i: F.hex(write_zigzag(i))), "")))
    return F.when(path == F.array(F.lit(0)), F.lit(b"\x00")).when(F.forall(path, lambda i: i >= 0), whole)


def delivery_ordinal(headers) -> Column:
    """Which delivery this is: the retry-count header, 0 without one, plus 1."""
    return F.coalesce(header_value(headers, RETRY_HEADER).try_cast("int"), F.lit(0)) + 1


def with_retry_count(headers, count) -> Column:
    return F.concat(without_headers(headers, RETRY_HEADER), F.array(header(RETRY_HEADER, _c(count).cast("string"))))
