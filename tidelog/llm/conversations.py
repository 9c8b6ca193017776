"""Conversation structure: faults of turns, and the cheapest edits that repair their order.

Rows of all conversations are sorted once, by conversation and turn, and stay in the slice that they
were sorted into. A conversation's part of a slice, cut into segments, is edited for every state that a
segment can begin in; segments are then chained over a row for each of them. So a conversation of any
length is edited in pieces, and only the last step, its hash, reads it in order, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, table

#: Fixed values of the contract: costs of edits, what an undeleted truncated row adds, roles.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a segment at most; sequences of up to SHORT rows are edited once and remembered.
SEGMENT, SHORT, KEPT = 1024, 32, 1 << 16
#: What the repaired rows end in so far: nothing, a system, a user or an assistant row.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Inserts that complete the conversation from each state.
TAIL = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
SPACE = " \t\n\x0b\x0c\r"


class Edits:
    """Sequences of symbols as linked nodes that share their prefixes; 0 is the empty one. Each node knows
    its ancestors 1, 2, 4, ... back and a rolling hash of its whole prefix."""

    BASE, MODULUS = 911382323, (1 << 61) - 1

    def __init__(self):
        self.symbol, self.depth, self.hash, self.up = [0], [0], [0], [[]]
        self.same: set[tuple[int, int]] = set()

    def grow(self, node: int, symbol: int) -> int:
        back, k = [node], 0
        while len(self.up[back[k]]) > k:
            back.append(self.up[back[k]][k])
            k += 1
        self.symbol.append(symbol)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.BASE + symbol + 1) % self.MODULUS)
        self.up.append(back)
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        rest, k = self.depth[node] - depth, 0
        while rest:
            if rest & 1:
                node = self.up[node][k]
            rest >>= 1
            k += 1
        return node

    def spelled(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]

    def _equal(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth spell the same, symbol by symbol, up to where they meet or are
        known to be equal."""
        seen = []
        while a != b and (a, b) not in self.same:
            if self.symbol[a] != self.symbol[b]:
                return False
            seen.append((a, b))
            a, b = self.up[a][0], self.up[b][0]
        self.same.update(seen)
        return True

    def compare(self, x: int, y: int) -> int:
        """Below 0 if x comes before y, 0 if they spell the same. The longest common prefix is searched
        for by hashes of ancestors; what the hashes call equal is verified."""
        if x == y:
            return 0
        depth = min(self.depth[x], self.depth[y])
        a, b = self.ancestor(x, depth), self.ancestor(y, depth)
        if self.hash[a] == self.hash[b] and self._equal(a, b):
            return self.depth[x] - self.depth[y]
        if self.hash[a] != self.hash[b]:
            for k in range(len(self.up[a]) - 1, -1, -1):
                if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
            if self._equal(self.up[a][0], self.up[b][0]):
                return self.symbol[a] - self.symbol[b]
        s, t = self.spelled(x), self.spelled(y)  # two prefixes of one hash that differ
        return (s > t) - (s < t)

    def best(self, options: list[tuple[int, int, str]]) -> tuple[int, int] | None:
        """The cheapest of (cost, node, symbol to add or none), of equally cheap ones the least."""
        if not options:
            return None
        low = min(o[0] for o in options)
        nodes = [self.grow(n, ord(s)) if s else n for c, n, s in options if c == low]
        first = nodes[0]
        for n in nodes[1:]:
            if self.compare(n, first) < 0:
                first = n
        return low, first


def _step(e: Edits, at: list, symbol: str) -> list:
    """The states after one row. Inserts stand in front of the row whose edit they serve.
    symbol: the role's initial (u, a, s or x), a capital where the row is truncated, d where it must go."""
    option = lambda s, cost, what: [(at[s][0] + cost, at[s][1], what)] if at[s] else []
    insert = COST["I"]
    user = e.best(option(USER, 0, "") + [o for s in (NONE, SYSTEM, ASSISTANT) for o in option(s, insert, "I")])
    assistant = e.best(option(ASSISTANT, 0, "") + ([(user[0] + insert, user[1], "I")] if user else []))
    at = [at[NONE], at[SYSTEM], user, assistant]
    out = [option(s, COST["D"], "D") for s in range(4)]
    if symbol != "d":
        extra, role = TRUNCATED * symbol.isupper(), symbol.lower()
        if role == "s":
            out[SYSTEM] += option(NONE, COST["K"] + extra, "K")
        for to, own, before in ((USER, "u", (NONE, SYSTEM, ASSISTANT)), (ASSISTANT, "a", (USER,))):
            what = "K" if role == own else "R"
            out[to] += [o for s in before for o in option(s, COST[what] + extra, what)]
    return [e.best(o) for o in out]


def edits_from(symbols: str, begin: int) -> tuple:
    """For each state to end in, (cost, audit) of the cheapest edits of these rows that begin in `begin`,
    ties by the least audit; None where there are none. Trailing inserts are not among them."""
    return _remembered(symbols, begin) if len(symbols) <= SHORT else _edits_from(symbols, begin)


def _edits_from(symbols: str, begin: int) -> tuple:
    e = Edits()
    at: list = [None] * 4
    at[begin] = (0, 0)
    for s in symbols:
        at = _step(e, at, s)
    return tuple(a and (a[0], bytes(e.spelled(a[1])).decode()) for a in at)


_remembered = lru_cache(KEPT)(_edits_from)


def pieces(symbols: str, begins: tuple[int, ...]) -> list[int]:
    """Of a segment, for each state it begins and ends in, its cost and its audit's rank among them; -1
    where there is no way. Two audits of one segment have as many edits of rows and end in one, so
    neither is the beginning of the other: chained segments compare by the first rank that differs."""
    ways = {(b, t): w for b in begins for t, w in enumerate(edits_from(symbols, b)) if w}
    rank = {a: n for n, a in enumerate(sorted({w[1] for w in ways.values()}))}
    return [v for b in range(4) for t in range(4) for v in ((ways[b, t][0], rank[ways[b, t][1]]) if (b, t) in ways else (-1, -1))]


def chain(segments: list[list[int]]) -> tuple[int, list[int]]:
    """Total cost and the states that each segment begins in, and the last one ends in, of the cheapest
    way through a conversation's segments, ties by the least audit."""
    e = Edits()
    at: list = [(0, 0), None, None, None]
    back: list[dict] = []
    for p in segments:
        grown: dict[tuple[int, int], int] = {}
        new: list = []
        came: dict[int, int] = {}
        for t in range(4):
            best = None
            for b in range(4):
                cost, rank = p[8 * b + 2 * t : 8 * b + 2 * t + 2]
                if cost < 0 or not at[b]:
                    continue
                total = at[b][0] + cost
                if best and total > best[0]:
                    continue
                node = grown.setdefault((at[b][1], rank), -1)
                if node < 0:
                    node = grown[at[b][1], rank] = e.grow(at[b][1], rank)
                if not best or total < best[0] or e.compare(node, best[1]) < 0:
                    best, came[t] = (total, node), b
            new.append(best)
        at = new
        back.append(came)
    ends = [(a[0] + COST["I"] * len(TAIL[s]), a[1], s) for s, a in enumerate(at) if a]
    order = lambda x, y: x[0] - y[0] or e.compare(x[1], y[1])
    cost, _, state = min(ends, key=cmp_to_key(order))
    states = [state]
    for came in reversed(back):
        states.append(came[states[-1]])
    return cost, states[::-1]


def _symbol(role, blank, repeated, truncated):
    initial = F.when(F.substring(role, 1, 1).isin("u", "a", "s"), F.substring(role, 1, 1)).otherwise("x")
    return F.when(blank | repeated, "d").when(truncated, F.upper(initial)).otherwise(initial)


FACTS = "slice int, conv string, id bigint, turn bigint, symbol string, initial string, blank boolean, repeated boolean, truncated boolean"
SEGMENTS = "slice int, conv string, id bigint, n int, ways array<bigint>, sums array<bigint>, first_initial string, last_initial string, first_turn bigint, last_turn bigint"
CHOSEN = "slice int, conv string, id bigint, n int, begin int, to int, tail string, sums array<bigint>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[dict]]]:
    """Rows (slice, conv, ...) in order as segments, with whether each surely begins its conversation."""
    key, part, sure = object(), [], False
    last_slice = None
    for batch in batches:
        for r in batch.to_pylist():
            now = (r["slice"], r["conv"])
            if now != key or len(part) == SEGMENT:
                if part:
                    yield sure, part
                # A slice's first conversation may go on from the slice before.
                sure, part = now != key and r["slice"] == last_slice, []
                key, last_slice = now, r["slice"]
            part.append(r)
    if part:
        yield sure, part


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for sure, rows in _runs(batches):
        ways = pieces("".join(r["symbol"] for r in rows), (NONE,) if sure else (NONE, SYSTEM, USER, ASSISTANT))
        turns = [r["turn"] for r in rows if r["turn"] is not None]
        sums = [sum(r["blank"] for r in rows), sum(r["repeated"] for r in rows), sum(r["truncated"] for r in rows), sum(_illegal(a["initial"], b["initial"]) for a, b in zip(rows, rows[1:])), len(set(turns))]
        out.append({"slice": rows[0]["slice"], "conv": rows[0]["conv"], "id": rows[0]["id"], "n": len(rows), "ways": ways, "sums": sums, "first_initial": rows[0]["initial"], "last_initial": rows[-1]["initial"], "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None})
        if len(out) == 1000:
            yield _batch(out, SEGMENTS)
            out = []
    yield _batch(out, SEGMENTS)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary()}


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in ddl.split(", "))]))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order -> what each of them does; a conversation's sums stand with its first."""

    def of(rows: list[dict]) -> list[dict]:
        cost, states = chain([r["ways"] for r in rows])
        sums = [sum(v) for v in zip(*[r["sums"] for r in rows], strict=True)]
        dated = [r for r in rows if r["first_turn"] is not None]
        illegal = sums[3] + sum(_illegal(a["last_initial"], b["first_initial"]) for a, b in zip(rows, rows[1:]))
        distinct = sums[4] - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - distinct if dated else 0
        made = [{"slice": r["slice"], "conv": r["conv"], "id": r["id"], "n": r["n"], "begin": b, "to": t, "tail": "", "sums": None} for r, b, t in zip(rows, states, states[1:], strict=False)]
        made[0]["sums"] = [gaps, *sums[:3], illegal, cost]
        made[-1]["tail"] = TAIL[states[-1]]
        return made

    key, part, out = object(), [], []
    for batch in batches:
        for r in batch.to_pylist():
            if r["conv"] != key:
                out += of(part) if part else []
                key, part = r["conv"], []
                if len(out) >= 1000:
                    yield _batch(out, CHOSEN)
                    out = []
            part.append(r)
    out += of(part) if part else []
    yield _batch(out, CHOSEN)


EDITED = "conv string, id bigint, kind int, edits string, tail string, sums array<bigint>, role binary, text binary"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's choice and then its rows -> each row's edits, inserts in front of its own."""
    out, left, symbols, chosen = [], 0, [], None
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == 0:
                chosen, left, symbols = r, r["n"], []
                continue
            symbols.append((r["id"], r["symbol"]))
            left -= 1
            if left:
                continue
            audit = edits_from("".join(s for _, s in symbols), chosen["begin"])[chosen["to"]][1]
            own, row = "", 0
            for c in audit:
                own += c
                if c != "I":
                    first, last = row == 0, row == len(symbols) - 1
                    out.append({"conv": chosen["conv"], "id": symbols[row][0], "kind": 0, "edits": own, "tail": chosen["tail"] if last else "", "sums": chosen["sums"] if first else None, "role": None, "text": None})
                    own, row = "", row + 1
            if len(out) >= 5000:
                yield _batch(out, EDITED)
                out = []
    yield _batch(out, EDITED)


RESULT = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with its edits in front -> the conversations' results. What is repaired is
    hashed as it comes, so no conversation is held whole."""
    key, out = object(), []
    state: dict = {}

    def begin():
        state.update(audit=[], hash=hashlib.sha256(), any=False, last="", sums=[0] * 6, edits="", tail="")

    def put(role: bytes, text: bytes):
        state["hash"].update((b"\n" if state["any"] else b"") + role + b":" + text)
        state["any"], state["last"] = True, role[:1].decode(errors="replace")

    def made(role, text, edits: str):
        for c in edits:
            following = ROLES["a" if state["last"] == "u" else "u"].encode()
            if c == "I":
                put(following, b"")
            elif c != "D":
                put(role if c == "K" else following, text)
        state["audit"].append(edits)

    def end():
        made(b"", b"", state["tail"])
        s = state["sums"]
        out.append(dict(zip(("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), (key, *s, "".join(state["audit"]), state["hash"].hexdigest()), strict=True)))

    for batch in batches:
        for r in batch.to_pylist():
            if r["conv"] != key:
                if state:
                    end()
                key = r["conv"]
                begin()
                if len(out) >= 1000:
                    yield _batch(out, RESULT)
                    out = []
            if r["kind"] == 0:
                state["edits"] = r["edits"]
                state["sums"] = r["sums"] or state["sums"]
                state["tail"] = r["tail"] or state["tail"]
            elif r["kind"] == 1:
                made(r["role"], r["text"], state["edits"])
    if state:
        end()
    yield _batch(out, RESULT)


def repair(rows: DataFrame, all_ids: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation: its faults, and the cheapest edits after which its roles begin `(s?(ua)+)?`.

    Rows come by turn, nulls first; of one turn by role and text, so copies are adjacent. A null role or
    text is one space; a null id is a conversation of its own. A row's first fault counts: blank,
    duplicate (of an earlier row's role and text), truncated (it doesn't end in one of .!?). Roles of
    other initials (an empty role among them) are legal nowhere, so such rows are reroled or deleted.
    Of equally cheap edits those with the least audit are taken; an audit tells the edits, as the rows
    repaired so far tell which role comes next. Conversations of `all_ids` without rows get zeros, an
    empty audit and the hash of nothing. Repeated rows are duplicates; an empty table gives no rows;
    other columns are ignored.

    Texts are sorted once and moved once more to be hashed; edits are found on symbols alone. The audit
    is built as persistent prefixes (`Edits`): two prefixes of the same rows, cost and state are never one
    the beginning of the other, since what follows could only be inserts, which cost more. So the least
    prefix leads to the least whole.
    """
    kind = rows.schema[id_col].dataType
    name = {"role": F.coalesce(F.col(role_col), F.lit(" ")), "text": F.coalesce(F.col(text_col), F.lit(" "))}
    own = rows.select(F.col(id_col).cast("string").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), name["role"].alias("role"), name["text"].alias("text"))
    ends = F.rtrim("text", F.lit(SPACE))
    order = ["conv", "turn", "role", "text"]
    own = own.withColumns({
        "empty": ends == "", "cut": ~F.right(ends, F.lit(1)).isin(".", "!", "?"),
        "same": F.unhex(F.sha2(F.concat(F.coalesce(F.concat("conv", F.lit(";")), F.lit("null;")), F.char_length("role").cast("string"), F.lit(";"), "role", "text"), 256)),
    })
    # The ids follow the order over all slices.
    sorted_ = own.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"slice": F.spark_partition_id(), "id": F.monotonically_increasing_id()})
    sorted_ = checkpoint(sorted_)

    facts = sorted_.select("slice", "conv", "id", "turn", F.substring("role", 1, 1).alias("initial"), "empty", "cut", "same")
    first = facts.groupBy("same").agg(F.min("id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("same", "_first")
    again = F.coalesce(F.col("id") > F.col("_first"), F.lit(False))
    facts = facts.join(first, "same", "left").withColumn("again", again)
    repeated, truncated = F.col("again") & ~F.col("empty"), F.col("cut") & ~F.col("empty") & ~F.col("again")
    facts = checkpoint(facts.select("slice", "conv", "id", "turn", _symbol("initial", F.col("empty"), repeated, truncated).alias("symbol"), "initial", F.col("empty").alias("blank"), repeated.alias("repeated"), truncated.alias("truncated")))

    segments = facts.repartition("slice").sortWithinPartitions("slice", "id").mapInArrow(_segments, SEGMENTS)
    chosen = checkpoint(segments.repartition("conv").sortWithinPartitions("conv", "id").mapInArrow(_chained, CHOSEN))
    both = chosen.select("slice", "id", F.lit(0).alias("kind"), "conv", "n", "begin", "to", "tail", "sums", F.lit(None).cast("string").alias("symbol"))
    both = both.unionByName(facts.select("slice", "id", F.lit(1).alias("kind"), "symbol"), allowMissingColumns=True)
    edits = both.repartition("slice").sortWithinPartitions("slice", "id", "kind").mapInArrow(_edited, EDITED)

    texts = sorted_.select("conv", "id", F.lit(1).alias("kind"), F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"))
    asked = (rows if all_ids is None else all_ids).select(F.col(id_col).cast("string").alias("conv")).distinct().select("conv", F.lit(-1).cast("bigint").alias("id"), F.lit(-1).alias("kind"))
    all_ = edits.unionByName(texts, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    out = all_.repartition("conv").sortWithinPartitions("conv", "id", "kind").mapInArrow(_applied, RESULT)
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *[c.split()[0] for c in RESULT.split(", ")[1:]])


#: Fixed value of the contract: of so many kinds of rows the first five are damaged.
KINDS = 20


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in, by a checksum of conversation and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % KINDS
    out = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), how.alias("_how")).where("_how > 0")
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv_id", "turn", F.when(F.col("_how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_k")).drop("_k")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of every conversation, after its damage."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(rows), rows.select("conv_id"))
