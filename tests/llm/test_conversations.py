"""Repairs of conversations against every possible sequence of edits, and against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import conversations as C

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out: dict = {}
    text = lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        out.setdefault(c, [])
        how, r, x = zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20, text(r), text(x)
        x = "" if how == 1 else re.sub("[.!?]", "", x) if how == 2 else x
        if how:
            out[c] += [(t, "user" if how == 4 else r, x)] * (1 + (how == 3))
    return out


def faults(rows):
    seen, out = set(), []
    for _, r, x in rows:
        bare = x.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def applied(rows, audit):
    """Role and text of each repaired row, and the cost."""
    out, i, last = [], 0, ""
    for e in audit:
        if e == "D":
            i += 1
            continue
        if e == "I":
            out.append((ROLE[NEXT[last]], ""))
        else:
            out.append((rows[i][1] if e == "K" else ROLE[NEXT[last]], rows[i][2]))
            i += 1
        last = out[-1][0][:1]
    return out


def cheapest(rows):
    """From the back: the cheapest edits of what is left, in each state, ties by the least audit."""
    found, n = faults(rows), len(rows)
    best: list = [dict() for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here = {}
        for s in NEXT:
            options = [(0, "")] if i == n and s in ("", "a") else []
            if i < n:
                extra, own = 5 * (found[i] == "truncated"), rows[i][1][:1]
                ways = [(2, "D", s)]
                if found[i] not in ("blank", "duplicate"):
                    ways += [(extra, "K", own)] * (own == NEXT[s] or (own == "s" and s == "")) + [(1 + extra, "R", NEXT[s])]
                options += [(c + best[i + 1][to][0], e + best[i + 1][to][1]) for c, e, to in ways if to in best[i + 1]]
            if options:
                here[s] = min(options)
        for _ in range(4):
            for s in NEXT:
                if NEXT[s] in here:
                    c, e = here[NEXT[s]]
                    here[s] = min(here.get(s, (1 << 60, "")), (c + 5, "I" + e))
        best[i] = here
    return best[0][""]


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns, found = [t for t, _, _ in rows if t is not None], faults(rows)
    cost, audit = cheapest(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    whole = "\n".join(f"{r}:{x}" for r, x in applied(rows, audit))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def got(spark, rows, damaging=False):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    df = df.withColumns({"id": F.lit("x"), "slice": F.lit(1), "n": F.lit(0), "kind": F.lit(2), "symbol": F.lit("")})
    out = C.repair(C.damaged(df), df) if damaging else C.repair(df)
    return {r[0]: tuple(r[1:]) for r in out.select(*COLUMNS).collect()}


def by_conversation(rows):
    out: dict = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    return out


def test_cheapest_edits_of_short_conversations_by_enumeration():
    """Every audit with up to two inserts at a place, its cost by hand, for every conversation of three rows."""
    for symbols in itertools.product("uasxUAd", repeat=3):
        best = None
        for own in itertools.product("KRD", repeat=3):
            for ins in itertools.product(range(3), repeat=4):
                audit = "".join("I" * n + e for n, e in zip(ins, own)) + "I" * ins[3]
                cost, last, ok, i = 0, "", True, 0
                for e in audit:
                    cost += C.COST[e]
                    if e == "I":
                        last = NEXT[last]
                        continue
                    s, i = symbols[i], i + 1
                    if e == "D":
                        continue
                    low = s.lower()
                    ok &= s != "d" and (e == "R" or low == NEXT[last] or (low == "s" and last == ""))
                    last = (low if e == "K" else NEXT[last]) if ok else ""
                    cost += C.TRUNCATED * s.isupper()
                if ok and last in ("", "a"):
                    best = min(best or (cost, audit), (cost, audit))
        cost, states = C.chain([C.pieces("".join(symbols), (0, 1, 2, 3))])
        audit = C.edits_from("".join(symbols), C.NONE)[states[-1]][1] + C.TAIL[states[-1]]
        assert (cost, audit) == best, symbols


@pytest.mark.parametrize("cut", [1, 2, 7])
def test_chained_segments_equal_the_whole(cut):
    rng = random.Random(4)
    for _ in range(300):
        symbols = "".join(rng.choice("uaUAsxd") for _ in range(rng.randint(1, 40)))
        parts = [symbols[i : i + cut] for i in range(0, len(symbols), cut)]
        cost, states = C.chain([C.pieces(p, (0, 1, 2, 3)) for p in parts])
        audit = "".join(C.edits_from(p, a)[b][1] for p, a, b in zip(parts, states, states[1:])) + C.TAIL[states[-1]]
        rows = [(i, {"u": "user", "a": "assistant", "s": "system", "x": "other", "d": "user"}[s.lower()], "" if s == "d" else f"{i}" if s.isupper() else f"{i}.") for i, s in enumerate(symbols)]
        assert (cost, audit) == cheapest(rows)


def test_collisions_of_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(C.Edits, "MODULUS", 3)
    rng, e = random.Random(1), C.Edits()
    nodes = [0]
    for _ in range(400):
        nodes.append(e.grow(rng.choice(nodes), rng.choice((1, 2))))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        s, t = e.spelled(a), e.spelled(b)
        c = e.compare(a, b)
        assert (c > 0) - (c < 0) == (s > t) - (s < t)
    assert all(e.spelled(e.ancestor(n, d)) == e.spelled(n)[:d] for n in nodes[::40] for d in range(e.depth[n] + 1))


def test_equals_the_plain_version_on_the_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = {r[0]: tuple(r[1:]) for r in C.op12_conversation_repair(spark, "/root/testdata/sf0.01").select(*COLUMNS).collect()}
    assert out == {c: plain(v) for c, v in damage(rows).items()}


def test_nulls_ties_odd_roles_repeated_rows_and_empty_tables(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "a."), (1, 0, "user", "a."), (1, 0, "assistant", "b."), (1, 5, "user", "\t\x0b"), (1, 7, "assistant", "no end"),
        (2, None, "user", "x."), (2, None, "system", "y."), (3, 1, "", "x."), (3, 2, "User", "é?"), (3, 3, "assistant", "x!"), (4, 1, "system", "s."), (4, 2, "system", "t."),
        (None, 1, "user", "u."), (None, 2, "assistant", "a. \n"), (5, -3, "user", "u"), (6, 1, "a", "."), (6, 1, "a", "."), (7, 0, None, "text."), (8, 2, "assistant", "x" * 50000 + ".\r\n"),
    ]
    assert got(spark, rows) == {c: plain(v) for c, v in by_conversation(rows).items()}
    assert got(spark, []) == {}
    gone = [(c, t, "user", "x.") for c in range(40) for t in (1,)]
    out = got(spark, gone, damaging=True)
    lost = [c for c, v in damage(gone).items() if not v]
    assert len(out) == 40 and lost and all(out[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in lost)


def test_a_conversation_of_most_rows_is_edited_in_pieces(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No", "", "So?", "So what!"]
    rows = [(1, t, rng.choice(["user", "user", "assistant", "assistant", "system", "tool"]), rng.choice(texts) if rng.random() < 0.3 else f"{t}.") for t in range(2600)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in (0, 2, 3) for t in range(6)]
    assert got(spark, rows, damaging=True) == {c: plain(v) for c, v in damage(rows).items()}
