import random
from collections import defaultdict

import numpy as np
from tidelog.llm import mixing as M


def reshared(sizes):
    """Targets by resharing the excess again and again, as the contract words it."""
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: [1, 2, 3][k % 3] for k, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        per = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += per * weight[s]
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def rows(seed, n=900):
    r = random.Random(seed)
    names = ["a", "B", "é", "z", "b", None, "empty"]
    return [(i, None if (s := r.choices(names, [30, 3, 2, 1, 1, 1, 1])[0]) == "empty" and i % 2 else "" if s == "empty" else "w " * r.choice([1, 5, 40, 300]), s) for i in range(n)]


def test_targets_and_balance(spark):
    for seed in (1, 2):
        data = rows(seed) + [(None, "x y", "a"), (5, "x y z", "a"), (5, "x y z", "a")]
        docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
        got = M.mix(docs, block=64).collect()
        assert len(got) == len(data)
        sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
        for g in got:
            sizes[g.source] += g.size
            taken[g.source] += g.taken
            most[g.source] = max(most[g.source], g.size)
            assert g.taken <= 3 * g.size and (g.size == 0 or g.taken % g.size == 0)
        want = reshared(dict(sizes))
        for g in got:
            assert g.source_size == sizes[g.source] and abs(g.target - want[g.source]) <= 1e-6 * max(1, want[g.source])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= max(2, 0.005 * want[s]), (s, taken[s], want[s])
        again = M.mix(docs.repartition(2), block=64).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))


def test_flight_keeps_counts_and_tokens():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 400).astype(float)
    p = M.flight(np.full(400, 0.37), size, rng)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert abs(p.sum() - 148) < 1e-6 and abs((p * size).sum() - 0.37 * size.sum()) < 1e-3
    mean = np.mean([M.flight(np.full(7, 0.4), np.arange(7.0), np.random.default_rng(k)) for k in range(3000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.05


def test_settling_ends_with_the_smallest():
    """One document of a fifth of the target among small ones: its rounding is made up for."""
    rng = np.random.default_rng(3)
    for k in range(50):
        size = np.sort(np.concatenate([[20_020], rng.integers(20, 2000, 300)]))[::-1].astype(float)
        chance = np.full(len(size), rng.uniform(0.1, 0.9))
        p = M.settle(chance, size, rng)
        assert set(p) <= {0.0, 1.0}
        assert abs((p - chance) @ size) <= 2 + 0.0005 * (chance @ size)
        assert abs((p - chance).sum()) <= 0.2 * len(size)
    mean = np.mean([M.settle(np.full(60, 0.4), np.arange(60.0, 0, -1), np.random.default_rng(k)) for k in range(2000)], axis=0)
    assert np.abs(mean[:40] - 0.4).max() < 0.06


def test_equal_rows_of_a_hot_key_are_dealt_evenly(spark):
    """A third of all rows have the same (null) id and text: blocks stay small and reruns agree."""
    data = [(None, "a b c", "s")] * 1000 + [(i, "w " * (1 + i % 9), "s" if i % 2 else "t") for i in range(2000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = M.checkpoint(M.sized(docs.repartition(5)))
    dealt = M.marked(rows)
    assert dealt.count() == len(data) and dealt.select("mark").distinct().count() == len(data)
    assert dealt.groupBy((M.F.abs("mark") % 16).alias("lot")).count().agg({"count": "max"}).first()[0] < 2 * len(data) / 16
    one, two = (sorted(map(str, M.mix(docs.repartition(n), block=100).collect())) for n in (2, 5))
    assert one == two and len(one) == len(data)


def test_clashing_names_and_long_texts(spark):
    data = [(i, "w " * (300_000 if i == 3 else 10), "s", 5, "x", 0.5) for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, size int, of string, target double")
    got = {g.doc_id: g for g in M.mix(docs).collect()}
    assert got[3].size == 300_000 and len(got) == 40 and sum(g.taken for g in got.values()) == 300_390


def test_empty_and_sizeless(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(docs).count() == 0
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(g.size, g.target, g.taken) for g in M.mix(docs).collect()} == {(0, 0.0, 0)}
