import random

from tidelog.llm.common import components


def test_components_equal_union_find(spark):
    r = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 501 + i) for i in range(80)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(120)]
    edges += [(7, 7), (None, 3), (3, None), (101, 100), (100, 101)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    want = sorted((x, find(x)) for x in up)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == want


def test_no_edges_and_text_nodes(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    got = components(spark.createDataFrame([("b", "c"), ("a", "c")], "a string, b string")).collect()
    assert sorted(map(tuple, got)) == [("a", "a"), ("b", "a"), ("c", "a")]
