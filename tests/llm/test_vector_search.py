"""Hard negatives and nearest neighbours against brute force, and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import negatives, neighbours, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def rows_of(n, dim=8, seed=1, labels=4, spread=0.3, centres=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    x = (middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, labels))) for i in range(n)]


def partakes(v, dim, zero=False):
    return v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))


def plain_negatives(rows, dim, every):
    use = [(i, [int(np.floor(256.0 * float(np.float32(c)))) for c in v], y) for i, v, y in rows if i is not None and y is not None and partakes(v, dim, zero=True)]
    out = []
    for a, q, y in use:
        if a % every:
            continue
        scored = sorted((-sum(p * r for p, r in zip(q, v)), i, z) for i, v, z in use if i != a)
        for s, p, _ in [r for r in scored if r[2] == y][:5]:
            fits = [(i, -t) for t, i, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = negatives.hard_negatives(df.withColumns({"rank": F.lit(1), "id": F.lit("x"), "score": F.lit(0), "anchor": F.lit(None).cast("int")}), lambda i: i % every == 0, **more)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("block", [7, 60, 4096])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = rows_of(300)
    # Copies of one vector over a third of all rows, in two labels, anchors among them.
    rows = [(i, rows[10][1] if i % 3 == 0 else v, y % 2 if i % 3 == 0 else y) for i, v, y in rows]
    assert mined(spark, rows, 10) == plain_negatives(rows, 8, 10)


def test_rows_without_part_and_large_components(spark):
    rows = rows_of(60, labels=2)
    rows += [(100, None, 1), (110, [1.0] * 7 + [None], 1), (120, [float("nan")] + [1.0] * 7, 0), (130, [float("inf")] + [0.0] * 7, 0), (140, rows[3][1], None), (150, [1.0] * 5, 1), (None, rows[2][1], 1)]
    rows += [(160, [0.0] * 8, 0), (170, [-0.0] * 8, 1), (180, [3e5] * 8, 1), (190, [2.9e5] * 8, 0), (200, [3e5] * 8, 0)]
    assert mined(spark, rows, 10) == plain_negatives(rows, 8, 10)
    assert mined(spark, rows + rows[:5], 10) == mined(spark, rows, 10)  # repeated rows are one
    assert mined(spark, [], 10) == [] and mined(spark, [(1, [1.0], None), (2, None, 1)], 10) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)], 10) == []


def test_scores_beyond_doubles_are_exact():
    x, q = np.array([[2.0**60, 1.0], [2.0**60, 0.0]]), np.array([1.0, 3.0])
    assert negatives.scores(x, q).tolist() == [2**60 + 3, 2**60]
    assert negatives.scores(np.array([[2.0**62, 2.0**62]]), np.array([4.0, 4.0])).tolist() == [2**63 - 1]
    for v in (np.array([[3.0, -4.0]]), np.array([[70000.0, 1.0]]), np.array([[2.0**40, -1.0]])):
        assert (negatives.decoded(negatives.encoded(v), 2) == v).all()


def test_no_row_of_a_cell_passes_its_bound(spark):
    rows = rows_of(200, dim=5)
    dim = 5
    df = spark.createDataFrame(rows, SCHEMA)
    encode = lambda x: (np.arange(len(x)), negatives.encoded(np.floor(256 * x)))
    prepared = vectors.prepared(df, dim, encode, "vec_id", "embedding", F.col("label"))
    put, cells = negatives._index(prepared, dim)
    got = put.collect()
    x = negatives.decoded([r.vec for r in got], dim)
    a, b = cells.halves(x)
    at = np.array([(r.i, r.j) for r in got])
    assert (x @ x.T <= a[:, at[:, 0]] + b[:, at[:, 1]]).all()
    assert (cells.block_bounds(x).max(axis=1) >= (x @ x.T).max(axis=1)).all()


def found(spark, rows, every, k=10):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({"rank": F.lit(1), "id": F.lit("x"), "score": F.lit(0)})
    out: dict = {}
    for r in sorted(neighbours.nearest(df, lambda i: i % every == 0, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def plain_neighbours(rows, dim, every, k=10):
    use = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and partakes(v, dim)}
    out = {}
    for q in use:
        if q % every == 0:
            near = sorted((float(np.sqrt(((v - use[q]) ** 2).sum())), i) for i, v in use.items() if i != q)[:k]
            if near:
                out[q] = [(n + 1, i, s) for n, (s, i) in enumerate(near)]
    return out


def test_few_rows_are_searched_whole(spark):
    rows = rows_of(90) + [(100, None, 1), (110, [1.0] * 7 + [None], 1), (120, [float("nan")] + [1.0] * 7, 0), (130, [0.0] * 8, 0), (150, [1.0] * 5, 1), (None, [1.0] * 8, 1)]
    rows = [(i, rows[7][1] if i is not None and i < 40 else v, y) for i, v, y in rows]  # ties
    want = plain_neighbours(rows, 8, 10)
    assert found(spark, rows, 10) == want and found(spark, rows + rows[:20], 10) == want
    assert found(spark, [], 10) == {} and found(spark, rows[:1], 10) == {}
    assert found(spark, rows[50:54], 1) == plain_neighbours(rows[50:54], 8, 1)


@pytest.mark.parametrize("spread", [0.05, 1.0, 30.0])
def test_recall_over_many_lists_and_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "LIST_ROWS", 40)
    rows = rows_of(4000, dim=24, spread=spread, centres=20)
    rows = [(i, rows[4][1] if i % 3 == 0 else v, y) for i, v, y in rows]  # a third are copies
    got, want = found(spark, rows, 100), plain_neighbours(rows, 24, 100)
    assert got.keys() == want.keys() and all([r for r, _, _ in v] == list(range(1, 11)) for v in got.values())
    assert all(s == pytest.approx(float(np.linalg.norm(np.float64(np.float32(rows[i][1])) - np.float64(np.float32(rows[q][1])))), abs=1e-12) for q, v in got.items() for _, i, s in v)
    assert np.mean([len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, 0) for r in df.collect()]
    want = plain_neighbours(rows, 64, 100)
    got: dict = {}
    for r in neighbours.op13_nearest_neighbours(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for _, i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_the_graph_finds_the_nearest_lists():
    rng = np.random.default_rng(2)
    centroids = rng.normal(size=(1500, 12))
    graph = neighbours.Graph.over(centroids)
    x = rng.normal(size=(700, 12))
    far = np.linalg.norm(x[:, None] - centroids[None], axis=2)
    row, of = graph.homes(x)
    assert set(row.tolist()) == set(range(700)) and np.bincount(row).max() <= neighbours.MOST_HOMES
    assert np.mean([far[i].argmin() in set(of[row == i].tolist()) for i in range(700)]) > 0.98


def test_groups_are_packed_into_blocks():
    first, many, blocks = vectors.dealt_blocks(np.array([3, 3, 5, 25, 2, 0, 9]), 10)
    assert many.tolist() == [1, 1, 1, 3, 1, 1, 1] and blocks == int((first + many).max())
    assert first.tolist() == [0, 0, 1, 2, 5, 5, 6] and vectors.dealt_blocks(np.array([0]), 10)[2] == 1
