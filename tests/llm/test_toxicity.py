import itertools
import random

import numpy as np

from tidelog.llm import toxicity as T


def test_interaction_is_learnt(spark):
    """Either word alone is fine; insult and group together are not: no linear model tells."""
    r = random.Random(4)
    rows, marks = [], []
    for i in range(1500):
        words = [f"w{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}" for _ in range(r.randint(5, 30))]
        a, b = r.random() < 0.5, r.random() < 0.5
        words += ["vermin"] * a + ["tribe"] * b
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, None if i % 50 == 0 else int(a and b)))
    odd = [(9001, None), (9002, ""), (None, "vermin tribe"), (9003, "Vermin, tribe " * 30000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    labels = spark.createDataFrame(marks + [(None, 1)], "doc_id long, toxic int")
    model = T.train(docs, labels, epochs=40)
    got = {g.doc_id: g for g in T.score(docs, model).withColumn("held", T.held_out()).collect()}
    held = [(got[i], m) for i, m in marks if got[i].held and m is not None]
    assert sum(g.predicted == m for g, m in held) >= 0.95 * len(held)
    assert got[9003].predicted == 1 and got[None].predicted == 1
    assert got[9001].score == got[9002].score and 0 <= got[9001].score <= 1


def rows_of(texts):
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(data), np.uint8)
    row, bucket, x = T.terms(buf, np.concatenate([[0], np.cumsum([len(t) for t in data])]))
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    return [(bucket[a:b], x[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def test_pair_among_thousands_of_telling_terms():
    """Every clean text has one of the two words, a toxic one both, beside 6000 terms of other kinds."""
    r = random.Random(7)
    texts, y = [], []
    for i in range(2400):
        toxic = r.random() < 0.3
        words = [f"n{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}q" for k in r.choices(range(6000), k=30)]
        words += ["vermin", "tribe"] if toxic else [r.choice(["vermin", "tribe"])]
        r.shuffle(words)
        texts.append(" ".join(words))
        y.append(float(toxic))
    each, y = rows_of(texts), np.array(y)
    model = T.fit(each[:2000], y[:2000], epochs=15)
    assert len(model.buckets) > 4096
    data = [t.encode() for t in texts[2000:]]
    got = model.score(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in data])]))
    assert ((got >= 0.5) == (y[2000:] > 0)).mean() > 0.95


def test_value_and_gradient_against_plain_sums():
    rng = np.random.default_rng(2)
    row, term = np.array([0, 0, 0, 2, 2]), np.array([1, 3, 4, 0, 3])
    x, w, v = rng.random(5), rng.normal(size=6), rng.normal(size=(6, T.FACTORS))
    slope = np.array([0.7, 1.0, -0.3])

    def plain(w, v):
        out = np.full(3, 0.25)
        for n in range(3):
            at = np.flatnonzero(row == n)
            out[n] += sum(w[term[i]] * x[i] for i in at) + sum(v[term[i]] @ v[term[j]] * x[i] * x[j] for i, j in itertools.combinations(at, 2))
        return out

    got, total = T.value(row, term, x, 3, 0.25, w, v)
    assert np.allclose(got, plain(w, v))
    used, gw, gv = T.gradient(row, term, x, total, slope, v)
    assert used.tolist() == [0, 1, 3, 4]
    step = 1e-6
    for k, t in enumerate(used):
        near = w.copy()
        near[t] += step
        assert np.isclose(gw[k], slope @ (plain(near, v) - plain(w, v)) / step, atol=1e-4)
        for f in range(T.FACTORS):
            near = v.copy()
            near[t, f] += step
            assert np.isclose(gv[k, f], slope @ (plain(w, near) - plain(w, v)) / step, atol=1e-4)


def test_terms_against_plain_counts():
    text = "Vermin vermin é tribes, a1b"
    (bucket, x), (none, _) = rows_of([text, ""])
    words = ["vermin", "vermin", "é", "tribes", "a", "b"]
    plain = {w: words.count(w) for w in words} | {"vermi+5": 2, "tribe+5": 1}
    assert sorted(np.round(x, 5)) == sorted(np.round([min(1, T.SHARE * n / len(words)) for n in plain.values()], 5).astype(np.float32))
    assert len(bucket) == len(set(bucket.tolist())) and not len(none)


def test_one_class_repeated_ids_clashing_names_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", 0, "x")] * 3 + [(None, None, 1, None)], "doc_id long, text string, score int, label string")
    labels = spark.createDataFrame([(1, 0), (1, 0)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    assert [g.predicted for g in T.score(docs, model).collect()] == [0] * 4
    assert T.labelled(docs, labels, "toxic", 10).count() <= 1
    assert T.score(docs.limit(0), T.train(docs.limit(0), labels.limit(0))).count() == 0
