import itertools
import random
import re

import numpy as np

from tidelog.llm import quality_model as Q


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    first = np.array([0, 1, 4, 9])
    score, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    good, pair, log_z = Q.marginals(score, trans, first)
    k = 0
    for r, (a, b) in enumerate(zip(first[:-1], first[1:])):
        total, marg, pairs = 0.0, np.zeros(b - a), np.zeros((b - a - 1, 2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(score[a + i] * v for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:])))
            total += w
            marg += w * np.array(y)
            for i, (u, v) in enumerate(zip(y, y[1:])):
                pairs[i, u, v] += w
        assert np.allclose(good[a:b], marg / total) and np.isclose(log_z[r], np.log(total))
        assert np.allclose(pair[k : k + b - a - 1], pairs / total)
        k += b - a - 1


def test_held_out_accuracy_and_odd_rows(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7)))
    rows, marks = [], []
    for i in range(600):
        good = i % 3 > 0
        lines = [" ".join((word() if good or k == 0 else word().upper() + "!!") for _ in range(r.randint(4, 12))) for k in range(r.randint(2, 9))]
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(good)))
    odd = [(9000, None), (9001, ""), (None, "a b c d"), (9002, "x y z w\n" * 30000), (9002, "x y z w\n" * 30000), (9003, "\n\n#")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame(marks + [(None, 1)], "doc_id long, quality int"), rows=500)
    out = Q.score(docs, model).withColumn("held", Q.held_out()).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= o.score <= 1 and o.predicted == int(o.score >= 0.3) for o in out)
    got = {o.doc_id: o for o in out}
    held = [(got[i], m) for i, m in marks if got[i].held]
    assert sum(int(o.score >= 0.5) == m for o, m in held) >= 0.97 * len(held)
    assert got[9000].score == got[9001].score


def test_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [o.predicted for o in Q.score(docs, Q.train(docs, labels)).collect()] == [1]
    assert Q.score(docs.limit(0), Q.train(docs, labels.limit(0))).count() == 0


def plain_line(line, before):
    """The line's shares, byte by byte."""
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", line) if w]
    n, size = max(1, len(words)), max(1, len(line))
    symbols, letters = b"#*$%&|<>", [b for b in line if b >= 128 or chr(b).isalpha()]
    again = sum(a.lower() == b.lower() for a, b in zip(words, words[1:]))
    share = [
        sum(b in symbols for b in line) / n / 2, sum(len(w) == 1 and w in symbols for w in words) / n, sum(65 <= b <= 90 for b in line) / max(1, len(letters)),
        sum(w.endswith(b"!") for w in words) / n, again / n if len(words) > 1 else 0, float(bool(words) and line in before), sum(48 <= b <= 57 for b in line) / size, float(len(words) < 3),
    ]
    return [min(1.0, x) for x in share], size + 1


def plain_document(text, model):
    """Log odds of the length-weighted mean chance of `good`, from all labellings of the lines."""
    lines = text.encode().split(b"\n")
    raw = [plain_line(x, lines[:k]) for k, x in enumerate(lines)]
    steps = [[float(np.float32(v) > s) for s in Q.STEPS for v in x] for x, _ in raw]
    none = [0.0] * len(steps[0])
    rows = [[1.0, *steps[k], *(steps[k - 1] if k else none), *(steps[k + 1] if k + 1 < len(steps) else none), float(k == 0), float(k + 1 == len(steps))] for k in range(len(steps))]
    score = [float(np.dot(f, model.theta)) for f in rows]
    total, good = 0.0, np.zeros(len(lines))
    for y in itertools.product((0, 1), repeat=len(lines)):
        w = np.exp(sum(s for s, v in zip(score, y) if v) + sum(model.trans[a, b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
    weight = np.array([w for _, w in raw])
    p = float((good / total * weight).sum() / weight.sum())
    return np.log(p / (1 - p))


def test_document_score_equals_brute_force():
    r, rng = random.Random(5), np.random.default_rng(6)
    bits = ["a", "Word", "word", "WORD", "é", "#", "x*y", "NO!", "12", "7", " ", "\t", "\n", "|", "ha ha", "Terms apply\n"]
    texts = ["", "\n", "a", "A b c\nA b c"] + [" ".join(r.choices(bits, k=r.randint(1, 18))) for _ in range(120)]
    texts = [t for t in texts if t.count("\n") < 9]
    data = [t.encode() for t in texts]
    model = Q.LineField(rng.normal(size=Q.N_FEATURES), rng.normal(size=(2, 2)))
    buf, bounds = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = model.document(*Q.raw_features(buf, bounds))
    assert np.allclose(got, [plain_document(t, model) for t in texts], atol=1e-5)


def test_repeated_ids_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7, "x"), (1, "a b c d", 8, "y"), (None, None, 9, "z")], "doc_id long, text string, score int, label string")
    model = Q.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    got = Q.score(docs, model).collect()
    assert len(got) == 3 and all(0 <= g.score <= 1 for g in got) and got[0].score == got[1].score
