import random

import numpy as np

from tidelog.llm import decontaminate as D


def word(r):
    return "".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 8)))


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_bit_parallel_lcs():
    r = random.Random(1)
    for _ in range(200):
        a, b = [[r.randrange(5) for _ in range(r.randint(1, 25))] for _ in "ab"]
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert D.lcs(masks, len(a), b) == plain_lcs(a, b)


def test_copies_and_paraphrases_are_found_and_clean_texts_are_not(spark):
    r = random.Random(7)
    items = [(k, " ".join(word(r) for _ in range(r.randint(14, 60)))) for k in range(60)]
    docs, want = [], set()
    for i in range(400):
        text = [word(r) for _ in range(r.randint(0, 300))]
        if i % 4 == 0:
            k = r.randrange(60)
            said = items[k][1].split()
            if i % 8 == 0:  # a fifth of the words replaced: recall rests on the answer or enough order
                for at in r.sample(range(len(said)), len(said) // 5):
                    said[at] = word(r)
            at = r.randint(0, len(text))
            text[at:at] = said
            want.add((i, k))
        docs.append((i, " ".join(text), "x"))
    odd = [(900, None, "x"), (901, "", "x"), (902, "12 34", "x"), (None, items[3][1], "x"), (903, "lorem ipsum " * 60000 + items[5][1].upper(), "x"), (904, items[5][1], "x"), (904, items[5][1], "x")]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, leaks string")
    bench = spark.createDataFrame(items + [(70, None), (71, "..."), (None, "")], "item_id long, text string")
    out = D.find_leaks(frame, bench).collect()
    assert len(out) == len(docs) + len(odd)
    got = {(o.doc_id, k.item_id) for o in out for k in o.leaks}
    assert {(None, 3), (903, 5), (904, 5)} <= got and not [g for g in got if g[0] in (900, 901, 902)]
    found = {g for g in got if g[0] is not None and g[0] < 900}
    assert found <= want, "clean texts are left alone"
    exact = {w for w in want if w[0] % 8}
    assert exact <= found and len(found) >= 0.9 * len(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert [o.leaks for o in D.find_leaks(docs, bench.limit(0)).collect()] == [[]]
    assert D.find_leaks(docs.limit(0), bench).count() == 0
    assert np.isfinite(D.idf_weights(docs.limit(0))).all()


def test_each_block_is_a_job_of_its_own(spark, monkeypatch):
    """Eight blocks give the leaks of one, without a chain of Python nodes in any stage."""
    r = random.Random(3)
    items = [(k, " ".join(word(r) for _ in range(20))) for k in range(40)]
    docs = [(i, " ".join([word(r) for _ in range(50)] + [items[(i + j) % 40][1] for j in range(i % 4)])) for i in range(120)] + [(None, None), (5, "")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    told = lambda df: sorted((o.doc_id or -1, o.text or "", sorted((k.item_id, k.lcs, k.answer) for k in o.leaks)) for o in df.collect())
    want = told(D.find_leaks(frame, bench))
    assert sum(len(x[2]) for x in want) >= 170
    plans, done = [], D.checkpoint
    monkeypatch.setattr(D, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or done(df))
    for limit in (1 << 18, 10):  # leaks that are broadcast, and more than that
        monkeypatch.setattr(D, "ITEM_BLOCK", 5)
        monkeypatch.setattr(D, "BROADCAST_LEAKS", limit)
        out = D.find_leaks(frame, bench)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert told(out) == want
    assert sum("MapInArrow" in p for p in plans) == 16 and max(p.count("MapInArrow") for p in plans) == 1


def test_places_of_items_are_kept_within_a_bound(monkeypatch):
    monkeypatch.setattr(D, "MASK_WORDS", 25)
    words = [np.arange(k, k + 10, dtype=np.uint64) << np.uint64(50) for k in range(8)]
    search = D.Search(D.Latent(np.ones(1 << D.BITS, np.float32), np.ones((1 << D.BITS, D.RANK), np.float32)), D.Items(list(range(8)), words, [set()] * 8))
    for k in [0, 1, 2, 1, 7, 0, 0]:
        assert search.mask(k) == {int(w): 1 << i for i, w in enumerate(words[k])}
        assert sum(len(m) for m in search.masks.values()) <= 25
