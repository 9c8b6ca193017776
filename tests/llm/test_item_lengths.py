"""Benchmark items of any length are found where a document holds them."""

import random

import pytest

from tidelog.llm import decontaminate as D

from .test_decontaminate import word


@pytest.mark.parametrize("size", [1, 3, 5, 10, 100, 200, 1000])
def test_items_of_this_length_are_found(spark, size):
    r = random.Random(size)
    common = [word(r) for _ in range(300)]
    prose = lambda n: [r.choice(common) if r.random() < 0.5 else word(r) for _ in range(n)]
    # Apart from the corpus' common words, so that no clean text holds a short item by chance.
    items = [(k, " ".join("z" + word(r) for _ in range(size))) for k in range(8)] + [(20 + k, " ".join(prose(r.randint(20, 50)))) for k in range(30)]
    docs, want = [], set()
    for i in range(160):
        text = prose(r.randint(0, 400))
        if i % 4 == 0:
            at = r.randint(0, len(text))
            text[at:at] = items[i // 4 % 8][1].split()
            want.add((i, i // 4 % 8))
        docs.append((i, " ".join(text)))
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(o.doc_id, k.item_id) for o in found.collect() for k in o.leaks} == want


def test_a_fifth_of_a_long_item_replaced(spark):
    r = random.Random(5)
    items = [(k, " ".join(word(r) for _ in range(300))) for k in range(10)]
    docs, want = [], set()
    for i in range(60):
        said = items[i % 10][1].split()
        for at in r.sample(range(300), 60):
            said[at] = word(r)
        docs.append((i, " ".join([word(r) for _ in range(r.randint(0, 200))] + said)))
        want.add((i, i % 10))
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(o.doc_id, k.item_id) for o in found.collect() for k in o.leaks} == want


@pytest.mark.parametrize("share", [0.0, 0.25], ids=["verbatim", "quarter_replaced"])
def test_recall_against_brute_force_over_all_lengths(spark, share):
    """Items of 4 to 2000 words in one benchmark; what a scan of every pair of text and item says."""
    r = random.Random(17)
    common = [word(r) for _ in range(400)]
    prose = lambda n: [r.choice(common) if r.random() < 0.4 else word(r) + word(r) for _ in range(n)]
    lengths = [4, 8, 30, 100, 300, 2000]
    items = [(100 * k + i, [word(r) + "q" + word(r) if r.random() < 0.7 else r.choice(common) for _ in range(n)]) for k, n in enumerate(lengths) for i in range(12 if n < 2000 else 4)]
    docs, planted = [], set()
    for i, (k, words) in enumerate([x for x in items for _ in range(4 if len(x[1]) < 2000 else 2)]):
        said = list(words)
        for at in r.sample(range(len(said)), int(share * len(said))):
            said[at] = word(r) + "z" + word(r)
        before = prose(r.randint(0, 200))
        docs.append((i, before + said + prose(r.randint(0, 200))))
        planted.add((i, k))
    docs += [(1000 + i, prose(r.randint(0, 300))) for i in range(60)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    found = {(o.doc_id, k.item_id) for o in D.find_leaks(frame, bench).collect() for k in o.leaks}
    brute = set()
    for k, words in items:
        masks = {}
        for i, w in enumerate(words):
            masks[w] = masks.get(w, 0) | 1 << i
        brute |= {(i, k) for i, text in docs if sum(w in masks for w in text) >= 0.75 * len(words) and D.lcs(masks, len(words), text) >= 0.75 * len(words)}
    assert planted <= brute
    by = {n: [p for p in planted if p[1] // 100 == k] for k, n in enumerate(lengths)}
    recall = {n: sum(p in found for p in pairs) / len(pairs) for n, pairs in by.items()}
    assert min(recall.values()) >= 0.95, recall
    assert len(found & brute) >= 0.95 * len(brute) and len(found - brute) <= 0.02 * len(found)


def test_blocks_of_items_and_slices_of_cosines_change_nothing(spark, monkeypatch):
    r = random.Random(4)
    items = [(k, " ".join(word(r) for _ in range(r.randint(6, 80)))) for k in range(40)]
    docs = [(i, " ".join([word(r) for _ in range(r.randint(0, 90))] + items[i % 40][1].split())) for i in range(80)]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    leaks = lambda: sorted((o.doc_id, sorted(k.item_id for k in o.leaks)) for o in D.find_leaks(frame, bench).collect())
    once = leaks()
    assert all(i % 40 in ids for i, ids in once)
    monkeypatch.setattr(D, "ITEM_BLOCK", 7)
    monkeypatch.setattr(D, "AT_ONCE", 50)
    assert leaks() == once
