"""The near-copy stage against brute force on five-word shingles, 0.8 alike or more."""

import random

import corpus_pipeline
from .test_ngram_join import WORD, corpus


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def least_of_each(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, a in enumerate(sets):
        for y in range(x):
            if a and sets[y] and 100 * len(a & sets[y]) >= 80 * len(a | sets[y]):
                up[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted(least.values())


def test_stage_equals_brute_force_of_five_words(spark):
    r = random.Random(21)
    rows = [(i, t) for i, t in corpus(4)]
    for k in range(20):  # a fifth of new text appended: 0.83 of the shingles shared
        base = " ".join(f"b{r.randrange(10**6)}" for _ in range(104))
        rows += [(1000 + 2 * k, base), (1001 + 2 * k, base + " " + " ".join(f"n{r.randrange(10**6)}" for _ in range(20)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(x.doc_id for x in corpus_pipeline.one_of_each_group(spark, docs, "").collect())
    assert got == least_of_each(rows)
    assert not [i for i in got if i > 1000 and i % 2], "the lengthened copies go"
