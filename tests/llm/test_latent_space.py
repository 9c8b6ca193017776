import random

import numpy as np

from tidelog.llm import decontaminate as D


def test_products_are_over_the_passages_of_all_texts(spark):
    """A^T (A base) of every passage, however many texts and tasks there are."""
    r, rng = random.Random(6), np.random.default_rng(7)
    texts = [" ".join("".join(r.choices("abcdefg", k=4)) for _ in range(r.randint(0, 90))) for _ in range(1500)] + [None, "", "12"]
    idf, base = rng.random(1 << D.BITS).astype(np.float32) + 1, rng.normal(size=(1 << D.BITS, D.RANK)).astype(np.float32)
    want, n = np.zeros(base.shape), 0
    for text in texts:
        buf = np.frombuffer((text or "").encode(), np.uint8)
        buckets = D.bucket_of(D.words_of(buf, np.array([0, len(buf)]))[0])
        for k in range(0, len(buckets), 32):
            at, times = np.unique(buckets[k : k + 32], return_counts=True)
            w = np.concatenate([[idf[b]] * t for b, t in zip(at, times, strict=True)])
            w = np.repeat(idf[at], times) / np.sqrt((w**2).sum())
            np.add.at(want, np.repeat(at, times), w[:, None] * (w @ base[np.repeat(at, times)]))
            n += 1
    got = D._multiplied(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), idf, base)
    assert np.allclose(got, want / n, atol=1e-5)
