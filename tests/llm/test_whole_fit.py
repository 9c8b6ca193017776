import random

import numpy as np

from tidelog.llm import language_id as L

WORDS = {"aa": ["the", "and", "thing", "over", "shed"], "bb": ["über", "schön", "nicht", "keit", "ung"]}


def test_every_row_is_learnt_from_in_whatever_order(spark, monkeypatch):
    """No sample is drawn, a language of two rows is learnt, and rows sorted by language do no harm."""

    def no_sample(*_, **__):
        raise AssertionError("a sample was drawn")

    monkeypatch.setattr(L, "sample_by_id", no_sample)
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(WORDS["aa" if i < 2500 else "bb"]) for _ in range(r.randint(5, 40))), "aa" if i < 2500 else "bb") for i in range(5000)]
    rows += [(10_000 + i, "zkryzw mlpqyk", "cc") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    assert model.langs == ["aa", "bb", "cc"]
    got = L.identify(docs, model).where("lang <> 'cc'").collect()
    assert np.mean([g.lang == g.lang_pred for g in got]) >= 0.98
