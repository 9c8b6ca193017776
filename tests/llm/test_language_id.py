import random

import numpy as np

from tidelog.llm import language_id as L

WORDS = {"aa": ["the", "and", "thing", "over", "shed"], "bb": ["über", "schön", "nicht", "keit", "ung"]}


def make(lang, r):
    return " ".join(r.choice(WORDS[lang]) for _ in range(r.randint(5, 60)))


def test_held_out_accuracy_and_undetermined(spark):
    r = random.Random(2)
    rows = [(i, make(lang := r.choice(["aa", "bb"]), r), lang if i % 17 else None) for i in range(600)]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 …!", "bb"), (None, "the thing", "aa"), (1003, "schön " * 50000, None), (1003, "schön " * 50000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = L.identify(docs, L.train(docs, rows=400)).withColumn("held", L.held_out()).collect()
    assert len(got) == len(rows) + len(odd)
    known = [g for g in got if g.held and g.lang and g.doc_id is not None and g.doc_id < 1000]
    assert len(known) > 50 and sum(g.lang == g.lang_pred for g in known) >= 0.98 * len(known)
    by = {g.doc_id: g for g in got}
    assert {by[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and not any(by[i].lang_accepted for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "bb" and by[1003].lang_accepted and by[None].lang_pred == "aa"
    assert all(0 <= g.lang_score <= 1 for g in got)


def test_unlearnt_language_is_rejected_and_learnt_ones_are_not(spark):
    """The threshold comes from calibration rows: languages that were learnt pass, others don't."""
    r = random.Random(3)
    rows = [(i, make(lang := r.choice(["aa", "bb"]), r), lang, "x", 0.5) for i in range(3000)]
    other = ["zkryzw", "mlpqyk", "dźwięk", "wjqzxy", "pszczoła", "kwxyzq"]
    odd = [(5000 + i, " ".join(r.choice(other) for _ in range(r.randint(5, 40))), None, "x", 0.5) for i in range(60)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, lang_score double")
    model = L.train(docs, rows=2000)
    got = L.identify(docs, model).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "source", "lang_pred", "lang_score", "lang_accepted"}
    assert sum(g.lang_accepted for g in got if g.doc_id >= 5000) <= 3
    assert sum(not g.lang_accepted for g in got if g.doc_id < 5000) <= 0.01 * 3000
    assert model.least > 0.5


def test_repeated_ids_are_learnt_once(spark):
    """A hot id doesn't swell the sample that is fitted on; every one of its rows is scored."""
    r = random.Random(5)
    rows = [(i, make(lang := r.choice(["aa", "bb"]), r), lang) for i in range(200)] + [(7, "über schön nicht", "bb")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.sample_by_id(docs, 10**6).count() == 200
    assert L.identify(docs, L.train(docs)).where("doc_id = 7 and lang_pred = 'bb'").count() >= 300


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = L.train(docs)
    assert [g.lang_pred for g in L.identify(docs, model).collect()] == ["und"]
    assert L.identify(docs.limit(0), model).count() == 0


def test_logits_equal_plain_averages():
    """Every 3- and 4-gram of bytes without an inner break, averaged over the whole text."""
    r, rng = random.Random(3), np.random.default_rng(4)
    texts = ["", "a", "ab", "abc", "Ab1c", "é", "x y z", "üüü 12 Aa-bb"] + ["".join(r.choices("abZé .1\n", k=r.randint(1, 40))) for _ in range(60)]
    model = L.LanguageModel(["p", "q", "s"], rng.normal(size=(1 << L.BITS, 3)), rng.normal(size=3), 1.0, 0.0)

    def plain(text):
        data = [b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in text.encode()]
        rows = []
        for n in (3, 4):
            for i in range(len(data) - n + 1):
                if 0x20 not in data[i + 1 : i + n - 1]:
                    code = sum(b << 8 * k for k, b in enumerate(data[i : i + n]))
                    mixed = (code * 0x9E3779B1 + (n * 0x85EBCA6B & 0xFFFFFFFF)) & 0xFFFFFFFF
                    rows.append(model.table[(mixed * 0xC2B2AE35 & 0xFFFFFFFF) >> 32 - L.BITS])
        return (np.mean(rows, axis=0) if rows else np.zeros(3)) + model.bias

    data = [t.encode() for t in texts]
    got = model.logits(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    assert np.allclose(got, [plain(t) for t in texts])


def test_threshold_of_many_and_of_few_rows():
    scores = 1 / (1 + np.exp(-np.random.default_rng(1).normal(6, 1, 100_000)))
    assert 0.0005 <= (scores < L.threshold(scores)).mean() <= 0.0011
    few = [L.threshold(scores[k : k + 40]) for k in range(0, 20_000, 40)]
    assert np.mean([(scores < x).mean() for x in few]) < 0.004
