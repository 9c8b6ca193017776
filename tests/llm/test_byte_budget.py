"""What a model is fitted on has a bound in bytes, by whole rows."""

from tidelog.llm import quality_model, toxicity
from tidelog.llm.common import within_bytes


def test_rows_are_taken_whole_until_the_bytes_are_full(spark):
    rows = [(i, bytes(10 + i % 7), bytes(5)) for i in range(300)] + [(500, bytes(5000), b""), (None, b"", b"")]
    df = spark.createDataFrame(rows, "doc_id long, x binary, w binary").repartition(3)
    kept = within_bytes(df, ["x", "w"], 2000).collect()
    assert 1900 < sum(len(r.x) + len(r.w) for r in kept) <= 2000 and all(len(r.x) == 10 + r.doc_id % 7 for r in kept)
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in within_bytes(df.repartition(5), ["x", "w"], 2000).collect())
    assert within_bytes(df, ["x", "w"], 1 << 30).count() == 301 and within_bytes(df.limit(0), ["x"], 10).count() == 0


def test_models_are_fitted_within_it(spark, monkeypatch):
    words = ["good words here", "bad # $ words"]
    docs = spark.createDataFrame([(i, f"{words[i % 2]} {i}\n" * 20) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    seen = []
    for module in (quality_model, toxicity):
        monkeypatch.setattr(module, "TRAIN_BYTES", 4_000)
        monkeypatch.setattr(module, "within_bytes", lambda df, c, most: seen.append((df.count(), within_bytes(df, c, most).count())) or within_bytes(df, c, most))
        module.train(docs, labels)
    assert len(seen) == 2 and all(0 < kept < all_ for all_, kept in seen), seen
