"""The pipeline against plain versions of its stages on a small corpus."""

import random
from collections import defaultdict

import corpus_pipeline
from .test_mixing import reshared
from .test_ngram_join import brute


def corpus():
    r = random.Random(9)
    vocab = {"aa": [f"th{x}ing" for x in "abcdefghijklmnopqrstuvwxy"], "bb": [f"ü{x}keit" for x in "abcdefghijklmnopqrstuvwxy"]}
    bench = [(k, " ".join(r.choice(vocab["aa"]) + str(r.choice("abc")) for _ in range(25))) for k in range(5)]
    rows = []
    for i in range(240):
        lang = r.choice(["aa", "bb"])
        words = [r.choice(vocab[lang]) + r.choice("abcdefgh") for _ in range(r.randint(30, 90))]
        text = " ".join(words)
        if i % 11 == 0:
            text = bench[i % 5][1] + " " + text
        if i % 6 == 0:
            text = "Shared footer line\n" + text
        rows.append((i, text, lang, r.choice(["s0", "s1", None]), len(text)))
        if i % 9 == 0:
            rows.append((1000 + i, text + " tail", lang, "s2", len(text) + 5))
    rows += [(5000, None, "aa", "s0", 0), (5001, "", "bb", "s0", 0), (5002, "12 34", "aa", "s1", 5)]
    return rows, bench


def test_stages_follow_their_plain_versions(spark, tmp_path):
    rows, bench = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "decontaminate", "source_mix"]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = now.collect()
        now = stage(spark, now, str(tmp_path))
        if name != "source_mix":
            assert now.columns == columns
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        after = now.collect()
        seen[name] = (before, after)
    ids = lambda rows: {r.doc_id for r in rows}
    before, after = seen["language_id"]
    assert ids(before) - ids(after) == {5000, 5001, 5002}
    before, after = seen["line_dedup"]
    holders = sum("Shared footer line" in r.text for r in before)
    assert holders >= 10 and ids(before) == ids(after) and not any("Shared footer line" in r.text for r in after)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = seen["ngram_join"]
    assert ids(after) == {i for i, _, c in brute([(r.doc_id, r.text) for r in before]) if i == c} and len(after) == len(ids(after))
    before, after = seen["decontaminate"]
    assert ids(after) == {r.doc_id for r in before if not any(t in r.text for _, t in bench)}
    before, after = seen["source_mix"]
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in after:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert ids(after) == ids(before)
    want = reshared(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= max(2, 0.005 * want[s]) for s in sizes)
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, after))


def test_repeated_rows_null_ids_and_extra_columns(spark, tmp_path):
    """Extra columns stay to the last stage; of repeated rows one stays; the benchmark is caught."""
    rows, bench = corpus()
    rows = [(*r, k, "x", None, "l") for k, r in enumerate(rows[:150] + rows[:20] + [(None, *r[1:]) for r in rows[30:36]])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, doc string, lang_score double, leaks string"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.checkpoint(stage(spark, now, str(tmp_path)))
        assert now.schema.names == docs.schema.names
        if name in ("language_id", "line_dedup"):
            assert now.count() == before.count()
    ids = [r.doc_id for r in now.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 20 < len(ids) < 150
    assert all((r.doc, r.lang_score, r.leaks) == ("x", None, "l") for r in now.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() == len(ids)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c d")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
