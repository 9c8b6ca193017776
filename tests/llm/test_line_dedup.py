import random

import duckdb

from tidelog.llm.line_dedup import OP9_SQL, drop_shared_lines, op9_line_dedup


def test_shared_lines_nulls_and_repeats(spark):
    rows = [(1, None, "z"), (None, "a\nb", "z"), (None, "a\nb", "y"), (1, "", "q")] + [(i, f" A \nq{i}", "k") for i in range(10, 22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = drop_shared_lines(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.row): r for r in got}
    assert by[(1, "z")].kept_text == "" and by[(1, "z")].n_lines == 1 and by[(1, "z")].n_dropped == 0
    assert by[(None, "y")].kept_text == "b"
    assert by[(12, "k")].kept_text == "q12" and by[(12, "k")].n_dropped == 1


def test_threshold_counts_documents_not_lines(spark):
    docs = spark.createDataFrame([(i, "x\nx\nx") for i in range(9)], "doc_id long, text string")
    assert {r.n_dropped for r in drop_shared_lines(docs).collect()} == {0}
    docs = spark.createDataFrame([(i, "x\n\nX") for i in range(10)], "doc_id long, text string")
    assert {(r.n_dropped, r.kept_text) for r in drop_shared_lines(docs).collect()} == {(2, "")}


def test_empty_table(spark):
    assert drop_shared_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain(rows, min_docs=10):
    """(n_lines, n_dropped, kept text) of each row by the contract's words."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(("id", i) if i is not None else ("text", text))
    gone = {k for k, v in holders.items() if len(k) >= 1 and len(v) >= min_docs}
    out = []
    for _, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def made(seed):
    r = random.Random(seed)
    lines = ["", " ", "A", "a ", "\tÉ", "é", "Q\r", "q", "common", "rare"] + [f"l{k}" for k in range(30)]
    rows = [(r.choice([None, *range(25)]) if r.random() < 0.5 else 100 + i, r.choice([None, ""]) if r.random() < 0.05 else "\n".join(r.choices(lines, k=r.randint(1, 9)))) for i in range(160)]
    return rows + rows[:20] + [(7, "nine\nonly")] * 12 + [(None, "x y")] * 12 + [(200 + i, "y z\nlast") for i in range(9)] + [(None, f"y z\n{i}") for i in range(1)]


def test_against_brute_force_with_repeated_rows_and_null_ids(spark):
    for seed in (1, 2):
        rows = made(seed)
        got = drop_shared_lines(spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, drop int")).orderBy("drop").collect()
        assert [(g.n_lines, g.n_dropped, g.kept_text) for g in got] == plain(rows)


def test_sql_equals_query_on_repeated_rows(spark, tmp_path):
    rows = made(3)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_sha256) for r in op9_line_dedup(spark, str(tmp_path)).collect())
    want = sorted((i is None, i or 0, n, d, h) for i, n, d, h in db.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({OP9_SQL})").fetchall())
    assert got == want and len(got) == len(rows)


def test_clashing_names_and_long_texts(spark):
    names = ["doc_id", "text", "drop", "lines", "doc", "made", "marks", "row", "whole", "a", "n_lines"]
    long = "\n".join(f"line {k}" for k in range(200_000))
    rows = [(i, "same\n" + (long if i == 3 else str(i)), *[i] * 9) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names[2:]))
    got = {g.doc_id: g for g in drop_shared_lines(docs).collect()}
    assert got[3].n_lines == 200_001 and got[3].n_dropped == 1 and got[3].kept_text == long
    assert got[4].kept_text == "4" and got[4].drop == 4 and got[4].whole == 4 and got[4].n_lines == 2
