import hashlib
import random
import re

import pytest

from tidelog.llm import secret_scan as S

WORDS = "alpha beta gamma delta house river garden window silver morning winter letter number music paper stone bridge forest market summer".split()


def test_planted_secrets_are_found_and_look_alikes_are_not(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aeinorst") for _ in range(r.randint(3, 7)))
    prose = lambda: " ".join(word() for _ in range(12))
    h = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    rows, want = [], {}
    for i in range(300):
        kind = i % 6
        value, text = [(h(i), f'{prose()} token = "{h(i)}" {prose()}'), (h(i), f"{prose()} commit {h(i)} {prose()}"), (str(10**15 + i), f"{prose()} {10**15 + i} {prose()}"),
                       (f"{word()}/{word()}/part_{i:04d}.parquet", None), (h(i)[:32], f"{prose()} password: {h(i)[:32]} {prose()}"), (None, prose())][kind]
        rows.append((i, text or f"{prose()} {value} {prose()}"))
        if value and len(value) >= 16:
            want[(i, value)] = kind in (0, 4)
    odd = [(900, None), (901, ""), (None, f'x token = "{h(1)}"'), (902, f'token = "{h(2)}" ' * 2000), (902, f'token = "{h(2)}" ' * 2000)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    words = S.dictionary(docs)
    model = S.train(S.labelled_findings(docs), words)
    out = S.scan(docs, model, words).collect()
    got = {(o.doc_id, o.candidate): o for o in out}
    assert set(want) <= set(got)
    right = sum(got[k].is_secret == v for k, v in want.items())
    assert right >= 0.97 * len(want)
    texts = dict(rows)
    assert all(texts[i][got[i, c].start - 1 :].startswith(c) and got[i, c].length == len(c) for i, c in want)
    assert sum(o.is_secret for o in out if o.doc_id is not None and o.doc_id < 900 and not want.get((o.doc_id, o.candidate))) <= 3
    assert got[None, h(1)].is_secret and sum(o.doc_id == 902 for o in out) == 4000 and not any(o.doc_id in (900, 901) for o in out)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.createDataFrame([(i, " ".join(WORDS[(i * 7 + k * (1 + i % 5)) % len(WORDS)] for k in range(12))) for i in range(400)], "doc_id long, text string")
    words = S.checkpoint(S.dictionary(docs))
    return docs, words, S.train(S.labelled_findings(docs), words)


def test_every_place_in_its_own_context(spark, fitted):
    _, words, model = fitted
    h = hashlib.sha1(b"x").hexdigest()
    texts = [
        (f'commit {h} and later token = "{h}"', [(h, False), (h, True)]), (f'token = "{h}" and again token = "{h}"', [(h, True), (h, True)]),
        (f"see xx-{h} then password: {h}", [(f"xx-{h}", False), (h, True)]), ("garden password: hunter2secret9", [("hunter2secret9", True)]),
        ("passphrase: correct-horse-battery-staple.", [("correct-horse-battery-staple", True)]), ('password = "qwmzkrtvbxnp"', [("qwmzkrtvbxnp", True)]),
        ("postgres://admin:s3cr3tP4ss@host/db", [("s3cr3tP4ss", True)]), (f"my_api_key={h[:24]}", [(h[:24], True)]),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    out = S.scan(docs, model, words).orderBy("doc_id", "start").collect()
    for k, (_, want) in enumerate(texts):
        assert [(o.candidate, o.is_secret) for o in out if o.doc_id == k] == want, k
        assert all(texts[k][0][o.start - 1 : o.start - 1 + o.length] == o.candidate for o in out if o.doc_id == k)
        assert len({o.start for o in out if o.doc_id == k}) == len(want)


def test_candidates_against_brute_force(spark):
    """Every match of a plain scan, at its place, with what is around it."""
    r = random.Random(9)
    bits = ["é", " ", "\n", "token", "=", ": ", '"', "'", "abc12345", "x/y_9", "://u:", "@h", "pwd", "Bearer ", "zz99zz99zz", ".", "ünï", "-", "12345678"]
    rows = [(i, "".join(r.choices(bits, k=r.randint(1, 40)))) for i in range(600)] + [(7, None), (8, ""), (9, "😀 token: é😀éaaa1")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, candidate string")
    got = sorted((-1 if c.doc_id is None else c.doc_id, c.start, c.candidate) for c in S.candidates(docs).collect())
    want = []
    for i, t in rows:
        for m in re.finditer(S.CANDIDATE, t or "", re.ASCII):
            lead = (re.match(S.LEAD, m.group(), re.ASCII) or re.match("", "")).group()
            body = m.group()[len(lead) :]
            body = re.sub("[\"']$", "", body) if lead[-1:] in ("'", '"') and lead else re.sub(r"[.!?:]+$", "", body)
            if body:
                want.append((i, m.start() + len(lead) + 1, body))
    assert got == sorted(want) and len(want) > 300


def test_very_long_text(spark):
    """Fifty thousand candidates in one text, and one run of a million characters."""
    docs = spark.createDataFrame([(1, "key abcd1234 " * 50_000), (2, "a" * 1_000_000 + "1 " + "b" * 1_000_000)], "doc_id long, text string")
    got = S.candidates(docs).groupBy("doc_id").agg(S.F.count("*").alias("n"), S.F.max("start").alias("last"), S.F.max(S.F.length("candidate")).alias("size")).orderBy("doc_id").collect()
    assert [(g.n, g.last, g.size) for g in got] == [(50_000, 13 * 49_999 + 5, 8), (1, 1, 1_000_001)]


def test_held_out_kinds(spark, fitted):
    """Whole kinds of findings that the forest has not seen: their likes are judged right."""
    docs, words, _ = fitted
    made = S.checkpoint(S.labelled_findings(docs))
    right = {}
    for fold in range(4):
        kinds = sorted(k.kind for k in made.select("kind").distinct().collect())[fold::4]
        model = S.train(made.where(~S.F.col("kind").isin(kinds)), words, trees=20)
        ready = S.VectorAssembler(inputCols=S.FEATURES, outputCol="features").transform(S.features(made.where(S.F.col("kind").isin(kinds)), words))
        right |= {g.kind: g["right"] for g in model.transform(ready).groupBy("kind").agg(S.F.avg((S.F.col("prediction") == S.F.col("label")).cast("int")).alias("right")).collect()}
    assert sum(right.values()) / len(right) >= 0.75, right


def test_dictionary_counts_all_rows(spark):
    docs = spark.createDataFrame([(i, f"Über house{i} tree tree w{chr(97 + i)}w") for i in range(7)] + [(9, None)], "doc_id long, text string")
    assert {w.word for w in S.dictionary(docs, 5).collect()} == {"über", "tree"}


def test_held_out_findings(spark):
    docs = spark.createDataFrame([(i, f"alpha beta gamma delta {i}") for i in range(500)], "doc_id long, text string")
    words = S.dictionary(docs)
    model = S.train(S.labelled_findings(docs.where("doc_id % 5 > 0")), words)
    ready = S.VectorAssembler(inputCols=S.FEATURES, outputCol="features").transform(S.features(S.labelled_findings(docs.where("doc_id % 5 = 0")), words))
    out = model.transform(ready).selectExpr("avg(cast(prediction = label as int)) as right").first()
    assert out.right >= 0.97


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.scan(docs, S.train(S.labelled_findings(docs), S.dictionary(docs)), S.dictionary(docs)).count() == 0


def test_features_equal_plain_counts(spark):
    known = {"river", "stone", "paper"}
    found = [
        ("Abc123-river_STONE", 'api_key = "', '" next'), ("deadbeef00112233", "commit ", " x"), ("river stone paper!", "passphrase: '", "'"), ("a/b/c.d-e_9", "see ", ""),
        ("aaaa1111", "", None), ("ÄäÖ9x", None, " y"), ("s3cret!", "http://u:", "@host"), ("xriver9", "token: ", "."),
    ]
    rows = spark.createDataFrame([(i, *f) for i, f in enumerate(found)], "i int, candidate string, before string, after string")
    got = {r.i: r for r in S.features(rows, spark.createDataFrame([(w,) for w in known], "word string")).collect()}
    for i, (c, before, after) in enumerate(found):
        n, near, behind = len(c), ((before or "") + " ").lower(), after or ""
        kind = ["a" if x.islower() else "A" if x.isupper() else "0" if x in "0123456789" else x for x in c]
        want = {
            "length": n, "transitions": sum(a != b for a, b in zip(kind, kind[1:])) / n, "digits": sum(x in "0123456789" for x in c) / n, "uppers": sum("A" <= x <= "Z" for x in c) / n,
            "hex": bool(re.fullmatch("[0-9a-fA-F]+", c)), "distinct": len(set(c)) / n, "dictionary": sum(len(w) for w in re.findall(r"[^\W\d_]{3,}", c.lower()) if w in known) / n,
            "slashes": c.count("/") / n, "dots": sum(x in ".-" for x in c) / n, "spaces": c.count(" ") / n,
            "assigned": bool(re.search(r"[=:]\s*[\"']?\s*$", near)), "quoted": near[-2:-1] in ("\"", "'") and near != " " and behind[:1] in ("\"", "'") and behind != "",
            "in_url": bool(re.search(r"://[^\s/:@]*: $", near)) and behind.startswith("@"),
        }
        for name, value in want.items():
            assert got[i][name] == pytest.approx(float(value), abs=1e-12), (c, name)
    assert [got[i].credential for i in range(8)] == [1, 0, 1, 0, 0, 0, 0, 1] and [got[i].harmless for i in range(8)] == [0, 1, 0, 0, 0, 0, 0, 0]
