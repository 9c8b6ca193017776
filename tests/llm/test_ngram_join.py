import random
import re

from tidelog.llm import ngram_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y in range(x):
            b = sets[y][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(s), least[find(x)]) for x, (i, s) in enumerate(sets))


def corpus(seed, hub=0):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    words = lambda n: [r.choice(vocab) for _ in range(n)]
    shared = words(30)
    made = [None, "", " \t", "one", "one two", "ONE two", "one two three", "a b c d", "A b\nc d", "a b c d e"]
    for _ in range(60):
        base = words(r.choice([5, 12, 40, 150]))
        made.append(" ".join(base))
        for _ in range(r.randint(0, 5)):
            other = base[:]
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                other[r.randrange(len(other))] = r.choice(vocab) + "x"
            made.append(" ".join(other))
    made += [" ".join(shared + words(20)) for _ in range(40)]
    if hub:
        base = words(100)
        made.append(" ".join(base))
        for _ in range(hub):  # near copies that link to the hub but seldom to each other, and chains
            other = base[:]
            for _ in range(r.choice([1, 2, 3, 4, 6])):
                at = r.randrange(len(other))
                other[at : at + 1] = [f"u{r.randrange(10**6)}"]
            made.append(" ".join(other))
    ids = list(range(len(made)))
    r.shuffle(ids)
    return list(zip(ids, made))


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert sorted(map(tuple, J.link_components(docs).drop("mark").collect())) == brute(rows)


def test_small_corpus_equals_brute_force(spark):
    check(spark, corpus(1))


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "LONG_LIST", 8)
    monkeypatch.setattr(J, "BLOCK", 16)
    check(spark, corpus(2, hub=150))


def test_without_frequency_order_links_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT", 0)
    monkeypatch.setattr(J, "LONG_LIST", 4)
    check(spark, corpus(3, hub=40))


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "a b c d e f"
    got = J.link_components(spark.createDataFrame([(5, text, 1), (5, text, 1), (None, text, 2), (9, text.upper(), 3), (None, None, 4)], "doc_id long, text string, cls int")).collect()
    assert sorted((g.doc_id or -1, g.n_shingles, g.component_id) for g in got if g.n_shingles) == [(-1, 3, 5), (5, 3, 5), (5, 3, 5), (9, 3, 5)]
    assert [(g.doc_id, g.component_id) for g in got if not g.n_shingles] == [(None, None)]
    assert J.link_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"w{k % 7919}" for k in range(200000))
    check(spark, [(1, long), (2, long + " end"), (3, "x y z q")])


def test_columns_of_any_name_do_not_meet_ours(spark):
    texts = ["a b c d e f g h i j", "a b c d e f g h i j", "k l m n o p", None]
    names = ["n_shingles", "component_id", "owner", "grams", "row", "n", "h1", "class_id", "list", "keep"]
    docs = spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in enumerate(texts)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = sorted((r.doc_id, r.component_id) for r in J.link_components(docs.select("doc_id", "text", *names)).select("doc_id", "component_id").collect())
    assert got == [(0, 0), (1, 0), (2, 2), (3, 3)]
    kept = J.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 3] and all(tuple(r)[2:] == ("x",) * len(names) for r in kept)
