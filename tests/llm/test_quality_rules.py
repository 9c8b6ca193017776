import random
import re
from collections import Counter

from tidelog.llm.quality_rules import RULES, apply_rules, by_worth, order_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(wins)
    marked = {i + k for i, w in enumerate(wins) if often[w] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), n < 20 or 100 * len(marked) > 30 * n


def texts():
    r = random.Random(5)
    made = [None, "", " ", "\n\n", "a", "a\nb\na\n\na ", " x y é|é", "x" * 5000, "w " * 70000]
    for _ in range(150):
        vocab = [r.choice(["é", "b", "cc#", " ", "D", "7"]) * r.randint(1, 3) for _ in range(r.randint(1, 6))]
        made.append("".join(r.choice(vocab) + r.choice([" ", "\n", "\t", " \r\n", "\x0b", "\x1c"]) for _ in range(r.randint(0, 120))))
    return made


def test_counts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows] + [(3, "twice", 1), (3, "twice", 1), (None, "x", 1)], "doc_id long, text string, kept int").repartition(3)
    got = apply_rules(docs).collect()
    assert len(got) == len(rows) + 3
    by = {r.doc_id: r for r in got if r.doc_id not in (3, None)}
    for i, t in rows:
        if i != 3:
            assert tuple(by[i])[1:7] == brute(t), (i, t)
            assert not (by[i].kept and by[i].base_failed)


def brute_kept(text):
    """The verdict rule by rule, without a cascade."""
    text = text or ""
    n, chars, symbols, dup, _, failed = brute(text)
    words = WORD.findall(text)
    lower = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
    letter = lambda w: bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w))
    bad = [
        symbols > 0.1 * n, dup > max(2, 0.3 * len(text.split("\n"))), chars < 2 * n or chars > 15 * n, len(re.findall("[A-Z]", text)) > 0.5 * max(1, len(re.findall("[A-Za-z]", text))),
        sum(not letter(w) for w in words) > 0.3 * n, sum(w.endswith("!") and len(w.encode()) > 1 for w in words) > 0.3 * n, sum(a == b for a, b in zip(lower, lower[1:])) > 0.2 * n,
    ]
    return not failed and not any(bad)


def test_kept_equals_brute_force(spark):
    r = random.Random(8)
    plain = [f"{a}{b}" for a in "bcdfg" for b in ("arn", "est", "ILL", "öt", "ump", "iss")]
    odd = ["#", "&x", "|", "7", "12", "NO!", "Wow!", "a", "Q" * 30, "ha", "ha", "\n", "\n"]
    made = [" ".join(r.choice(plain if r.random() > share else odd) for _ in range(r.randint(15, 80))) for share in (0.0, 0.1, 0.2, 0.4, 0.7) for _ in range(60)]
    made += ["\n".join(r.choice(["one two three", "four five", "six seven eight nine", ""]) for _ in range(r.randint(5, 20))) for _ in range(60)]
    got = {g.doc_id: g.kept for g in apply_rules(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    want = {i: brute_kept(t) for i, t in enumerate(made)}
    assert got == want and 30 < sum(want.values()) < len(made) - 30


def test_rules_are_ordered_by_what_is_left():
    """The second rule rejects all that the first does, so the first is worth nothing after it."""
    assert by_worth([1.0, 1.0, 2.0], {0b011: 10, 0b010: 1, 0b100: 6}) == [1, 2, 0]
    assert by_worth([3.0, 1.0], {}) == [1, 0]


def test_junk_goes_and_clean_stays_whatever_the_order(spark):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} of" for i in range(60))
    junk = [" | ".join(clean.split()), clean.replace(" ", "### "), clean.upper().replace(" ", "!! "), " ".join(w for w in clean.split()[::2] for _ in range(4)), "\n".join(["Terms apply here"] * 9 + [clean])]
    docs = spark.createDataFrame(list(enumerate([clean, *junk])), "doc_id long, text string")
    for rules in (RULES, RULES[::-1]):
        assert [r.kept for r in sorted(apply_rules(docs, rules).collect())] == [True] + [False] * len(junk)
    assert sorted(r.name for r in order_rules(docs, RULES)) == sorted(r.name for r in RULES)


def test_empty_table(spark):
    assert apply_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
