import random

import duckdb

from tidelog.llm import url_filter as U
from tidelog.llm.url_filter import RULES, judge

RULE = "host string, path string, verdict string"


def run(spark, rows, rules=RULES, redirects=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule int")
    return {r.page_id: r for r in judge(pages, spark.createDataFrame(rules, RULE), redirects).collect()}


def test_rules_longest_wins_and_bad_urls(spark):
    got = run(spark, [(1, "http://X.Example.com/en/71?q", "", 0), (2, "http://a.com/en/7", "", 0), (3, "http://b.example.net/de/8#x", "", 0),
                      (4, None, None, 0), (5, "no url", "", 0), (6, "ftp://example.org/es/", None, 0), (7, "x://notexample.com/en/7", "", 0), (7, "x://notexample.com/en/7", "", 0)])
    assert {k: (r.rule, r.verdict) for k, r in got.items()} == {
        1: ("example.com/en/7", "allow"), 2: ("com/en/", "block"), 3: ("example.net/de/8", "block"), 4: (None, "allow"),
        5: (None, "allow"), 6: ("org/es/", "block"), 7: ("com/en/", "block")}
    assert got[1].host == "x.example.com" and got[1].path == "/en/71" and got[4].host == "" == got[5].path


def test_blocks_reach_aliases_and_allows_come_first(spark):
    link = '<link rel="canonical" href="%s">'
    fresh = '<meta http-equiv="refresh" content="0; url=%s">'
    rows = [(1, "http://a.io/1", link % "http://bad.com/en/x", 0), (2, "http://b.io/2", fresh % "http://a.io/1", 0), (3, "http://c.io/3", "", 0),
            (4, "http://d.io/4", link % "http://example.com/en/7", 0), (5, "http://e.io/dir/5", link % "http://bad.com/en/y", 0), (6, "http://e.io/6", link % "/dir/5", 0),
            (7, "https://d.io/4#top", link % "http://bad.com/en/z", 0)]
    redirects = spark.createDataFrame([("http://c.io/3", "http://b.io/2"), (None, "x")], "from_url string, to_url string")
    got = run(spark, rows, redirects=redirects)
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "block", 7: "allow"}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_urls_without_a_scheme_have_no_aliases(spark):
    rows = [(1, "example.com/en/1", '<link rel="canonical" href="http://example.com/en/1">'), (2, "http://example.com/en/1", None), (3, "http://a.test/", '<link rel="canonical" href="example.com/en/1">')]
    moved = spark.createDataFrame([("nowhere", "http://example.com/en/1"), ("http://b.test/", "example.com/en/1")], "from_url string, to_url string")
    rules = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    got = {g.page_id: g for g in U.judge(spark.createDataFrame(rows + [(4, "nowhere", "")], "page_id long, url string, html string"), rules, moved).collect()}
    assert [got[i].verdict for i in (1, 2, 3, 4)] == ["allow", "block", "allow", "allow"] and got[1].host == got[1].path == ""


def test_equally_long_rules_and_clashing_names(spark):
    """Allow wins a tie; the input's columns keep their values."""
    rules = spark.createDataFrame([("a.test", "/x", "block"), ("a.test", "/x", "allow"), ("test", "/x/lo", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.test/x/y", "", "n", "c", "b"), (2, "http://b.a.test/x/loud", None, "n", "c", "b"), (3, None, None, "n", "c", "b")], "page_id long, url string, html string, node string, component string, best string")
    got = {g.page_id: g for g in U.judge(pages, rules).collect()}
    assert (got[1].verdict, got[1].rule, got[2].verdict, got[3].verdict) == ("allow", "a.test/x", "block", "allow") and got[2].rule == "test/x/lo"
    assert all((g.node, g.component, g.best) == ("n", "c", "b") for g in got.values())


def test_sql_equals_query_on_linked_pages(spark, tmp_path):
    r = random.Random(6)
    hosts = ["example.com", "www.Example.com", "example.net", "x.org", "free.test", "y.test"]
    urls = [f"{r.choice(['http', 'https'])}://{r.choice(hosts)}/{r.choice(['en', 'de', 'es', 'q'])}/{r.randint(1, 9)}{r.choice(['', '?a=1', '#top'])}" for _ in range(150)] + [None, "example.com/en/1", "nothing"]
    link = lambda: r.choice(["", f'<p><LINK rel="canonical" href="{r.choice(urls[:150])}">', f'<link rel=canonical href="/{r.choice(["en", "de", "q"])}/{r.randint(1, 9)}">', f'<meta http-equiv="refresh" content="0; url={r.choice(urls[:150])}">', '<link rel="canonical" href="7">', "//x"])
    spark.createDataFrame([(i, u, link()) for i, u in enumerate(urls + urls[:20])], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(map(str, U.op10_url_filter(spark, str(tmp_path)).select(*names).toPandas().astype(str).values.tolist()))
    want = sorted(map(str, db.execute(f"SELECT {', '.join(names)} FROM ({U.OP10_SQL})").df().astype(str).replace("nan", "None").values.tolist()))
    assert got == want and sum("block" in g for g in got) > 20


def test_very_long_pages_are_read_whole(spark):
    filler = "<p>" + "lorem ipsum < > ' \" " * 100_000
    rows = [(1, "http://a.io/1", filler + '<link rel="canonical" href="http://bad.com/en/x">', 0), (2, "http://a.io/2", filler + "<link rel=", 0), (3, "http://a.io/" + "y" * 100_000, "", 0)]
    assert {k: r.verdict for k, r in run(spark, rows).items()} == {1: "block", 2: "allow", 3: "allow"}
