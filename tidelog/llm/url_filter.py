"""URL block and allow rules that also hold for redirects and canonical links of the same page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, table
from .line_dedup import LOWER, UPPER

#: Rules of the registered query: host, path, verdict.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: Up to so many rules their table is broadcast; beyond, the join shuffles.
BROADCAST_RULES = 50_000


def url_host(url):
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_node(url):
    """What names the same resource whatever the scheme and the fragment: host, path and query. A url
    without a scheme stands for itself; no other node has a `#`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(url_host(url), rest)).otherwise(F.concat(F.lit("#"), url))


def link_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and immediate meta redirects found in the html of pages whose url
    has a scheme; relative targets are resolved against it."""
    tag = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
    meta = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
    canonical = F.regexp_extract(F.regexp_extract("html", tag, 0), r"(?is)\bhref\s*=\s*[\"']?([^\"'>\s]+)", 1)
    refresh = F.regexp_extract(F.regexp_extract("html", meta, 0), r"(?is)\burl\s*=\s*[\"']?([^\"'>\s;]+)", 1)
    found = pages.where("contains(url, '://')").select("url", F.explode(F.array(canonical, refresh)).alias("target")).where("target <> ''")
    scheme = F.concat(F.regexp_extract("url", r"(?s)^(.*?)://", 1), F.lit(":"))
    base = F.concat(scheme, F.lit("//"), url_host(F.col("url")))
    whole = (
        F.when(F.col("target").contains("://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(scheme, F.col("target")))
        .when(F.col("target").startswith("/"), F.concat(base, F.col("target")))
        .otherwise(F.concat(base, F.regexp_extract(url_path(F.col("url")), r"(?s)^(.*/)?", 0), F.col("target")))
    )
    return found.select("url", whole.alias("target")).where("contains(target, '://')")


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url) distinct and not null -> (url, rule, verdict) of the longest fitting rule.

    A rule fits its host and all subdomains where the path starts with the rule's. Equally long
    rules: allow wins, then the lesser text. The host's suffixes meet the rules' hosts by an equal
    join; the best of a url is found by an aggregation with map-side combine.
    """
    n = rules.count()
    r = rules.select(F.translate("host", UPPER, LOWER).alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("rule_verdict")).distinct()
    r = F.broadcast(r) if n <= BROADCAST_RULES else r
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fit = (
        urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .select("url", "path", F.explode(suffixes).alias("suffix"))
        .join(r, "suffix")
        .where(F.expr("startswith(path, prefix)"))
        .select("url", F.struct(F.char_length(F.concat("suffix", "prefix")).alias("length"), (F.col("rule_verdict") == "allow").alias("allow"), F.concat("suffix", "prefix").alias("rule"), F.col("rule_verdict").alias("verdict")).alias("best"))
    )
    return fit.groupBy("url").agg(F.max("best").alias("best")).select("url", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule, verdict to pages (page_id, url, html; other columns stay).

    A page whose url a rule fits takes that rule's verdict. Any other page takes the verdict of its
    aliases: the urls joined to it by canonical links, meta redirects and the given redirects
    (from_url, to_url), in either direction and over any number of steps. One alias with an explicit
    allow makes it allow; else one with a block makes it block; else it is allowed. A null url and
    one without `://` have empty host and path, fit no rule with a path and have no aliases, whatever
    their html or the redirects say. Null html has no links. Repeated urls share a verdict; every input
    row comes back, with its other columns whatever their names.
    """
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("from_url"), F.col("to_url")).where("contains(from_url, '://') and contains(to_url, '://')"))
    ends = edges.select(url_node(F.col("url")).alias("a"), url_node(F.col("target")).alias("b"))
    groups = components(ends)
    urls = pages.select("url").where("url is not null").union(edges.select("target")).union(edges.select("url")).distinct()
    ruled = rule_of(urls, rules)
    known = urls.join(ruled, "url", "left").withColumn("node", url_node(F.col("url")))
    grouped = known.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = (
        grouped.where("verdict is not null")
        .groupBy("component")
        .agg(F.when(F.bool_or(F.col("verdict") == "allow"), F.lit("allow")).otherwise("block").alias("of_group"))
    )
    decided = grouped.join(spread, "component", "left").select(
        F.col("url").alias("known_url"), F.col("rule").alias("own_rule"), F.coalesce("verdict", "of_group", F.lit("allow")).alias("own_verdict")
    )
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    left = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("page"))
    out = left.join(decided, F.col("page.url") == F.col("known_url"), "left")
    return out.select(
        "page.*", url_host(F.col("page.url")).alias("host"), url_path(F.col("page.url")).alias("path"),
        F.col("own_rule").alias("rule"), F.coalesce("own_verdict", F.lit("allow")).alias("verdict"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH RECURSIVE
links AS (
  SELECT url, CASE WHEN contains(t.target, '://') THEN t.target WHEN starts_with(t.target, '//') THEN scheme || t.target
                   WHEN starts_with(t.target, '/') THEN scheme || '//' || host || t.target ELSE scheme || '//' || host || regexp_extract(path, '(?s)^(.*/)?', 0) || t.target END AS target FROM (
    SELECT url, regexp_extract(url, '(?s)^(.*?)://', 1) || ':' AS scheme,
      translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, unnest([
      regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0), '(?is)\bhref\s*=\s*["'']?([^"''>\s]+)', 1),
      regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0), '(?is)\burl\s*=\s*["'']?([^"''>\s;]+)', 1)]) AS target
    FROM pages WHERE contains(url, '://')) t WHERE t.target <> ''),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT target FROM links UNION SELECT url FROM links),
parts AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest FROM urls),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
ruled AS (
  SELECT p.url, p.host, p.path, CASE WHEN contains(p.url, '://') THEN p.host || p.rest ELSE '#' || p.url END AS node,
         arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM parts p LEFT JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
  GROUP BY ALL),
edges AS (SELECT a.node AS x, b.node AS y FROM links JOIN ruled a ON a.url = links.url JOIN ruled b ON b.url = links.target
          UNION SELECT b.node, a.node FROM links JOIN ruled a ON a.url = links.url JOIN ruled b ON b.url = links.target),
reach(x, y) AS (SELECT node, node FROM ruled UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
spread AS (SELECT reach.x AS node, CASE WHEN bool_or(rverdict = 'allow') THEN 'allow' ELSE 'block' END AS v
           FROM reach JOIN ruled ON reach.y = ruled.node WHERE rverdict IS NOT NULL GROUP BY 1)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(rverdict, v, 'allow') AS verdict
FROM pages LEFT JOIN ruled USING (url) LEFT JOIN spread USING (node)
"""
