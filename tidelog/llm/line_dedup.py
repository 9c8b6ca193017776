"""Lines that many documents share: explode, hash, count documents, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line):
    """The line without space and \\t..\\r at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Adds n_lines, n_dropped and kept_text (the other columns stay as they are).

    A line's key (see line_key) of at least min_chars code points that at least min_docs documents
    hold loses all its lines in every row. Rows of one id are one document, whatever their texts; rows
    of null id are one document for each different text. A null or empty text is one empty line, which
    is never dropped. Repeated rows, null and repeated ids each come back. Columns of the input keep
    their names, whatever they are; one named n_lines, n_dropped or kept_text is replaced.

    Only hashes and positions are shuffled to count and to mark lines; the text moves once, to meet
    its row's marks. Keys are compared by two 64-bit hashes. Different documents of a key are counted
    by key and document first, so a line of a third of all rows is spread over all tasks, and the
    marking join is one that adaptive execution splits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    keyed = F.transform(F.split(text, "\n", -1), line_key)
    hashed = F.transform(keyed, lambda k: F.when(F.char_length(k) >= max(1, min_chars), F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))))
    lines = docs.select(row.alias("row"), hashed.alias("keys"))
    whole = F.when(F.col("row.id").isNull(), F.struct("row.h1", "row.h2"))
    common = (
        lines.select(F.struct("row.id", whole.alias("text")).alias("document"), F.explode("keys").alias("key"))
        .where("key is not null")
        # Grouped by the struct, joined by its fields: the join then has an exchange of its own on
        # either side, which adaptive execution needs to split a line that very many rows hold.
        .groupBy("key")
        .agg(F.count_distinct("document").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
        .select("key.a", "key.b", F.lit(True).alias("common"))
    )
    # Rows that are the same in id and text share their marks, so they are marked once.
    marked = (
        lines.dropDuplicates(["row"])
        .select("row", F.posexplode("keys").alias("pos", "key"))
        .select("row", "pos", F.col("key.a").alias("a"), F.col("key.b").alias("b"))
        .join(common, ["a", "b"], "left")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("common", F.lit(False)).alias("drop")))).alias("marks"))
        # Taken out here: inside the filter below it would be taken out again for every line.
        .select("row", F.col("marks.drop").alias("marks"))
    )
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    # The input's columns travel in one struct, so that none of their names can meet one of ours.
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"), row.alias("row"), text.alias("whole"))
    drop, split = F.col("marks"), F.split("whole", "\n", -1)
    joined = left.join(marked, left["row"].eqNullSafe(marked["row"])).select(
        "doc",
        F.struct(
            F.size(split).cast("long").alias("n_lines"),
            F.size(F.filter(drop, lambda x: x)).cast("long").alias("n_dropped"),
            F.array_join(F.filter(split, lambda x, i: ~F.get(drop, i)), "\n").alias("kept_text"),
        ).alias("made"),
    )
    return joined.select("doc.*", "made.*")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT rid, doc_id, text, l.i AS pos, l.line,
         translate(trim(l.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, text, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 'line': x})) AS l FROM numbered)),
common AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key
  HAVING count(DISTINCT doc_id) + count(DISTINCT CASE WHEN doc_id IS NULL THEN text END) >= 10),
marked AS (SELECT lines.*, common.key IS NOT NULL AS dropped FROM lines LEFT JOIN common USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
