"""From raw documents to a training mix: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. `run` applies them to the documents table with a reliable checkpoint after each, so a
lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, language_id, line_dedup, mixing, ngram_join
from tidelog.llm.common import checkpoint, table

#: Words of a shingle and percentage of likeness of the near-copy stage (op3 alone takes 4 and 85).
SHINGLE, ALIKE = 5, 80


def _aside(docs: DataFrame, *made: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns of these names (in any case) renamed, so that a stage's own columns don't meet
    them, and how to name them again."""
    names = {c: f"own_{c}" for c in docs.columns if c.lower() in made}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier is sure of; those it rejects go."""
    docs, back = _aside(docs, "lang_pred", "lang_score", "lang_accepted")
    judged = language_id.identify(docs, language_id.train(docs))
    return judged.where("lang_accepted").select(*docs.columns).withColumnsRenamed(back)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that ten documents share; n_chars follows the text."""
    docs, back = _aside(docs, "n_lines", "n_dropped", "kept_text")
    cleaned = line_dedup.drop_shared_lines(docs).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("kept_text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns).withColumnsRenamed(back)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: five-word shingles, 0.8 alike or more."""
    return ngram_join.one_of_each(docs, gram=SHINGLE, percent=ALIKE)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    docs, back = _aside(docs, "leaks")
    clean = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).where("size(leaks) = 0")
    return clean.select(*docs.columns).withColumnsRenamed(back)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_shared_lines),
    ("ngram_join", one_of_each_group),
    ("decontaminate", without_benchmarks),
    ("source_mix", mixed),
]

#: Trained models and balanced sampling are not expressible in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
