"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordhash as W
from .common import sample_by_id, table

#: Rows (about so many) on which cost and selectivity of the rules are estimated; only the order
#: depends on them.
SAMPLE_ROWS = 2000
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = ~W.IS_BREAK
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SMALL = np.zeros(256, bool)
_SMALL[ord("a") : ord("z") + 1] = True


def base_counts(buf: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each whole text."""
    starts, ends, first = W.spans(buf, bounds)
    n_rows = len(bounds) - 1
    point = ((buf & 0xC0) != 0x80) & ~W.IS_SPACE[buf]
    out = {"n_words": np.diff(first), "word_chars": W.per_row(point, bounds), "n_symbols": W.per_row(_SYMBOL[buf], bounds)}
    # Lines: spans between line feeds, each with its row.
    feed = np.flatnonzero(buf == 10)
    cut = np.searchsorted(feed, bounds)
    line_row = np.repeat(np.arange(n_rows), np.diff(cut) + 1)
    last = np.cumsum(np.diff(cut) + 1) - 1
    is_last = np.zeros(len(line_row), bool)
    is_last[last] = True
    line_end = np.empty(len(line_row), np.int64)
    line_end[is_last], line_end[~is_last] = bounds[1:], feed
    line_start = np.empty_like(line_end)
    line_start[1:] = line_end[:-1] + 1
    line_start[np.concatenate([[0], last[:-1] + 1])] = bounds[:-1]
    full = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    h, row = W.span_hash(buf, line_start[full], line_end[full]), line_row[full]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out["n_dup_lines"] = np.bincount(row[1:][same], minlength=n_rows)
    # Windows of eight words, told apart by row; those seen twice mark their words.
    words = W.span_hash(buf, starts, ends)
    wins = W.ngrams(words, WINDOW)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(wins):
        row = np.repeat(np.arange(n_rows), np.diff(first))
        inside = np.flatnonzero(row[: len(wins)] == row[WINDOW - 1 :])
        with np.errstate(over="ignore"):
            key = wins[inside] + W.mix64(row[inside].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        eq = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[1:], twice[:-1] = eq, twice[:-1]
        twice[:-1] |= eq
        hit = inside[order[twice]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, np.minimum(hit + WINDOW, len(words)), -1)
        covered = np.cumsum(covered)
    out["n_repeat_words"] = W.per_row(covered[:-1] > 0, first)
    return out


@dataclass(frozen=True)
class Rule:
    """reject(buf, bounds, counts) -> one boolean for each row; counts are base_counts of these rows."""

    name: str
    reject: Callable[[np.ndarray, np.ndarray, dict], np.ndarray]


def _per_letter(buf, bounds, what):
    return W.per_row(what[buf], bounds) / np.maximum(1, W.per_row(_SMALL[buf] | _CAPITAL[buf], bounds))


def _unlettered(buf, bounds, counts):
    starts, ends, first = W.spans(buf, bounds)
    letters = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    return W.per_row(letters[ends] == letters[starts], first) > 0.3 * counts["n_words"]


def _shouted(buf, bounds, counts):
    starts, ends, first = W.spans(buf, bounds)
    if not len(ends):
        return np.zeros(len(bounds) - 1, bool)
    return W.per_row((buf[ends - 1] == 33) & (ends - starts > 1), first) > 0.3 * counts["n_words"]


def _stutter(buf, bounds, counts):
    starts, ends, first = W.spans(buf, bounds)
    words = W.span_hash(buf, starts, ends, W.LOWER)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    return W.per_row(again, first) > 0.2 * counts["n_words"]


RULES = [
    Rule("symbols", lambda b, o, c: c["n_symbols"] > 0.1 * c["n_words"]),
    # A line that comes again once or twice, such as a heading below a short text, is no junk.
    Rule("dup_lines", lambda b, o, c: c["n_dup_lines"] > np.maximum(2, 0.3 * (W.per_row(b == 10, o) + 1))),
    Rule("word_length", lambda b, o, c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 15 * c["n_words"])),
    Rule("capitals", lambda b, o, c: _per_letter(b, o, _CAPITAL) > 0.5),
    Rule("unlettered", _unlettered),
    Rule("shouted", _shouted),
    Rule("stutter", _stutter),
]


def _base_failed(c: dict) -> np.ndarray:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def _rows(buf, bounds, which):
    """The bytes and bounds of some rows only, in order."""
    if len(which) == len(bounds) - 1:
        return buf, bounds
    size = np.diff(bounds)[which]
    start = np.concatenate([[0], np.cumsum(size)])
    return buf[np.repeat(bounds[which] - start[:-1], size) + np.arange(start[-1])], start


def cascade(buf, bounds, counts, rules: list[Rule]) -> np.ndarray:
    """Index of the first rule that rejects each row, -1 where none does; each rule sees only the
    rows that every rule before it has let pass."""
    by = np.full(len(bounds) - 1, -1)
    left = np.flatnonzero(~_base_failed(counts))
    sub = _rows(buf, bounds, left)
    for k, rule in enumerate(rules):
        if not len(left):
            break
        bad = np.asarray(rule.reject(*sub, {n: v[left] for n, v in counts.items()}), bool)
        if bad.any():
            by[left[bad]] = k
            sub = _rows(*sub, np.flatnonzero(~bad))
            left = left[~bad]
    return by


def by_worth(seconds: list[float], rejected: dict[int, int]) -> list[int]:
    """Rules, each next one by rejections a second among the rows that those before it leave.
    rejected: number of sample rows by the bits of the rules that reject them."""
    order, gone = [], 0
    while len(order) < len(seconds):
        left = [k for k in range(len(seconds)) if k not in order]
        hits = {k: sum(n for bits, n in rejected.items() if not bits & gone and bits >> k & 1) for k in left}
        best = max(left, key=lambda k: (hits[k] / max(1e-9, seconds[k]), -seconds[k], -k))
        order.append(best)
        gone |= 1 << best
    return order


def order_rules(docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """The rules by rejections per second of their own work (see by_worth), measured on a sample on the
    executors. Only sums per rule and per set of rejecting rules reach the driver. The order never
    changes a verdict."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, sets = np.zeros(len(rules)), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, buf, bounds in W.chunks(batch.column(0)):
                counts = base_counts(buf, bounds)
                left = np.flatnonzero(~_base_failed(counts))
                sub, some = _rows(buf, bounds, left), {n: v[left] for n, v in counts.items()}
                bits = np.zeros(len(left), np.int64)
                for k, rule in enumerate(rules):
                    began = time.perf_counter()
                    if len(left):
                        bits |= np.asarray(rule.reject(*sub, some), bool).astype(np.int64) << k
                    spent[k] += time.perf_counter() - began
                sets = np.concatenate([sets, bits[bits > 0]])
        which, n = np.unique(sets, return_counts=True)
        seconds = [*spent, *np.zeros(len(which))]
        yield pa.record_batch({"rule": pa.array([*range(len(rules)), *[-1] * len(which)], pa.int32()), "bits": pa.array([*[0] * len(rules), *which], pa.int64()), "n": pa.array([*[0] * len(rules), *n], pa.int64()), "spent": pa.array(seconds, pa.float64())})

    chosen = sample_by_id(docs, rows, id_col).select(F.col(text_col).alias("text"))
    sums = chosen.mapInArrow(measure, "rule int, bits bigint, n bigint, spent double").groupBy("rule", "bits").agg(F.sum("n").alias("n"), F.sum("spent").alias("spent")).collect()
    spent = {r.rule: r.spent for r in sums}
    return [rules[k] for k in by_worth([spent.get(k, 0.0) for k in range(len(rules))], {r.bits: r.n for r in sums if r.rule == -1})]


OUT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the base counts, base_failed and kept.

    Null and empty texts have counts of 0 and fail the base rule (fewer than 20 words). Repeated rows
    and repeated or null ids each come back. Other columns of the input are not read, whatever
    their names. Ids are bigint or cast to it. Every text is read whole; a row needs no other row, so nothing is shuffled.
    """
    ordered = order_rules(docs, RULES if rules is None else rules, id_col=id_col, text_col=text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, bounds in W.chunks(batch.column(1)):
                counts = base_counts(buf, bounds)
                failed = _base_failed(counts)
                kept = ~failed & (cascade(buf, bounds, counts, ordered) < 0)
                yield pa.record_batch([batch.column(0).slice(i, j - i), *(pa.array(counts[n], pa.int64()) for n in names), pa.array(failed), pa.array(kept)], [id_col, *names, "base_failed", "kept"])

    return docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).alias("text")).mapInArrow(run, OUT.replace("doc_id", id_col))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
