"""Quality rules with a bitmask ledger: every rule is evaluated once, and policies are masks over the stored failure bits.

A ledger has a row for each document: its measurements and `failed`, a long with a bit for each rule that it fails. A policy
is a named version of a set of rules, so judging by another policy, or finding what a rule costs, reads the ledger alone.
Ablations first sum up documents by their failure bits, at most 2 ** len(RULES) rows however many documents there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import SPACE, Words, Workspace, column, map_batches, ship, text_bytes

#: What is measured of a text, in this order: counts of words, code points in words, lines with a word, characters that are
#: symbols, lines with a word equal to an earlier line, words in three-word windows found twice or more, letters A-Z,
#: exclamation and question marks, words with a letter, lines that begin with a bullet, lines that end with an ellipsis.
MEASURES = ("n_words", "word_chars", "n_lines", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_letter_words", "n_bullet_lines", "n_ellipsis_lines")
SYMBOLS, MARKS, BULLETS = b"#*$%&|<>", b"!?", b"-*"
WINDOW = 3

#: Name and failing condition of each rule; a rule's bit is its place. Only ever add at the end: ledgers hold the bits.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("capitals", "100 * n_capitals > 40 * word_chars"),
    ("marks", "5 * n_marks > n_words"),
    ("few_letter_words", "100 * n_letter_words < 80 * n_words"),
    ("bullets", "100 * n_bullet_lines > 90 * n_lines"),
    ("ellipses", "100 * n_ellipsis_lines > 30 * n_lines"),
)
BIT = {name: k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of a named set of rules; a document passes if it fails none of them."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(or_, (1 << BIT[r] for r in self.rules), 0)


_BASE = ("few_words", "repeated_windows")
_LOOKS = (*_BASE, "symbols", "duplicate_lines")
POLICIES = (Policy("base", 1, _BASE), Policy("clean", 1, _LOOKS), Policy("clean", 2, tuple(name for name, _ in RULES)))
BASE, CURRENT = POLICIES[0], POLICIES[-1]

_SYMBOL, _MARK, _BULLET = (np.isin(np.arange(256), list(x)) for x in (SYMBOLS, MARKS, BULLETS))
_CAPITAL = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _CAPITAL | (np.arange(256) >= 97) & (np.arange(256) <= 122) | (np.arange(256) >= 128)


def _identity(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Small integers, equal just for equal pieces of data."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)])
    packed = data[np.repeat(starts - at[:-1], size) + np.arange(at[-1])]
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(packed)])
    return pieces.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integers below 2 ** 62, equal just for equal pairs."""
    if len(a) and (int(a.max()) + 1) * (int(b.max()) + 1) > 2**62:
        a = np.unique(a, return_inverse=True)[1].reshape(-1)
    return a * (int(b.max(initial=0)) + 1) + b


def _repeats(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """0 for a (row, key) found once, 1 for the first of several, 2 for those after it; rows ascend."""
    order = np.argsort(key, kind="stable")
    r, k = row[order], key[order]
    same = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    before, after = np.concatenate([[False], same])[: len(r)], np.concatenate([same, [False]])[: len(r)]
    out = np.zeros(len(row), np.int8)
    out[order] = np.where(before, 2, after)
    return out


def measures(texts: pa.Array) -> list[np.ndarray]:
    """MEASURES of each text, exact; null counts as empty."""
    w = Words(texts)
    n_rows, n = len(w.at) - 1, len(w)
    data = w.data
    per = lambda rows: np.bincount(rows, minlength=n_rows)
    upto = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    in_rows = lambda flags: np.diff(upto(flags)[w.at])
    row = np.repeat(np.arange(n_rows), np.diff(w.first))
    letter = upto(_LETTER[data])

    word = _identity(data, w.starts, w.ends)
    key = np.zeros(0, np.int64)
    if n >= WINDOW:
        key = word[: n - WINDOW + 1]
        for k in range(1, WINDOW):
            key = _joined(key, word[k : n - WINDOW + 1 + k])
    inside = np.flatnonzero(row[: len(key)] == row[WINDOW - 1 :]) if len(key) else key
    twice = inside[_repeats(row[inside], key[inside]) > 0]
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[twice + k] = True

    edge = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([w.at[:-1], edge + 1]))
    line_row = np.sort(np.concatenate([np.arange(n_rows), np.searchsorted(w.at, edge, "right") - 1]))
    last = np.concatenate([line_row[1:] != line_row[:-1], np.ones(min(1, len(line_row)), bool)])
    stops = np.where(last, w.at[line_row + 1], np.concatenate([begins[1:], [0]])[: len(begins)] - 1)
    head, tail = np.searchsorted(w.starts, begins), np.searchsorted(w.starts, stops) - 1
    full = tail >= head
    begins, stops, line_row, head, tail = (x[full] for x in (begins, stops, line_row, head, tail))
    again = _repeats(line_row, _identity(data, begins, stops)) == 2
    end = w.ends[tail] - 1
    dots = np.concatenate([data, np.zeros(1, np.uint8)])
    dot = lambda k: (dots[np.maximum(end - k, 0)] == 46) & (end - k >= begins)
    ellipsis = dot(0) & dot(1) & dot(2)
    return [
        np.diff(w.first), in_rows(((data & 0xC0) != 0x80) & ~SPACE[data]), per(line_row), in_rows(_SYMBOL[data]), per(line_row[again]),
        per(row[covered]), in_rows(_CAPITAL[data]), in_rows(_MARK[data]), per(row[letter[w.ends] > letter[w.starts]]), per(line_row[_BULLET[data[w.starts[head]]]]), per(line_row[ellipsis]),
    ]


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES and failed (the bits of RULES), a row for each of docs' rows.

    Words are runs of other characters than blank, tab, line feed, vertical tab, form feed and carriage return; lines end
    with a line feed. A null or empty text has no words: it fails few_words alone. Rows that repeat a doc_id, or have none,
    are judged one by one; an empty table gives an empty one. Columns other than doc_id and text are not looked at.
    """
    ship(docs.sparkSession)

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = measures(column(batch, "text"))
        return pa.record_batch({"doc_id": column(batch, "doc_id"), **{m: pa.array(c.astype(np.int64)) for m, c in zip(MEASURES, cols, strict=True)}})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = map_batches(rows, measured, ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)]), text="text")
    bit = [F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, fails) in enumerate(RULES)]
    return found.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bit))


def judged(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger's rows with base_failed and kept, by the policy and always by the base rules."""
    hit = lambda mask: F.col("failed").bitwiseAND(F.lit(mask).cast("long")) != 0
    return entries.withColumn("base_failed", hit(BASE.mask)).withColumn("kept", ~hit(BASE.mask | policy.mask))


def ablation(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """policy, version, rule, and how many documents and words: failed by the rule, by it alone of the policy's rules, kept
    by the policy, and kept once the rule is left out. An empty ledger gives no rows."""
    seen = entries.groupBy("failed").agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"))
    case = lambda p, r: F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << BIT[r]).cast("long").alias("bit"))
    cases = seen.select("*", F.inline(F.array(*(case(p, r) for p in policies for r in p.rules))))
    hit = cases.withColumn("hit", F.expr("failed & mask")).withColumn("rest", F.expr("hit & ~bit"))
    tests = {"failed": F.expr("hit & bit <> 0"), "alone": F.expr("hit = bit"), "kept": F.expr("hit = 0"), "kept_without": F.expr("rest = 0")}
    sums = [F.sum(F.when(t, F.col(what)).otherwise(0)).alias(f"{what}_{name}") for what in ("docs", "words") for name, t in tests.items()]
    return hit.groupBy("policy", "version", "rule").agg(*sums)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurements of every document, stored in a ledger, and what the current policy makes of them."""
    entries = Workspace(spark, "rules").write(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")), "ledger")
    return judged(entries).select("doc_id", *MEASURES, "failed", "base_failed", "kept")


OP12_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as t, list_filter(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as l from documents),
t as (select doc_id, unnest(w) as a, generate_subscripts(w, 1) as i from d),
u as (select *, lead(a) over o as b, lead(a, 2) over o as z from t window o as (partition by doc_id order by i)),
g as (select doc_id, i, count(*) over (partition by doc_id, a, b, z) as c from u where z is not null),
r as (select doc_id, count(distinct j) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as j from g where c > 1) group by doc_id),
m as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, len(l) as n_lines,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_capitals, length(regexp_replace(t, '[^!?]', '', 'g')) as n_marks,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) as n_letter_words,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*]'))) as n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '[.][.][.][\\x20\\x09-\\x0D]*$'))) as n_ellipsis_lines
  from d left join r using (doc_id)),
f as (select *, cast({" + ".join(f"(case when {fails} then {1 << k} else 0 end)" for k, (_, fails) in enumerate(RULES))} as bigint) as failed from m)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, failed = 0 as kept from f
"""
