"""Quality rules as a ledger: every rule is evaluated once per document, and its failure is one bit.

``build_ledger`` measures the texts and stores the measurements with the failure bits of all rules. A policy is a
named, versioned set of rules, that is, a mask; applying one, comparing versions and asking what a rule alone
would have dropped are bitwise operations on the stored bits and never read a text again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks
from spinmart.llm.names import step_aside

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words",
            "n_wordless")
# Measured only for rules that use it: distinct words of every ``WINDOW_WORDS`` words in a row, summed up.
BY_WINDOW = "n_window_distinct"
WINDOW_WORDS = 5_000


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements; ``bit`` is its place in the ledger and never reused."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


# Whole numbers throughout, so that a measurement at the limit does not depend on rounding.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_passages", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule(4, "short_words", "word_chars < 3 * n_words"),
    Rule(5, "long_words", "word_chars > 10 * n_words"),
    Rule(6, "few_distinct_words", "100 * n_distinct_words < 20 * n_words"),
    Rule(7, "words_without_letters", "10 * n_wordless > 3 * n_words"),
)
# The share of distinct words falls with the length of any text, so very long ones are judged by their windows.
RULES_2 = (*RULES, Rule(8, "few_distinct_words_by_window", f"100 * {BY_WINDOW} < 20 * n_words"))


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        known = {rule.name: rule.mask for rule in rules}
        return reduce(int.__or__, (known[name] for name in self.rules), 0)


BASE = Policy("base", 1, ("few_words", "repeated_passages"))
WEB_TEXT = Policy("web_text", 1, tuple(rule.name for rule in RULES))
# Of ledgers with ``RULES_2``; equal to version 1 on texts of up to ``WINDOW_WORDS`` words.
WEB_TEXT_2 = Policy("web_text", 2, tuple(rule.name for rule in RULES_2 if rule.name != "few_distinct_words"))


def repeat_words(words: list[bytes]) -> tuple[int, int]:
    """(words in 3-word windows that occur at least twice, distinct words)."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(number)
    if len(ids) < 4 or n == len(ids):  # a repeated window needs a fourth word and a repeated one
        return 0, n
    pair = ids[:-2] * n + ids[1:-1]
    if n >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
    _, place, counts = np.unique(pair * n + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= twice
    return int(covered.sum()), n


LETTERLESS = bytes(range(0x21, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``; a NULL text has none of anything."""
    text = text or b""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated, distinct = repeat_words(words)
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    letterless = sum(1 for w in words if not w.strip(LETTERLESS))
    return (len(words), len(joined.decode("utf-8", "replace")), symbols, len(lines), len(lines) - len(set(lines)),
            repeated, distinct, letterless)


def window_distinct(text: bytes | None) -> int:
    """Distinct words of consecutive windows, the last one shorter, that cover the text."""
    words = (text or b"").split()
    return sum(len(set(words[i:i + WINDOW_WORDS])) for i in range(0, len(words), WINDOW_WORDS))


def build_ledger(docs: DataFrame, carry: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row: the ``carry`` columns, the measurements that the rules need and ``fail_bits`` (long).

    Words are runs without ASCII white space; a line counts if it has a word; a line is a duplicate if an equal
    line comes before it. ``text`` may be NULL or empty: it has no words and fails ``few_words``.
    Carried columns must not be named like a measurement. Rows are independent of each other; an empty table
    gives an empty table.
    """
    kept = docs.select(*dict.fromkeys([*carry, "text"])).schema
    by_window = any(BY_WINDOW in rule.fails for rule in rules)
    measures = (*MEASURES, BY_WINDOW) if by_window else MEASURES
    schema = T.StructType([*[kept[name] for name in carry], *[T.StructField(m, T.LongType()) for m in measures]])

    def measured(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [(*measure(t), window_distinct(t)) if by_window else measure(t) for t in texts]
            columns = zip(*found) if found else [()] * len(measures)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in carry] + [pa.array(c, pa.int64()) for c in columns],
                names=[*carry, *measures])

    ledger = docs.select(*kept.names).mapInArrow(measured, schema)
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(rule.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return ledger.withColumn("fail_bits", bits)


def fails(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def ablations(ledger: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule in it: documents the rule fails, those it alone drops, and those kept without it.

    One aggregation over the ledger to at most 2^rules bit patterns, the rest is bitwise over these.
    """
    patterns = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("_docs"))
    cases = [(p.name, p.version, r.name, p.mask(rules), r.mask) for p in policies for r in rules if r.name in p.rules]
    listed = F.explode(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(v).alias("version"), F.lit(r).alias("rule"),
                 F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit")) for p, v, r, m, b in cases]))
    failed = F.col("fail_bits").bitwiseAND(F.col("c.mask"))

    def docs(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_docs"))), F.lit(0)).cast("long")

    return patterns.select("*", listed.alias("c")).groupBy("c.policy", "c.version", "c.rule").agg(
        docs(F.col("fail_bits").bitwiseAND(F.col("c.bit")) != 0).alias("n_failed"),
        docs(failed == F.col("c.bit")).alias("n_dropped_alone"),
        docs(failed == 0).alias("n_kept"),
        docs(failed.bitwiseAND(F.bitwise_not(F.col("c.bit"))) == 0).alias("n_kept_without"))


def keep_good(docs: DataFrame, policy: Policy = WEB_TEXT_2, rules: Sequence[Rule] = RULES_2) -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their own columns, whatever their names."""
    docs, own = step_aside(docs, (*MEASURES, BY_WINDOW, "fail_bits"))
    return build_ledger(docs, docs.columns, rules).where(~fails(policy, rules)).select(*docs.columns).withColumnsRenamed(own)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents: measurements, failure bits and the verdicts of two policies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return build_ledger(docs, rules=RULES_2).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        fails(BASE, RULES_2).alias("base_failed"), (~fails(WEB_TEXT_2, RULES_2)).alias("kept"),
        "n_lines", "n_distinct_words", "n_wordless", BY_WINDOW, "fail_bits")


def quality_ablations(spark, sf_dir: str) -> DataFrame:
    """What each rule of three policies does to all documents, from one ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ablations(build_ledger(docs, rules=RULES_2), [BASE, WEB_TEXT, WEB_TEXT_2], RULES_2)


# The words of DuckDB's trim and split are the same runs; code points by length().
LEDGER_SQL = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM split
), windows AS (
    SELECT doc_id, i, word || ' ' || lead(word, 1) OVER places || ' ' || lead(word, 2) OVER places AS w
    FROM placed WINDOW places AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
    SELECT doc_id, w FROM windows WHERE w IS NOT NULL GROUP BY doc_id, w HAVING count(*) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM windows JOIN twice USING (doc_id, w), (SELECT unnest([0, 1, 2]) AS k)
    GROUP BY doc_id
), measured AS (
    SELECT s.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(list_distinct(words)) AS n_distinct_words,
           len(list_filter(words, lambda x: regexp_full_match(x, '[\x21-\x40\x5B-\x60\x7B-\x7E]+'))) AS n_wordless,
           CAST(coalesce(list_sum(list_transform(range(0, len(words), 5000),
                lambda i: len(list_distinct(words[i + 1:i + 5000])))), 0) AS BIGINT) AS n_window_distinct
    FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), judged AS (
    SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN 10 * n_dup_lines > 4 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 10 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_distinct_words < 20 * n_words THEN 64 ELSE 0 END
        + CASE WHEN 10 * n_wordless > 3 * n_words THEN 128 ELSE 0 END
        + CASE WHEN 100 * n_window_distinct < 20 * n_words THEN 256 ELSE 0 END AS BIGINT) AS fail_bits
    FROM measured
)
"""
OP1_SQL = LEDGER_SQL + "SELECT *, (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 447) = 0 AS kept FROM judged"
ABLATIONS_SQL = LEDGER_SQL + """, rules (rule, bit) AS (
    VALUES ('few_words', 1), ('repeated_passages', 2), ('symbols', 4), ('repeated_lines', 8), ('short_words', 16),
           ('long_words', 32), ('few_distinct_words', 64), ('words_without_letters', 128),
           ('few_distinct_words_by_window', 256)
), policies (policy, version, mask) AS (VALUES ('base', 1, 3), ('web_text', 1, 255), ('web_text', 2, 447))
SELECT policy, version, rule, count(*) FILTER (WHERE fail_bits & bit <> 0) AS n_failed,
       count(*) FILTER (WHERE fail_bits & mask = bit) AS n_dropped_alone,
       count(*) FILTER (WHERE fail_bits & mask = 0) AS n_kept,
       count(*) FILTER (WHERE fail_bits & mask & ~bit = 0) AS n_kept_without
FROM judged, policies JOIN rules ON mask & bit <> 0
GROUP BY policy, version, rule
"""

ship_with_tasks(__name__)
