"""Quality rules in a bitmask ledger.

Every text is measured once and every rule is evaluated once. A row keeps its measurements and one
number whose bit ``i`` says that rule ``i`` failed. Policies are masks over those bits, with a
version each; what a policy keeps, and what each of its rules changes, follows from the bits alone.

Null and empty texts have no words and measure zero. Rows are never joined, so repeated ids, null
ids and further columns make no difference; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.common import column_bytes, slices, table

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` (SQL over the measurements) is true. Bits never change their meaning."""

    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version of the decision: documents that fail any of ``rules`` go."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule]) -> int:
        return sum(1 << r.bit for r in rules if r.name in self.rules)


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 5 * word_chars"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "capitals", "100 * n_capitals > 40 * word_chars"),
)
POLICIES = (
    Policy("base", ("few_words", "repeated_words")),
    Policy("1", ("few_words", "repeated_words", "symbols")),
    Policy("2", ("few_words", "repeated_words", "symbols", "repeated_lines", "capitals")),
)


def repeated_words(words: Sequence[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words that occurs at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    windows = ids
    for size in range(1, width):  # number the windows of each size from those one shorter
        windows = windows[: len(ids) - size] * len(numbers) + ids[size:]
        windows = np.unique(windows, return_inverse=True)[1].astype(np.int64)
    twice = np.bincount(windows)[windows] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += twice
    edges[width:] -= twice
    return int((np.cumsum(edges) > 0).sum())


def measure_text(text: bytes) -> tuple[int, ...]:
    """The numbers of ``MEASURES``."""
    words = text.split()  # bytes.split() breaks at the six ASCII white-space bytes and nothing else
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text) - len(text.translate(None, CAPITALS)),
    )


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key and its measurements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = np.array([measure_text(x) for x in column_bytes(batch, "text")], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(rows[:, i]) for i in range(len(MEASURES))]], ["key", *MEASURES]
            )

    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    found = slim.mapInArrow(run, f"key {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    return found.withColumnRenamed("key", key)


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    """All rules as one number."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    total = F.lit(0).cast("long")
    for bit in bits:
        total = total.bitwiseOR(bit)
    return total


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements and ``fail_bits`` of every document."""
    return measure(docs, key, text).withColumn("fail_bits", failure_bits(rules))


def keeps(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger row passes ``policy``."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules))) == 0


def ablations(
    rows: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()
) -> DataFrame:
    """For each policy and each of its rules: documents kept, kept without the rule, and failed by it alone.

    The ledger is reduced to one row per bit pattern first, so this costs one narrow aggregation
    however many policies there are.
    """
    patterns = rows.groupBy(*by, "fail_bits").agg(F.count("*").alias("n"))
    cases = [(p.version, r.name, p.mask(rules), 1 << r.bit) for p in policies for r in rules if r.name in p.rules]
    case = F.explode(
        F.array(*[
            F.struct(F.lit(v).alias("policy"), F.lit(n).alias("rule"), F.lit(m).cast("long").alias("mask"),
                     F.lit(b).cast("long").alias("bit"))
            for v, n, m, b in cases
        ])
    )
    spread = patterns.withColumn("case", case).select(*by, "fail_bits", "n", "case.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return spread.groupBy(*by, "policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(failed == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(failed.bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.bit_or(failed).alias("bits_seen"),
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    base, newest = POLICIES[0], POLICIES[-1]
    return rows.select(
        "doc_id",
        *MEASURES[:5],
        (~keeps(base)).alias("base_failed"),
        (keeps(base) & keeps(newest)).alias("kept"),
        "fail_bits",
    )


#: The same by regular expressions and lists: windows as joined text, counted by grouping.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS k FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 5) AS r(j) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      len(ls) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END AS b0, CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END AS b1,
      CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END AS b2,
      CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END AS b3,
      CASE WHEN 100 * n_capitals > 40 * word_chars THEN 16 ELSE 0 END AS b4 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 + b1 > 0 AS base_failed,
  b0 + b1 + b2 + b3 + b4 = 0 AS kept, (b0 + b1 + b2 + b3 + b4)::BIGINT AS fail_bits FROM b
"""
