"""Quality rules as a bitmask ledger.

``ledger`` reads every whole text once, measures it, evaluates every rule once and
stores the failures as bits of one integer beside the measurements. A policy is a
version name with a mask of rules; ``apply_policy`` is one bitwise AND over the
ledger, so a new policy never reads the texts again. ``ablation`` tells for every
rule of a policy how many documents it fails, and how many it alone would drop,
by one aggregation of bits without a shuffle of rows.

Words are runs of anything but ASCII white space. Defined results: a null or empty
text has no words, fails ``few_words`` and is not kept; repeated rows give a row
each; an empty table gives none; null ``doc_id`` values are kept; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import portions, text_of, utf8

SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = b"abcdefghijklmnopqrstuvwxyz"
WHITE = b" \t\n\x0b\x0c\r"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_small")
_LEDGER = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)

#: Bit, name and failing condition of each rule. A bit keeps its meaning for ever; new rules take new bits.
RULES: tuple[tuple[int, str, str], ...] = (
    (0, "few_words", "n_words < 10"),
    (1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    (2, "symbols", "100 * n_symbols > 10 * word_chars"),
    (3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    (4, "capitals", "100 * n_capitals > 50 * (n_capitals + n_small)"),
    (5, "short_words", "word_chars < 2 * n_words"),
    (6, "long_words", "word_chars > 15 * n_words"),
    (7, "no_ascii_letters", "n_words > 0 and n_capitals + n_small = 0"),
)
BITS = {name: 1 << bit for bit, name, _ in RULES}
BASE = BITS["few_words"] | BITS["repeated_windows"]

#: Policies by version: the rules whose failure drops a document. Versions are never edited.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BITS["symbols"] | BITS["repeated_lines"] | BITS["capitals"],
    "v2": BASE | BITS["symbols"] | BITS["repeated_lines"] | BITS["capitals"] | BITS["short_words"] | BITS["long_words"],
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more in the text, first ones included."""
    windows = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = end = 0
    for start, found in enumerate(windows):
        if times[found] > 1:
            covered += start + window - max(start, end)
            end = start + window
    return covered


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return len(lines), len(lines) - len(set(lines))


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n_lines, n_dup_lines = repeated_lines(text)
    without = lambda characters: len(text) - len(text.translate(None, characters))
    return (
        len(words),
        len(b"".join(words).decode("utf-8")),
        without(SYMBOLS),
        n_dup_lines,
        repeated_words(words),
        n_lines,
        without(CAPITALS),
        without(SMALL),
    )


def failure_bits() -> Column:
    """The failures of a measured row as one integer."""
    bits = F.lit(0).cast("bigint")
    for bit, _, failing in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(failing), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, every measurement and failure_bits, a row per document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            columns = zip(*map(measure, utf8(batch.column(1))), strict=True)
            found = [pa.array(c, type=pa.int64()) for c in columns] or [pa.array([], type=pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["doc_id", *MEASURES])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return source.mapInArrow(rows, _LEDGER).withColumn("failure_bits", failure_bits())


def apply_policy(found: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds base_failed, and kept: no failure among the policy's rules."""
    mask = POLICIES[policy]
    failed = lambda bits: F.col("failure_bits").bitwiseAND(F.lit(bits)) != 0
    return found.withColumn("base_failed", failed(BASE)).withColumn("kept", ~failed(BASE | mask))


def ablation(found: DataFrame, policy: str = "v1") -> DataFrame:
    """A row per rule of the policy: documents failing it, and documents that it alone drops."""
    mask = POLICIES[policy]
    rules = [(name, 1 << bit) for bit, name, _ in RULES if mask >> bit & 1]
    in_policy = F.col("failure_bits").bitwiseAND(F.lit(mask))
    counts = [F.count("*").alias("n_docs")]
    for name, bit in rules:
        counts.append(F.count_if(in_policy.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_failed"))
        counts.append(F.count_if(in_policy == bit).alias(f"{name}_alone"))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"{name}_failed").alias("n_failed"), F.col(f"{name}_alone").alias("n_only_this")) for name, _ in rules)))
    return found.agg(*counts).select("n_docs", each.alias("r")).select(F.lit(policy).alias("policy"), "r.rule", "n_docs", "r.n_failed", "r.n_only_this")


def result(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger under a policy."""
    judged = apply_policy(ledger(docs), policy)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failure_bits")


def oracle_sql(policy: str = "v1") -> str:
    """``result`` in DuckDB's SQL."""
    bits = " + ".join(f"(CASE WHEN {failing} THEN {1 << bit} ELSE 0 END)" for bit, _, failing in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
spans AS (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM w WHERE len(ws) >= {WINDOW}),
grams AS (SELECT r, i, ws[i:i + {WINDOW - 1}] AS g FROM spans),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
line_counts AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(l.n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
    length(regexp_replace(text, '[^a-z]+', '', 'g')) AS n_small
  FROM w LEFT JOIN covered c ON c.r = w.r LEFT JOIN line_counts l ON l.r = w.r),
b AS (SELECT *, CAST({bits} AS BIGINT) AS failure_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failure_bits & {BASE}) <> 0 AS base_failed, (failure_bits & {BASE | POLICIES[policy]}) = 0 AS kept, failure_bits
FROM b
"""
