"""Gold checks: does a model make the distinctions that people wrote down?"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from claimloom.functions.vocabulary import SEVERE_FOR_GOLD

#: Characters of the patterns that are searched in one pass over the rows.
BLOCK_CHARS = 1_000_000
_FOUND = "__patterns"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = re.compile(r"\\(.)|\[\^?\]?(?:\\.|[^\]\\])*\]|(\()|(\))|(\|)|([?*]|\{[^}]*\}?)|(\+)|[.^$]|([^\\\[\]().^$?*+{}|])|.", re.S)
_PLAIN = frozenset(".-+*?/()[]{}|^$#:,'\"&%@!=<>;~`_ ")


def path_text(path: Column, *parts: Column) -> Column:
    """All that a pattern may meet in a path: name, description, statements, values, patterns and steps."""
    return F.concat_ws("\n", path, *parts)


def required(pattern: str) -> list[str]:
    """Strings, in small ASCII letters, of which every text that ``pattern`` matches holds one; none if that is not known.

    Of each branch it is the longest run of plain characters outside of groups. Where flags or quotations may give
    characters another meaning, nothing is said.
    """
    if re.search(r"\(\?[a-z]*[xd]|\\[QE]", pattern):
        return []
    branches, runs, run, depth = [], [], "", 0
    for token in _TOKEN.finditer(pattern):
        escaped, opens, closes, either, again, more, plain = token.groups()
        if depth:  # inside of a group
            depth += bool(opens) - bool(closes)
            continue
        own = plain or (escaped if escaped and escaped in _PLAIN else None)
        if again:  # the character before may be missing
            run = run[:-1]
        if own:
            run += own
            continue
        runs.append(run)
        run = ""
        if opens:
            depth = 1
        if closes:
            return []
        if either:
            branches.append(max(runs, key=len))
            runs = []
    branches.append(max([*runs, run], key=len))
    return sorted({x.translate(_LOWER) for x in branches}) if depth == 0 and all(branches) else []


def hits(checks: DataFrame, rows: DataFrame, pattern: str = "match", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Checks with the rows that match them, letter case (ASCII) aside.

    The strings that patterns require are compiled into an automaton, in blocks of about ``block_chars`` characters; one
    scan of a row tells which patterns it is a candidate of, and the others never run. Patterns that require
    nothing are candidates everywhere. Rows are not shuffled until they match.
    """
    spark = rows.sparkSession
    asked = checks.select(F.col(pattern).alias("p")).filter("p IS NOT NULL").distinct()
    chars = asked.agg(F.sum(F.length("p"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    schema = StructType([*rows.schema.fields, StructField(_FOUND, ArrayType(StringType()))])
    found = spark.createDataFrame([], schema)
    for n in range(blocks):
        told = sorted(r.p for r in asked.filter(F.pmod(F.xxhash64("p"), F.lit(blocks)) == n).collect())
        found = found.unionByName(rows.mapInArrow(_candidates(spark.sparkContext.broadcast(told), rows.columns.index(text), schema.names), schema))
    each = found.withColumn(_FOUND, F.explode(_FOUND)).filter(F.regexp_like(F.col(text), F.concat(F.lit("(?i)"), F.col(_FOUND))))
    return each.join(checks, F.col(_FOUND) == checks[pattern]).drop(_FOUND)


def _candidates(shared: Broadcast, place: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, always, by_literal = shared.value, [], {}
        for n, pattern in enumerate(patterns):
            literals = required(pattern)
            if not literals:
                always.append(n)
            for literal in literals:
                by_literal.setdefault(literal, []).append(n)
        automaton = ahocorasick.Automaton()
        for literal, numbers in by_literal.items():
            automaton.add_word(literal, numbers)
        automaton.make_automaton()
        for batch in batches:
            told = []
            for text in batch.column(place).to_pylist():
                met = set(always) if text is not None else set()
                if by_literal and text:
                    met.update(*(numbers for _, numbers in automaton.iter(text.translate(_LOWER))))
                told.append([patterns[n] for n in sorted(met)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.list_(pa.string()))], names)

    return run


def evaluated(checks: DataFrame, paths: DataFrame, contexts: DataFrame) -> DataFrame:
    """check, type, distinction and passed for checks of every type.

    Checks: check, type, distinction, match, matches, min_distinct, risk_types, step. Paths: path,
    text, risk_type, level, steps (text), known_issue, required_version, required_other and firm
    (a required condition that is not low). Contexts: text, known_issue.
    """
    severe = F.col("level").isin(*SEVERE_FOR_GOLD)
    step = F.coalesce(F.regexp_like("steps", F.concat(F.lit("(?i)"), F.col("step"))), F.lit(False))
    by_path = hits(checks, paths).groupBy("check").agg(
        F.bool_or(F.col("required_version") & F.col("required_other")).alias("required_conditions"),
        F.bool_or(F.coalesce(F.array_contains("risk_types", F.col("risk_type")), F.lit(False))).alias("risk_type_hit"),
        F.bool_or(step).alias("step_hit"),
        F.bool_or("known_issue").alias("path_issue"),
        F.bool_or(severe & F.col("firm")).alias("asserted"),
        F.bool_or(severe).alias("any_severe"),
        F.bool_or(~severe).alias("any_low"),
    )
    by_context = hits(checks, contexts).groupBy("check").agg(F.bool_or("known_issue").alias("context_issue"), F.count("*").alias("contexts"))
    each = checks.filter("type = 'alternative_paths'").select("check", F.posexplode("matches").alias("k", "pattern"))
    first = hits(each, paths, "pattern").groupBy("check", "k").agg(F.min("path").alias("first_path"))
    distinct = first.groupBy("check").agg(F.count("*").alias("patterns_hit"), F.count_distinct("first_path").alias("distinct_paths"))
    joined = checks.join(by_path, "check", "left").join(by_context, "check", "left").join(distinct, "check", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    enough = lambda c: F.coalesce(F.col(c), F.lit(0)) >= F.col("min_distinct")
    passed = (
        F.when(F.col("type") == "required_conditions", yes("required_conditions"))
        .when(F.col("type") == "alternative_paths", enough("patterns_hit") & enough("distinct_paths"))
        .when(F.col("type") == "risk_type", yes("risk_type_hit"))
        .when(F.col("type") == "migration_step", yes("step_hit"))
        .when(F.col("type") == "known_incompatibility", yes("path_issue") | yes("context_issue"))
        .when(F.col("type") == "not_asserted", ~yes("asserted"))
        .when(F.col("type") == "contextual", ((F.coalesce("contexts", F.lit(0)) > 0) | yes("any_low")) & ~yes("any_severe"))
    )
    return joined.select("check", "type", "distinction", F.coalesce(passed, F.lit(False)).alias("passed"))


def scores(results: DataFrame) -> DataFrame:
    """distinction and passed/total."""
    counts = results.groupBy("distinction").agg(F.count_if("passed").alias("p"), F.count("*").alias("n"))
    return counts.select("distinction", F.concat_ws("/", F.col("p").cast("string"), F.col("n").cast("string")).alias("score"))
