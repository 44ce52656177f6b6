"""Buckets, open questions, coverage, citations, facets and filters of a finished model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.rubrics import overall_confidence
from claimloom.functions.vocabulary import CONFIDENCE, RISK_LEVELS, SEVERE, rank


def bucket() -> Column:
    """A path's bucket: flags of dispute put it among the low ones whatever its confidence."""
    disputed = F.col("ungrounded_condition") | F.col("judge_disputed_condition")
    return F.when((F.col("confidence") == "low") | disputed, "low").otherwise(F.col("confidence"))


def overall(paths: DataFrame, judged: bool, failures: bool, unresolved: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Confidence of a whole model from its paths; ``unresolved`` tells of each path whether a conflict is open."""
    counts = [F.count("*").alias("n"), F.count_if(F.col("confidence") == "high").alias("high"), F.count_if(F.col("confidence") == "low").alias("low"), F.coalesce(F.bool_or(unresolved), F.lit(False)).alias("open")]
    grouped = paths.groupBy(*by).agg(*counts) if by else paths.agg(*counts)
    sure = F.lit(judged and not failures) & ~F.col("open")
    return grouped.select(*by, "n", "high", "low", overall_confidence(F.col("n"), F.col("high"), F.col("low"), sure).alias("overall"))


def distinct_in_order(notes: DataFrame, note: str, *order: str) -> DataFrame:
    """Each note once, where it was first seen: an aggregate with a partial step, as a note may stand in all rows."""
    rest = [c for c in notes.columns if c != note]
    first = notes.groupBy(note).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*(F.col(c) if c == note else F.col(f"__first.{c}") for c in notes.columns))


def missing(expected: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Rows of ``expected`` that ``have`` lacks."""
    return expected.join(have.select(key).distinct(), key, "left_anti")


def version_coverage(associations: DataFrame, versions: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Per version: documents, kinds collected and kinds not collected, versions without any included."""
    grouped = associations.groupBy("version").agg(F.count_distinct("document").alias("documents"), F.sort_array(F.collect_set("kind")).alias("have"))
    joined = versions.join(grouped, "version", "left")
    have = F.coalesce("have", F.array().cast("array<string>"))
    return joined.select("version", F.coalesce("documents", F.lit(0)).alias("documents"), have.alias("kinds"), F.array_except(F.array(*map(F.lit, kinds)), have).alias("missing_kinds"))


def citations(cited: DataFrame, sources: DataFrame) -> DataFrame:
    """source and how many paths cite it, zero included."""
    counts = cited.groupBy("source").agg(F.count_distinct("path").alias("n_paths"))
    return sources.join(counts, "source", "left").select("source", F.coalesce("n_paths", F.lit(0)).alias("n_paths"))


def facets(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """facet, value and count of each name apart, in one pass over the rows."""
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("facet"), F.col(n).cast("string").alias("value")) for n in names)))
    return rows.select(each.alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def filtered(rows: DataFrame, chosen: dict[str, Sequence[str]], needle: str = "", text: Column | None = None) -> DataFrame:
    """Rows in all chosen facets whose text holds the needle, letter case aside."""
    for name, values in chosen.items():
        rows = rows.filter(F.col(name).isin(*values))
    return rows.filter(F.contains(F.lower(text), F.lit(needle.lower()))) if needle and text is not None else rows


def final_order(name: Column = None, mode: str = "severity") -> list[Column]:
    """Severity, confidence and name, beginning with what the mode names."""
    keys = {"severity": rank(F.col("level"), RISK_LEVELS), "confidence": rank(F.col("confidence"), CONFIDENCE), "name": F.lower(F.col("name") if name is None else name)}
    return [keys[mode], *(k for m, k in keys.items() if m != mode)]


def verification_counts(flags: DataFrame) -> DataFrame:
    """Paths with a disagreement, with a single source though severe, and without a required condition."""
    count = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c)
    return flags.agg(count("source_disagreement"), count("single_source_severe"), count("no_required_condition"))


def single_source_question(paths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One sentence on all severe paths that rest on one source: three names and how many more."""
    severe = paths.filter(F.col("level").isin(*SEVERE) & (F.col("n_sources") == 1))
    names = F.transform(F.array_sort(F.collect_list(F.struct(F.col("path").alias("p"), F.col("name").alias("n")))), lambda x: x.n)
    grouped = severe.groupBy(*by).agg(names.alias("names"), F.count("*").alias("n")) if by else severe.agg(names.alias("names"), F.count("*").alias("n"))
    shown = F.array_join(F.transform(F.slice("names", 1, 3), lambda n: F.concat(F.lit("'"), n, F.lit("'"))), "; ")
    more = F.when(F.col("n") > 3, F.concat(F.lit(" and "), (F.col("n") - 3).cast("string"), F.lit(" more"))).otherwise("")
    return grouped.filter("n > 0").select(*by, F.concat(F.col("n").cast("string"), F.lit(" severe risks have one source only: "), shown, more).alias("question"))


def top_types(paths: DataFrame, by: str, kind: str, most: int = 4) -> DataFrame:
    """The commonest kinds of each ``by`` with counts, of equal ones the first by name."""
    counts = paths.groupBy(by, kind).agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), kind)).cast("bigint")).filter(F.col("place") <= most)
