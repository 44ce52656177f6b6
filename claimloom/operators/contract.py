"""The shape of what goes out: evidence copies, contexts, nested paths, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUOTE_CHARS, QUOTES = 1200, 3


def evidence() -> Column:
    """A fact's evidence, copied from its columns and never written by a model."""
    return F.struct("source", "source_type", F.col("quote").alias("quote_or_summary"), F.col("explanation").alias("relevance"), "fact", "candidate", "url", "tier", "versions", "certainty")


def context_entries(facts: DataFrame, reason: Column | None = None) -> DataFrame:
    """Facts that are no risks, as statements with their evidence and why they are none."""
    why = F.coalesce(reason, F.lit("Extracted as context.")) if reason is not None else F.lit("Extracted as context.")
    return facts.select("fact", F.concat(F.col("subject"), F.lit(": "), F.col("explanation")).alias("statement"), "subject", "change", "versions", why.alias("why_not_a_risk"), evidence().alias("evidence"))


def relevance_hint() -> Column:
    """Label and type of a scored section, null for others."""
    return F.when(F.col("status") == "scored", F.struct("label", "risk_type"))


def judge_state(quotes: Column) -> Column:
    """The quotes a judge sees: the first few, cut to a length."""
    return F.transform(F.slice(quotes, 1, QUOTES), lambda q: F.substring(q, 1, QUOTE_CHARS))


def compact(fields: dict[str, int], lists: dict[str, int]) -> Column:
    """A lossy shape for small models: texts cut to lengths, lists to sizes."""
    texts = [F.substring(c, 1, n).alias(c) for c, n in fields.items()]
    return F.struct(*texts, *(F.slice(c, 1, n).alias(c) for c, n in lists.items()))


def final_paths(paths: DataFrame, conditions: DataFrame, path: str = "path", order: str = "condition", fields: tuple[str, ...] = ()) -> DataFrame:
    """Paths with their conditions as an ordered array of the contract's fields; internal columns stay behind.

    A path has a handful of conditions, so the array is bounded by what a model wrote for one path.
    """
    own = conditions.groupBy(path).agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias("conditions"))
    return paths.join(own, path, "left")


def search_patterns(conditions: DataFrame, path: str, order: str, patterns: str) -> DataFrame:
    """Each path's search patterns, first seen first."""
    listed = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(order, patterns))), lambda x: x[patterns]))
    return conditions.groupBy(path).agg(F.array_distinct(listed).alias("search_patterns"))


def change_kinds(facts: DataFrame, path: str = "path") -> DataFrame:
    """Kinds of change of a path's facts; a known incompatibility counts as a known issue."""
    issue = F.collect_set(F.when(F.col("known_incompatibility"), "known_issue"))
    return facts.groupBy(path).agg(F.sort_array(F.array_distinct(F.concat(F.collect_set("change"), issue))).alias("change_kinds"))


def structural_warnings(conditions: DataFrame, path: str = "path") -> DataFrame:
    """What a path lacks: a condition on the version, or one on anything else."""
    version = F.col("category") == "version"
    lacks = F.array_compact(F.array(F.when(~F.bool_or(version), "no_version_condition"), F.when(F.bool_and(version), "no_other_condition")))
    return conditions.groupBy(path).agg(lacks.alias("warnings"))


def diagnostics(judged: bool, not_judged: Column, failures: Column, ungrounded: Column) -> Column:
    """Sentences on how a verification went, only those that apply."""
    told = lambda c, s: F.when(c > 0, F.concat(c.cast("string"), F.lit(s)))
    return F.array_compact(
        F.array(
            F.when(F.lit(not judged), "No judge ran; confidence is medium at most."),
            told(not_judged, " conditions were past the judge's budget."),
            told(failures, " calls of the judge failed."),
            told(ungrounded, " contextual facts could not be found again."),
        )
    )


def upstream_questions(gaps: DataFrame, project: str, version: str = "version") -> DataFrame:
    """A question for each version without evidence."""
    return gaps.select(F.concat(F.lit(f"Nothing was collected for {project} "), F.col(version).cast("string"), F.lit("; its changes are unknown.")).alias("question"))
