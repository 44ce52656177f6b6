"""Confidence of conditions and paths, corroboration, severity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import rubrics
from claimloom.functions.vocabulary import SEVERE, TRUST_TIERS, rank, ranked


def corroboration(rows: DataFrame, key: str, root: str, source: str) -> DataFrame:
    """key and how many distinct sources hold the passage, exact copies included."""
    counts = rows.groupBy(root).agg(F.count_distinct(source).alias("n_sources"))
    return rows.select(key, root).join(counts, root).select(key, "n_sources")


def graded(conditions: DataFrame) -> DataFrame:
    """Adds low_reasons, missing and confidence.

    Columns: cited, grounded, verdict, role, n_speculative, n_implied, best_rank (place of the best
    tier, null without a source), lost, unresolved, touching and unsupported.
    """
    low, missing = rubrics.condition_reasons(
        F.col("grounded"), F.col("cited"), F.col("verdict"), F.col("role"),
        (F.col("cited") > 0) & (F.col("n_speculative") == F.col("cited")), ranked(F.col("best_rank"), TRUST_TIERS),
        F.col("lost"), F.col("unresolved"), F.col("unsupported"), F.col("n_implied") > 0, F.col("touching"),
    )
    graded = conditions.withColumns({"low_reasons": low, "missing": missing})
    return graded.withColumn("confidence", rubrics.condition_confidence(F.col("low_reasons"), F.col("missing")))


def downgraded(conditions: DataFrame) -> DataFrame:
    """Conditions without ground or against the judge become uncertain and not required; none is removed."""
    doubtful = ((F.col("grounded") == 0) & (F.col("cited") > 0)) | F.col("verdict").isin("contradicts", "unrelated")
    role = F.when(doubtful, "uncertain").otherwise(F.col("role"))
    return conditions.withColumn("preliminary_role", F.col("role")).withColumn("role", role).withColumn("required", F.col("role") == "required")


def restored(conditions: DataFrame) -> DataFrame:
    """Back to the state before verification, so that verifying again starts from the same point."""
    return conditions.withColumn("role", F.coalesce("preliminary_role", "role")).withColumn("required", F.col("role") == "required").drop("preliminary_role", "low_reasons", "missing", "confidence")


def path_confidence(conditions: DataFrame, path: str = "path") -> DataFrame:
    """A path is as sure as its weakest required or alternative condition, or its weakest if it has none of those."""
    core = F.col("role").isin("required", "alternative")
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    grouped = conditions.groupBy(path).agg(
        any_of(core).alias("has_core"),
        any_of(core & (F.col("confidence") == "low")).alias("core_low"),
        any_of(core & (F.col("confidence") != "high")).alias("core_not_high"),
        any_of(F.col("confidence") == "low").alias("any_low"),
        any_of(F.col("confidence") != "high").alias("any_not_high"),
    )
    low = F.when(F.col("has_core"), F.col("core_low")).otherwise(F.col("any_low"))
    not_high = F.when(F.col("has_core"), F.col("core_not_high")).otherwise(F.col("any_not_high"))
    return grouped.select(path, F.when(low, "low").when(not_high, "medium").otherwise("high").alias("confidence"))


def path_flags(conditions: DataFrame, paths: DataFrame, path: str = "path") -> DataFrame:
    """The five flags of each path. Conditions have grounded, cited, verdict, touching, role and sources; paths have level."""
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    grouped = conditions.groupBy(path).agg(
        any_of((F.col("grounded") == 0) & (F.col("cited") > 0)).alias("ungrounded_condition"),
        any_of(F.col("verdict").isin("contradicts", "unrelated")).alias("judge_disputed_condition"),
        any_of(F.col("touching") > 0).alias("source_disagreement"),
        F.size(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("n_sources"),
        (~any_of(F.col("role").isin("required", "alternative"))).alias("no_required_condition"),
    )
    single = F.col("level").isin(*SEVERE) & (F.col("n_sources") == 1)
    return grouped.join(paths.select(path, "level"), path).withColumn("single_source_severe", single).drop("level", "n_sources")


def severity(facts: DataFrame, level: str, path: str = "path") -> DataFrame:
    """path, level and the level that its facts can carry (heading, quote, change and certainty of each cited fact)."""
    every = lambda c: F.bool_and(c)
    grouped = facts.groupBy(path).agg(
        F.first(level, ignorenulls=True).alias("level") if level != "level" else F.max("level").alias("level"),
        every(F.col("heading").rlike(rubrics.EXPERIMENTAL)).alias("experimental"),
        every(F.col("quote").rlike(rubrics.BUG_FIX)).alias("bug_fix"),
        every((F.col("change") == "security_fix") | F.col("quote").rlike(rubrics.SECURITY_FIX)).alias("security"),
        every(F.col("certainty") != "explicit").alias("none_explicit"),
    )
    cap = rubrics.severity_cap(F.col("experimental"), F.col("bug_fix"), F.col("security"), F.col("none_explicit"))
    return grouped.select(path, "level", rubrics.capped(F.col("level"), cap).alias("capped_level"))


def preliminary(facts: DataFrame, condition: str = "condition") -> DataFrame:
    """condition and its confidence before verification, from role, certainty and tier of the cited facts."""
    grouped = facts.groupBy(condition).agg(F.max("role").alias("role"), F.collect_set("certainty").alias("certainties"), F.collect_set("tier").alias("tiers"))
    return grouped.select(condition, rubrics.preliminary_confidence(F.col("role"), F.col("certainties"), F.col("tiers")).alias("confidence"))


def best_tier(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.min_by("tier", rank(F.col("tier"), TRUST_TIERS)).alias("best_tier"))
