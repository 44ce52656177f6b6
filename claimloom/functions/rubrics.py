"""Graded judgements as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import loose
from claimloom.functions.vocabulary import RISK_LEVELS, rank

# Thresholds, and the words that cap a severity.
RISK_AT, CONTEXT_AT = 2.5, 1.5
EXPERIMENTAL = r"(?i)\b(experimental|alpha|canary|unstable)\b"
BUG_FIX = r"(?i)^\W*fix(es|ed)?\b"
SECURITY_FIX = r"(?i)\bCVE-\d{4}-\d+|\bpotential (?:denial[- ]of[- ]service|sql injection|xss|redos)\b"


def relevance_label(score: Column) -> Column:
    return F.when(score >= RISK_AT, "risk_candidate").when(score >= CONTEXT_AT, "context").when(score.isNotNull(), "not_relevant")


def expected_score(probabilities: Column) -> Column:
    """The mean of the levels that are the keys of a distribution; null if a key is no number."""
    return F.aggregate(F.map_entries(probabilities), F.lit(0.0), lambda a, e: a + e.key.try_cast("double") * e.value)


def distribution_faults(probabilities: Column, choice: Column, score: Column, names: list[str], tolerance: float = 1e-3) -> Column:
    """What is wrong with a decision: unknown names, bad numbers, a wrong sum, a choice that is not the likeliest, a wrong score."""
    values = F.map_values(probabilities)
    return F.array_compact(
        F.array(
            F.when(F.size(F.array_except(F.map_keys(probabilities), F.array(*map(F.lit, names)))) > 0, "unknown_name"),
            F.when(F.size(probabilities) < len(names), "missing_name"),
            F.when(F.exists(values, lambda v: v.isNull() | F.isnan(v) | (v < 0) | (v > 1)), "not_a_probability"),
            F.when(F.abs(F.aggregate(values, F.lit(0.0), lambda a, v: a + v) - 1) > tolerance, "sum"),
            F.when(F.abs(F.try_element_at(probabilities, choice) - F.array_max(values)) > tolerance, "not_the_likeliest"),
            F.when(F.abs(expected_score(probabilities) - score) > tolerance, "score"),
        )
    )


def severity_cap(experimental: Column, bug_fix: Column, security: Column, none_explicit: Column) -> Column:
    """The highest level that a path's facts can carry, null if there is no cap; each argument holds for every cited fact."""
    return F.when(experimental | bug_fix | security, "low").when(none_explicit, "medium")


def capped(level: Column, cap: Column) -> Column:
    """The level, lowered to the cap; unknown stays."""
    lower = cap.isNotNull() & (level != "unknown") & (rank(level, RISK_LEVELS) < rank(cap, RISK_LEVELS))
    return F.when(lower, cap).otherwise(level)


def preliminary_confidence(role: Column, certainties: Column, tiers: Column) -> Column:
    """Confidence before verification, from the sets of certainties and tiers of the cited facts."""
    only = lambda have, value: F.size(F.array_except(have, F.array(F.lit(value)))) == 0
    low = (role == "uncertain") | (only(certainties, "speculative") & (F.size(certainties) > 0)) | only(tiers, "third_party")
    high = only(certainties, "explicit") & (F.size(certainties) > 0) & F.array_contains(tiers, "official")
    return F.when(low, "low").when(high, "high").otherwise("medium")


def condition_reasons(
    grounded: Column, cited: Column, verdict: Column, role: Column, all_speculative: Column, best_tier: Column,
    lost: Column, unresolved: Column, unsupported: Column, any_implied: Column, won: Column,
) -> tuple[Column, Column]:
    """(reasons for low, reasons against high) of one condition; counts and flags are columns."""
    low = F.array_compact(
        F.array(
            F.when((grounded == 0) & (cited > 0), "not_grounded"),
            F.when(verdict.isin("contradicts", "unrelated"), "judge_disputes"),
            F.when(role == "uncertain", "uncertain_role"),
            F.when(all_speculative, "speculative"),
            F.when(best_tier.isNull(), "no_verified_source"),
            F.when(best_tier == "third_party", "third_party_only"),
            F.when(lost > 0, "lost_conflict"),
            F.when(unresolved > 0, "unresolved_conflict"),
        )
    )
    missing = F.array_compact(
        F.array(
            F.when((grounded > 0) & (grounded < cited), "partly_grounded"),
            F.when(verdict == "not_checked", "not_judged"),
            F.when(verdict == "partially_supports", "partial_support"),
            F.when(F.coalesce(unsupported, F.lit(0.0)) >= 0.5, "adds_detail"),
            F.when(any_implied, "implied"),
            F.when(best_tier.isNotNull() & ~best_tier.isin("official", "third_party"), "not_official"),
            F.when((won > 0) & (lost == 0) & (unresolved == 0), "won_conflict"),
        )
    )
    return low, missing


def condition_confidence(low: Column, missing: Column) -> Column:
    return F.when(F.size(low) > 0, "low").when(F.size(missing) > 0, "medium").otherwise("high")


def claim_value(value: Column) -> Column:
    """The form in which claimed values are compared; empty for none."""
    return F.coalesce(F.lower(loose(value)), F.lit(""))


def disagreement(a: str, b: str, scoped: str = "scoped") -> Column:
    """How the facts aliased ``a`` and ``b`` disagree, null if they do not; the first kind that holds.

    Their ``value`` is a ``claim_value``, made once a fact and not once a pair.
    """
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    against = lambda p, q: (p("change") == "removed") & q("change").isin("deprecated", "replacement_recommended")
    value = (x("value") != "") & (y("value") != "") & (x("value") != y("value"))
    apart = x(scoped) & y(scoped) & ~F.arrays_overlap(x("versions"), y("versions"))
    return (
        F.when(against(x, y) | against(y, x), "severity")
        .when(x("is_risk") != y("is_risk"), "risk_vs_context")
        .when(x("change") != y("change"), F.lit(None).cast("string"))
        .when(value, "value")
        .when(apart, "versions")
    )


def overall_confidence(n: Column, high: Column, low: Column, may_be_high: Column) -> Column:
    """A whole model's confidence: low without paths or with most of them low; high needs three fifths and no doubt."""
    return F.when((n == 0) | (low * 2 > n), "low").when((high * 10 >= n * 6) & may_be_high, "high").otherwise("medium")


def preliminary_overall(n: Column, high: Column, low: Column, no_failure: Column) -> Column:
    """The same before verification, where high is asked first."""
    return F.when(n == 0, "low").when((high * 10 >= n * 6) & no_failure, "high").when(low * 2 > n, "low").otherwise("medium")
