"""Closed and ordered word lists; an order is a rank, never the order of the strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each list in its semantic order, best or most severe first.
RISK_LEVELS = ("critical", "high", "medium", "low", "unknown")
CONFIDENCE = ("high", "medium", "low")
TRUST_TIERS = ("official", "probable_official", "official_repository_discussion", "third_party")
SOURCE_KINDS = (
    "upgrade_guide", "release_notes", "github_release", "deprecation_notice", "api_documentation",
    "registry_metadata", "github_pull_request", "github_issue", "blog_post", "supporting_document",
)
DISCOVERY = ("resolver_release_record", "repository_document", "resolver_homepage", "linked_context")
RELEASE_KINDS = ("release_notes", "github_release")
CHANGE_KINDS = (*RELEASE_KINDS, "upgrade_guide", "deprecation_notice")
RISK_TYPES = (
    "removed_api", "changed_behavior", "changed_default", "dependency_requirement", "runtime_requirement",
    "configuration_change", "data_migration", "operational_risk", "unknown",
)
RELEVANCE = ("risk_candidate", "context", "not_relevant")
SEVERE = ("critical", "high")
SEVERE_FOR_GOLD = ("critical", "high", "medium")
SHARED_HOSTS = ("github.io", "readthedocs.io", "netlify.app", "vercel.app", "pages.dev", "gitlab.io")


def rank(value: Column, order: Sequence[str]) -> Column:
    """Place of ``value`` in ``order`` from 0; whatever is not there comes last."""
    place = F.array_position(F.array(*map(F.lit, order)), value)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(order))).cast("int")


def ranked(place: Column, order: Sequence[str]) -> Column:
    """The value at a place that ``rank`` gave; null past the end."""
    return F.get(F.array(*map(F.lit, order)), place.cast("int"))
