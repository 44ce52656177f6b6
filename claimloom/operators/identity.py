"""Project identity: additive scores of candidates, groups of one identity, and the choice among them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.functions.text import alphanumeric
from claimloom.operators import numbering

LEAST_SCORE, LEAST_MARGIN = 6, 3
# Words that mark software around another.
ANCILLARY = r"(?i)\b(client|driver|wrapper|bindings|plugin|adapter|sdk|operator|tutorial|example|boilerplate|template|orm)\b"
# Hosts that belong to no project.
COMMON_HOSTS = ("github.com", "pypi.org", "www.npmjs.com", "registry.npmjs.org")


def package_names(project: str) -> list[str]:
    """The names a package may have: the project's, and that without .js."""
    name = project.strip().lower()
    return [name, name.removesuffix(".js")] if name.endswith(".js") else [name]


def score(candidates: DataFrame, project: str) -> DataFrame:
    """Adds ``score``, ``reasons`` and ``rejected``.

    Columns: name, description, repository, homepage, kind, fork and reciprocal.
    """
    brand = re.sub("[^a-z0-9]", "", project.lower())
    named = alphanumeric(F.col("name"))
    labels = F.transform(F.split(urls.host(F.col("homepage")), r"\."), alphanumeric)
    branded = F.arrays_overlap(labels, F.array(*(F.lit(brand + e) for e in ("", "project", "framework")))) & ~urls.host(F.col("homepage")).isin(*COMMON_HOSTS)
    last = alphanumeric(F.element_at(F.split("repository", "/"), -1))
    packages = [re.sub("[^a-z0-9]", "", n) for n in package_names(project)]
    ancillary = F.lit(not re.search(ANCILLARY, project)) & F.col("description").rlike(ANCILLARY)
    terms: list[tuple[Column, int, str]] = [
        (named == brand, 4, "name"),
        ((F.col("repository") != "") & (last == brand), 3, "repository"),
        (F.lit(bool(brand)) & branded, 4, "homepage"),
        (F.col("description").rlike(rf"(?i)(?<![\p{{L}}\p{{N}}_]){re.escape(project)}(?![\p{{L}}\p{{N}}_])"), 2, "description"),
        (ancillary, -8, "ancillary"),
        (F.col("fork"), -10, "fork"),
        (F.col("reciprocal"), 4, "reciprocal"),
        (F.col("kind").isin("npm", "pypi") & ~named.isin(*packages), -12, "other_component"),
    ]
    holds = [(F.coalesce(c, F.lit(False)), n, r) for c, n, r in terms]
    total = sum((F.when(c, n).otherwise(0) for c, n, _ in holds), F.lit(0)).cast("bigint")
    reasons = F.array_compact(F.array(*(F.when(c, r) for c, _, r in holds)))
    return candidates.withColumns({"score": total, "reasons": reasons}).withColumn("rejected", F.col("score") < 0)


def merged(candidates: DataFrame) -> DataFrame:
    """One row per url: the first by ``position``, with the evidence of all, first seen first."""
    all_evidence = F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("position", "evidence"))), lambda x: x.evidence)))
    columns = [c for c in candidates.columns if c not in ("url", "evidence")]
    return candidates.groupBy("url").agg(*(F.min_by(c, "position").alias(c) for c in columns), all_evidence.alias("evidence")).select(*candidates.columns)


def identity_key() -> Column:
    """Candidates with one repository are one identity; sites go by host; everything else by its address."""
    return (
        F.when(F.col("repository") != "", F.concat(F.lit("github:"), F.lower("repository")))
        .when(F.col("kind") == "html", F.concat(F.lit("site:"), F.coalesce(F.nullif(urls.host(F.col("url")), F.lit("")), F.lower("url"))))
        .otherwise(F.concat_ws(":", "kind", F.lower("url")))
    )


def preference() -> Column:
    """Lower is preferred on a tie: search results, repositories, packages, others."""
    return F.when(F.col("from_search"), 0).when(F.col("kind") == "github", 1).when(F.col("kind").isin("npm", "pypi"), 2).otherwise(3)


def ranked(scored: DataFrame) -> DataFrame:
    """identity, score, preference and members of each group of candidates that are not rejected, with its rank."""
    rows = scored.filter("NOT rejected").withColumns({"identity": identity_key(), "preference": preference()})
    groups = rows.groupBy("identity").agg(
        F.max("score").alias("score"),
        F.min_by("preference", F.struct(-F.col("score"), F.col("preference"))).cast("bigint").alias("preference"),
        F.count("*").alias("members"),
    )
    return numbering.placed(groups, "rank", (), [-F.col("score"), "preference", "identity"])


def chosen(groups: DataFrame) -> DataFrame:
    """The first identity if its score and its margin suffice, or preference breaks an exact tie."""
    order = Window.orderBy("rank")
    top = groups.filter("rank <= 2").withColumns({"next_score": F.lead("score").over(order), "next_preference": F.lead("preference").over(order)}).filter("rank = 1")
    margin = F.col("next_score").isNull() | (F.col("score") - F.col("next_score") >= LEAST_MARGIN)
    tie = (F.col("score") == F.col("next_score")) & (F.col("preference") < F.col("next_preference"))
    return top.withColumn("status", F.when((F.col("score") >= LEAST_SCORE) & (margin | tie), "resolved").otherwise("ambiguous"))
