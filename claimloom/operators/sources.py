"""Sources: trust, exclusion, rank, and why they are relevant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.functions.vocabulary import DISCOVERY, SOURCE_KINDS, TRUST_TIERS, rank
from claimloom.operators import numbering


def with_trust(documents: DataFrame, identity: DataFrame) -> DataFrame:
    """Adds tier and source_type. ``identity`` has one row: catalog, sites and repositories of the project."""
    joined = documents.crossJoin(F.broadcast(identity.limit(1)))  # one row
    tier = urls.trust_tier(F.col("url"), F.col("kind"), F.col("catalog"), F.col("sites"), F.col("repositories"), F.col("relation"))
    with_tier = joined.withColumn("tier", tier).drop("catalog", "sites", "repositories")
    return with_tier.withColumn("source_type", urls.source_type(F.col("url"), F.col("kind"), F.col("tier")))


def project_identity(addresses: DataFrame) -> DataFrame:
    """Sites and repositories of a project from its recorded addresses (``address``)."""
    own = addresses.select(urls.repository(F.regexp_replace("address", r"^git\+", "")).alias("r"), urls.host(F.regexp_replace("address", r"^git\+", "")).alias("h"))
    return own.agg(
        F.sort_array(F.collect_set(F.when(F.col("r").isNull() & (F.col("h") != "") & (F.col("h") != "github.com"), urls.site(F.col("h"))))).alias("sites"),
        F.sort_array(F.collect_set("r")).alias("repositories"),
    )


def exclusion(bases: Column, tier: Column) -> Column:
    """Why a source is left out, null if it is not: no version at all, or a third party known by a link only."""
    only_link = F.forall(bases, lambda b: b == "linked_context")
    return F.when(F.size(bases) == 0, "no_version").when((tier == "third_party") & only_link, "linked_only")


def ranked(sources: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``rank`` from 1: tier, kind, verified quotes downwards, url."""
    return numbering.placed(sources, "rank", by, [rank(F.col("tier"), TRUST_TIERS), rank(F.col("kind"), SOURCE_KINDS), F.coalesce(-F.col("verified_quotes").cast("bigint"), F.lit(1)), "url"])


def first_relation(relations: Column) -> Column:
    """The strongest of a document's discovery relations."""
    return F.get(F.array_sort(F.transform(relations, lambda r: F.struct(rank(r, DISCOVERY).alias("n"), r.alias("r")))), F.lit(0)).r


def why_relevant(relation: Column, title: Column, versions: Column, parent: Column, mentioned: Column, top_topics: Column) -> Column:
    """A sentence on why a source was kept."""
    listed = lambda c: F.array_join(c, ", ")
    reason = (
        F.when(relation == "resolver_release_record", F.concat(F.lit("Catalog record of "), listed(versions), F.lit(".")))
        .when(relation == "repository_document", F.concat(F.lit("Document of the project's repository: "), F.substring(title, 1, 80), F.lit(".")))
        .when(relation == "resolver_homepage", F.lit("The project's home page."))
        .when(relation == "linked_context", F.concat(F.lit("Linked from "), parent, F.lit(".")))
        .otherwise(F.lit("Supporting context."))
    )
    mention = F.when(F.size(mentioned) > 0, F.concat(F.lit("Names "), listed(F.sort_array(mentioned)), F.lit(".")))
    topic = F.when(F.size(top_topics) > 0, F.concat(F.lit("Topics: "), listed(top_topics), F.lit(".")))
    return F.concat_ws(" ", reason, mention, topic)
