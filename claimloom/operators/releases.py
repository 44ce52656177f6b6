"""Release catalogs: intervals, endpoints, milestones, coverage, agreement, choice.

Input rows are releases: ``catalog``, ``version`` (label), ``position`` (order in the catalog).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import versions as v


def keyed(releases: DataFrame, label: str = "version", projects: Sequence[str] = ()) -> DataFrame:
    """Adds ``key``; labels without one keep a null."""
    return releases.withColumn("key", v.version_key(F.col(label), projects))


def skipped_labels(releases: DataFrame, label: str = "version", projects: Sequence[str] = ()) -> DataFrame:
    """The rows whose labels are no versions."""
    return keyed(releases, label, projects).filter("key IS NULL").drop("key")


def select(releases: DataFrame, current: str, target: str, mode: str = "family") -> DataFrame:
    """Releases of the interval, one per catalog and version (the first stays), numbered upwards in ``place``."""
    inside = keyed(releases).filter(v.in_interval(F.col("key"), current, target, mode))
    first = Window.partitionBy("catalog", "key").orderBy("position", "version")
    place = Window.partitionBy("catalog").orderBy("key")
    single = inside.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    return single.withColumn("place", F.row_number().over(place).cast("bigint"))


def endpoint_checks(releases: DataFrame, current: str, target: str, mode: str = "family") -> DataFrame:
    """Whether each catalog lists both endpoints."""
    has = lambda e: F.coalesce(F.bool_or(v.is_endpoint(F.col("key"), e, mode)), F.lit(False))
    return keyed(releases).groupBy("catalog").agg(has(current).alias("current_found"), has(target).alias("target_found"))


def milestones(selected: DataFrame, numbers: int) -> DataFrame:
    """The documentation milestones of each catalog's releases, in order."""
    cut = selected.select("catalog", F.slice("key", 1, numbers).alias("m")).distinct()
    place = F.row_number().over(Window.partitionBy("catalog").orderBy("m")).cast("bigint")
    return cut.select("catalog", v.milestone(F.col("m"), numbers).alias("milestone"), place.alias("place"))


def coverage(releases: DataFrame, current: str, target: str, mode: str = "family") -> DataFrame:
    """Per catalog: endpoint checks, releases in the interval, how many are finer than the target, and the granularity."""
    numbers = target.count(".") + 1
    counts = select(releases, current, target, mode).groupBy("catalog").agg(
        F.count("*").alias("interval_count"), F.count_if(v.precision(F.col("version")) > numbers).alias("detailed_count")
    )
    both = endpoint_checks(releases, current, target, mode).join(counts, "catalog", "left").fillna(0, ["interval_count", "detailed_count"])
    return both.withColumn("granularity", F.when(F.col("detailed_count") > 0, "detailed_releases").otherwise("endpoint_precision_only"))


def agreement(selected: DataFrame) -> DataFrame:
    """Pairs of catalogs with the same releases: equal sets are met by a hash of the sorted set, then compared."""
    sets = selected.groupBy("catalog").agg(F.sort_array(F.collect_set("version")).alias("versions"))
    sets = sets.withColumn("h", F.xxhash64(F.to_json("versions")))
    a, b = sets.alias("a"), sets.alias("b")
    return a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.versions") == F.col("b.versions")) & (F.col("a.catalog") != F.col("b.catalog"))).select(
        F.col("a.catalog").alias("catalog"), F.col("b.catalog").alias("matching")
    )


def choose(covered: DataFrame, *order: Column, by: Sequence[str] = ()) -> DataFrame:
    """The best usable catalog (with releases in the interval) by ``order``, one for each value of ``by``."""
    usable = covered.filter("interval_count > 0")
    if not by:
        return usable.orderBy(*order).limit(1)
    return usable.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("n = 1").drop("n")


def catalog_order() -> list[Column]:
    """Authority first, then endpoints, completeness, preference, detail and address."""
    missing = F.when(F.col("current_found") & F.col("target_found"), 0).otherwise(1)
    coarse = F.when(F.col("granularity") == "detailed_releases", 0).otherwise(1)
    return [F.desc("authority"), missing, F.when(F.col("complete"), 0).otherwise(1), F.col("preference"), coarse, F.col("catalog")]


def with_fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All of ``first``, and what ``second`` has under keys that ``first`` lacks."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))


def dispatched(registry: DataFrame, final: DataFrame, tags: DataFrame, pages: DataFrame, current: str, target: str, mode: str = "family") -> DataFrame:
    """Releases of each catalog by its kind, with the reader they come from.

    Columns: catalog, kind, version, position; ``final`` (a repository's releases) also complete. Registries are read as they are.
    Tags of a repository are taken as well where its releases are incomplete or lack an endpoint, and pages where nothing else lists any.
    """
    own = lambda df, reader: df.select("catalog", "version", "position", F.lit(reader).alias("reader"))
    whole = final.groupBy("catalog").agg(F.bool_and("complete").alias("complete"))
    ends = endpoint_checks(final, current, target, mode)
    enough = whole.join(ends, "catalog").filter("complete AND current_found AND target_found").select("catalog")
    more = tags.join(enough, "catalog", "left_anti")
    first = own(registry, "registry").unionByName(own(final, "releases")).unionByName(own(more, "tags"))
    return first.unionByName(own(pages.join(first.select("catalog").distinct(), "catalog", "left_anti"), "pages"))


def indexed(links: DataFrame, current: str, target: str, mode: str = "family") -> DataFrame:
    """Links of release index pages: label (a release they name), relevance to the interval, and whether they are followed.

    Links: page, href, text. Links to other hosts go; one that names a release outside of the interval is not followed.
    """
    from claimloom.functions import urls

    href, text = urls.without_fragment(F.col("href")), F.col("text")
    near = links.withColumn("href", href).filter(urls.host(F.col("href")) == urls.host(F.col("page")))
    early = text.rlike(r"(?i)alpha|beta|\brc\b|preview|candidate")
    inner = F.regexp_extract(text, r"(?i)(?:^|[^\w.])(v?[0-9]+(?:\.[0-9]+){0,3})(?:$|[^\w.-])", 1)
    named = F.when(text.rlike("(?i)release|version|changelog") & ~early, F.nullif(inner, F.lit("")))
    label = F.when(v.numeric_label(text).isNotNull(), text).otherwise(named)
    placed = F.nullif(F.regexp_extract(urls.path(F.col("href")), r"(?:release[-/]|/)([0-9]+(?:[.-][0-9]+){0,3})(?:/|\.html|$)", 1), F.lit(""))
    key = F.coalesce(v.version_key(F.col("label")), v.version_key(F.translate(placed, "-", ".")))
    both = F.concat(text, F.lit(" "), F.col("href"))
    base = F.when(both.rlike("(?i)release|changelog|upgrade"), 4).when(text.rlike("(?i)documentation|download"), 1).otherwise(0)
    inside = F.coalesce(v.in_scope(F.col("key"), current, target, mode), F.lit(True))
    points = base + F.when(F.col("key").isNotNull() & inside, 5).otherwise(0)
    found = near.withColumn("label", label).withColumn("key", key).withColumn("relevance", points.cast("bigint"))
    followed = inside & (F.col("relevance") > 0) & ~urls.path(F.col("href")).rlike(r"\.(?:zip|gz|xz|exe|pdf)$")
    return found.select("page", "href", "label", "relevance", followed.alias("followed"))


def index_crawl(links: DataFrame, root: str, current: str, target: str, mode: str = "family", most_pages: int = 8) -> DataFrame:
    """catalog (the root), version and page of the releases that a site's index pages name, best pages first, ``most_pages`` at most.

    Pages are read by relevance, then address; what a page links to goes before worse pages that wait.
    """
    from claimloom.operators import frontier

    marked = indexed(links, current, target, mode)
    edges = marked.filter("followed").select(F.col("page").alias("src"), F.col("href").alias("dst"), "relevance").distinct()
    read = frontier.best_first(edges, root, most_pages).select(F.col("url").alias("page"))
    return marked.join(F.broadcast(read), "page").filter("label IS NOT NULL").select(F.lit(root).alias("catalog"), F.col("label").alias("version"), "page").distinct()


def tag_matches(tags: DataFrame, records: DataFrame, tag: str = "tag", version: str = "version") -> DataFrame:
    """(tag, version) of records that a tag names by its very label or by equal numbers: two equi-joins, no condition with OR."""
    raw = tags.join(records, F.col(tag) == F.col("raw_version")).select(tag, version)
    keyed_tags = tags.withColumn("__k", v.version_key(F.col(tag))).filter("__k IS NOT NULL")
    keyed_records = records.withColumn("__v", v.version_key(F.col(version))).filter("__v IS NOT NULL")
    numeric = keyed_tags.join(keyed_records, F.col("__k") == F.col("__v")).select(tag, version)
    return raw.unionByName(numeric).distinct()
