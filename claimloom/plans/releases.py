"""Queries over releases, identities and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import text as t
from claimloom.functions import urls
from claimloom.functions import versions as v
from claimloom.operators import identity, releases, sources
from claimloom.plans import views
from claimloom.plans.catalogue import query
from claimloom.plans.views import HOST_SQL, KEY, KIND_SQL, RELEASE_SQL, SITE_SQL, SOURCE_SQL, TIER_RANK_SQL, TIER_SQL, TITLE_SQL
from claimloom.session import table


def _selected(low: str, high: str) -> str:
    return f"""SELECT catalog, version, position, key, row_number() OVER (PARTITION BY catalog ORDER BY key) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY catalog, key ORDER BY position, version) AS n FROM (SELECT *, {KEY} AS key FROM ({RELEASE_SQL}))
  WHERE key[1] * 1000 + key[2] {low} AND key[1] * 1000 + key[2] {high}) WHERE n = 1"""


_FAMILY = _selected(">= 11000", "< 21000")


@query("interval_family", f"SELECT catalog, version, position, place FROM ({_FAMILY})")
def interval_family(spark, sf_dir):
    return releases.select(views.releases(spark, sf_dir), "10", "20").select("catalog", "version", "position", "place")


@query("interval_exact", f"SELECT catalog, version, position, place FROM ({_selected('> 10005', '<= 20003')})")
def interval_exact(spark, sf_dir):
    return releases.select(views.releases(spark, sf_dir), "10.5", "20.3", "exact").select("catalog", "version", "position", "place")


_ENDPOINTS = f"""SELECT catalog, bool_or(key >= [10, 0, 0, 0] AND key < [11, 0, 0, 0]) AS current_found, bool_or(key >= [20, 0, 0, 0] AND key < [21, 0, 0, 0]) AS target_found
FROM (SELECT *, {KEY} AS key FROM ({RELEASE_SQL})) GROUP BY catalog"""


@query("endpoint_checks", _ENDPOINTS)
def endpoint_checks(spark, sf_dir):
    return releases.endpoint_checks(views.releases(spark, sf_dir), "10", "20")


@query("milestones", f"SELECT catalog, CAST(m AS VARCHAR) AS milestone, row_number() OVER (PARTITION BY catalog ORDER BY m) AS place FROM (SELECT DISTINCT catalog, key[1] AS m FROM ({_FAMILY}))")
def milestones(spark, sf_dir):
    return releases.milestones(releases.select(views.releases(spark, sf_dir), "10", "20"), 1)


_LABEL_SQL = """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'v' || n WHEN 1 THEN 'release-' || n WHEN 2 THEN 'REL_' || replace(n, '.', '_') WHEN 3 THEN 'refs/tags/v' || n
  WHEN 4 THEN 'orbit@' || n WHEN 5 THEN n || '-rc.1' WHEN 6 THEN 'nightly' ELSE ' ' || n || ' ' END AS label FROM (SELECT p_partkey, p_size || '.' || (p_partkey % 10) AS n FROM part)"""


def _labels(spark, sf_dir):
    n = F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 10).cast("string"))
    k = F.col("p_partkey") % 8
    label = (
        F.when(k == 0, F.concat(F.lit("v"), n)).when(k == 1, F.concat(F.lit("release-"), n)).when(k == 2, F.concat(F.lit("REL_"), F.translate(n, ".", "_")))
        .when(k == 3, F.concat(F.lit("refs/tags/v"), n)).when(k == 4, F.concat(F.lit("orbit@"), n)).when(k == 5, F.concat(n, F.lit("-rc.1"))).when(k == 6, "nightly")
        .otherwise(F.concat(F.lit(" "), n, F.lit(" ")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


_NUMERIC_SQL = rf"""SELECT p_partkey, label, CASE WHEN regexp_full_match(n, '[0-9]+(\.[0-9]+){{0,3}}') THEN n END AS numeric_label FROM (
  SELECT p_partkey, label, replace(regexp_replace(regexp_replace(regexp_replace(trim(label), '(?i)^refs/tags/', ''), '(?i)^orbit[-_@](v?[0-9])', '\1'),
    '(?i)^(?:version[-_ ]?|release[-_ ]?|rel[-_]|v)([0-9])', '\1'), '_', '.') AS n FROM ({_LABEL_SQL}))"""


@query("label_normalize", _NUMERIC_SQL)
def label_normalize(spark, sf_dir):
    return _labels(spark, sf_dir).withColumn("numeric_label", v.numeric_label(F.col("label"), ["orbit"]))


@query("label_skipped", f"SELECT p_partkey, label FROM ({_NUMERIC_SQL}) WHERE numeric_label IS NULL")
def label_skipped(spark, sf_dir):
    return releases.skipped_labels(_labels(spark, sf_dir), "label", ["orbit"])


_COVERAGE = f"""SELECT e.*, coalesce(c.n, 0) AS interval_count, coalesce(c.d, 0) AS detailed_count,
  CASE WHEN coalesce(c.d, 0) > 0 THEN 'detailed_releases' ELSE 'endpoint_precision_only' END AS granularity
FROM ({_ENDPOINTS}) e LEFT JOIN (SELECT catalog, count(*) AS n, count_if(len(string_split(version, '.')) > 1) AS d FROM ({_FAMILY}) GROUP BY catalog) c ON c.catalog = e.catalog"""


@query("catalog_coverage", _COVERAGE)
def catalog_coverage(spark, sf_dir):
    return releases.coverage(views.releases(spark, sf_dir), "10", "20")


_NARROW = _selected(">= 40000", "< 41000")


@query("catalog_agreement", f"""WITH s AS (SELECT catalog, list_sort(list(DISTINCT version)) AS vs FROM ({_NARROW}) GROUP BY catalog)
SELECT a.catalog, b.catalog AS matching FROM s a JOIN s b ON a.vs = b.vs AND a.catalog <> b.catalog""")
def catalog_agreement(spark, sf_dir):
    return releases.agreement(releases.select(views.releases(spark, sf_dir), "39", "40"))


@query("catalog_select", f"""SELECT catalog, team, interval_count FROM (SELECT *, row_number() OVER (PARTITION BY team ORDER BY authority DESC,
    CASE WHEN current_found AND target_found THEN 0 ELSE 1 END, CASE WHEN complete THEN 0 ELSE 1 END, preference, CASE WHEN granularity = 'detailed_releases' THEN 0 ELSE 1 END, catalog) AS n
  FROM (SELECT *, length(catalog) % 3 AS authority, CAST(substr(catalog, 7) AS BIGINT) % 5 AS team, CAST(substr(catalog, 7) AS BIGINT) % 2 = 0 AS complete, CAST(substr(catalog, 7) AS BIGINT) % 4 AS preference
    FROM ({_COVERAGE})) WHERE interval_count > 0) WHERE n = 1""")
def catalog_select(spark, sf_dir):
    number = F.expr("bigint(substr(catalog, 7))")
    found = releases.coverage(views.releases(spark, sf_dir), "10", "20").withColumns(
        {"authority": F.length("catalog") % 3, "team": number % 5, "complete": number % 2 == 0, "preference": number % 4}
    )
    return releases.choose(found, *releases.catalog_order(), by=("team",)).select("catalog", "team", "interval_count")


def _candidates(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    k = F.col("s_suppkey") % 5
    return table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(  # 25 rows
        "s_suppkey",
        F.when(k == 0, F.col("n_name")).otherwise(F.col("s_name")).alias("name"),
        F.concat(F.lit("https://x.example.com/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.when(k < 3, F.concat(F.lit("Org"), (F.col("s_suppkey") % 3).cast("string"), F.lit("/"), F.col("n_name"))).otherwise("").alias("repository"),
        F.concat(F.lit("https://www."), F.lower(F.regexp_replace("n_name", "[^A-Za-z]", "")), F.lit(".example.com/")).alias("homepage"),
        F.when(k == 1, F.concat(F.lit("A client of "), F.col("n_name"))).otherwise(F.concat(F.lit("About "), F.col("n_name"), F.lit("."))).alias("description"),
        F.when(k == 0, "github").when(k == 1, "npm").when(k == 2, "pypi").otherwise("html").alias("kind"),
        (F.col("s_suppkey") % 7 == 0).alias("fork"),
        (F.col("s_suppkey") % 4 == 0).alias("reciprocal"),
        (F.col("s_suppkey") % 6 == 0).alias("from_search"),
    )


_CANDIDATE_SQL = """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN n_name ELSE s_name END AS name, 'https://x.example.com/' || s_suppkey AS url,
  CASE WHEN s_suppkey % 5 < 3 THEN 'Org' || (s_suppkey % 3) || '/' || n_name ELSE '' END AS repository, lower(regexp_replace(n_name, '[^A-Za-z]', '', 'g')) AS label,
  CASE WHEN s_suppkey % 5 = 1 THEN 'A client of ' || n_name ELSE 'About ' || n_name || '.' END AS description, n_name,
  CASE s_suppkey % 5 WHEN 0 THEN 'github' WHEN 1 THEN 'npm' WHEN 2 THEN 'pypi' ELSE 'html' END AS kind,
  s_suppkey % 7 = 0 AS fork, s_suppkey % 4 = 0 AS reciprocal, s_suppkey % 6 = 0 AS from_search FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
_PROJECT_SQL = "(SELECT lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) FROM nation WHERE n_nationkey = 2)"
_SCORE_SQL = f"""SELECT *, CAST((CASE WHEN brand THEN 4 ELSE 0 END) + (CASE WHEN repository <> '' AND lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) = {_PROJECT_SQL} THEN 3 ELSE 0 END)
  + (CASE WHEN label IN ({_PROJECT_SQL}, {_PROJECT_SQL} || 'project', {_PROJECT_SQL} || 'framework') THEN 4 ELSE 0 END)
  + (CASE WHEN n_name = (SELECT n_name FROM nation WHERE n_nationkey = 2) THEN 2 ELSE 0 END) + (CASE WHEN s_suppkey % 5 = 1 THEN -8 ELSE 0 END)
  + (CASE WHEN fork THEN -10 ELSE 0 END) + (CASE WHEN reciprocal THEN 4 ELSE 0 END) + (CASE WHEN kind IN ('npm', 'pypi') AND NOT brand THEN -12 ELSE 0 END) AS BIGINT) AS score
FROM (SELECT *, lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) = {_PROJECT_SQL} AS brand FROM ({_CANDIDATE_SQL}))"""


def _scored(spark, sf_dir):
    project = table(spark, sf_dir, "nation").filter("n_nationkey = 2").first()["n_name"]
    return identity.score(_candidates(spark, sf_dir), project)


@query("identity_score", f"SELECT s_suppkey, score, score < 0 AS rejected FROM ({_SCORE_SQL})")
def identity_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("s_suppkey", "score", "rejected")


_RANK_SQL = f"""SELECT identity, score, preference, members, row_number() OVER (ORDER BY score DESC, preference, identity) AS rank FROM (
  SELECT identity, max(score) AS score, arg_min(preference, (-score, preference)) AS preference, count(*) AS members FROM (
    SELECT *, CASE WHEN repository <> '' THEN 'github:' || lower(repository) WHEN kind = 'html' THEN 'site:x.example.com' ELSE kind || ':' || lower(url) END AS identity,
      CAST(CASE WHEN from_search THEN 0 WHEN kind = 'github' THEN 1 WHEN kind IN ('npm', 'pypi') THEN 2 ELSE 3 END AS BIGINT) AS preference FROM ({_SCORE_SQL}) WHERE score >= 0) GROUP BY identity)"""


@query("identity_rank", _RANK_SQL)
def identity_rank(spark, sf_dir):
    return identity.ranked(_scored(spark, sf_dir))


@query("identity_choice", f"""SELECT identity, score, CASE WHEN score >= 6 AND (next_score IS NULL OR score - next_score >= 3 OR (score = next_score AND preference < next_preference)) THEN 'resolved' ELSE 'ambiguous' END AS status
FROM (SELECT *, lead(score) OVER (ORDER BY rank) AS next_score, lead(preference) OVER (ORDER BY rank) AS next_preference FROM ({_RANK_SQL})) WHERE rank = 1""")
def identity_choice(spark, sf_dir):
    return identity.chosen(identity.ranked(_scored(spark, sf_dir))).select("identity", "score", "status")


@query("host_site", f"SELECT page_id, host, {SITE_SQL} AS site FROM (SELECT page_id, {HOST_SQL} AS host FROM pages)")
def host_site(spark, sf_dir):
    host = urls.host(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), urls.site(host).alias("site"))


@query("url_classify", f"SELECT page_id, {KIND_SQL} AS kind FROM (SELECT page_id, url, {TITLE_SQL} AS title FROM pages)")
def url_classify(spark, sf_dir):
    from claimloom.operators.sections import page_title

    return table(spark, sf_dir, "pages").select("page_id", urls.document_kind(F.col("url"), page_title(F.col("html"))).alias("kind"))


def _trusted(spark, sf_dir):
    own = table(spark, sf_dir, "pages").agg(F.min("url").alias("catalog"))
    own = own.select("catalog", F.array(F.lit("example.org")).alias("sites"), F.array().cast("array<string>").alias("repositories"))
    return sources.with_trust(views.sources(spark, sf_dir), own)


_TRUSTED_SQL = f"SELECT *, {TIER_SQL} AS tier FROM ({SOURCE_SQL})"


@query("trust_tier", f"SELECT page_id, tier FROM ({_TRUSTED_SQL})")
def trust_tier(spark, sf_dir):
    return _trusted(spark, sf_dir).select("page_id", "tier")


@query("source_type", f"""SELECT page_id, CASE kind WHEN 'release_notes' THEN CASE WHEN regexp_matches(url, '(?i)changelog|changes\\.(?:md|rst|txt)') THEN CASE WHEN o THEN 'official_changelog' ELSE 'changelog' END
    WHEN o THEN 'official_release_notes' ELSE 'release_notes' END WHEN 'upgrade_guide' THEN CASE WHEN o THEN 'official_migration_guide' ELSE 'migration_guide' END
  WHEN 'api_documentation' THEN CASE WHEN o THEN 'official_api_documentation' ELSE 'third_party_documentation' END WHEN 'blog_post' THEN CASE WHEN o THEN 'maintainer_blog_post' ELSE 'community_writeup' END
  WHEN 'supporting_document' THEN CASE WHEN o THEN 'official_documentation' ELSE 'community_writeup' END WHEN 'registry_metadata' THEN 'package_registry_metadata' ELSE kind END AS source_type
FROM (SELECT *, tier IN ('official', 'probable_official') AS o FROM ({_TRUSTED_SQL}))""")
def source_type(spark, sf_dir):
    return _trusted(spark, sf_dir).select("page_id", "source_type")


_KIND_RANK_SQL = """CASE kind WHEN 'upgrade_guide' THEN 0 WHEN 'release_notes' THEN 1 WHEN 'github_release' THEN 2 WHEN 'deprecation_notice' THEN 3 WHEN 'api_documentation' THEN 4
  WHEN 'registry_metadata' THEN 5 WHEN 'github_pull_request' THEN 6 WHEN 'github_issue' THEN 7 WHEN 'blog_post' THEN 8 WHEN 'supporting_document' THEN 9 ELSE 10 END"""


@query("source_rank", f"""SELECT page_id, site, row_number() OVER (PARTITION BY site ORDER BY {TIER_RANK_SQL}, {_KIND_RANK_SQL}, verified_quotes DESC, url, page_id) AS rank
FROM (SELECT *, {SITE_SQL} AS site FROM ({_TRUSTED_SQL}))""")
def source_rank(spark, sf_dir):
    rows = _trusted(spark, sf_dir).withColumn("site", urls.site(urls.host(F.col("url"))))
    unique = rows.withColumn("url", F.concat_ws(" ", "url", F.format_string("%09d", "page_id")))
    return sources.ranked(unique, ("site",)).select("page_id", "site", "rank")


@query("source_exclusion", f"""SELECT page_id, CASE WHEN n_bases = 0 THEN 'no_version' WHEN tier = 'third_party' AND n_bases = 1 THEN 'linked_only' END AS reason FROM ({_TRUSTED_SQL})""")
def source_exclusion(spark, sf_dir):
    return _trusted(spark, sf_dir).select("page_id", sources.exclusion(F.col("bases"), F.col("tier")).alias("reason"))


@query("source_notes", f"""SELECT page_id, CASE n_bases WHEN 0 THEN 'Supporting context.' WHEN 1 THEN 'Linked from ' || host || '.' ELSE 'Linked from ' || host || '. Names 1.0, 2.0.' END AS note FROM ({SOURCE_SQL})""")
def source_notes(spark, sf_dir):
    none = F.array().cast("array<string>")
    mentioned = F.when(F.array_contains("bases", "text_mention"), F.array(F.lit("2.0"), F.lit("1.0"))).otherwise(none)
    note = sources.why_relevant(sources.first_relation(F.col("bases")), F.col("title"), none, urls.host(F.col("url")), mentioned, none)
    return views.sources(spark, sf_dir).select("page_id", note.alias("note"))


@query("content_hash", "SELECT page_id, sha256(html) AS content_sha256, length(html) AS chars FROM pages")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", t.content_hash(F.col("html")).alias("content_sha256"), F.length("html").cast("bigint").alias("chars"))


@query("public_urls", rf"""SELECT page_id, url FROM (SELECT page_id, url, {HOST_SQL} AS host FROM pages) WHERE regexp_matches(url, '(?i)^https?://') AND host <> ''
  AND NOT regexp_matches(host, '\.(?:local|internal|localhost)$') AND regexp_extract(url, '^[a-zA-Z]+://[^/?#:]+:([0-9]+)', 1) IN ('', '80', '443')""")
def public_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url").filter(urls.public(F.col("url")))


def _answers(spark, sf_dir, value):
    """Registry answers made from the releases: one JSON text per catalog."""
    each = F.map_from_entries(F.array_sort(F.collect_set(F.struct("version", value.alias("v")))))
    return views.releases(spark, sf_dir).groupBy("catalog", "version").agg(F.min("position").alias("position")).groupBy("catalog").agg(each.alias("m"))


@query("catalog_pypi", f"""SELECT catalog, version, '2024-01-0' || (1 + p % 9) AS published, p % 5 = 0 AS yanked FROM (SELECT catalog, version, min(position) AS p FROM ({RELEASE_SQL}) GROUP BY catalog, version) WHERE p % 4 <> 0""")
def catalog_pypi(spark, sf_dir):
    from claimloom.sources import catalogs

    file = F.struct(F.concat(F.lit("2024-01-0"), (1 + F.col("position") % 9).cast("string")).alias("upload_time"), (F.col("position") % 5 == 0).alias("yanked"))
    files = F.when(F.col("position") % 4 != 0, F.array(file)).otherwise(F.array().cast("array<struct<upload_time:string,yanked:boolean>>"))
    body = F.to_json(F.struct(F.col("m").alias("releases")))
    return catalogs.pypi(_answers(spark, sf_dir, files).select("catalog", body.alias("body")))


@query("catalog_npm", f"""SELECT catalog, version, '2024-01-0' || (1 + p % 9) AS published FROM (SELECT catalog, version, min(position) AS p FROM ({RELEASE_SQL}) GROUP BY catalog, version)""")
def catalog_npm(spark, sf_dir):
    from claimloom.sources import catalogs

    day = F.concat(F.lit("2024-01-0"), (1 + F.col("position") % 9).cast("string"))
    body = F.to_json(F.struct(F.col("m").alias("versions"), F.col("m").alias("time")))
    return catalogs.npm(_answers(spark, sf_dir, day).select("catalog", body.alias("body")))


@query("catalog_github", f"""SELECT catalog, 'v' || version AS version, '2024' AS published FROM (SELECT catalog, version, min(position) AS p FROM ({RELEASE_SQL}) GROUP BY catalog, version) WHERE p % 3 <> 0 AND p % 5 <> 0""")
def catalog_github(spark, sf_dir):
    from claimloom.sources import registry

    rows = views.releases(spark, sf_dir).groupBy("catalog", "version").agg(F.min("position").alias("p"))
    item = F.struct(F.concat(F.lit("v"), F.col("version")).alias("tag_name"), (F.col("p") % 3 == 0).alias("draft"), (F.col("p") % 5 == 0).alias("prerelease"), F.lit("2024").alias("published_at"))
    pages = rows.groupBy("catalog", (F.col("p") % 2 + 1).alias("page")).agg(F.to_json(F.collect_list(item)).alias("body"))
    return registry.releases(registry.scan(spark, registry.land(pages)))
