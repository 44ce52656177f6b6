"""Queries over candidates of an identity, catalogs, retrieval and the joins between what was collected."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import rubrics, urls
from claimloom.functions import text as t
from claimloom.functions import versions as v
from claimloom.functions.vocabulary import CHANGE_KINDS, RELEASE_KINDS
from claimloom.operators import candidates, decisions, discovery, facts, frontier, generation, releases, retrieval, sections, selection, sources, summary
from claimloom.plans import views
from claimloom.plans.catalogue import query
from claimloom.plans.evidence import _TOPICS_SQL, TOPICS
from claimloom.plans.views import DUPLICATE_SQL, FACT_SQL, FLAG_SQL, GRADED_SQL, HOST_SQL, LEVEL_SQL, LOOSE_SQL, PATH_CONFIDENCE_SQL, SOURCE_SQL, TIER_SQL, TITLE_SQL
from claimloom.session import table
from claimloom.sources import catalogs, registry, snapshots


def _text(column):
    return column.cast("string")


def _case(key, *values):
    """``values`` in turn by the remainder of ``key``."""
    out = F.when(key % len(values) == 0, values[0])
    for n, value in enumerate(values[1:], 1):
        out = out.when(key % len(values) == n, value)
    return out


# Sections as candidates

_KIND_LIST = ("release_notes", "blog_post", "upgrade_guide", "api_documentation")
_SECTION_SQL = f"""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '  ' ELSE text END AS text, ['{"', '".join(_KIND_LIST)}'][doc_id % 4 + 1] AS kind,
  CASE doc_id % 5 WHEN 0 THEN [] WHEN 1 THEN ['1.0'] END AS versions FROM documents"""


def _sections(spark, sf_dir):
    n = F.col("doc_id")
    named = F.when(n % 5 == 0, F.array().cast("array<string>")).when(n % 5 == 1, F.array(F.lit("1.0")))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.when(n % 6 == 0, "  ").otherwise(F.col("text")).alias("text"), _case(n, *map(F.lit, _KIND_LIST)).alias("kind"), named.alias("versions"), F.array(F.lit("2.0"), F.lit("3.0")).alias("doc_versions"))


@query("section_candidates", f"""SELECT doc_id, CASE WHEN versions IS NULL THEN 'document_association' ELSE 'version_heading' END AS version_scope, array_to_string(coalesce(versions, ['2.0', '3.0']), ',') AS versions,
  length(body) > 6000 AS truncated, least(length(body), 6000) AS chars, array_to_string(topics, ',') AS topics FROM (
  SELECT *, trim(text, ' ') AS body, CASE WHEN len(found) = 0 AND kind IN ('{"', '".join(CHANGE_KINDS)}') THEN ['unclassified_change'] ELSE found END AS topics FROM (SELECT *, {_TOPICS_SQL} AS found FROM ({_SECTION_SQL})))
WHERE body <> '' AND (versions IS NULL OR len(versions) > 0) AND len(topics) > 0""")
def section_candidates(spark, sf_dir):
    found = candidates.nominated(_sections(spark, sf_dir), t.topics(F.col("text"), TOPICS))
    return found.select("doc_id", "version_scope", F.array_join("versions", ",").alias("versions"), "truncated", F.length("text").cast("bigint").alias("chars"), F.array_join("topics", ",").alias("topics"))


@query("feeding_records", "SELECT page_id, kind <> 'registry_metadata' OR page_id % 3 = 0 OR page_id % 7 = 1 AS feeds FROM (" + SOURCE_SQL + ")")
def feeding_records(spark, sf_dir):
    n = F.col("page_id")
    own = F.array(_text(n % 3), F.concat(F.lit("m"), _text(n % 7)))
    return views.sources(spark, sf_dir).select("page_id", candidates.feeding_records(own, F.array(F.lit("0"), F.lit("m1")), F.col("kind")).alias("feeds"))


#: Sentences that hold the words of every topic, and some of none.
_SENTENCES = (
    "A breaking change in the parser", "This option is deprecated", "The old method was removed", "The default is now false", "It now raises an error", "Requires Python 3.9 or later",
    "Update the peer dependency", "A new environment variable", "Migrate with the guide, use this instead", "Run pg_upgrade first", "A new api is exported from the module", "A known issue with a workaround",
    "Fixes a security hole, CVE-2020-1234", "Nothing of note here", "The documentation was improved",
)
_PRODUCTION_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(body, '(?i){p}') THEN '{n}' END" for n, p in t.TOPICS.items()) + "], lambda x: x IS NOT NULL)"
_NOTE_SQL = "SELECT p_partkey, s[p_partkey % 15 + 1] || '. ' || s[p_partkey // 15 % 15 + 1] || ' in ' || p_name AS body FROM part CROSS JOIN (SELECT [" + ", ".join(f"'{s}'" for s in _SENTENCES) + "] AS s)"


def _notes(spark, sf_dir):
    n, sentences = F.col("p_partkey"), F.array(*map(F.lit, _SENTENCES))
    first, second = (F.get(sentences, x.cast("int")) for x in (n % 15, F.floor(n / 15) % 15))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", F.concat(first, F.lit(". "), second, F.lit(" in "), F.col("p_name")).alias("body"))


@query("section_topics", f"SELECT p_partkey, array_to_string({_PRODUCTION_SQL}, ',') AS topics FROM ({_NOTE_SQL})")
def section_topics(spark, sf_dir):
    return _notes(spark, sf_dir).select("p_partkey", F.array_join(t.topics(F.col("body")), ",").alias("topics"))


@query("section_annotation", f"SELECT p_partkey, 'https://docs.example.org/' || (p_partkey % 9) || CASE WHEN p_partkey % 4 > 0 THEN '#a' || p_partkey ELSE '' END AS section_url, len({_PRODUCTION_SQL}) > 0 AS change_related FROM ({_NOTE_SQL})")
def section_annotation(spark, sf_dir):
    n = F.col("p_partkey")
    anchor = F.when(n % 4 > 0, F.concat(F.lit("a"), _text(n)))
    rows = _notes(spark, sf_dir).select("p_partkey", F.concat(F.lit("https://docs.example.org/"), _text(n % 9), F.lit("#old")).alias("url"), anchor.alias("anchor"), F.lit("Notes").alias("heading"), F.col("body").alias("text"))
    return retrieval.annotated(rows).select("p_partkey", "section_url", "change_related")


@query("context_facts", """SELECT p_partkey AS fact, CASE WHEN p_size % 2 = 0 THEN 'extracted' ELSE 'grouped' END AS reason FROM part WHERE p_size % 2 = 0 OR p_size % 3 = 0""")
def context_facts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    stage = lambda k, reason: part.filter(F.col("p_size") % k == 0).select(F.col("p_partkey").alias("fact"), F.lit(reason).alias("reason"))
    return facts.contextual(stage(2, "extracted"), stage(3, "grouped"))


@query("fact_scopes", f"SELECT f.fact, p.p_size % 2 = 0 AS scoped_section, p.p_brand AS section_source FROM ({FACT_SQL}) f LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 > 0) p ON p.p_partkey = f.subject")
def fact_scopes(spark, sf_dir):
    own = table(spark, sf_dir, "part").filter("p_partkey % 10 > 0").select(F.col("p_partkey").alias("subject"), (F.col("p_size") % 2 == 0).alias("scoped_section"), F.col("p_brand").alias("section_source"))
    return facts.with_scope(views.facts(spark, sf_dir), own, "subject", "scoped_section", "section_source").select("fact", "scoped_section", "section_source")


@query("section_sources", f"SELECT d.doc_id, s.title, s.tier FROM documents d LEFT JOIN (SELECT page_id, title, {TIER_SQL} AS tier FROM ({SOURCE_SQL})) s ON s.page_id = d.doc_id % 300")
def section_sources(spark, sf_dir):
    from claimloom.plans.releases import _trusted

    known = _trusted(spark, sf_dir).select(F.col("page_id").alias("source"), "title", "tier")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 300).alias("source"))
    return facts.with_scope(docs, known, "source", "title", "tier").select("doc_id", "title", "tier")


#: Sources with the tier that each branch of the cascade gives; the project has one repository.
_TIERS = (
    ("https://github.com/orbit/engine/issues/4", "github_issue", None, "official_repository_discussion"), ("https://github.com/Orbit/Engine/blob/main/NEWS", "release_notes", None, "official"),
    ("https://raw.githubusercontent.com/orbit/engine/main/x.md", "supporting_document", None, "official"), ("https://api.github.com/repos/orbit/engine/pulls/9", "github_pull_request", None, "official_repository_discussion"),
    ("https://github.com/fork/engine/releases", "release_notes", None, "probable_official"), ("https://docs.orbit.io/v2", "api_documentation", None, "official"), ("https://blog.example.com/", "blog_post", None, "third_party"),
    ("https://other.net/", "blog_post", "associated_repository", "official"), ("https://other.net/r", "registry_metadata", None, "official"), ("https://other.net/g", "blog_post", "linked_context", "third_party"),
)


@query("trust_cascade", "SELECT p_partkey, ['" + "', '".join(x[3] for x in _TIERS) + "'][p_partkey % 10 + 1] AS tier FROM part")
def trust_cascade(spark, sf_dir):
    n = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", *(_case(n, *(F.lit(x[k]) for x in _TIERS)).alias(name) for k, name in enumerate(("url", "kind", "relation"))))
    addresses = spark.range(1).select(F.explode(F.array(F.lit("git+https://github.com/Orbit/Engine.git"), F.lit("https://www.orbit.io/"), F.lit("https://github.com/"))).alias("address"))
    identity = sources.project_identity(addresses).withColumn("catalog", F.lit("https://pypi.org/pypi/orbit/json"))
    return sources.with_trust(rows, identity).select("p_partkey", "tier")


@query("source_relations", """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Catalog record of 1.0, 2.0.' WHEN 1 THEN 'Document of the project''s repository: ' || substr(p_name, 1, 80) || '.' WHEN 2 THEN 'The project''s home page.' WHEN 3 THEN 'Linked from h.org.' ELSE 'Supporting context.' END
  || CASE WHEN p_size % 2 = 0 THEN ' Names 1.0, 2.0.' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN ' Topics: security, removal.' ELSE '' END AS note FROM part""")
def source_relations(spark, sf_dir):
    n, none = F.col("p_partkey"), F.array().cast("array<string>")
    array = lambda *x: F.array(*map(F.lit, x))
    found = (array("linked_context", "resolver_release_record"), array("linked_context", "repository_document"), array("resolver_homepage"), array("linked_context"), none)
    note = sources.why_relevant(
        sources.first_relation(_case(n, *found)), F.col("p_name"), array("1.0", "2.0"), F.lit("h.org"),
        F.when(F.col("p_size") % 2 == 0, array("2.0", "1.0")).otherwise(none), F.when(F.col("p_size") % 3 == 0, array("security", "removal")).otherwise(none),
    )
    return table(spark, sf_dir, "part").select("p_partkey", note.alias("note"))


@query("github_completeness", "SELECT p_brand AS catalog, max(p_partkey % 4 + 3 * CAST(right(p_brand, 1) AS INTEGER)) < 12 AND bool_and(p_partkey % 499 > 0) AS complete FROM part GROUP BY p_brand")
def github_completeness(spark, sf_dir):
    n = F.col("p_partkey")
    body = F.when(n % 499 == 0, '{"message": "rate limit"}').otherwise('[{"tag_name": "v1"}]')
    pages = table(spark, sf_dir, "part").select(F.col("p_brand").alias("catalog"), (n % 4 + 3 * F.substring("p_brand", -1, 1).cast("int")).alias("page"), body.alias("body"))
    return registry.completeness(registry.scan(spark, registry.land(pages)), most_pages=12)


@query("source_filter", f"SELECT page_id, tier, title FROM (SELECT page_id, title, {TIER_SQL} AS tier FROM ({SOURCE_SQL})) WHERE tier = 'official' AND contains(lower(title), 'er')")
def source_filter(spark, sf_dir):
    from claimloom.plans.releases import _trusted

    return summary.filtered(_trusted(spark, sf_dir), {"tier": ("official",)}, "ER", F.col("title")).select("page_id", "tier", "title")


@query("cluster_versions", """SELECT key AS cluster_key, array_to_string(list_sort(list(DISTINCT version)), ',') AS versions FROM (
  SELECT regexp_replace(lower(p_name), '[^a-z0-9.]+', '', 'g') AS key, unnest([CAST(p_size % 5 AS VARCHAR), (p_partkey % 3) || '.0']) AS version FROM part) GROUP BY key""")
def cluster_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_name", F.array(_text(F.col("p_size") % 5), F.concat(_text(F.col("p_partkey") % 3), F.lit(".0"))).alias("versions"))
    return facts.cluster_versions(rows, "p_name", "versions").withColumn("versions", F.array_join("versions", ","))


@query("original_texts", f"SELECT d.doc_id, sha256(coalesce(o.text, d.text)) AS text_sha256 FROM (SELECT d.doc_id, d.text, x.duplicate_of FROM documents d JOIN ({DUPLICATE_SQL}) x USING (doc_id)) d LEFT JOIN documents o ON o.doc_id = d.duplicate_of")
def original_texts(spark, sf_dir):
    docs = candidates.with_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "doc_id").withColumnRenamed("duplicate_of", "duplicate_content_of")
    return facts.original_texts(docs, "doc_id", "text").select("doc_id", t.content_hash(F.col("text")).alias("text_sha256"))


@query("quote_first_source", f"SELECT item_id, min(doc_id) AS doc_id FROM (SELECT item_id, {LOOSE_SQL.format('text')} AS q FROM benchmark) JOIN (SELECT doc_id, {LOOSE_SQL.format('text')} AS d FROM documents) ON contains(d, q) GROUP BY item_id")
def quote_first_source(spark, sf_dir):
    pairs = facts.grounded_pairs(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")
    return retrieval.first_holders(pairs, "item_id", "doc_id")


@query("claim_location", f"""WITH p AS MATERIALIZED (SELECT item_id, doc_id FROM (SELECT item_id, {LOOSE_SQL.format('text')} AS q FROM benchmark) JOIN (SELECT doc_id, {LOOSE_SQL.format('text')} AS d FROM documents) ON contains(d, q)),
f AS (SELECT item_id, min(doc_id) AS first FROM p GROUP BY item_id), c AS (SELECT item_id, CASE WHEN item_id % 2 = 0 THEN coalesce((SELECT max(doc_id) FROM p WHERE p.item_id = b.item_id), -1) ELSE -1 END AS doc_id FROM benchmark b)
SELECT c.item_id, CASE WHEN p.doc_id IS NOT NULL THEN c.doc_id ELSE f.first END AS held_by, coalesce(CASE WHEN p.doc_id IS NOT NULL THEN c.doc_id ELSE f.first END <> c.doc_id, false) AS corrected
FROM c LEFT JOIN p ON p.item_id = c.item_id AND p.doc_id = c.doc_id LEFT JOIN f ON f.item_id = c.item_id""")
def claim_location(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    pairs = facts.grounded_pairs(items, table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")
    last = pairs.groupBy("item_id").agg(F.max("doc_id").alias("last"))
    claimed = F.when(F.col("item_id") % 2 == 0, F.coalesce("last", F.lit(-1))).otherwise(-1).cast("bigint")
    claims = items.select("item_id").join(last, "item_id", "left").select("item_id", claimed.alias("doc_id"))
    return retrieval.located(claims, pairs, "item_id", "doc_id").select("item_id", "held_by", "corrected")


# Functions of texts and addresses

_LABELS = ("2.0.0", "3", "1.10", "4.0")
_PLAIN_LABEL = lambda forms: r"(^|[^\p{L}\p{N}_.])v?(" + "|".join(f.replace(".", r"\.") for f in forms) + r")(\.0)*($|[^\p{L}\p{N}_.]|\.($|[^0-9]))"
_FORMS = {"2.0.0": ("2.0.0", "2.0", "2"), "3": ("3",), "1.10": ("1.10",), "4.0": ("4.0", "4")}


@query("names_version", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{_PLAIN_LABEL(f)}') THEN '{k}' END" for k, f in _FORMS.items()) + "], lambda x: x IS NOT NULL), ',') AS named FROM documents")
def names_version(spark, sf_dir):
    named = F.array_compact(F.array(*(F.when(v.names_version(F.col("text"), F.lit(label)), F.lit(label)) for label in _LABELS)))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(named, ",").alias("named"))


#: Addresses with the repository they belong to.
_ADDRESSES = (
    ("git+https://github.com/Own/Name.git", "Own/Name"), ("git@github.com:a.b/c-d.git", "a.b/c-d"), ("https://www.github.com/o/n/issues/3", "o/n"), ("https://github.com/search/x", ""),
    ("https://gitlab.com/a/b", ""), ("https://github.com/only", ""), ("", ""),
)


@query("project_repository", "SELECT p_partkey, ['" + "', '".join(r for _, r in _ADDRESSES) + "'][p_partkey % 7 + 1] AS repository FROM part")
def project_repository(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", urls.project_repository(_case(F.col("p_partkey"), *(F.lit(a) for a, _ in _ADDRESSES))).alias("repository"))


_PAGES = (
    ("https://github.com/o/n/tree/main/docs", None), ("https://github.com/o/n/releases/tag/v1.0", "https://api.github.com/repos/o/n/releases/tags/v1.0"),
    ("https://github.com/o/n/issues/5", "https://api.github.com/repos/o/n/issues/5"), ("https://github.com/o/n/pull/6", "https://api.github.com/repos/o/n/pulls/6"), ("https://docs.example.org/tree/x", "https://docs.example.org/tree/x"),
)


@query("retrieval_address", "SELECT p_partkey, [" + ", ".join("NULL" if r is None else f"'{r}'" for _, r in _PAGES) + "][p_partkey % 5 + 1] AS address FROM part")
def retrieval_address(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", urls.retrieval_address(_case(F.col("p_partkey"), *(F.lit(a) for a, _ in _PAGES))).alias("address"))


#: Ends that pages get, and whether the address is then that of a file.
_ENDS = (
    ("", False), (".PDF?x=1", True), (".pdf/b", False), ("/a.tar.xz", True), ("?f=b.pdf", True), (".gif", False), ("/x.tgz", False), ("/x-1.0.whl#sha256=0", True), (".svg?raw", True),
    (".jpeg", False), ("/pdf", False), ("#a.zip", False), (".Zip", True), ("?f=a.tar&b=1", False), (".png", True), (".exe?", True), (".webp", False), (".jpg", True), (".json.gz", True),
)


@query("binary_urls", f"SELECT page_id, list_value({', '.join(str(found).lower() for _, found in _ENDS)})[page_id % {len(_ENDS)} + 1] AS is_binary FROM pages")
def binary_urls(spark, sf_dir):
    end = _case(F.col("page_id"), *(F.lit(e) for e, _ in _ENDS))
    return table(spark, sf_dir, "pages").select("page_id", urls.binary(F.concat(F.regexp_replace("url", "[?#].*$", ""), end)).alias("is_binary"))


@query("issue_references", r"SELECT doc_id, array_to_string(regexp_extract_all(text || ' see #' || doc_id || ', a#5 and &#7; (#8)', '(?:^|[^\w&])#([0-9]+)', 1), ',') AS issues FROM documents")
def issue_references(spark, sf_dir):
    told = F.concat(F.col("text"), F.lit(" see #"), _text(F.col("doc_id")), F.lit(", a#5 and &#7; (#8)"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(t.issue_references(told).cast("array<string>"), ",").alias("issues"))


_MARKDOWN_SQL = "SELECT page_id, 'See [the page](' || url || ') and [notes](https://docs.example.org/n' || page_id || ' \"t\"), [local](/x) or ' || url || '.' AS body FROM pages"


@query("text_links", f"SELECT page_id, array_to_string(regexp_extract_all(body, '\\[[^\\]]*\\]\\((https?://[^\\s)]+)\\)', 1), ' ') AS markdown, array_to_string([regexp_replace(u, '[.,]+$', '') FOR u IN regexp_extract_all(body, 'https?://[^\\s<>\"\\)]+')], ' ') AS bare FROM ({_MARKDOWN_SQL})")
def text_links(spark, sf_dir):
    body = F.concat(F.lit("See [the page]("), F.col("url"), F.lit(") and [notes](https://docs.example.org/n"), _text(F.col("page_id")), F.lit(' "t"), [local](/x) or '), F.col("url"), F.lit("."))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(sections.markdown_links(body), " ").alias("markdown"), F.array_join(t.urls(body), " ").alias("bare"))


_XML_SQL = """SELECT page_id, CASE WHEN page_id % 6 = 0 THEN '<!DOCTYPE x>' ELSE '' END || '<urlset><url><loc> ' || url || ' </loc></url><loc>https://a.org/' || page_id || '</loc></urlset><link rel="x" href="https://b.org/"/><link>https://c.org</link>' AS xml FROM pages"""


@query("sitemap_links", f"""SELECT page_id, CASE WHEN NOT regexp_matches(xml, '(?i)<!DOCTYPE|<!ENTITY') THEN array_to_string(regexp_extract_all(xml, '<loc>\\s*([^<]*?)\\s*</loc>', 1) || regexp_extract_all(xml, '<link[^>]*?href="([^"]*)"', 1) || regexp_extract_all(xml, '<link>\\s*([^<]*?)\\s*</link>', 1), ' ') END AS links FROM ({_XML_SQL})""")
def sitemap_links(spark, sf_dir):
    head = F.when(F.col("page_id") % 6 == 0, "<!DOCTYPE x>").otherwise("")
    xml = F.concat(head, F.lit("<urlset><url><loc> "), F.col("url"), F.lit(" </loc></url><loc>https://a.org/"), _text(F.col("page_id")), F.lit('</loc></urlset><link rel="x" href="https://b.org/"/><link>https://c.org</link>'))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(sections.sitemap_links(xml), " ").alias("links"))


# Snapshots

@query("api_documents", """SELECT 'u' || doc_id AS url, ['Name ' || doc_id, 'Title ' || doc_id, 'Title ' || doc_id, 'f' || doc_id, 'pkg'][doc_id % 6 + 1] AS title, sha256(text) AS text_sha256,
  ['github_release', 'github_pull_request', 'github_issue', 'repository_file', 'registry_metadata'][doc_id % 6 + 1] AS kind FROM documents WHERE doc_id % 6 < 5""")
def api_documents(spark, sf_dir):
    n, body = F.col("doc_id"), F.col("text")
    named = lambda s: F.concat(F.lit(s), _text(n))
    shapes = (
        F.to_json(F.struct(F.lit("v1").alias("tag_name"), named("Name ").alias("name"), body.alias("body"))),
        F.to_json(F.struct(named("Title ").alias("title"), n.alias("number"), F.struct(F.lit("x").alias("url")).alias("pull_request"), body.alias("body"))),
        F.to_json(F.struct(named("Title ").alias("title"), n.alias("number"), body.alias("body"))),
        F.to_json(F.struct(F.lit("base64").alias("encoding"), named("f").alias("path"), F.base64(F.encode(body, "utf-8")).alias("content"))),
        F.to_json(F.struct(F.struct(F.lit("pkg").alias("name"), body.alias("description")).alias("info"))),
        F.lit('{"message": "Not Found"}'),
    )
    answers = table(spark, sf_dir, "documents").select(named("u").alias("url"), _case(n, *shapes).alias("body"))
    return snapshots.from_api(answers).select("url", "title", t.content_hash(F.col("text")).alias("text_sha256"), "kind")


_SNAPSHOT_SQL = """SELECT doc_id, [200, 404, 503, 410, 200, 301][doc_id % 6 + 1] AS status, CASE WHEN doc_id % 7 = 0 THEN 'Please verify you are human. ' ELSE '' END || text AS body, doc_id % 11 = 0 AS broken FROM documents"""


def _snapshots(spark, sf_dir):
    n = F.col("doc_id")
    body = F.concat(F.when(n % 7 == 0, "Please verify you are human. ").otherwise(""), F.col("text"))
    status = _case(n, *map(F.lit, (200, 404, 503, 410, 200, 301)))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("u"), _text(n)).alias("url"), status.alias("status"), body.alias("body"), F.lit("2024").alias("retrieved_at"), F.concat(F.lit("f"), _text(n)).alias("final_url"))
    return rows.withColumn("content_sha256", F.when(n % 11 == 0, "0").otherwise(t.content_hash(F.col("body"))))


@query("sound_snapshots", f"SELECT doc_id, status FROM ({_SNAPSHOT_SQL}) WHERE (status < 400 OR status IN (404, 410)) AND NOT broken AND NOT regexp_matches(body, '{snapshots.REFUSALS}')")
def sound_snapshots(spark, sf_dir):
    return snapshots.sound(_snapshots(spark, sf_dir)).select("doc_id", "status")


@query("request_log", f"SELECT 'source_' || substr(sha256('u' || doc_id), 1, 12) AS source_id, 'f' || doc_id AS final_url, status, CASE WHEN broken THEN '0' ELSE sha256(body) END AS content_sha256 FROM ({_SNAPSHOT_SQL})")
def request_log(spark, sf_dir):
    return snapshots.request_log(_snapshots(spark, sf_dir)).select("source_id", "final_url", "status", "content_sha256")


@query("snapshot_lookup", "SELECT doc_id, coalesce(s.body IS NOT NULL, false) AS cached, length(s.body) AS chars FROM documents d LEFT JOIN (SELECT 'u' || doc_id AS url, text AS body FROM documents WHERE doc_id % 3 = 0) s ON s.url = 'u' || d.doc_id")
def snapshot_lookup(spark, sf_dir):
    url = F.concat(F.lit("u"), _text(F.col("doc_id"))).alias("url")
    docs = table(spark, sf_dir, "documents")
    stored = docs.filter("doc_id % 3 = 0").select(url, F.lit("html").alias("accept"), F.lit(200).alias("status"), F.col("text").alias("body"), url.alias("final_url"))
    return snapshots.looked_up(docs.select("doc_id", url, F.lit("html").alias("accept")), stored).select("doc_id", "cached", F.length("body").cast("bigint").alias("chars"))


_ORIGIN_SQL = "regexp_extract(url, '^([a-z]+://[^/]+)', 1)"


@query("robots_allowed", f"""SELECT page_id FROM (SELECT page_id, {_ORIGIN_SQL} AS o, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS p FROM pages) u WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT {_ORIGIN_SQL} AS origin, CASE page_id % 3 WHEN 0 THEN '/fr' WHEN 1 THEN '/en/1' END AS prefix FROM pages WHERE page_id % 4 = 0) r WHERE r.origin = u.o AND (prefix IS NULL OR starts_with(p, prefix)))""")
def robots_allowed(spark, sf_dir):
    pages, n = table(spark, sf_dir, "pages"), F.col("page_id")
    policies = pages.filter(n % 4 == 0).select(F.regexp_extract("url", "^([a-z]+://[^/]+)", 1).alias("origin"), F.when(n % 3 == 0, "/fr").when(n % 3 == 1, "/en/1").alias("prefix")).distinct()
    return snapshots.allowed(pages.select("page_id", "url"), policies).select("page_id")


_ATTEMPT_SQL = "SELECT event_id, user_id, CASE event_type WHEN 'error' THEN 403 WHEN 'click' THEN 200 WHEN 'view' THEN 429 ELSE 503 END AS status, CASE WHEN value > 20 THEN 30 END AS retry_after FROM events"


@query("fetch_outcomes", f"""SELECT event_id, CASE WHEN event_id > coalesce(third, event_id) THEN 'quarantined' WHEN (status = 429 OR status >= 500) AND coalesce(retry_after, 0) > 10 THEN 'deferred' WHEN status = 429 OR status >= 500 THEN 'retried'
  WHEN status >= 400 THEN 'failed' ELSE 'ok' END AS outcome FROM ({_ATTEMPT_SQL}) a LEFT JOIN (SELECT user_id, event_id AS third FROM (
    SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM ({_ATTEMPT_SQL}) WHERE status = 403) WHERE n = 3) q USING (user_id)""")
def fetch_outcomes(spark, sf_dir):
    kind = F.col("event_type")
    status = F.when(kind == "error", 403).when(kind == "click", 200).when(kind == "view", 429).otherwise(503)
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("host"), F.col("event_id").alias("seq"), status.alias("status"), F.when(F.col("value") > 20, 30).alias("retry_after"))
    return retrieval.outcomes(rows).select("event_id", "outcome")


@query("search_results", """WITH a AS (SELECT conv_id AS query, 'first' AS provider, turn AS position, 'u' || (turn * 7 % 5) AS url FROM conversations WHERE conv_id % 3 > 0),
b AS (SELECT conv_id AS query, 'second' AS provider, turn AS position, 'v' || turn AS url FROM conversations)
SELECT query, provider, url, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY position, url) AS place FROM (
  SELECT query, provider, url, min(position) AS position FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE query NOT IN (SELECT query FROM a)) GROUP BY query, provider, url)) WHERE place <= 3""")
def search_results(spark, sf_dir):
    told, n = table(spark, sf_dir, "conversations"), F.col("conv_id")
    answers = lambda provider, url, challenge: told.select(n.alias("query"), F.lit(provider).alias("provider"), F.col("turn").alias("position"), url.alias("url"), challenge.alias("challenge"))
    first = answers("first", F.concat(F.lit("u"), _text(F.col("turn") * 7 % 5)), n % 3 == 0)
    return retrieval.search_results(first, answers("second", F.concat(F.lit("v"), _text(F.col("turn"))), F.lit(False)), 3)


# Catalogs

_CATALOG_KIND_SQL = "SELECT p_brand AS catalog, p_size || '.' || (p_partkey % 10) AS version, p_partkey AS position, CAST(right(p_brand, 1) AS INTEGER) AS b FROM part"
_HAS = lambda low, high: f"bool_or(CAST(split_part(version, '.', 1) AS INTEGER) BETWEEN {low} AND {high})"


@query("catalog_dispatch", f"""WITH p AS (SELECT *, position % 4 AS k FROM ({_CATALOG_KIND_SQL})), reg AS (SELECT * FROM p WHERE b = 1), fin AS (SELECT * FROM p WHERE b IN (2, 3) AND k = 0 AND (b = 2 OR CAST(split_part(version, '.', 1) AS INTEGER) <> 20)),
tags AS (SELECT * FROM p WHERE b IN (2, 3, 4) AND k = 1), web AS (SELECT * FROM p WHERE k = 2),
enough AS (SELECT catalog FROM fin GROUP BY catalog HAVING bool_and(b = 2) AND {_HAS(10, 10)} AND {_HAS(20, 20)}),
f AS (SELECT catalog, version, position, 'registry' AS reader FROM reg UNION ALL SELECT catalog, version, position, 'releases' FROM fin UNION ALL SELECT catalog, version, position, 'tags' FROM tags WHERE catalog NOT IN (SELECT catalog FROM enough))
SELECT * FROM f UNION ALL SELECT catalog, version, position, 'pages' FROM web WHERE catalog NOT IN (SELECT catalog FROM f)""")
def catalog_dispatch(spark, sf_dir):
    rows = views.releases(spark, sf_dir).withColumns({"b": F.substring("catalog", -1, 1).cast("int"), "k": F.col("position") % 4})
    final = rows.filter((F.col("b").isin(2, 3)) & (F.col("k") == 0) & ((F.col("b") == 2) | (F.substring_index("version", ".", 1) != "20"))).withColumn("complete", F.col("b") == 2)
    return releases.dispatched(rows.filter("b = 1"), final, rows.filter("b IN (2, 3, 4) AND k = 1"), rows.filter("k = 2"), "10", "20")


_INDEX_SQL = """SELECT 'https://x.org/i' || (p_partkey % 7) AS page, CASE p_partkey % 5 WHEN 0 THEN 'https://x.org/release-' || p_size || '.html' WHEN 1 THEN 'https://x.org/i' || (p_partkey % 7 + 1) || '#top' WHEN 2 THEN 'https://y.org/' WHEN 3 THEN 'https://x.org/docs' ELSE 'https://x.org/f.zip' END AS href,
  CASE p_partkey % 4 WHEN 0 THEN 'Release ' || p_size || '.1 notes' WHEN 1 THEN p_size || '.2' WHEN 2 THEN 'Documentation' ELSE 'Version ' || p_size || ' beta' END AS text FROM part"""
_INDEXED_SQL = f"""SELECT DISTINCT page, href, label, relevance, (k IS NULL OR (k >= 10 AND k < 21)) AND relevance > 0 AND NOT regexp_matches(href, '\\.zip$') AS followed FROM (
  SELECT *, CASE WHEN regexp_matches(text || ' ' || href, '(?i)release|changelog|upgrade') THEN 4 WHEN regexp_matches(text, '(?i)documentation|download') THEN 1 ELSE 0 END + CASE WHEN k >= 10 AND k < 21 THEN 5 ELSE 0 END AS relevance FROM (
    SELECT page, regexp_replace(href, '#.*$', '') AS href, text, CASE WHEN p % 4 = 0 THEN size || '.1' WHEN p % 4 = 1 THEN size || '.2' END AS label, CASE WHEN p % 4 < 2 THEN size WHEN p % 5 = 0 THEN size END AS k
    FROM (SELECT x.*, p_partkey AS p, p_size AS size FROM part JOIN LATERAL (SELECT * FROM (SELECT part.p_partkey AS pk) q) l ON true JOIN ({_INDEX_SQL.replace('SELECT ', 'SELECT p_partkey AS id, ', 1)}) x ON x.id = p_partkey) WHERE p % 5 <> 2))"""


def _index_links(spark, sf_dir):
    n, size = F.col("p_partkey"), _text(F.col("p_size"))
    page = lambda k: F.concat(F.lit("https://x.org/i"), _text(k))
    href = _case(n, F.concat(F.lit("https://x.org/release-"), size, F.lit(".html")), F.concat(page(n % 7 + 1), F.lit("#top")), F.lit("https://y.org/"), F.lit("https://x.org/docs"), F.lit("https://x.org/f.zip"))
    text = _case(n, F.concat(F.lit("Release "), size, F.lit(".1 notes")), F.concat(size, F.lit(".2")), F.lit("Documentation"), F.concat(F.lit("Version "), size, F.lit(" beta")))
    return table(spark, sf_dir, "part").select(page(n % 7).alias("page"), href.alias("href"), text.alias("text"))


@query("release_index", f"SELECT page, href, label, CAST(relevance AS BIGINT) AS relevance, followed FROM ({_INDEXED_SQL})")
def release_index(spark, sf_dir):
    return releases.indexed(_index_links(spark, sf_dir), "10", "20").distinct()


_INDEX_PAGES = 6
_POP = """SELECT dst FROM e WHERE src IN (SELECT url FROM s{0}) AND dst NOT IN (SELECT url FROM s{0}) GROUP BY dst ORDER BY max(relevance) DESC, dst LIMIT 1"""


@query("index_crawl", f"""WITH l AS MATERIALIZED ({_INDEXED_SQL}), e AS MATERIALIZED (SELECT page AS src, href AS dst, relevance FROM l WHERE followed), s1 AS (SELECT 'https://x.org/i0' AS url),
{", ".join(f"s{k + 1} AS MATERIALIZED (SELECT url FROM s{k} UNION ALL SELECT * FROM ({_POP.format(k)}))" for k in range(1, _INDEX_PAGES))}
SELECT DISTINCT 'https://x.org/i0' AS catalog, label AS version, page FROM l JOIN s{_INDEX_PAGES} r ON r.url = l.page WHERE label IS NOT NULL""")
def index_crawl(spark, sf_dir):
    return releases.index_crawl(_index_links(spark, sf_dir), "https://x.org/i0", "10", "20", most_pages=_INDEX_PAGES)


_TAG_SQL = "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'v' || p_size || '.0' WHEN 1 THEN 'build-' || p_size ELSE 'release-' || p_size END AS tag FROM part"


@query("release_tag_match", f"""SELECT DISTINCT tag, version FROM ({_TAG_SQL}) t JOIN (SELECT DISTINCT p_size || '.0.0' AS version, 'build-' || p_size AS raw_version, p_size FROM part) r
  ON tag = raw_version OR (p_partkey % 3 <> 1 AND regexp_extract(tag, '[0-9]+') = CAST(p_size AS VARCHAR))""")
def release_tag_match(spark, sf_dir):
    part, size = table(spark, sf_dir, "part"), _text(F.col("p_size"))
    tags = part.select(_case(F.col("p_partkey"), F.concat(F.lit("v"), size, F.lit(".0")), F.concat(F.lit("build-"), size), F.concat(F.lit("release-"), size)).alias("tag"))
    return releases.tag_matches(tags.distinct(), part.select(F.concat(size, F.lit(".0.0")).alias("version"), F.concat(F.lit("build-"), size).alias("raw_version")).distinct())


@query("inventories", "SELECT 'p' || p_size AS page, count(DISTINCT p_partkey % 4) AS releases FROM part WHERE p_partkey % 3 = 0 GROUP BY p_size HAVING count(DISTINCT p_partkey % 4) >= 2")
def inventories(spark, sf_dir):
    n = F.col("p_partkey")
    label = F.when(n % 3 == 0, F.concat(F.lit("v1."), _text(n % 4))).otherwise(F.concat(F.lit("see "), _text(n)))
    return catalogs.inventories(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), _text(F.col("p_size"))).alias("page"), label.alias("label")))


@query("version_documents", "SELECT DISTINCT CAST(o_custkey % 9 AS VARCHAR) AS version, 'd' || o_custkey AS url FROM orders WHERE o_custkey % 9 < 5")
def version_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.concat(F.lit("d"), _text(F.col("o_custkey"))).alias("url"), _text(F.col("o_custkey") % 9).alias("version"))
    return frontier.by_version(docs, spark.range(5).select(_text(F.col("id")).alias("version")))


@query("association_pass", """SELECT DISTINCT 'd' || p_partkey AS url, CAST(p_size AS VARCHAR) AS version, 'own' AS basis FROM part UNION
  SELECT 'd' || l_partkey, v, 'linked_context' FROM (SELECT l_partkey, unnest([CAST(l_suppkey % 3 AS VARCHAR), 'x']) AS v FROM lineitem) WHERE l_partkey IN (SELECT p_partkey FROM part)""")
def association_pass(spark, sf_dir):
    docs = table(spark, sf_dir, "part").select(F.concat(F.lit("d"), _text(F.col("p_partkey"))).alias("url"), _text(F.col("p_size")).alias("version"), F.lit("own").alias("basis"))
    edges = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("d"), _text(F.col("l_partkey"))).alias("dst"), F.array(_text(F.col("l_suppkey") % 3), F.lit("x")).alias("versions"), F.lit("linked_context").alias("relation"))
    return frontier.propagated(docs, edges)


# Identity

_PROVIDER_SQL = """SELECT p_partkey, p_name, ['github', 'npm', 'pypi', 'html'][p_partkey % 4 + 1] AS provider, p_partkey % 13 = 0 AS broken FROM part"""


def _records(spark, sf_dir):
    n, name = F.col("p_partkey"), F.col("p_name")
    own = lambda s, e="": F.concat(F.lit(s), _text(n), F.lit(e))
    shapes = (
        F.to_json(F.struct(name.alias("name"), own("own/r").alias("full_name"), F.lit("a tool").alias("description"), own("https://h", ".org/").alias("homepage"), own("https://github.com/own/r").alias("html_url"))),
        F.to_json(F.struct(name.alias("name"), F.struct(own("git+https://github.com/Own/r", ".git").alias("url")).alias("repository"))),
        F.to_json(F.struct(F.struct(name.alias("name"), F.lit("summed").alias("summary"), F.create_map(F.lit("Homepage"), own("https://h", ".org/"), F.lit("Source"), own("https://github.com/o/p")).alias("project_urls")).alias("info"))),
        F.to_json(F.struct(name.alias("title"))),
    )
    body = F.when(n % 13 == 0, "{}").otherwise(_case(n, *shapes))
    return table(spark, sf_dir, "part").select(_case(n, *map(F.lit, ("github", "npm", "pypi", "html"))).alias("provider"), own("https://a/").alias("address"), body.alias("body"))


@query("identity_scan", f"""SELECT provider AS kind, CASE WHEN provider = 'github' AND NOT broken THEN 'https://github.com/own/r' || p_partkey ELSE 'https://a/' || p_partkey END AS url, CASE WHEN broken THEN '' ELSE p_name END AS name,
  CASE WHEN broken THEN '' WHEN provider = 'github' THEN 'own/r' || p_partkey WHEN provider = 'npm' THEN 'Own/r' || p_partkey WHEN provider = 'pypi' THEN 'o/p' || p_partkey ELSE '' END AS repository,
  CASE WHEN provider = 'html' THEN 'https://a/' || p_partkey WHEN broken OR provider = 'npm' THEN '' ELSE 'https://h' || p_partkey || '.org/' END AS homepage,
  CASE WHEN provider = 'github' THEN CASE WHEN broken THEN 2 ELSE 3 END WHEN provider = 'npm' THEN 3 WHEN provider = 'pypi' THEN CASE WHEN broken THEN 2 ELSE 4 END ELSE 1 END AS proofs,
  CASE WHEN broken THEN 'failed' ELSE 'read' END AS status, CASE WHEN broken THEN 'no name in https://a/' || p_partkey END AS error FROM ({_PROVIDER_SQL})""")
def identity_scan(spark, sf_dir):
    return discovery.scanned(_records(spark, sf_dir)).select("kind", "url", "name", "repository", "homepage", F.size("evidence").cast("bigint").alias("proofs"), "status", "error")


_SEARCH_SQL = "SELECT p_brand AS query, ['npm', 'github', 'web'][p_partkey % 3 + 1] AS provider, p_partkey AS position, 'u' || (p_partkey * 7 % 400) AS url FROM part"


@query("search_lists", f"""SELECT query, provider, url, place FROM (SELECT *, row_number() OVER (PARTITION BY query, provider ORDER BY position, url) AS place FROM (SELECT query, provider, url, min(position) AS position FROM ({_SEARCH_SQL}) GROUP BY query, provider, url))
  WHERE place <= CASE provider WHEN 'github' THEN 10 ELSE 5 END""")
def search_lists(spark, sf_dir):
    n = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("query"), _case(n, *map(F.lit, ("npm", "github", "web"))).alias("provider"), n.alias("position"), F.concat(F.lit("u"), _text(n * 7 % 400)).alias("url"))
    return discovery.searched(rows, ("query",))


_SCORED_SQL = "SELECT 'u' || p_partkey AS url, p_brand AS project, p_size % 12 AS score FROM part"


@query("candidate_shortlist", f"SELECT project, url, score, place FROM (SELECT *, row_number() OVER (PARTITION BY project ORDER BY score DESC, url) AS place FROM ({_SCORED_SQL})) WHERE place <= 5")
def candidate_shortlist(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("u"), _text(F.col("p_partkey"))).alias("url"), F.col("p_brand").alias("project"), (F.col("p_size") % 12).alias("score"))
    return discovery.shortlist(rows, by=("project",)).select("project", "url", "score", "place")


def _candidates(spark, sf_dir):
    n = F.col("p_partkey")
    home = F.when(n % 5 == 0, "").when(n % 5 == 1, "https://github.com/x").otherwise(F.concat(F.lit("https://h"), _text(n % 40), F.lit(".org/")))
    repository = F.when(n % 3 == 0, "").otherwise(F.concat(F.lit("Own/r"), _text(n % 40)))
    return table(spark, sf_dir, "part").select(F.concat(F.lit("u"), _text(n)).alias("url"), home.alias("homepage"), repository.alias("repository"), (F.col("p_size") % 9).alias("score"))


_CANDIDATE_SQL = "SELECT 'u' || p_partkey AS url, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'https://github.com/x' ELSE 'https://h' || (p_partkey % 40) || '.org/' END AS homepage, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'Own/r' || (p_partkey % 40) END AS repository, p_size % 9 AS score, p_partkey % 40 AS h FROM part"


@query("homepage_links", f"""SELECT url, CASE WHEN alone THEN 'a/Orbit' ELSE repository END AS repository, coalesce(back, false) OR coalesce(alone, false) AS reciprocal FROM (
  SELECT c.*, looked AND repository <> '' AND h % 4 = 0 AS back, looked AND repository = '' AND h % 4 IN (1, 2) AS alone FROM (SELECT *, score >= 4 AND starts_with(homepage, 'https://h') AS looked FROM ({_CANDIDATE_SQL})) c)""")
def homepage_links(spark, sf_dir):
    pages = spark.range(40).select("id", F.concat(F.lit("https://h"), _text(F.col("id")), F.lit(".org/")).alias("page"))
    back = pages.filter("id % 4 = 0").select("page", F.concat(F.lit("https://github.com/own/R"), _text(F.col("id"))).alias("href"))
    one = pages.filter("id % 4 IN (1, 2, 3)").select("page", F.lit("https://github.com/a/Orbit").alias("href"))
    two = pages.filter("id % 4 = 3").select("page", F.lit("https://github.com/b/orbit.git").alias("href"))
    plain = pages.select("page", F.lit("https://example.org/").alias("href"))
    return discovery.expanded(_candidates(spark, sf_dir), one.unionByName(two).unionByName(back).unionByName(plain), "Orbit").select("url", "repository", "reciprocal")


@query("renamed_repositories", f"SELECT url, CASE WHEN repository <> '' AND h < 10 THEN 'new/r' || h ELSE repository END AS repository FROM ({_CANDIDATE_SQL})")
def renamed_repositories(spark, sf_dir):
    aliases = spark.range(10).select(F.concat(F.lit("own/R"), _text(F.col("id"))).alias("repository"), F.concat(F.lit("new/r"), _text(F.col("id"))).alias("full_name"))
    return discovery.renamed(_candidates(spark, sf_dir), aliases).select("url", "repository")


@query("same_identity", f"""SELECT a.url, b.url AS other, CASE WHEN a.repository <> '' AND b.repository <> '' THEN lower(a.repository) = lower(b.repository) ELSE starts_with(a.homepage, 'https://h') AND a.homepage = b.homepage END AS same
FROM ({_CANDIDATE_SQL}) a JOIN ({_CANDIDATE_SQL}) b ON b.h = a.h AND b.url > a.url""")
def same_identity(spark, sf_dir):
    rows = discovery.identified(_candidates(spark, sf_dir)).withColumn("h", F.substring("url", 2, 20).cast("bigint") % 40)
    # The groups are few and large: each is dealt to 64 cells, in which an eighth of it meets an eighth. Few rows become many
    # pairs, so tasks are not made fewer by their input's size, and nothing is broadcast, through the driver, by its files' size.
    own, every = F.pmod(F.xxhash64("url"), F.lit(8)).cast("int"), F.explode(F.array(*map(F.lit, range(8))))
    dealt = lambda df: df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h", "line", "place")
    a = dealt(rows.withColumn("line", own).withColumn("place", every)).alias("a")
    b = dealt(rows.withColumn("place", own).withColumn("line", every)).hint("merge").alias("b")
    met = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.line") == F.col("b.line")) & (F.col("a.place") == F.col("b.place")) & (F.col("b.url") > F.col("a.url")))
    return met.select(F.col("a.url").alias("url"), F.col("b.url").alias("other"), discovery.same_identified("a", "b").alias("same"))


@query("project_repositories", f"SELECT DISTINCT repository FROM ({_CANDIDATE_SQL}) WHERE repository <> '' AND homepage IN ('https://h7.org/', 'https://h8.org/', 'https://h9.org/', 'https://h12.org/') ORDER BY repository LIMIT 3")
def project_repositories(spark, sf_dir):
    hosts = spark.range(1).select(F.explode(F.array(*(F.lit(f"h{k}.org") for k in (7, 8, 9, 12)))).alias("host"))
    return discovery.project_repositories(_candidates(spark, sf_dir), hosts)


# What a research client sees

@query("fetch_pages", """SELECT doc_id, o AS "offset", sha256(substr(text, o + 1, 1000)) AS page_sha256, CASE WHEN o + 1000 < length(text) THEN o + 1000 END AS next_offset FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text), 1), 1000)) AS o FROM documents)""")
def fetch_pages(spark, sf_dir):
    found = retrieval.fetch_pages(table(spark, sf_dir, "documents"), "doc_id", "text", 1000)
    return found.select("doc_id", F.col("offset").cast("bigint").alias("offset"), t.content_hash(F.col("page")).alias("page_sha256"), F.col("next_offset").cast("bigint").alias("next_offset"))


@query("version_outline", """SELECT doc_id, heading, CAST(spot AS BIGINT) AS "offset" FROM (SELECT doc_id, unnest([1, 2, 3]) AS k, unnest(['Notes 1.0', 'Other words', 'Notes 2.0']) AS heading, unnest([0, 10, 22]) AS spot FROM documents) WHERE k <> 2""")
def version_outline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Notes 1.0\nOther words\nNotes 2.0\nNotes 1.0\n"), F.col("text")).alias("text"))
    heads = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(h).alias("heading")) for n, h in enumerate(("Notes 1.0", "Other words", "Not there", "Notes 2.0"))))
    sections_ = docs.select("doc_id", F.explode(heads).alias("x")).select("doc_id", "x.n", "x.heading")
    found = retrieval.version_outline(sections_, docs, "doc_id", "n", F.size(v.version_tokens(F.col("heading"))) > 0)
    return found.select("doc_id", "heading", F.col("offset").cast("bigint").alias("offset"))


@query("document_budget", f"SELECT page_id, kind = 'registry_metadata' OR row_number() OVER (PARTITION BY kind = 'registry_metadata' ORDER BY page_id) <= 50 AS within FROM ({SOURCE_SQL})")
def document_budget(spark, sf_dir):
    return retrieval.within_documents(views.sources(spark, sf_dir), 50, "page_id").select("page_id", "within")


@query("note_versions", f"SELECT DISTINCT doc_id % 20 AS source, CAST(doc_id % 7 AS VARCHAR) AS version FROM ({_SECTION_SQL}) WHERE kind IN ('{"', '".join(RELEASE_KINDS)}')")
def note_versions(spark, sf_dir):
    claims = _sections(spark, sf_dir).select((F.col("doc_id") % 20).alias("source"), "kind", F.array(_text(F.col("doc_id") % 7)).alias("versions"))
    return retrieval.note_versions(claims, ("source",))


@query("evidence_numbers", """SELECT l_orderkey AS path, l_linenumber AS cited, l_suppkey AS source, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY first, l_suppkey) AS number FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey, l_suppkey) AS first FROM lineitem)""")
def evidence_numbers(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("cited"), F.col("l_suppkey").alias("source"))
    return retrieval.numbered_evidence(rows, "path", "cited", "source").select("path", "cited", "source", "number")


@query("text_order", "SELECT p_brand AS source, p_partkey AS id, row_number() OVER (PARTITION BY p_brand ORDER BY 's' || p_partkey) AS place FROM part")
def text_order(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), F.col("p_partkey").alias("id"), F.concat(F.lit("s"), _text(F.col("p_partkey"))).alias("key"))
    return selection.in_text_order(rows, "source", "key").select("source", "id", "place")


# Models and their counts

_MODE_SQL = {"severity": "level_rank, confidence_rank, name", "confidence": "confidence_rank, level_rank, name", "name": "name, level_rank, confidence_rank"}
_GRADED_PATHS = f"""SELECT o_orderkey AS path, o_custkey % 50 AS grp, list_position(['critical', 'high', 'medium', 'low', 'unknown'], {LEVEL_SQL}) AS level_rank, ['high', 'medium', 'low'][o_orderkey % 3 + 1] AS confidence, o_orderkey % 3 AS confidence_rank, 'order ' || (o_orderkey % 100) AS name FROM orders"""


@query("sort_modes", "SELECT path, " + ", ".join(f"row_number() OVER (PARTITION BY grp ORDER BY {o}, path) AS by_{m}" for m, o in _MODE_SQL.items()) + f" FROM ({_GRADED_PATHS})")
def sort_modes(spark, sf_dir):
    from pyspark.sql import Window

    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(n.alias("path"), (F.col("o_custkey") % 50).alias("grp"), views.level().alias("level"), _case(n, *map(F.lit, ("high", "medium", "low"))).alias("confidence"), F.concat(F.lit("Order "), _text(n % 100)).alias("name"))
    place = lambda m: F.row_number().over(Window.partitionBy("grp").orderBy(*summary.final_order(mode=m), "path")).cast("bigint").alias(f"by_{m}")
    return rows.select("path", *map(place, _MODE_SQL))


@query("verification_counts", f"SELECT count_if(source_disagreement) AS source_disagreement, count_if(single_source_severe) AS single_source_severe, count_if(no_required_condition) AS no_required_condition FROM ({FLAG_SQL})")
def verification_counts(spark, sf_dir):
    from claimloom.plans.models import _flags

    return summary.verification_counts(_flags(spark, sf_dir))


@query("preliminary_overall", f"""SELECT path // 3 AS model, CASE WHEN 10 * count_if(confidence = 'high') >= 6 * count(*) AND path // 3 % 2 = 0 THEN 'high' WHEN 2 * count_if(confidence = 'low') > count(*) THEN 'low' ELSE 'medium' END AS overall FROM ({PATH_CONFIDENCE_SQL}) GROUP BY path // 3""")
def preliminary_overall(spark, sf_dir):
    from claimloom.operators import confidence
    from claimloom.plans.models import _graded

    rows = confidence.path_confidence(_graded(spark, sf_dir)).groupBy(F.floor(F.col("path") / 3).alias("model"))
    counted = rows.agg(F.count("*").alias("n"), F.count_if(F.col("confidence") == "high").alias("high"), F.count_if(F.col("confidence") == "low").alias("low"))
    return counted.select("model", rubrics.preliminary_overall(F.col("n"), F.col("high"), F.col("low"), F.col("model") % 2 == 0).alias("overall"))


@query("judge_budget", "SELECT p_partkey, CASE WHEN row_number() OVER (ORDER BY p_size, p_partkey) > 30 THEN 'not_checked' WHEN p_partkey % 3 = 0 THEN 'contradicts' ELSE 'supports' END AS verdict FROM part")
def judge_budget(spark, sf_dir):
    judge = lambda: lambda rows: ["contradicts" if r["p_partkey"] % 3 == 0 else "supports" for r in rows]
    return decisions.judged(table(spark, sf_dir, "part").select("p_size", "p_partkey"), judge, 30, "p_size", "p_partkey").select("p_partkey", "verdict")


def extractor():
    """A client that needs no model: a fact for every word that starts with a capital, and nonsense for some."""
    import json

    def ask(request: dict) -> str:
        words = [w for w in request["text"].split(" ") if w[:1].isupper()]
        return "no json" if len(words) > 4 else json.dumps({"items": [{"subject": w, "section": len(w)} for w in words]})

    return ask


_CAPITALS = "list_filter(string_split(p_name, ' '), lambda w: regexp_matches(w, '^[A-Z]'))"


@query("generated_facts", """WITH t AS (SELECT p_partkey AS batch, upper(p_name) || ' ' || p_brand || CASE WHEN p_partkey % 5 = 0 THEN ' A B C' ELSE '' END AS body FROM part), w AS (SELECT batch, string_split(body, ' ') AS words FROM t),
i AS (SELECT batch, words FROM w WHERE len(list_filter(words, lambda x: regexp_matches(x, '^[A-Z]'))) <= 4)
SELECT batch, subject, CAST(length(subject) AS BIGINT) AS section, false AS failed FROM (SELECT batch, unnest(list_filter(words, lambda x: regexp_matches(x, '^[A-Z]'))) AS subject FROM i) WHERE length(subject) BETWEEN 3 AND 7
UNION ALL SELECT batch, NULL, NULL, true FROM w WHERE batch NOT IN (SELECT batch FROM i)""")
def generated_facts(spark, sf_dir):
    n = F.col("p_partkey")
    body = F.concat(F.upper("p_name"), F.lit(" "), F.col("p_brand"), F.when(n % 5 == 0, " A B C").otherwise(""))
    made = generation.generated(table(spark, sf_dir, "part").select(n.alias("batch"), body.alias("body")), "batch", "body", extractor, {"subject": str, "section": int})
    offered = spark.range(3, 8).select(F.col("id").alias("section"))
    return generation.only_known(made, offered, "section").select("batch", "subject", "section", F.col("error").isNotNull().alias("failed"))
