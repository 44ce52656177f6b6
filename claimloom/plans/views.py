"""Declared views that bind the driver's tables to the engine's logical tables, in both dialects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.operators.sections import page_title
from claimloom.session import table

#: DuckDB: the sortable key of a two-part version.
KEY = "([CAST(x AS BIGINT) FOR x IN string_split(version, '.')] || [0, 0])"
RELEASE_SQL = "SELECT p_brand AS catalog, p_size || '.' || (p_partkey % 10) AS version, p_partkey AS position FROM part"
HOST_SQL = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
TITLE_SQL = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
FINGERPRINT_SQL = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"
LOOSE_SQL = r"trim(regexp_replace(translate({}, '`*_>#', '     '), '[\s\p{{Z}}]+', ' ', 'g'))"


def text(value: Column) -> Column:
    return value.cast("string")


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.concat_ws(".", text(F.col("p_size")), text(F.col("p_partkey") % 10))
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("catalog"), version.alias("version"), F.col("p_partkey").alias("position"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as documents: url, title, kind, bases of association, verified quotes, recorded relation."""
    pages = table(spark, sf_dir, "pages")
    title = page_title(F.col("html"))
    kind = F.when(F.col("page_id") % 10 == 0, "registry_metadata").when(F.col("page_id") % 10 == 1, "upgrade_guide").otherwise(urls.document_kind(F.col("url"), F.col("title")))
    bases = F.when(F.col("page_id") % 4 == 0, F.array().cast("array<string>")).when(F.col("page_id") % 4 == 1, F.array(F.lit("linked_context"))).otherwise(F.array(F.lit("linked_context"), F.lit("text_mention")))
    relation = F.when(F.col("page_id") % 9 == 0, "selected_project_site")
    return pages.select("page_id", "url", title.alias("title")).select("page_id", "url", "title", kind.alias("kind"), bases.alias("bases"), (F.col("page_id") % 3).alias("verified_quotes"), relation.alias("relation"))


KIND_SQL = rf"""CASE WHEN regexp_matches(url || ' ' || title, '(?i)migrat|upgrad') THEN 'upgrade_guide'
  WHEN regexp_matches(url || ' ' || title, '(?i)deprecat') THEN 'deprecation_notice'
  WHEN regexp_matches(url || ' ' || title, '(?i)changelog|release.?notes|/releases?/') THEN 'release_notes'
  WHEN regexp_matches(url, '(?i)/blog/|/news/') THEN 'blog_post'
  WHEN regexp_matches(url || ' ' || title, '(?i)/docs?/|documentation|\bdocs?\b|readme|\bapi\b') THEN 'api_documentation'
  ELSE 'supporting_document' END"""
SOURCE_SQL = f"""SELECT page_id, url, title,
  CASE WHEN page_id % 10 = 0 THEN 'registry_metadata' WHEN page_id % 10 = 1 THEN 'upgrade_guide' ELSE {KIND_SQL} END AS kind,
  CASE page_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS n_bases, page_id % 3 AS verified_quotes,
  CASE WHEN page_id % 9 = 0 THEN 'selected_project_site' END AS relation, {HOST_SQL} AS host
FROM (SELECT page_id, url, {TITLE_SQL} AS title FROM pages)"""
SITE_SQL = r"regexp_extract(host, '([^.]*\.)?[^.]*$', 0)"
TIER_SQL = f"""CASE WHEN url = (SELECT min(url) FROM pages) OR kind = 'registry_metadata' THEN 'official'
  WHEN host <> '' AND {SITE_SQL} = 'example.org' THEN 'official'
  WHEN coalesce(relation = 'selected_project_site', false) THEN 'official' ELSE 'third_party' END"""
TIER_RANK_SQL = "CASE tier WHEN 'official' THEN 0 WHEN 'probable_official' THEN 1 WHEN 'official_repository_discussion' THEN 2 WHEN 'third_party' THEN 3 ELSE 4 END"


def facts(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Distinct claims of ``lineitem``: subject = part, source = supplier; if ``dealt``, a subject's all in one task, by one shuffle."""
    items = table(spark, sf_dir, "lineitem")
    change = F.when(F.col("l_returnflag") == "A", "removed").when(F.col("l_returnflag") == "N", "deprecated").otherwise("renamed")
    rows = items.select(
        F.col("l_partkey").alias("subject"),
        F.col("l_suppkey").alias("source"),
        change.alias("change"),
        (F.col("l_linestatus") == "F").alias("is_risk"),
        F.format_string("%.2f", F.col("l_discount")).alias("value"),
        F.year("l_shipdate").alias("year"),
    )
    rows = (rows.repartition("subject") if dealt else rows).distinct()
    fact = F.concat_ws("|", *(F.col(c).cast("string") for c in ("subject", "source", "change", "is_risk", "value", "year")))
    tier = F.when(F.col("source") % 4 == 0, "official").when(F.col("source") % 4 == 1, "probable_official").when(F.col("source") % 4 == 2, "official_repository_discussion").otherwise("third_party")
    return rows.select(
        fact.alias("fact"), "subject", "source", "change", "is_risk", "value", F.array(F.col("year").cast("string")).alias("versions"),
        ((F.col("source") % 2) == 0).alias("scoped"), tier.alias("tier"), F.col("year").cast("bigint").alias("latest"),
    )


FACT_SQL = """SELECT concat_ws('|', subject, source, change, is_risk, value, year) AS fact, subject, source, change, is_risk, value, year,
  source % 2 = 0 AS scoped, CASE source % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS tier_rank
FROM (SELECT DISTINCT l_partkey AS subject, l_suppkey AS source,
    CASE l_returnflag WHEN 'A' THEN 'removed' WHEN 'N' THEN 'deprecated' ELSE 'renamed' END AS change,
    l_linestatus = 'F' AS is_risk, printf('%.2f', l_discount) AS value, year(l_shipdate) AS year FROM lineitem)"""
PAIR_SQL = f"""SELECT a.subject, CASE WHEN (a.change, b.change) IN (('removed', 'deprecated'), ('deprecated', 'removed')) THEN 'severity'
    WHEN a.is_risk <> b.is_risk THEN 'risk_vs_context' WHEN a.change <> b.change THEN NULL
    WHEN a.value <> b.value THEN 'value' WHEN a.scoped AND b.scoped AND a.year <> b.year THEN 'versions' END AS kind, a.fact AS a, b.fact AS b
  FROM ({FACT_SQL}) a JOIN ({FACT_SQL}) b ON a.subject = b.subject AND a.fact < b.fact AND a.source <> b.source"""


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as conditions of a path; what a verification would have measured comes from their columns."""
    items = table(spark, sf_dir, "lineitem")
    grouped = items.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("cited"),
        F.count_if(F.col("l_quantity") > 5).alias("grounded"),
        F.count_if(F.col("l_discount") > 0.08).alias("n_speculative"),
        F.count_if(F.col("l_tax") > 0.05).alias("n_implied"),
        F.min(F.col("l_suppkey") % 4).cast("int").alias("best_rank"),
        F.array_sort(F.collect_set("l_suppkey")).alias("sources"),
        F.count_if(F.col("l_returnflag") == "R").alias("touching"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05)).alias("lost"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") < 0.01)).alias("unresolved"),
        F.max("l_tax").alias("tax"),
    )
    n = (F.col("l_orderkey") + F.col("l_linenumber")) % 6
    verdict = F.when(n == 0, "contradicts").when(n == 1, "partially_supports").when(n == 2, "not_checked").otherwise("supports")
    role = F.when(F.col("l_linenumber") <= 2, "required").when(F.col("l_linenumber") == 3, "alternative").when(F.col("l_linenumber") == 4, "uncertain").otherwise("optional")
    return grouped.select(
        F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("condition"), "cited", "grounded", "n_speculative", "n_implied", "best_rank",
        "sources", "touching", "lost", "unresolved", verdict.alias("verdict"), role.alias("role"), F.when(F.col("tax") > 0.07, 0.6).otherwise(0.1).alias("unsupported"),
    )


CONDITION_SQL = """SELECT l_orderkey AS path, l_linenumber AS condition, count(*) AS cited, count_if(l_quantity > 5) AS grounded,
  count_if(l_discount > 0.08) AS n_speculative, count_if(l_tax > 0.05) AS n_implied, min(l_suppkey % 4) AS best_rank,
  list_sort(list(DISTINCT l_suppkey)) AS sources, count_if(l_returnflag = 'R') AS touching,
  count_if(l_returnflag = 'R' AND l_discount > 0.05) AS lost, count_if(l_returnflag = 'R' AND l_discount < 0.01) AS unresolved,
  CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN 'contradicts' WHEN 1 THEN 'partially_supports' WHEN 2 THEN 'not_checked' ELSE 'supports' END AS verdict,
  CASE WHEN l_linenumber <= 2 THEN 'required' WHEN l_linenumber = 3 THEN 'alternative' WHEN l_linenumber = 4 THEN 'uncertain' ELSE 'optional' END AS role,
  CASE WHEN max(l_tax) > 0.07 THEN 0.6 ELSE 0.1 END AS unsupported
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
GRADED_SQL = f"""SELECT *, CASE WHEN low <> '' THEN 'low' WHEN missing <> '' THEN 'medium' ELSE 'high' END AS confidence FROM (
  SELECT *, concat_ws(',', CASE WHEN grounded = 0 AND cited > 0 THEN 'not_grounded' END, CASE WHEN verdict IN ('contradicts', 'unrelated') THEN 'judge_disputes' END,
    CASE WHEN role = 'uncertain' THEN 'uncertain_role' END, CASE WHEN cited > 0 AND n_speculative = cited THEN 'speculative' END,
    CASE WHEN best_rank = 3 THEN 'third_party_only' END, CASE WHEN lost > 0 THEN 'lost_conflict' END, CASE WHEN unresolved > 0 THEN 'unresolved_conflict' END) AS low,
  concat_ws(',', CASE WHEN grounded > 0 AND grounded < cited THEN 'partly_grounded' END, CASE WHEN verdict = 'not_checked' THEN 'not_judged' END,
    CASE WHEN verdict = 'partially_supports' THEN 'partial_support' END, CASE WHEN unsupported >= 0.5 THEN 'adds_detail' END, CASE WHEN n_implied > 0 THEN 'implied' END,
    CASE WHEN best_rank IN (1, 2) THEN 'not_official' END, CASE WHEN touching > 0 AND lost = 0 AND unresolved = 0 THEN 'won_conflict' END) AS missing
  FROM ({CONDITION_SQL}))"""
PATH_CONFIDENCE_SQL = f"""SELECT path, CASE WHEN CASE WHEN has_core THEN core_low ELSE any_low END THEN 'low'
    WHEN CASE WHEN has_core THEN core_not_high ELSE any_not_high END THEN 'medium' ELSE 'high' END AS confidence
  FROM (SELECT path, bool_or(role IN ('required', 'alternative')) AS has_core,
    bool_or(role IN ('required', 'alternative') AND confidence = 'low') AS core_low, bool_or(role IN ('required', 'alternative') AND confidence <> 'high') AS core_not_high,
    bool_or(confidence = 'low') AS any_low, bool_or(confidence <> 'high') AS any_not_high FROM ({GRADED_SQL}) GROUP BY path)"""
LEVEL_SQL = "CASE CAST(left(o_orderpriority, 1) AS INTEGER) WHEN 1 THEN 'critical' WHEN 2 THEN 'high' WHEN 3 THEN 'medium' WHEN 4 THEN 'unknown' ELSE 'low' END"
FLAG_SQL = f"""SELECT g.path, ungrounded_condition, judge_disputed_condition, source_disagreement, no_required_condition,
    level IN ('critical', 'high') AND n_sources = 1 AS single_source_severe
  FROM (SELECT path, bool_or(grounded = 0 AND cited > 0) AS ungrounded_condition, bool_or(verdict IN ('contradicts', 'unrelated')) AS judge_disputed_condition,
      bool_or(touching > 0) AS source_disagreement, len(list_distinct(flatten(list(sources)))) AS n_sources,
      NOT bool_or(role IN ('required', 'alternative')) AS no_required_condition FROM ({CONDITION_SQL}) GROUP BY path) g
  JOIN (SELECT o_orderkey AS path, {LEVEL_SQL} AS level FROM orders) o ON o.path = g.path"""


def level() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    return F.when(first == "1", "critical").when(first == "2", "high").when(first == "3", "medium").when(first == "4", "unknown").otherwise("low")


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), level().alias("level"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidate sections with a decision model's score (null: the call failed) and duplicates."""
    from claimloom.operators.candidates import with_duplicates

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    found = with_duplicates(docs, "doc_id", "doc_id").drop("text").join(labels, "doc_id", "left")
    made = F.coalesce("quality", F.lit(0)) * 2.0 + F.coalesce("toxic", F.lit(0)) * 1.5 + (F.col("doc_id") % 3) * 0.5
    return found.select("doc_id", "source", "n_chars", "duplicate_of", F.when(F.col("doc_id") % 11 != 0, made).alias("score"))


DUPLICATE_SQL = f"""SELECT doc_id, source, n_chars, CASE WHEN length(fp) >= 40 AND first_doc <> doc_id THEN first_doc END AS duplicate_of
  FROM (SELECT *, first_value(doc_id) OVER (PARTITION BY fp ORDER BY doc_id) AS first_doc FROM (SELECT *, {FINGERPRINT_SQL} AS fp FROM documents))"""
SCORED_SQL = f"""SELECT d.*, CASE WHEN d.doc_id % 11 <> 0 THEN coalesce(quality, 0) * 2.0 + coalesce(toxic, 0) * 1.5 + (d.doc_id % 3) * 0.5 END::DOUBLE AS score
  FROM ({DUPLICATE_SQL}) d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
ATTEMPT_SQL = f"""SELECT *, duplicate_of IS NULL AND row_number() OVER (PARTITION BY source, duplicate_of IS NULL ORDER BY n_chars, doc_id) <= 20 AS attempted FROM ({SCORED_SQL})"""
ASSESSED_SQL = f"""SELECT *, CASE WHEN status = 'scored' THEN CASE WHEN score >= 2.5 THEN 'risk_candidate' WHEN score >= 1.5 THEN 'context' ELSE 'not_relevant' END END AS label
  FROM (SELECT *, CASE WHEN NOT attempted THEN 'not_scored' WHEN score IS NULL THEN 'failed' ELSE 'scored' END AS status FROM ({ATTEMPT_SQL}))"""
INHERITED_SQL = f"""SELECT a.doc_id, a.source, a.n_chars, a.duplicate_of,
    coalesce(CASE WHEN a.duplicate_of IS NULL THEN a.status ELSE r.status END, 'not_scored') AS status,
    CASE WHEN a.duplicate_of IS NULL THEN a.label ELSE r.label END AS label, CASE WHEN a.duplicate_of IS NULL THEN a.score ELSE r.score END AS score
  FROM ({ASSESSED_SQL}) a LEFT JOIN ({ASSESSED_SQL}) r ON r.doc_id = a.duplicate_of AND r.duplicate_of IS NULL"""
