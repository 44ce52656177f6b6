"""Queries over links, decision choices, run summaries and batches of cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import links
from claimloom.functions import versions as v
from claimloom.operators import confidence, resolution, summary
from claimloom.plans import views
from claimloom.plans.catalogue import query
from claimloom.plans.views import LEVEL_SQL, PATH_CONFIDENCE_SQL
from claimloom.session import table

_LINK_SQL = """SELECT page_id, label, CASE page_id % 4 WHEN 0 THEN 'https://docs.orbit.dev/releases/' || n || '/' WHEN 1 THEN 'https://docs.orbit.dev/en/' || n || '.html'
  WHEN 2 THEN 'https://docs.orbit.dev/guide' ELSE 'https://github.com/o/orbit/issues/' || page_id END AS url, page_id % 40 AS major, page_id % 3 AS minor
FROM (SELECT page_id, (page_id % 40) || '.' || (page_id % 3) AS n, CASE page_id % 5 WHEN 0 THEN 'Upgrading' WHEN 1 THEN 'What''s new' ELSE 'Page' END AS label FROM pages)"""
#: In scope: 10 <= version < 21; milestones 11 to 20.
_IN_SQL = "page_id % 4 < 2 AND major >= 10 AND major < 21"
_NOTES_SQL = f"CASE WHEN (page_id % 4 = 0 OR page_id % 5 = 1) AND {_IN_SQL} THEN CASE WHEN minor = 0 AND major >= 11 THEN 0 ELSE 1 END END"
_MILESTONES = [str(k) for k in range(11, 21)]


def _links(spark, sf_dir):
    p = F.col("page_id")
    n = F.concat_ws(".", (p % 40).cast("string"), (p % 3).cast("string"))
    base = F.lit("https://docs.orbit.dev/")
    url = (
        F.when(p % 4 == 0, F.concat(base, F.lit("releases/"), n, F.lit("/"))).when(p % 4 == 1, F.concat(base, F.lit("en/"), n, F.lit(".html")))
        .when(p % 4 == 2, F.concat(base, F.lit("guide"))).otherwise(F.concat(F.lit("https://github.com/o/orbit/issues/"), p.cast("string")))
    )
    label = F.when(p % 5 == 0, "Upgrading").when(p % 5 == 1, "What's new").otherwise("Page")
    rows = table(spark, sf_dir, "pages").select("page_id", url.alias("url"), label.alias("label"))
    return rows.withColumn("keys", links.scope_keys(F.col("url"), F.col("label"), "orbit"))


@query("link_scope", f"SELECT page_id, page_id % 4 < 2 AND NOT (major >= 10 AND major < 21) AS outside FROM ({_LINK_SQL})")
def link_scope(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", links.outside_scope(F.col("keys"), "10", "20").alias("outside"))


@query("release_notes_rank", f"SELECT page_id, {_NOTES_SQL} AS notes_rank FROM ({_LINK_SQL})")
def release_notes_rank(spark, sf_dir):
    rank = links.notes_rank(F.col("url"), F.col("label"), F.col("keys"), "10", "20", _MILESTONES)
    return _links(spark, sf_dir).select("page_id", rank.alias("notes_rank"))


@query("link_priority", f"""SELECT page_id, CASE WHEN page_id % 4 = 3 THEN 9 WHEN notes IS NOT NULL THEN notes WHEN page_id % 5 = 0 THEN CASE WHEN page_id % 4 < 2 AND minor = 0 AND major >= 11 AND major <= 20 THEN 0 ELSE 1 END ELSE 3 END AS priority
FROM (SELECT *, {_NOTES_SQL} AS notes FROM ({_LINK_SQL}))""")
def link_priority(spark, sf_dir):
    from claimloom.functions import urls

    u, label = F.col("url"), F.col("label")
    notes = links.notes_rank(u, label, F.col("keys"), "10", "20", _MILESTONES)
    named = v.milestone_named(label, F.regexp_replace(urls.path(u), r"\.html$", ""), [f"{m}.0" for m in _MILESTONES])
    return _links(spark, sf_dir).select("page_id", links.priority(u, label, urls.site(urls.host(u)) == "orbit.dev", notes, named).alias("priority"))


@query("milestone_siblings", f"""SELECT page_id, 'https://docs.orbit.dev/releases/' || m || '/' AS sibling FROM (SELECT page_id, unnest(['11', '11.0', '12.1']) AS m FROM ({_LINK_SQL}) WHERE page_id % 4 = 0)""")
def milestone_siblings(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", F.explode(links.milestone_siblings(F.col("url"), ["11", "12.1"])).alias("sibling"))


@query("link_relevance", f"SELECT page_id FROM ({_LINK_SQL}) WHERE page_id % 4 IN (0, 3) OR page_id % 5 = 0")
def link_relevance(spark, sf_dir):
    return _links(spark, sf_dir).filter(links.relevant(F.col("label"), F.col("url"))).select("page_id")


_CHOICE_SQL = """SELECT s_nationkey AS nation, s_suppkey, 'https://c/' || s_suppkey AS url, s_suppkey % 3 AS identity, (s_suppkey % 5) * 1.0::DOUBLE AS match, (s_suppkey % 7) * 0.9::DOUBLE AS authority,
  s_suppkey % 4 AS interval_count, s_suppkey % 2 = 0 AS endpoints_found, s_suppkey % 6 = 0 AS detailed, s_suppkey % 8 = 0 AS complete FROM supplier"""
_ELIGIBLE_SQL = f"""SELECT *, row_number() OVER (PARTITION BY nation ORDER BY score DESC, NOT endpoints_found, NOT detailed, NOT complete, url) AS n
  FROM (SELECT *, match + authority AS score FROM ({_CHOICE_SQL}) WHERE match >= 3 AND authority >= 3 AND interval_count > 0)"""


@query("decision_choice", f"""SELECT f.nation, f.url, round(f.score, 6) AS score, CASE WHEN coalesce(f.score - r.rival < 0.25, false) THEN 'ambiguous' ELSE 'resolved' END AS status
FROM (SELECT * FROM ({_ELIGIBLE_SQL}) WHERE n = 1) f LEFT JOIN (SELECT a.nation, max(a.score) AS rival FROM ({_ELIGIBLE_SQL}) a JOIN ({_ELIGIBLE_SQL}) b ON a.nation = b.nation AND b.n = 1 AND a.identity <> b.identity GROUP BY a.nation) r ON r.nation = f.nation""")
def decision_choice(spark, sf_dir):
    k = F.col("s_suppkey")
    choices = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.concat(F.lit("https://c/"), k.cast("string")).alias("url"), (k % 3).alias("identity"), ((k % 5) * 1.0).cast("double").alias("match"),
        ((k % 7).cast("double") * F.lit(0.9)).alias("authority"), (k % 4).alias("interval_count"), (k % 2 == 0).alias("endpoints_found"), (k % 6 == 0).alias("detailed"), (k % 8 == 0).alias("complete"),
    )
    return resolution.decided(choices, "nation").withColumn("score", F.round("score", 6))


@query("authority_rank", """SELECT p_partkey, CASE WHEN p_type = 'SMALL' OR p_size % 9 = 0 THEN 1 WHEN p_type IN ('ECONOMY', 'PROMO') THEN 3 WHEN p_size % 4 = 0 THEN 4 WHEN contains(p_name, 'ring') THEN 3 ELSE 2 END AS authority FROM part""")
def authority_rank(spark, sf_dir):
    kind = F.when(F.col("p_type") == "SMALL", "github_tags").when(F.col("p_type") == "ECONOMY", "npm_release_catalog").when(F.col("p_type") == "PROMO", "github_releases").otherwise("html")
    found = resolution.authority(kind, F.col("p_size") % 9 == 0, F.col("p_size") % 4 == 0, F.replace("p_name", F.lit("ring"), F.lit("Release")))
    return table(spark, sf_dir, "part").select("p_partkey", found.alias("authority"))


@query("run_summary", """SELECT v.c AS "case", count(*) AS versions, count_if(direct) AS direct, count_if(NOT direct AND mention) AS mention_only, count_if(known AND NOT direct AND NOT mention) AS record_only, count_if(NOT known) AS none, any_value(documents) AS documents
FROM (SELECT e.c, u.version, coalesce(direct, false) AS direct, coalesce(mention, false) AS mention, direct IS NOT NULL AS known FROM (SELECT unnest(range(5)) AS c) e CROSS JOIN (SELECT unnest(range(1, 41)) AS version) u
  LEFT JOIN (SELECT user_id % 5 AS c, day(ts) AS version, bool_or(event_type = 'purchase') AS direct, bool_or(event_type = 'view') AS mention FROM events WHERE value > 55 GROUP BY user_id % 5, day(ts)) a ON a.c = e.c AND a.version = u.version) v
JOIN (SELECT user_id % 5 AS c, count(DISTINCT user_id) AS documents FROM events WHERE value > 55 GROUP BY user_id % 5) d ON d.c = v.c GROUP BY v.c""")
def run_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter("value > 55")
    basis = F.when(F.col("event_type") == "purchase", "direct").when(F.col("event_type") == "view", "text_mention").otherwise("record")
    rows = events.select((F.col("user_id") % 5).alias("case"), F.col("user_id").alias("document"), F.dayofmonth("ts").cast("bigint").alias("version"), basis.alias("basis"))
    versions = spark.range(200).select((F.col("id") % 5).alias("case"), (F.floor(F.col("id") / 5) + 1).alias("version"))
    return resolution.run_summary(rows, versions, "case")


def _cases(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), (F.col("o_custkey") % 7).alias("case"))
    graded = confidence.path_confidence(confidence.graded(views.conditions(spark, sf_dir)))
    return views.paths(spark, sf_dir).join(orders, "path").join(graded, "path")


_CASE_SQL = f"SELECT o_custkey % 7 AS c, o_orderkey AS path, {LEVEL_SQL} AS level, confidence FROM orders JOIN ({PATH_CONFIDENCE_SQL}) p ON p.path = o_orderkey"


@query("batch_index", f"""SELECT c AS "case", count(*) AS paths, count_if(level IN ('critical', 'high')) AS severe, count_if(confidence = 'high') AS high_confidence FROM ({_CASE_SQL}) GROUP BY c""")
def batch_index(spark, sf_dir):
    return resolution.batch_index(_cases(spark, sf_dir), "case")


@query("case_headline", f"""SELECT l.c AS "case", l.n || ' risk paths (' || l.levels || ').' || ' Most severe: ' || s.names || '.' AS headline FROM (
  SELECT c, sum(n)::BIGINT AS n, string_agg(n || ' ' || level, ', ' ORDER BY list_position(['critical', 'high', 'medium', 'low', 'unknown'], level)) AS levels FROM (SELECT c, level, count(*) AS n FROM ({_CASE_SQL}) GROUP BY c, level) GROUP BY c) l
JOIN (SELECT c, string_agg('Order ' || path, '; ' ORDER BY p) AS names FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY list_position(['critical', 'high'], level), path) AS p FROM ({_CASE_SQL}) WHERE level IN ('critical', 'high')) WHERE p <= 3 GROUP BY c) s ON s.c = l.c""")
def case_headline(spark, sf_dir):
    return resolution.headline(_cases(spark, sf_dir), "case")


@query("diagnostic_split", """SELECT l_orderkey, note, l_linenumber % 3 <> 0 AS diagnostic FROM (SELECT DISTINCT l_orderkey, l_linenumber,
  ['Unconfirmed condition', '12 extracted facts were rejected', 'No entailment judge ran; medium'][l_linenumber % 3 + 1] AS note FROM lineitem)""")
def diagnostic_split(spark, sf_dir):
    note = F.get(F.array(F.lit("Unconfirmed condition"), F.lit("12 extracted facts were rejected"), F.lit("No entailment judge ran; medium")), F.col("l_linenumber") % 3)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().select("l_orderkey", note.alias("note"))
    return resolution.split_notes(rows)


@query("path_types", "SELECT p_brand AS case_id, p_type AS risk_type, count(*) AS n FROM part GROUP BY p_brand, p_type")
def path_types(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("case_id"), F.col("p_type").alias("risk_type"))
    return summary.facets(rows.withColumn("risk_type", F.concat_ws("\t", "case_id", "risk_type")), ["risk_type"]).select(
        F.get(F.split("value", "\t"), F.lit(0)).alias("case_id"), F.get(F.split("value", "\t"), F.lit(1)).alias("risk_type"), "n"
    )


_GRADED_JSON_SQL = f"""SELECT p.path, level, sha256(to_json(list(struct_pack(condition := condition, role := role, confidence := confidence) ORDER BY condition))::VARCHAR) AS conditions_sha256
FROM ({views.GRADED_SQL}) p JOIN (SELECT o_orderkey AS path, {LEVEL_SQL} AS level FROM orders) o ON o.path = p.path GROUP BY p.path, level"""


@query("final_projection", _GRADED_JSON_SQL)
def final_projection(spark, sf_dir):
    from claimloom.operators import contract

    graded = confidence.graded(views.conditions(spark, sf_dir))
    found = contract.final_paths(views.paths(spark, sf_dir), graded, fields=("role", "confidence")).filter("conditions IS NOT NULL")
    return found.select("path", "level", F.sha2(F.to_json("conditions"), 256).alias("conditions_sha256"))


@query("change_kinds", """SELECT l_orderkey AS path, array_to_string(list_sort(list_distinct(list(CASE l_returnflag WHEN 'A' THEN 'removed' WHEN 'N' THEN 'deprecated' ELSE 'renamed' END) || list(CASE WHEN l_quantity > 45 THEN 'known_issue' END))), ',') AS kinds
FROM lineitem GROUP BY l_orderkey""")
def change_kinds(spark, sf_dir):
    from claimloom.operators import contract

    change = F.when(F.col("l_returnflag") == "A", "removed").when(F.col("l_returnflag") == "N", "deprecated").otherwise("renamed")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), change.alias("change"), (F.col("l_quantity") > 45).alias("known_incompatibility"))
    return contract.change_kinds(rows).select("path", F.array_join("change_kinds", ",").alias("kinds"))


@query("structural_warnings", """SELECT l_orderkey AS path, concat_ws(',', CASE WHEN NOT bool_or(l_linenumber = 1) THEN 'no_version_condition' END, CASE WHEN bool_and(l_linenumber = 1) THEN 'no_other_condition' END) AS warnings FROM lineitem GROUP BY l_orderkey""")
def structural_warnings(spark, sf_dir):
    from claimloom.operators import contract

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), F.when(F.col("l_linenumber") == 1, "version").otherwise("api_usage").alias("category"))
    return contract.structural_warnings(rows).select("path", F.array_join("warnings", ",").alias("warnings"))


@query("search_patterns", """SELECT path, array_to_string(list(pattern ORDER BY seen), ',') AS patterns FROM (SELECT l_orderkey AS path, pattern, min(l_linenumber * 10 + k) AS seen
FROM (SELECT l_orderkey, l_linenumber, unnest([l_returnflag || l_linenumber % 2, l_linestatus]) AS pattern, unnest([1, 2]) AS k FROM (SELECT DISTINCT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY l_orderkey, l_linenumber)) GROUP BY l_orderkey, pattern) GROUP BY path""")
def search_patterns(spark, sf_dir):
    from claimloom.operators import contract

    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("f"), F.min("l_linestatus").alias("s"))
    own = F.array(F.concat(F.col("f"), (F.col("l_linenumber") % 2).cast("string")), F.col("s"))
    rows = items.select(F.col("l_orderkey").alias("path"), "l_linenumber", own.alias("patterns"))
    return contract.search_patterns(rows, "path", "l_linenumber", "patterns").select("path", F.array_join("search_patterns", ",").alias("patterns"))
