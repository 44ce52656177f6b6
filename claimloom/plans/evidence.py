"""Queries over sections, candidates, relevance, selection and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import rubrics
from claimloom.functions import text as t
from claimloom.functions import versions as v
from claimloom.operators import candidates, decisions, facts, numbering, relevance, sections, selection
from claimloom.plans import views
from claimloom.plans.catalogue import query
from claimloom.plans.views import ASSESSED_SQL, DUPLICATE_SQL, FINGERPRINT_SQL, INHERITED_SQL, LOOSE_SQL, TITLE_SQL
from claimloom.session import table

#: Topics that the driver's texts hold.
TOPICS = {"licence": "licen[cs]e", "version": "version", "mail": "@[a-z0-9]", "address": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "secret": "token = "}
_TOPICS_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN '{n}' END" for n, p in TOPICS.items()) + "], lambda x: x IS NOT NULL)"

_TOKENS_SQL = r"""SELECT doc_id, [regexp_extract(r, '[0-9]+(\.[0-9]+)+') FOR r IN regexp_extract_all(text, '[\p{L}\p{N}_.]+') IF regexp_matches(r, '^v?[0-9]+(\.[0-9]+)+\.*$')] AS tokens FROM documents"""


@query("version_tokens", f"SELECT doc_id, array_to_string(tokens, ',') AS tokens FROM ({_TOKENS_SQL}) WHERE len(tokens) > 0")
def version_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", v.version_tokens(F.col("text")).alias("tokens"))
    return docs.filter(F.size("tokens") > 0).select("doc_id", F.array_join("tokens", ",").alias("tokens"))


@query("version_mentions", r"""SELECT doc_id, array_to_string(list_filter(['4.0', '3', '2.0', '1'], lambda m: list_contains(tokens, m)), ',') AS versions FROM (
  SELECT doc_id, [regexp_replace(r, '^v', '') FOR r IN regexp_extract_all(text, '[\p{L}\p{N}_.]+') IF regexp_matches(r, '^v?[0-9]+(\.[0-9]+){0,3}$')] AS tokens FROM documents)
WHERE len(list_filter(['4.0', '3', '2.0', '1'], lambda m: list_contains(tokens, m))) > 0""")
def version_mentions(spark, sf_dir):
    known = F.array(*map(F.lit, ("4.0", "3", "2.0", "1")))
    docs = table(spark, sf_dir, "documents").select("doc_id", v.version_mentions(F.col("text"), known).alias("versions"))
    return docs.filter(F.size("versions") > 0).select("doc_id", F.array_join("versions", ",").alias("versions"))


@query("page_title", f"SELECT page_id, {TITLE_SQL} AS title FROM pages")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sections.page_title(F.col("html")).alias("title"))


@query("link_extract", r"""SELECT page_id, i - 1 AS place, hrefs[i] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i
FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS hrefs FROM pages))""")
def link_extract(spark, sf_dir):
    return sections.links(table(spark, sf_dir, "pages")).withColumn("place", F.col("place").cast("bigint"))


_PLAIN = r"regexp_replace(regexp_replace(array_to_string(list_filter([trim(x, chr(32) || chr(9) || chr(10) || chr(13)) FOR x IN regexp_split_to_array({}, '<[^>]*>')], lambda x: x <> ''), ' '), '&quot;', chr(34), 'g'), '&amp;?', '&', 'g')"


@query("html_sections", f"""WITH a AS (SELECT page_id, url, string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>') AS parts FROM pages),
t AS (SELECT page_id, url, {_PLAIN.format("regexp_extract(parts[1], '<h1>(.*)</h1>', 1, 's')")} AS heading, list_filter([{_PLAIN.format('p')} FOR p IN parts[2:]], lambda p: p <> '') AS texts FROM a)
SELECT page_id, 0 AS section, heading, '' AS path, regexp_replace(url, '#.*$', '') AS address, length(array_to_string(texts, chr(10))) AS chars, md5(array_to_string(texts, chr(10))) AS digest FROM t WHERE len(texts) > 0""")
def html_sections(spark, sf_dir):
    """The twin knows the make of these pages: one article with a heading and flat paragraphs; the tests have pages of other makes."""
    found = sections.html_sections(table(spark, sf_dir, "pages"), url="url")
    return found.select("page_id", "section", "heading", F.array_join("path", " > ").alias("path"), "address", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("digest"))


@query("html_links", r"""SELECT page_id, unnest([0, 1, 2, 3, 4]) AS place, unnest(['navigation', 'link', 'link', 'link', 'feed']) AS kind, unnest(['https://docs.example.org/up/' || page_id, 'https://docs.example.org/v2/guide-' || page_id || '.html',
  'https://docs.example.org/v2/?q=' || page_id, 'https://other.example.net/a', 'https://docs.example.org/feed.xml']) AS address, unnest(['Upgrading to ' || page_id, 'Read this now T', 'search', '', '']) AS label FROM pages""")
def html_links(spark, sf_dir):
    """Pages with a base, a guide in their navigation, links of several makes in the article and beside it, and a feed."""
    key = F.col("page_id").cast("string")
    head = F.lit("<base href='https://docs.example.org/v2/'><link rel=alternate type='application/rss+xml' href='/feed.xml'><link rel=icon href=i.png></head>")
    nav = F.concat(F.lit('<nav><a href="../up/'), key, F.lit('">Upgrading <b>to</b> '), key, F.lit("</a>"))
    main = F.concat(F.lit("<a href=/beside>beside</a><article><A title=T HREF='guide-"), key, F.lit(".html'>Read <b>this</b> now</A><a href=?q="), key, F.lit('>search</a><a name=x>no link</a><aside><a href="/in-aside">x</a></aside><a href="//other.example.net/a"></a>'))
    html = F.col("html")
    for old, new in (("</head>", head), ("<nav>", nav), ("<article>", main)):
        html = F.replace(html, F.lit(old), new)
    return sections.html_links(table(spark, sf_dir, "pages").withColumn("html", html), url="url").withColumn("place", F.col("place").cast("bigint"))


def _marked(spark, sf_dir):
    """Documents whose every fifth line is a heading that names a version."""
    heading = lambda x, i: F.concat(F.when(i % 15 == 0, "# ").otherwise("## "), (i % 4).cast("string"), F.lit("."), (F.col("doc_id") % 5).cast("string"), F.lit(" notes"))
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when(i % 5 == 0, heading(x, i)).otherwise(x))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))


_LINES_SQL = """SELECT doc_id, i, CASE WHEN i % 5 = 0 THEN (i % 4) || '.' || (doc_id % 5) || ' notes' END AS heading, i % 15 = 0 AS top, line FROM (
  SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""
_SECTIONS_SQL = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS section, heading, path, text FROM (
  SELECT doc_id, g, max(heading) AS heading, CASE WHEN bool_or(coalesce(top, false) AND heading IS NOT NULL) THEN '' ELSE max(above) END AS path,
    string_agg(CASE WHEN heading IS NULL THEN line END, chr(10) ORDER BY i) AS text, bool_or(heading IS NULL AND trim(line) <> '') AS body
  FROM (SELECT *, count(heading) OVER w AS g, last_value(CASE WHEN top THEN heading END IGNORE NULLS) OVER w AS above FROM ({_LINES_SQL}) WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))
  GROUP BY doc_id, g) WHERE body"""


@query("markdown_sections", f"SELECT doc_id, section, heading, path, sha256(text) AS text_sha256 FROM ({_SECTIONS_SQL})")
def markdown_sections(spark, sf_dir):
    found = sections.markdown_sections(_marked(spark, sf_dir))
    return found.select("doc_id", F.col("section").cast("bigint").alias("section"), "heading", F.array_join("path", " > ").alias("path"), t.content_hash(F.col("text")).alias("text_sha256"))


@query("heading_scope", f"SELECT doc_id, section, CASE WHEN v IN ('0.1', '1.1', '1.2', '2.0', '3.4') THEN v ELSE '' END AS versions FROM (SELECT *, string_split(heading, ' ')[1] AS v FROM ({_SECTIONS_SQL}))")
def heading_scope(spark, sf_dir):
    known = F.array(*map(F.lit, ("0.1", "1.1", "1.2", "2.0", "3.4")))
    scope = sections.heading_versions(F.col("heading"), F.col("path"), known)
    return sections.markdown_sections(_marked(spark, sf_dir)).select("doc_id", F.col("section").cast("bigint").alias("section"), F.array_join(scope, ",").alias("versions"))


@query("governing_heading", f"""SELECT doc_id, i AS line, last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS governing FROM ({_LINES_SQL})""")
def governing_heading(spark, sf_dir):
    marked = sections.lines(_marked(spark, sf_dir)).withColumn("mark", F.when(F.col("line") % 5 == 0, F.regexp_replace("text", "^#+ ", "")))
    return sections.governing(marked, "doc_id", "line", "mark", "governing").select("doc_id", F.col("line").cast("bigint").alias("line"), "governing")


@query("topic_tags", f"SELECT doc_id, array_to_string({_TOPICS_SQL}, ',') AS topics FROM documents WHERE len({_TOPICS_SQL}) > 0")
def topic_tags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", t.topics(F.col("text"), TOPICS).alias("topics"))
    return docs.filter(F.size("topics") > 0).select("doc_id", F.array_join("topics", ",").alias("topics"))


@query("topic_counts", f"SELECT source, topic, count(*) AS n FROM (SELECT source, unnest({_TOPICS_SQL}) AS topic FROM documents) GROUP BY source, topic")
def topic_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", t.topics(F.col("text"), TOPICS).alias("topics"))
    return candidates.topic_counts(docs, "source")


@query("topic_top", f"""SELECT source, topic, n, place FROM (SELECT source, topic, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, seen, k) AS place FROM (
  SELECT source, topic, count(*) AS n, min(doc_id) AS seen, arg_min(k, (doc_id, k)) AS k FROM (
    SELECT source, doc_id, topics[i] AS topic, i AS k FROM (SELECT source, doc_id, topics, unnest(range(1, len(topics) + 1)) AS i FROM (SELECT source, doc_id, {_TOPICS_SQL} AS topics FROM documents))) GROUP BY source, topic)) WHERE place <= 2""")
def topic_top(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", t.topics(F.col("text"), TOPICS).alias("topics"))
    return candidates.top_topics(docs, "source", "doc_id", 2)


@query("fingerprint_dedup", f"SELECT doc_id, duplicate_of FROM ({DUPLICATE_SQL}) WHERE duplicate_of IS NOT NULL")
def fingerprint_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return candidates.with_duplicates(docs, "doc_id", "doc_id").filter("duplicate_of IS NOT NULL").select("doc_id", "duplicate_of")


@query("content_dup", "SELECT doc_id, sha256(text) AS content_sha256, CASE WHEN first <> doc_id THEN first END AS duplicate_content_of FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)")
def content_dup(spark, sf_dir):
    return candidates.content_duplicates(table(spark, sf_dir, "documents"), "doc_id")


@query("corroboration", f"SELECT doc_id, count(DISTINCT source) OVER (PARTITION BY coalesce(duplicate_of, doc_id)) AS n_sources FROM ({DUPLICATE_SQL})")
def corroboration(spark, sf_dir):
    from claimloom.operators.confidence import corroboration as counted

    docs = candidates.with_duplicates(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id", "doc_id")
    return counted(docs.withColumn("root", F.coalesce("duplicate_of", "doc_id")), "doc_id", "root", "source").select("doc_id", "n_sources")


@query("zero_filled_counts", "SELECT day, coalesce(n, 0) AS n FROM (SELECT unnest(range(1, 41)) AS day) LEFT JOIN (SELECT day(ts) AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY day(ts)) USING (day)")
def zero_filled_counts(spark, sf_dir):
    days = spark.range(1, 41).select(F.col("id").alias("day"))
    counted = table(spark, sf_dir, "events").filter("event_type = 'error'").groupBy(F.dayofmonth("ts").cast("bigint").alias("day")).agg(F.count("*").alias("n"))
    return candidates.counts_with_zeros(counted, days, "day")


def _decided(spark, sf_dir):
    """A decision per label: levels 0 to 4, some with a wrong name, choice or score."""
    n = F.col("doc_id")
    raw = [((n * 7 + k * 3) % 11 + 1).cast("double") for k in range(5)]
    total = raw[0] + raw[1] + raw[2] + raw[3] + raw[4]
    names = [F.when((n % 13 == 0) & F.lit(k == 4), "x").otherwise(str(k)) for k in range(5)]
    rows = table(spark, sf_dir, "labels").select("doc_id", F.map_from_arrays(F.array(*names), F.array(*(r / total for r in raw))).alias("p"), (n % 5).cast("string").alias("choice"))
    known = F.map_filter("p", lambda k, _: k != "x")
    return rows.withColumn("score", rubrics.expected_score(known) + F.when(n % 6 == 0, 0.5).otherwise(0.0)).withColumn("known", known)


_DECIDED_SQL = "SELECT doc_id, [CAST((doc_id * 7 + k * 3) % 11 + 1 AS DOUBLE) FOR k IN range(5)] AS raw, doc_id % 5 AS choice FROM labels"


@query("expected_score", f"SELECT doc_id, round(list_sum([(k - 1) * raw[k] / list_sum(raw) FOR k IN range(1, CASE WHEN doc_id % 13 = 0 THEN 5 ELSE 6 END)]), 6) AS expected FROM ({_DECIDED_SQL})")
def expected_score(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", F.round(rubrics.expected_score(F.col("known")), 6).alias("expected"))


@query("decision_validate", f"""SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 13 = 0 THEN 'unknown_name' END,
  CASE WHEN NOT (doc_id % 13 = 0 AND choice = 4) AND abs(raw[choice + 1] - list_max(raw)) / list_sum(raw) > 0.001 THEN 'not_the_likeliest' END, CASE WHEN doc_id % 6 = 0 THEN 'score' END) AS faults FROM ({_DECIDED_SQL})""")
def decision_validate(spark, sf_dir):
    rows = _decided(spark, sf_dir)
    faults = rubrics.distribution_faults(F.col("p"), F.col("choice"), F.col("score"), [str(k) for k in range(5)])
    # The expected score of an unknown name is null, so its score is checked over the known ones.
    known = F.when(F.abs(rubrics.expected_score(F.col("known")) - F.col("score")) > 1e-3, "score")
    rest = F.filter(faults, lambda f: f != "score")
    return rows.select("doc_id", F.concat_ws(",", rest, known).alias("faults"))


@query("relevance_label", f"SELECT doc_id, status, label FROM ({ASSESSED_SQL})")
def relevance_label(spark, sf_dir):
    return _assessed(spark, sf_dir).select("doc_id", "status", "label")


def _assessed(spark, sf_dir):
    return relevance.assessed(relevance.budgeted(views.scored_documents(spark, sf_dir), 20, "n_chars", "doc_id", by=("source",)))


@query("relevance_budget", f"SELECT source, count_if(attempted) AS attempted, count_if(duplicate_of IS NULL AND NOT attempted) AS over_budget, count_if(duplicate_of IS NOT NULL) AS duplicates FROM ({ASSESSED_SQL}) GROUP BY source")
def relevance_budget(spark, sf_dir):
    own = F.col("duplicate_of").isNull()
    return _assessed(spark, sf_dir).groupBy("source").agg(F.count_if("attempted").alias("attempted"), F.count_if(own & ~F.col("attempted")).alias("over_budget"), F.count_if(~own).alias("duplicates"))


@query("relevance_inherit", f"SELECT doc_id, duplicate_of, status, label, score FROM ({INHERITED_SQL})")
def relevance_inherit(spark, sf_dir):
    return relevance.inherited(_assessed(spark, sf_dir), "doc_id").select("doc_id", "duplicate_of", "status", "label", "score")


@query("relevance_histogram", f"""SELECT source, count_if(status = 'scored') AS scored, count_if(status = 'failed') AS failed, count_if(status = 'not_scored') AS not_scored,
  count_if(label = 'risk_candidate') AS risk_candidate, count_if(label = 'context') AS context, count_if(label = 'not_relevant') AS not_relevant FROM ({ASSESSED_SQL}) WHERE duplicate_of IS NULL GROUP BY source""")
def relevance_histogram(spark, sf_dir):
    return relevance.histogram(_assessed(spark, sf_dir), "source")


_SELECT_SQL = f"""SELECT doc_id, source, excluded, CASE WHEN excluded IS NULL THEN row_number() OVER (PARTITION BY source, excluded IS NULL ORDER BY
    CASE WHEN status = 'scored' AND label = 'risk_candidate' THEN 0 WHEN status = 'scored' AND label = 'context' THEN 1 ELSE 2 END, -coalesce(score, 0), n_chars, doc_id) END AS place
  FROM (SELECT *, CASE WHEN duplicate_of IS NOT NULL THEN 'duplicate' WHEN status = 'scored' AND label NOT IN ('risk_candidate', 'context') THEN 'not_relevant' END AS excluded FROM ({INHERITED_SQL}))"""


@query("section_select", f"SELECT doc_id, source, excluded, place, coalesce(place <= 10, false) AS chosen FROM ({_SELECT_SQL})")
def section_select(spark, sf_dir):
    rows = relevance.inherited(_assessed(spark, sf_dir), "doc_id")
    return selection.selected(rows, 10, True, ("source",), "n_chars", "doc_id").select("doc_id", "source", "excluded", "place", "chosen")


@query("exclusion_counts", f"SELECT excluded, count(*) AS n FROM ({_SELECT_SQL}) WHERE excluded IS NOT NULL GROUP BY excluded")
def exclusion_counts(spark, sf_dir):
    rows = relevance.inherited(_assessed(spark, sf_dir), "doc_id").withColumn("excluded", selection.exclusion(True))
    return rows.filter("excluded IS NOT NULL").groupBy("excluded").agg(F.count("*").alias("n"))


@query("batch_pack", """WITH RECURSIVE r AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
p AS (SELECT conv_id, turn, n, size AS chars, 1 AS items, 0 AS batch FROM r WHERE n = 1
  UNION ALL SELECT r.conv_id, r.turn, r.n, CASE WHEN p.chars + r.size > 1500 OR p.items >= 3 THEN r.size ELSE p.chars + r.size END,
    CASE WHEN p.chars + r.size > 1500 OR p.items >= 3 THEN 1 ELSE p.items + 1 END, CASE WHEN p.chars + r.size > 1500 OR p.items >= 3 THEN p.batch + 1 ELSE p.batch END
  FROM p JOIN r ON r.conv_id = p.conv_id AND r.n = p.n + 1)
SELECT conv_id, turn, CAST(batch AS BIGINT) AS batch FROM p""")
def batch_pack(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return selection.batches(rows, "conv_id", "turn", "size", 1500, 3)


@query("quote_grounding", f"SELECT item_id, doc_id FROM (SELECT item_id, {LOOSE_SQL.format('text')} AS q FROM benchmark) JOIN (SELECT doc_id, {LOOSE_SQL.format('text')} AS d FROM documents) ON contains(d, q)")
def quote_grounding(spark, sf_dir):
    return facts.grounded_pairs(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")


_DRAFT_SQL = f"""SELECT d.doc_id, {LOOSE_SQL.format('d.text')} AS body, CASE WHEN d.doc_id % 2 = 0 THEN {LOOSE_SQL.format('b.text')} ELSE {LOOSE_SQL.format('substr(d.text, 3, 40)')} END AS quote,
  [[], ['1.0'], ['1.0', '9.0']][d.doc_id % 3 + 1] AS versions, d.doc_id % 5 < 3 AS scoped FROM documents d
  JOIN (SELECT text, row_number() OVER (ORDER BY item_id) - 1 AS place, count(*) OVER () AS n FROM benchmark) b ON b.place = d.doc_id % b.n"""


def _drafts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = numbering.numbered(table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item")), "place", "item_id")
    count = items.agg(F.count("*").alias("n_items"))
    # Every document meets one item, and every item takes part, whatever the sizes.
    joined = docs.crossJoin(F.broadcast(count)).join(items, F.col("doc_id") % F.col("n_items") == F.col("place") - 1)  # one row
    k = F.col("doc_id") % 3
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        F.col("text").alias("section_text"),
        F.when(F.col("doc_id") % 2 == 0, F.col("item")).otherwise(F.substring("text", 3, 40)).alias("quote"),
        F.when(k == 0, none).when(k == 1, F.array(F.lit("1.0"))).otherwise(F.array(F.lit("1.0"), F.lit("9.0"))).alias("versions"),
        F.array(F.lit("1.0"), F.lit("2.0")).alias("section_versions"),
        F.when(F.col("doc_id") % 5 < 3, "version_heading").otherwise("document_association").alias("version_scope"),
    )


@query("fact_reject_reasons", f"""SELECT doc_id, CASE WHEN NOT contains(body, quote) THEN 'quote_not_in_section' WHEN scoped AND list_contains(versions, '9.0') THEN 'versions_contradict_heading' END AS reason,
  array_to_string(CASE WHEN len(versions) = 0 AND contains(body, quote) THEN ['1.0', '2.0'] ELSE versions END, ',') AS versions FROM ({_DRAFT_SQL})""")
def fact_reject_reasons(spark, sf_dir):
    return facts.acceptance(_drafts(spark, sf_dir)).select("doc_id", "reason", F.array_join("versions", ",").alias("versions"))


@query("evidence_faults", f"""SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 7 = 0 THEN 'unknown_source' END, CASE WHEN doc_id % 9 = 0 THEN 'no_document' END,
  CASE WHEN doc_id % 9 <> 0 AND NOT contains(body, quote) THEN 'quote_not_found' END, CASE WHEN list_contains(versions, '9.0') THEN 'versions_outside' END, CASE WHEN doc_id % 8 = 0 THEN 'unknown_fact' END) AS faults FROM ({_DRAFT_SQL})""")
def evidence_faults(spark, sf_dir):
    n = F.col("doc_id")
    text = F.when(n % 9 != 0, F.col("section_text"))
    found = facts.evidence_faults(n % 7 != 0, text, F.col("quote"), F.col("versions"), F.col("section_versions"), n % 8 != 0)
    return _drafts(spark, sf_dir).select("doc_id", F.array_join(found, ",").alias("faults"))


@query("agent_claims", f"""SELECT doc_id, reason IS NULL AS accepted, reason FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'source_not_observed' WHEN quote = '' THEN 'empty_quote'
  WHEN quote = {LOOSE_SQL.format('head')} THEN 'heading_only' WHEN NOT contains(body, quote) THEN 'not_contiguous' END AS reason
FROM (SELECT x.*, substr(d.text, 1, 42) AS head FROM (SELECT doc_id, body, CASE WHEN doc_id % 10 = 1 THEN (SELECT {LOOSE_SQL.format('substr(text, 1, 42)')} FROM documents z WHERE z.doc_id = y.doc_id LIMIT 1) ELSE quote END AS quote FROM ({_DRAFT_SQL}) y) x JOIN documents d USING (doc_id)))""")
def agent_claims(spark, sf_dir):
    drafts = _drafts(spark, sf_dir)
    head = F.substring("section_text", 1, 42)
    asked = drafts.select("doc_id", F.col("doc_id").alias("source"), F.when(F.col("doc_id") % 10 == 1, head).otherwise(F.col("quote")).alias("quote"))
    observed = drafts.filter("doc_id % 9 <> 0").select(F.col("doc_id").alias("source"), F.col("section_text").alias("text"), head.alias("heading"))
    return decisions.claims(asked, observed).select("doc_id", "accepted", "reason")


_SUBJECT_SQL = "SELECT p_partkey AS fact, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || '()' ELSE p_name END AS subject, p_type AS change FROM part"
_CLUSTER_SQL = f"""SELECT key AS cluster_key, min(fact) AS first_fact, arg_min(subject, fact) AS label, array_to_string(list_sort(list(DISTINCT change)), ',') AS changes, count(*) AS n_facts,
  row_number() OVER (ORDER BY min(fact)) AS cluster FROM (SELECT *, regexp_replace(replace(lower(subject), '()', ''), '[^a-z0-9.]+', '', 'g') AS key FROM ({_SUBJECT_SQL})) GROUP BY key"""


def _clusters(spark, sf_dir):
    k = F.col("p_partkey") % 3
    subject = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat(F.col("p_name"), F.lit("()"))).otherwise(F.col("p_name"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("fact"), subject.alias("subject"), F.col("p_type").alias("change"))
    return facts.clusters(rows, "subject", "fact", "change")


@query("subject_clusters", _CLUSTER_SQL)
def subject_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir).withColumn("changes", F.array_join("changes", ","))


@query("cluster_chunks", f"SELECT cluster, (cluster - 1) // 10 AS chunk FROM ({_CLUSTER_SQL})")
def cluster_chunks(spark, sf_dir):
    return facts.chunked(_clusters(spark, sf_dir), "cluster", 10).select("cluster", "chunk")


@query("group_partition", f"""SELECT c.cluster, g.grp AS "group", CASE WHEN g.grp IS NULL THEN 'unassigned' ELSE 'grouped' END AS method FROM ({_CLUSTER_SQL}) c
LEFT JOIN (SELECT cluster, min(grp) AS grp FROM (SELECT cluster, cluster % 7 AS grp FROM ({_CLUSTER_SQL}) WHERE cluster % 3 <> 0 UNION ALL SELECT cluster, cluster % 5 FROM ({_CLUSTER_SQL}) WHERE cluster % 2 = 0) GROUP BY cluster) g ON g.cluster = c.cluster""")
def group_partition(spark, sf_dir):
    own = _clusters(spark, sf_dir).select("cluster")
    first = own.filter("cluster % 3 <> 0").withColumn("group", F.col("cluster") % 7)
    second = own.filter("cluster % 2 = 0").withColumn("group", F.col("cluster") % 5)
    return facts.partitioned(first.unionByName(second), own, "cluster", "group")


@query("slugs", """SELECT p_partkey, CASE WHEN s = '' THEN 'item' ELSE s END AS slug FROM (SELECT p_partkey, regexp_replace(substr(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 12), '_+$', '') AS s FROM part)""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", t.slug(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")), 12).alias("slug"))


@query("unique_slugs", """SELECT p_brand, p_partkey, base, base || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS slug FROM (SELECT p_brand, p_partkey, replace(p_name, ' ', '_') AS base, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS n FROM part)""")
def unique_slugs(spark, sf_dir):
    """No base here ends in a number, so numbering each base is the same; tests cover those that do."""
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", t.slug(F.col("p_name")).alias("base"))
    return selection.unique_slugs(rows, "p_brand", "p_partkey", "base")


@query("loose_text", f"SELECT doc_id, sha256({LOOSE_SQL.format('text')}) AS loose_sha256, length({FINGERPRINT_SQL}) AS fingerprint_chars FROM documents")
def loose_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.content_hash(t.loose(F.col("text"))).alias("loose_sha256"), F.length(t.fingerprint(F.col("text"))).cast("bigint").alias("fingerprint_chars"))


_CHANGED_SQL = "substr(text, 4, 10 + doc_id % 50) || 'Q' || substr(text, 14 + doc_id % 50, 20)"


@query("quote_divergence", f"""SELECT doc_id, max(CASE WHEN contains(text, substr(quote, 1, n)) THEN n ELSE 0 END) AS length FROM (SELECT doc_id, text, quote, unnest(range(0, length(quote) + 1)) AS n FROM (SELECT doc_id, text, {_CHANGED_SQL} AS quote FROM documents)) GROUP BY doc_id""")
def quote_divergence(spark, sf_dir):
    """Each document with a quote that leaves its text at some place."""
    n = (F.col("doc_id") % 50).cast("int")
    quote = F.concat(F.substring(F.col("text"), F.lit(4), n + 10), F.lit("Q"), F.substring(F.col("text"), n + 14, F.lit(20)))
    return table(spark, sf_dir, "documents").select("doc_id", t.divergence(quote, F.col("text")).cast("bigint").alias("length"))


@query("keyword_decisions", """SELECT doc_id, CASE WHEN NOT bool_or(contains(part, 'token =')) THEN max(CASE WHEN contains(part, 'license') THEN 4.0 ELSE 1.0 END) END AS score,
  CASE WHEN bool_or(contains(part, 'token =')) THEN 'refused' END AS error FROM (SELECT doc_id, lower(substr(text, o + 1, 4000)) AS part FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text), 1), 4000)) AS o FROM documents)) GROUP BY doc_id""")
def keyword_decisions(spark, sf_dir):
    """Whole documents, a portion at a time."""
    docs = decisions.portions(table(spark, sf_dir, "documents"), "doc_id", "text")
    return decisions.combined(decisions.decided(docs, lambda: decisions.keyword_backend("license", "token ="), "doc_id"), "doc_id")
