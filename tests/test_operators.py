import heapq
import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import candidates, confidence, conflicts, decisions, discovery, evaluation, facts, frontier, generation, identity, manifest, numbering, relevance, releases, sections, selection, sources, summary


def test_first_catalog_record_wins(spark):
    rows = [("a", "4.0", 1), ("a", "4.0.0", 0), ("a", "3.2.1", 2), ("b", "4.1", 0), ("a", "x", 5)]
    found = releases.select(spark.createDataFrame(rows, "catalog string, version string, position int"), "3.2", "4.2").collect()
    assert {(r.catalog, r.version, r.place) for r in found} == {("a", "4.0.0", 1), ("b", "4.1", 1)}


def test_identity_scores(spark):
    rows = [
        ("orbit", "u1", "org/orbit", "https://orbit.dev", "The orbit framework", "github", False, True, False),
        ("orbit-client", "u2", "", "", "A client for orbit", "npm", False, False, False),
        ("orbit", "u3", "x/orbit", "", "fork", "github", True, False, False),
        ("other", "u4", "", "https://www.orbitproject.org", "", "html", False, False, True),
    ]
    frame = spark.createDataFrame(rows, "name string, url string, repository string, homepage string, description string, kind string, fork boolean, reciprocal boolean, from_search boolean")
    scored = {r.url: (r.score, r.rejected) for r in identity.score(frame, "orbit").collect()}
    assert scored == {"u1": (17, False), "u2": (-18, True), "u3": (-3, True), "u4": (4, False)}
    top = identity.chosen(identity.ranked(identity.score(frame, "orbit"))).first()
    assert (top.identity, top.status) == ("github:org/orbit", "resolved")
    merged = identity.merged(spark.createDataFrame([("u", "first", 0, ["a"]), ("u", "second", 1, ["b", "a"])], "url string, name string, position int, evidence array<string>")).first()
    assert (merged.name, merged.evidence) == ("first", ["a", "b"])


def test_exclusion_and_rank(spark):
    rows = [([], "official", 0), (["linked_context"], "third_party", 0), (["linked_context"], "official", 0), (["linked_context", "text_mention"], "third_party", 0)]
    frame = spark.createDataFrame(rows, "bases array<string>, tier string, n int")
    assert [r[0] for r in frame.select(sources.exclusion(F.col("bases"), F.col("tier"))).collect()] == ["no_version", "linked_only", None, None]
    rows = [("b", "third_party", "release_notes", 9), ("a", "official", "blog_post", 0), ("c", "official", "upgrade_guide", 0), ("d", "official", "upgrade_guide", 2), ("e", "official", "odd", 0)]
    found = sources.ranked(spark.createDataFrame(rows, "url string, tier string, kind string, verified_quotes int")).orderBy("rank").collect()
    assert [r.url for r in found] == ["d", "c", "a", "e", "b"]
    own = sources.project_identity(spark.createDataFrame([("git+https://github.com/A/b.git",), ("https://docs.a.org/x",), ("https://github.com",)], "address string")).first()
    assert (own.sites, own.repositories) == (["a.org"], ["a/b"])


MARKDOWN = "intro\n# 3.0.0\n\n## Fixes\nfix one\n# 2.1.0\nnote\n### Deep\ndeep text\n## Empty\n# 1.0.0\nold"


def test_markdown_sections_and_scope(spark):
    docs = spark.createDataFrame([(1, MARKDOWN), (2, None), (3, ""), (4, "no heading")], "doc_id bigint, text string")
    found = sections.markdown_sections(docs)
    known = F.array(F.lit("3.0.0"), F.lit("2.1"))
    rows = found.withColumn("v", sections.heading_versions(F.coalesce("heading", F.lit("")), F.col("path"), known)).orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.heading, r.path, r.text.strip(), r.v) for r in rows] == [
        (1, None, [], "intro", None),
        (1, "Fixes", ["3.0.0"], "fix one", ["3.0.0"]),
        (1, "2.1.0", [], "note", ["2.1"]),
        (1, "Deep", ["2.1.0"], "deep text", ["2.1"]),
        (1, "1.0.0", [], "old", []),
        (4, None, [], "no heading", None),
    ]


HTML = """<html><head><title>T &amp; t</title></head><body><nav><p>menu</p></nav><article><p>lead<h1 id=a>One</h1><p>first<p>second <b>bold</b>
<h2><a name="x"></a>Two</h2><ul><li>item <p>inner</p></li></ul><script>var s = "</p>";</script><pre>code</pre><h2>Empty</h2></article><footer><p>foot</p></footer>"""


def test_html_sections(spark):
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "<p>only")], "page_id bigint, html string")
    rows = sections.html_sections(pages).orderBy("page_id", "section").collect()
    assert [(r.page_id, r.heading, r.anchor, r.path, r.text) for r in rows] == [
        (1, "T & t", None, [], "lead"),
        (1, "One", "a", [], "first\nsecond bold"),
        (1, "Two", "x", ["One"], "item inner\ncode"),
        (3, "", None, [], "only"),
    ]
    assert [r.address for r in rows] == ["", "#a", "#x", ""]
    xml = spark.createDataFrame([("<urlset><url><loc> https://a/b </loc></url></urlset>",), ("<!DOCTYPE x><loc>y</loc>",)], "x string")
    assert [r[0] for r in xml.select(sections.sitemap_links(F.col("x"))).collect()] == [["https://a/b"], None]


def test_main_part_of_pages(spark):
    """Pages with and without a main part, frames in odd places, bare text, and addresses that are relative, odd or none."""
    url = "https://orbit.org/releases/2.0/?x=1#top"
    pages = [
        '<base href="/docs/2/"><title>Release</title><main><div id="migration"><div><h2>Upgrade</h2></div><p>Read <a href="upgrading.html">this</a>.</p></div></main>',
        '<title>Orbit 2.0</title><nav>NOISE</nav><main><h1>Orbit 2.0</h1><h2 id="migration">Migration</h2><p>Remove the deprecated option.</p><a href="/docs/2/api/">API documentation</a><a href="/release/0.1/">Release 0.1</a></main>',
        '<p>banner</p><div class="wide chapter"><h3>A</h3><table><tr><td><p>cell</p><td>two</table></div><p>box</p><article>late</article>',
        "<title> bare  title </title><body>bare <b>text</b><script>x()</script>, &lt;here&gt;</body>",
        "bare text alone",
        '<div role="main"><header><h1>gone</h1></header><h2><a name="n1"></a>Two<h4>Four</h4><ol><li>a<ul><li>b</ul><li>c</ol><h3>Three</h3><pre>x\n  y</pre></div>',
        '<main><p>a<!-- c -->b<a href="http://[bad">odd</a><a>none</a><a href=" next ">n</a></main>',
        "", None, "<nav><a href=/u>Migrating</a><nav><a href=/c>changelog</a></nav></nav><p>x</p></p></div>", "<p>" * 3000 + "deep" + "<div>" * 3000 + "er",
    ]
    frame = spark.createDataFrame([(f"k{n}", p, url) for n, p in enumerate(pages)], "k string, h string, u string")
    found = sections.html_sections(frame, "k", "h", "u").collect()
    here = "https://orbit.org/releases/2.0/?x=1"
    assert [(int(r.k[1:]), r.heading, r.anchor, r.path, r.text, r.address) for r in found] == [
        (0, "Upgrade", "migration", [], "Read this .", f"{here}#migration"),
        (1, "Migration", "migration", ["Orbit 2.0"], "Remove the deprecated option.", f"{here}#migration"),
        (2, "A", None, [], "cell two", here),
        (3, "bare title", None, [], "bare text , <here>", here),
        (4, url, None, [], "bare text alone", here),
        (5, "Four", "n1", ["Two"], "a b\nc", f"{here}#n1") if False else (5, "Four", None, ["Two"], "a b\nc", here),
        (5, "Three", None, ["Two"], "x\n  y", here),
        (6, url, None, [], "a b odd none n", here),
        (9, url, None, [], "x", here),
        (10, url, None, [], "deep", here),
    ]
    links = sections.html_links(frame, "k", "h", "u").collect()
    assert [(int(r.k[1:]), r.place, r.kind, r.address, r.label) for r in links] == [
        (0, 0, "link", "https://orbit.org/docs/2/upgrading.html", "this"),
        (1, 0, "link", "https://orbit.org/docs/2/api/", "API documentation"),
        (1, 1, "link", "https://orbit.org/release/0.1/", "Release 0.1"),
        (6, 0, "link", "http://[bad", "odd"),
        (6, 1, "link", "https://orbit.org/releases/2.0/next", "n"),
        (9, 0, "navigation", "https://orbit.org/u", "Migrating"),
        (9, 1, "navigation", "https://orbit.org/c", "changelog"),
    ]
    raw = spark.createDataFrame([("<a href='/x'>1</a><A id=b HREF=/y>2</A><a data-href=no href = \"/z w\">3</a><abbr href=q>",)], "html string").withColumn("page_id", F.lit(1))
    assert [r.href for r in sections.links(raw).orderBy("place").collect()] == ["/x", "/y", "/z w"]


def test_nominated(spark):
    rows = [(" ", "release_notes", None), ("text", "release_notes", None), ("text", "blog_post", None), ("deprecated", "blog_post", ["1.0"]), ("deprecated", "blog_post", [])]
    frame = spark.createDataFrame(rows, "text string, kind string, versions array<string>").withColumn("doc_versions", F.array(F.lit("9")))
    topics = F.when(F.col("text").contains("deprecated"), F.array(F.lit("deprecation"))).otherwise(F.array().cast("array<string>"))
    found = {(r.kind, r.version_scope, tuple(r.versions), tuple(r.topics)) for r in candidates.nominated(frame, topics).collect()}
    assert found == {("release_notes", "document_association", ("9",), ("unclassified_change",)), ("blog_post", "version_heading", ("1.0",), ("deprecation",))}


def test_dedup_does_not_depend_on_row_order(spark):
    long = "The same passage, forty characters or more of it."
    rows = [(1, 2, long), (2, 1, long.upper().replace(",", " --")), (3, 3, long + "!"), (4, 0, "short"), (5, 9, "short"), (6, 1, None)]
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "id int, rank int, text string")
        results.append({(r.id, r.duplicate_of) for r in candidates.with_duplicates(frame, "id", "rank").collect()})
    assert results[0] == results[1] == results[2] == {(1, 2), (2, None), (3, 2), (4, None), (5, None), (6, None)}


def test_budget_is_conserved_and_inherited(spark):
    rows = [(k, None if k % 4 else max(0, k - 4), float(k % 5) if k % 3 else None) for k in range(1, 40)]
    rows = [(k, None if d in (None, 0) else 1, s) for k, d, s in rows]
    frame = relevance.assessed(relevance.budgeted(spark.createDataFrame(rows, "id int, duplicate_of int, score double"), 7, "id"))
    found = frame.collect()
    own = [r for r in found if r.duplicate_of is None]
    h = relevance.histogram(frame).first()
    assert h.scored + h.failed + h.not_scored == len(own) and h.scored + h.failed == 7
    inherited = {r.id: r for r in relevance.inherited(frame, "id").collect()}
    assert all(inherited[r.id].status == inherited[1].status for r in found if r.duplicate_of == 1)
    two = relevance.assessed(relevance.budgeted(spark.createDataFrame([(1, None, None), (2, None, 3.0), (3, 1, 2.0)], "id int, duplicate_of int, score double"), 1, "id"))
    assert {r.id: r.status for r in relevance.inherited(two, "id").collect()} == {1: "failed", 2: "not_scored", 3: "failed"}


def test_selection_order_and_packing(spark):
    rows = [("a", 1, None, "failed", None, None), ("b", 1, None, "scored", "risk_candidate", 3.0), ("c", 1, None, "scored", "context", 2.0), ("d", 1, None, "scored", "not_relevant", 0.0), ("e", 1, "b", "scored", "risk_candidate", 3.0)]
    frame = spark.createDataFrame(rows, "candidate_id string, source_rank int, duplicate_of string, status string, label string, score double")
    found = {r.candidate_id: (r.excluded, r.place, r.chosen) for r in selection.selected(frame, 2).collect()}
    assert found == {"b": (None, 1, True), "c": (None, 2, True), "a": (None, 3, False), "d": ("not_relevant", None, False), "e": ("duplicate", None, False)}
    items = [("s", f"k#s{n}", size) for n, size in enumerate([10, 20, 5970, 1, 1, 1, 1, 1, 1, 1, 1, 1])]
    batches = {r.key: r.batch for r in selection.batches(spark.createDataFrame(items, "source string, key string, size int"), "source", "key", "size").collect()}
    order, size, count, batch, expected = sorted(items, key=lambda x: x[1]), 0, 0, 0, {}
    for _, key, own in order:
        if count and (size + own > 6000 or count >= 8):
            batch, size, count = batch + 1, 0, 0
        size, count, expected[key] = size + own, count + 1, batch
    assert batches == expected


def test_unique_slugs(spark):
    rows = [(1, 0, "x"), (1, 1, "x"), (1, 2, "x_2"), (1, 3, "x"), (1, 4, "x_2"), (2, 0, "x")]
    found = {(r.path, r.n): r.slug for r in selection.unique_slugs(spark.createDataFrame(rows, "path int, n int, base string"), "path", "n", "base").collect()}
    used, expected = {}, {}
    for path, n, base in rows:
        own, name, k = used.setdefault(path, set()), base, 2
        while name in own:
            name, k = f"{base}_{k}", k + 1
        own.add(name)
        expected[path, n] = name
    assert found == expected


def test_grounding(spark):
    docs = spark.createDataFrame([(1, "Some *text* with a quoted passage of several words inside."), (2, "nothing"), (3, None), (4, "prefixquoted passage of several words inside more")], "doc_id int, text string")
    quotes = spark.createDataFrame([(1, "a  quoted `passage` of several words"), (2, "text with"), (3, "invented passage of several words"), (4, None), (5, "quoted passage of several words inside")], "item_id int, text string")
    found = facts.grounded_pairs(quotes, docs, "item_id", "text", "doc_id", "text")
    assert sorted((r.item_id, r.doc_id) for r in found.collect()) == [(1, 1), (2, 1), (5, 1), (5, 4)]


def test_acceptance(spark):
    rows = [("good quote", ["1.0"], "version_heading"), ("invented", ["1.0"], "version_heading"), ("good", ["9.0"], "version_heading"), ("good", ["9.0"], "document_association"), ("quote", [], "version_heading")]
    frame = spark.createDataFrame(rows, "quote string, versions array<string>, version_scope string").withColumns({"section_text": F.lit("# a good   quote here"), "section_versions": F.array(F.lit("1.0"), F.lit("2.0"))})
    found = [(r.reason, r.versions) for r in facts.acceptance(frame).collect()]
    assert found == [(None, ["1.0"]), ("quote_not_in_section", ["1.0"]), ("versions_contradict_heading", ["9.0"]), (None, ["9.0"]), (None, ["1.0", "2.0"])]
    docs = spark.createDataFrame([(1, "t", None), (2, None, 1)], "id int, text string, duplicate_content_of int")
    assert {r.id: r.text for r in facts.original_texts(docs, "id", "text").collect()} == {1: "t", 2: "t"}


def test_clusters_and_partition(spark):
    rows = [(1, "render", "removed"), (2, "render()", "renamed"), (3, "ReactDOM.render", "removed"), (4, "hydrate", "removed"), (5, "Hydrate", "removed"), (6, "??", "removed")]
    found = facts.clusters(spark.createDataFrame(rows, "fact int, subject string, change string"), "subject", "fact", "change")
    assert [(r.cluster, r.label, r.changes, r.n_facts) for r in found.orderBy("cluster").collect()] == [(1, "render", ["removed", "renamed"], 2), (2, "ReactDOM.render", ["removed"], 1), (3, "hydrate", ["removed"], 2), (4, "??", ["removed"], 1)]
    claimed = spark.createDataFrame([(1, 7), (2, 7), (1, 8), (3, 8)], "cluster bigint, grp int")
    parts = {r.cluster: (r.grp, r.method) for r in facts.partitioned(claimed, found, "cluster", "grp").collect()}
    assert parts == {1: (7, "grouped"), 2: (7, "grouped"), 3: (8, "grouped"), 4: (None, "unassigned")}


FACT = "fact string, subject string, source string, change string, is_risk boolean, value string, versions array<string>, scoped boolean, tier string, latest int"


def test_conflicts(spark):
    rows = [
        ("f1", "s", "A", "deprecated", True, None, ["1"], True, "official", 1), ("f2", "s", "B", "removed", True, None, ["1"], True, "third_party", 1),
        ("f3", "t", "A", "renamed", True, "x", ["1"], True, "official", 1), ("f4", "t", "B", "renamed", True, "y", ["1"], True, "official", 1), ("f5", "t", "B", "renamed", True, "`X`", ["1"], False, "official", 1),
        ("f6", "u", "A", "renamed", True, None, ["1"], True, "official", 1), ("f7", "u", "B", "renamed", True, None, ["2"], True, "official", 2),
        ("f8", "u", "A", "renamed", True, None, ["3"], True, "official", 3), ("f9", "v", "A", "renamed", True, None, ["1"], False, "official", 1), ("g1", "v", "B", "renamed", False, None, ["1"], False, "official", 1),
    ]
    frame = spark.createDataFrame(rows, FACT)
    pairs = conflicts.pairs(frame)
    assert {(r.kind, r.a, r.b) for r in pairs.collect()} == {("severity", "f1", "f2"), ("value", "f3", "f4"), ("versions", "f6", "f7"), ("versions", "f7", "f8"), ("risk_vs_context", "f9", "g1")}
    members = conflicts.members(frame)
    assert {tuple(r) for r in members.collect()} == {(r.subject, r.kind, f) for r in pairs.collect() for f in (r.a, r.b)}
    out = {(r.subject, r.kind): (r.n_claims, r.resolution, r.winner) for r in conflicts.resolved(members, frame).collect()}
    assert out == {("s", "severity"): (2, "resolved", "f1"), ("t", "value"): (2, "unresolved", None), ("u", "versions"): (3, "resolved", "f8"), ("v", "risk_vs_context"): (2, "unresolved", None)}
    cited = spark.createDataFrame([("c1", "f1"), ("c2", "f2"), ("c2", "f3"), ("c3", "f5")], "condition string, fact string")
    touched = {r.condition: (r.touching, r.lost, r.unresolved) for r in conflicts.touching(cited, members, conflicts.resolved(members, frame)).collect()}
    assert touched == {"c1": (1, 0, 0), "c2": (2, 1, 1)}


CONDITION = "path int, condition int, cited int, grounded int, n_speculative int, n_implied int, best_rank int, sources array<int>, touching int, lost int, unresolved int, verdict string, role string, unsupported double"


def test_rubric_downgrade_and_idempotence(spark):
    base = (1, 1, 0, 0, 0, [1], 0, 0, 0, "supports", "required", 0.0)
    rows = [
        (1, 1, 1, 1, 0, 0, 0, [1], 0, 0, 0, "supports", "required", 0.0), (1, 2, 1, 1, 0, 1, 0, [1], 0, 0, 0, "supports", "required", None), (2, 1, 1, 1, 0, 0, 0, [1], 0, 0, 0, "not_checked", "required", 0.0),
        (3, 1, 1, 0, 0, 0, 0, [], 0, 0, 0, "supports", "required", 0.0), (4, 1, 1, 1, 0, 0, None, [1, 2], 0, 0, 0, "supports", "optional", 0.0), (5, 1, 1, 1, 0, 0, 0, [1], 1, 0, 0, "supports", "required", 0.0),
        (6, 1, 1, 1, 0, 0, 0, [1], 1, 1, 0, "supports", "required", 0.0),
    ]
    assert len(base) == 12
    frame = spark.createDataFrame(rows, CONDITION)
    graded = confidence.graded(frame)
    assert {(r.path, r.condition): (r.confidence, r.low_reasons + r.missing) for r in graded.collect()} == {
        (1, 1): ("high", []), (1, 2): ("medium", ["implied"]), (2, 1): ("medium", ["not_judged"]), (3, 1): ("low", ["not_grounded"]),
        (4, 1): ("low", ["no_verified_source"]), (5, 1): ("medium", ["won_conflict"]), (6, 1): ("low", ["lost_conflict"]),
    }
    paths = {r.path: r.confidence for r in confidence.path_confidence(graded).collect()}
    assert paths == {1: "medium", 2: "medium", 3: "low", 4: "low", 5: "medium", 6: "low"}
    once = confidence.downgraded(frame)
    again = confidence.downgraded(confidence.restored(once))
    assert sorted(map(str, once.select(sorted(once.columns)).collect())) == sorted(map(str, again.select(sorted(again.columns)).collect()))
    assert {r.path for r in once.collect() if r.role == "uncertain"} == {3}


def test_buckets_overall_and_questions(spark):
    rows = [(1, "high", True, False), (2, "high", False, False), (3, "low", False, False), (4, "medium", False, True)]
    frame = spark.createDataFrame(rows, "path int, confidence string, ungrounded_condition boolean, judge_disputed_condition boolean")
    assert {r.path: r.b for r in frame.withColumn("b", summary.bucket()).collect()} == {1: "low", 2: "high", 3: "low", 4: "low"}
    level = lambda judged, opened, names: summary.overall(spark.createDataFrame([(n, opened) for n in names], "confidence string, o boolean"), judged, False, F.col("o")).first().overall
    assert level(True, False, ["high"] * 3 + ["medium"] * 2) == "high" and level(False, False, ["high"] * 5) == "medium"
    assert level(True, True, ["high"] * 5) == "medium" and level(True, False, ["low"] * 3 + ["high"] * 2) == "low" and level(True, False, []) == "low"
    severe = spark.createDataFrame([(k, f"n{k}", "critical" if k % 2 else "low", 1) for k in range(9)], "path int, name string, level string, n_sources int")
    assert summary.single_source_question(severe).first().question == "4 severe risks have one source only: 'n1'; 'n3'; 'n5' and 1 more"


def test_gold_checks_pass_vacuously_where_nothing_matches(spark):
    checks = spark.createDataFrame([("a", "not_asserted", "d", "x", None, 0, None, None), ("b", "contextual", "d", "x", None, 0, None, None)], "check string, type string, distinction string, match string, matches array<string>, min_distinct int, risk_types array<string>, step string")
    paths = spark.createDataFrame([(1, "other", "t", "high", "", False, False, False, True)], "path int, text string, risk_type string, level string, steps string, known_issue boolean, required_version boolean, required_other boolean, firm boolean")
    contexts = spark.createDataFrame([("none", False)], "text string, known_issue boolean")
    found = evaluation.evaluated(checks, paths, contexts)
    assert {r.check: r.passed for r in found.collect()} == {"a": True, "b": False}
    assert evaluation.scores(found).first().score == "1/2"


@pytest.mark.parametrize("block", [60, 1_000_000])
def test_quotes_of_any_length_are_grounded_exactly(spark, block):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("ab", k=rng.randint(1, 4)))
    docs = [(f"d{n}", " ".join(word() for _ in range(rng.choice([0, 1, 3, 12])))) for n in range(60)] + [("none", None)]
    most = 60 if block < 100 else 1500
    quotes = [(n, " ".join(word() for _ in range(1 + n % 7))) for n in range(most)] + [(9000, " "), (9001, None), (9002, docs[7][1]), (9003, "a"), (9004, "a"), (9005, "é😀")]
    docs.append(("odd", "x é😀 y"))
    frame = spark.createDataFrame(docs, "d string, body string").repartition(3)
    found = facts.grounded_pairs(spark.createDataFrame(quotes, "q int, quote string"), frame, "q", "quote", "d", "body", block)
    assert found.dtypes == [("q", "int"), ("d", "string")]
    expected = sorted((q, d) for q, quote in quotes for d, body in docs if (quote or "").strip() and quote in (body or ""))
    assert sorted((r.q, r.d) for r in found.collect()) == expected and len(expected) > 100
    none = facts.grounded_pairs(spark.createDataFrame([], "q int, quote string"), frame, "q", "quote", "d", "body")
    assert none.columns == ["q", "d"] and none.collect() == []


def test_no_text_is_shuffled_to_ground_quotes(spark):
    quotes = spark.createDataFrame([(1, "b c")], "q int, quote string")
    frame = spark.createDataFrame([(1, "a b c d")], "d int, body string")
    plan = facts.grounded_pairs(quotes, frame, "q", "quote", "d", "body")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_numbers_and_budgets_over_ranges(spark):
    rows = [(k * 7 % 101, k % 3, k % 5 == 0) for k in range(101)]
    frame = spark.createDataFrame(rows, "n int, g int, marked boolean").repartition(5)
    assert {r.n: r.place for r in numbering.numbered(frame, "place", "n").collect()} == {n: n + 1 for n in range(101)}
    for most in (0, 1, 7, 500):
        assert {r.n for r in numbering.within(frame, most, ["n"]).filter("within").collect()} == set(range(min(most, 101)))
        got = {(r.g, r.n) for r in numbering.within(frame, most, ["n"], ["g"], F.col("marked")).filter("within").collect()}
        assert got == {(g, n) for g in range(3) for n in sorted(n for n, h, m in rows if h == g and m)[:most]}


def plain_crawl(links, seeds, b, closed=()):
    """The crawl by a heap: one page at a time, its links admitted before the next, budgets counted as they are spent."""
    heap, nodes, proofs, spent, out = [], {}, set(), dict.fromkeys(("registry", "index", "document", "discussion"), 0), {}

    def admit(url, parent, priority, kind, depth):
        if url in nodes:
            proofs.add((parent, url))
            return
        if kind == "discussion" and sum(k == "discussion" for _, k, _ in nodes.values()) >= b.discussions:
            return
        if depth > b.depth or len(nodes) >= b.urls + (b.reserve if priority <= frontier.GUIDE else 0):
            return
        nodes[url] = (priority, kind, depth)
        proofs.add((parent, url))
        heapq.heappush(heap, (priority, len(nodes), url))

    for url, priority, position, kind in sorted(seeds, key=lambda s: (s[2], s[0])):
        admit(url, None, priority, kind, 0)
    requests = fetched = 0
    while heap and spent["document"] + spent["discussion"] < b.documents and requests < b.requests:
        _, sequence, url = heapq.heappop(heap)
        _, kind, depth = nodes[url]
        if kind == "registry" and spent["registry"] >= b.registry:
            out[url] = (sequence, "registry_budget", None)
            continue
        if url in closed:
            out[url] = (sequence, "disallowed", None)
            continue
        requests += 1
        if kind == "index" and spent["index"] >= b.index_pages:
            out[url] = (sequence, "index_budget", None)
            continue
        spent[kind] += 1
        fetched += 1
        out[url] = (sequence, "fetched", fetched)
        for _, dst, _, priority, kind in sorted((x for x in links if x[0] == url), key=lambda x: (x[2], x[1])):
            admit(dst, url, priority, kind, depth + 1)
    return out | {url: (sequence, "pending", None) for _, sequence, url in heap}, {(a, u) for a, u in proofs if a}


PATTERNS = {
    "render": ["render"], "React\\.render\\b": ["react.render"], "alpha|beta gamma": ["alpha", "beta gamma"], "colou?r": ["colo"], "a+b": ["a"], "x*": [], "[abc]def": ["def"], "(?:foo|bar)baz": ["baz"],
    "foo(bar)?": ["foo"], "\\d+": [], "alpha|\\d": [], "^old$": ["old"], "ab{2,3}c": ["a"], "(unclosed": [], "(?x) a b": [], "\\Qa.b\\E": [], "É|é": ["É", "é"], "v\\.next": ["v.next"], "no longer (?:works|runs)": ["no longer "], "": [],
}


def test_literals_that_patterns_require():
    assert {p: evaluation.required(p) for p in PATTERNS} == {p: sorted(x) for p, x in PATTERNS.items()}


@pytest.mark.parametrize("block", [20, 100_000])
def test_pattern_hits_against_a_cross_join(spark, block):
    rng = random.Random(block)
    words = ["render", "React.render", "ReactXrender", "ALPHA", "beta gamma", "color", "COLOUR", "aab", "b", "bdef", "xdef", "barbaz", "foo", "42", "old", "abbc", "abbbbc", "a.b", "É", "v.next", "vXnext", "no longer runs", "no longer"]
    rows = [(n, " ".join(rng.sample(words, rng.choice([0, 1, 2, 4])))) for n in range(120)] + [(900, None), (901, "old")]
    patterns = [p for p in PATTERNS if p != "(unclosed"]
    checks = spark.createDataFrame([*enumerate(patterns), (99, "render"), (100, None)], "check int, match string")
    frame = spark.createDataFrame(rows, "path int, text string").repartition(3)
    plain = frame.crossJoin(checks).filter("regexp_like(text, concat('(?i)', match))")
    found = evaluation.hits(checks, frame, block_chars=block)
    assert sorted(found.columns) == sorted(plain.columns)
    told = sorted((r.path, r.check) for r in found.collect())
    assert told == sorted((r.path, r.check) for r in plain.collect()) and len(told) > 400


@pytest.mark.parametrize("seed", range(3))
def test_members_are_the_facts_of_all_pairs(spark, seed):
    """A hot subject and small ones, with empty values, empty and shared versions, and facts of one source alone."""
    rng = random.Random(seed)
    rows = []
    for fact in range(400):
        subject = rng.choice(["hot"] * 6 + [f"s{k}" for k in range(60)])
        versions = sorted(rng.sample(["1", "2", "3", "4"], rng.choice([0, 1, 1, 2, 3])))
        rows.append((subject, fact, rng.choice("ABC" if subject == "hot" else "AB"), rng.choice(["removed", "deprecated", "replacement_recommended", "changed", "added"]), rng.random() < 0.8, rng.choice([None, "", "x", "X ", "y"]), versions, rng.random() < 0.6))
    frame = spark.createDataFrame(rows, "subject string, fact int, source string, change string, is_risk boolean, value string, versions array<string>, scoped boolean")
    expected = set()
    for r in conflicts.pairs(frame).collect():
        expected |= {(r.subject, r.kind, r.a), (r.subject, r.kind, r.b)}
    found = [tuple(r) for r in conflicts.members(frame).select("subject", "kind", "fact").collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    assert {k for _, k, _ in expected} == {"severity", "risk_vs_context", "value", "versions"}
    dealt = [tuple(r) for r in conflicts.members_where_dealt(frame.repartition(3, "subject")).select("subject", "kind", "fact").collect()]
    assert sorted(dealt) == sorted(found)
    assert conflicts.fit_in_tasks(frame) and not conflicts.fit_in_tasks(frame, 20)


def test_conflicts_are_told_without_meeting_facts_by_number(spark):
    """Members keep what a resolution needs, so no fact is shuffled by its number to be joined with itself."""
    rows = [(f"f{n}", f"s{n % 9}", "AB"[n % 2], "renamed", True, "xyz"[n % 3], [str(n % 4)], n % 3 > 0, "official", n % 4) for n in range(60)]
    frame = spark.createDataFrame(rows, FACT).repartition(3)
    kept = conflicts.members_where_dealt(frame.repartition(3, "subject"), ("tier", "scoped", "latest"))
    assert "hashpartitioning(fact" not in conflicts.resolved(kept)._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, conflicts.resolved(kept).collect()), key=str) == sorted(map(tuple, conflicts.resolved(conflicts.members(frame), frame).collect()), key=str)


def plain_batches(rows, most_chars, most_items):
    out, own = {}, object()
    for source, key, size in sorted(rows):
        size = size or 0
        if source != own:
            own, batch, items, chars = source, 0, 0, 0
        if items and (chars + size > most_chars or items >= most_items):
            batch, items, chars = batch + 1, 0, 0
        items, chars = items + 1, chars + size
        out[source, key] = batch
    return out


@pytest.mark.parametrize("most_chars,most_items", [(1500, 3), (6000, 8), (100_000, 40)])
def test_batches_of_a_hot_source_against_a_fold(spark, most_chars, most_items):
    """A source with most of the rows, in many ranges, some of which hold less than a batch."""
    rng = random.Random(most_chars)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3]), k, rng.choice([None, 0, 5, 300, 900, 1400, 7000])) for k in range(600)]
    frame = spark.createDataFrame(rows, "source int, key int, size int").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 40):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found = selection.batches(frame, "source", "key", "size", most_chars, most_items).collect()
            assert {(r.source, r.key): r.batch for r in found} == plain_batches(rows, most_chars, most_items) and len(found) == 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_places_within_hot_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", None]), k, rng.random()) for k in range(500)]
    frame = spark.createDataFrame(rows, "g string, k int, place double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for by in ([], ["g"]):
            found = {r.k: r.place for r in numbering.placed(frame, "place", by, [-F.col("place"), "k"]).collect()}
            expected = {k: 1 + sum(q > p for h, _, q in rows if not by or h == g) for g, k, p in rows}
            assert found == expected
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(6))
def test_crawl_against_a_heap(spark, seed, monkeypatch):
    rng = random.Random(seed)
    kinds = {f"p{k}": rng.choice(["document", "document", "registry", "index", "discussion"]) for k in range(60)}
    closed = {u for u in kinds if rng.random() < 0.1}
    pairs = {(rng.choice([*kinds]), u) for u in kinds for _ in range(4)}
    # The priority is the link's: a page may be left out under one and admitted under another.
    links = [(a, u, n, rng.choice([0, 1, 3, 7, 9]), kinds[u], u not in closed) for n, (a, u) in enumerate(sorted(pairs))]
    seeds = [(u, rng.choice([0, 3, 9]), n, kinds[u], u not in closed) for n, u in enumerate(["p1", "p2", "p3"])]
    b = frontier.Budgets(depth=rng.choice([1, 2, 4]), urls=rng.choice([10, 20, 100]), documents=rng.choice([4, 12, 100]), registry=rng.choice([1, 2]), index_pages=rng.choice([1, 3]), requests=rng.choice([8, 100]))
    rounds = []
    monkeypatch.setattr(frontier, "committed", lambda *x, f=frontier.committed: rounds.append(f(*x)) or rounds[-1])
    frame = spark.createDataFrame(links, "src string, dst string, position int, priority int, kind string, allowed boolean")
    found = frontier.crawl(frame, spark.createDataFrame(seeds, "url string, priority int, position int, kind string, allowed boolean"), b)
    expected, proofs = plain_crawl([x[:5] for x in links], [s[:4] for s in seeds], b, closed)
    assert {r.url: (r.sequence, r.status, r.fetched_at) for r in found.collect()} == expected
    taken = sum(status != "pending" for _, status, _ in expected.values())
    assert sum(rounds) == taken and (taken < 8 or len(rounds) < taken)
    missed = {r.url: r.reason for r in frontier.left_out(found, frame, b).collect()}
    fetched = {u for u, (_, status, _) in expected.items() if status == "fetched"}
    assert set(missed) == {d for s, d, *_ in links if s in fetched} - set(expected)
    assert {tuple(r) for r in frontier.with_provenance(found, frame).collect()} == proofs


def test_a_better_link_goes_first(spark):
    """Of two seeds the first names a page that is better than the second: with room for two documents it is fetched."""
    links = spark.createDataFrame([("A", "B", 0, 1)], "src string, dst string, position int, priority int")
    seeds = spark.createDataFrame([("A", 3), ("C", 3)], "url string, priority int")
    found = frontier.crawl(links, seeds, frontier.Budgets(documents=2))
    assert {r.url: (r.status, r.fetched_at) for r in found.collect()} == {"A": ("fetched", 1), "B": ("fetched", 2), "C": ("pending", None)}


@pytest.mark.parametrize("seed", range(3))
def test_best_first_against_a_queue(spark, seed):
    rng = random.Random(seed)
    edges = sorted({(f"p{rng.randrange(25)}", f"p{rng.randrange(25)}", rng.choice([1, 4, 5, 9])) for _ in range(90)})
    queue, seen = [(0, "p0")], []
    while queue and len(seen) < 12:
        queue.sort()
        _, url = queue.pop(0)
        if url not in seen:
            seen.append(url)
            queue += [(-r, dst) for src, dst, r in edges if src == url and dst not in seen]
    found = frontier.best_first(spark.createDataFrame(edges, "src string, dst string, relevance bigint"), "p0", 12)
    assert [r.url for r in found.orderBy("fetched_at").collect()] == seen and len(seen) > 5


def test_crowded_crawls(spark):
    """Fifty discussions do not keep a guide out of twenty addresses, nor ten documents out of six."""
    talks = [("root", f"issues/{k}", k, 9, "discussion") for k in range(50)]
    frame = lambda rows: spark.createDataFrame(rows, "src string, dst string, position int, priority int, kind string")
    seed = spark.createDataFrame([("root", 1)], "url string, priority int")
    found = {r.url: r for r in frontier.crawl(frame([*talks, ("root", "guide", 50, 1, "document")]), seed, frontier.Budgets(urls=20)).collect()}
    assert found["guide"].fetched_at == 2 and sum(r.kind == "discussion" for r in found.values()) == 4
    pages = [("root", f"doc/{k}", k, 3, "document") for k in range(10)]
    found = {r.url: r for r in frontier.crawl(frame([*pages, ("root", "guide", 50, 1, "document")]), seed, frontier.Budgets(urls=6)).collect()}
    assert len(found) == 7 and found["guide"].fetched_at == 2
    records = [("root", f"record/{k}", k, 1, "registry") for k in range(5)]
    found = frontier.crawl(frame(records), seed, frontier.Budgets(registry=2, documents=2)).collect()
    assert sorted(r.status for r in found) == ["fetched"] * 3 + ["registry_budget"] * 3


def test_propagated_versions(spark):
    documents = spark.createDataFrame([("a", "1.0", "text_mention"), ("b", "2.0", "text_mention")], "url string, version string, basis string")
    edges = spark.createDataFrame([("x", "a", ["1.0", "1.1"], "linked_context"), ("x", "z", ["9"], "linked_context"), ("y", "a", ["1.1"], "linked_context")], "src string, dst string, versions array<string>, relation string")
    found = frontier.propagated(documents, edges)
    assert {tuple(r) for r in found.collect()} == {("a", "1.0", "text_mention"), ("b", "2.0", "text_mention"), ("a", "1.0", "linked_context"), ("a", "1.1", "linked_context")} and found.count() == 4
    versions = spark.createDataFrame([("1.1",), ("2.0",), ("3.0",)], "version string")
    assert {tuple(r) for r in frontier.by_version(found, versions).collect()} == {("1.1", "a"), ("2.0", "b")}


def test_model_calls(spark):
    rows = [("a", "the keyword"), ("b", "plain"), ("c", "break it"), ("d", None)]
    frame = spark.createDataFrame(rows, "candidate_id string, text string")
    found = {r.candidate_id: (r.score, r.error) for r in decisions.decided(frame, lambda: decisions.keyword_backend("KEYWORD", "break")).collect()}
    assert found == {"a": (4.0, None), "b": (1.0, None), "c": (None, "refused"), "d": (1.0, None)}
    judged = decisions.judged(spark.createDataFrame([(k, "s") for k in range(5)], "n int, s string"), lambda: lambda batch: ["supports" for _ in batch], 3, "n")
    assert [r.verdict for r in judged.orderBy("n").collect()] == ["supports"] * 3 + ["not_checked"] * 2
    assert {r.verdict for r in decisions.judged(judged.drop("verdict"), None, 9, "n").collect()} == {"not_checked"}
    drafts = spark.createDataFrame([(1, "x", "a good quote"), (2, "x", "invented"), (3, "y", "a"), (4, "x", "The Title"), (5, "x", " ")], "claim int, source string, quote string")
    observed = spark.createDataFrame([("x", "The Title\nhas a  good *quote*", "The Title")], "source string, text string, heading string")
    assert {r.claim: r.reason for r in decisions.claims(drafts, observed).collect()} == {1: None, 2: "not_contiguous", 3: "source_not_observed", 4: "heading_only", 5: "empty_quote"}


@pytest.mark.parametrize("first,second,expected", [([("a", 1)], [("a", 2), ("b", 3)], {("a", 1), ("b", 3)}), ([], [("a", 2)], {("a", 2)})])
def test_fallback(spark, first, second, expected):
    frames = [spark.createDataFrame(rows, "k string, v int") for rows in (first, second)]
    assert {tuple(r) for r in releases.with_fallback(*frames, "k").collect()} == expected


def test_discovery(spark):
    links = [("https://h.org/", n, f"https://h.org/r{n}", "Release notes") for n in range(5)] + [("https://h.org/", 9, "https://h.org/x", "Releases 2"), ("https://h.org/", 8, "https://pypi.org/project/a", "a"), ("https://h.org/", 7, "https://y.org/releases", "releases")]
    found = discovery.followed(spark.createDataFrame(links, "page string, position int, href string, label string"))
    assert {(r.href, r.relation) for r in found.collect()} == {*((f"https://h.org/r{n}", "project_release_link") for n in range(3)), ("https://pypi.org/project/a", "package_link")}
    assert discovery.public(spark.createDataFrame([(1, "b", "m")], "url int, body string, metadata string")).columns == ["url"]


def test_generators_and_clients(spark):
    fields = {"subject": str, "n": int}
    answers = {"good": '{"items": [{"subject": "a", "n": 1}, {"subject": "b", "n": 9}]}', "extra": '{"items": [{"subject": "a", "n": 1, "x": 2}]}', "kind": '{"items": [{"subject": 3, "n": 1}]}', "none": "[]", "twice": '{"items": [], "items": []}'}
    rows = [(n, k) for n, k in enumerate([*answers, " "])]
    frame = spark.createDataFrame(rows, "batch int, body string")
    made = generation.generated(frame, "batch", "body", lambda: lambda request: answers[request["text"]], fields)
    found = made.collect()
    assert {(r.batch, r.subject, r.n) for r in found if r.error is None} == {(0, "a", 1), (0, "b", 9)} and {r.batch for r in found if r.error} == {1, 2, 3, 4, 5}
    kept = generation.only_known(made, spark.createDataFrame([(1,)], "n bigint"), "n").collect()
    assert {r.subject for r in kept if r.error is None} == {"a"} and sum(r.error is not None for r in kept) == 5
    for bad in ({"type": "x", "text": "a"}, {"type": "score", "text": " "}, {"type": "score", "text": "a", "n": [float("nan")]}):
        with pytest.raises(ValueError):
            generation.prepared(bad)
    for config, client in ((None, None), ({"url": "u"}, len)):
        with pytest.raises(ValueError):
            generation.opened(config, client)
    with pytest.raises(ValueError, match="did not answer"):
        generation.remote({"url": "http://127.0.0.1:9/", "key": "secret", "timeout": "1"}, attempts=2, wait=0)({"text": "a"})
    assert generation.action_schema({"fetch": ["s2", "s1"], "finish": []})["properties"]["target"]["enum"] == ["s1", "s2"]


def test_research_loop():
    def step(trace):
        return [{"action": "search", "target": "a"}, {"action": "fetch", "target": "bad"}, {"action": "finish", "target": ""}, {"action": "fetch", "target": "ok"}, {"action": "finish", "target": ""}][min(len(trace), 4)]

    def act(action, target):
        if target == "bad":
            raise ValueError("not found")
        return target

    trace = generation.research(step, act, 10, lambda t: any(x.get("result") == "ok" for x in t))
    assert [x["status"] for x in trace] == ["done", "failed", "not_covered", "done", "finished"]
    assert generation.research(lambda t: {"action": "search", "target": "a"}, act, 3, lambda t: False)[-1] == {"action": "finish", "status": "budget"}


def test_runs_and_their_manifest(spark, tmp_path):
    def broken(spark, results):
        raise ValueError("no answer")

    stages = [("first", lambda s, r: s.range(4)), ("side", broken), ("second", lambda s, r: r["first"].filter("id > 1")), ("third", broken), ("fourth", lambda s, r: s.range(1))]
    results, rows = manifest.run(spark, stages, str(tmp_path / "run"), optional=("side",))
    told = {r.stage: (r.status, r.rows, r.error) for r in rows.collect()}
    assert told == {"first": ("done", 4, None), "side": ("failed", None, "ValueError: no answer"), "second": ("done", 2, None), "third": ("failed", None, "ValueError: no answer"), "fourth": ("not_run", None, None)}
    assert set(results) == {"first", "second"}
    assert [manifest.tenths(d, t) for d, t in ((0, 9), (4, 9), (9, 9), (3, 0))] == [0, 4, 10, 10]


def test_identities_are_told_by_what_each_row_has_once(spark):
    """The same as pair by pair, and no pattern is matched over pairs."""
    told = [("u1", "https://a.org/x", "Own/R"), ("u2", "https://A.org:80/", "own/r"), ("u3", "https://a.org", ""), ("u4", "https://github.com/x", None), ("https://a.org/y", "", ""), ("u5", None, "o/s"), ("u6", "https://github.com/z", ""), (None, None, None)]
    rows = discovery.identified(spark.createDataFrame(told, "url string, homepage string, repository string"))
    met = rows.alias("a").crossJoin(rows.alias("b"))
    assert met.filter(~discovery.same_identified("a", "b").eqNullSafe(discovery.same_identity("a", "b"))).count() == 0
    assert "regexp" not in discovery.same_identified("a", "b")._jc.toString().lower()
