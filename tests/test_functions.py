import pytest
from pyspark.sql import functions as F

from claimloom.functions import rubrics, text, urls, versions


def values(spark, rows, column, schema="x string"):
    frame = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in frame.select(column).collect()]


def test_version_keys(spark):
    keys = values(spark, ["1.10.0", "1.9.0", "1.1", "1.1.0", "nightly", "1.2.3.4.5", "2.0b1", "", "99999999999999999999"], versions.version_key(F.col("x")))
    assert keys[0] > keys[1] and keys[2] == keys[3] == [1, 1, 0, 0]
    assert keys[4:] == [None] * 5


def test_tags(spark):
    labels = ["v1.2.3", "REL_16_0", "release-2.1", "orbit@2.0.0", "refs/tags/v3.1", "v2.0.0-rc.1", "2025-01-01", "comet@1.0"]
    found = values(spark, labels, versions.numeric_label(F.col("x"), ["orbit"]))
    assert found == ["1.2.3", "16.0", "2.1", "2.0.0", "3.1", None, None, None]


def test_intervals(spark):
    labels = ["3.2.99", "4.0.0", "4.2", "4.2.9", "4.3.0", "3.2.1", "3.2.0", "4.2.0"]
    family = values(spark, labels, versions.in_interval(versions.version_key(F.col("x")), "3.2", "4.2"))
    assert dict(zip(labels, family)) == {"3.2.99": False, "4.0.0": True, "4.2": True, "4.2.9": True, "4.3.0": False, "3.2.1": False, "3.2.0": False, "4.2.0": True}
    exact = values(spark, labels, versions.in_interval(versions.version_key(F.col("x")), "3.2.0", "4.2.0", "exact"))
    assert [x for x, y in zip(labels, exact) if y] == ["3.2.99", "4.0.0", "4.2", "3.2.1", "4.2.0"]
    scope = values(spark, ["3.1.9", "3.2.0", "4.2.9"], versions.in_scope(versions.version_key(F.col("x")), "3.2", "4.2"))
    assert scope == [False, True, True]
    for bad in (("4", "3", "family"), ("3.2", "4", "family"), ("3", "3.1", "exact-ish"), ("a", "4", "exact"), ("3", "3", "family")):
        with pytest.raises(ValueError):
            versions.check_interval(*bad)


def test_version_tokens_and_names(spark):
    found = values(spark, ["v1.2.3 and 10.0.", "x1.2", "1.2..3 a 3", "é1.0 (2.5)", "1.2.3.4"], versions.version_tokens(F.col("x")))
    assert found == [["1.2.3", "10.0"], [], [], ["2.5"], ["1.2.3.4"]]
    rows = [("see 18.0 notes", "18.0.0"), ("see 18 notes", "18.0.0"), ("see v18.0.0.", "18.0.0"), ("see 18.0.1", "18.0.0"), ("x18.0", "18.0.0"), ("18.1", "18.1"), ("18", "18.1")]
    named = values(spark, rows, versions.names_version(F.col("t"), F.col("v")), "t string, v string")
    assert named == [True, True, True, False, False, True, False]
    mile = values(spark, [("Upgrading: Version 14", "/x"), ("", "/blog/next-13"), ("", "/blog/next-13-4"), ("14.2", "/")], versions.milestone_named(F.col("t"), F.col("p"), ["13", "14"]), "t string, p string")
    assert mile == [["14"], ["13"], [], []]


def test_texts(spark):
    assert values(spark, ["# A  *b*\n`c`", "  "], text.loose(F.col("x"))) == ["A b c", ""]
    assert values(spark, ["Café -- École_1!", None], text.fingerprint(F.col("x"))) == ["café école 1", None]
    assert values(spark, ["React.render()", "ReactDOM.Render"], text.subject_key(F.col("x"))) == ["react.render", "reactdom.render"]
    assert values(spark, ["Hello, World!", "***", "a" * 70], text.slug(F.col("x"))) == ["hello_world", "item", "a" * 60]
    assert values(spark, ["see https://a.b/c. and (http://d.e)", ""], text.urls(F.col("x"))) == [["https://a.b/c", "http://d.e"], []]
    assert values(spark, ["fixes #12, x#3 and &#4; #5"], text.issue_references(F.col("x"))) == [[12, 5]]
    assert values(spark, [("abcdef", "xx abcd yy"), ("abc", "abc"), ("q", "abc")], text.divergence(F.col("q"), F.col("t")), "q string, t string") == [4, 3, 0]


def test_topics(spark):
    cases = {
        "This is a BREAKING change": "breaking_change", "foo() is deprecated": "deprecation", "bar was removed": "removal", "it defaults to on": "changed_default",
        "now throws an error": "behavior_change", "requires Python 3.10": "runtime_requirement", "peer dependency": "dependency_requirement", "a new setting": "configuration_change",
        "migrate your code": "migration_step", "run pg_upgrade": "data_migration", "a new API": "api_change", "known issue": "known_issue", "CVE-2024-1": "security",
    }
    found = values(spark, list(cases), text.topics(F.col("x")))
    for (sentence, topic), names in zip(cases.items(), found):
        assert topic in names, sentence
    assert values(spark, ["nothing to see"], text.topics(F.col("x"))) == [[]]


def test_urls(spark):
    given = ["https://User@Docs.Example.org:8080/a/b?q#f", "https://x.github.io/y", "ftp://h", "nonsense", "https://localhost/x"]
    assert values(spark, given, urls.host(F.col("x"))) == ["docs.example.org", "x.github.io", "h", "", "localhost"]
    assert values(spark, given, urls.site(urls.host(F.col("x")))) == ["example.org", "x.github.io", "h", "", "localhost"]
    repos = ["https://github.com/Org/Name.git", "https://raw.githubusercontent.com/a/b/main/x", "https://api.github.com/repos/A/b/issues", "https://github.com/only", "https://x.org/a/b"]
    assert values(spark, repos, urls.repository(F.col("x"))) == ["org/name", "a/b", "a/b", None, None]
    projects = ["git+https://github.com/A/b.git", "git@github.com:a/b.git", "https://github.com/topics/x", "https://gitlab.com/a/b"]
    assert values(spark, projects, urls.project_repository(F.col("x"))) == ["A/b", "a/b", "", ""]
    kinds = [("https://x/migrating", ""), ("https://x/a", "Deprecations"), ("https://x/releases/1", ""), ("https://x/blog/a", "x"), ("https://x/docs/a", ""), ("https://x/a", "b")]
    found = values(spark, kinds, urls.document_kind(F.col("u"), F.col("t")), "u string, t string")
    assert found == ["upgrade_guide", "deprecation_notice", "release_notes", "blog_post", "api_documentation", "supporting_document"]
    public = ["https://a.org/x", "http://10.0.0.1/", "https://u:p@a.org/", "https://a.org:8443/", "https://a.org:443/", "file:///etc", "http://172.20.1.1/", "http://x.local/"]
    assert values(spark, public, urls.public(F.col("x"))) == [True, False, False, False, True, False, False, False]
    assert values(spark, ["https://a/b.PDF", "https://a/b.html"], urls.binary(F.col("x"))) == [True, False]
    assert values(spark, ["https://github.com/a/b/issues/5", "https://github.com/a/b/releases/tag/v1"], urls.api_address(F.col("x"))) == ["https://api.github.com/repos/a/b/issues/5", "https://api.github.com/repos/a/b/releases/tags/v1"]


def test_trust_tiers(spark):
    rows = [
        ("https://docs.orbit.dev/x", "release_notes", None, "official"), ("https://github.com/Orbit/orbit/x", "release_notes", None, "official"),
        ("https://github.com/fork/orbit", "release_notes", None, "probable_official"), ("https://github.com/orbit/orbit/pull/1", "github_pull_request", None, "official_repository_discussion"),
        ("https://blog.net/x", "blog_post", None, "third_party"), ("https://blog.net/y", "blog_post", "selected_project_site", "official"), ("https://any.net/z", "registry_metadata", None, "official"),
    ]
    tier = urls.trust_tier(F.col("u"), F.col("k"), F.lit("https://cat"), F.array(F.lit("orbit.dev")), F.array(F.lit("orbit/orbit")), F.col("r"))
    assert values(spark, [r[:3] for r in rows], tier, "u string, k string, r string") == [r[3] for r in rows]


def test_severity_and_confidence(spark):
    t, f = F.lit(True), F.lit(False)
    cap = lambda *flags: rubrics.severity_cap(*flags)
    levels = ["critical", "high", "medium", "low", "unknown"]
    assert values(spark, levels, rubrics.capped(F.col("x"), cap(f, f, f, t))) == ["medium", "medium", "medium", "low", "unknown"]
    assert values(spark, levels, rubrics.capped(F.col("x"), cap(t, f, f, f))) == ["low", "low", "low", "low", "unknown"]
    assert values(spark, levels, rubrics.capped(F.col("x"), cap(f, f, f, f))) == levels
    assert values(spark, [(2.5,), (1.5,), (1.4,), (None,)], rubrics.relevance_label(F.col("s")), "s double") == ["risk_candidate", "context", "not_relevant", None]
    rows = [("required", ["explicit"], ["official"]), ("required", ["implied"], ["official"]), ("uncertain", ["explicit"], ["official"]), ("required", ["speculative"], ["official"]), ("required", ["explicit"], ["third_party"])]
    found = values(spark, rows, rubrics.preliminary_confidence(F.col("r"), F.col("c"), F.col("t")), "r string, c array<string>, t array<string>")
    assert found == ["high", "medium", "low", "low", "low"]


def test_decisions_are_validated(spark):
    good = {str(k): 0.2 for k in range(5)}
    rows = [(good, "0", 2.0), ({**good, "0": 0.5}, "0", 2.0), ({"0": 1.0}, "0", 0.0), (good, "0", 3.0), ({**good, "4": float("nan")}, "0", 2.0)]
    faults = rubrics.distribution_faults(F.col("p"), F.col("c"), F.col("s"), [str(k) for k in range(5)])
    found = values(spark, rows, faults, "p map<string,double>, c string, s double")
    assert found[0] == [] and found[1] == ["sum"] and found[2] == ["missing_name"] and found[3] == ["score"] and "not_a_probability" in found[4]
