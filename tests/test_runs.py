import pytest
from pyspark.sql import functions as F

from claimloom import settings
from claimloom.functions import links
from claimloom.operators import resolution


def test_links(spark):
    rows = [
        ("https://d.orbit.dev/releases/3.0/", "notes"), ("https://d.orbit.dev/releases/9.0/", "notes"), ("https://d.orbit.dev/docs/en/", "Orbit 3.1 guide"),
        ("https://d.orbit.dev/2024/01/02", "news"), ("https://github.com/o/r/pull/7", "x"), ("https://d.orbit.dev/x", "Upgrading to 3.0"),
    ]
    frame = spark.createDataFrame(rows, "url string, label string").withColumn("keys", links.scope_keys(F.col("url"), F.col("label"), "orbit"))
    u, label, keys = F.col("url"), F.col("label"), F.col("keys")
    outside = [r[0] for r in frame.select(links.outside_scope(keys, "2", "3")).collect()]
    assert outside == [False, True, False, False, False, False]
    notes = links.notes_rank(u, label, keys, "2", "3", ["3"])
    assert [r[0] for r in frame.select(notes).collect()] == [0, None, None, None, None, None]
    order = links.priority(u, label, F.lit(True), notes, F.array().cast("array<string>"))
    assert [r[0] for r in frame.select(order).collect()] == [0, 3, 3, 3, 9, 1]
    sibling = spark.createDataFrame([("https://d/releases/v3.0.1/x?q",), ("https://d/other",)], "url string").select(links.milestone_siblings(F.col("url"), ["3", "3.1"]))
    assert [r[0] for r in sibling.collect()] == [["https://d/releases/3/x", "https://d/releases/3.0/x", "https://d/releases/3.1/x"], None]


def test_decisions_between_catalogs(spark):
    shape = "case int, match double, authority double, interval_count int, endpoints_found boolean, detailed boolean, complete boolean, identity string, url string"
    rows = [(1, 4.0, 4.0, 2, True, True, True, "a", "u1"), (1, 4.0, 3.9, 2, True, True, True, "b", "u2"), (1, 4.0, 4.0, 2, True, True, True, "a", "u0"), (2, 4.0, 4.0, 2, False, True, True, "a", "u1"), (2, 4.0, 3.0, 2, True, True, True, "b", "u2"), (3, 2.9, 4.0, 2, True, True, True, "a", "u"), (4, 4.0, 4.0, 0, True, True, True, "a", "u")]
    found = {r.case: (r.url, r.status) for r in resolution.decided(spark.createDataFrame(rows, shape), "case").collect()}
    assert found == {1: ("u0", "ambiguous"), 2: ("u1", "resolved")}


def test_headline(spark):
    rows = [(1, 1, "low", "n1"), (1, 2, "critical", "n2"), (1, 3, "high", "n3"), (1, 4, "critical", "n4"), (1, 5, "high", "n5"), (2, 6, "unknown", "n6")]
    found = {r.case: r.headline for r in resolution.headline(spark.createDataFrame(rows, "case int, path int, level string, name string"), "case").collect()}
    assert found == {1: "5 risk paths (2 critical, 2 high, 1 low). Most severe: n2; n4; n3.", 2: "1 risk paths (1 unknown)."}


def test_strict_json_and_schemas():
    assert settings.strict_json('{"a": [1, 2.5, null]}') == {"a": [1, 2.5, None]}
    for bad in ('{"a": 1, "a": 2}', '{"a": NaN}', "[Infinity]", "{"):
        with pytest.raises(ValueError):
            settings.strict_json(bad)
    schema = {"type": "object", "properties": {"id": {"type": "string"}, "more": {"type": "array", "items": {"type": "object", "properties": {"id": {"type": "string"}}}}}}
    closed = settings.closed_schema(schema)
    assert closed["required"] == ["id", "more"] and closed["properties"]["more"]["items"]["additionalProperties"] is False
    narrowed = settings.with_choices(closed, "id", ["x", "y"])
    assert narrowed["properties"]["id"]["enum"] == ["x", "y"] == narrowed["properties"]["more"]["items"]["properties"]["id"]["enum"]
    with pytest.raises(ValueError):
        settings.closed_schema({"$ref": "https://elsewhere"})


def test_model_settings():
    found = settings.resolved("facts", {"facts_model": "m1", "model": "m0", "url": None}, {"CLAIMLOOM_URL": "https://a", "CLAIMLOOM_FACTS_BACKEND": "b"}, {"backend": "z"})
    assert found == {"model": "m1", "url": "https://a", "backend": "b"}
    opened = []
    registry = settings.Registry(lambda s: opened.append(s) or len(opened))
    assert registry.get({"a": "1"}) == registry.get({"a": "1"}) == 1 and registry.get({"a": "2"}) == 2
    assert "secret" not in repr(settings.Transport("https://x", "secret")) and settings.Transport("https://x", retries=3).waits(5.0) == [5.0, 5.0, 5.0]
    for bad in ({"url": "http://x"}, {"url": "https://x", "timeout": 0}, {"url": "https://x", "retries": 99}):
        with pytest.raises(ValueError):
            settings.Transport(**bad)


def test_contract(spark):
    from claimloom.operators import contract

    shape = "fact string, subject string, change string, source string, source_type string, quote string, explanation string, candidate string, url string, tier string, versions array<string>, certainty string"
    row = ("f1", "render", "context", "s", "t", "q", "why", "c", "u", "official", ["1"], "explicit")
    entry = contract.context_entries(spark.createDataFrame([row], shape)).first()
    assert entry.statement == "render: why" and entry.evidence.quote_or_summary == "q" and entry.why_not_a_risk == "Extracted as context."
    state = spark.createDataFrame([(["a" * 2000, "b", "c", "d"],)], "q array<string>").select(contract.judge_state(F.col("q"))).first()[0]
    assert [len(x) for x in state] == [1200, 1, 1]
    counts = spark.createDataFrame([(0, 2, 0), (0, 0, 0)], "a int, b int, c int").select(contract.diagnostics(False, F.col("a"), F.col("b"), F.col("c")).alias("d")).collect()
    assert [len(r.d) for r in counts] == [2, 1] and counts[0].d[1] == "2 calls of the judge failed."
    small = spark.createDataFrame([("abcdef", [1, 2, 3])], "t string, l array<int>").select(contract.compact({"t": 3}, {"l": 2}).alias("x")).first().x
    assert (small.t, small.l) == ("abc", [1, 2])
    hints = spark.createDataFrame([("scored", "context", "x"), ("failed", None, None)], "status string, label string, risk_type string").select(contract.relevance_hint().alias("h")).collect()
    assert hints[0].h.label == "context" and hints[1].h is None
    assert contract.upstream_questions(spark.createDataFrame([("1.0",)], "version string"), "orbit").first()[0].startswith("Nothing was collected for orbit 1.0")
