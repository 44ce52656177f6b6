import base64
import datetime
import json

import pytest
from pyspark.sql import functions as F

from claimloom.sources import artifacts, catalogs, registry, reports, snapshots
from claimloom.streaming import ingest


def test_registry_catalogs(spark):
    pypi = {"releases": {"1.0": [{"upload_time_iso_8601": "2024-02-01", "yanked": True}, {"upload_time_iso_8601": "2024-01-01", "yanked": False}], "1.1": [], "1.2": [{"upload_time": "2024-03-01", "yanked": True}]}}
    frame = spark.createDataFrame([("c", json.dumps(pypi))], "catalog string, body string")
    assert {(r.version, r.published, r.yanked) for r in catalogs.pypi(frame).collect()} == {("1.0", "2024-01-01", False), ("1.2", "2024-03-01", True)}
    assert [r.version for r in catalogs.pypi_skipped(frame).collect()] == ["1.1"]
    npm = {"versions": {"1.0.0": {}, "2.0.0": {"x": 1}}, "time": {"1.0.0": "2023"}}
    found = catalogs.npm(spark.createDataFrame([("c", json.dumps(npm))], "catalog string, body string"))
    assert {(r.version, r.published) for r in found.collect()} == {("1.0.0", "2023"), ("2.0.0", None)}
    pages = [("c", 1, json.dumps([{"tag_name": "v1", "draft": False, "prerelease": False}, {"tag_name": "v2", "draft": True}])), ("c", 2, json.dumps([{"tag_name": "v3", "prerelease": True}])), ("d", 1, "not json")]
    rows, complete = catalogs.github(spark.createDataFrame(pages, "catalog string, page int, body string"))
    assert [r.version for r in rows.collect()] == ["v1"] and {r.catalog: r.complete for r in complete.collect()} == {"c": True, "d": False}
    links = spark.createDataFrame([("p", "v1.0"), ("p", "2.0"), ("p", "about"), ("q", "1.0")], "page string, label string")
    assert [(r.page, r.releases) for r in catalogs.inventories(links).collect()] == [("p", 2)]


def test_snapshots(spark):
    rows = [("u1", "html", 200, "body", True), ("u2", "html", 500, "body", True), ("u3", "html", 404, "gone", True), ("u4", "html", 200, "body", False), ("u5", "html", 200, "Please solve the CAPTCHA", True)]
    frame = spark.createDataFrame(rows, "url string, accept string, status int, body string, good boolean").withColumn("content_sha256", F.when(F.col("good"), F.sha2("body", 256)).otherwise("0"))
    assert {r.url for r in snapshots.sound(frame).collect()} == {"u1", "u3"}
    asked = spark.createDataFrame([("u1", "html"), ("u1", "json")], "url string, accept string")
    assert {(r.accept, r.cached) for r in snapshots.looked_up(asked, frame.withColumn("final_url", F.col("url"))).collect()} == {("html", True), ("json", False)}
    old = spark.createDataFrame([("u1", "h", 200, "old", "t1"), ("u2", "h", 200, "old", "t1")], "url string, accept string, status int, body string, retrieved_at string")
    new = spark.createDataFrame([("u1", "h", 304, None, "t2"), ("u3", "h", 200, "new", "t2")], old.schema)
    assert {tuple(r) for r in snapshots.refreshed(old, new).collect()} == {("u1", "h", 200, "old", "t2"), ("u2", "h", 200, "old", "t1"), ("u3", "h", 200, "new", "t2")}
    urls = spark.createDataFrame([("https://a/x",), ("https://a/private/y",), ("https://b/z",), ("https://c/z",)], "url string")
    policies = spark.createDataFrame([("https://a", "/private"), ("https://b", None)], "origin string, prefix string")
    assert {r.url for r in snapshots.allowed(urls, policies).collect()} == {"https://a/x", "https://c/z"}


def test_api_documents(spark):
    answers = [
        ("u1", {"tag_name": "v1", "name": "One", "body": "notes"}), ("u2", {"number": 5, "title": "Bug", "body": "text"}), ("u3", {"number": 6, "title": "PR", "body": None, "merged_at": "x"}),
        ("u4", {"encoding": "base64", "path": "README.md", "content": base64.b64encode("héllo".encode()).decode()}), ("u5", {"info": {"name": "pkg", "description": "d"}}), ("u6", {"other": 1}),
    ]
    frame = spark.createDataFrame([(u, json.dumps(b)) for u, b in answers], "url string, body string")
    assert {tuple(r) for r in snapshots.from_api(frame).collect()} == {("u1", "One", "notes", "github_release"), ("u2", "Bug", "text", "github_issue"), ("u3", "PR", "", "github_pull_request"), ("u4", "README.md", "héllo", "repository_file"), ("u5", "pkg", "d", "registry_metadata")}


def test_case_inputs_and_artifacts(spark, tmp_path):
    (tmp_path / "cases.json").write_text(json.dumps([{"project": "orbit", "current_version": "1", "target_version": "2"}, {"project": "x"}]))
    cases = snapshots.case_inputs(spark, str(tmp_path / "cases.json"))
    assert [(r.project, r.version_mode) for r in cases.collect()] == [("orbit", "family")]
    artifacts.write(cases, str(tmp_path), "cases")
    assert artifacts.read(spark, str(tmp_path), "cases").count() == 1
    artifacts.export_json(cases, str(tmp_path), "json")
    assert json.loads(spark.read.text(str(tmp_path / "json")).first()[0])["project"] == "orbit"
    page = "".join(reports.page("T & t", ["x"], [{"x": "</script><b>"}], ["x"], {}, {}))
    assert "</script><b>" not in page and "T &amp; t" in page
    snapshot = artifacts.schema_snapshot(cases.schema)
    assert artifacts.schema_drift(cases.schema, snapshot) == [] and artifacts.schema_drift(cases.drop("project").schema, snapshot) == ["project"]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"u{k % 3}", f"body {k % 4}", datetime.datetime(2024, 1, 1, 0, k)) for k in range(12)]
    frame = spark.createDataFrame(rows, "url string, body string, arrived timestamp")
    for n in range(3):
        frame.filter(F.minute("arrived") % 3 == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second start finds nothing new
        query = ingest.distinct_contents(stream).writeStream.foreachBatch(ingest.upserting(spark, out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = {(r.url, r.body) for r in ingest.current(spark, out).collect()}
    assert {u for u, _ in got} == {"u0", "u1", "u2"} and got <= {(u, b) for u, b, _ in rows}
    batch = ingest.latest(frame.withColumn("content_sha256", F.sha2("body", 256)))
    assert {r.url for r in batch.collect()} == {u for u, _ in got}


def test_upserts_equal_the_batch_and_can_run_again(spark, tmp_path):
    rows = [(f"u{k % 3}", f"body {k}", "h", datetime.datetime(2024, 1, 1, 0, k)) for k in range(9)]
    frame = spark.createDataFrame(rows, "url string, body string, content_sha256 string, arrived timestamp")
    folder = str(tmp_path / "t")
    merge = ingest.upserting(spark, folder, compact_every=2)
    tidy = lambda df: sorted(tuple(r) for r in df.collect())
    for number in (0, 1, 1, 2, 3, 4, 4, 3, 5):
        merge(frame.filter(F.minute("arrived") % 6 == number), number)
        seen = frame.filter(F.minute("arrived") % 6 <= max(number, 4 if number == 3 and ingest._numbers(spark, folder, "changes")[-1] > 3 else number))
        assert tidy(ingest.current(spark, folder)) == tidy(ingest.latest(seen))
    assert ingest._numbers(spark, folder, "base") == [5] and len(ingest._numbers(spark, folder, "changes")) <= 4


def test_scan_of_landed_answers(spark, tmp_path):
    import hashlib

    def row(url, body, at, status=200, good=True):
        return {"url": url, "accept": "html", "status": status, "headers": {"a": "b"}, "body": body, "final_url": url, "retrieved_at": at, "content_sha256": hashlib.sha256(body.encode()).hexdigest() if good else "0"}

    rows = [row("a", "old", "2024-01"), row("a", "new", "2024-02"), row("a", "broken", "2024-03", good=False), row("b", "Please verify you are human", "2024"), row("c", "gone", "2024", 404), row("d", "down", "2024", 503)]
    (tmp_path / "x.json").write_text("\n".join(map(json.dumps, rows)))
    found = snapshots.scan(spark, str(tmp_path / "x.json"))
    assert {(r.url, r.body, r.status) for r in found.collect()} == {("a", "new", 200), ("c", "gone", 404)}


@pytest.mark.parametrize("value", ["<script>", "a & b", " "])
def test_script_safe(value):
    made = artifacts.script_safe([value])
    assert json.loads(made) == [value] and "<" not in made and " " not in made


def test_paged_registry_scan(spark, tmp_path):
    """Pages of several catalogs, one of which fails, one that is empty; filters choose folders and rows."""
    release = lambda n, **more: {"tag_name": f"v{n}", "published_at": "2024", **more}
    pages = [("a#1", 1, json.dumps([release(1), release(2, draft=True)])), ("a#1", 2, json.dumps([release(3, prerelease=True), {"name": "v4"}], indent=1)), ("b", 1, "[]"), ("c/d", 1, json.dumps([release(1)])), ("c/d", 2, '{"message": "rate limit"}'), ("e", 1, "[{"), ("f", 12, json.dumps([release(9)]))]
    path = registry.land(spark.createDataFrame(pages, "catalog string, page int, body string"), str(tmp_path / "landed"))
    rows = registry.scan(spark, path, 2)
    assert rows.rdd.getNumPartitions() == 4
    assert sorted((r.catalog, r.version) for r in registry.releases(rows).collect()) == [("a#1", "v1"), ("a#1", "v4"), ("c/d", "v1"), ("f", "v9")]
    assert {(r.catalog, r.complete) for r in registry.completeness(rows).collect()} == {("a#1", True), ("b", True), ("c/d", False), ("e", False), ("f", False)}
    assert {(r.catalog, r.page, r.error is not None) for r in rows.filter("version IS NULL").collect()} == {("b", 1, False), ("c/d", 2, True), ("e", 1, True)}
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for condition in ("catalog = 'c/d'", "catalog IN ('b', 'f') AND page > 3", "version = 'v1'", "version = 'v1' AND catalog = 'a#1'", "catalog = 'none'"):
            found = registry.scan(spark, path).filter(condition)
            assert sorted(map(str, found.collect())) == sorted(str(r) for r in rows.collect() if r in rows.filter(condition).collect())
        reader = registry._FilteringReader({"path": path})
        left = list(reader.pushFilters([registry.EqualTo(("catalog",), "c/d"), registry.In(("version",), ("v1",)), registry.EqualTo(("page",), 1)]))
        assert [f.attribute for f in left] == [("page",)] and [f[:2] for p in reader.partitions() for f in p.files] == [("c/d", 1), ("c/d", 2)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert registry.scan(spark, str(tmp_path / "nothing")).collect() == []
