import html
import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimloom.functions.vocabulary import RISK_LEVELS
from claimloom.sources import reports

ODD = ["</script><b>", "a & b", " ", "é\U0001f600", "'\"", "", None]


def cells(text):
    return [[html.unescape(c) for c in re.findall(r"<td>(.*?)</td>", row, re.S)] for row in re.findall(r"<tr[^>]*>(<td>.*?)</tr>\n", text, re.S)]


def facets(text):
    return json.loads(re.search(r"id='facets'>(.*?)</script>", text, re.S)[1])


def test_a_thousand_cases(spark, tmp_path):
    rows = [(f"case/{k % 1000}", k, ODD[k % 7], RISK_LEVELS[k * 7 % 4], [k, None]) for k in range(4000)]
    frame = spark.createDataFrame(rows, "name string, n int, note string, level string, more array<int>")
    modes = {"severity": ["level", "n"], "note": ["note"]}
    for _ in range(2):  # the second run takes the place of the first
        reports.write_reports(frame, str(tmp_path), "name", ["n"], ["level", "note"], modes, {"level": list(RISK_LEVELS)})
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == sorted(reports.file_name(f"case/{k}") for k in range(1000))
    for k in range(0, 1000, 37):
        text = (tmp_path / reports.file_name(f"case/{k}")).read_text()
        own = [r for r in rows if r[0] == f"case/{k}"]
        assert cells(text) == [[str(n), note or "", level, json.dumps({"more": more}, separators=(",", ":"))] for _, n, note, level, more in own]
        found = facets(text)
        levels = Counter(r[3] for r in own)
        assert found["level"] == [[v, levels[v]] for v in RISK_LEVELS if levels[v]]
        assert {v: n for v, n in found["note"]} == Counter(r[2] for r in own)
        island = re.search(r"id='facets'>(.*?)</script>", text, re.S)[1]
        assert "<" not in island and " " not in island and "</script><b>" not in text
        assert "<option value='2,0'>severity</option>" in text and "data-r2='" in text


def test_a_run_that_fails_leaves_nothing(spark, tmp_path):
    broken = spark.range(50).select(F.col("id").alias("case"), F.when(F.col("id") == 49, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("x"))
    with pytest.raises(Exception, match="no"):
        reports.write_reports(broken, str(tmp_path), "case")
    assert not any(p.suffix == ".html" or p.name.startswith("_pages") for p in tmp_path.iterdir())
    reports.write_reports(spark.range(3).select(F.col("id").alias("case"), F.lit("x").alias("x")), str(tmp_path), "case")
    reports.write_reports(spark.range(2, 5).select(F.col("id").alias("case"), F.lit("y").alias("x")), str(tmp_path), "case", overwrite=False)
    assert {p.name: cells(p.read_text()) for p in tmp_path.glob("*.html")} == {"0.html": [["x"]], "1.html": [["x"]], "2.html": [["y"]], "3.html": [["y"]], "4.html": [["y"]]}
