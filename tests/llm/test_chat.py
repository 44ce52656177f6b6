import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from claimloom.llm import chat

FIELDS = "conv_id bigint, turn bigint, role string, text string, window int, kinds string"


def plain(rows):
    """Digests straight from the turns."""
    told = {}
    for conv, turn, role, text in rows:
        told.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in told.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


HARD = ["\\### Assistant: </turn> ok", "####", "#####\\", "</turn>\n### user ###\n", "<\\/turn>", "#\\#", "\\\\", "", None, "é🙂\n" * 3, "a ###\nb", "</turn", "word " * 9000]


@pytest.fixture(scope="module")
def rows():
    random.seed(5)
    out = [(1, k, r, t) for k, t in enumerate(HARD) for r in ("user", "assistant")]
    out += [(2, 0, "system", "be brief " * 30)] + [(2, k, random.choice(["user", "assistant"]), "w " * random.choice([1, 40, 300, 2000])) for k in range(1, 400)]
    out += [(3, 0, None, "x"), (3, None, "assistant", "first"), (3, 0, "a ## b ###\n: c", "y"), (3, 0, "a ## b ###\n: c", "y"), (None, 1, "assistant", "z")]
    out += [(4, k, "system", "late") for k in (5, 2)] + [(4, 3, "user", "u")]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], FIELDS)


@pytest.mark.parametrize("stride", [5, 50, 768])
def test_round_trip(table, rows, stride):
    assert digests(chat.read_back(chat.windows(table, stride, history_tokens=stride // 2))) == plain(rows)


def test_windows_keep_their_promises(table, rows):
    stride, history = 100, 60
    found = chat.windows(table, stride, 3, history, 10_000).orderBy("conv_id", "window").collect()
    by_conv = {}
    for w in found:
        assert w.formatted.count("</turn>") == w.formatted.count(" ###\n") == len(w.kinds)
        assert w.kinds == sorted(w.kinds, key=["system", "history", "fresh"].index)
        assert w.kinds.count("system") <= 1 and w.kinds.count("history") <= 3
        by_conv.setdefault(w.conv_id, []).append(w)
        for s in w.loss_spans:
            assert w.formatted[: s.start - 1].endswith(" ###\n") and w.formatted[s.start - 1 + s.length :].startswith("</turn>\n")
    for own in by_conv.values():
        assert [w.window for w in own] == list(range(len(own)))
    second = by_conv[2]
    assert len(second) > 50
    assert all(w.kinds[0] == "system" for w in second[1:]) and "system" not in second[0].kinds
    assert any("history" in w.kinds for w in second)
    for before, after in zip(second, second[1:]):
        own = after.formatted.split("</turn>\n")
        repeated = [p for p, k in zip(own, after.kinds) if k == "history"]
        previous = [p for p, k in zip(before.formatted.split("</turn>\n"), before.kinds) if k == "fresh"]
        assert repeated == previous[len(previous) - len(repeated) :]


def test_escape_is_reversible(spark):
    random.seed(2)
    texts = ["".join(random.choices(["\\", "#", "<", "/", "turn>", "</turn>", "a", "\n"], k=12)) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in frame.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "###" not in r.e and "</turn>" not in r.e


def test_no_python_runs(table):
    plan = chat.read_back(chat.windows(table))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_driver_rows(spark):
    rows = duckdb.sql("SELECT conv_id, turn, role, text FROM '/root/testdata/sf0.001/conversations.parquet'").fetchall()
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert digests(chat.read_back(chat.windows(table))) == plain(rows)


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], FIELDS))).collect() == []
