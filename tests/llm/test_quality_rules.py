import re

import duckdb
import pytest

from claimloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n\t ", "a b c d e a b c d e", "one two three four five six seven eight nine ten",
    "x " * 30, "Same line here\nother\nSame line here\n\n\n \nSame line here", "### *** $$$ a b c d e f g h i j",
    "É é ü b c d e f g h i j k", "SHOUT! " * 12, "ab " * 40_000, "a b c d e f a b c d e g h i j k l m n o p",
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 1), (None, "no id at all", 2)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_words int")


def test_measures_against_a_plain_count(docs):
    rows = q.result(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        if r.doc_id is None:
            continue
        expected = plain(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.base_failed and r.kept)


def test_sql_twin(docs):
    found = sorted(map(tuple, q.result(docs).fillna(-1, ["doc_id"]).collect()))
    documents = docs.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    expected = duckdb.sql(q.oracle_sql()).fetchall()
    assert found == sorted((-1 if r[0] is None else r[0], *r[1:]) for r in expected)


def test_policies_and_ablation(docs):
    ledger = q.ledger(docs)
    rows = ledger.collect()
    for policy, mask in q.POLICIES.items():
        kept = {r.doc_id: r.kept for r in q.apply_policy(ledger, policy).collect()}
        assert all(kept[r.doc_id] == (r.failure_bits & (mask | q.BASE) == 0) for r in rows)
        for a in q.ablation(ledger, policy).collect():
            bit = q.BITS[a.rule]
            assert a.n_docs == len(rows)
            assert a.n_failed == sum(bool(r.failure_bits & mask & bit) for r in rows)
            assert a.n_only_this == sum(r.failure_bits & mask == bit for r in rows)


def test_empty_table(spark):
    assert q.result(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
