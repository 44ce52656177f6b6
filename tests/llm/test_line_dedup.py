import itertools
import random

import duckdb
import numpy as np
import pytest

from claimloom.llm import line_dedup as q

FIELDS = "doc_id bigint, text string, n_chars int, doc string, runs int"


def phrase(rng, n):
    return [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(4000)}" for _ in range(n)]


def plain_blocks(text):
    """(first word, end) of the lines from each line on, and up to each, that make ten words."""
    sizes = [n for line in text.split("\n") if (n := len(line.split()))]
    edges = [0, *itertools.accumulate(sizes)]
    out = {(a, next((b for b in edges if b >= a + 10), None)) for a in edges[:-1]} | {(next((a for a in reversed(edges) if a <= b - 10), None), b) for b in edges[1:]}
    return sorted((a, b) for a, b in out if a is not None and b is not None and b - a < 50)


def plain(texts):
    """{key: text} with the same promises, by brute force over all 50-word windows and all blocks of lines in document order."""
    seen, blocks, out = set(), set(), {}
    for key, text in texts:
        words = (text or "").split()
        drop = [False] * len(words)
        for i in range(len(words) - 49):
            gram = tuple(words[i : i + 50])
            if gram in seen:
                drop[i : i + 50] = [True] * 50
            seen.add(gram)
        for a, b in plain_blocks(text or ""):
            if tuple(words[a:b]) in blocks:
                drop[a:b] = [True] * (b - a)
            blocks.add(tuple(words[a:b]))
        out[key] = [w for w, d in zip(words, drop) if not d]
    return out


def test_word_hashes():
    rng = random.Random(2)
    texts = ["".join(rng.choices(" \t\n\x0b\x0c\rab\x00\x01é\x1c\x85", k=rng.randrange(60))).encode() for _ in range(2000)]
    seen = {}
    for text in [*texts, b"", b"word", b" a" * 200_000]:
        words, hashes = text.split(), q.word_hashes(text).tolist()
        assert len(words) == len(hashes)
        starts, ends = q.word_spans(text)
        assert [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())] == words
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len({h & 0xFFFFFFFF for h in seen.values()}) == len(seen) > 1000


def test_line_hashes_and_selection():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 300).astype(np.uint64)
    for line in (1, 2, 3, 8, 25, 31):
        hashes = q.line_hashes(np.concatenate([words, words[40:90]]), line)
        assert len(hashes) == 350 - line + 1
        n = 50 - line + 1
        assert (hashes[300 : 300 + n] == hashes[40 : 40 + n]).all() and len(set(hashes.tolist())) >= 300 - line
    for n in (26, 27, 60, 400):
        for top in (3, 50, 2**60):
            hashes = rng.integers(0, top, n).astype(np.uint64).tolist()
            expected = [i + hashes[i : i + q.LINES].index(min(hashes[i : i + q.LINES])) for i in range(n - q.LINES + 1)]
            assert q.least_places(np.array(hashes, np.uint64)).tolist() == expected


def test_marks_cover_every_window_once():
    rng = random.Random(8)
    texts = [" ".join(phrase(rng, n)).encode() for n in (0, 49, 50, 51, 300)] + [b"a " * 200]
    marks = q.Marked(texts)
    text, place, line, own = marks.windows(np.arange(len(marks.text)))
    assert sorted(zip(text.tolist(), place.tolist())) == [(n, i) for n, t in enumerate(texts) for i in range(len(t.split()) - 49)]
    by_words = {}
    for n, i, a, b in zip(text.tolist(), place.tolist(), line.tolist(), own.tolist()):
        assert by_words.setdefault(tuple(texts[n].split()[i : i + 50]), (a, b)) == (a, b)
    assert len(set(by_words.values())) == len(by_words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    shared = [phrase(rng, n) for n in (51, 60, 75, 120, 400)]
    docs = []
    for i in range(120):
        words = phrase(rng, rng.choice([5, 30, 80, 300]))
        for at in sorted({rng.randrange(len(words) + 1) for _ in range(rng.choice([0, 1, 1, 2]))}, reverse=True):
            words[at:at] = rng.choice(shared)
        docs.append((i, " ".join(words)))
    docs += [(200, docs[3][1]), (201, docs[3][1] + "\n tail"), (202, None), (203, ""), (204, "same " * 20_000), (205, " ".join(phrase(rng, 49)))]
    docs.append((206, docs[-1][1]))
    docs += [(207, " ".join(phrase(rng, 60) * 3)), (208, "\n".join(["one line of five words"] * 30))]
    return docs


def test_against_brute_force(spark, corpus):
    rows = [(i, t, len(t or ""), "x", 1) for i, t in corpus]
    found = {r.doc_id: r for r in q.line_dedup(spark.createDataFrame(rows, FIELDS).repartition(3)).collect()}
    expected = plain(corpus)
    texts = dict(corpus)
    assert len(found) == len(corpus)
    for i, words in expected.items():
        if i in (204, 207, 208):
            continue
        own = (found[i].text or "").split()
        assert own == words, i
        assert found[i].removed_words == len((texts[i] or "").split()) - len(words)
        if not found[i].removed_runs:
            assert found[i].text == texts[i]
    assert found[204].text.split() == ["same"]
    assert found[207].text.split() == texts[207].split()[:60]
    assert found[208].text.split() == texts[208].split()[:5]
    assert found[200].text == "" and found[201].text.split() == ["tail"]


def test_whole_passage_after_an_edited_copy(spark):
    rng = random.Random(6)
    docs = []
    for n in range(60):
        whole = phrase(rng, rng.choice([50, 55, 60, 80, 150]))
        edited = list(whole)
        for at in rng.sample(range(len(whole)), rng.choice([1, 1, 2])):
            edited[at] = "other"
        a, b = sorted(rng.sample(range(len(whole) + 1), 2))
        for copy in (edited, whole[a:b], edited[5:] + whole[:30], whole, whole[10:] + whole, whole[:-3]):
            docs.append((len(docs), " ".join([*phrase(rng, rng.randrange(40)), *copy, *phrase(rng, rng.randrange(40))])))
    common = phrase(rng, 40)
    docs += [(1000 + n, " ".join([*phrase(rng, 30), *common, *phrase(rng, 30)])) for n in range(20)]
    docs += [(2000 + n, docs[-1][1]) for n in range(3)]
    expected = plain(docs)
    found = q.line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: r.text.split() for r in found} == expected


def test_stage_keeps_columns_and_repeated_rows(spark, corpus):
    long = corpus[3][1] + " " + " ".join(f"w{k}" for k in range(80))
    rows = [(9, long, 5, "x", 1), (9, long, 5, "x", 1), (9, "another text", 12, "y", 2), (10, long + " end", 5, "z", 3), (11, long, 5, "z", 3), (None, long, 1, "n", 4), (None, "short", None, None, None), (12, None, None, None, None)]
    docs = spark.createDataFrame(rows, FIELDS)
    out = q.deduplicated(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame([rows[0], rows[1], rows[2], (10, "end", 3, "z", 3), rows[6], rows[7]], FIELDS).collect()))


def test_batches_settle_what_they_can():
    ints = lambda *x: np.array(x, np.int64)
    line, own = np.array([1, 2, 2, 2, 2, 3, 3], np.uint64), np.array([5, 6, 6, 7, 6, 8, 8], np.uint64)
    rows = q.settled(line, own, ints(0, 4, 1, 9, 1, 5, 2), ints(*[0] * 7), ints(0, 0, 0, 0, 0, 0, 3), np.zeros(7, np.int32)).to_pylist()
    # The row that stands twice is sent once; of (2, 6) document 1 goes on and 4 is a copy, (2, 7) is asked for.
    assert sorted((r["doc"], r["own"], r["kind"]) for r in rows) == [(0, 5, q.ALONE), (1, 6, q.SEVERAL), (2, 8, q.ALONE), (4, 6, q.COPY), (5, 8, q.COPY), (9, 7, q.ASKED)]
    assert all(r["line"] in (1, 2, 3) for r in rows if r["kind"] in (q.ALONE, q.SEVERAL))


def test_rows_without_doc_id(spark):
    rng = random.Random(11)
    shared = phrase(rng, 70)
    texts = [" ".join(phrase(rng, 8)) for _ in range(49_900)] + [" ".join([*phrase(rng, 20), *shared, *phrase(rng, 60)]) for _ in range(100)]
    rows = [(None, t, n) for n, t in enumerate(texts)] + [(7, " ".join(shared), -1)]
    found = {r.n: r for r in q.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(4)).collect()}
    assert len(found) == len(rows)
    for n, t in enumerate(texts):
        words = t.split()
        assert found[n].text.split() == (words if n < 49_900 else words[:20] + words[90:])


def test_rows_that_share_a_key_lose_nothing_of_their_own(spark, monkeypatch):
    rng = random.Random(12)
    shared = phrase(rng, 120)
    texts = [" ".join([*phrase(rng, rng.randrange(90)), *(shared if n % 2 else []), *phrase(rng, rng.randrange(90))]) for n in range(60)]
    real = q._keyed
    monkeypatch.setattr(q, "_keyed", lambda docs: real(docs).withColumn(q.TAG, q.F.lit(3).cast("bigint")))
    found = q.deduplicated(spark.createDataFrame([(None, t, n) for n, t in enumerate(texts)], "doc_id bigint, text string, n int").repartition(3)).collect()
    for r in found:
        words, left = texts[r.n].split(), r.text.split()
        assert set(words) - set(shared) <= set(left)


def test_common_line_in_many_contexts(spark):
    rng = random.Random(13)
    line = phrase(rng, 40)
    docs = [(n, " ".join([*phrase(rng, 30), *line, *rng.choice([["x"] * 9, ["x", "y"] * 9, phrase(rng, 30)]), *phrase(rng, 40)])) for n in range(300)]
    found = q.line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: r.text.split() for r in found} == plain(docs)


def test_empty_table(spark):
    docs = spark.createDataFrame([], FIELDS)
    assert q.line_dedup(docs).collect() == [] and q.deduplicated(docs).collect() == []


def test_lines_against_brute_force(spark):
    """Footers, headers and runs of short lines, between lines of their own."""
    rng = random.Random(12)
    shared = [" ".join(phrase(rng, n)) for n in (14, 10, 9, 3, 1, 25)]
    few = ["\n".join(" ".join(phrase(rng, n)) for n in sizes) for sizes in ((3, 4, 5), (2, 2, 2, 2, 2), (12, 1), (1, 9, 1))]
    docs = []
    for i in range(150):
        lines = [" ".join(phrase(rng, rng.choice([0, 1, 4, 12, 60]))) for _ in range(rng.choice([0, 1, 3, 6]))]
        for _ in range(rng.choice([0, 1, 2, 3])):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(shared + few))
        docs.append((i, rng.choice(["\n", "\n\n", "\r\n", " \n\t"]).join(lines)))
    found = {r.doc_id: r for r in q.line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect()}
    expected = plain(docs)
    assert {i: (r.text or "").split() for i, r in found.items()} == expected
    assert sum(r.removed_words for r in found.values()) > 500


def test_a_footer_stays_once(spark):
    rng = random.Random(3)
    footer = " ".join(phrase(rng, 14))
    docs = [(i, " ".join(phrase(rng, 70)) + f"\n{footer}\n" + ("" if i % 2 else f"tail{i} x{i}")) for i in range(20)]
    found = q.line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()
    assert sorted(r.doc_id for r in found if footer in r.text) == [0] and all(r.removed_words == 14 and r.removed_runs == 1 for r in found if r.doc_id)


def test_twin_by_lines(spark):
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    found = q.line_dedup(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    expected = connection.execute(q.oracle_sql()).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
