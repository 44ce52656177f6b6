import random

import duckdb
import pytest

from claimloom.llm import decontamination as q


def plain_nearest(item, text):
    """Least edit distance of item to any run of text, and the first end of such a run."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b or not b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row), row.index(min(row))


def test_bit_vectors_against_a_table():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randint(1, 4) for _ in range(rng.randint(1, 90))]
        text = [rng.randint(0, 4) for _ in range(rng.randint(0, 60))]
        assert q.nearest(item, text) == plain_nearest(item, text)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + (kind < 2)] = [] if kind == 0 else [f"zz{rng.randrange(99)}"]
    return words


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, [word() for _ in range(rng.choice([5, 9, 15, 40, 60, 64, 65, 150, 400]))]) for i in range(60)]
    docs, planted = [], set()
    for d in range(300):
        words = [word() for _ in range(rng.choice([0, 3, 60, 400]))]
        if d % 2:
            i, own = rng.choice(items)
            share = rng.choice([0, 0.05, 0.1, 0.2])
            copy = edited(rng, own, int(share * len(own) + 1e-9))
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
            planted.add((d, i, share))
        docs.append((d, " ".join(w.upper() + "," if rng.random() < 0.1 else w for w in words)))
    return items, docs, planted


def brute(items, docs):
    out = {}
    codes = {}
    code = lambda w: codes.setdefault(w, len(codes) + 1)
    for d, text in docs:
        words = [code(w) for w in q.words_of((text or "").encode())]
        for i, own in items:
            best, _ = q.nearest([code(w) for w in own], words)
            if own and best <= q.allowed(len(own)):
                out[d, i] = best
    return out


def test_against_brute_force(spark, case):
    items, docs, _ = case
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(900, None), (901, "w1 W2!"), (None, "w1 w2 w3 w4 w5 w6"), (0, " ".join(items[0][1]))], "item_id bigint, text string")
    rows = [(d, t, 1, "x") for d, t in docs] + [(1000, None, 1, "x"), (1001, "", 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int, distance string")
    found = {(r.doc_id, r.item_id): r for r in q.contaminated(frame, bench).collect()}
    items = [*items, (901, ["w1", "w2"])]
    expected = brute([(i, q.words_of(' '.join(w).encode())) for i, w in items], docs)
    assert set(found) <= set(expected)
    texts = dict(docs)
    own = {i: q.words_of(' '.join(w).encode()) for i, w in items}
    for (d, i), r in found.items():
        assert r.distance == expected[d, i] and r.item_words == len(own[i])
        codes = {w: n + 1 for n, w in enumerate(sorted({*own[i], *q.words_of(texts[d].encode())}))}
        run = [codes[w] for w in q.words_of(texts[d].encode())[r.start_word : r.end_word]]
        assert plain_nearest([codes[w] for w in own[i]], run)[0] == r.distance
    exact = {k for k, v in expected.items() if v <= 0.1 * len(own[k[1]])}
    assert exact <= set(found)
    assert len(found) >= 0.95 * len(expected) > 100
    stay = q.clean(frame, bench)
    assert stay.columns == frame.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted({r[0] for r in rows} - {d for d, i in found if i != 901})
    assert {r.doc_id for r in q.clean(frame, bench, short=True).collect()} == {r[0] for r in rows} - {d for d, _ in found}


def test_blocks_and_segments(spark, case, monkeypatch):
    items, docs, _ = case
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert len(list(q.matchers(bench, 5000))) > 3
    matcher = next(q.matchers(bench))
    assert matcher.simulated_recall >= q.TARGET
    long = [" ".join(t for _, t in docs).encode()]
    whole = {(i, d) for _, i, d, *_ in matcher.find(long, matcher.symbols())}
    monkeypatch.setattr(q, "SEGMENT", 3000)
    cut = {(i, d) for _, i, d, *_ in matcher.find(long, matcher.symbols())}
    assert cut == whole and len(whole) > 20


@pytest.mark.parametrize("sizes", [[8] * 490 + [62] * 10, [6, 9] * 297 + [64] * 6, [64] * 40])
def test_rare_long_items_are_found(sizes):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(2000)}"
    items = [(n, [word() for _ in range(size)]) for n, size in enumerate(sizes)]
    matcher = q.Matcher([(n, " ".join(w).encode()) for n, w in items])
    own = [(n, w) for n, w in items if len(w) > 60]
    texts, expected = [], set()
    for k in range(400):
        n, words = own[k % len(own)]
        at = sorted(rng.sample(range(len(words)), q.allowed(len(words))))
        copy = [x for i, w in enumerate(words) for x in ([w] if i not in at else rng.choice([[], ["zz"], [w, "zz"]]))]
        texts.append(" ".join([word() for _ in range(30)] + copy + [word() for _ in range(30)]).encode())
        expected.add((k, n))
    found = {(k, n) for k, n, *_ in matcher.find(texts, matcher.symbols())}
    assert len(expected & found) >= 0.96 * len(expected)


def test_exact_search_where_walks_do_not_suffice(case, monkeypatch):
    items, docs, _ = case
    monkeypatch.setattr(q, "MOST_WALKS", 1)
    matcher = q.Matcher([(i, " ".join(w).encode()) for i, w in items])
    assert matcher.blocks and matcher.simulated_recall >= q.TARGET
    monkeypatch.setattr(q, "MOST_WALKS", 0)
    matcher = q.Matcher([(i, " ".join(w).encode()) for i, w in items])
    found = {(d, i) for d, i, *_ in matcher.find([t.encode() for _, t in docs], matcher.symbols())}
    assert found == set(brute([(i, q.words_of(" ".join(w).encode())) for i, w in items], docs))


def test_driver_rows_against_brute_force(spark):
    at = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{at}/documents.parquet'").fetchall()
    items = [(i, q.words_of(t.encode())) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{at}/benchmark.parquet'").fetchall()]
    found = q.contaminated(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/benchmark.parquet")).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == brute(items, docs)


def test_items_under_five_words_are_whole_texts(spark):
    docs = spark.createDataFrame([(1, "Yes."), (2, "yes, and more"), (3, None), (4, "New  YORK\ncity"), (5, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "yes"), (2, "new york city"), (3, ""), (4, None), (5, "YES!")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.distance, r.item_words, r.start_word, r.end_word) for r in q.contaminated(docs, bench, short=False).collect()}
    assert found == {(1, 1): (0, 1, 0, 1), (1, 5): (0, 1, 0, 1), (4, 2): (0, 3, 0, 3)}
    assert {(r.doc_id, r.item_id) for r in q.contaminated(docs, bench).collect()} == {*found, (2, 1), (2, 5)}
    assert sorted(r.doc_id for r in q.clean(docs, bench).collect()) == [2, 3, 5]


def test_texts_shorter_than_an_item_within_its_edits(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "one two three"), (3, "one two four five"), (4, "three four")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "one two three four five"), (2, "three four")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in q.contaminated(docs, bench).collect()}
    assert found == {(1, 1): 1, (1, 2): 0, (3, 1): 1, (4, 2): 0}


def test_empty_tables(spark):
    docs, bench = (spark.createDataFrame(r, f) for r, f in (([(1, "a b c d e f")], "doc_id bigint, text string"), ([(1, "a b c d e f")], "item_id bigint, text string")))
    assert q.contaminated(docs.limit(0), bench).collect() == [] and q.contaminated(docs, bench.limit(0)).collect() == []
    assert q.clean(docs, bench).collect() == [] and q.clean(docs, bench.limit(0)).count() == 1


def test_short_items_inside_texts():
    matcher = q.Matcher([(1, b"Alpha"), (2, b"beta gamma"), (3, b"beta, gamma"), (4, b"a b c d"), (5, b"one two three four five six"), (6, b"two three")])
    texts = [b"x Beta - gamma alpha. alpha", b"alpha", b"a b c", b"", b"?", b"a b c D! a b c d", b"one two three four five six", b"beta x gamma", b"gamma beta"]
    found = {(t, i): (d, n, a, b) for t, i, d, n, a, b in matcher.find(texts, matcher.symbols())}
    assert {k: v for k, v in found.items() if k[1] != 5} == {(0, 2): (0, 2, 1, 3), (0, 3): (0, 2, 1, 3), (0, 1): (0, 1, 3, 4), (1, 1): (0, 1, 0, 1), (5, 4): (0, 4, 0, 4), (6, 6): (0, 2, 1, 3)}
    assert found[6, 5][0] == 0
    assert {(t, i) for t, i, *_ in matcher.find(texts, matcher.symbols(), False)} == {(1, 1), (6, 5)}
