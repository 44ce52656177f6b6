import random

import duckdb
import numpy as np
import pytest
import xxhash

from claimloom.llm import common, minhash

SF = "/root/testdata/sf0.001"


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset(words)


def plain(rows):
    """Components by all pairs of rows; a row is (doc_id, text)."""
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for (doc_id, _), s, g in zip(rows, sets, group, strict=True):
        ids = [d for (d, _), h in zip(rows, group, strict=True) if h == g and d is not None]
        out.append((doc_id, len(s), min(ids, default=None), doc_id is not None and doc_id == min(ids)))
    return sorted(out, key=str)


def told(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def edited(words, share):
    return [w if random.random() > share else f"n{random.randrange(10**6)}" for w in words]


def test_groups_of_near_copies(spark):
    """Chains whose ends are far apart, a large group around one text, and pairs about the threshold."""
    random.seed(5)
    base = [f"w{random.randrange(400)}" for _ in range(120)]
    texts = [" ".join(edited(base, 0.04)) for _ in range(60)]
    for share in (0.02, 0.05, 0.07, 0.1):
        for _ in range(12):
            own = [f"v{random.randrange(10**6)}" for _ in range(random.choice([6, 12, 60, 200]))]
            texts += [" ".join(own), " ".join(edited(own, share)), " ".join(own[: int(len(own) * 0.83)])]
    chain = [f"c{k}" for k in range(100)]
    texts += [" ".join(chain[k : k + 70]) for k in range(0, 30, 6)]
    random.shuffle(texts)
    rows = list(enumerate(texts))
    assert told(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))) == plain(rows)


@pytest.mark.parametrize("more", [2, 5])
def test_rounds_compare_all_pairs(spark, monkeypatch, more):
    """With few entries compared a round, what lies in a bucket with unlike texts is still found."""
    monkeypatch.setattr(minhash, "MORE", more)
    random.seed(more)
    pool = [f"p{k}" for k in range(45)]
    texts = [" ".join(pool[:30] + random.sample(pool[30:], 9)) for _ in range(70)]
    rows = list(enumerate(texts))
    assert told(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))) == plain(rows)


@pytest.mark.parametrize("more", [3, 64])
def test_near_copies_that_do_not_link_compare_few_texts(spark, monkeypatch, more):
    """A group of which a third is too far from all others: its texts are told apart without being compared pair by pair."""
    monkeypatch.setattr(minhash, "MORE", more)
    compared, asked = minhash.compared, []
    monkeypatch.setattr(minhash, "compared", lambda pairs, *rest: asked.append(pairs.count()) or compared(pairs, *rest))
    random.seed(11)
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join(base)] + [" ".join(edited(base, random.choice([0.02, 0.04, 0.09]))) for _ in range(150)]
    rows = list(enumerate(texts))
    expected = plain(rows)
    assert 30 < sum(kept for *_, kept in expected) < 90
    assert told(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))) == expected
    assert sum(asked[1:]) < len(rows)  # besides the pairs with firsts


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(3)
    for size in (1, 20, 150, 3000):
        pool = rng.integers(0, 1 << 64, 2 * size, np.uint64)
        for shared in (0, size // 2, size - 1, size):
            one, other = pool[:size], pool[size - shared : 2 * size - shared]
            bits = sum(int(x).bit_count() for x in (minhash.parities(one) ^ minhash.parities(other)).view(np.uint64))
            differ = 2 * (size - shared)
            assert bits <= differ and (differ > 60 or bits >= 0.8 * differ)


def test_defined_cases(spark):
    rows = [(4, None), (5, ""), (6, " \n"), (7, "One"), (8, "one"), (9, "one two"), (2, "One  two\nthree four five six"), (3, "one two three four five six seven")]
    rows += [(1, "other text here"), (1, "one two three four five six"), (1, "one two three four five six"), (None, "other text here"), (None, "alone"), (None, "alone"), (None, ""), (10, "É é É é"), (11, "é É É é")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, entry int, tag string").repartition(3)
    found = minhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    # Rows without words stand for themselves, whatever id they have.
    assert told(found) == plain(rows)


def test_twin(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = connection.execute(minhash.oracle_sql())
    found = minhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))
    assert [c[0] for c in result.description] == found.columns
    assert told(found) == sorted(result.fetchall(), key=str)


def test_both_ends_estimate_the_similarity_without_bias():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 64, 900, np.uint64)
    for shared in (100, 300, 500):
        agree = [np.mean(minhash.signature(x[: 300 + shared // 2]) == minhash.signature(x[300 - shared // 2 :])) for x in (rng.permutation(pool)[:600] for _ in range(60))]
        assert abs(np.mean(agree) - shared / 600) < 0.02


def test_bands_catch_the_threshold():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = rng.integers(0, 1 << 64, 500, np.uint64)
        assert (minhash.bands(x[:450]) == minhash.bands(x[50:])).any()
    far = [rng.integers(0, 1 << 64, 500, np.uint64) for _ in range(300)]
    assert sum((minhash.bands(x[:300]) == minhash.bands(x[200:])).any() for x in far) < 6


def test_long_texts_in_parts():
    memo = common.Memo(xxhash.xxh64_intdigest)
    words = [f"w{k % 5000}" for k in range(300_000)]
    text = " ".join(words).encode()
    assert len(text) > 1 << 20
    assert len(minhash.shingles(text, memo)) == len(set(zip(words, words[1:], strict=False)))


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
