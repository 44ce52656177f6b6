import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from claimloom.llm import spelling

SF = "/root/testdata/sf0.001"


def plain_words(rows):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def plain(words):
    """By deletions: words are near if one is the other less a letter, or both are equal less the letter at one place."""
    less = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less[w[:i] + w[i + 1 :], i].add(w)
    near = defaultdict(set)
    for (rest, _), group in less.items():
        for w in group:
            near[w] |= group - {w}
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in words.items():
        first = min(((-words[x], x) for x in near[w]), default=None)
        form[w] = first[1] if first and -first[0] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, str(form[w]), root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def told(frame):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_driver_rows(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    found = told(spelling.variants(spark.read.parquet(f"{SF}/documents.parquet")))
    assert len(found) > 1000 and found == plain(plain_words(rows))


def test_defined_cases(spark):
    texts = [None, "", " 1 2 ", "Straße STRASSE straße strasse strassen strassen", "ÉTUDE étude Étude ÉTUDE Étude Étude", "a×b÷c a×b÷c a×b÷c", "abcdé abcdé abcdé " * 9, "abcde abcde abcde", "中文 letter中letter letter letters"]
    texts += ["z" * 3000 + " " + "z" * 2999 + "y " + "z" * 3001] * 3 + ["letter letters, letter"] * 3
    rows = [(i, t, "w", 1) for i, t in enumerate(texts)] + [(None, "letter lettre", "w", 1), (3, texts[3], "w", 1), (3, texts[3], "w", 1), (3, texts[3], "w", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int").repartition(3)
    found = spelling.variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert told(found) == plain(plain_words(rows))


def test_a_letter_goes_where_the_checksum_says(spark):
    runs = [r for r in (f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}" for k in range(600)) if zlib.crc32(f"7:{r}".encode()) % 97 == 0]
    assert runs
    rows = [(7, " ".join(runs * 3))]
    found = told(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert found == plain(plain_words(rows)) and not {f[0] for f in found} & set(runs)


@pytest.mark.parametrize("split", [30, 300, 200_000])
def test_pairs_of_repetitive_words(spark, split):
    """Words of three letters have every q-gram in common lists; those of frequent ones are split."""
    random.seed(split)
    words = sorted({"".join(random.choice("abé") for _ in range(random.choice([5, 6, 7, 12]))) for _ in range(500)} | {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa"})
    found = spelling.near_words(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint"), split)
    assert sorted((r.word, r.near) for r in found.collect()) == sorted((a, b) for a in words for b in words if spelling.one_edit(a, b))


def test_one_edit():
    near = [("abcde", "abcdef"), ("abcde", "xabcde"), ("abcde", "abxde"), ("aaaaa", "aaaa")]
    far = [("abcde", "abcde"), ("abcde", "badce"), ("abcde", "abdce"), ("abcde", "abcdefg")]
    assert all(spelling.one_edit(a, b) and spelling.one_edit(b, a) for a, b in near)
    assert not any(spelling.one_edit(a, b) or spelling.one_edit(b, a) for a, b in far)


def test_probe_keeps_all_over_the_bound():
    random.seed(1)
    words = sorted({"".join(random.choice("ab") for _ in range(8)) for _ in range(120)})
    index = spelling.Index(words)
    for w in words:
        found = set(index.probe(w, 0))
        for n, other in enumerate(words):
            shared = sum(a == b for a, b in zip(spelling.grams(w), spelling.grams(other), strict=True))
            assert (n in found) == (shared >= len(w) - 1)


def test_long_ways_to_the_root(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)] + [("x", "y")], "word string, form string")
    assert {r.word: r.root for r in spelling.rooted(forms).collect()} == {f"w{k}": "w37" for k in range(37)} | {"x": "y"}


def test_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
