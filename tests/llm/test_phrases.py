import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from claimloom.llm import phrases

SF = "/root/testdata/sf0.001"
FIELDS = "text string, lang string, phrase int, f string"


def plain(rows, least, top):
    sizes, counts = Counter(), Counter()
    for text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            counts.update((lang or "und", tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    longer = {}
    for (lang, p), f in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i : i + k]] = max(f, longer.get((lang, p[i : i + k]), 0))
    by_lang = {}
    for (lang, p), a in found.items():
        cuts = [(1000 * a * sizes[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if 100 * longer.get((lang, p), -1) < 100 * a:
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, n, p.decode(), -a, l, r, sizes[lang], -score) for lang, rows in by_lang.items() for n, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def told(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("counters", [1 << 16, 1 << 20])
def test_against_all_phrases(spark, counters):
    random.seed(counters)
    words = ["der", "Die", "das", "étude", "x", "#", "naïve", "a" * 70]
    make = lambda: "".join(random.choice(words) + random.choice([" ", "  ", " ", "\t", ", ", ".", "\n", "\r\n", " \x0b"]) for _ in range(random.randrange(60)))
    rows = [(make(), random.choice(["de", "de", "de", "fr", None]), 1, "f") for _ in range(80)]
    rows += [(None, "de", 1, "f"), ("", None, 1, "f"), (" .,", "es", 1, "f"), ("one two", "it", 1, "f"), rows[0], rows[0], ("a a a a a a a", "und", 1, "f")]
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    assert told(phrases.collocations(docs, 3, 40, counters)) == plain(rows, 3, 40)


def test_a_full_sketch_changes_nothing(spark):
    """With 65,536 counters for 485,000 characters the bounds tell little; the sums decide."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert told(phrases.collocations(docs, 8, 30, 1 << 16)) == plain(rows, 8, 30)


def test_twin(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = phrases.collocations(spark.read.parquet(f"{SF}/documents.parquet"), 20)
    result = connection.execute(phrases.oracle_sql(20))
    assert [c[0] for c in result.description] == found.columns
    rows = told(found)
    assert rows and rows == sorted(result.fetchall())


def test_counts_of_overlapping_matches():
    text = phrases.Shard("x", [b"a a a. a a", b"a b"]).text
    assert phrases.counted(["a", "a a", "a a a", "a b", "b a"], text).tolist() == [6, 3, 1, 1, 0]
    assert phrases.counted([], text).size == 0


def test_long_texts_are_parted_at_piece_ends():
    import pyarrow as pa

    text = "one two three, four five; " * 400
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
    shards = list(phrases._shards(iter([batch]), 512))
    assert len(shards) > 5
    whole = [b" ".join(s.text[a:b] for a, b in zip(s.starts, s.ends, strict=True)).decode() for s in shards]
    assert " ".join(whole).split() == re.findall("[a-z]+", text)
    pairs = sum(int(np.sum(s.pieces[1:] == s.pieces[:-1])) for s in shards)
    assert pairs == 400 * 3


def test_products_beyond_64_bits(spark, monkeypatch):
    rows = [("en", "u v", 4_000_000_000_000), ("en", "u", 4_000_000_000_001), ("en", "v", 4_000_000_000_000), ("en", None, 9_000_000_000_000_000)]
    monkeypatch.setattr(phrases, "frequent", lambda *_: spark.createDataFrame(rows, "lang string, phrase string, f bigint"))
    row = phrases.collocations(spark.range(0)).first()
    assert row.score == 1000 * rows[0][2] * rows[3][2] // (rows[1][2] * rows[2][2])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert phrases.collocations(docs).collect() == []
