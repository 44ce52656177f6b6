import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " \t\n",
    "Plain words, here!",
    "it's IT'S don't \"quoted\" (x)... <|endoftext|> <|ENDOFTEXT|> a<|endoftext|>,",
    "Étude école ΑΣΣ Straße non breaking \x1c\x85 İstanbul 12,345.67",
    "x" * 5000,
    "word " * 5000,
    "a≯ b, c.́ 日本語 テスト 🙂!!",
]


def plain_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 2}", 7) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s", 7), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, sequence_id int")


def test_word_ids_equal_the_plain_tokenizer():
    words = packing.WordIds(open(PATH, encoding="utf-8").read())
    random.seed(3)
    texts = [t or "" for t in TEXTS] + ["".join(random.choices("ab é'.,!<|>s t\ńΣ1", k=60)) for _ in range(400)]
    texts += ["".join(random.choices("ßçñÉİſǆ日本ά\u0301\u0327aeZ ـक्ि١", k=40)) for _ in range(400)]
    tokenizer = Tokenizer.from_file(PATH)
    for text in texts:
        assert np.frombuffer(words.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_and_places(docs):
    rows = packing.pack_documents(docs, PATH).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(TEXTS):
        ids = plain_ids(text)
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]})
        expected = [(k, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
        assert own == expected
    assert len(by_doc[3]) == 2 and len(by_doc[None]) == 1
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(empty, PATH).collect() == []


@pytest.mark.parametrize("limit", [1, 3, 10_000])
def test_best_fit_matches_a_plain_one(limit):
    random.seed(limit)
    bins, free, made = packing.OpenBins(100, limit), {}, 0
    for length in [random.randint(1, 100) for _ in range(3000)]:
        found, offset = bins.place(length)
        fitting = [f for f in free.values() if f >= length]
        if fitting:
            assert free[found] == min(fitting) == 100 - offset
        else:
            if len(free) >= limit:
                fullest = min(free.values())
                assert len([1 for v in free.values() if v == fullest]) >= 1
                gone = next(k for k in sorted(free) if free[k] == fullest and k not in {b for v in bins.by_space.values() for b in v} and k != found)
                del free[gone]
            assert (found, offset) == (made, 0)
            free[found], made = 100, made + 1
        free[found] -= length
        if not free[found]:
            del free[found]


def test_few_sequences(spark):
    random.seed(1)
    rows = [(i, 0, 0, random.randint(1, 2048), i) for i in range(20_000)]
    parts = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint").coalesce(1)
    used = packing.pack(parts).select("sequence_id").distinct().count()
    assert used <= 1.02 * sum(r[3] for r in rows) / 2048
