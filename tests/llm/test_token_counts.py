import random
from fractions import Fraction

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimloom.llm import token_counts as q

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "First line here.\n\nThird one,\n   indented\n", " lead\n \n trail  ", "a\x1cb !\x1c c\x85d\xa0 e f",
    "É日本語🙂\n🙂🙂\n", "it's don't\nIT'S", "<|endoftext|> x\n<|endoftext|>", "word " * 20_000, "x" * 3000 + "\n" * 50,
]


def plain(text, rule):
    """Sections by a loop over tokens and their bytes."""
    text = text or ""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    lines = [0]
    for byte in text.encode():
        lines.append(lines[-1] + (byte == 10))
    counts, at = [Fraction(0)] * (text.count("\n") + 1), 0
    for token in tokenizer.encode(text, add_special_tokens=False).tokens:
        own = lines[at : at + len(token)]
        at += len(token)
        if rule == "first":
            counts[own[0]] += 1
        elif rule == "most":
            counts[max(sorted(set(own)), key=lambda s: (own.count(s), -s))] += 1
        else:
            for s in own:
                counts[s] += Fraction(1, len(own))
    assert at == len(text.encode())
    return [float(c) for c in counts]


@pytest.mark.parametrize("rule", q.RULES)
def test_lines_against_a_plain_loop(spark, rule):
    random.seed(6)
    texts = TEXTS + ["".join(random.choices(["a", "B", " ", "  ", "\n", "\n\n", "é", "1", "!", "'s", "\t", "\x85", "\x1f"], k=40)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "a\nb", 0, "x"), (4, TEXTS[4], 0, "x")], "doc_id bigint, text string, section int, n_tokens string")
    found = {}
    for r in q.by_line(docs, PATH, rule).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len(found[None]) == 2 and len(found[4]) == 2
    for i, text in enumerate(texts):
        if i == 4:
            continue
        rows = sorted(found[i], key=lambda r: r.section)
        assert [r.n_tokens for r in rows] == pytest.approx(plain(text, rule))
        assert [(text or "")[r.start_char : r.end_char] for r in rows] == [x + "\n" for x in (text or "").split("\n")[:-1]] + [(text or "").split("\n")[-1]]


def test_parts_of_long_texts_give_the_tokens_of_the_whole(monkeypatch):
    random.seed(9)
    white = ["\t", "\n", "\x0b", "\x0c", "\r", " ", "  ", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "\x1c", "\x1f", "\u200b", "\ufeff"]
    texts = ["".join(random.choices([*white, "a", "Bc", "é", "1", "23", "!", "'s", "'", "-", "日本", "🙂"], k=80)) for _ in range(400)] + [t or "" for t in TEXTS]
    lengths = q.TokenLengths(open(PATH, encoding="utf-8").read())
    whole = [x.tolist() for x in lengths.of(texts)]
    for size, together in ((1, 1), (7, 50), (30, 1 << 18)):
        monkeypatch.setattr(q, "WHOLE", size)
        monkeypatch.setattr(q, "TOGETHER", together)
        assert [x.tolist() for x in lengths.of(texts)] == whole
    assert list(lengths.of([])) == [] and sum(map(len, whole)) > 10_000


def test_fields(spark):
    rows = [(1, "A title", "A body\nof text", None), (2, None, None, None), (3, "x ", " y", "z")]
    df = spark.createDataFrame(rows, "page bigint, title string, body string, field string")
    tokenizer = Tokenizer.from_file(PATH)
    found = {}
    for r in q.by_field(df, "page", ["title", "body", "field"], PATH, "most").collect():
        found.setdefault(r.page, {})[r.field] = r.n_tokens
    for page, *values in rows:
        whole = "\n".join(v or "" for v in values)
        assert sum(found[page].values()) == len(tokenizer.encode(whole).tokens)
        assert set(found[page]) == {"title", "body", "field"}


def test_empty_table_and_unknown_rule(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert q.by_line(docs, PATH).collect() == []
    with pytest.raises(ValueError):
        q.by_line(docs, PATH, "any")
