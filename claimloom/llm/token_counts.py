"""Token counts by section: whole documents are encoded once and their tokens joined to sections by position.

A document is encoded as a whole, so its tokens are those that training would see.
Each token's span is joined to the sections that it overlaps, by binary search in the
sections' sorted starts, and a rule says where a token counts that crosses a boundary:

* ``first``: in the section of its first byte;
* ``most``: in the section that holds most of its bytes, the earlier one on a tie;
* ``share``: in every section, by its share of the token's bytes.

Whatever the rule, a document's counts sum to its tokens. Sections are the lines of a
text, each with its line feed, or named fields that are joined by a separator, which
belongs to the field before it.

The tokenizer is a byte-level BPE of the GPT-2 kind: its tokens are the text's bytes one
after another, so the running sum of the tokens' byte lengths is their offsets. Its pieces
never go on from other characters into white space; a text of more than ``WHOLE`` characters
is encoded in parts that end there, which gives the tokens of the whole and bounds memory.

Defined results: a null text or field is empty; an empty text is one empty section
without tokens; repeated rows give their sections once each; null ``doc_id`` rows are
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import kept, portions, text_of

RULES = ("first", "most", "share")
#: The characters with Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
#: Characters of a text that are encoded at once, and of the texts that are encoded together.
WHOLE, TOGETHER = 1 << 20, 1 << 18


class TokenLengths:
    """Byte lengths of texts' tokens."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)  # one character of a byte-level token stands for one byte

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > WHOLE:
            cut = _CUT.search(text, at + WHOLE)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def of(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The lengths of each text's tokens, in order."""
        held: list[tuple[str, bool]] = []  # parts, and whether a text ends with one
        size, whole = 0, []

        def encoded() -> Iterator[np.ndarray]:
            found = self.tokenizer.encode_batch_fast([p for p, _ in held], add_special_tokens=False)
            for one, (_, last) in zip(found, held, strict=True):
                whole.append(self.sizes[np.array(one.ids, np.int64)])
                if last:
                    yield np.concatenate(whole)
                    whole.clear()
            held.clear()

        for text in texts:
            *parts, last = self._parts(text)
            for part in (*((p, False) for p in parts), (last, True)):
                held.append(part)
                size += len(part[0])
                if size >= TOGETHER:
                    yield from encoded()
                    size = 0
        yield from encoded()


def token_lengths(tokenizer_json: str) -> TokenLengths:
    """This worker's lengths for a tokenizer."""
    return kept(("lengths", zlib.crc32(tokenizer_json.encode())), lambda: TokenLengths(tokenizer_json))


def allocate(lengths: np.ndarray, starts: np.ndarray, end: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and crossing tokens that count there first. ``starts`` are the sections' first bytes, ``end`` the text's."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    owner = first.copy()
    counts = np.zeros(len(starts))
    edges = np.append(starts, end)
    for k in crossing if rule != "first" else ():
        over = np.arange(first[k], last[k] + 1)
        shares = np.minimum(edges[over + 1], ends[k]) - np.maximum(edges[over], begins[k])
        if rule == "most":
            owner[k] = over[np.argmax(shares)]
        else:
            counts[over] += shares / lengths[k]
    whole = np.delete(owner, crossing) if rule == "share" else owner
    counts += np.bincount(whole, minlength=len(starts))
    return counts, np.bincount(owner[crossing], minlength=len(starts))


def _tokenizer(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())  # a file of fixed size


def _types(rule: str) -> tuple[str, pa.DataType]:
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    return ("double", pa.float64()) if rule == "share" else ("bigint", pa.int64())


def by_line(docs: DataFrame, tokenizer_path: str, rule: str = "first") -> DataFrame:
    """doc_id, section (line number from 0), start_char, end_char, n_tokens and n_crossing, a row per line of each text."""
    shared = _tokenizer(docs, tokenizer_path)
    kind, arrow = _types(rule)
    names = ["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = token_lengths(shared.value)
        for batch in portions(batches, holding=True):
            owners, found = [], []
            texts = batch.column(1).to_pylist()
            for n, (text, own) in enumerate(zip(texts, lengths.of(texts), strict=True)):
                data = np.frombuffer(text.encode(), np.uint8)
                starts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
                counts, crossing = allocate(own, starts, len(data), rule)
                heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before a byte
                edges = heads[np.append(starts, len(data))]
                owners.append(np.full(len(starts), n))
                found.append((np.arange(len(starts)), edges[:-1], edges[1:], counts, crossing))
            if found:
                ids = batch.column(0).take(pa.array(np.concatenate(owners)))
                section, start, end, counts, crossing = (np.concatenate(c) for c in zip(*found, strict=True))
                columns = [ids, pa.array(section, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(counts).cast(arrow), pa.array(crossing, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return source.mapInArrow(rows, f"doc_id bigint, section int, start_char bigint, end_char bigint, n_tokens {kind}, n_crossing bigint")


def by_field(df: DataFrame, key: str, fields: Sequence[str], tokenizer_path: str, rule: str = "first", separator: str = "\n") -> DataFrame:
    """``key``, field, n_tokens and n_crossing: the fields are joined by ``separator``, encoded once, and counted apart."""
    shared = _tokenizer(df, tokenizer_path)
    kind, arrow = _types(rule)
    fields = list(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = token_lengths(shared.value)
        for batch in portions(batches, holding=True):
            owners, found = [], []
            rows_of = list(zip(*(batch.column(k + 1).to_pylist() for k in range(len(fields))), strict=True))
            joined = [separator.join(values) for values in rows_of]
            for n, (values, whole, own) in enumerate(zip(rows_of, joined, lengths.of(joined), strict=True)):
                sizes = [len((v + separator).encode()) for v in values]
                starts = np.cumsum([0, *sizes[:-1]])
                end = len(whole.encode())
                found.append(allocate(own, np.minimum(starts, end), end, rule))
                owners.append(np.full(len(fields), n))
            if found:
                ids = batch.column(0).take(pa.array(np.concatenate(owners)))
                counts, crossing = (np.concatenate(c) for c in zip(*found, strict=True))
                columns = [ids, pa.array(fields * batch.num_rows), pa.array(counts).cast(arrow), pa.array(crossing, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [key, "field", "n_tokens", "n_crossing"])

    source = df.select(F.col(key).cast("bigint").alias(key), *(text_of(f).alias(f"f{n}") for n, f in enumerate(fields)))
    return source.mapInArrow(rows, f"`{key}` bigint, field string, n_tokens {kind}, n_crossing bigint")
