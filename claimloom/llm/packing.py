"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents are tokenized in one pass that moves no text: each task turns its rows
into pieces (document, piece number, length, checksum) of a few dozen bytes. Only
those pieces are shuffled, by a hash of their identity, so that a hot source or a
group of copies spreads evenly, and each task packs its share by bounded-space
online best fit.

A task reads its pieces in hash order through a window of ``lookahead`` pieces,
hands each window over from its longest piece to its shortest, and keeps at most
``open_bins`` open sequences. A bitset holds a 1 for every free space that some
open sequence has; the best fit is its lowest 1 at or above the piece's length.
When all are open and a new one is needed, the fullest closes first.

Defined results: a null text is an empty one; an empty text gives one piece that
holds the end id alone; repeated rows give their pieces once each; an empty table
gives no rows; null ``doc_id`` values are kept. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from struct import pack as pack_numbers
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Memo, kept, portions, segments, text_of, utf8

CONTEXT = 2048
OPEN_BINS = 32_768
LOOKAHEAD = 32_768

#: ASCII punctuation that may follow a word; the apostrophe is left out, as contractions start with it.
_TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = f"{_PIECES}, sequence_id bigint, offset bigint"


class WordIds(Memo):
    """Little-endian unsigned 32-bit ids of a white-space-free chunk, from a tokenizer that drops white space and letter case.

    Such a tokenizer never joins what white space separates, so a text's ids are
    those of its chunks one after another. A chunk that ends in ASCII punctuation
    after an ASCII letter splits there as well, and ASCII capitals are folded;
    chunks that might hold a special token are left whole. A word of small letters
    alone is one piece as it stands, and goes to the tokenizer's model at once.
    """

    def __init__(self, tokenizer_json: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__(self.encode, limit)
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
        others = iter(range(256, 512))
        self.signs = {b: b if b in plain else next(others) for b in range(256)}

    def encode(self, chunk: bytes) -> bytes:
        if b"<|" not in chunk:
            stem = chunk.rstrip(_TAIL)
            if stem and len(stem) < len(chunk) and stem[-1] in _LETTERS:
                return self[stem] + self[chunk[len(stem) :]]
            low = chunk.lower()
            if low != chunk:
                return self[low]
        word = chunk.decode("utf-8")
        if word.isalpha() and (word.isascii() or is_normalized("NFC", word) and word.lower() == word):
            if not word.isascii():
                word = chunk.decode("latin-1").translate(self.signs)
            ids = [token.id for token in self.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return pack_numbers(f"<{len(ids)}I", *ids)

    def of(self, text: bytes) -> bytes:
        return b"".join([b"".join(map(self.__getitem__, part.split())) for part in segments(text)])


def pieces(docs: DataFrame, tokenizer_path: str, context: int = CONTEXT, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``context`` tokens; only documents longer than that are cut."""
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())  # a file of fixed size
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(("words", zlib.crc32(vocabulary.value.encode())), lambda: WordIds(vocabulary.value))
        for batch in portions(batches, holding=True):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = words.of(text) + end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, context)):
                    part = ids[4 * start : 4 * (start + context)]
                    rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
            yield _batch(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), _PIECES)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return source.mapInArrow(cut, _PIECES)


def _batch(rows: list[tuple], types: tuple, schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names)


class OpenBins:
    """Bounded-space best fit. ``place`` returns a piece's bin and its offset there."""

    def __init__(self, context: int = CONTEXT, limit: int = OPEN_BINS):
        self.context, self.limit = context, limit
        self.spaces = 0  # bit f: some open bin has f free tokens
        self.by_space: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.spaces ^= 1 << space
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fits = self.spaces >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            if self.open >= self.limit:  # the fullest closes
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            space, found = self.context, self.made
            self.made += 1
        left = space - length
        if left:
            self.by_space.setdefault(left, []).append(found)
            self.spaces |= 1 << left
            self.open += 1
        return found, self.context - space


def pack(parts: DataFrame, context: int = CONTEXT, open_bins: int = OPEN_BINS, lookahead: int = LOOKAHEAD) -> DataFrame:
    """Places each piece of ``parts``; adds sequence_id and offset. Every length lies in 1..context."""

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, lookahead - rows)
                batch = batch.slice(part.num_rows)
                held.append(part)
                rows += part.num_rows
                if rows == lookahead:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(context, open_bins)
        first = TaskContext.get().partitionId() << 40
        for window in windows(batches):
            lengths = window.column("length").to_numpy()
            order = np.argsort(-lengths, kind="stable")
            placed = np.array([bins.place(n) for n in lengths[order].tolist()], dtype=np.int64).reshape(-1, 2)
            window = window.take(pa.array(order))
            window = window.append_column("sequence_id", pa.array(placed[:, 0] + first)).append_column("offset", pa.array(placed[:, 1]))
            yield from window.combine_chunks().to_batches()

    # Pieces land by hash and are read in hash order, so a task that is run again places them alike.
    identity = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = parts.repartition(identity).sortWithinPartitions(identity, "doc_id", "piece", "ids_crc32", "start", "length")
    return dealt.mapInArrow(place, _PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, context: int = CONTEXT, end_id: int = 0) -> DataFrame:
    """All documents as pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer_path, context, end_id), context)
