"""Spelling variants: a positional q-gram inverted index with count filter.

Words one edit apart have nearly all q-grams in common, at places that are equal or, behind an inserted
letter, one apart. A word of m letters, padded, has m + q - 1 of them; one edit spoils q in
the longer word at most, so a pair shares ``max(m) - 1`` (the count filter), and of the q + 1 rarest of each word
one is shared at fitting places: in an order of all q-grams, the first that a pair shares has at most q before it on either side.

So only the q + 1 rarest postings of each word are shuffled, by q-gram, place and length:
the word as an entry there, and as a probe where words longer by one have the q-gram at the same place or one behind.
What meets is a small positional index of its own in a task, whose lists are cut by length and position. A probe takes its lists
there, sets the longest aside, merges the shortest with a heap, so many that no word over the bound can
miss them all, completes the count in the long ones by bisection, and keeps what reaches the bound; an edit check verifies it. A
pair that meets under several q-grams is reported under the first alone.

The order of q-grams is by the counts of 2 ** 16 hashed classes, which is all that is broadcast. Words
are counted in tasks before the shuffle.

Defined results: null and empty texts have no words; repeated rows count as often as they stand; a null
``doc_id`` spells like one without digits (``:run``); texts of any length are read whole; an empty table gives no rows; words may be of any length; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from heapq import merge
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import OWN, cut, discard, portions, text_of, written

Q = 4
LEAST_LETTERS = 5
LEAST_TIMES = 3
DROPPED = 97
#: Distinct words that a task counts before it passes them on.
COUNTED = 300_000
CLASSES = 1 << 16
#: Occurrences of a q-gram's class for which its entries are split once more.
SPLIT = 200_000
_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_BEGIN, _END = "<", ">"
_ALIKE = 2


def spelled(run: bytes, crc: int) -> bytes:
    """The run, less a letter where the checksum says so."""
    if crc % DROPPED:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """The words of a text in Latin-1, where every letter is a byte, and how often each stands."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    crc32 = zlib.crc32
    for run, times in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        word = spelled(run, crc32(run if run.isascii() else run.decode("latin-1").encode(), start))
        if len(word) >= LEAST_LETTERS:
            yield word, times


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in portions(batches, 200):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for word, times in words_of(doc_id, text):
                counts[word] = counts.get(word, 0) + times
            if len(counts) >= COUNTED:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words with three occurrences or more."""
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(_counted, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def grams(word: str, q: int = Q) -> list[str]:
    padded = _BEGIN * (q - 1) + word + _END * (q - 1)
    return [padded[i : i + q] for i in range(len(word) + q - 1)]


def _class(gram: str) -> int:
    return zlib.crc32(gram.encode()) % CLASSES


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES, np.int64)
    for batch in portions(batches):
        for word in batch.column(0).to_pylist():
            np.add.at(counts, [_class(g) for g in grams(word)], 1)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found])], ["class", "n"])


def _postings(frequency, split: int) -> Callable:
    """Entries and probes of each word: (key, shift, word, n, places).

    ``shift`` is -1 for an entry, and for a probe how far behind longer words have the q-gram, or ``_ALIKE``
    for a probe among words of its length. The entries of a q-gram whose class has over ``split`` occurrences
    are dealt to parts by their word, and its probes go to every part; elsewhere entries probe each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.frombuffer(frequency.value, np.int64)
        for batch in portions(batches):
            rows: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rarest = sorted((times[_class(g)], g, at) for at, g in enumerate(grams(word)))[: Q + 1]
                places = np.array([at for *_, at in rarest], np.int32).tobytes()
                for often, gram, at in rarest:
                    parts = 1 + int(often) // split
                    rows.append((f"{gram}{at},{len(word)},{zlib.crc32(word.encode()) % parts}", -1, word, n, places))
                    for part in range(parts):
                        if parts > 1:
                            rows.append((f"{gram}{at},{len(word)},{part}", _ALIKE, word, n, places))
                        rows += [(f"{gram}{at + shift},{len(word) + 1},{part}", shift, word, n, places) for shift in (0, 1)]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int8(), pa.string(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shift", "word", "n", "places"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes the words equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


class Index:
    """A positional inverted index over some words: lists of word numbers by q-gram and place."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lists: dict[tuple[str, int], list[int]] = {}
        for n, word in enumerate(words):
            for at, gram in enumerate(grams(word)):
                self.lists.setdefault((gram, at), []).append(n)

    def probe(self, word: str, longer: int, after: int = -1) -> list[int]:
        """Numbers over ``after`` of the words, ``longer`` by so many letters, that share as many q-grams with ``word`` as one edit leaves.

        The lists of a q-gram are those at its place and, where words are longer, one behind.
        """
        bound = len(word) + longer - 1
        lists = []
        for at, gram in enumerate(grams(word)):
            lists += [found for shift in range(longer + 1) if (found := self.lists.get((gram, at + shift)))]
        if len(lists) < bound:
            return []
        lists.sort(key=len)
        short, long = lists[: len(lists) - bound + 1], lists[len(lists) - bound + 1 :]
        out = []
        for n, same in groupby(merge(*short)):
            if n > after:
                count = sum(1 for _ in same)
                for left, found in enumerate(long):
                    if count + len(long) - left < bound:
                        break
                    at = bisect_left(found, n)
                    count += at < len(found) and found[at] == n
                if count >= bound:
                    out.append(n)
        return out


def _first_meeting(a: str, places_a: bytes, b: str, places_b: bytes, longer: int) -> tuple[int, int]:
    """Place and shift of the first of a's rarest q-grams that is one of b's at a fitting place."""
    of_a, of_b, there = grams(a), grams(b), set(np.frombuffer(places_b, np.int32).tolist())
    for at in np.frombuffer(places_a, np.int32).tolist():
        for shift in range(longer + 1):
            if at + shift in there and of_a[at] == of_b[at + shift]:
                return at, shift
    raise ValueError(f"{a} and {b} do not meet")


def _met(key: str, entries: list[tuple], probes: list[tuple], among: bool) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near word, its n) of the pairs that meet under a key and under none before it; entries meet each other if ``among``."""
    place = int(key[Q:].split(",")[0])
    index = Index([w for w, _, _ in entries])
    found = [(entry, index.probe(entry[0], 0, n), 0, 0) for n, entry in enumerate(entries)] if among and len(entries) > 1 else []
    found += [(probe, index.probe(probe[0], int(shift != _ALIKE)), int(shift != _ALIKE), shift % _ALIKE) for shift, *probe in probes]
    for (a, n, places), others, longer, shift in found:
        for other in others:
            b, m, there = entries[other]
            if (longer or a < b) and one_edit(a, b) and _first_meeting(a, places, b, there, longer) == (place - shift, shift):
                yield a, n, b, m


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs in both directions, from postings in the order of key, entries first."""

    def rows() -> Iterator[tuple]:
        for batch in portions(batches, 5000):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out: list[tuple[str, int, str, int]] = []

    def sent() -> pa.RecordBatch:
        both = [(a, b, m) for a, _, b, m in out] + [(b, a, n) for a, n, b, _ in out]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in both], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))], ["word", "near", "near_n"])

    for key, group in groupby(rows(), itemgetter(0)):
        entries, probes, among = [], [], True
        for _, shift, word, n, places in group:
            if shift < 0:
                entries.append((word, n, places))
            elif entries:
                among &= shift != _ALIKE
                probes.append((shift, word, n, places))
        if entries and (probes or len(entries) > 1):
            out += _met(key, entries, probes, among)
        if len(out) >= 20_000:
            yield sent()
    if out:
        yield sent()


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """(word, near, near_n): every pair one edit apart, in both directions, of ``words`` (word, n), each once."""
    spark = words.sparkSession
    counts = np.zeros(CLASSES, np.int64)
    for row in words.select("word").mapInArrow(_classes, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[row["class"]] = row["n"]
    postings = words.select("word", "n").mapInArrow(_postings(spark.sparkContext.broadcast(counts.tobytes()), split), "key string, shift byte, word string, n bigint, places binary")
    return postings.repartition("key").sortWithinPartitions("key", "shift", "word").mapInArrow(_pairs, "word string, near string, near_n bigint")


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last form on the way from each word.

    A form has twice its word's occurrences, so no way is longer than their logarithm, and every
    round halves what is left of it. A round is written to the shared folder and the one before deleted.
    """
    spark = forms.sparkSession
    now, place = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        before, further = place, now.select(F.col("word").alias("root"), F.col("root").alias(f"{OWN}next"))
        moved = now.join(further, "root", "left")
        now, place = written(moved.select("word", F.coalesce(f"{OWN}next", "root").alias("root")), "roots")
        discard(spark, before)
        if now.join(forms.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word with the near word that it may be a misspelling of."""
    words = cut(vocabulary(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = (-F.col("best.less") >= 2 * F.col("n"))
    named = words.join(near, "word", "left").select(
        "word",
        F.when(formed, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, -F.col("best.less")).alias("form_n"),
    )
    found = cut(named, "forms")
    roots = rooted(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
