"""Phrase collocations: sketch upper bounds, automata over shards, exact scores.

Two passes fill a counting sketch with hashed phrases: one with words and pairs, one with
phrases of three to five words whose pairs all may be frequent. A counter is an upper bound of the counts
of all phrases that share it, so a phrase under ``least`` there is under it in truth, and
a phrase can only reach ``least`` if all its parts may. What is left of a sketch is one
bit a counter, which is broadcast: 128 MB at the ``MOST_COUNTERS``, a quarter of it for the longer phrases. Counters grow with the texts up
to that number; beyond it bounds get looser, which makes more work and never another result.

The third pass scans shards, blocks of the texts of one language inside a task. The candidates
of a shard, the phrases in it that the bounds leave, are compiled into an automaton whose
keys stand between guards (``" a b "``, pieces end in a line of their own), and one scan of the shard
counts every match, overlaps included. So an automaton is as large as its shard allows, whatever the corpus holds. The counts of all
shards are summed and only then held against ``least``: a frequent phrase is a candidate
in every shard where it stands, so its sum is exact, and so are those of its parts.

Scores, cuts and the dropping of phrases inside longer ones are joins over what is frequent.

Defined results: a null text is empty; a null lang is ``und``; repeated rows count as often as they
stand; an empty table gives no rows; a language whose words never make a frequent phrase has no row; ties go by
the phrase's UTF-8 bytes; other columns are ignored. Phrases are told apart by 64-bit hashes within a shard.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import cut, portions, segments, text_of, utf8

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of pending shards in a task; the largest is scanned when there are more.
SHARD_BYTES = 1 << 22
#: Sums that a task holds before it passes them on.
SUMS = 600_000
TASK_CHARS = 1 << 28
MOST_COUNTERS = 1 << 30
LEAST_COUNTERS = 1 << 20
_CHARS_A_COUNTER = 8
_SLICE = 1 << 16
_PIECE_ENDS = re.compile(rb"[.,;:!?\n-\r]")
_BREAK = b"\xff"  # no UTF-8 text holds this byte
_GUARDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
_MIX, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: A value for each byte, of which a word's hash is a sum weighted by place.
_VALUES = np.frombuffer(b"".join(xxhash.xxh64_digest(bytes([b])) for b in range(256)), np.uint64)


class Shard:
    """Texts of one language, where their words begin and end, and the hashes of the phrases that begin at each."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang, self.text = lang, _BREAK.join(texts).lower().translate(_GUARDS)
        raw = np.frombuffer(self.text, np.uint8)
        broken = raw == _BREAK[0]
        inside = np.concatenate([[False], ~(broken | (raw == 32)), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.pieces = np.cumsum(broken, dtype=np.int32)[self.starts] if len(raw) else np.zeros(0, np.int32)
        lengths = self.ends - self.starts
        if not len(lengths):
            self.hashes = []
            return
        letters = np.flatnonzero(inside[1:-1])
        weights = np.cumprod(np.full(lengths.max(), _NEXT))
        values = _VALUES[raw[letters]] * weights[letters - np.repeat(self.starts, lengths)]
        begins = np.cumsum(lengths) - lengths
        self.hashes = [(np.add.reduceat(values, begins) * _MIX) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))]
        for k in range(1, min(LONGEST, len(lengths))):
            self.hashes.append(self.hashes[-1][:-1] * _MIX + self.hashes[0][k:])

    def phrase(self, at: int, k: int) -> str:
        return " ".join(self.text[self.starts[i] : self.ends[i]].decode() for i in range(at, at + k))

    def counters(self, k: int, at: np.ndarray, bits: int) -> np.ndarray:
        """The counters of the phrases of ``k`` words at these places."""
        mixed = (self.hashes[k - 1][at] + np.uint64(k)) * _NEXT
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _MIX) >> np.uint64(64 - bits)).astype(np.uint32)

    def places(self, sketches: list[np.ndarray], longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
        """By k, where phrases begin that may be frequent by the sketches, and whose parts may be."""
        open_ = np.ones(len(self.starts), bool)
        for k in range(1, min(longest, len(self.hashes)) + 1):
            if k > 1:
                open_ = open_[:-1] & open_[1:] & (self.pieces[k - 1 :] == self.pieces[: 1 - k])
            at = np.flatnonzero(open_)
            sketch = sketches[k > 2] if len(sketches) > (k > 2) else None
            if sketch is not None:
                counter = self.counters(k, at, sketch.size.bit_length() + 2)
                at = at[(sketch[counter >> np.uint32(3)] >> (counter & np.uint32(7)).astype(np.uint8)) & 1 == 1]
                open_ = np.zeros(len(open_), bool)
                open_[at] = True
            yield k, at


def _shards(batches: Iterator[pa.RecordBatch], size: int = SHARD_BYTES) -> Iterator[Shard]:
    """Texts (lang, text) by language; holds about ``size`` bytes of them, and the last part of a text. No piece is parted."""
    pending: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in portions(batches, 200):
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            for part in segments(text, size // 4, _PIECE_ENDS):
                pending.setdefault(lang, []).append(part)
                sizes[lang] += len(part) + 1
                if sizes.total() >= size:
                    most = sizes.most_common(1)[0][0]
                    del sizes[most]
                    yield Shard(most, pending.pop(most))
    for lang, texts in pending.items():
        yield Shard(lang, texts)


def _filled(bits: int, low: int, high: int, sketches: list) -> Callable:
    """Parts of a sketch of ``2 ** bits`` counters with the phrases of ``low`` to ``high`` words: (slice, counters and counts)."""

    def sliced(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        counters = np.sort(np.concatenate(parts))
        first = np.flatnonzero(np.diff(counters, prepend=counters[:1] ^ np.uint32(1)))
        times = np.minimum(np.diff(first, append=len(counters)), 255).astype(np.uint8)
        counters = counters[first]
        slices = (counters >> np.uint32(16)).astype(np.int32)
        starts = np.flatnonzero(np.diff(slices, prepend=-1))
        pack = zstandard.ZstdCompressor(level=1).compress
        for group in np.array_split(starts, max(1, len(starts) // 256)):
            rows = []
            for at in group:
                end = starts[np.searchsorted(starts, at, "right")] if at < starts[-1] else len(counters)
                rows.append(pack((counters[at:end] & np.uint32(_SLICE - 1)).astype(np.uint16).tobytes() + times[at:end].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(slices[group]), pa.array(rows, pa.binary())], ["slice", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, size = [_bitmap(x) for x in sketches], [], 0
        for shard in _shards(batches):
            for k, at in shard.places(known, high):
                if low <= k and len(at):
                    parts.append(shard.counters(k, at, bits))
                    size += len(at)
            if size >= 1 << 23:
                yield from sliced(parts)
                parts, size = [], 0
        if parts:
            yield from sliced(parts)

    return run


def _summed(least: int) -> Callable:
    """One bit a counter, by slices; rows come in the order of slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        now, counts = -1, np.zeros(_SLICE, np.int64)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(counts >= least, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != now:
                    if now >= 0 and (counts >= least).any():
                        yield row()
                    now = number
                    counts[:] = 0
                part = unpack(part)
                n = len(part) // 3
                counts[np.frombuffer(part, np.uint16, n)] += np.frombuffer(part, np.uint8, n, 2 * n)
        if now >= 0 and (counts >= least).any():
            yield row()

    return run


def _bitmap(shared) -> np.ndarray:
    return np.frombuffer(shared.value, np.uint8)


def _sketch(texts: DataFrame, bits: int, low: int, high: int, least: int, sketches: list):
    """The broadcast bits of a sketch over the phrases of ``low`` to ``high`` words."""
    spark = texts.sparkSession
    # A count that a part holds at most 255 of is cut there, so no higher bound can be told.
    parts = texts.mapInArrow(_filled(bits, low, high, sketches), "slice int, part binary")
    found = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_summed(min(least, 255)), "slice int, bits binary").toLocalIterator()
    whole = bytearray(2**bits // 8)
    for row in found:
        whole[row.slice * _SLICE // 8 : (row.slice + 1) * _SLICE // 8] = row.bits
    return spark.sparkContext.broadcast(bytes(whole))


def _scanned(sketches: list) -> Callable:
    """(lang, phrase, f) of the candidates of a task's shards, and rows without phrase with their numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_bitmap(x) for x in sketches]
        sums: Counter = Counter()

        def rows() -> pa.RecordBatch:
            langs, phrases = zip(*sums, strict=True)
            found = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(list(sums.values()), pa.int64())], ["lang", "phrase", "f"])
            sums.clear()
            return found

        for shard in _shards(batches):
            phrases: list[str] = []
            for k, at in shard.places(known):
                _, first = np.unique(shard.hashes[k - 1][at], return_index=True)
                phrases += [shard.phrase(p, k) for p in at[first].tolist()]
            sums[shard.lang, None] += len(shard.starts)
            for phrase, f in zip(phrases, counted(phrases, shard.text).tolist(), strict=True):
                sums[shard.lang, phrase] += f
            if len(sums) >= SUMS:
                yield rows()
        if sums:
            yield rows()

    return run


def counted(phrases: list[str], text: bytes) -> np.ndarray:
    """How often each phrase stands in the pieces of the text, overlaps included."""
    if not phrases:
        return np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for n, phrase in enumerate(phrases):
        automaton.add_word(f" {phrase} ", n)
    automaton.make_automaton()
    spaced = b" ".join(text.replace(_BREAK, b" \xff ").split()).replace(_BREAK, b"\n").decode()
    matches = np.fromiter((n for _, n in automaton.iter(f" {spaced} ")), np.int64)
    return np.bincount(matches, minlength=len(phrases))


def frequent(docs: DataFrame, least: int = LEAST, counters: int | None = None) -> DataFrame:
    """(lang, phrase, f): phrases of one to five words with f of ``least`` or more; without phrase, the words of the language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    if counters is None:
        counters = min(MOST_COUNTERS, max(LEAST_COUNTERS, chars // _CHARS_A_COUNTER))
    bits = max(16, (counters - 1).bit_length())
    sketches = [_sketch(texts, bits, 1, 2, least, [])]
    sketches.append(_sketch(texts, max(16, bits - 2), 3, LONGEST, least, sketches))
    # A task sums over more than one split, up to ``TASK_CHARS`` or two tasks a core, so that fewer rows meet in the shuffle.
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, 1 + chars // TASK_CHARS)
    sums = texts.coalesce(tasks).mapInArrow(_scanned(sketches), "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return cut(sums.filter((F.col("f") >= least) | F.col("phrase").isNull()), "phrases")


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, counters: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    found = frequent(docs, least, counters)
    sizes = found.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    phrases = found.filter("phrase IS NOT NULL")
    part = lambda side: phrases.select(F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(side[0]))
    words = F.split("phrase", " ")
    candidates = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).filter(F.size("words") > 1)
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right")
    )
    scored = cuts.join(part("left"), ["lang", "left"]).join(part("right"), ["lang", "right"]).join(sizes, "lang").withColumn("up", F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("n"))
    scored = scored.withColumn("down", _whole("l") * _whole("r")).withColumn("score", F.expr("CAST(up div down AS BIGINT)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("words") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " ")))))
    within = candidates.filter(F.size("words") > 2).select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    stay = lowest.join(within, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    rows = stay.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # Each of 64 parts of a language passes on its first rows, so the last window sees 64 * top of them at most.
    early = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = early.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same from counts of all phrases."""
    spans = "\n      UNION ALL ".join(f"SELECT lang, {k} AS size, array_to_string(words[i:i + {k - 1}], ' ') AS phrase FROM places WHERE i + {k - 1} <= len(words)" for k in range(1, LONGEST + 1))
    return f"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ), worded AS (
      SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
    ), places AS (
      SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded
    ), sizes AS (
      SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
    ), counts AS (
      SELECT lang, size, phrase, count(*) AS f FROM (
        {spans}
      ) GROUP BY ALL HAVING count(*) >= {least}
    ), candidates AS (
      SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS words FROM counts WHERE size > 1
    ), cuts AS (
      SELECT *, unnest(range(1, size)) AS k FROM candidates
    ), scored AS (
      SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, s.n,
             CAST((CAST(1000 AS HUGEINT) * c.a * s.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM cuts c JOIN sizes s USING (lang)
      JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
      JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:], ' ')
    ), lowest AS (
      SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), stay AS (
      SELECT * FROM lowest s WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = s.lang AND c.phrase <> s.phrase
        AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * c.a >= 100 * s.a)
    )
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay
    ) WHERE rank <= {top}"""
