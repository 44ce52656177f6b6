"""MinHash near-duplicates with min-max hashing: both ends of every permutation, banded, confirmed on full sets.

A document's set holds its distinct shingles. Each permutation of the shingles' hashes gives two values that agree for two
sets with the probability of their Jaccard similarity, its minimum and its maximum, so ``PERMUTATIONS``
evaluations give twice as many rows of signature, banded in ``ROWS``: two sets at the threshold of 0.8
share none of the 40 bands with probability 5e-6, and far fewer above it. Rows of a band are all minima or all maxima.

Documents with equal sets are one entry of the index, named by the smallest doc_id and its text's hash. What shares a
band's value is a bucket. Of a bucket only pairs of entries that no confirmed link joins yet are compared, in rounds: those
with the entry that meets most others in its buckets; then with some sixty-four entries, then with as many times more, until every pair of every bucket is
compared or known to be in one component, or cannot be similar by what each shares with the bucket's first, or by their
parities: each shingle turns one of ``PARITIES`` bits of its set, so two sets differ in at least as many shingles as bits. Both bounds are exact, so no pair is
given up, and nothing is capped or sampled; texts are compared for a few pairs an entry. Parities are still met pair by pair in what is left of a bucket.
A pair is confirmed on the shingles of both texts; sizes
that rule out the threshold are dropped before. Texts move only for entries that a bitmap of
fixed size (8 MB, broadcast) has among the pairs.

Defined results: null, empty and blank texts have the empty set, ``n_shingles`` 0 and no links; a text of fewer words
than a shingle is one shingle; repeated rows give a row each, and rows under one doc_id with unlike texts are judged apart; rows
without doc_id link, but name no component and are not ``kept``; a component of such rows alone has no id; an empty table gives
no rows; other columns are ignored. Shingles are told apart by 64-bit hashes, sets by 128-bit hashes of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import OWN, Memo, cut, discard, merged, portions, segments, text_of, utf8, written
from claimloom.llm.components import connected_components

SHINGLE = 2
PERCENT = 80
PERMUTATIONS = 120
ROWS = 6
BANDS = 2 * PERMUTATIONS // ROWS
#: Times as many entries of a bucket that each round compares with the others.
MORE = 64
#: Bits of a set's parities.
PARITIES = 1024
_BITS = 1 << 26
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(13)
_FACTORS = _RANDOM.integers(0, 1 << 32, (PERMUTATIONS, 1), np.uint32) | np.uint32(1)
_TERMS = _RANDOM.integers(0, 1 << 32, (PERMUTATIONS, 1), np.uint32)
_CHUNK = 512


def _hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of the shingles of a sequence of hashed words; of the whole sequence if it is shorter."""
    shingle = min(shingle, len(words))
    found = words[: len(words) - shingle + 1] * _MIX
    for k in range(1, shingle):
        found = ((found ^ (found >> np.uint64(32))) + words[k : len(words) - shingle + 1 + k]) * _MIX
    return found ^ (found >> np.uint64(29))


def shingles(text: bytes, memo: Memo, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    parts, rest = [], np.zeros(0, np.uint64)
    for part in segments(text):
        words = part.lower().split()
        rest = np.concatenate([rest, np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))])
        if len(rest) >= shingle:
            parts.append(np.unique(_hashes(rest, shingle)))
            rest = rest[len(rest) - shingle + 1 :]
    if not parts:
        return _hashes(rest, shingle) if len(rest) else rest
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def signature(found: np.ndarray) -> np.ndarray:
    """The minima, then the maxima, of all permutations of 32 bits of the hashes."""
    values, low, high = (found >> np.uint64(32)).astype(np.uint32), np.full(PERMUTATIONS, (1 << 32) - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(values), _CHUNK):
        places = _FACTORS * values[at : at + _CHUNK]
        places += _TERMS
        np.minimum(low, places.min(1), out=low)
        np.maximum(high, places.max(1), out=high)
    return np.concatenate([low, high]).astype(np.uint64)


def bands(found: np.ndarray) -> np.ndarray:
    """One signed hash a band."""
    rows = signature(found).reshape(BANDS, ROWS)
    value = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        value = ((value ^ (value >> np.uint64(31))) + rows[:, k]) * _MIX
    return value.view(np.int64)


def parities(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of the hashes falls on each of ``PARITIES`` places, as bits of signed numbers."""
    odd = np.bincount((found % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_NONE = (1 << 63) - 1
_ENTRY = "struct<id: bigint, text: bigint>"


def _name() -> Column:
    """What tells a row's text from all others: doc_id (the last number for none) and a hash of the text."""
    return F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NONE)).alias("id"), F.xxhash64(text_of()).alias("text"))


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """named, n_shingles, tag (equal for equal sets), bands and parities of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh64_intdigest)
        for batch in portions(batches):
            sets = [shingles(t, memo, shingle) for t in utf8(batch.column(1))]
            keys = [bands(s) if len(s) else None for s in sets]
            odd = [parities(s) if len(s) else None for s in sets]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), *(pa.array(c, pa.list_(pa.int64())) for c in (keys, odd))]
            yield pa.RecordBatch.from_arrays(columns, ["named", "n_shingles", "tag", "bands", "parities"])

    return docs.select(_name().alias("named"), text_of().alias("text")).mapInArrow(rows, f"named {_ENTRY}, n_shingles bigint, tag binary, bands array<bigint>, parities array<bigint>")


def compared(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of ``texts`` (entry, text) with the number of shingles in ``both``, and whether they are ``linked``, as similar as ``percent`` says."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last, own = Memo(xxhash.xxh64_intdigest), None, np.zeros(0, np.uint64)
        for batch in portions(batches, 100):
            shared, keep = [], []
            for one, other in zip(utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
                if other != last:
                    last, own = other, shingles(other, memo, shingle)
                found = shingles(one, memo, shingle)
                both = len(np.intersect1d(own, found, True))
                shared.append(both)
                keep.append(100 * both >= percent * (len(own) + len(found) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(keep, pa.bool_())], ["a", "b", "both", "linked"])

    moved = _among(texts, pairs.select(F.explode(F.array("a", "b")).alias("entry"))).groupBy("entry").agg(F.first("text").alias("text"))
    one = moved.select(F.col("entry").alias("a"), F.col("text").alias("one"))
    other = moved.select(F.col("entry").alias("b"), F.col("text").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(rows, f"a {_ENTRY}, b {_ENTRY}, both bigint, linked boolean")


def _among(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """``rows`` less those whose entry is surely not in ``entries``, by one bit for each hashed entry."""
    bit = F.pmod(F.xxhash64("entry"), F.lit(_BITS)) + 1
    part, place = F.call_function("bitmap_bucket_number", bit), F.call_function("bitmap_bit_position", bit)
    bitmaps = entries.groupBy(part.alias(f"{OWN}part")).agg(F.call_function("bitmap_construct_agg", place).alias(f"{OWN}bits"))
    byte = F.conv(F.hex(F.substring(F.col(f"{OWN}bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(bitmaps), part == F.col(f"{OWN}part"))
    return met.filter(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1).select(*rows.columns)


def _merged(roots: DataFrame | None, links: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) of what is linked after more ``links``, and where it lies: only the components that links join are joined anew."""
    if roots is None:
        return written(connected_components(links, "minhash"), "roots")
    for end in ("a", "b"):
        links = links.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left").withColumn(end, F.coalesce(f"{end}_root", end))
    joined = cut(connected_components(links.select("a", "b"), "minhash"), "joined")
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return written(moved.unionByName(joined.join(roots.select("node"), "node", "left_anti")), "roots")


def _unlike(a: str, b: str) -> Column:
    """In how many bits two columns of parities differ, at most the number of shingles that are in one set alone."""
    return reduce(add, (F.bit_count(F.col(a)[n].bitwiseXOR(F.col(b)[n])) for n in range(PARITIES // 64)))


def _beside(one: DataFrame, other: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Pairs of rows with one bucket; ``columns`` are named anew, with the side at the end."""
    side = lambda rows, x: rows.select("bucket", *(F.col(c).alias(f"{name}_{x}" if name else x) for c, name in columns))
    return side(one, "a").join(merged(side(other, "b")), "bucket")


def _components(buckets: DataFrame, odd: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame | None:
    """(node, root) of the entries that links join, from ``buckets`` (bucket, entry, n, degree) and ``odd`` (entry, parities); None if nothing is linked."""
    spark = buckets.sparkSession
    roots, roots_at, known, open_at, done, most = None, None, None, None, 1, 1
    while True:
        if roots is None:
            now = buckets.withColumn("root", F.col("entry"))
        else:
            now = buckets.join(roots.withColumnRenamed("node", "entry"), "entry", "left").withColumn("root", F.coalesce("root", "entry"))
        # A number from 0 to 1 by the entry's hash; about ``most`` of a bucket are under ``most / size``.
        now = now.withColumn("at", F.xxhash64("entry").cast("double") / F.lit(2.0**64) + 0.5).withColumn("mark", F.xxhash64("root"))
        sizes = now.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct((-F.col("degree")).alias("less"), "at", "entry", "mark")).alias("first"), F.min("mark").alias("least"), F.max("mark").alias("last"))
        sizes, sizes_at = written(sizes.filter((F.col("size") > done) & (F.col("least") < F.col("last"))).select("bucket", "size", F.col("first.entry").alias("first"), F.col("first.mark").alias("main")), "sizes")
        if sizes.isEmpty():  # all pairs of every bucket are compared, or in one component
            if open_at:
                discard(spark, open_at)
            return roots
        open_, first = now.join(sizes, "bucket"), F.col("entry") == F.col("first")
        near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        carried = [("entry", ""), ("n", "n"), ("mark", "mark"), ("at", "at"), ("main", "main")]
        if most == 1:
            pairs = _beside(open_.filter(first), open_, carried).filter((F.col("a") != F.col("b")) & near)
        else:
            if open_at is None:
                met = known.select(F.col("a").alias("first"), F.col("b").alias("entry"), F.col("both").alias("with_first"))
                open_ = open_.join(merged(met), ["first", "entry"], "left").join(merged(odd), "entry")
            # Later rounds read what is open now: a bucket that is done, or in one component, stays so.
            before = open_at
            open_, open_at = written(open_, "open")
            if before:
                discard(spark, before)
            buckets = open_.select("bucket", "entry", "n", "degree", "with_first", "parities")
            carried += [("with_first", "f"), ("parities", "odd")]
            # What two entries share is at most what both share with the bucket's first, and as much of the rest as the lesser has.
            bound = F.least("f_a", "f_b") + F.least(F.col("n_a") - F.col("f_a"), F.col("n_b") - F.col("f_b"))
            told = F.col("f_a").isNotNull() & F.col("f_b").isNotNull()
            both = F.col("n_a") + F.col("n_b")
            near &= ~told | (100 * bound >= percent * (both - bound))
            near &= (100 + percent) * _unlike("odd_a", "odd_b") <= (100 - percent) * both
            # Of entries in two components, one at least is not in the first's. The first has met all others already.
            chosen, apart = (F.col("size") <= most) | (F.col("at") * F.col("size") < most), F.col("mark") != F.col("main")
            once = (F.col("mark_b") == F.col("main_b")) | (F.col("at_b") > F.col("at_a")) | ((F.col("at_b") == F.col("at_a")) & (F.col("b") > F.col("a")))
            pairs = _beside(open_.filter(apart & chosen), open_.filter(~first), carried).filter((F.col("mark_a") != F.col("mark_b")) & once & near)
            others = _beside(open_.filter(apart & ~chosen), open_.filter(~first & ~apart & chosen), carried).filter(near)
            pairs = pairs.select("a", "b").unionByName(others.select("a", "b"))
        pairs = pairs.select("a", "b").distinct()
        asked, asked_at = written(pairs, "pairs")
        found, found_at = written(compared(asked, texts, shingle, percent), "compared")
        links = found.filter("linked").select("a", "b")
        if not links.isEmpty():
            before = roots_at
            roots, roots_at = _merged(roots, links)
            if before:
                discard(spark, before)
        if known is None:
            known = found
        else:
            discard(spark, found_at)
        discard(spark, asked_at)
        discard(spark, sizes_at)
        done, most = max(2, most), most * MORE


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable, itself included) and kept, of every row."""
    sketched, place = written(sketches(docs, shingle), "sketches")
    entries = cut(sketched.filter("n_shingles > 0").groupBy("tag").agg(F.min("named").alias("entry"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("parities").alias("parities")), "entries")
    members = cut(sketched.select("named", "n_shingles", "tag"), "members")
    discard(docs.sparkSession, place)
    postings = entries.select("entry", "n", F.explode("bands").alias("bucket"))
    shared = postings.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met, met_at = written(postings.join(shared, "bucket"), "met")
    # In a group of near copies the text that the others came from meets most of them.
    buckets = cut(met.drop("size").join(met.groupBy("entry").agg(F.sum("size").alias("degree")), "entry"), "buckets")
    discard(docs.sparkSession, met_at)
    roots = _components(buckets, entries.select("entry", "parities"), docs.select(_name().alias("entry"), text_of().alias("text")), shingle, percent)
    named = entries.select("tag", F.col("entry").alias("root"))
    if roots is not None:
        named = entries.select("tag", "entry").join(roots.withColumnRenamed("node", "entry"), "entry", "left").select("tag", F.coalesce("root", "entry").alias("root"))
    given = lambda column: F.when(F.col(column) < _NONE, F.col(column))
    found = members.join(named, "tag", "left").select(given("named.id").alias("doc_id"), "n_shingles", F.coalesce("root", "named").alias("component"))
    return found.select("doc_id", "n_shingles", given("component.id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def oracle_sql(percent: int = PERCENT) -> str:
    """The same over all pairs that share a shingle, for two words and unlike doc_ids."""
    return f"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), shingled AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS shingle FROM worded
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
    ), pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
      SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)
    ), reached AS (
      SELECT doc_id AS a, doc_id AS b FROM documents
      UNION
      SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
    )
    SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.b) AS component_id, min(r.b) = d.doc_id AS kept
    FROM documents d JOIN reached r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""
