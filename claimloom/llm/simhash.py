"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint of 64 bits is eight positional bytes. Two fingerprints that differ in at
most two bits share at least six of them, so a pair is retained only when the tally of
what it shares reaches the guaranteed minimum, and is then verified bit by bit.

Postings of one byte each would hold a 256th of all fingerprints, and tallying their
pairs is quadratic. A posting is therefore four positional bytes at once, in the 14
choices of four places of eight whose numbers have exclusive-or zero. Any three places
lie in exactly one of these choices, so two fingerprints share one posting if they share
five bytes, three postings if they share six, seven if seven: the tally of shared
postings tells those that share six bytes from the rest, and ``LEAST_SHARED`` is three.
Equal fingerprints are one entry, so copies never meet in the index.

A list longer than ``longest`` entries (a large group of near copies) is not expanded
into pairs. Its entries are linked exactly another way: within it only the other 32 bits
may differ, and two entries differ in at most two of those if and only if some value
lies within one bit of both. Each entry is filed under the 33 values within one bit of
it; at most 33 entries can share such a value, and they are linked to the smallest of
them. A pair that meets in a long list is linked there; one that meets in short lists
alone has its whole tally there. Nothing is capped, sampled or dropped.
All joins are by sort and merge, so no table of fingerprints passes through the driver.

Defined results: a null or empty text, or one without words, has fingerprint zero and
links like any other; repeated rows give a row each; null ``doc_id`` rows link, but
never name a component; an empty table gives no rows; other columns are ignored.
``one_of_each`` keeps all columns; of each component it keeps one row, the first by
doc_id (null last), then by the hashes of the text and of the whole row, so rows under
one doc_id with unlike texts are judged apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations
from operator import xor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.llm.common import OWN, cut, merged, portions, segments, text_of, utf8
from claimloom.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
LONGEST_LIST = 64
#: Places of the four bytes of each posting; byte 0 is the lowest.
CHOICES = tuple(c for c in combinations(range(8), 4) if reduce(xor, c) == 0)
#: Postings that fingerprints share at least which share all bytes but ``MAX_BITS``.
LEAST_SHARED = sum(not {0, 1} & set(c) for c in CHOICES)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned SimHash of a text: a bit is 1 if set in over half of the shingles' hashes."""
    digest, words, total = xxhash.xxh64_digest, [], 0
    ones = np.zeros((8, 8), np.int64)
    for part in segments(text):
        words += part.lower().split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)])
        table = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        for at in range(0, len(table), 1 << 16):
            counts = np.bincount((table[at : at + (1 << 16)] + _PLACES).ravel(), minlength=2048).reshape(8, 256)
            ones += counts @ _BYTE_BITS
        total += len(table)
        words = words[len(words) - shingle + 1 :]  # the next part's first shingles begin here
    if not total:
        return int.from_bytes(digest(b" ".join(words), SEED), "big") if words else 0
    return int.from_bytes(np.packbits((2 * ones > total).ravel()).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tag (a hash of the text) and fp, the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = np.array([fingerprint(t, shingle) for t in utf8(batch.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "tag", "fp"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tag"), text_of().alias("text"))
    return source.mapInArrow(rows, "doc_id bigint, tag bigint, fp bigint")


def _byte(k: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * k).bitwiseAND(F.lit(0xFF))


def _posting(n: int) -> Column:
    """The list of a fingerprint for choice ``n``: the choice above its four bytes."""
    return reduce(Column.bitwiseOR, (F.shiftleft(_byte(k), 8 * i) for i, k in enumerate(CHOICES[n])), F.lit(n << 32))


def _verified(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)


def links(distinct: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints of ``distinct`` (fp) within two bits, directly or through others."""
    postings = distinct.select("fp", F.explode(F.array(*map(_posting, range(len(CHOICES))))).alias("list"))
    lengths = postings.groupBy("list").agg(F.count("*").alias("entries")).filter("entries > 1")
    kept = postings.join(merged(lengths), "list")
    short = kept.filter(F.col("entries") <= longest)
    tally = (
        short.select("list", F.col("fp").alias("a"))
        .join(merged(short.select("list", F.col("fp").alias("b"))), "list")
        .filter("a > b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"))
    )
    pairs = tally.filter(F.col("shared") >= LEAST_SHARED).select("a", "b")
    bits = F.array(*(F.array(*(F.lit(8 * k + i) for k in range(8) if k not in choice for i in range(8))) for choice in CHOICES))
    free = F.element_at(bits, F.shiftright("list", 32).cast("int") + 1)
    one_bit = F.transform(free, lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    balls = (
        kept.filter(F.col("entries") > longest)
        .select("fp", "list", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), one_bit)).alias("flip"))
        .select("fp", "list", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
        .groupBy("list", "centre")
        .agg(F.sort_array(F.collect_set("fp")).alias("near"))
        .filter(F.size("near") > 1)
        .select(F.explode(F.slice("near", 2, 33)).alias("a"), F.element_at("near", 1).alias("b"))
    )
    return _verified(pairs.unionByName(balls)).distinct()


def _rooted(groups: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """The rows of ``groups``, one for each fp, with the root of their component."""
    joined = connected_components(links(groups.select("fp"), longest), "simhash")
    return groups.join(merged(joined.withColumnRenamed("node", "fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, longest: int = LONGEST_LIST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links, itself included."""
    found = cut(fingerprints(docs, shingle).select("doc_id", "fp"), "fingerprints")
    rooted = _rooted(found.groupBy("fp").agg(F.min("doc_id").alias("least")), longest)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(merged(smallest), "root").select("fp", "component_id")
    return found.join(merged(named), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component."""
    doc, tag, order = f"{OWN}id", f"{OWN}tag", f"{OWN}n"
    last = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    found = cut(fingerprints(docs), "fingerprints").withColumn("doc_id", last)
    rooted = _rooted(found.groupBy("fp").agg(F.min(F.struct("doc_id", "tag")).alias("first")))
    stay = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias(doc), F.col("first.tag").alias(tag)).distinct()
    own = docs.select("*", last.alias(f"{doc}_own"), F.xxhash64("text").alias(f"{tag}_own"))
    met = own.join(merged(stay), (F.col(f"{doc}_own") == F.col(doc)) & (F.col(f"{tag}_own") == F.col(tag)), "left_semi")
    # Of rows that repeat doc_id and text one stays; each task passes one on.
    first = F.row_number().over(Window.partitionBy(f"{doc}_own", f"{tag}_own").orderBy(F.xxhash64(*docs.columns)))
    return met.withColumn(order, first).filter(F.col(order) == 1).select(*docs.columns)


def without_later_copies(docs: DataFrame, as_they_came: DataFrame) -> DataFrame:
    """The rows of ``docs`` less those whose texts were near-duplicates of an earlier document's as they came.

    For use where a stage before has cut repeats out of the texts, so that near copies no longer look
    alike. A row is judged by the text that ``as_they_came`` holds under its doc_id; rows
    without one, or with several that have unlike fingerprints, stay.
    """
    came, present = f"{OWN}came", docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    by_id = fingerprints(as_they_came).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("fp"), F.max("fp").alias("other"))
    found = cut(by_id.filter("fp = other").join(merged(present), "doc_id", "left_semi").select("doc_id", "fp"), "fingerprints")
    rooted = _rooted(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("least"))
    named = rooted.select("fp", "root").join(merged(smallest), "root").select("fp", "least")
    later = found.join(merged(named), "fp").filter("doc_id > least").select(F.col("doc_id").alias(came))
    return docs.join(merged(later), F.col("doc_id").cast("bigint") == F.col(came), "left_anti")
