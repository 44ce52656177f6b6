"""Facts: grounding of quotes, acceptance, clusters of one subject, groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from claimloom.functions.text import loose, subject_key
from claimloom.operators import numbering
from claimloom.session import cut

#: Characters of the quotes that are matched in one pass over the texts.
BLOCK_CHARS = 2_000_000
_QUOTE, _TEXT = "__quote", "__text"
_built: list = []


def _automaton(name: str, shared: Broadcast) -> tuple[pa.Array, list[list[int]], ahocorasick.Automaton]:
    """Ids, their numbers by pattern, and the automaton of a block of quotes; a worker keeps one from task to task."""
    if not _built or _built[0] != name:
        _built.clear()
        table = pa.ipc.open_stream(shared.value).read_all()
        numbers: dict[str, list[int]] = {}
        for n, quote in enumerate(table.column(1).to_pylist()):
            numbers.setdefault(quote, []).append(n)
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, quote in enumerate(numbers):
            found.add_word(quote, n)
        found.make_automaton()
        _built[:] = [name, (table.column(0).combine_chunks(), list(numbers.values()), found)]
    return _built[1]


def _holding(name: str, shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id of a quote, id of a text) of what each text (id, text) holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, numbers, automaton = _automaton(name, shared)

        def rows(batch: pa.RecordBatch, held: list[int], holder: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids.take(pa.array(held)), batch.column(0).take(pa.array(holder))], ["quote", "document"])

        for batch in batches:
            held: list[int] = []
            holder: list[int] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                for pattern in {n for _, n in automaton.iter(text)}:
                    held += numbers[pattern]
                    holder += [row] * len(numbers[pattern])
                if len(held) >= 100_000:
                    yield rows(batch, held, holder)
                    held, holder = [], []
            if held:
                yield rows(batch, held, holder)

    return run


def grounded_pairs(quotes: DataFrame, documents: DataFrame, quote: str, quote_text: str, document: str, text: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(quote, document) where the loose quote is a contiguous passage of the loose document; empty quotes are in none.

    A contains-join has no equi key. Quotes are compiled into automata, in blocks of about ``block_chars``
    characters that are dealt by hash, and one scan of a text finds all quotes of a block in it, of
    whatever length. A block is collected, broadcast and kept by a worker while its pass lasts, some 50 bytes a character; texts
    are not shuffled, and no key is hot.
    """
    q = quotes.select(quote, loose(F.col(quote_text)).alias(_QUOTE)).filter(F.col(_QUOTE) != "")
    d = documents.select(document, loose(F.col(text)).alias(_TEXT)).filter(F.col(_TEXT) != "")
    kind = lambda df, name: df.select(F.col(name)).schema[0].dataType
    schema = StructType([StructField("quote", kind(q, quote)), StructField("document", kind(d, document))])
    chars = q.agg(F.sum(F.length(_QUOTE))).first()[0] or 0
    blocks = -(-chars // block_chars)
    if blocks > 1:
        q = cut(q, "quotes")
    found = documents.sparkSession.createDataFrame([], schema)
    for n in range(blocks):
        rows = q.filter(F.pmod(F.xxhash64(_QUOTE), F.lit(blocks)) == n).toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as stream:
            stream.write_table(rows)
        shared = documents.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
        found = found.unionByName(d.mapInArrow(_holding(uuid4().hex, shared), schema))
    return found.select(F.col("quote").alias(quote), F.col("document").alias(document))


def quoted(quote: Column, text: Column) -> Column:
    """Whether the quote is a contiguous passage of the text, Markdown's markers and white space aside."""
    return F.contains(loose(text), loose(quote))


def acceptance(drafts: DataFrame) -> DataFrame:
    """Adds ``reason`` (null if accepted) and fills empty versions from the section.

    Columns: quote, versions, section_text, section_versions and version_scope.
    """
    beyond = (F.col("version_scope") == "version_heading") & (F.size(F.array_except("versions", "section_versions")) > 0)
    reason = F.when(~quoted(F.col("quote"), F.col("section_text")), "quote_not_in_section").when(beyond, "versions_contradict_heading")
    filled = F.when(F.size("versions") == 0, F.col("section_versions")).otherwise(F.col("versions"))
    return drafts.withColumn("reason", reason).withColumn("versions", F.when(F.col("reason").isNull(), filled).otherwise(F.col("versions")))


def evidence_faults(source_known: Column, text: Column, quote: Column, versions: Column, resolved: Column, fact_known: Column) -> Column:
    """Everything that is wrong with a piece of evidence, checked again against the collected document."""
    return F.array_compact(
        F.array(
            F.when(~source_known, "unknown_source"),
            F.when(text.isNull(), "no_document"),
            F.when(text.isNotNull() & ~quoted(quote, text), "quote_not_found"),
            F.when(F.size(F.array_except(versions, resolved)) > 0, "versions_outside"),
            F.when(~fact_known, "unknown_fact"),
        )
    )


def original_texts(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key and text, duplicates with the text of the document they point to."""
    own = documents.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    joined = documents.join(own, F.col("duplicate_content_of") == F.col("__key"), "left")
    return joined.select(key, F.coalesce("__text", text).alias(text))


def clusters(facts: DataFrame, subject: str, fact: str, change: str) -> DataFrame:
    """Facts of one normalized subject: cluster number in order of first fact, label, changes and facts.

    A subject without letters and digits is a cluster of its fact alone.
    """
    key = F.coalesce(F.nullif(subject_key(F.col(subject)), F.lit("")), F.concat(F.lit("fact "), F.col(fact).cast("string")))
    grouped = facts.withColumn("cluster_key", key).groupBy("cluster_key").agg(
        F.min(fact).alias("first_fact"),
        F.min_by(subject, fact).alias("label"),
        F.array_sort(F.collect_set(change)).alias("changes"),
        F.count("*").alias("n_facts"),
    )
    return numbering.numbered(grouped, "cluster", "first_fact")


def chunked(numbered: DataFrame, number: str, size: int = 150) -> DataFrame:
    """Adds ``chunk`` (from 0) of ``size`` neighbours."""
    return numbered.withColumn("chunk", F.floor((F.col(number) - 1) / size).cast("bigint"))


def partitioned(assigned: DataFrame, clusters: DataFrame, cluster: str, group: str) -> DataFrame:
    """cluster, group and method: the first group that claims a cluster keeps it; unclaimed ones stand alone (null group)."""
    first = assigned.groupBy(cluster).agg(F.min(group).alias(group))
    joined = clusters.select(cluster).join(first, cluster, "left")
    return joined.withColumn("method", F.when(F.col(group).isNull(), "unassigned").otherwise("grouped"))


def cluster_versions(facts: DataFrame, subject: str, versions: str) -> DataFrame:
    """cluster_key and the versions that its facts name, each once, in order."""
    own = facts.select(subject_key(F.col(subject)).alias("cluster_key"), F.explode(versions).alias("version")).distinct()
    return own.groupBy("cluster_key").agg(F.sort_array(F.collect_list("version")).alias("versions"))


def with_scope(facts: DataFrame, sections: DataFrame, section: str, *columns: str) -> DataFrame:
    """Facts with columns of the section that they were read in; null where it is not known."""
    return facts.join(sections.select(section, *columns), section, "left")


def contextual(*stages: DataFrame) -> DataFrame:
    """The contextual facts of several stages, each once: the first stage that tells a fact keeps its reason."""
    rows = [s.withColumn("__stage", F.lit(n)) for n, s in enumerate(stages)]
    both = rows[0]
    for other in rows[1:]:
        both = both.unionByName(other)
    return both.groupBy("fact").agg(F.min_by("reason", "__stage").alias("reason"))
