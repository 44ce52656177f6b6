"""What a research client sees of documents, and bookkeeping of its requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.functions.text import TOPICS, topics
from claimloom.functions.vocabulary import RELEASE_KINDS
from claimloom.operators import numbering

PAGE_CHARS, PAGE_LINKS, OUTLINE, OUTLINE_CHARS = 12_000, 40, 40, 120
LONGEST_WAIT, REFUSALS_TO_QUARANTINE = 10, 3
MOST_RESULTS = 20


def fetch_pages(documents: DataFrame, key: str, text: str, size: int = PAGE_CHARS) -> DataFrame:
    """Whole texts in pages: key, offset, page text and next_offset, null on the last one."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(size))
    paged = documents.select(key, text, F.explode(starts).alias("offset"))
    end = F.col("offset") + size
    return paged.select(key, "offset", F.substring(F.col(text), F.col("offset") + 1, F.lit(size)).alias("page"), F.when(end < F.length(text), end).alias("next_offset"))


def version_outline(sections: DataFrame, documents: DataFrame, key: str, order: str, in_range: Column, most: int = OUTLINE) -> DataFrame:
    """key, heading and offset of the headings that name versions in range, searched from one heading to the next.

    Sections: key, order, heading; documents: key, text. A fold over a document's own headings.
    """
    item = F.struct(F.col(order).alias("at"), F.col("heading").alias("heading"), in_range.alias("named"))
    headings = sections.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"))
    start = F.struct(F.lit(1).alias("place"), F.array().cast("array<struct<heading:string,offset:int>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        found = F.call_function("locate", x.heading, F.col("text"), a.place)
        entry = F.array(F.struct(F.substring(x.heading, 1, OUTLINE_CHARS).alias("heading"), (found - 1).alias("offset")))
        kept = (found > 0) & x.named & (F.size(a.out) < most)
        return F.struct(F.when(found > 0, found).otherwise(a.place).alias("place"), F.when(kept, F.concat(a.out, entry)).otherwise(a.out).alias("out"))

    folded = documents.select(key, "text").join(headings, key).select(key, F.explode(F.aggregate("items", start, step, lambda a: a.out)).alias("x"))
    return folded.select(key, "x.heading", "x.offset")


def annotated(sections: DataFrame, url: str = "url") -> DataFrame:
    """Adds the section's own address, whether it is about changes, and its topics."""
    anchor = F.coalesce("anchor", F.lit(""))
    own = F.concat(urls.without_fragment(F.col(url)), F.when(anchor != "", F.concat(F.lit("#"), anchor)).otherwise(""))
    content = F.concat(F.col("heading"), F.lit("\n"), F.col("text"))
    return sections.withColumn("section_url", own).withColumn("topics", topics(content)).withColumn("change_related", F.size("topics") > 0)


def within_documents(rows: DataFrame, most: int, *order: str, by: tuple[str, ...] = (), kind: str = "kind") -> DataFrame:
    """Adds ``within``: whether a document is one of the first ``most`` that are no registry records; those have a budget of their own."""
    document = F.col(kind) != "registry_metadata"
    counted = numbering.within(rows.filter(document), most, order, by)
    return counted.unionByName(rows.filter(~document).withColumn("within", F.lit(True)))


def note_versions(claims: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The versions that claims typed as release notes speak of."""
    return claims.filter(F.col("kind").isin(*RELEASE_KINDS)).select(*by, F.explode("versions").alias("version")).distinct()


def first_holders(pairs: DataFrame, quote: str, document: str) -> DataFrame:
    """Each quote with the first observed document that holds it (pairs as ``facts.grounded_pairs`` gives them)."""
    return pairs.groupBy(quote).agg(F.min(document).alias(document))


def located(claims: DataFrame, pairs: DataFrame, quote: str, document: str) -> DataFrame:
    """Claims with ``held_by`` and ``corrected``: their own document if it holds the quote, else the first other one; null if none does."""
    own = pairs.select(F.col(quote).alias("__q"), F.col(document).alias("__d"), F.lit(True).alias("__own"))
    any_ = first_holders(pairs, quote, document).select(F.col(quote).alias("__q2"), F.col(document).alias("__first"))
    joined = claims.join(own, (F.col(quote) == F.col("__q")) & (F.col(document) == F.col("__d")), "left").join(any_, F.col(quote) == F.col("__q2"), "left")
    held = F.when(F.col("__own"), F.col(document)).otherwise(F.col("__first"))
    return joined.withColumn("held_by", held).withColumn("corrected", F.coalesce(held != F.col(document), F.lit(False))).drop("__q", "__d", "__own", "__q2", "__first")


def outcomes(attempts: DataFrame, host: str = "host", order: str = "seq") -> DataFrame:
    """Adds ``outcome`` to requests (status, retry_after): ok, retried, deferred, failed, or quarantined after a host's third 403.

    Pacing and retries are the client's; here they are a column.
    """
    refused = attempts.filter(F.col("status") == 403)
    # Three rows of a host are enough, which each task picks before the shuffle.
    place = F.row_number().over(Window.partitionBy(host).orderBy(order))
    third = refused.withColumn("__n", place).filter(F.col("__n") <= REFUSALS_TO_QUARANTINE).filter(F.col("__n") == REFUSALS_TO_QUARANTINE).select(F.col(host).alias("__host"), F.col(order).alias("__third"))
    joined = attempts.join(third, F.col(host) == F.col("__host"), "left")
    later = F.coalesce(F.col(order) > F.col("__third"), F.lit(False))
    again = (F.col("status") == 429) | (F.col("status") >= 500)
    outcome = (
        F.when(later, "quarantined").when(again & (F.coalesce("retry_after", F.lit(0)) > LONGEST_WAIT), "deferred").when(again, "retried").when(F.col("status") >= 400, "failed").otherwise("ok")
    )
    return joined.withColumn("outcome", outcome).drop("__host", "__third")


def search_results(first: DataFrame, second: DataFrame, limit: int, by: str = "query") -> DataFrame:
    """(query, provider, url, place): what the first provider answers; of queries it answers with nothing or a challenge, the second's.

    Answers: query, provider, position, url, challenge. At most 20 results of a query are taken.
    """
    limit = max(1, min(limit, MOST_RESULTS))
    good = first.filter(~F.coalesce("challenge", F.lit(False)))
    used = good.unionByName(second.join(good.select(by).distinct(), by, "left_anti").filter(~F.coalesce("challenge", F.lit(False))))
    once = used.groupBy(by, "provider", "url").agg(F.min("position").alias("position"))
    place = F.row_number().over(Window.partitionBy(by).orderBy("position", "url"))
    return once.withColumn("place", place).filter(F.col("place") <= limit).select(by, "provider", "url", F.col("place").cast("bigint").alias("place"))


def numbered_evidence(rows: DataFrame, by: str, order: str, *key: str) -> DataFrame:
    """Adds ``number``: each piece of evidence of a path once, numbered as it is first cited."""
    first = rows.groupBy(by, *key).agg(F.min(order).alias("__first"))
    numbered = first.withColumn("number", F.row_number().over(Window.partitionBy(by).orderBy("__first", *key)).cast("bigint")).drop("__first")
    return rows.join(numbered, [by, *key])


def change_words() -> tuple[str, ...]:
    return tuple(TOPICS)
