"""Crawl of a link table by priority, under budgets of its own for each kind of page; a loop of joins.

Links: src, dst, position (place of the link on its page), priority (lower first) and, where
there are kinds, kind: ``document``, ``registry``, ``index`` or ``discussion``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut, discard, written

#: Guides and release notes, which keep a reserve of a fifth of the URLs.
GUIDE = 1


@dataclass(frozen=True)
class Budgets:
    """What a crawl may take. Every number bounds rows that one task orders."""

    depth: int = 2
    urls: int = 500
    documents: int = 100
    registry: int = 60
    index_pages: int = 20
    requests: int = 200

    @property
    def reserve(self) -> int:
        return self.urls // 5

    @property
    def discussions(self) -> int:
        return max(1, self.urls // 5)


_NODE = "url string, depth int, priority int, kind string, allowed boolean, parent bigint, sequence bigint, fetched_at bigint, status string"
_ORDER = ["parent", "position", "url"]
_LAST = (1 << 63) - 1


def crawl(links: DataFrame, seeds: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:
    """url, depth, priority, kind, allowed, parent, sequence, fetched_at and status of everything admitted, in the order of a heap.

    One page at a time would be taken from a heap of (priority, sequence), and its links admitted, in
    their order on it, before the next one is taken: as far as the URLs go; discussions have a share of
    their own, and guides a reserve beyond the others. A round here takes the first pages of the queue ahead
    of time, as many as requests are left, finds the first whose links name a better priority than a page behind
    it has, commits the pages up to there with their links and returns the rest to the queue. So every page
    is taken in its turn, and a round ends early only where a link overtakes the queue.

    ``status`` is fetched, disallowed (by ``allowed``, as robots rules say), registry_budget, index_budget, or
    pending when documents or requests are used up; ``parent`` is the number of the fetch that admitted a page, 0 for seeds.
    Links are only joined with the pages of a round, and only rows that budgets bound are ordered in one task.
    """
    for name, value in (("kind", F.lit("document")), ("position", F.lit(0)), ("allowed", F.lit(True))):
        links = links if name in links.columns else links.withColumn(name, value)
        seeds = seeds if name in seeds.columns else seeds.withColumn(name, value)
    spark = links.sparkSession
    first = seeds.withColumns({"parent": F.lit(0).cast("bigint"), "depth": F.lit(0)})
    known, place = written(_admitted(first, spark.createDataFrame([], _NODE), budgets), "frontier")
    while True:
        top = _taken(known, budgets)
        if top is None:
            return known.fillna("pending", ["status"])
        top, top_at = written(top, "frontier-top")
        fresh = top.filter((F.col("fetched_at") > 0) & (F.col("depth") < budgets.depth)).select(F.col("url").alias("src"), "rank", F.col("fetched_at").alias("parent"), (F.col("depth") + 1).alias("depth"))
        reached = links.join(F.broadcast(fresh), "src").withColumnRenamed("dst", "url").join(known.select("url"), "url", "left_anti")  # ``budgets.requests`` rows at most
        reached, reached_at = written(reached.select("url", "rank", "parent", "position", "priority", "kind", "allowed", "depth"), "frontier-links")
        last = committed(top.select("rank", F.struct("priority", "sequence").alias("key")), reached.select("rank", F.struct("priority", F.lit(_LAST).alias("sequence")).alias("key")))
        done = top.filter(F.col("rank") <= last)
        marked = known.drop("fetched_at", "status").join(F.broadcast(done.select("url", "fetched_at", "status")), "url")
        moved = known.join(F.broadcast(done.select("url")), "url", "left_anti").unionByName(marked)
        before = place
        known, place = written(moved.unionByName(_admitted(reached.filter(F.col("rank") <= last), known, budgets)), "frontier")
        discard(spark, before, top_at, reached_at)


def committed(top: DataFrame, reached: DataFrame) -> int:
    """The last rank of ``top`` (rank, key, in order) that no key of ``reached`` (rank, key) overtakes.

    A row of ``reached`` comes up when the row of its rank is taken; rows behind that with a greater key have to wait for it.
    ``top`` is bounded, and what is reached is one least key a rank.
    """
    least = reached.groupBy("rank").agg(F.min("key").alias("found")).select(F.col("rank").alias("at"), "found")
    waits = top.join(F.broadcast(least), (F.col("rank") > F.col("at")) & (F.col("key") > F.col("found")))
    stop, end = waits.agg(F.min("rank")).first()[0], top.agg(F.max("rank")).first()[0]
    return end if stop is None else stop - 1


def _admitted(new: DataFrame, known: DataFrame, budgets: Budgets) -> DataFrame:
    """The nodes that rows of links add to ``known``, one after another in their order.

    While there is room for any page, each is admitted where it is met first; once there is none, guides go
    on, where a link calls them so, into the reserve. Discussions are admitted as long as their share lasts.
    """
    counts = known.agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "discussion").alias("d")).first()
    room = max(0, budgets.urls - counts.n)
    rest = budgets.urls + budgets.reserve - max(counts.n, budgets.urls)
    left = max(0, budgets.discussions - counts.d)
    node = F.struct("parent", "position", "url", "priority", "kind", "allowed", "depth")
    bound = lambda row: None if row is None else F.struct(*(F.lit(row[c]).cast(new.schema[c].dataType) for c in _ORDER))

    def among(rows: DataFrame, column: str, most: int, talks: int) -> tuple[Column, int, int, Column | None]:
        """Which rows are the first ``most`` by ``column``, with ``talks`` discussions at most; how many they are, how many of them discussions, and the last."""
        at, is_talk = F.struct(*(F.col(f"{column}.{c}") for c in _ORDER)), F.col(f"{column}.kind") == "discussion"
        told = bound(rows.filter(is_talk).select(at.alias("at")).orderBy("at").limit(talks).agg(F.max("at")).first()[0])
        open_to = ~is_talk | (at <= told) if told is not None else ~is_talk
        full = rows.filter(open_to).select(at.alias("at"), is_talk.alias("talk")).orderBy("at").limit(most).agg(F.count("*").alias("n"), F.count_if("talk").alias("d"), F.max("at").alias("at")).first()
        last = bound(full.at)
        return (open_to & (at <= last) if last is not None else F.lit(False)), full.n, full.d, last

    met = new.groupBy("url").agg(F.min(node).alias("met"))
    here, n, d, last = among(met, "met", room, left)
    chosen = F.when(here, F.col("met"))
    if n == room and rest > 0:
        behind = F.lit(True) if last is None else F.struct(*_ORDER) > last
        met = new.groupBy("url").agg(F.min(node).alias("met"), F.min(F.when((F.col("priority") <= GUIDE) & behind, node)).alias("guide"))
        guides = among(met.filter(~here & F.col("guide").isNotNull()), "guide", rest, left - d)[0]
        chosen = chosen.when(guides, F.col("guide"))
    taken = met.select(chosen.alias("node")).filter("node IS NOT NULL").select("node.*")
    place = F.row_number().over(Window.orderBy(*_ORDER)).cast("bigint")
    columns = [F.col("depth").cast("int"), F.col("priority").cast("int"), "kind", "allowed", F.col("parent").cast("bigint")]
    return taken.select("url", *columns, (F.lit(counts.n) + place).alias("sequence"), F.lit(None).cast("bigint").alias("fetched_at"), F.lit(None).cast("string").alias("status"))


def _taken(known: DataFrame, budgets: Budgets) -> DataFrame | None:
    """The queue's first pages, as far as the budgets go, with the rank, status and fetch they would have; None when nothing is left to do."""
    kinds = [F.count_if((F.col("kind") == k) & (F.col("status") == "fetched")) for k in ("registry", "index")]
    others = F.count_if(~F.col("kind").isin("registry", "index") & (F.col("status") == "fetched"))
    asked = F.count_if(F.col("status").isin("fetched", "index_budget"))
    waiting = F.count_if(F.col("status").isNull())
    registry, index, documents, requests, last, queued = known.agg(*kinds, others, asked, F.coalesce(F.max("fetched_at"), F.lit(0)), waiting).first()
    if not queued or documents >= budgets.documents or requests >= budgets.requests:
        return None
    place = Window.orderBy("priority", "sequence")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    count = lambda condition, window: F.coalesce(F.sum(F.when(condition, 1).otherwise(0)).over(window), F.lit(0))
    is_registry, is_index, open_ = F.col("kind") == "registry", F.col("kind") == "index", F.coalesce("allowed", F.lit(True))
    top = known.filter("status IS NULL").orderBy("priority", "sequence").limit(budgets.requests).withColumn("rank", F.row_number().over(place).cast("bigint"))
    # A registry record beyond its budget is not asked for, nor a page that rules forbid; an index page beyond its own budget is, and left.
    top = top.withColumn("status", F.when(is_registry & (count(is_registry & open_, before) >= budgets.registry - registry), "registry_budget").when(~open_, "disallowed"))
    over = F.when(is_index & F.col("status").isNull() & (count(is_index & F.col("status").isNull(), before) >= budgets.index_pages - index), "index_budget")
    top = top.withColumn("spent", count(F.col("status").isNull(), before)).withColumn("full", count(F.col("status").isNull() & ~is_registry & ~is_index, before)).withColumn("status", F.coalesce("status", over, F.lit("fetched")))
    top = top.filter((F.col("spent") < budgets.requests - requests) & (F.col("full") < budgets.documents - documents))
    number = F.when(F.col("status") == "fetched", F.lit(last) + count(F.col("status") == "fetched", place.rowsBetween(Window.unboundedPreceding, 0)))
    return top.withColumn("fetched_at", number.cast("bigint")).select("rank", *known.columns)


def best_first(edges: DataFrame, root: str, most_pages: int) -> DataFrame:
    """(url, fetched_at) of the pages that a best-first crawl of ``edges`` (src, dst, relevance) reads from ``root``, ``most_pages`` at most.

    The waiting page of the greatest relevance goes next, then by address; one that is met again under a greater
    relevance moves up. Rounds take the best pages ahead of time and commit those that no link of theirs overtakes, as in ``crawl``.
    """
    spark = edges.sparkSession
    seen, place = written(spark.createDataFrame([(root, 1)], "url string, fetched_at bigint"), "best-first")
    taken = 1
    while taken < most_pages:
        key = lambda relevance, url: F.struct((-F.col(relevance)).alias("worse"), F.col(url).alias("url"))
        waiting = edges.join(F.broadcast(seen.select(F.col("url").alias("src"))), "src").groupBy("dst").agg(F.max("relevance").alias("relevance"))
        waiting = waiting.join(F.broadcast(seen.select(F.col("url").alias("dst"))), "dst", "left_anti").select(key("relevance", "dst").alias("key"))
        top = waiting.orderBy("key").limit(most_pages - taken).withColumn("rank", F.row_number().over(Window.orderBy("key")).cast("bigint"))
        top, top_at = written(top, "best-first-top")
        reached = edges.join(F.broadcast(top.select(F.col("key.url").alias("src"), "rank")), "src").join(F.broadcast(seen.select(F.col("url").alias("dst"))), "dst", "left_anti")
        if top.isEmpty():
            break
        last = committed(top, reached.select("rank", key("relevance", "dst").alias("key")))
        before = place
        seen, place = written(seen.unionByName(top.filter(F.col("rank") <= last).select(F.col("key.url").alias("url"), (F.col("rank") + taken).alias("fetched_at"))), "best-first")
        discard(spark, before, top_at)
        taken += last
    return seen


def left_out(known: DataFrame, links: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:
    """url and reason of pages that fetched ones link to and that were not admitted."""
    fetched = known.filter("status = 'fetched'").select(F.col("url").alias("src"), "depth")
    reached = links.join(F.broadcast(fetched), "src").groupBy(F.col("dst").alias("url")).agg(F.min("depth").alias("depth"), F.max("kind").alias("kind"))
    missed = reached.join(known.select("url"), "url", "left_anti")
    reason = F.when(F.col("depth") >= budgets.depth, "depth").when(F.col("kind") == "discussion", "discussion_budget").otherwise("url_budget")
    return missed.select("url", reason.alias("reason"))


def reachable(links: DataFrame, seeds: DataFrame, depth: int = 2) -> DataFrame:
    """url and the least number of links to it, without budgets: a join, an aggregate and an anti-join for each level."""
    known = cut(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "reachable")
    for level in range(1, depth + 1):
        edge = known.filter(F.col("depth") == level - 1).select(F.col("url").alias("src"))
        new = links.join(edge, "src").select(F.col("dst").alias("url")).distinct().join(known.select("url"), "url", "left_anti")
        known = cut(known.unionByName(new.withColumn("depth", F.lit(level))), "reachable")
    return known


def with_provenance(reached: DataFrame, links: DataFrame) -> DataFrame:
    """Every link between what was fetched and what was reached, also those met after a page was admitted.

    A link that was met before, when there was no room for its page yet, is none.
    """
    fetched = reached.filter("status = 'fetched'").select(F.col("url").alias("src"), "fetched_at")
    met = links.join(fetched, "src").join(reached.select(F.col("url").alias("dst"), "parent"), "dst")
    return met.filter(F.col("fetched_at") >= F.col("parent")).select("src", "dst").distinct()


def propagated(documents: DataFrame, edges: DataFrame) -> DataFrame:
    """(url, version, basis): a document's own associations, and those that its incoming edges bring."""
    brought = edges.select(F.col("dst").alias("url"), F.explode("versions").alias("version"), F.col("relation").alias("basis"))
    return documents.select("url", "version", "basis").unionByName(brought.join(documents.select("url").distinct(), "url", "left_semi")).distinct()


def by_version(documents: DataFrame, versions: DataFrame) -> DataFrame:
    """(version, url) for every resolved version that a document is associated with (J12): an equi-join, no product."""
    return documents.select("url", "version").distinct().join(versions.select("version").distinct(), "version").select("version", "url")
