"""Candidates for a project's identity from provider records, searches and homepages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.functions.text import alphanumeric
from claimloom.operators.identity import COMMON_HOSTS

#: How many results of a search are looked at, by provider.
RESULTS = {"npm": 5, "github": 10, "web": 5}
SHORTLIST, LEAST_TO_EXPAND = 5, 4
RELEASE_LINKS, REGISTRY_LINKS = 3, 3


def _at(path: str) -> Column:
    return F.coalesce(F.get_json_object("body", path), F.lit(""))


def scanned(records: DataFrame) -> DataFrame:
    """One candidate per provider record: kind, url, name, description, repository, homepage, evidence; and status and error.

    Records: provider (github, npm, pypi or html), address and body (JSON; of a page its title and description).
    A record that holds no name is a row with an error, and aborts nothing.
    """
    links = F.from_json(F.get_json_object("body", "$.info.project_urls"), "map<string,string>")
    values = F.coalesce(F.map_values(links), F.array().cast("array<string>"))
    linked = F.filter(F.transform(values, urls.project_repository), lambda r: r != "")
    home = F.map_values(F.map_filter(links, lambda k, _: F.lower(k).isin("homepage", "home", "website")))
    by = lambda github, npm, pypi, html: F.when(F.col("provider") == "github", github).when(F.col("provider") == "npm", npm).when(F.col("provider") == "pypi", pypi).otherwise(html)
    name = by(_at("$.name"), _at("$.name"), _at("$.info.name"), _at("$.title"))
    description = by(_at("$.description"), _at("$.description"), _at("$.info.summary"), F.coalesce(F.nullif(_at("$.description"), F.lit("")), _at("$.title")))
    npm_repository = urls.project_repository(F.coalesce(F.get_json_object("body", "$.repository.url"), _at("$.repository")))
    repository = by(_at("$.full_name"), npm_repository, F.coalesce(F.get(linked, F.lit(0)), F.lit("")), F.lit(""))
    homepage = by(_at("$.homepage"), _at("$.homepage"), F.coalesce(F.get(home, F.lit(0)), _at("$.info.home_page")), F.col("address"))
    proof = lambda field, value: F.struct(F.col("address").alias("url"), F.lit(field).alias("field"), value.alias("value"))
    of_project = F.transform(F.coalesce(F.map_entries(links), F.array().cast("array<struct<key:string,value:string>>")), lambda e: F.struct(F.col("address").alias("url"), F.concat(F.lit("info.project_urls."), e.key).alias("field"), e.value.alias("value")))
    evidence = by(
        F.concat(F.array(proof("full_name", F.col("repository")), proof("description", F.col("description"))), F.when(F.col("homepage") != "", F.array(proof("homepage", F.col("homepage")))).otherwise(F.array().cast("array<struct<url:string,field:string,value:string>>"))),
        F.array(proof("name", F.col("name")), proof("repository", F.col("repository")), proof("description", F.col("description"))),
        F.concat(F.array(proof("info.name", F.col("name")), proof("info.summary", F.col("description"))), of_project),
        F.array(proof("title", F.col("name"))),
    )
    url = F.when(F.col("provider") == "github", F.coalesce(F.nullif(_at("$.html_url"), F.lit("")), F.col("address"))).otherwise(F.col("address"))
    found = records.withColumns({"name": name, "description": description, "repository": repository, "homepage": homepage, "candidate": url})
    found = found.withColumn("evidence", evidence)
    failed = F.col("name") == ""
    return found.select(
        F.col("provider").alias("kind"), F.col("candidate").alias("url"), "name", "description", "repository", "homepage", "evidence",
        F.when(failed, "failed").otherwise("read").alias("status"), F.when(failed, F.concat(F.lit("no name in "), F.col("address"))).alias("error"),
    )


def searched(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The first results of each provider (provider, position, url), each address once, as far as a provider's list is looked at."""
    once = results.groupBy(*by, "provider", "url").agg(F.min("position").alias("position"))
    most = F.element_at(F.create_map(*(F.lit(x) for pair in RESULTS.items() for x in pair)), F.col("provider"))
    place = F.row_number().over(Window.partitionBy(*by, "provider").orderBy("position", "url"))
    return once.withColumn("place", place).filter(F.col("place") <= max(RESULTS.values())).filter(F.col("place") <= most).select(*by, "provider", "url", F.col("place").cast("bigint").alias("place"))


def shortlist(scored: DataFrame, most: int = SHORTLIST, by: tuple[str, ...] = ()) -> DataFrame:
    """The strongest candidates by score and then address, with their place; a top-k of each ``by``."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "url"))
    if not by:
        scored = scored.orderBy(F.desc("score"), "url").limit(most)
    return scored.withColumn("place", place).filter(F.col("place") <= most).withColumn("place", F.col("place").cast("bigint"))


def expanded(candidates: DataFrame, links: DataFrame, project: str) -> DataFrame:
    """Candidates with what their homepages' links tell: reciprocal, and the repository where none is recorded.

    Candidates: url, homepage, repository, score; links: page (a homepage), href. Only those with ``LEAST_TO_EXPAND``
    points and a homepage of their own are looked at. A missing repository is taken if just one
    linked repository bears the project's name.
    """
    brand = "".join(c for c in project.lower() if c.isascii() and c.isalnum())
    repository = urls.project_repository(F.col("href"))
    to = links.select("page", repository.alias("linked")).filter("linked <> ''").distinct()
    own = F.lower("linked")
    looked = candidates.filter((F.col("score") >= LEAST_TO_EXPAND) & (F.col("homepage") != "") & (urls.host(F.col("homepage")) != "github.com"))
    met = looked.select("url", "repository", F.col("homepage").alias("page")).join(to, "page")
    named = F.when(alphanumeric(F.element_at(F.split("linked", "/"), -1)) == brand, F.col("linked"))
    told = met.groupBy("url").agg(F.bool_or(own == F.lower("repository")).alias("back"), F.collect_set(named).alias("named"))
    alone = (F.col("repository") == "") & (F.size("named") == 1)
    joined = candidates.join(told, "url", "left")
    return joined.withColumn("reciprocal", F.coalesce(F.col("back") | alone, F.lit(False))).withColumn(
        "repository", F.when(F.coalesce(alone, F.lit(False)), F.get("named", F.lit(0))).otherwise(F.col("repository"))
    ).drop("back", "named")


def followed(links: DataFrame) -> DataFrame:
    """(page, href, relation) of a homepage's links that lead to further candidates: its release pages, and packages.

    Links: page, position, href and label. Both lists are short, of each page.
    """
    page, target = urls.host(F.col("page")), urls.host(F.col("href"))
    release = (F.col("href") != F.col("page")) & (page == target) & F.col("label").rlike("(?i)release notes|releases|changelog") & ~F.col("label").rlike("[0-9]")
    package = target.isin("pypi.org", "www.npmjs.com", "npmjs.com")
    marked = links.withColumn("relation", F.when(package, "package_link").when(release, "project_release_link")).filter("relation IS NOT NULL")
    once = marked.groupBy("page", "href", "relation").agg(F.min("position").alias("position"), F.min("label").alias("label"))
    is_package = F.col("relation") == "package_link"
    # Packages count in the page's order, release pages by address.
    order = [F.when(is_package, F.col("position")).otherwise(0), "href", "label"]
    place = F.row_number().over(Window.partitionBy("page", "relation").orderBy(*order))
    most = F.when(is_package, REGISTRY_LINKS).otherwise(RELEASE_LINKS)
    return once.withColumn("place", place).filter(F.col("place") <= max(REGISTRY_LINKS, RELEASE_LINKS)).filter(F.col("place") <= most).select("page", "href", "relation")


def renamed(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """Repositories under their present names. Aliases: repository, full_name, one row each."""
    now = aliases.select(F.lower("repository").alias("__old"), "full_name")
    joined = candidates.join(now, F.lower("repository") == F.col("__old"), "left")
    return joined.withColumn("repository", F.coalesce("full_name", "repository")).drop("__old", "full_name")


def same_identity(a: str, b: str) -> Column:
    """Whether two candidates are one project: one repository, or without both of them one host that is no registry."""
    at = lambda side, name: F.col(f"{side}.{name}")
    both = (at(a, "repository") != "") & (at(b, "repository") != "")
    site = lambda side: urls.host(F.coalesce(F.nullif(at(side, "homepage"), F.lit("")), at(side, "url")))
    hosts = (site(a) != "") & ~site(a).isin(*COMMON_HOSTS, "npmjs.com") & (site(a) == site(b))
    return F.when(both, F.lower(at(a, "repository")) == F.lower(at(b, "repository"))).otherwise(hosts)


def identified(candidates: DataFrame) -> DataFrame:
    """Candidates with what ``same_identified`` compares, made once a row and not once a pair: their repository and site in lower case."""
    site = urls.host(F.coalesce(F.nullif(F.col("homepage"), F.lit("")), F.col("url")))
    return candidates.withColumn("own_repository", F.lower(F.nullif(F.col("repository"), F.lit("")))).withColumn("site", F.when(site.isin(*COMMON_HOSTS, "npmjs.com"), "").otherwise(site))


def same_identified(a: str, b: str) -> Column:
    """``same_identity`` of two rows of ``identified``."""
    at = lambda side, name: F.col(f"{side}.{name}")
    both = at(a, "own_repository").isNotNull() & at(b, "own_repository").isNotNull()
    return F.when(both, at(a, "own_repository") == at(b, "own_repository")).otherwise((at(a, "site") != "") & (at(a, "site") == at(b, "site")))


def public(candidates: DataFrame) -> DataFrame:
    """Candidates as they are shown: without the records they come from."""
    return candidates.drop("body", "metadata", "page_excerpt")


def project_repositories(candidates: DataFrame, hosts: DataFrame, most: int = 3) -> DataFrame:
    """Repositories of candidates whose homepage lies on a project host: a semi join, the first few by name."""
    own = candidates.filter("repository <> ''").withColumn("host", urls.host(F.col("homepage")))
    return own.join(hosts.select("host"), "host", "left_semi").select("repository").distinct().orderBy("repository").limit(most)
