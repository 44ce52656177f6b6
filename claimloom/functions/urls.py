"""URLs: hosts, sites, repositories, document kinds, trust."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.vocabulary import SHARED_HOSTS

# First path parts of GitHub that are no owners.
NO_OWNERS = ("search", "topics", "collections", "features", "orgs", "settings")
# Ends of files that are not texts.
BINARY_ENDS = ("zip", "gz", "xz", "tar", "exe", "whl", "png", "jpg", "svg", "pdf")


def host(url: Column) -> Column:
    """The host in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def site(name: Column) -> Column:
    """The last two labels of a host; hosts that many tenants share keep all of theirs."""
    shared = F.lit(False)
    for end in SHARED_HOSTS:
        shared = shared | F.endswith(name, F.lit(end))
    return F.when(shared, name).otherwise(F.regexp_extract(name, r"([^.]*\.)?[^.]*$", 0))


def repository(url: Column) -> Column:
    """owner/name of GitHub's web, raw and API addresses, in lower case; null for others."""
    own, parts = host(url), F.filter(F.split(path(url), "/"), lambda p: p != "")
    two = lambda a: F.lower(F.concat_ws("/", F.get(parts, F.lit(a)), F.get(parts, F.lit(a + 1))))
    web = own.isin("github.com", "raw.githubusercontent.com") & (F.size(parts) >= 2)
    api = (own == "api.github.com") & (F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "repos")
    return F.when(web, F.regexp_replace(two(0), r"\.git$", "")).when(api, two(1))


def project_repository(url: Column) -> Column:
    """owner/name as written of a GitHub project address in any usual form; empty if it is none."""
    plain = F.regexp_replace(F.regexp_replace(url, r"^git\+", ""), "^git@github[.]com:", "https://github.com/")
    parts = F.filter(F.split(path(plain), "/"), lambda p: p != "")
    owner, name = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    good = host(plain).isin("github.com", "www.github.com") & owner.rlike(r"^[\w.-]+$") & name.rlike(r"^[\w.-]+$") & ~owner.isin(*NO_OWNERS)
    return F.when(good, F.concat(owner, F.lit("/"), F.regexp_replace(name, r"\.git$", ""))).otherwise(F.lit(""))


def api_address(url: Column) -> Column:
    """The API's address for a release, issue or pull request page; the URL itself for others."""
    base = r"^https?://github\.com/([^/]+)/([^/]+)/"
    out = F.regexp_replace(url, base + r"releases/tag/([^/?#]+).*$", "https://api.github.com/repos/$1/$2/releases/tags/$3")
    out = F.regexp_replace(out, base + r"issues/([0-9]+).*$", "https://api.github.com/repos/$1/$2/issues/$3")
    return F.regexp_replace(out, base + r"pull/([0-9]+).*$", "https://api.github.com/repos/$1/$2/pulls/$3")


def retrieval_address(url: Column) -> Column:
    """The address to fetch; null for a tree of sources, which is no text of a release."""
    tree = (host(url) == "github.com") & (F.get(F.filter(F.split(path(url), "/"), lambda p: p != ""), F.lit(2)) == "tree")
    return F.when(~F.coalesce(tree, F.lit(False)), api_address(url))


def document_kind(url: Column, title: Column) -> Column:
    """The kind of a document by its address and title; the first pattern decides."""
    hint = F.concat(url, F.lit(" "), title)
    # The patterns and their order.
    return (
        F.when(hint.rlike("(?i)migrat|upgrad"), "upgrade_guide")
        .when(hint.rlike("(?i)deprecat"), "deprecation_notice")
        .when(hint.rlike("(?i)changelog|release.?notes|/releases?/"), "release_notes")
        .when(url.rlike("(?i)/blog/|/news/"), "blog_post")
        .when(hint.rlike(r"(?i)/docs?/|documentation|\bdocs?\b|readme|\bapi\b"), "api_documentation")
        .otherwise("supporting_document")
    )


def public(url: Column) -> Column:
    """Whether an address may be fetched: http or https, no credentials, usual port, no private or local host."""
    own = host(url)
    octets = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|2[3-5][0-9])(?:\.[0-9]+)*$"
    bad = (own == "") | own.isin("localhost") | own.rlike(r"\.(?:local|internal|localhost)$") | own.rlike(octets) | url.rlike(r"^[a-z]+://[^/?#]*@")
    port = F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#:]+:([0-9]+)", 1)
    return url.rlike("(?i)^https?://") & ~bad & port.isin("", "80", "443")


def binary(url: Column) -> Column:
    """Whether an address names a file that is no text: such an end before a query, or at the end of the whole address, its query included."""
    return without_fragment(url).rlike(rf"(?i)\.(?:{'|'.join(BINARY_ENDS)})(?:$|\?)")


def discussion(url: Column) -> Column:
    return url.rlike(r"github\.com/[^/]+/[^/]+/(?:issues|pull)/[0-9]+")


def trust_tier(url: Column, kind: Column, catalog: Column, sites: Column, repositories: Column, relation: Column) -> Column:
    """How far a source is trusted: registry and catalog, then the project's repositories, then its sites, then recorded relations."""
    own, place = repository(url), host(url)
    names = F.transform(repositories, lambda r: F.get(F.split(r, "/"), F.lit(1)))
    return (
        F.when((url == catalog) | (kind == "registry_metadata"), "official")
        .when(F.array_contains(repositories, own) & kind.isin("github_issue", "github_pull_request"), "official_repository_discussion")
        .when(F.array_contains(repositories, own), "official")
        .when(F.array_contains(names, F.get(F.split(own, "/"), F.lit(1))), "probable_official")
        .when((place != "") & F.array_contains(sites, site(place)), "official")
        .when(F.coalesce(relation.isin("associated_repository", "selected_project_site"), F.lit(False)), "official")
        .otherwise("third_party")
    )


def source_type(url: Column, kind: Column, tier: Column) -> Column:
    """A source's type by its kind and whether it speaks for the project."""
    official = tier.isin("official", "probable_official")
    changes = url.rlike(r"(?i)changelog|changes\.(?:md|rst|txt)")
    either = lambda yes, no: F.when(official, yes).otherwise(no)
    return (
        F.when((kind == "release_notes") & changes, either("official_changelog", "changelog"))
        .when(kind == "release_notes", either("official_release_notes", "release_notes"))
        .when(kind == "upgrade_guide", either("official_migration_guide", "migration_guide"))
        .when(kind == "api_documentation", either("official_api_documentation", "third_party_documentation"))
        .when(kind == "blog_post", either("maintainer_blog_post", "community_writeup"))
        .when(kind == "supporting_document", either("official_documentation", "community_writeup"))
        .when(kind == "registry_metadata", "package_registry_metadata")
        .otherwise(kind)
    )
