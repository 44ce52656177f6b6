"""Which links a crawl follows, and in which order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import urls
from claimloom.functions import versions as v

# Places of a path where a number is a version, words of release notes and of guides.
_PLACES = r"(?i)(?:releases?[-/]|/docs?/(?:[a-z]{2}/)?|/en/|version[-/])([0-9]+(?:[.-][0-9]+){0,3})(?:/|\.html|$)"
_NOTES = r"(?i)release|changelog|changes|what.?s.?new"
_GUIDES = "(?i)migrat|upgrad|changelog|deprecat"


def scope_keys(url: Column, title: Column, project: str) -> Column:
    """Keys of the versions that an address or a title names: in known places of the path, or after the project's name."""
    path = urls.path(url)
    named = rf"(?i){re.escape(project)}[-\s]+v?([0-9]+(?:\.[0-9]+){{0,3}})(?:[^0-9.]|$)"
    found = F.concat(F.regexp_extract_all(path, F.lit(_PLACES), F.lit(1)), F.regexp_extract_all(F.concat(path, F.lit(" "), title), F.lit(named), F.lit(1)))
    return F.transform(found, lambda x: v.version_key(F.translate(x, "-", ".")))


def outside_scope(keys: Column, current: str, target: str, mode: str = "family") -> Column:
    """Versions are named, and none of them is in scope."""
    return (F.size(keys) > 0) & ~F.exists(keys, lambda k: v.in_scope(k, current, target, mode))


def notes_rank(url: Column, label: Column, keys: Column, current: str, target: str, milestones: Sequence[str], mode: str = "family") -> Column:
    """0 for release notes of a milestone, 1 for those of another release in scope, null for other pages."""
    inside = F.filter(keys, lambda k: v.in_scope(k, current, target, mode))
    marks = F.array(*(v.constant_key(v.key_of(m)) for m in milestones))
    is_notes = F.concat(label, F.lit(" "), urls.path(url)).rlike(_NOTES)
    return F.when(is_notes & (F.size(inside) > 0), F.when(F.arrays_overlap(inside, marks), 0).otherwise(1))


def priority(url: Column, label: Column, same_site: Column, notes: Column, named_milestones: Column) -> Column:
    """Lower is fetched first: notes in scope, guides, pages of the site, other pages, discussions."""
    guide = F.concat(label, F.lit(" "), url).rlike(_GUIDES)
    return (
        F.when(urls.discussion(url), 9)
        .when(same_site & notes.isNotNull(), notes)
        .when(same_site & guide, F.when(F.size(named_milestones) > 0, 0).otherwise(1))
        .when(same_site, 3)
        .otherwise(7)
    )


def milestone_siblings(url: Column, milestones: Sequence[str]) -> Column:
    """Addresses that notes of the milestones would have, if this is an address of release notes; guesses until fetched."""
    pattern = r"(?i)((?:releases?|release-notes|changelog)[-/])v?[0-9]+(?:\.[0-9]+){0,3}(/|\.html|$)"
    forms = [f for m in milestones for f in ([m] if "." in m else [m, f"{m}.0"])]
    plain = F.regexp_replace(url, r"[?#].*$", "")
    return F.when(plain.rlike(pattern), F.array(*(F.regexp_replace(plain, pattern, f"$1{f}$2") for f in forms)))


def relevant(label: Column, url: Column) -> Column:
    """Links worth following by their words, or discussions."""
    # Words of pages about changes.
    words = r"(?i)migrat|upgrad|release|changelog|breaking|deprecat|compatib|removed|documentation|\bdocs?\b|readme|\bapi\b"
    return F.concat(label, F.lit(" "), urls.path(url)).rlike(words) | urls.discussion(url)
