"""Release labels as sortable keys, and intervals between releases.

A key is an array of four longs, zero-padded, so trailing zeros do not count and arrays
compare as versions do. Labels that are not one to four dotted numbers have no key.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = 4
_NUMERIC = r"^[0-9]+(\.[0-9]+){0,3}$"
#: Version tokens: maximal runs of letters, digits, dots and underscores are cut out first, so no lookaround is needed.
TOKEN_RUN = r"[\p{L}\p{N}_.]+"
TOKEN = r"^v?[0-9]+(\.[0-9]+)+\.*$"


def numeric_label(label: Column, projects: Sequence[str] = ()) -> Column:
    """The dotted numbers of a tag or label, without conventional wrappers; null if anything else is left."""
    text = F.regexp_replace(F.trim(label), r"(?i)^refs/tags/", "")
    for name in sorted(projects, key=len, reverse=True):
        text = F.regexp_replace(text, rf"(?i)^{re.escape(name)}[-_@](v?[0-9])", "$1")
    text = F.regexp_replace(text, r"(?i)^(?:version[-_ ]?|release[-_ ]?|rel[-_]|v)([0-9])", "$1")
    text = F.translate(text, "_", ".")
    return F.when(text.rlike(_NUMERIC), text)


def version_key(label: Column, projects: Sequence[str] = ()) -> Column:
    """The sortable key of a label; null without one."""
    numbers = F.transform(F.split(numeric_label(label, projects), r"\."), lambda p: F.expr("bigint(0)") + p.try_cast("bigint"))
    padded = F.slice(F.concat(numbers, F.array_repeat(F.lit(0).cast("bigint"), _PARTS)), 1, _PARTS)
    return F.when(~F.exists(padded, lambda p: p.isNull()), padded)


def precision(label: Column) -> Column:
    """How many numbers a label has."""
    return F.size(F.split(numeric_label(label), r"\."))


def key_of(label: str) -> tuple[int, ...]:
    """The key of an endpoint on the driver: an optional v and one to four dotted numbers."""
    if not re.fullmatch(r"v?[0-9]+(?:\.[0-9]+){0,3}", label):
        raise ValueError(f"{label!r} is not a numeric stable version")
    numbers = [int(p) for p in label.lstrip("v").split(".")]
    return tuple(numbers + [0] * (_PARTS - len(numbers)))


def _size(label: str) -> int:
    return label.count(".") + 1


def family_end(label: str) -> tuple[int, ...]:
    """The first key after the family of an endpoint: its last number raised by one."""
    key = list(key_of(label))
    key[_size(label) - 1] += 1
    return tuple(key)


def check_interval(current: str, target: str, mode: str) -> None:
    """Raises ValueError unless the endpoints make a usable interval."""
    if mode not in ("family", "exact"):
        raise ValueError("mode is family or exact")
    if key_of(target) <= key_of(current):
        raise ValueError("the target is not newer than the current version")
    if mode == "family":
        if _size(current) != _size(target):
            raise ValueError("family endpoints have equal precision; exact mode takes mixed ones")
        if family_end(current) > key_of(target):
            raise ValueError("the families overlap")


def constant_key(key: tuple[int, ...]) -> Column:
    return F.array(*(F.lit(n).cast("bigint") for n in key))


def in_interval(key: Column, current: str, target: str, mode: str = "family") -> Column:
    """Family: after the current family, up to the end of the target's. Exact: after current, up to target."""
    check_interval(current, target, mode)
    if mode == "family":
        return (key >= constant_key(family_end(current))) & (key < constant_key(family_end(target)))
    return (key > constant_key(key_of(current))) & (key <= constant_key(key_of(target)))


def in_scope(key: Column, current: str, target: str, mode: str = "family") -> Column:
    """The wider scope of collection: the current family counts as well."""
    check_interval(current, target, mode)
    end = key < constant_key(family_end(target)) if mode == "family" else key <= constant_key(key_of(target))
    return (key >= constant_key(key_of(current))) & end


def is_endpoint(key: Column, endpoint: str, mode: str = "family") -> Column:
    if mode == "family":
        return (key >= constant_key(key_of(endpoint))) & (key < constant_key(family_end(endpoint)))
    return key == constant_key(key_of(endpoint))


def milestone(key: Column, numbers: int) -> Column:
    """The key's first ``numbers`` numbers as a label."""
    return F.array_join(F.transform(F.slice(key, 1, numbers), lambda p: p.cast("string")), ".")


def version_tokens(text: Column) -> Column:
    """Dotted version numbers in a text, in order."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(TOKEN_RUN), F.lit(0)), lambda r: r.rlike(TOKEN))
    return F.transform(runs, lambda r: F.regexp_extract(r, r"[0-9]+(\.[0-9]+)+", 0))


def version_mentions(text: Column, versions: Column) -> Column:
    """Those of ``versions`` whose labels stand in the text as numbers of their own, in the order of ``versions``."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(TOKEN_RUN), F.lit(0)), lambda r: r.rlike(r"^v?[0-9]+(\.[0-9]+){0,3}$"))
    return F.array_intersect(versions, F.transform(runs, lambda r: F.regexp_replace(r, "^v", "")))


def short_forms(label: Column) -> Column:
    """The label and its forms without trailing zeros: 18.0.0, 18.0, 18."""
    parts = F.split(label, r"\.")
    sizes = F.sequence(F.size(parts), F.lit(1), F.lit(-1))
    kept = F.filter(sizes, lambda n: F.forall(F.slice(parts, n + 1, F.size(parts)), lambda p: p == "0"))
    return F.transform(kept, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def names_version(text: Column, label: Column) -> Column:
    """Whether the text names the release, by its label or a short form of it."""
    forms = F.array_join(F.transform(short_forms(label), lambda f: F.replace(f, F.lit("."), F.lit(r"\."))), "|")
    return F.regexp_like(text, F.concat(F.lit(r"(?<![\p{L}\p{N}_.])v?(?:"), forms, F.lit(r")(?:\.0)*(?![\p{L}\p{N}_]|\.[0-9])")))


def milestone_named(title: Column, path: Column, milestones: Sequence[str]) -> Column:
    """The milestones that a title or a URL path names."""
    slug = F.regexp_replace(F.regexp_replace(path, r"(?<=[0-9])[-_](?=[0-9])", "."), r"[/_-]+", " ")
    probe = F.concat(title, F.lit(" "), slug)
    pattern = r"(?i)(?<![\p{{L}}\p{{N}}_.])v?{}(?![\p{{L}}\p{{N}}_]|\.[0-9])"
    return F.array_compact(F.array(*(F.when(probe.rlike(pattern.format(re.escape(m))), F.lit(m)) for m in milestones)))
