"""Scalar functions over texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of every kind, in one class that Java and RE2 read alike.
SPACE = r"[\s\p{Z}]+"
# Topic names and the patterns that nominate a section for them.
TOPICS: dict[str, str] = {
    "breaking_change": r"breaking change|\bbreaking\b|backwards?[- ]incompatib|incompatible change",
    "deprecation": r"deprecat",
    "removal": r"\bremov(?:ed|al|es)\b|\bdrop(?:ped|s)? support|no longer (?:available|exported|supported|included)",
    "changed_default": r"\bdefaults? (?:to|is now|now|changed|has changed)|chang(?:e|ed|es) (?:the )?default|new default|now (?:enabled|disabled|on|off) by default",
    "behavior_change": r"behaviou?rs? (?:change|differently)|behaves? differently|now (?:throws?|warns?|errors?|returns?|raises?|fails?)|stricter|no longer (?:\w+ ){0,2}(?:accepts?|allows?|returns?|works?)",
    "runtime_requirement": r"requires? (?:python|node(?:\.js)?|go|java|kernel|glibc)|minimum (?:supported )?(?:python|node|go|runtime)|(?:python|node(?:\.js)?) \d+(?:\.\d+)? (?:or (?:later|newer|higher)|\+|is required)|supported (?:python|node(?:\.js)?) versions?",
    "dependency_requirement": r"peer ?dependenc|\bdependenc(?:y|ies)\b|minimum (?:supported )?version of|requires? [\w.@/-]+ (?:>=|version) ?\d",
    "configuration_change": r"\bsettings?\b|config(?:uration)? (?:option|key|file|setting|parameter)|\bflag\b|environment variable|feature gates?|\brenamed?\b",
    "migration_step": r"migrat|how to upgrade|upgrade guide|\bupgrading\b|replace [\w.`()]+(?: [\w.`()]+){0,3} with|instead of|use [\w.`()]+ instead",
    "data_migration": r"pg_upgrade|pg_dump|dump and restore|schema migration|data (?:format|migration)|on-disk format|\breindex|storage version|catalog version",
    "api_change": r"\bnew (?:api|method|hook)s?\b|\bsignature\b|exported from|\bapis?\b (?:changed|removed|renamed)",
    "known_issue": r"known (?:issue|problem|bug)s?|\bregression|\bworkaround|\bcaveat",
    "security": r"\bsecurity\b|cve-\d{4}|vulnerab",
}


def collapsed(text: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def loose(text: Column) -> Column:
    """``collapsed``, with Markdown's markers as white space: the form in which quotes are compared."""
    return collapsed(F.translate(text, "`*_>#", "     "))


def fingerprint(text: Column) -> Column:
    """Lower-case letters and digits, everything between them one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def subject_key(subject: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(subject), F.lit("()")), "[^a-z0-9.]+", "")


def slug(text: Column, limit: int = 60) -> Column:
    made = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    made = F.regexp_replace(F.substring(made, 1, limit), "_+$", "")
    return F.when(made == "", F.lit("item")).otherwise(made)


def alphanumeric(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def topics(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """Names of the topics whose patterns the text matches, in the order of the dictionary."""
    found = (F.when(text.rlike(f"(?i){p}"), F.lit(name)) for name, p in (patterns or TOPICS).items())
    return F.array_compact(F.array(*found))


def urls(text: Column) -> Column:
    """Bare URLs in a text, without a full stop or comma at their end."""
    found = F.regexp_extract_all(text, F.lit(r"https?://[^\s<>\"\)]+"), F.lit(0))
    return F.transform(found, lambda u: F.regexp_replace(u, "[.,]+$", ""))


def issue_references(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?:^|[^\w&])#([0-9]+)"), F.lit(1)), lambda n: n.cast("bigint"))


def diagnostic_note(note: Column) -> Column:
    """Whether an old mixed note tells how a run went, rather than what is unknown about the upgrade."""
    # Wordings of such notes.
    return note.rlike(
        r"relevant sections were not (?:processed|extracted)|extracted facts were rejected|^Extraction \w+ step failed|"
        r"sections had no relevance verdict|^No entailment judge ran|conditions were not judged|^The judge failed|contextual facts cite evidence"
    )


def divergence(quote: Column, text: Column) -> Column:
    """Length of the longest start of ``quote`` that ``text`` holds, by binary search in a bounded fold."""
    start = F.struct(F.lit(0).alias("low"), F.length(quote).alias("high"))

    def halve(a: Column, _: Column) -> Column:
        middle = F.ceil((a.low + a.high) / 2).cast("int")
        inside = F.contains(text, F.substring(quote, F.lit(1), middle))
        return F.struct(F.when(inside, middle).otherwise(a.low).alias("low"), F.when(inside, a.high).otherwise(F.greatest(a.low, middle - 1)).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(24)), start, halve, lambda a: a.low)
