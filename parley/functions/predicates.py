"""Predicates and small parsers of keys, names and notes, as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_honorific, stripped


def is_target(key: Column, wanted: Column) -> Column:
    """Whether ``wanted`` is the key's stem, or project and stem, without extensions."""
    bare = lambda c: F.regexp_replace(c, r"\.(?:md|txt|m4a)$", "")
    return (bare(wanted) == bare(key)) | (bare(wanted) == F.regexp_replace(bare(key), r"^.*/", ""))


def is_canonical(key: Column) -> Column:
    """notes/<project>/<meeting>.md, without steps upwards."""
    return key.rlike(r"^notes/[^/]+/[^/]+\.md$") & ~key.rlike(r"(?:^|/)\.\.?(?:/|$)")


def confirmed_target(target: Column) -> Column:
    """A ledger target, or null if it ends in a hedge, begins with a quote, or is over 45 characters long."""
    t = stripped(target)
    bad = t.rlike(r"(?:추정|확인 필요|검증 필요|후보|가능성|잠정)\s*$") | t.rlike("^[\"'“‘]") | (F.length(t) > 45) | (t == "")
    return F.when(~bad, t)


def mentions_person(text: Column) -> Column:
    """A Hangul name in a form of address."""
    return text.rlike("[가-힣]{2,5}(?:님|씨)")


def name_tokens(text: Column) -> Column:
    """Hangul runs of two to five syllables; those in a form of address first, each once."""
    addressed = F.transform(F.regexp_extract_all(text, F.lit("[가-힣]{2,5}(?:님|씨)"), F.lit(0)), lambda x: strip_honorific(x))
    return F.array_distinct(F.concat(addressed, F.regexp_extract_all(text, F.lit("[가-힣]{2,5}"), F.lit(0))))


def name_and_team(value: Column) -> tuple[Column, Column]:
    """Name_Team."""
    part = lambda i: F.trim(F.regexp_extract(value, r"^([^_]+)_(.+)$", i))
    return F.when(part(1) != "", part(1)).otherwise(F.trim(value)), part(2)


def safe_stem(value: Column) -> Column:
    """a file-system-safe stem."""
    return F.regexp_replace(F.trim(value), r"[^0-9A-Za-z가-힣._-]+", "_")


def acronyms(text: Column) -> Column:
    """upper-case acronyms of two to eight letters, first ones kept."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b[A-Z][A-Z0-9]{1,7}\b"), F.lit(0)))


def marked_terms(text: Column) -> Column:
    """what stands in bold, in backticks or after an arrow."""
    one = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(1))
    return F.array_distinct(F.transform(F.concat(one(r"\*\*([^*\n]+)\*\*"), one("`([^`\n]+)`"), one(r"(?:->|→)\s*([^\s,;]+)")), lambda x: F.trim(x)))


def note_time(text: Column) -> Column:
    """The first date, with its time if one follows, as it is written: a date alone stays a date."""
    full = F.regexp_extract(text, r"([0-9]{4})[-./]([0-9]{1,2})[-./]([0-9]{1,2})(?:[ T]+([0-9]{1,2}):([0-9]{2}))?", 0)
    part = lambda i: F.regexp_extract(full, r"([0-9]{4})[-./]([0-9]{1,2})[-./]([0-9]{1,2})(?:[ T]+([0-9]{1,2}):([0-9]{2}))?", i)
    day = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    return F.when(full != "", F.when(part(4) != "", F.concat(day, F.lit("T"), F.lpad(part(4), 2, "0"), F.lit(":"), part(5))).otherwise(day))


def unexpired(until: Column, now: Column) -> Column:
    """a moment with a time zone that isn't past; one without a zone never counts."""
    zoned = until.rlike(r"(?:Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.coalesce(zoned & (F.try_to_timestamp(until) >= now), F.lit(False))
