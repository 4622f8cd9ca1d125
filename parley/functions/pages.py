"""Pages of a notes service, recordings and requests, as column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import collapsed, stripped

# Parts of names that are no people's, the names that a page's properties go by, and what an approval must hold.
EXCLUDED = ("테스트", "관리자", "운영자", "test", "admin")
PREFERRED = {"title": ("title", ("이름", "Name", "Title", "title")), "date": ("date", ("미팅일시", "Meeting Date", "Date", "날짜")), "participants": ("rich_text", ("참여자", "Participants")), "meeting_type": ("select", ("회의구분", "Type", "구분"))}
SNAPSHOT = ("source_path", "source_sha256", "readable_path", "readable_sha256", "target_data_source_id")
APPROVAL = ("approval_id", "request_path", "request_sha256", *SNAPSHOT, "expires_at")
PROPERTIES = "map<string, struct<type: string, title: array<struct<plain_text: string>>>>"
HISTORY = "struct<version: int, entries: map<string, struct<name: string, department: string, employment_status: string>>>"


def excluded(name: Column) -> Column:
    """P10: a name of a test, an administrator or the like."""
    return F.lower(name).rlike("|".join(EXCLUDED))


def property_of(properties: Column, kind: str, preferred: tuple[str, ...]) -> Column:
    """of a map of properties (name to type) the first preferred name of this type, else the first of that type by name; null if there is none."""
    named = F.filter(F.array(*map(F.lit, preferred)), lambda n: F.try_element_at(properties, n).eqNullSafe(F.lit(kind)))
    other = F.array_sort(F.map_keys(F.map_filter(properties, lambda _, t: t.eqNullSafe(F.lit(kind)))))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at(other, F.lit(1)))


def schema_of(properties: Column) -> Column:
    """the properties that a notes table is written by, from a map of name to type."""
    return F.struct(*(property_of(properties, kind, names).alias(field) for field, (kind, names) in PREFERRED.items()))


def page_title(page: Column) -> Column:
    """the plain text of a page's title, from the page's properties in JSON; empty without one."""
    titled = F.filter(F.map_values(F.from_json(page, PROPERTIES)), lambda p: (p["type"] == "title") & (F.size(p["title"]) > 0))
    first = F.try_element_at(titled, F.lit(1))["title"]
    return F.coalesce(stripped(F.array_join(F.transform(first, lambda t: F.coalesce(t["plain_text"], F.lit(""))), "")), F.lit(""))


def page_time(created: Column, edited: Column) -> Column:
    """when a page was made, else last edited, as a moment."""
    return F.try_to_timestamp(F.coalesce(F.nullif(created, F.lit("")), edited))


def recording_context(path: Column, labels: Column) -> tuple[Column, Column, Column]:
    """project, stem and label of a note at notes/<project>/<stem>.md; the label is the one given, else the stem."""
    project = F.regexp_extract(path, r"^notes/([^/]+)/[^/]+$", 1)
    stem = F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]*$", "")
    return project, stem, F.coalesce(F.nullif(collapsed(labels), F.lit("")), stem)


def history_of(text: Column) -> Column:
    """the entries of a roster history in JSON; empty where the text isn't one."""
    return F.coalesce(F.from_json(text, HISTORY)["entries"], F.from_json(F.lit("{}"), HISTORY.split("entries: ")[1][:-1]))


def accepted(decisions: DataFrame) -> DataFrame:
    """the accepted patches of manifests (version, decisions), in order, with the counts of both kinds."""
    yes = F.filter("decisions", lambda p: p["accepted"])
    return decisions.select("version", F.size(yes).alias("accepted"), (F.size("decisions") - F.size(yes)).alias("rejected"), yes.alias("patches"))


def requests(notes: DataFrame, published: DataFrame) -> DataFrame:
    """F64: a publication request per note (key, and SNAPSHOT's fields): these, what was published before, and the request's own hash;
    ``missing`` names the fields that are empty, without which there is no request."""
    x = notes.join(published.select("key", F.col("page_id").alias("existing")), "key", "left")
    lacks = F.filter(F.array(*(F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c)) for c in SNAPSHOT)), lambda c: c.isNotNull())
    return x.withColumn("missing", lacks).withColumn("request_sha256", F.when(F.size("missing") == 0, F.sha2(F.to_json(F.struct(*SNAPSHOT)), 256)))


def approval_missing(approval: Column) -> Column:
    """F64: the fields of APPROVAL that an approval (a struct) lacks."""
    return F.filter(F.array(*(F.when(F.coalesce(F.trim(approval[c]), F.lit("")) == "", F.lit(c)) for c in APPROVAL)), lambda c: c.isNotNull())


def unescaped_export(markdown: Column) -> Column:
    """doubled escapes before Markdown's marks made single."""
    return F.regexp_replace(markdown, r"\\\\(?=[\\*~`$\[\]<>{}|^_])", r"\\")


def verified_export(markdown: Column, marker: Column) -> Column:
    """an exported page with its first embed replaced by the picture's marker; null if there should be one and is none. Without a marker the text alone."""
    embed = r"(?ms)^<embed\b[^>]*(?:/>|>.*?</embed>)\s*$"
    text = unescaped_export(F.concat(F.regexp_replace(markdown, r"\s+\z", ""), F.lit("\n")))
    at = F.regexp_instr(text, F.lit(embed))
    hit = F.regexp_extract(text, embed, 0)
    swapped = F.concat(F.substring(text, F.lit(1), at - 1), marker, F.substring(text, at + F.length(hit), F.length(text)))
    return F.when(F.coalesce(marker, F.lit("")) == "", text).when(at > 0, swapped)


def clamped(start: Column, end: Column, pad: Column | float, duration: Column) -> tuple[Column, Column]:
    """an interval padded at both ends, within a recording."""
    return F.greatest(start - pad, F.lit(0.0)), F.least(end + pad, duration)


def ratio(part: Column, whole: Column, least: float = 1.0) -> Column:
    """a share that is defined for an empty whole too."""
    return part / F.greatest(whole, F.lit(least))


def half_even(value: Column, digits: int) -> Column:
    """rounded to even at halves, as binary floats are elsewhere."""
    return F.bround(value, digits)


def compact(text: Column) -> Column:
    """without white space, in lower case."""
    return F.lower(F.regexp_replace(text, r"\s+", ""))


def segment_text(segments: Column) -> Column:
    """the texts of segments in order, joined by spaces."""
    return stripped(F.array_join(F.transform(segments, lambda s: stripped(F.coalesce(s["text"], F.lit("")))), " "))


def word_spans(segments: Column) -> Column:
    """the (start, end) of the words that have both, in order."""
    return F.filter(F.flatten(F.transform(segments, lambda s: F.transform(F.coalesce(s["words"], F.array().cast("array<struct<start: double, end: double, word: string>>")), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"))))), lambda w: w["start"].isNotNull() & w["end"].isNotNull())
