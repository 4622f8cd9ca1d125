"""Publication: admission to the queue, approval, history, metadata, attendees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.text import stripped


def _packed(sha: str) -> Column:
    """A hex digest as its 32 bytes; any other text as its UTF-8 bytes behind 33 zero bytes: equal for equal texts alone."""
    other = F.concat(F.lit(b"\0" * 33), F.encode(sha, "UTF-8"))
    return F.when(F.col(sha).rlike(r"\A[0-9a-f]{64}\z"), F.unhex(sha)).otherwise(other)


def admitted(receipts: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Keys whose artifacts are all there and have the hashes of their receipt (key, kind, sha256)."""
    # by key alone, so that what is joined is summed where it lies; a key's few kinds are compared within it. Digests move as bytes.
    r = receipts.select("key", F.col("kind").alias("_kind"), _packed("sha256").alias("_was"))
    a = artifacts.select(F.col("key").alias("_key"), F.col("kind").alias("_of"), _packed("sha256").alias("_now"))
    same = (F.col("key") == F.col("_key")) & (F.col("_kind") <= F.col("_of")) & (F.col("_kind") >= F.col("_of"))
    x = r.join(a, same, "left")
    return x.groupBy("key").agg(F.count_if(F.col("_now").isNull()).alias("missing"), F.count_if(F.col("_now") != F.col("_was")).alias("stale")).withColumn("ready", (F.col("missing") == 0) & (F.col("stale") == 0))


def approved(requests: DataFrame, approvals: DataFrame, now: Column) -> DataFrame:
    """Whether an approval (key, source_sha256, visibility, expires) matches its request exactly and isn't past; with the reason if not."""
    a = approvals.select("key", F.col("source_sha256").alias("a_sha"), F.col("visibility").alias("a_visibility"), "expires")
    x = requests.join(a, "key", "left")
    why = F.when(F.col("a_sha").isNull(), "no approval").when(F.col("a_sha") != F.col("source_sha256"), "source changed").when(~F.col("a_visibility").eqNullSafe(F.col("visibility")), "visibility differs").when(~P.unexpired(F.col("expires"), now), "expired").otherwise("ok")
    return x.select("key", why.alias("verdict"))


def history(before: DataFrame, published: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The latest page of each key (key, page_id, at), and pages that a new one replaced, to be cleaned up."""
    both = before.unionByName(published)
    w = Window.partitionBy("key").orderBy(F.desc("at"), F.desc("page_id"))
    ranked = both.withColumn("r", F.row_number().over(w))
    latest = ranked.filter("r = 1").drop("r")
    old = both.select("key", "page_id").distinct().join(latest.select("key", "page_id"), ["key", "page_id"], "left_anti")
    return latest, old


# What an attendee line or a recording's label says besides names.
PRIVATE = r"(?<![0-9A-Za-z가-힣])비공개(?![0-9A-Za-z가-힣])"
DATED = r"(?:^|[_\s-])20[0-9]{6}(?:[_\s-]?[0-9]{6})?(?:$|[_\s-])"
GENERIC = ("미팅", "회의", "녹음", "음성", "새로운", "참석자", "비공개", "meeting")
NAME = "^[가-힣]{2,4}$"


def attendees(line: Column, roster: Column) -> Column:
    """The names of an attendee line, each once: privacy mark, heading, dates and generic labels go; with a roster only its names stay, without
    one what looks like a name."""
    bare = F.regexp_replace(line, PRIVATE, " ")
    for mark in (r"(?i)^\s*참석자\s*:\s*", DATED, r"(?i)\bmeeting\b", r"(?:^|[\s_-])미팅(?:$|[\s_-])"):
        bare = F.regexp_replace(bare, mark, "" if mark.startswith("(?i)^") else " ")
    parts = F.filter(F.split(bare, r"[,，+&/\s_-]+"), lambda x: (x != "") & ~F.lower(x).isin(*GENERIC))
    return F.array_distinct(F.filter(parts, lambda x: F.when(F.size(roster) > 0, F.array_contains(roster, x)).otherwise(x.rlike(NAME))))


def first_attendees(*sources: Column) -> Column:
    """The first source that isn't empty."""
    return F.coalesce(*(F.when(F.size(s) > 0, s) for s in sources), F.array().cast("array<string>"))


# The headings that a summary stands under.
SUMMARIES = (r"## 1\. 핵심 결론 및 결정사항", r"## 1\. 핵심 요약")


def plain_inline(text: Column) -> Column:
    """Links, code, bold and struck text reduced to what they say."""
    for mark, kept in ((r"\[([^\]]+)\]\([^)]+\)", "$1"), ("`([^`]*)`", "$1"), (r"(\*\*|__)(.+?)\1", "$2"), ("~~(.+?)~~", "$1")):
        text = F.regexp_replace(text, mark, kept)
    return stripped(text)


def admission(notes: DataFrame) -> DataFrame:
    """Per note of the queue, with the flags that ``state.audit`` takes, the first reason why it can't be published; ok if there is none."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    why = F.lit("ok")
    order = (("exists", "no note"), ("transcript", "no transcript"), ("valid", "contract broken"), ("preview", "no readable form"), ("preview_faithful", "readable form differs"), ("review", "review incomplete"), ("review_valid", "review invalid"), ("receipt", "no receipt"), ("receipt_valid", "receipt invalid"), ("receipt_current", "receipt outdated"))
    for flag, name in reversed(order):
        why = F.when(~yes(flag), name).otherwise(why)
    return notes.select("key", why.alias("admission"))


def metadata(notes: DataFrame, most: int = 2000) -> DataFrame:
    """Title, time and summary of each note (note_key, text)."""
    t = F.col("text")
    title = F.coalesce(F.nullif(F.trim(F.regexp_extract(t, r"(?m)^# (.+)$", 1)), F.lit("")), F.regexp_replace("note_key", r"^.*/|\.md$", ""))
    body = F.regexp_extract(t, rf"(?sm)^\s*(?:{'|'.join(SUMMARIES)})\s*$(.*?)(?=^\s*##\s+\S|\z)", 1)
    lines = F.transform(F.split(body, "\n"), lambda x: plain_inline(F.regexp_replace(stripped(x), r"^(?:[-+*]|[0-9]+[.)])\s+", "")))
    summary = F.substring(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), 1, most)
    return notes.select("note_key", title.alias("title"), P.note_time(t).alias("time"), summary.alias("summary"))
