"""Audits of batches of candidate notes, and the context that a search gives to a note's writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .notes import ACTION, APPENDIX, HEADINGS, contract

DENSE_LINES, LONG_TITLE = 65, 90


def missing_refs(primary: Column, text: Column) -> Column:
    """The evidence numbers that the reader's sections name and no heading has, in order."""
    named = F.regexp_extract_all(primary, F.lit(r"§(4\.[0-9]+)"), F.lit(1))
    there = F.regexp_extract_all(text, F.lit(r"(?m)^###\s+(4\.[0-9]+)\s+"), F.lit(1))
    return F.array_sort(F.array_except(named, there))


def broken_anchors(readable: Column) -> Column:
    """The local links of a readable note that no evidence heading of it answers, in order."""
    linked = F.regexp_extract_all(readable, F.lit(r"\[[^\]]+\]\((#[^)]+)\)"), F.lit(1))
    heads = F.transform(F.regexp_extract_all(readable, F.lit(r"(?m)^###\s+(4\.[0-9]+\s+.+)$"), F.lit(1)), lambda h: T.anchor(F.regexp_replace(h, r"^(\S+)\s+", "$1 ")))
    return F.array_sort(F.array_except(linked, heads))


def missing_attendees(confirmed: Column, body: Column) -> Column:
    """The confirmed attendees that a note's list doesn't hold."""
    return F.filter(confirmed, lambda name: ~F.contains(body, name))


def first_screen(readable: Column) -> Column:
    """the lines before the section of details."""
    return F.size(F.split(F.regexp_replace(F.split(readable, rf"\Q{HEADINGS[3]}\E", 2)[0], r"\n\z", ""), "\n"))


def audited(notes: DataFrame) -> DataFrame:
    """Per candidate (note_key, text, transcript: whether its source is there, confirmed: attendees, candidate: its readable form or null, faithful: whether that
    is exactly the note's, review: whether one is there, assets: whether all pictures are there with their hashes) a status with errors (E13's and those
    of the batch, in order) and warnings."""
    body = lambda heading, until: T.stripped(F.regexp_extract("text", rf"(?sm)\Q{heading}\E[^\n]*\n(.*?)(?={until}|\z)", 1))
    x = notes.join(contract(notes.select("note_key", "text")).withColumnRenamed("errors", "broken"), "note_key")
    x = x.withColumn("absent", missing_attendees(F.coalesce("confirmed", F.array().cast("array<string>")), body(APPENDIX[0], r"^#{2,3}\s")))
    x = x.withColumn("refs", missing_refs(F.concat_ws("\n", *(body(h, r"^##\s") for h in HEADINGS[:3])), F.col("text"))).withColumn("anchors", broken_anchors(F.coalesce("candidate", F.lit(""))))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    some = lambda c, name: F.when(F.size(c) > 0, F.concat(F.lit(f"{name}: "), F.array_join(c, ", ")))
    more = F.filter(F.array(
        F.when(~yes("transcript"), "no transcript"), some("absent", "attendees missing"), some("refs", "evidence missing"), F.when(F.col("candidate").isNull(), "no readable form"),
        F.when(F.col("candidate").isNotNull() & ~yes("faithful"), "readable form differs"), some("anchors", "broken links"), F.when(~yes("assets"), "pictures missing or changed"), F.when(~yes("review"), "no review"),
    ), lambda e: e.isNotNull())
    titles = F.regexp_extract_all("text", F.lit(f"(?m){ACTION}"), F.lit(2))
    long = F.size(F.filter(titles, lambda t: F.length(t) > LONG_TITLE))
    warnings = F.filter(F.array(F.when(F.col("candidate").isNotNull() & (first_screen(F.col("candidate")) > DENSE_LINES), "first screen is dense"), F.when(long > 0, F.concat(F.lit("long action titles: "), long.cast("string")))), lambda w: w.isNotNull())
    errors = F.concat("broken", more)
    return x.select("note_key", F.when(F.size(errors) == 0, "pass").otherwise("fail").alias("status"), errors.alias("errors"), warnings.alias("warnings"))


# The headings of the context.
CONTEXT, TERMS, RELATED, EVIDENCE, NONE = "# 회의 전 근거 컨텍스트", "## 검색어", "## 관련 회의", "## 근거 후보", "- 해당 없음"


def context(rows: DataFrame) -> DataFrame:
    """Per note (note; terms: array; related: array of title, date, team, decision_count, open_action_count, risk_count, topics, mentions, decisions;
    confirmed: array of names; found: array of term, source, title, day, place, snippet in order) its context as Markdown."""
    none = F.array().cast("array<string>")
    line = lambda label, values: F.when(F.size(values) > 0, F.concat(F.lit(f"- {label}: "), F.array_join(values, ", ")))

    def meeting(m: Column) -> Column:
        team = F.when(F.coalesce(m["team"], F.lit("")) != "", F.concat(F.lit(" · "), m["team"])).otherwise("")
        counts = F.format_string("- 집계: 결정 %d · 미결액션 %d · 리스크 %d", *(F.coalesce(m[c], F.lit(0)).cast("int") for c in ("decision_count", "open_action_count", "risk_count")))
        told = F.array(F.lit(""), F.concat(F.lit("### "), F.coalesce(m["date"], F.lit("날짜 미상")), team, F.lit(" — "), F.coalesce(m["title"], F.lit("(제목 없음)"))), counts, line("주제", m["topics"]), line("언급 인물", m["mentions"]), line("결정 요지", m["decisions"]))
        return F.filter(told, lambda x: x.isNotNull())

    def hits(term: Column) -> Column:
        own = F.filter("found", lambda f: f["term"] == term)
        each = F.flatten(F.transform(own, lambda f: F.array(F.concat(F.lit("- ["), f["source"], F.lit("] "), f["title"], F.lit(" ("), F.coalesce(f["day"], F.lit("date unknown")), F.lit(")")), F.concat(F.lit("  - ref: `"), f["place"], F.lit("`")), F.concat(F.lit("  - snippet: "), F.coalesce(F.nullif(f["snippet"], F.lit("")), F.lit("snippet 없음"))))))
        present = F.concat(F.lit("- source presence: "), F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda f: f["source"]))), ", "))
        head = F.array(F.lit(""), F.concat(F.lit("### `"), term, F.lit("`")))
        return F.concat(head, F.when(F.size(own) == 0, F.array(F.lit("- hit 없음"))).otherwise(F.concat(F.array(present), each)))

    asked = F.when(F.size("terms") == 0, F.array(F.lit(NONE))).otherwise(F.transform("terms", lambda t: F.concat(F.lit("- `"), t, F.lit("`"))))
    meetings = F.when(F.size("related") == 0, F.array(F.lit("- 관련 회의 없음"))).otherwise(F.flatten(F.transform("related", meeting)))
    known = F.when(F.size("confirmed") > 0, F.array(F.lit(""), F.concat(F.lit("- 사내 인물로 확인됨: "), F.array_join("confirmed", ", ")))).otherwise(none)
    lines = F.concat(F.array(F.lit(CONTEXT), F.lit(""), F.lit(TERMS)), asked, F.array(F.lit(""), F.lit(RELATED)), meetings, known, F.array(F.lit(""), F.lit(EVIDENCE)), F.flatten(F.transform("terms", hits)))
    return rows.select("note", F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("context"))
