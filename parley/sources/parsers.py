"""Parsers: text and JSON columns to rows. Line order is always an explicit column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas


def numbered_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """S3: one row per line: the other columns, line_no from 0, line."""
    return df.select(*(c for c in df.columns if c != text), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def transcript_rows(lines: DataFrame) -> DataFrame:
    """S3: lines of the form [hh:mm:ss - hh:mm:ss] S: text; others keep nulls."""
    row = r"^\[(\d{2}:\d{2}:\d{2}) - (\d{2}:\d{2}:\d{2})\] ([^:]+): (.*)$"
    part = lambda i: F.when(F.col("line").rlike(row), F.regexp_extract("line", row, i))
    return lines.select("*", part(1).alias("start"), part(2).alias("end"), part(3).alias("speaker"), part(4).alias("text"))


def words_of(segments: DataFrame) -> DataFrame:
    """Nested segments (meeting_id, segments) to words with both bounds, in order of time."""
    s = segments.select("meeting_id", F.posexplode("segments").alias("seq", "s"))
    w = s.select("meeting_id", "seq", F.explode("s.words").alias("w")).select("meeting_id", "w.*").filter("`start` is not null and `end` is not null")
    return w.withColumn("word_idx", F.row_number().over(Window.partitionBy("meeting_id").orderBy("start", "end")) - 1)


def turns_of(diarized: DataFrame) -> DataFrame:
    """Diarization segments that don't end before they begin."""
    t = diarized.select("meeting_id", F.posexplode("segments").alias("turn_idx", "s")).select("meeting_id", "turn_idx", "s.start", "s.end", "s.speaker")
    return t.filter("`end` >= `start`")


def json_or_empty(text: Column, schema: str) -> Column:
    """A JSON document, unwrapped from a code fence; null where it isn't one."""
    bare = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.from_json(F.when(bare != "", bare).otherwise(text), schema)


def ledger(lines: DataFrame, dialect: str = "scan") -> DataFrame:
    """Lines '- a / b → **target** (n회)' to one row per variant, however long, in a dialect of F6."""
    row = r"^\s*[-*]\s*(.+?)\s*(?:->|→)\s*\*\*([^*]+)\*\*.*?\((\d+)회\)"
    from ..functions.text import variants

    hit = lines.filter(F.col("line").rlike(row))
    return hit.select(F.explode(variants(F.regexp_extract("line", row, 1), dialect)).alias("variant"), F.trim(F.regexp_extract("line", row, 2)).alias("target"), F.regexp_extract("line", row, 3).cast("int").alias("count"))


def pipe_table(lines: DataFrame, key: str) -> DataFrame:
    """Markdown table rows with the heading above them carried down as department."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = F.regexp_extract("line", r"^##\s+(.+?)\s*$", 1)
    carried = lines.withColumn("department", F.last(F.when(head != "", head), ignorenulls=True).over(w))
    cells = F.transform(F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(c))
    rows = carried.filter(F.col("line").rlike(r"^\s*\|") & ~F.col("line").rlike(r"^\s*\|[\s:|-]+\|?\s*$"))
    return rows.select(key, "line_no", "department", cells.alias("cells"))


def names_in(text: Column) -> Column:
    """The Hangul names of a list split at commas, slashes and line ends, first ones kept."""
    return F.array_distinct(F.filter(F.transform(F.split(text, r"[,/\n]"), lambda x: F.trim(x)), lambda x: x.rlike("^[가-힣]{2,5}$")))


def queue_entries(lines: DataFrame) -> DataFrame:
    """Entries of a queue file without comments and blanks, the first of each kept, in order."""
    e = lines.select("line_no", F.trim("line").alias("entry")).filter("entry <> '' and not entry like '#%'")
    return e.groupBy("entry").agg(F.min("line_no").alias("line_no"))


def silences(log: DataFrame) -> DataFrame:
    """The silences of a detector's log (path, line_no, line): a start and the end that follows."""
    at = lambda kind: F.regexp_extract("line", rf"silence_{kind}: (-?[0-9.]+)", 1)
    events = log.select("path", "line_no", F.when(at("start") != "", F.lit("start")).when(at("end") != "", F.lit("end")).alias("kind"), F.coalesce(F.nullif(at("start"), F.lit("")), F.nullif(at("end"), F.lit(""))).cast("double").alias("t")).filter("kind is not null")
    w = Window.partitionBy("path").orderBy("line_no")
    paired = events.withColumn("end", F.when(F.lead("kind").over(w) == "end", F.lead("t").over(w)))
    return paired.filter("kind = 'start'").select("path", F.greatest("t", F.lit(0.0)).alias("silence_start"), F.col("end").alias("silence_end"))


def block_text(blocks: DataFrame) -> DataFrame:
    """The titles of a parent's living children, in the parent's order."""
    kids = blocks.filter("alive = 1").select(F.col("id").alias("parent"), F.posexplode(F.from_json("content", "array<string>")).alias("pos", "id"))
    title = F.array_join(F.transform(F.from_json("properties", schemas.PROPERTIES)["title"], lambda x: x[0]), "")
    named = blocks.filter("alive = 1").select("id", title.alias("title"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "title")))
    return kids.join(named, "id").groupBy("parent").agg(F.array_join(F.transform(ordered, lambda x: x["title"]), "\n").alias("text"))
