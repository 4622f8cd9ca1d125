"""Interval operators: words and speaker turns.

Every join has an equality on the meeting, and on a time bucket where both sides may be long, so
Spark joins by hash or merge and a long meeting is spread over many tasks; the range conditions are
residuals. Buckets are a parameter; a pair met in several buckets is kept in one of them, the one where the later
interval begins, so no distinct is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import joined_words, stripped


def _buckets(start: Column, end: Column, width: int) -> Column:
    return F.sequence(F.floor(start / width).cast("long"), F.floor(end / width).cast("long"))


def met(words: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """Pairs of words (meeting, word, ws, we) and turns (meeting, turn, speaker, ts, te) that
    touch, ends included; each pair once."""
    w = words.withColumn("bucket", F.explode(_buckets(F.col("ws"), F.col("we"), width)))
    t = turns.filter("te >= ts").withColumn("bucket", F.explode(_buckets(F.col("ts"), F.col("te"), width)))
    once = F.col("bucket") == F.floor(F.greatest("ws", "ts") / width)
    return w.join(t, ["meeting", "bucket"]).filter((F.col("ts") <= F.col("we")) & (F.col("te") >= F.col("ws")) & once).drop("bucket")


def assign_midpoint(words: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """The first turn that holds the word's midpoint, else the one of most overlap, else null."""
    mid2 = F.col("ws") + F.col("we")
    hit = (2 * F.col("ts") <= mid2) & (mid2 <= 2 * F.col("te"))
    over = F.least("we", "te") - F.greatest("ws", "ts")
    best = met(words, turns, width).groupBy("meeting", "word").agg(
        F.min_by("speaker", F.when(hit, F.col("turn"))).alias("held"), F.count_if(hit).alias("hits"),
        F.max_by("speaker", F.when(over > 0, F.struct(over, -F.col("turn")))).alias("near"), F.count_if(over > 0).alias("overs"),
    )
    chosen = F.when(F.col("hits") > 0, F.col("held")).when(F.col("overs") > 0, F.col("near"))
    return words.join(best.select("meeting", "word", chosen.alias("speaker")), ["meeting", "word"], "left")


def overlaps(words: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """Summed positive overlap of each word with each speaker, and that speaker's first start."""
    over = F.least("we", "te") - F.greatest("ws", "ts")
    return met(words, turns, width).withColumn("over", over).filter("over > 0").groupBy("meeting", "word", "ws", "we", "speaker").agg(F.sum("over").alias("score"), F.min("ts").alias("first"))


def simultaneous(words: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """Words within which turns of two speakers overlap. A speaker's turns are joined where they overlap; then any that begins
    before the latest end so far does so within another speaker's."""
    inside = met(words, turns, width).filter("least(we, te) > greatest(ws, ts) and speaker is not null").select("meeting", "word", "speaker", F.greatest("ws", "ts").alias("s"), F.least("we", "te").alias("e"))
    before = lambda *keys: F.max("e").over(Window.partitionBy(*keys).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    own = ["meeting", "word", "speaker"]
    flagged = inside.withColumn("_new", F.coalesce(F.col("s") >= before(*own), F.lit(True)))
    joined = islands(flagged, own, ["s", "e"], F.col("_new")).groupBy(*own, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    hit = F.coalesce(F.col("s") < before("meeting", "word"), F.lit(False))
    return joined.withColumn("hit", hit).groupBy("meeting", "word").agg(F.max("hit").alias("simultaneous"))


def assign_overlap(words: DataFrame, turns: DataFrame, width: int, margin: float = 0.15) -> DataFrame:
    """E2, J2 + J3 + W6: the speaker of most overlap; transition: more than one speaker; uncertain:
    none, simultaneous speech, or a lead under ``margin`` of the word. Words of no length go to the first turn that holds them."""
    order = Window.partitionBy("meeting", "word").orderBy(F.col("score").desc(), "first", "speaker")
    ranked = overlaps(words, turns, width).withColumn("second", F.coalesce(F.lead("score").over(order), F.lit(0))).withColumn("rank", F.row_number().over(order)).withColumn("speakers", F.count("*").over(Window.partitionBy("meeting", "word")))
    best = ranked.filter("rank = 1").select("meeting", "word", F.col("speaker").alias("most"), "speakers", ((F.col("score") - F.col("second")) / (F.col("we") - F.col("ws"))).alias("lead"))
    points = met(words.filter("we = ws"), turns, width).groupBy("meeting", "word").agg(F.min_by("speaker", "turn").alias("point"), F.count_distinct("speaker").alias("point_speakers"))
    out = words.join(best, ["meeting", "word"], "left").join(points, ["meeting", "word"], "left").join(simultaneous(words, turns, width), ["meeting", "word"], "left")
    both = F.coalesce("simultaneous", F.lit(False))
    changes = F.coalesce(F.col("speakers") > 1, F.col("point_speakers") > 1, F.lit(False))
    lead = F.coalesce(F.greatest("lead", F.lit(0.0)), F.lit(0.0))
    unsure = F.col("most").isNull() | both | (changes & (lead < margin))
    return out.select(*words.columns, F.coalesce("most", "point").alias("speaker"), unsure.alias("uncertain"), both.alias("simultaneous"), changes.alias("transition"), F.round(lead, 6).alias("lead"))


def outside(words: DataFrame, clips: DataFrame, width: int) -> DataFrame:
    """Words whose midpoint lies in no clip (meeting, cs, ce)."""
    mid2 = F.col("ws") + F.col("we")
    w = words.withColumn("bucket", F.floor(mid2 / 2 / width).cast("long"))
    c = clips.withColumn("bucket", F.explode(_buckets(F.col("cs"), F.col("ce"), width))).select(F.col("meeting").alias("m"), F.col("bucket").alias("b"), "cs", "ce")
    inside = (F.col("meeting") == F.col("m")) & (F.col("bucket") == F.col("b")) & (2 * F.col("cs") <= mid2) & (mid2 <= 2 * F.col("ce"))
    return w.join(c, inside, "left_anti").drop("bucket")


def islands(df: DataFrame, keys: list[str], order: list[str], new: Column, name: str = "island") -> DataFrame:
    """Number the runs within each key: a run begins where ``new`` holds."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.sum(F.when(new, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def merge_turns(segments: DataFrame, gap: float) -> DataFrame:
    """Neighbouring segments (meeting, seq, speaker, start, end, text) of one speaker with a gap
    of at most ``gap`` become a turn: first start, last end (not the latest), texts joined."""
    w = Window.partitionBy("meeting").orderBy("seq")
    same = F.lag("speaker").over(w).eqNullSafe(F.col("speaker")) & (F.row_number().over(w) > 1)
    new = ~(same & (F.col("start") - F.lag("end").over(w) <= gap))
    flagged = segments.withColumn("_new", F.coalesce(new, F.lit(True)))
    return islands(flagged, ["meeting"], ["seq"], F.col("_new"), "turn").groupBy("meeting", "turn").agg(
        F.min_by("speaker", "seq").alias("speaker"), F.min_by("start", "seq").alias("start"), F.max_by("end", "seq").alias("end"), F.count("*").alias("segments"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ").alias("text"),
    )


def restart_groups(items: DataFrame, gap: float) -> DataFrame:
    """Recordings (project, start, end) that begin 0 to ``gap`` after the one before ends are one."""
    w = Window.partitionBy("project").orderBy("start", "item")
    since = F.col("start") - F.lag("end").over(w)
    flagged = items.filter("start is not null and end is not null").withColumn("_new", ~F.coalesce((since >= 0) & (since <= gap), F.lit(False)))
    return islands(flagged, ["project"], ["start", "item"], F.col("_new"), "grp").drop("_new")


def interval_union(spans: DataFrame, pad: int = 0, gap: int = 0) -> DataFrame:
    """Padded spans (key, start, end) joined where one begins no later than ``gap`` after the latest end so far."""
    s = spans.select("key", F.greatest(F.col("start") - pad, F.lit(0)).alias("start"), (F.col("end") + pad).alias("end")).filter("end > start")
    w = Window.partitionBy("key").orderBy("start", "end")
    latest = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = s.withColumn("_new", F.coalesce(F.col("start") > latest + gap, F.lit(True)))
    return islands(flagged, ["key"], ["start", "end"], F.col("_new"), "clip").groupBy("key", "clip").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("spans"))


def speaker_labels(lines: DataFrame) -> DataFrame:
    """A to Z, then S27 ..., by first appearance (meeting, seq, speaker); null is ?."""
    first = lines.filter("speaker is not null").groupBy("meeting", "speaker").agg(F.min("seq").alias("seq"))
    rank = F.row_number().over(Window.partitionBy("meeting").orderBy("seq"))
    label = F.when(F.col("r") <= 26, F.char(F.col("r") + 64)).otherwise(F.concat(F.lit("S"), F.col("r").cast("string")))
    known = first.withColumn("r", rank).select("meeting", "speaker", label.alias("label"))
    return lines.join(known, ["meeting", "speaker"], "left").withColumn("label", F.coalesce("label", F.lit("?")))


def majority(assigned: DataFrame, keys: list[str]) -> DataFrame:
    """The speaker of most words, the first seen if equal."""
    n = assigned.filter("speaker is not null").groupBy(*keys, "speaker").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return n.groupBy(*keys).agg(F.max_by("speaker", F.struct("n", -F.col("first"))).alias("speaker"), F.max("n").alias("n"))


def assign_segments(segments: DataFrame, words: DataFrame, turns: DataFrame, width: int, split: bool = True) -> DataFrame:
    """Speakers of a recogniser's segments (meeting, segment, ss, se, text) by their words (meeting, segment, word: its number in the meeting, ws, we, text):
    meeting, segment, run, start, end, speaker, text. Words get speakers by J1; a segment falls into runs of one speaker (W4), whose text is that of their words,
    or the segment's if they have none; without ``split`` it stays whole, with the speaker of most words (A7). A segment without a word that has both times
    goes by J1 itself. Words of no segment that is there are left out; segments come with run 1 at least, once each."""
    timed = words.filter("ws is not null and we is not null").withColumnRenamed("text", "said")
    bare = segments.join(timed.select("meeting", "segment").distinct(), ["meeting", "segment"], "left_anti")
    alone = assign_midpoint(bare.select("meeting", F.col("segment").alias("word"), F.col("ss").alias("ws"), F.col("se").alias("we"), "text"), turns, width)
    alone = alone.select("meeting", F.col("word").alias("segment"), F.lit(1).cast("long").alias("run"), F.col("ws").alias("start"), F.col("we").alias("end"), "speaker", "text")
    told = assign_midpoint(timed, turns, width)
    if not split:
        most = majority(told.withColumn("seq", F.col("word")), ["meeting", "segment"]).drop("n")
        whole = segments.join(timed.select("meeting", "segment").distinct(), ["meeting", "segment"], "left_semi").join(most, ["meeting", "segment"], "left")
        return whole.select("meeting", "segment", F.lit(1).cast("long").alias("run"), F.col("ss").alias("start"), F.col("se").alias("end"), "speaker", "text").unionByName(alone)
    order = Window.partitionBy("meeting", "segment").orderBy("word")
    new = (F.row_number().over(order) == 1) | ~F.lag("speaker").over(order).eqNullSafe(F.col("speaker"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("said", F.lit("")).alias("said")))), lambda w: w["said"])
    runs = islands(told.withColumn("_new", new), ["meeting", "segment"], ["word"], F.col("_new"), "run").groupBy("meeting", "segment", "run").agg(
        F.min_by("ws", "word").alias("start"), F.max_by("we", "word").alias("end"), F.min_by("speaker", "word").alias("speaker"), ordered.alias("saids"),
    )
    text = joined_words(F.filter("saids", lambda w: w != ""))
    runs = runs.join(segments.select("meeting", "segment", F.col("text").alias("whole")), ["meeting", "segment"])
    return runs.select("meeting", "segment", "run", "start", "end", "speaker", F.when(text != "", text).otherwise(stripped(F.coalesce("whole", F.lit("")))).alias("text")).unionByName(alone)


def speaker_stats(turns: DataFrame, keys: list[str]) -> DataFrame:
    """A1: turns and time of each speaker."""
    return turns.groupBy(*keys, "speaker").agg(F.count("*").alias("turns"), F.sum(F.greatest(F.col("end") - F.col("start"), F.lit(0))).alias("time"))


def speech_window(silences: DataFrame, pad: float = 0.25, edge: float = 0.05) -> DataFrame:
    """The part of a recording (path, duration, silence_start, silence_end) between a silence at its
    begin and one at its end, padded; null start where nothing is trimmed, or nothing would be left."""
    first = F.min_by(F.struct("silence_start", "silence_end"), "silence_start")
    last = F.max_by(F.struct("silence_start", "silence_end"), "silence_start")
    ends = silences.groupBy("path", "duration").agg(first.alias("a"), last.alias("z"))
    start = F.when((F.col("a.silence_start") <= edge) & F.col("a.silence_end").isNotNull(), F.greatest(F.col("a.silence_end") - pad, F.lit(0.0))).otherwise(F.lit(0.0))
    at_end = (F.coalesce("z.silence_end", "duration") >= F.col("duration") - edge) & (F.col("z.silence_start") < F.col("duration"))
    stop = F.when(at_end, F.least(F.col("z.silence_start") + pad, F.col("duration"))).otherwise(F.col("duration"))
    moved = ends.withColumn("from", start).withColumn("to", stop)
    some = (F.col("to") > F.col("from")) & ((F.col("from") > 0) | (F.col("to") < F.col("duration")))
    return moved.select("path", F.when(some, F.col("from")).alias("start"), F.when(some, F.col("to")).alias("end"))
