"""Recordings before transcription: what is new, what is cut off, refused, and heard as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import restart_groups, speech_window


def silence_totals(silences: DataFrame) -> DataFrame:
    """The seconds of silence of each recording (path, duration, silence_start, silence_end); a silence without an end lasts to the recording's."""
    length = F.coalesce("silence_end", "duration") - F.col("silence_start")
    return silences.groupBy("path").agg(F.sum(F.greatest(length, F.lit(0.0))).alias("silent"))


def prepared(items: DataFrame, done: DataFrame, silences: DataFrame, min_trim: float = 1.0, min_duration: float = 30.0, most_silent: float = 0.95, gap: float = 120.0, pad: float = 0.25) -> DataFrame:
    """The queue (project, path, start in seconds, duration) without what is done (P5, project and path), cut to its speech where that saves
    ``min_trim`` or more (P4), refused if its length isn't known, is under ``min_duration``, or mostly silence (P3, A8), and the
    rest numbered in groups of recordings that begin shortly after the one before ends (W2). ``silences``: path, silence_start, silence_end."""
    new = items.join(done.select("project", "path").distinct(), ["project", "path"], "left_anti")
    heard = silences.join(new.select("path", "duration").distinct(), "path")
    window = speech_window(heard.filter("duration is not null"), pad).filter("start is not null").select("path", F.col("start").alias("from"), F.col("end").alias("to"))
    x = new.join(window, "path", "left")
    trims = F.coalesce(F.col("from") + (F.col("duration") - F.col("to")) >= min_trim, F.lit(False))
    x = x.withColumn("trimmed", trims).withColumn("from", F.when(trims, F.col("from")).otherwise(F.lit(0.0))).withColumn("to", F.when(trims, F.col("to")).otherwise(F.col("duration")))
    x = x.withColumn("start", F.col("start") + F.col("from")).withColumn("duration", F.col("to") - F.col("from"))
    inside = silences.join(x.select("path", "from", "to").distinct(), "path").select("path", F.col("to").alias("duration"), F.greatest("silence_start", "from").alias("silence_start"), F.least(F.coalesce("silence_end", "to"), "to").alias("silence_end"))
    x = x.join(silence_totals(inside), "path", "left")
    part = F.coalesce("silent", F.lit(0.0)) / F.nullif(F.col("duration"), F.lit(0.0))
    reason = F.when(F.col("duration").isNull(), "no duration").when(F.col("duration") < min_duration, "too short").when(part >= most_silent, "silent")
    x = x.withColumn("reason", reason).select("project", "path", "start", "duration", "trimmed", "reason")
    kept = x.filter("reason is null").withColumn("end", F.col("start") + F.col("duration")).withColumn("item", F.col("path"))
    grouped = restart_groups(kept, gap).select("project", "path", "grp")
    return x.join(grouped, ["project", "path"], "left")
