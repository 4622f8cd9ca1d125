"""Streaming: a watched folder of transcripts, seen state, sessions, and roster state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.identity import ledger_counts


def watched(spark: SparkSession, folder: str, schema: str, files: int = 100) -> DataFrame:
    """New files of a folder as rows; the file source's log is the seen state, so each file comes once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)


def settled(batch: DataFrame, seconds: int = 60) -> DataFrame:
    """Rows of files that haven't changed for a while; to be applied in a batch function."""
    return batch.filter(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_metadata.file_modification_time") >= seconds)


def deduplicated(events: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Seen-state over a stream: the first of each key within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def sessions(events: DataFrame, key: str, time: str, gap: str, delay: str) -> DataFrame:
    """Counts of sessions whose events start within ``gap`` of each other, late events up to ``delay``."""
    at = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    w = F.session_window(F.col(time), gap)
    return at.groupBy(key, w.alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


_STATE = "last_end long, begin long, n long"
_OUT = "key string, begin long, last_end long, n long"


def merged_items(items: DataFrame, gap: int) -> DataFrame:
    """W2 over a stream of (key, start, end): items that begin 0 to ``gap`` after the one before ends are
    one; a group is given when the next one begins."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, begin, n = state.get if state.exists else (0, 0, 0)
        out = []
        rows = pd.concat(list(frames)).sort_values(["start", "end"])
        for s, e in zip(rows["start"], rows["end"]):
            if n and 0 <= s - last <= gap:
                last, n = int(e), n + 1
            else:
                if n:
                    out.append((key[0], begin, last, n))
                last, begin, n = int(e), int(s), 1
        state.update((last, begin, n))
        yield pd.DataFrame(out, columns=["key", "begin", "last_end", "n"])

    return items.groupBy("key").applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def classified(stream: DataFrame, rules: DataFrame, name: str, default: str | None = None) -> DataFrame:
    """A stream of items against a table of rules (idx, prefix, project) that is read anew with each batch: the first rule whose prefix the
    item's name has. Items are met by the length of the prefix, so the join is one of equality."""
    sizes = [r["n"] for r in rules.select(F.length("prefix").alias("n")).distinct().collect()]  # a few numbers
    cut = F.transform(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>"), lambda n: F.lower(F.substring(F.col(name), F.lit(1), n)))
    held = rules.groupBy(F.lower("prefix").alias("p")).agg(F.min(F.struct("idx", "project")).alias("rule"))
    table = held.agg(F.map_from_entries(F.collect_list(F.struct("p", "rule"))).alias("rules"))  # as many as there are rules
    hits = F.filter(F.transform(cut, lambda p: F.try_element_at(F.col("rules"), p)), lambda r: r.isNotNull())
    return stream.join(F.broadcast(table)).withColumn("project", F.coalesce(F.array_min(hits)["project"], F.lit(default), F.lit("unsorted"))).drop("rules")


def _started(stream: DataFrame, write, checkpoint: str, every: str | None) -> StreamingQuery:
    """The stream with ``write`` for each batch: what is there, then the end; or with ``every`` (an interval) on and on."""
    to = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (to.trigger(processingTime=every) if every else to.trigger(availableNow=True)).start()


def fed_back(notes: DataFrame, path: str, checkpoint: str, least: int = 1, every: str | None = None) -> StreamingQuery:
    """The feedback loop: each batch of confirmed corrections (note, target, variant) joins those kept before; its notes work with the ledger of the notes
    strictly before the first of them, written as ledger/batch=n (target, variant, count), so none learns from itself or from a later one."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.select("note", "target", "variant").distinct().write.mode("overwrite").parquet(f"{path}/confirmed/batch={number}")
        first = batch.agg(F.min("note")).first()[0]
        every = spark.read.schema(batch.select("note", "target", "variant").schema).parquet(f"{path}/confirmed")
        counts = ledger_counts(every, F.lit(first)).filter(F.col("count") >= least)
        counts.write.mode("overwrite").parquet(f"{path}/ledger/batch={number}")

    return _started(notes, write, checkpoint, every)


def advanced(jobs: DataFrame, events: DataFrame) -> DataFrame:
    """The stage machine of durable jobs (key, stage) after a batch of events (key, seq, kind): recorded starts a note job, noted moves it to review,
    reviewed ends it, failed leaves it where it is; events of a key apply in order. Jobs that ended are left out."""
    step = lambda stage, e: F.when(e["kind"] == "recorded", F.coalesce(stage, F.lit("note"))).when((e["kind"] == "noted") & (stage == "note"), "review").when((e["kind"] == "reviewed") & (stage == "review"), F.lit(None)).otherwise(stage)
    told = events.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "kind"))).alias("events"))
    x = jobs.join(told, "key", "full_outer")
    after = F.aggregate(F.coalesce("events", F.array().cast("array<struct<seq: long, kind: string>>")), F.col("stage"), step)
    return x.select("key", after.alias("stage")).filter("stage is not null")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions current=n of a table, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(p.getName()[8:]) for p in found if p.getName().startswith("current=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def merged_version(batch: DataFrame, number: int, path: str, key: str) -> bool:
    """K9 and K3: merge a batch into the keyed table of versions at ``path`` by writing a new one beside the old; says whether it did: a batch whose rows
    are all there already writes nothing, but for the first. Of a key's rows in a batch the greatest counts. The one version before stays,
    older ones go. A table that had versions and has none is an error, not a beginning."""
    spark = batch.sparkSession
    there = versions(spark, path)
    before = [n for n in there if n < number]
    if number and not before:
        raise RuntimeError(f"{path} has no version before {number}: its history is gone")
    rest = [c for c in batch.columns if c != key]
    latest = batch.groupBy(key).agg(F.max(F.struct(*rest)).alias("_x")).select(key, "_x.*") if rest else batch.distinct()
    if before:
        old = spark.read.parquet(f"{path}/current={before[-1]}")
        same = F.lit(True)
        held = old.select(*(F.col(c).alias(f"_{c}") for c in old.columns))
        for c in latest.columns:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        if not latest.join(held, same, "left_anti").limit(1).count():
            return False
        latest = latest.unionByName(old.join(latest, key, "left_anti"))
    latest.write.mode("overwrite").parquet(f"{path}/current={number}")
    for n in before[:-1]:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/current={n}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return True


def upserted(stream: DataFrame, path: str, key: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """K9: each batch of a stream merged into a keyed table of versions."""

    def write(batch: DataFrame, number: int) -> None:
        merged_version(batch, number, path, key)

    return _started(stream, write, checkpoint, every)
