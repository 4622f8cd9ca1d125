"""Durable jobs and restarted recordings as keyed state of a stream: values, timers, and recovery from the checkpoint.

Both are stateful processors. A key's state is a few numbers, so it never grows with the stream; a batch that fails is run again from the state of the
batch before it, and a restart goes on where the checkpoint is, in the middle of a job's stages as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..shipping import ship

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JOBS = "key string, seq long, stage string"
GROUPS = "key string, begin long, last_end long, n long"
#: Kinds of events of a job: what each makes of a stage is in ``after``.
RECORDED, NOTED, REVIEWED, FAILED = "recorded", "noted", "reviewed", "failed"
WAITING, NOTE, REVIEW, DONE, EXPIRED = "waiting", "note", "review", "done", "expired"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which processors with timers need; the session's setting is as before afterwards, and
    a started query keeps its own."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before is not None else spark.conf.unset(PROVIDER)


def after(stage: str | None, kind: str, waits: bool) -> str | None:
    """The stage of a job after an event. A recording starts a job, which waits until the file is old enough if there is a least age; a note
    moves it to review, and a review ends it. A failure leaves it where it is, to be tried again; so does an event that doesn't fit the stage."""
    if kind == RECORDED:
        return (WAITING if waits else NOTE) if stage in (None, DONE, EXPIRED) else stage
    if kind == NOTED and stage == NOTE:
        return REVIEW
    if kind == REVIEWED and stage == REVIEW:
        return DONE
    return stage


def _frame(rows: list[tuple], columns: tuple[str, ...]) -> pd.DataFrame:
    """Rows with columns of plain objects: what goes back as structs may not be in chunks."""
    return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=object) for i, c in enumerate(columns)})


class Jobs(StatefulProcessor):
    """One job of each key. State: stage, the last event's number and time (milliseconds), and when the stage began. Timers: when a waiting recording is old enough, and
    when a job without events is given up. A job that ended keeps nothing but the number of its last event, so a repeated event is known."""

    def __init__(self, least_age: int, expiry: int) -> None:
        self.least_age, self.expiry = least_age, expiry

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "stage string, seq long, at long, since long")

    def _timers(self, stage: str | None, at: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        if stage == WAITING:
            self.handle.registerTimer(at + self.least_age)
        elif stage in (NOTE, REVIEW) and self.expiry:
            self.handle.registerTimer(at + self.expiry)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stage, seen, at, since = self.state.get() if self.state.exists() else (None, -1, 0, 0)
        was = stage
        events = pd.concat(list(rows)).sort_values("seq")
        for seq, kind, ms in zip(events["seq"], events["kind"], events["ms"]):
            if seq <= seen:  # a repeated event, or one that came after a later one: order of a job's events is that of their numbers
                continue
            new = after(stage, kind, self.least_age > 0)
            since = int(ms) if new != stage else since
            stage, seen, at = new, int(seq), max(at, int(ms))
        self.state.update((stage, seen, at, since))
        if self.least_age or self.expiry:
            self._timers(stage, since if stage == WAITING else at)
        if stage != was:
            yield _frame([(key[0], seen, stage)], ("key", "seq", "stage"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stage, seen, at, since = self.state.get() if self.state.exists() else (None, -1, 0, 0)
        new = NOTE if stage == WAITING else EXPIRED if stage in (NOTE, REVIEW) else stage
        self.state.update((new, seen, at, since))
        if new == NOTE and self.expiry:
            self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.expiry)
        if new != stage:
            yield _frame([(key[0], seen, new)], ("key", "seq", "stage"))

    def close(self) -> None:
        pass


def job_stages(events: DataFrame, least_age: int = 0, expiry: int = 0, delay: str = "0 seconds") -> DataFrame:
    """§2.12: changes of stage (key, seq of the last event, stage) of jobs, from a stream of events (key, seq, kind, ts). With ``least_age`` seconds a recording waits until the
    stream's time has passed its own by so much; with ``expiry`` seconds a job without events for so long is given up. Start queries within ``keyed_state``."""
    ship(events.sparkSession)
    timed = events.select(F.col("key").cast("string").alias("key"), "seq", "kind", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay).withColumn("ms", F.unix_millis("ts"))
    mode = "eventTime" if least_age or expiry else "none"
    return timed.groupBy("key").transformWithStateInPandas(Jobs(least_age * 1000, expiry * 1000), JOBS, "update", mode)


class Restarts(StatefulProcessor):
    """W2 and E16's state: the open group of a key: begin, last end, how many items."""

    def __init__(self, gap: int) -> None:
        self.gap = gap

    def init(self, handle) -> None:
        self.state = handle.getValueState("group", "begin long, last_end long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        begin, last, n = self.state.get() if self.state.exists() else (0, 0, 0)
        out = []
        items = pd.concat(list(rows)).sort_values(["start", "end"])
        for s, e in zip(items["start"], items["end"]):
            if n and 0 <= s - last <= self.gap:
                last, n = int(e), n + 1
            else:
                if n:
                    out.append((key[0], begin, last, n))
                begin, last, n = int(s), int(e), 1
        self.state.update((begin, last, n))
        if out:
            yield _frame(out, ("key", "begin", "last_end", "n"))

    def close(self) -> None:
        pass


def restart_groups(items: DataFrame, gap: int) -> DataFrame:
    """W2 over a stream of (key, start, end): groups that are closed, each when the key's next one begins. Start queries within ``keyed_state``."""
    ship(items.sparkSession)
    return items.select(F.col("key").cast("string").alias("key"), "start", "end").groupBy("key").transformWithStateInPandas(Restarts(gap), GROUPS, "append", "none")
