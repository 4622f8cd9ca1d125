"""Counters of a run, taken while its rows pass: no second read of anything."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counters(status: str, values: tuple[str, ...]) -> dict[str, Column]:
    """How many rows there are, and how many of each value of a column."""
    return {"rows": F.count(F.lit(1)), **{v: F.count_if(F.col(status) == v) for v in values}}


def observed(df: DataFrame, counted: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with its counters: ``.get`` of the observation has them once an action on the first has ended."""
    seen = Observation()
    return df.observe(seen, *(c.alias(k) for k, c in counted.items())), seen


class StreamCounters(StreamingQueryListener):
    """Counters of a stream (``df.observe(name, ...)``), summed over its batches. Events come in a thread of their own; a batch that is told
    twice counts once. To be added by spark.streams.addListener."""

    def __init__(self, name: str) -> None:
        self.name, self.batches, self.lock, self.ended = name, {}, threading.Lock(), threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self.lock:
                self.batches[str(event.progress.id), event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def total(self) -> dict[str, int]:
        with self.lock:
            out: dict[str, int] = {}
            for row in self.batches.values():
                for k, v in row.items():
                    out[k] = out.get(k, 0) + (v or 0)
            return out
