"""Jobs and restarts as keyed state: restarts in mid-stage, timers, repeated events; counters of batches and streams."""

from __future__ import annotations

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parley.operators import counters
from parley.streaming import stateful

KINDS = ("recorded", "noted", "reviewed", "failed")
SCHEMA = "key string, seq long, kind string, ts timestamp"


def brute(events):
    stage = {}
    for k, _, kind, _ in sorted(set(events), key=lambda e: (e[0], e[1])):
        stage[k] = stateful.after(stage.get(k), kind, False)
    return {k: v for k, v in stage.items() if v}


class Feed:
    """A folder whose files are batches, and a query over them that keeps what it gives by the number of the batch."""

    def __init__(self, spark, tmp_path):
        self.spark, self.at, self.n = spark, tmp_path, 0
        (tmp_path / "in").mkdir()

    def add(self, rows):
        self.n += 1
        pd.DataFrame(rows, columns=["key", "seq", "kind", "ts"]).to_json(self.at / "in" / f"{self.n:03}.json", orient="records", lines=True)

    def start(self, fails_at=None, **settings):
        def keep(batch, number):
            if number == fails_at:
                raise RuntimeError("lost")
            batch.write.mode("overwrite").parquet(f"file://{self.at}/out/batch={number}")

        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"file://{self.at}/in")
        with stateful.keyed_state(self.spark):
            q = stateful.job_stages(stream, **settings).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"file://{self.at}/state").trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost" in str(e)

    def told(self):
        rows = self.spark.read.parquet(f"file://{self.at}/out").collect()
        last = {}
        for r in sorted(rows, key=lambda r: r.batch):
            last[r.key] = r.stage
        return last


def test_jobs_go_on_after_a_failure_in_mid_stage(spark, tmp_path):
    rng, feed, events = random.Random(3), Feed(spark, tmp_path), []
    before = spark.conf.get(stateful.PROVIDER, None)
    for b in range(4):
        batch = [(f"k{rng.randrange(6)}", 100 * b + i, rng.choice(KINDS), "2024-01-01T00:00:00Z") for i in range(25)]
        batch += rng.sample(events, min(5, len(events)))  # told again
        events += batch
        feed.add(batch)
    feed.start(fails_at=2)
    assert feed.told() != brute(events)
    feed.start()
    assert feed.told() == brute(events)
    assert spark.conf.get(stateful.PROVIDER, None) == before


def test_timers_of_age_and_expiry(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    at = lambda s: (pd.Timestamp("2024-01-01", tz="UTC") + pd.Timedelta(seconds=s)).isoformat()
    feed.add([("a", 1, "recorded", at(0)), ("b", 1, "recorded", at(50))])
    feed.start(least_age=60, expiry=600)
    assert feed.told() == {"a": "waiting", "b": "waiting"}
    feed.add([("a", 2, "failed", at(40))])  # doesn't put off the age of its recording
    feed.start(least_age=60, expiry=600)
    feed.add([("c", 1, "recorded", at(100)), ("b", 2, "noted", at(100))])  # b's note comes too early and changes nothing
    feed.add([("c", 2, "failed", at(101))])
    feed.start(least_age=60, expiry=600)
    assert feed.told()["a"] == "note" and feed.told()["b"] in ("waiting", "note")
    feed.add([("a", 3, "noted", at(170)), ("d", 1, "recorded", at(400))])
    feed.add([("d", 2, "failed", at(401))])
    feed.start(least_age=60, expiry=600)
    assert (feed.told()["a"], feed.told()["b"], feed.told()["c"]) == ("review", "note", "note")
    feed.add([("e", 1, "recorded", at(5000))])
    feed.add([("e", 2, "failed", at(5001))])
    feed.start(least_age=60, expiry=600)
    assert [feed.told()[k] for k in "abc"] == ["expired"] * 3


@pytest.mark.parametrize("waits", [False, True])
def test_stages(waits):
    first = "waiting" if waits else "note"
    assert [stateful.after(s, "recorded", waits) for s in (None, "done", "expired", "review")] == [first, first, first, "review"]
    assert stateful.after("note", "noted", waits) == "review" and stateful.after("review", "reviewed", waits) == "done" and stateful.after("note", "reviewed", waits) == "note" and stateful.after(None, "noted", waits) is None
    assert all(stateful.after(s, "failed", waits) == s for s in (None, "note", "review", "done"))


def test_counters_of_a_batch(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"))
    rows, seen = counters.observed(df, counters.counters("s", ("a", "b", "c")))
    rows.write.parquet(f"file://{tmp_path}/t")
    assert seen.get == {"rows": 1000, "a": 334, "b": 666, "c": 0} and spark.read.parquet(f"file://{tmp_path}/t").count() == 1000
    assert rows._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_counters_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        pd.DataFrame({"s": ["a"] * (i + 1) + ["b"]}).to_json(tmp_path / "in" / f"{i}.json", orient="records", lines=True)
    told = counters.StreamCounters("run")
    spark.streams.addListener(told)
    try:
        stream = spark.readStream.schema("s string").option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in").observe("run", *(c.alias(k) for k, c in counters.counters("s", ("a", "b")).items()))
        q = stream.writeStream.format("noop").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        end = time.time() + 20
        while told.total().get("rows") != 9 and time.time() < end:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(told)
    assert told.total() == {"rows": 9, "a": 6, "b": 3}
