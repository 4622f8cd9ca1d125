"""Operator 12, resampling of irregular series: clicks of clients to clock-hour buckets, by a Python UDTF (fed with Arrow batches) over client-time blocks.

A signal holds a value of hundredths from each point on. Of a client's rows in one second one is a point (the largest
id). They are found by an aggregation whose partial results are made before the shuffle, so a hot second costs
a row a task. Then points are dealt by client and block of ``BLOCK`` seconds, the ones of a block's first
``HOLD`` seconds also to the block before, as its halo. The table function gets a group of clients
in a block, ordered by client and time, and holds one pending point and one open bucket: a point ends the segment of the
pending one; a halo row, the client's end or ``terminate`` end the last segment. A segment belongs to the block in which it begins, and
buckets that it shares with other blocks are partial: they are added up by client and bucket.

A client has at most ``BLOCK`` points and ``HOLD`` rows of halo in a block, whatever its share of all rows, and so is as many
groups as it has blocks; rows stream through the function, which keeps two of them. Clients share a group (by hash, ``GROUPS``
in a block or a sixteenth of the shuffle's partitions) as most have few rows in a block, and a group costs as much as some hundred rows.

Integrals are exact: Python integers in the function, decimals of 38 digits in the sums.

Defined results: rows with null client, time or value are dropped, and those whose hundredths are not a long (NaN, infinite). Equal ids in
one second: the larger value. Repeated rows: one point. A client of one point: its bucket with no covered time (linear), or
``HOLD`` seconds (step). An area that is no long: null, its average is exact all the same. Empty table: no rows. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Seconds that a value lasts at most, of a bucket, and of a block; groups of clients in a block, at least.
HOLD, WIDTH, BLOCK, GROUPS = 3600, 3600, 6 * 3600, 8
ZONE = "Asia/Kolkata"
_PARTIAL = "series long, bucket_start long, n_points long, covered_seconds long, area2 decimal(38,0)"
_FIELDS = pa.schema([("series", pa.int64()), ("bucket_start", pa.int64()), ("n_points", pa.int64()), ("covered_seconds", pa.int64()), ("area2", pa.decimal128(38, 0))])
#: Finished buckets that are handed on together.
SOME = 500


def phase(zone: str, width: int) -> int:
    """What is added to epoch seconds so that a bucket of the zone's clock begins at a multiple of ``width``. A zone whose
    clock has moved by parts of a bucket since 1970 is refused."""
    at, seen = datetime(1970, 1, 1, tzinfo=timezone.utc), set()
    while at.year < 2040:
        seen.add(int(at.astimezone(ZoneInfo(zone)).utcoffset().total_seconds()) % width)
        at += timedelta(days=45)
    if len(seen) > 1:
        raise ValueError(f"the clock of {zone} moves by parts of {width} seconds")
    return seen.pop()


def integral2(v: int, w: int, d: int, u: int) -> int:
    """Twice the integral of the first ``u`` of ``d`` seconds on the way from ``v`` to ``w``, floored."""
    return 2 * v * u + (w - v) * u * u // d


class Buckets:
    """The table function of one group of clients in one block: batches of rows (clients, block, series, at, cents) in the
    order of series and time. Between two rows it holds a pending point and an open bucket, and no more between two batches."""

    def __init__(self, linear: bool, hold: int, width: int, block: int, first: int) -> None:
        self.linear, self.hold, self.width, self.block, self.first = linear, hold, width, block, first
        self.series = self.at = self.open = None
        self.v = self.n = self.covered = self.area = 0
        self.done: list[tuple] = []

    def goes_to(self, bucket: int | None) -> None:
        """Open ``bucket``; the one before is a result."""
        if self.open is not None:
            self.done.append((self.series, self.open, self.n, self.covered, self.area))
        self.open, self.n, self.covered, self.area = bucket, 0, 0, 0

    def segment(self, until: int | None, w: int | None) -> None:
        """What the pending point adds up to the series' next point, if there is one."""
        at, v = self.at, self.v
        if until is None or until - at > self.hold:
            if self.linear:
                return
            until = at + self.hold
        if not self.linear:
            w = v
        d, u, before = until - at, 0, 0
        while u < d:
            bucket = at + u - (at + u + self.first) % self.width
            if bucket != self.open:
                self.goes_to(bucket)
            end = min(d, bucket + self.width - at)
            area = integral2(v, w, d, end)
            self.covered += end - u
            self.area += area - before
            u, before = end, area

    def flush(self) -> None:
        if self.at is not None:
            self.segment(None, None)
        self.at = None
        self.goes_to(None)

    def point(self, block: int, series: int, at: int, cents: int) -> None:
        if series != self.series:
            self.flush()
            self.series = series
        elif self.at is not None:
            self.segment(at, cents)
        elif self.open is None:  # more halo than its first row
            return
        if at // self.block != block:  # halo: a point of the next block, which counts it
            self.at = None
            self.goes_to(None)
            return
        bucket = at - (at + self.first) % self.width
        if bucket != self.open:
            self.goes_to(bucket)
        self.n += 1
        self.at, self.v = at, cents

    def results(self) -> pa.Table:
        columns = list(zip(*self.done)) or [()] * len(_FIELDS)
        self.done = []
        return pa.table([pa.array(map(Decimal, c) if pa.types.is_decimal(f.type) else c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        for row in zip(*(batch.column(c).to_pylist() for c in ("block", "series", "at", "cents"))):
            self.point(*row)
        if len(self.done) >= SOME:
            yield self.results()

    def terminate(self) -> Iterator[pa.Table]:
        self.flush()
        yield self.results()


def function(linear: bool, hold: int, width: int, block: int, first: int):
    """The table function as Spark calls it: only rows are its arguments, so its settings are those of its class."""

    class Resampled(Buckets):
        def __init__(self) -> None:
            super().__init__(linear, hold, width, block, first)

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:  # Spark looks for these in the class itself
            return super().eval(batch)

        def terminate(self) -> Iterator[pa.Table]:
            return super().terminate()

    return F.arrow_udtf(Resampled, returnType=_PARTIAL)


def seconds(df: DataFrame, name: str) -> Column:
    """Epoch seconds, floored; a time without zone is UTC, whatever the session's zone."""
    c = F.col(name)
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_seconds(c.cast("timestamp"))
    return F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def points(df: DataFrame, series: str, ts: str, value: str, order: str) -> DataFrame:
    """series, at (epoch seconds), cents: one point a second."""
    exact = F.floor(100 * F.col(value).cast("double") + 0.5)
    fits = (F.abs(F.col(value).cast("double")) < 9.2e16) & ~F.isnan(value)
    rows = df.filter(F.col(series).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull() & fits)
    rows = rows.select(F.col(series).cast("long").alias("series"), seconds(rows, ts).alias("at"), F.struct(F.col(order).cast("long").alias("id"), exact.cast("long").alias("cents")).alias("last"))
    return rows.groupBy("series", "at").agg(F.max("last").alias("last")).select("series", "at", F.col("last.cents").alias("cents"))


def resample(df: DataFrame, kind: str = "linear", zone: str = ZONE, width: int = WIDTH, hold: int = HOLD, block: int = BLOCK, groups: int | None = None, series: str = "client_id", ts: str = "ts", value: str = "value", order: str = "click_id") -> DataFrame:
    """Per client and clock bucket with points or covered time: client_id, bucket_start, n_points, covered_seconds, area2, avg_cents."""
    if kind not in ("linear", "step"):
        raise ValueError(kind)
    spark = df.sparkSession
    ship(spark)
    groups = groups or max(GROUPS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    block = max(block, hold)  # what a block's last segment needs is in the next one
    own = F.expr(f"(at - pmod(at, {block})) div {block}")
    dealt = points(df, series, ts, value, order).withColumn("own", own)
    both = F.when(F.col("at") - F.col("own") * block < hold, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))
    dealt = dealt.select(F.pmod(F.xxhash64("series"), F.lit(groups)).alias("clients"), F.explode(both).alias("block"), "series", "at", "cents")
    partial = function(kind == "linear", hold, width, block, phase(zone, width))(dealt.asTable().partitionBy("clients", "block").orderBy("series", "at"))
    whole = partial.groupBy("series", "bucket_start").agg(F.sum("n_points").alias("n_points"), F.sum("covered_seconds").alias("covered_seconds"), F.sum("area2").alias("area2"))
    twice = "cast(2 * covered_seconds as decimal(38,0))"
    return whole.select(
        F.col("series").alias("client_id"), "bucket_start", "n_points", "covered_seconds", F.expr("try_cast(area2 as bigint)").alias("area2"),
        F.expr(f"case when covered_seconds > 0 then (area2 - pmod(area2, {twice})) div {twice} end").alias("avg_cents"),
    )
