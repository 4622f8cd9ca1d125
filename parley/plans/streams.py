"""Queries that run a bounded stream to its end and give its table, and sinks' renderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from ..streaming import stateful, watch
from .base import SQL, query, table
from .files import scratch_folder


def _run(stream: DataFrame, mode: str) -> DataFrame:
    """The rows that a stream gives from the files there are: a table in the shared folder, which the executors write; nothing meets on the driver. State is in
    RocksDB, as processors with timers need it, so it isn't held in the executors' heaps."""
    spark = stream.sparkSession
    path = scratch_folder(spark, "stream")
    out = stream.writeStream.option("checkpointLocation", scratch_folder(spark, "stream-state")).outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        with stateful.keyed_state(spark):
            query_ = out.format("parquet").start(f"{path}/rows")
        query_.awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/rows")
    done = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number}")
        done.append(number)

    with stateful.keyed_state(spark):
        query_ = out.foreachBatch(write).start()
    query_.awaitTermination()
    whole = done[-1:] if mode == "complete" else done  # a complete table comes anew with each batch
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(f"{path}/{n}" for n in whole))


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", True).parquet(d)


@query("""with g as (select user_id, ts, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts) < 10800000000 then 0 else 1 end n from events), h as (select *, sum(n) over (partition by user_id order by ts rows unbounded preceding) s from g)
  select user_id, count(*)::bigint n, epoch_us(min(ts)) "start" from h group by user_id, s""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Session windows of three hours over a stream of events, all given at the end."""
    return _run(watch.sessions(_events(spark, d), "user_id", "ts", "3 hours", "1 day"), "complete").select("user_id", "n", F.unix_micros("start").alias("start"))


@query("select event_type, count(distinct user_id)::bigint users from events group by 1")
def stream_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    """Seen state: the first event of each user and kind within a watermark longer than the data."""
    e = _events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    return _run(watch.deduplicated(e, ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type"), "append").groupBy("event_type").agg(F.count("*").alias("users"))


@query("""with s as (select user_id::varchar "key", epoch_us(ts) a, epoch_us(ts) + greatest(floor(value), 0)::bigint * 60000000 b from events), f as (select *, case when a - lag(b) over w >= 0 and a - lag(b) over w <= 10800000000 then 0 else 1 end n from s window w as (partition by "key" order by a, b)),
  g as (select *, sum(n) over (partition by "key" order by a, b rows unbounded preceding) grp from f), h as (select "key", grp, min(a) "begin", arg_max(b, (a, b)) last_end, count(*)::bigint n from g group by 1, 2) select "key", "begin", last_end, n from h qualify grp < max(grp) over (partition by "key")""")
def stream_restart_groups(spark: SparkSession, d: str) -> DataFrame:
    """W2 with keyed state; each user's last group is still open."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.greatest(F.floor("value"), F.lit(0)).cast("long") * 60_000_000
    items = _events(spark, d).select(F.col("user_id").cast("string").alias("key"), start.alias("start"), (start + length).alias("end"))
    return _run(watch.merged_items(items, 10_800_000_000), "append")


@query("""select event_id, coalesce((select project from (values (0, 'pur', 'sales'), (1, 'P', 'other'), (2, 'click', 'web'), (3, 'cl', 'never')) r(idx, prefix, project) where lower(event_type) like lower(prefix) || '%' order by idx limit 1), 'unsorted') project from events""")
def stream_classified(spark: SparkSession, d: str) -> DataFrame:
    """A stream against rules that lie in a table."""
    rules = spark.createDataFrame([(0, "pur", "sales"), (1, "P", "other"), (2, "click", "web"), (3, "cl", "never")], "idx int, prefix string, project string")
    return _run(watch.classified(_events(spark, d), rules, "event_type").select("event_id", "project"), "append")


@query("""with recursive e as (select user_id "key", row_number() over (partition by user_id order by event_id) n, case event_id % 4 when 0 then 'recorded' when 1 then 'noted' when 2 then 'reviewed' else 'failed' end kind from events), j as (select "key", 0::bigint n, case when "key" % 3 = 0 then 'note' when "key" % 3 = 1 then 'review' end stage from (select distinct "key" from e)
    union all select j."key", e.n, case when kind = 'recorded' then coalesce(stage, 'note') when kind = 'noted' and stage = 'note' then 'review' when kind = 'reviewed' and stage = 'review' then null else stage end from j join e on e."key" = j."key" and e.n = j.n + 1)
  select "key", stage from j qualify n = max(n) over (partition by "key") and stage is not null""")
def job_stages(spark: SparkSession, d: str) -> DataFrame:
    """The stage machine of durable jobs: each user's events in order, from the stage that its job has."""
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.element_at(F.array(*map(F.lit, ("recorded", "noted", "reviewed", "failed"))), (F.col("event_id") % 4 + 1).cast("int")).alias("kind"))
    jobs = e.select("key").distinct().withColumn("stage", F.when(F.col("key") % 3 == 0, "note").when(F.col("key") % 3 == 1, "review")).filter("stage is not null")
    return watch.advanced(jobs, e)


@query("""with recursive e as (select user_id "key", row_number() over (partition by user_id order by event_id) n, event_id, case event_id % 4 when 0 then 'recorded' when 1 then 'noted' when 2 then 'reviewed' else 'failed' end kind from events), j as (select distinct "key", 0::bigint n, null::varchar stage from e
    union all select j."key", e.n, case when kind = 'recorded' and (stage is null or stage = 'done') then 'note' when kind = 'noted' and stage = 'note' then 'review' when kind = 'reviewed' and stage = 'review' then 'done' else stage end from j join e on e."key" = j."key" and e.n = j.n + 1)
  select "key"::varchar "key", stage from j qualify n = max(n) over (partition by "key") and stage is not null""")
def stream_jobs(spark: SparkSession, d: str) -> DataFrame:
    """The stages of durable jobs as keyed state of a stream of events: each user's last."""
    kind = F.element_at(F.array(*map(F.lit, ("recorded", "noted", "reviewed", "failed"))), (F.col("event_id") % 4 + 1).cast("int"))
    e = _events(spark, d).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), kind.alias("kind"), "ts")
    return _run(stateful.job_stages(e), "update").groupBy("key").agg(F.max_by("stage", "seq").alias("stage"))


@query(SQL["stream_restart_groups"])
def stream_restart_state(spark: SparkSession, d: str) -> DataFrame:
    """W2 by a stateful processor; each user's last group is still open."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.greatest(F.floor("value"), F.lit(0)).cast("long") * 60_000_000
    items = _events(spark, d).select(F.col("user_id").cast("string").alias("key"), start.alias("start"), (start + length).alias("end"))
    return _run(stateful.restart_groups(items, 10_800_000_000), "append")


@query("select '| ' || r_regionkey || ' | ' || r_name || ' |' line from region")
def markdown_rows(spark: SparkSession, d: str) -> DataFrame:
    """K6."""
    return table(spark, d, "region").select(sinks.markdown_table(["r_regionkey", "r_name"]).alias("line"))


@query("""with n as (select n_regionkey r, n_name, row_number() over (partition by n_regionkey order by n_name) - 1 i from nation), l as (select * from (values (0, 'rollout-map', 4, 232, 120, 200, 96, true), (1, 'system-map', 3, 304, 96, 280, 72, false), (2, 'milestone-timeline', 1, 0, 84, 800, 68, true), (3, 'decision-map', 2, 456, 132, 424, 108, false)) t(k, kind, c, a, d, w, h, j)),
  p as (select r, kind, i, n_name, c, a, d, w, h, j, 32 + i % c * a x, 88 + i // c * d y, 32 + (i + 1) % c * a x2, 88 + (i + 1) // c * d y2, count(*) over (partition by r) m, (88 + ceil(count(*) over (partition by r) / c::double)::int * d + 16)::varchar total from n join l on k = r % 4),
  s as (select r, min(kind) kind, min(total) total, coalesce(string_agg(case when j and i < m - 1 then '<line class="line" x1="' || (x + w // 2) || '" y1="' || (y + h // 2) || '" x2="' || (x2 + w // 2) || '" y2="' || (y2 + h // 2) || '"/>' end, '' order by i), '') lines,
   string_agg('<g transform="translate(' || x || ',' || y || ')"><rect class="node" width="' || w || '" height="' || h || '" rx="8"/><text class="id" x="12" y="22">N' || i || '</text><text class="label" x="48" y="22"><tspan x="48" dy="0">' || n_name || '&lt;&amp;</tspan></text><text class="detail" x="12" y="' || (h - 26) || '">d</text><text class="detail" x="12" y="' || (h - 10) || '"></text></g>', '' order by i) boxes from p group by r)
  select r n_regionkey, '<svg xmlns="http://www.w3.org/2000/svg" width="960" height="' || total || '" viewBox="0 0 960 ' || total || '" role="img"><title>' || kind || '</title><text class="heading" x="32" y="42">' || kind || '</text>' || lines || boxes || '</svg>' svg from s""")
def svg_render(spark: SparkSession, d: str) -> DataFrame:
    """K7: the nations of each region, as pictures of the four kinds."""
    n = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("labels"))
    node = lambda label, i: F.struct(F.concat(F.lit("N"), i.cast("string")).alias("id"), F.concat(label, F.lit("<&")).alias("label"), F.lit("d").alias("detail"), F.lit(None).cast("string").alias("ref"))
    kind = F.element_at(F.array(*map(F.lit, sinks.LAYOUTS)), (F.col("n_regionkey") % 4 + 1).cast("int"))
    return n.select("n_regionkey", sinks.svg_picture(kind, kind, F.transform("labels", node)).alias("svg"))
