"""Queries of transcripts: conversations as lines, events as words and turns in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times
from ..operators import intervals as I
from .base import query, table

MINUTE = 60_000_000
BUCKET = 60 * MINUTE


def lines(spark: SparkSession, d: str) -> DataFrame:
    """conversations as transcript lines, 5 s apart and 4 s long by turn."""
    c = table(spark, d, "conversations")
    return c.select(F.col("conv_id").alias("meeting"), F.col("turn").alias("seq"), F.col("role").alias("speaker"), (F.col("turn") * 5).alias("start"), (F.col("turn") * 5 + 4).alias("end"), "text")


def spans(spark: SparkSession, d: str) -> DataFrame:
    """events as intervals in microseconds, floor(value) minutes long."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.greatest(F.floor("value"), F.lit(0)).cast("long") * MINUTE
    return table(spark, d, "events").select(F.col("user_id").alias("meeting"), F.col("event_id"), "event_type", start.alias("start"), (start + length).alias("end"))


def word_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans(spark, d).filter("event_type = 'click'").select("meeting", F.col("event_id").alias("word"), F.col("start").alias("ws"), F.col("end").alias("we"))


def turn_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans(spark, d).filter("event_type <> 'click'").select("meeting", F.col("event_id").alias("turn"), F.col("event_type").alias("speaker"), F.col("start").alias("ts"), F.col("end").alias("te"))


_SPANS = "spans as (select user_id meeting, event_id, event_type, epoch_us(ts) \"start\", epoch_us(ts) + greatest(floor(value), 0)::bigint * 60000000 \"end\" from events)"
_WT = _SPANS + ", w as (select meeting, event_id word, \"start\" ws, \"end\" we from spans where event_type = 'click'), t as (select meeting, event_id turn, event_type speaker, \"start\" ts, \"end\" te from spans where event_type <> 'click'), m as (select * from w join t using (meeting) where ts <= we and te >= ws)"
_LINES = "l as (select conv_id meeting, turn seq, role speaker, turn * 5 \"start\", turn * 5 + 4 \"end\", text from conversations)"


@query(f"""with {_LINES} select meeting, count(*)::bigint n_lines, count(distinct speaker)::bigint n_speakers,
  sum(len(regexp_extract_all(regexp_replace(text, '\\[[^\\]]+\\]', ' ', 'g'), '[0-9A-Za-z가-힣]')))::bigint meaningful,
  sum(len(regexp_extract_all(regexp_replace(text, '\\[[^\\]]+\\]', ' ', 'g'), '[0-9A-Za-z가-힣]'))) < 80 low_content,
  (max("end") - min("start"))::bigint duration from l where trim(text) not in ('', '.', '..', '...', '?', '!') group by meeting""")
def transcript_turn_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: per meeting lines, speakers, meaningful characters, low-content flag."""
    kept = lines(spark, d).filter(~T.is_noise(F.col("text")))
    return kept.groupBy("meeting").agg(
        F.count("*").alias("n_lines"), F.count_distinct("speaker").alias("n_speakers"), F.sum(T.meaningful_chars(F.col("text")).cast("long")).alias("meaningful"),
        (F.sum(T.meaningful_chars(F.col("text"))) < 80).alias("low_content"), (F.max("end") - F.min("start")).alias("duration"),
    )


@query("select conv_id meeting, turn seq, length(text)::bigint n from conversations where trim(text) not in ('', '.', '..', '...', '?', '!') and length(trim(text)) >= 20")
def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    """P1 with its length filter."""
    return lines(spark, d).filter(~T.is_noise(F.col("text")) & (F.length(F.trim("text")) >= 20)).select("meeting", "seq", F.length("text").cast("long").alias("n"))


@query("select doc_id, len(regexp_extract_all(regexp_replace(text, '\\[[^\\]]+\\]', ' ', 'g'), '[0-9A-Za-z가-힣]'))::bigint n from documents")
def meaningful_chars(spark: SparkSession, d: str) -> DataFrame:
    """P2."""
    return table(spark, d, "documents").select("doc_id", T.meaningful_chars(F.col("text")).cast("long").alias("n"))


@query("select doc_id, len(regexp_extract_all(regexp_replace(text, '\\[[^\\]]+\\]', ' ', 'g'), '[0-9A-Za-z가-힣]')) < 80 rejected from documents")
def low_content_reject(spark: SparkSession, d: str) -> DataFrame:
    """P2's decision."""
    return table(spark, d, "documents").select("doc_id", (T.meaningful_chars(F.col("text")) < 80).alias("rejected"))


@query(f"""with {_LINES}, f as (select *, case when lag(speaker) over w is not distinct from speaker and row_number() over w > 1 and "start" - lag("end") over w <= 2 then 0 else 1 end n from l window w as (partition by meeting order by seq)),
  g as (select *, sum(n) over (partition by meeting order by seq) turn from f)
  select meeting, turn::bigint turn, arg_min(speaker, seq) speaker, arg_min("start", seq) "start", arg_max("end", seq) "end", count(*)::bigint segments, string_agg(text, ' ' order by seq) text from g group by meeting, turn""")
def turn_merge_by_role(spark: SparkSession, d: str) -> DataFrame:
    """W1 over conversation lines."""
    return I.merge_turns(lines(spark, d), 2)


_EVENT_TURNS = f"""with {_SPANS}, f as (select *, case when lag(event_type) over w is not distinct from event_type and row_number() over w > 1 and "start" - lag("end") over w <= 3600000000 then 0 else 1 end n from spans window w as (partition by meeting order by "start", event_id)),
  g as (select *, sum(n) over (partition by meeting order by "start", event_id) turn from f)"""


@query(_EVENT_TURNS + """ select meeting, turn::bigint turn, event_type speaker, arg_min("start", ("start", event_id)) "start", arg_max("end", ("start", event_id)) "end", count(*)::bigint segments from g group by meeting, turn, event_type""")
def turn_merge_events(spark: SparkSession, d: str) -> DataFrame:
    """W1 over events of one kind at most an hour apart: first start, last (not latest) end."""
    s = spans(spark, d)
    seq = F.struct("start", "event_id")
    merged = I.merge_turns(s.select("meeting", seq.alias("seq"), F.col("event_type").alias("speaker"), "start", "end", F.lit("").alias("text")), 3600_000_000)
    return merged.drop("text")


@query(f"""with {_SPANS}, f as (select *, "start" - lag("end") over (partition by meeting order by "start", event_id) since from spans),
  g as (select *, sum(case when since >= 0 and since <= 10800000000 then 0 else 1 end) over (partition by meeting order by "start", event_id) grp from f)
  select meeting project, grp::bigint grp, min("start") "start", count(*)::bigint items from g group by 1, 2""")
def restart_groups(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of items that begin 0 to 180 minutes after the one before ends."""
    items = spans(spark, d).select(F.col("meeting").alias("project"), F.col("event_id").alias("item"), "start", "end")
    return I.restart_groups(items, 180 * MINUTE).groupBy("project", "grp").agg(F.min("start").alias("start"), F.count("*").alias("items"))


@query("""with g as (select user_id, event_id, ts, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) <= 10800000000 then 0 else 1 end n from events),
  h as (select *, sum(n) over (partition by user_id order by ts, event_id) island from g) select user_id, island::bigint island, count(*)::bigint n from h group by 1, 2""")
def gap_islands(spark: SparkSession, d: str) -> DataFrame:
    """Islands of events that start within 180 minutes of each other."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, d, "events").withColumn("at", at)
    w = Window.partitionBy("user_id").orderBy("at", "event_id")
    e = e.withColumn("new", ~F.coalesce(F.col("at") - F.lag("at").over(w) <= 180 * MINUTE, F.lit(False)))
    return I.islands(e, ["user_id"], ["at", "event_id"], F.col("new")).groupBy("user_id", "island").agg(F.count("*").alias("n"))


@query(f"""with {_SPANS}, s as (select meeting "key", greatest("start" - 60000000, 0) a, "end" + 60000000 b from spans where "end" + 60000000 > "start" - 60000000),
  f as (select *, max(b) over (partition by "key" order by a, b rows between unbounded preceding and 1 preceding) latest from s),
  g as (select *, sum(case when latest is null or a > latest + 30000000 then 1 else 0 end) over (partition by "key" order by a, b rows unbounded preceding) clip from f)
  select "key", clip::bigint clip, min(a) "start", max(b) "end", count(*)::bigint spans from g group by 1, 2""")
def interval_union(spark: SparkSession, d: str) -> DataFrame:
    """Events as speech, padded by a minute, joined over gaps of up to half a minute."""
    return I.interval_union(spans(spark, d).select(F.col("meeting").alias("key"), "start", "end"), MINUTE, MINUTE // 2)


@query(f"""with {_WT}, h as (select *, 2 * ts <= ws + we and ws + we <= 2 * te hit, least(we, te) - greatest(ws, ts) over_ from m),
  a as (select meeting, word, arg_min(speaker, turn) filter (hit) held from h group by 1, 2),
  b as (select meeting, word, speaker near from h where over_ > 0 qualify row_number() over (partition by meeting, word order by over_ desc, turn) = 1)
  select w.*, coalesce(held, near) speaker from w left join a using (meeting, word) left join b using (meeting, word)""")
def interval_assign_midpoint(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as words, other events as turns."""
    return I.assign_midpoint(word_spans(spark, d), turn_spans(spark, d), BUCKET)


_OVER = "o as (select meeting, word, ws, we, speaker, sum(least(we, te) - greatest(ws, ts))::bigint score, min(ts) \"first\" from m where least(we, te) > greatest(ws, ts) group by all)"
_SIM = "s as (select distinct a.meeting, a.word from m a join m b on a.meeting = b.meeting and a.word = b.word and a.speaker <> b.speaker and least(a.we, a.te, b.te) > greatest(a.ws, a.ts, b.ts))"


@query(f"with {_WT}, {_OVER} select * from o")
def interval_assign_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of each word with each speaker."""
    return I.overlaps(word_spans(spark, d), turn_spans(spark, d), BUCKET)


@query(f"with {_WT}, {_SIM} select meeting, word from s")
def simultaneous_turns(spark: SparkSession, d: str) -> DataFrame:
    """J3."""
    return I.simultaneous(word_spans(spark, d), turn_spans(spark, d), BUCKET).filter("simultaneous").select("meeting", "word")


@query(f"""with {_WT}, {_OVER}, {_SIM}, r as (select *, row_number() over k rank, lead(score) over k nxt, count(*) over (partition by meeting, word) n from o window k as (partition by meeting, word order by score desc, "first", speaker)),
  p as (select meeting, word, arg_min(speaker, turn) point, count(distinct speaker) pn from m where ws = we group by 1, 2),
  x as (select w.*, r.speaker most, r.n, p.point, p.pn, s.word is not null sim, case when r.score is null then 0.0 else greatest((r.score - coalesce(nxt, 0))::double / (w.we - w.ws), 0.0) end l from w left join r on r.meeting = w.meeting and r.word = w.word and rank = 1 left join p on p.meeting = w.meeting and p.word = w.word left join s on s.meeting = w.meeting and s.word = w.word)
  select meeting, word, coalesce(most, point) speaker, most is null or sim or (coalesce(n > 1, pn > 1, false) and l < 0.15) uncertain, sim simultaneous, coalesce(n > 1, pn > 1, false) transition from x""")
def overlap_uncertainty(spark: SparkSession, d: str) -> DataFrame:
    """Assignment by overlap with its flags."""
    return I.assign_overlap(word_spans(spark, d), turn_spans(spark, d), BUCKET).select("meeting", "word", "speaker", "uncertain", "simultaneous", "transition")


@query(f"""with {_WT} select (sum(case when a.speaker is distinct from b.speaker then 1 else 0 end))::bigint changed, sum(case when a.speaker is null then 1 else 0 end)::bigint unassigned, count(*)::bigint words from
  (select w.meeting, w.word, coalesce((select arg_min(speaker, turn) from m where m.meeting = w.meeting and m.word = w.word and 2 * ts <= m.ws + m.we and m.ws + m.we <= 2 * te), (select speaker from m where m.meeting = w.meeting and m.word = w.word and least(we, te) > greatest(ws, ts) order by least(we, te) - greatest(ws, ts) desc, turn limit 1)) speaker from w) a
  join (select w.meeting, w.word, coalesce((select speaker from (select speaker, sum(least(we, te) - greatest(ws, ts)) sc, min(ts) f from m where m.meeting = w.meeting and m.word = w.word and least(we, te) > greatest(ws, ts) group by speaker) order by sc desc, f, speaker limit 1), (select arg_min(speaker, turn) from m where m.meeting = w.meeting and m.word = w.word and ws = we)) speaker from w) b using (meeting, word)""")
def assignment_changes(spark: SparkSession, d: str) -> DataFrame:
    """Words that the two assignments give to different speakers."""
    w, t = word_spans(spark, d), turn_spans(spark, d)
    a = I.assign_midpoint(w, t, BUCKET).select("meeting", "word", F.col("speaker").alias("a"))
    b = I.assign_overlap(w, t, BUCKET).select("meeting", "word", F.col("speaker").alias("b"))
    return a.join(b, ["meeting", "word"]).agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed"), F.count_if(F.col("a").isNull()).alias("unassigned"), F.count("*").alias("words"))


_CLIPS = "s as (select meeting, \"start\" a, \"end\" b from spans where event_type = 'view' and \"end\" > \"start\")"


@query(f"""with {_SPANS}, w as (select meeting, event_id word, "start" ws, "end" we from spans where event_type = 'click'), {_CLIPS} select w.meeting, w.word from w where not exists (select 1 from s where s.meeting = w.meeting and 2 * a <= ws + we and ws + we <= 2 * b)""")
def outside_clip_words(spark: SparkSession, d: str) -> DataFrame:
    """Clicks whose midpoint no view covers."""
    clips = spans(spark, d).filter("event_type = 'view' and end > start").select("meeting", F.col("start").alias("cs"), F.col("end").alias("ce"))
    return I.outside(word_spans(spark, d), clips, BUCKET).select("meeting", "word")


@query(f"""with {_WT} select meeting, word, string_agg(speaker, ' ' order by ts, turn) speakers, count(*)::bigint n from m group by 1, 2""")
def claim_segment_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Every turn that touches a claim, ends included, in order of time."""
    m = I.met(word_spans(spark, d), turn_spans(spark, d), BUCKET)
    ordered = F.array_sort(F.collect_list(F.struct("ts", "turn", "speaker")))
    return m.groupBy("meeting", "word").agg(F.array_join(F.transform(ordered, lambda x: x["speaker"]), " ").alias("speakers"), F.count("*").alias("n"))


@query(f"""with {_SPANS} select meeting, event_type speaker, count(*)::bigint turns, sum("end" - "start")::bigint "time" from spans group by 1, 2""")
def speaker_stats(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return I.speaker_stats(spans(spark, d).withColumnRenamed("event_type", "speaker"), ["meeting"])


@query("""select user_id meeting, event_type speaker, n from (select user_id, event_type, count(*)::bigint n, min(event_id) f, row_number() over (partition by user_id order by count(*) desc, min(event_id)) r from events group by 1, 2) where r = 1""")
def majority_label(spark: SparkSession, d: str) -> DataFrame:
    """A7."""
    e = table(spark, d, "events").select(F.col("user_id").alias("meeting"), F.col("event_type").alias("speaker"), F.col("event_id").alias("seq"))
    return I.majority(e, ["meeting"])


@query("""with f as (select conv_id, role, min(turn) t from conversations group by 1, 2), r as (select *, row_number() over (partition by conv_id order by t) n from f)
  select c.conv_id meeting, c.turn seq, chr((64 + n)::int) label from conversations c join r using (conv_id, role)""")
def speaker_first_seen_label(spark: SparkSession, d: str) -> DataFrame:
    """W5."""
    return I.speaker_labels(lines(spark, d).select("meeting", "seq", "speaker")).select("meeting", "seq", "label")


@query("""with f as (select conv_id, role, min(turn) t from conversations group by 1, 2), r as (select *, chr((64 + row_number() over (partition by conv_id order by t))::int) label from f)
  select c.conv_id meeting, string_agg(printf('[%02d:%02d:%02d - %02d:%02d:%02d] ', (turn * 5 // 3600)::int, (turn * 5 % 3600 // 60)::int, (turn * 5 % 60)::int, ((turn * 5 + 4) // 3600)::int, ((turn * 5 + 4) % 3600 // 60)::int, ((turn * 5 + 4) % 60)::int) || label || ': ' || text, chr(10) order by turn) transcript from conversations c join r using (conv_id, role) group by 1""")
def transcript_render(spark: SparkSession, d: str) -> DataFrame:
    """Labelled lines with clock times, one text for each meeting."""
    labelled = I.speaker_labels(lines(spark, d))
    line = F.concat(F.lit("["), times.clock(F.col("start")), F.lit(" - "), times.clock(F.col("end")), F.lit("] "), F.col("label"), F.lit(": "), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", line.alias("line"))))
    return labelled.groupBy("meeting").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("transcript"))


@query("""with w as (select conv_id, turn, unnest(range(1, len(s) + 1)) i, s from (select conv_id, turn, list_filter(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> '') s from conversations)),
  v as (select conv_id, turn, i, s[i] word, case when s[i] = lower(s[i]) then 'low' else 'cap' end speaker from w),
  f as (select *, case when lag(speaker) over (partition by conv_id, turn order by i) is not distinct from speaker then 0 else 1 end n from v),
  g as (select *, sum(n) over (partition by conv_id, turn order by i) run from f) select conv_id meeting, turn seq, run::bigint run, min(speaker) speaker, string_agg(word, ' ' order by i) text, count(*)::bigint n from g group by 1, 2, 3""")
def speaker_runs(spark: SparkSession, d: str) -> DataFrame:
    """A line's words split into runs of one speaker (here: capitalised or not)."""
    w = lines(spark, d).select("meeting", "seq", F.posexplode(T.words(F.col("text"))).alias("i", "word")).withColumn("speaker", F.when(F.col("word") == F.lower("word"), "low").otherwise("cap"))
    order = Window.partitionBy("meeting", "seq").orderBy("i")
    w = w.withColumn("new", ~F.coalesce(F.lag("speaker").over(order) == F.col("speaker"), F.lit(False)))
    runs = I.islands(w, ["meeting", "seq"], ["i"], F.col("new"), "run")
    ordered = F.array_sort(F.collect_list(F.struct("i", "word")))
    return runs.groupBy("meeting", "seq", "run").agg(F.min("speaker").alias("speaker"), F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("text"), F.count("*").alias("n"))


_SEGMENTS = """c as (select *, word // 40 segment, case when word % 5 = 0 then '' else 'w' || word % 3 end said from w), g as (select meeting, segment, min(ws) ss, max(we) se, 'S' || segment whole from c group by all), d as (select * from c where segment % 4 <> 0),
  u as (select meeting, word id, 'w' kind, ws, we from d union all select meeting, segment, 's', ss, se from g where segment % 4 = 0),
  h as (select u.*, turn, speaker, 2 * ts <= ws + we and ws + we <= 2 * te hit, least(we, te) - greatest(ws, ts) over_ from u join t using (meeting) where ts <= we and te >= ws),
  j as (select meeting, id, kind, coalesce(first(speaker order by turn) filter (hit), first(speaker order by over_ desc, turn) filter (over_ > 0)) speaker from h group by all),
  k as (select u.meeting, u.id, u.kind, speaker from u left join j using (meeting, id, kind)), v as (select d.*, speaker from d join k on kind = 'w' and k.meeting = d.meeting and id = word)"""


@query(f"""with {_WT}, {_SEGMENTS}, f as (select *, case when row_number() over o = 1 or lag(speaker) over o is distinct from speaker then 1 else 0 end n from v window o as (partition by meeting, segment order by word)),
  r as (select *, sum(n) over (partition by meeting, segment order by word)::bigint run from f), x as (select meeting, segment, run, arg_min(ws, word) "start", arg_max(we, word) "end", min(speaker) speaker, coalesce(string_agg(said, ' ' order by word) filter (said <> ''), 'S' || segment) text from r group by 1, 2, 3)
  select * from x union all select meeting, segment, 1, ss, se, speaker, whole from g join k using (meeting) where kind = 's' and id = segment and segment % 4 = 0""")
def segment_runs(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as words, forty event ids a segment, of which every fourth has lost its words; split where the speaker changes."""
    return I.assign_segments(*_segments(spark, d), turn_spans(spark, d), BUCKET)


@query(f"""with {_WT}, {_SEGMENTS}, n as (select meeting, segment, speaker, count(*) n, min(word) f from v where speaker is not null group by all), b as (select meeting, segment, speaker from n qualify row_number() over (partition by meeting, segment order by n desc, f) = 1)
  select g.meeting, g.segment, 1::bigint run, ss "start", se "end", case when g.segment % 4 = 0 then k.speaker else b.speaker end speaker, whole text from g left join b on b.meeting = g.meeting and b.segment = g.segment left join k on k.kind = 's' and k.meeting = g.meeting and k.id = g.segment""")
def segment_speakers(spark: SparkSession, d: str) -> DataFrame:
    """The same segments, whole."""
    return I.assign_segments(*_segments(spark, d), turn_spans(spark, d), BUCKET, split=False)


def _segments(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w = word_spans(spark, d).withColumn("segment", F.floor(F.col("word") / 40))
    whole = w.groupBy("meeting", "segment").agg(F.min("ws").alias("ss"), F.max("we").alias("se")).withColumn("text", F.concat(F.lit("S"), F.col("segment").cast("string")))
    said = F.when(F.col("word") % 5 == 0, "").otherwise(F.concat(F.lit("w"), (F.col("word") % 3).cast("string")))
    return whole, w.withColumn("text", said).withColumn("ws", F.when(F.col("segment") % 4 != 0, F.col("ws")))


def synthetic_meeting(spark: SparkSession, seconds: int = 5400, meetings: int = 1) -> tuple[DataFrame, DataFrame]:
    """Words of 0.42 s every 0.5 s, turns of 4 s by four speakers in rotation, one overlapping turn
    for every 25; in milliseconds."""
    m = spark.range(meetings).select(F.col("id").alias("meeting"))
    words = m.join(spark.range(seconds * 2).select(F.col("id").alias("word")).hint("broadcast"), how="cross") if meetings > 1 else spark.range(seconds * 2).select(F.lit(0).cast("long").alias("meeting"), F.col("id").alias("word"))
    turns = spark.range(seconds // 4).select(F.lit(0).cast("long").alias("meeting"), F.col("id").alias("turn"), F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("speaker"), (F.col("id") * 4000).alias("ts"), (F.col("id") * 4000 + 4000).alias("te"))
    extra = spark.range(seconds // 100).select(F.lit(0).cast("long").alias("meeting"), (F.col("id") + 1_000_000).alias("turn"), F.concat(F.lit("S"), ((F.col("id") * 25 + 2) % 4).cast("string")).alias("speaker"), (F.col("id") * 100_000 + 1000).alias("ts"), (F.col("id") * 100_000 + 3000).alias("te"))
    both = turns.union(extra)
    if meetings > 1:
        both = both.drop("meeting").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(meetings - 1).cast("long"))).alias("meeting"), "turn", "speaker", "ts", "te")
    return words.select("meeting", "word", (F.col("word") * 500).alias("ws"), (F.col("word") * 500 + 420).alias("we")), both


@query("""with w as (select i word, i * 500 ws, i * 500 + 420 we from range(10800) t(i)), t as (select i turn, 'S' || (i % 4) speaker, i * 4000 ts, i * 4000 + 4000 te from range(1350) t(i) union all select i + 1000000, 'S' || ((i * 25 + 2) % 4), i * 100000 + 1000, i * 100000 + 3000 from range(54) t(i)),
  o as (select word, speaker, sum(least(we, te) - greatest(ws, ts)) sc, min(ts) f from w join t on ts <= we and te >= ws and least(we, te) > greatest(ws, ts) group by 1, 2)
  select word::bigint word, speaker from o qualify row_number() over (partition by word order by sc desc, f, speaker) = 1""")
def synthetic_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The published synthetic case, 10,800 words and 1,404 turns, by overlap."""
    words, turns = synthetic_meeting(spark)
    return I.assign_overlap(words, turns, 10_000).select("word", "speaker")
