"""Queries of page, recording and request helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages as G
from .base import query, table


@query("""select p_partkey, coalesce(case when p_size % 3 = 0 then 'Name' end, case when p_size % 2 = 0 then 'Zeta' end) title, case when p_size % 5 = 0 then 'Date' else 'When' end "date", null::varchar participants, case when p_size % 7 = 0 then '구분' end meeting_type from part""")
def property_schema(spark: SparkSession, d: str) -> DataFrame:
    """tables whose properties have other names, or none."""
    n = F.col("p_size")
    pair = lambda on, name, kind: F.when(on, F.struct(F.lit(name), F.lit(kind)))
    entries = F.filter(F.array(pair(n % 3 == 0, "Name", "title"), pair(n % 2 == 0, "Zeta", "title"), pair(n % 5 == 0, "Date", "date"), F.struct(F.lit("When"), F.lit("date")), pair(n % 7 == 0, "구분", "select"), pair(n % 7 != 0, "Type", "number")), lambda x: x.isNotNull())
    found = table(spark, d, "part").select("p_partkey", G.schema_of(F.map_from_entries(entries)).alias("s"))
    return found.select("p_partkey", "s.title", "s.date", "s.participants", "s.meeting_type")


@query("""select o_orderkey, case when o_orderkey % 4 = 0 then '' else trim('n ' || o_custkey || case when o_orderkey % 3 = 0 then '!' else '' end) end title, epoch_us(o_orderdate)::bigint made from orders""")
def page_objects(spark: SparkSession, d: str) -> DataFrame:
    """titles and times of pages in JSON."""
    k = F.col("o_orderkey")
    runs = F.concat(F.lit('[{"plain_text": " n "}, {"plain_text": "'), F.col("o_custkey").cast("string"), F.lit('"}'), F.when(k % 3 == 0, ', {"plain_text": "!"}').otherwise(""), F.lit("]"))
    props = F.concat(F.lit('{"a": {"type": "date"}, "b": {"type": "title", "title": '), F.when(k % 4 == 0, "[]").otherwise(runs), F.lit("}}"))
    stamp = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    o = table(spark, d, "orders").select("o_orderkey", props.alias("props"), F.when(k % 2 == 0, stamp).alias("created"), stamp.alias("edited"))
    return o.select("o_orderkey", G.page_title(F.col("props")).alias("title"), F.unix_micros(G.page_time(F.col("created"), F.col("edited"))).alias("made"))


@query("""select doc_id, case when doc_id % 3 = 0 then '' else source end project, 'm.' || doc_id stem, case when doc_id % 4 = 0 then 'a b' else 'm.' || doc_id end label from documents""")
def recording_contexts(spark: SparkSession, d: str) -> DataFrame:
    """project, stem and label of notes, some outside the folder of notes, some without a label."""
    k = F.col("doc_id")
    path = F.concat(F.when(k % 3 == 0, "other/").otherwise("notes/"), "source", F.lit("/m."), k.cast("string"), F.lit(".md"))
    project, stem, label = G.recording_context(path, F.when(k % 4 == 0, " a \n b ").when(k % 4 == 1, " "))
    return table(spark, d, "documents").select("doc_id", project.alias("project"), stem.alias("stem"), label.alias("label"))


@query("""select c_custkey, case when c_custkey % 4 = 0 then 0 when c_custkey % 4 = 1 then 0 else 1 end::int entries, regexp_matches(lower(c_name || case when c_custkey % 5 = 0 then ' Admin' else '' end), '테스트|관리자|운영자|test|admin') excluded from customer""")
def histories(spark: SparkSession, d: str) -> DataFrame:
    """Histories that are broken or of another shape count as empty; names that are no people's."""
    k = F.col("c_custkey")
    text = F.when(k % 4 == 0, "{broken").when(k % 4 == 1, '{"version": 1}').otherwise(F.concat(F.lit('{"version": 1, "entries": {"k": {"name": "'), "c_name", F.lit('"}}}')))
    return table(spark, d, "customer").select("c_custkey", F.size(G.history_of(text)).alias("entries"), G.excluded(F.concat("c_name", F.when(k % 5 == 0, " Admin").otherwise(""))).alias("excluded"))


@query("""select o_custkey, count(*)::int all_, count(*) filter (o_orderkey % 3 <> 0)::int accepted, string_agg(case when o_orderkey % 3 <> 0 then o_orderkey::varchar end, ',' order by o_orderkey) patches from orders group by 1""")
def accepted_patches(spark: SparkSession, d: str) -> DataFrame:
    """the accepted patches of each manifest."""
    p = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3 != 0).alias("accepted"))))
    m = G.accepted(table(spark, d, "orders").groupBy(F.col("o_custkey").alias("version")).agg(p.alias("decisions")))
    kept = F.nullif(F.array_join(F.transform("patches", lambda x: x["k"].cast("string")), ","), F.lit(""))
    return m.select(F.col("version").alias("o_custkey"), (F.col("accepted") + F.col("rejected")).alias("all_"), "accepted", kept.alias("patches"))


@query("""select p_partkey, case when p_partkey % 5 = 0 then 'source_sha256' when p_partkey % 7 = 0 then 'readable_path' else '' end missing, case when p_partkey % 3 = 0 then 's' || p_partkey end existing, p_partkey % 5 <> 0 and p_partkey % 7 <> 0 hashed, case when p_partkey % 2 = 0 then 'approval_id,expires_at' else '' end lacks from part""")
def publication_requests(spark: SparkSession, d: str) -> DataFrame:
    """F64: requests with their snapshot, and what approvals lack."""
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    notes = table(spark, d, "part").select(k.alias("key"), F.concat(F.lit("a"), s).alias("source_path"), F.when(k % 5 == 0, " ").otherwise("h").alias("source_sha256"), F.when((k % 7 == 0) & (k % 5 != 0), F.lit(None)).otherwise("r").alias("readable_path"), F.lit("x").alias("readable_sha256"), F.lit("t").alias("target_data_source_id"))
    published = notes.filter("key % 3 = 0").select("key", F.concat(F.lit("s"), F.col("key").cast("string")).alias("page_id"))
    approval = F.struct(*(F.when((F.col("key") % 2 == 0) & F.lit(c in ("approval_id", "expires_at")), "").otherwise("v").alias(c) for c in G.APPROVAL))
    r = G.requests(notes, published)
    return r.select(F.col("key").alias("p_partkey"), F.array_join("missing", ",").alias("missing"), "existing", F.col("request_sha256").isNotNull().alias("hashed"), F.array_join(G.approval_missing(approval), ",").alias("lacks"))


@query("""select page_id, case when page_id % 3 = 0 then 'a\\*b ' || page_id || chr(10) when page_id % 3 = 1 then 'a\\*b ' || page_id || chr(10) || '![p](x)' || chr(10) || 'z' || chr(10) end exported from pages""")
def export_checks(spark: SparkSession, d: str) -> DataFrame:
    """exports without pictures, with the embed that a picture became, and without it."""
    k = F.col("page_id")
    body = F.concat(F.lit("a\\\\*b "), k.cast("string"), F.when(k % 3 == 1, '\n<embed src="u">c\n</embed>\nz').otherwise(""), F.lit("\n \n"))
    return table(spark, d, "pages").select("page_id", G.verified_export(body, F.when(k % 3 != 0, "![p](x)")).alias("exported"))


@query("""select event_id, greatest(v - 0.5, 0.0) s, least(v + 1.5, 90.0) e, v / greatest(v - 20, 1.0) r, case when event_id % 2 = 0 then 0.0 else v end h from (select event_id, (event_id % 100)::double v from events)""")
def guarded_numbers(spark: SparkSession, d: str) -> DataFrame:
    """F39, F40 and F41."""
    v = (F.col("event_id") % 100).cast("double")
    s, e = G.clamped(v, v + 1.0, 0.5, F.lit(90.0))
    half = G.half_even(F.lit(0.5), 0) + F.when(F.col("event_id") % 2 == 0, 0.0).otherwise(v)
    return table(spark, d, "events").select("event_id", s.alias("s"), e.alias("e"), G.ratio(v, v - 20).alias("r"), half.alias("h"))


@query("""select conv_id, trim(string_agg(trim(t), ' ' order by turn)) "text", count(*) filter (turn % 2 = 0)::int spans, lower(regexp_replace(string_agg(trim(t), ' ' order by turn), '\\s+', '', 'g')) compact from (select conv_id, turn, regexp_replace(text, '[^ -~]', '?', 'g') t from conversations) group by 1""")
def segment_texts(spark: SparkSession, d: str) -> DataFrame:
    """texts, word intervals and compact forms of nested segments."""
    t = F.regexp_replace("text", "[^ -~]", "?")
    word = F.struct(F.col("turn").cast("double").alias("start"), F.when(F.col("turn") % 2 == 0, F.col("turn") + 1.0).alias("end"), F.lit("w").alias("word"))
    seg = F.struct("turn", F.struct(F.concat(F.lit(" "), t).alias("text"), F.array(word).alias("words")).alias("s"))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(seg)), lambda x: x["s"]).alias("segments"))
    return c.select("conv_id", G.segment_text(F.col("segments")).alias("text"), F.size(G.word_spans(F.col("segments"))).alias("spans"), G.compact(G.segment_text(F.col("segments"))).alias("compact"))
