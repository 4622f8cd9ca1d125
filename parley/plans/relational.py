"""Queries of plain relational operators: set operations, semi and anti joins, dedupe, ordered sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import query, table


@query("select doc_id from documents union select doc_id from labels")
def keys_union(spark: SparkSession, d: str) -> DataFrame:
    """U1 and U3."""
    return table(spark, d, "documents").select("doc_id").union(table(spark, d, "labels").select("doc_id")).distinct()


@query("select doc_id from documents except select doc_id from labels")
def new_keys_except(spark: SparkSession, d: str) -> DataFrame:
    """U2 and U5."""
    return table(spark, d, "documents").select("doc_id").subtract(table(spark, d, "labels").select("doc_id"))


@query("select distinct o_custkey k from orders where o_orderstatus = 'O' intersect select distinct o_custkey from orders where o_orderstatus = 'F'")
def keys_intersect(spark: SparkSession, d: str) -> DataFrame:
    """U4."""
    o = table(spark, d, "orders")
    of = lambda s: o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return of("O").intersect(of("F"))


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def unprocessed_anti(spark: SparkSession, d: str) -> DataFrame:
    """P5: rows without a result yet."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey")


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 100000)")
def existing_semi(spark: SparkSession, d: str) -> DataFrame:
    """P20: rows whose counterpart exists."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders").filter("o_totalprice > 100000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey")


@query("select entry, min(line_no)::bigint line_no from (select lower(event_type) || (user_id % 40) entry, event_id line_no from events) group by 1")
def ordered_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The first of each entry, in order."""
    e = table(spark, d, "events").select(F.concat(F.lower("event_type"), (F.col("user_id") % 40).cast("string")).alias("entry"), F.col("event_id").alias("line_no"))
    return e.groupBy("entry").agg(F.min("line_no").alias("line_no"))


@query("select o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') sources from orders group by 1")
def sources_union(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct sources."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("sources"))


@query("select count(*) filter (o_orderstatus = 'O')::bigint open, count(*) filter (o_orderstatus = 'F')::bigint filled, count(*) filter (o_orderstatus = 'P')::bigint partial from orders")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """A6 and A17."""
    return table(spark, d, "orders").agg(*(F.count_if(F.col("o_orderstatus") == s).alias(n) for s, n in (("O", "open"), ("F", "filled"), ("P", "partial"))))


@query("""select 'rows' counter, count(*)::bigint n from orders union all select o_orderstatus, count(*)::bigint from orders where o_orderstatus in ('O', 'F', 'P') group by 1""")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """A run that writes the orders counts them, by status, while they pass."""
    from ..operators import counters as C
    from .files import scratch_folder

    rows, seen = C.observed(table(spark, d, "orders"), C.counters("o_orderstatus", ("O", "F", "P")))
    rows.write.parquet(scratch_folder(spark, "counted"))
    return spark.createDataFrame([(k, v) for k, v in seen.get.items() if v], "counter string, n long")


@query("""select o_orderkey, case when o_totalprice is null then 'no duration' when o_totalprice < 10000 then 'too short' when o_totalprice > 0 and o_custkey / o_totalprice >= 0.05 then 'silent' else 'ok' end verdict from orders""")
def audio_reject_rule(spark: SparkSession, d: str) -> DataFrame:
    """The first reason that holds."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.when(F.col("o_totalprice").isNull(), "no duration").when(F.col("o_totalprice") < 10000, "too short").when((F.col("o_totalprice") > 0) & (F.col("o_custkey") / F.col("o_totalprice") >= 0.05), "silent").otherwise("ok").alias("verdict"))


@query("select p_partkey, coalesce(s_name, '') label from part left join supplier on p_partkey = s_suppkey")
def label_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A label by key, empty if there is none."""
    p, s = table(spark, d, "part"), table(spark, d, "supplier")
    return p.join(s, p["p_partkey"] == s["s_suppkey"], "left").select("p_partkey", F.coalesce("s_name", F.lit("")).alias("label"))


@query("""select p_partkey, case when length(t) between 2 and 40 and not regexp_matches(t, '/| etc') and not regexp_matches(lower(t), 'anodized|plated') then t end term from (select p_partkey, trim(regexp_replace(p_type, '[.,;:!?]+', '', 'g')) t from part)""")
def glossary_clean(spark: SparkSession, d: str) -> DataFrame:
    """Candidates cleaned, noise dropped."""
    t = F.trim(F.regexp_replace("p_type", "[.,;:!?]+", ""))
    ok = F.length(t).between(2, 40) & ~t.rlike("/| etc") & ~F.lower(t).rlike("anodized|plated")
    return table(spark, d, "part").select("p_partkey", F.when(ok, t).alias("term"))


@query("select n_name, r_name, count(c_custkey)::bigint customers from nation join region on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by 1, 2")
def key_summary(spark: SparkSession, d: str) -> DataFrame:
    """A18 and T2's input: counts through dimension joins; small sides are broadcast by their size."""
    n, r, c = (table(spark, d, t) for t in ("nation", "region", "customer"))
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).join(c, c["c_nationkey"] == n["n_nationkey"], "left").groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("customers"))


@query("""select doc_id, coalesce(nullif(regexp_extract(text, '^# (.+)', 1), ''), nullif(trim(split_part(text, '.', 1)), ''), source) title from documents""")
def title_derivation(spark: SparkSession, d: str) -> DataFrame:
    """heading, else first sentence, else the stem."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.coalesce(F.nullif(F.regexp_extract("text", "^# (.+)", 1), F.lit("")), F.nullif(F.trim(F.split("text", r"\.")[0]), F.lit("")), F.col("source")).alias("title"))


@query("""select doc_id, case when contains(text, 'private') then 'private' when contains(text, 'public') then 'public' else 'public' end visibility from documents""")
def visibility(spark: SparkSession, d: str) -> DataFrame:
    """A private mark wins over a public one; public by default."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.when(t.contains("private"), "private"), F.when(t.contains("public"), "public"), F.lit("public")).alias("visibility"))


@query("""select o_orderkey, o_custkey, o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) r from orders) where r <= 2""")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    """W7."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return table(spark, d, "orders").withColumn("r", F.row_number().over(w)).filter("r <= 2").select("o_orderkey", "o_custkey", "o_orderdate")
