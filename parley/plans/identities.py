"""Queries of names and rosters, over customers, suppliers, parts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import identity as N
from .base import query, table


@query("select c_custkey, substr(sha256('alias:' || lower(c_name)), 1, 24) own, substr(sha256('mail:' || lower(c_name) || '@other.example'), 1, 24) other, substr(sha256('name:' || c_mktsegment), 1, 24) fallback from customer")
def identity_hash(spark: SparkSession, d: str) -> DataFrame:
    """F46 in three of its cases."""
    c = table(spark, d, "customer")
    key = lambda mail, back: N.identity_key(mail, F.lit(None).cast("string"), back, "corp.example")
    return c.select("c_custkey", key(F.concat("c_name", F.lit("@corp.example")), F.lit("")).alias("own"), key(F.concat("c_name", F.lit("@Other.example")), F.lit("")).alias("other"), key(F.lit(None).cast("string"), F.col("c_mktsegment")).alias("fallback"))


_TOK = "t as (select distinct replace(p_name, ' ', '') token from part), r as (select distinct replace(p_name, ' ', '') || 'x' name from part)"


@query(f"""with {_TOK}, j as (select token, name, 1.0::double - levenshtein(token, name)::double / greatest(length(token), length(name)) sim from t, r where token <> name),
  k as (select *, row_number() over (partition by token order by sim desc, name) rank from j where sim >= 0.72) select token, name, round(sim, 9) sim, rank::int rank from k where rank <= 2""")
def fuzzy_name_join(spark: SparkSession, d: str) -> DataFrame:
    """J6 over part names, with all of them as the roster."""
    p = table(spark, d, "part").withColumn("name", F.replace("p_name", F.lit(" "), F.lit("")))
    return N.fuzzy_names(p.select(F.col("name").alias("token")), p.select(F.concat("name", F.lit("x")).alias("name")), 0.72, 2).withColumn("sim", F.round("sim", 9))


@query()
def jamo_similarity_topk(spark: SparkSession, d: str) -> DataFrame:
    """J6 on Hangul names by their letters."""
    from ..functions import text as T

    tokens = spark.createDataFrame([("김민중",), ("이서윤",), ("박지호",)], "token string")
    roster = spark.createDataFrame([("김민준",), ("이서연",), ("최지호",), ("박지후",)], "name string")
    asked, held = (x.select(F.col(c).alias(f"full_{c}"), T.jamo(F.col(c)).alias(c)) for x, c in ((tokens, "token"), (roster, "name")))
    found = N.fuzzy_names(asked, held, 0.6, 2)
    return found.join(asked, "token").join(held, "name").select(F.col("full_token").alias("token"), F.col("full_name").alias("name"), F.round("sim", 4).alias("sim"), "rank")


_PAIRS = "w as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{3,}'))) target, source from documents), c as (select doc_id note, target, lower(target) variant, source from w)"


def _confirmed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    w = docs.select(F.col("doc_id").alias("note"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3,}"), F.lit(0)))).alias("target"))
    return w.withColumn("variant", F.lower("target"))


@query(f"with {_PAIRS} select target, variant, count(distinct note)::bigint \"count\" from c group by 1, 2")
def ledger_counts(spark: SparkSession, d: str) -> DataFrame:
    """A2: capitalised words as confirmed targets, their lower case as variants."""
    return N.ledger_counts(_confirmed(spark, d))


@query(f"with {_PAIRS}, g as (select c.* from c join documents d on d.doc_id = c.note where contains(d.text, c.variant)) select target, variant, count(distinct note)::bigint \"count\" from g group by 1, 2 order by 3 desc, 1, 2 limit 200")
def ledger_grounded(spark: SparkSession, d: str) -> DataFrame:
    """J8, A2, and the 200 of T1."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("note"), "text")
    return N.ledger_counts(N.grounded(_confirmed(spark, d), texts)).orderBy(F.desc("count"), "target", "variant").limit(200)


@query("""with l as (select distinct lower(p_type) variant, p_brand target from part), v as (select variant, min(target) target from l group by 1),
  w as (select distinct lower(p_type) || s word, lower(p_type) base from part, (values (''), ('s'), ('es'), ('-x')) x(s)),
  h as (select w.word, v.variant, v.target, row_number() over (partition by w.word order by length(v.variant) desc) r from w join v on w.word in (v.variant, v.variant || 's', v.variant || 'es')) select word, variant, target from h where r = 1""")
def ledger_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Words that are a variant with or without a suffix."""
    p = table(spark, d, "part")
    ledger = p.groupBy(F.lower("p_type").alias("variant")).agg(F.min("p_brand").alias("target"))
    words = p.select(F.explode(F.array(*(F.concat(F.lower("p_type"), F.lit(s)) for s in ("", "s", "es", "-x")))).alias("word")).distinct()
    return N.ledger_lookup(words, ledger, ["s", "es"]).select("word", "variant", "target")


@query("""with t as (select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) term, unnest(generate_series(1, len(regexp_extract_all(text, '[A-Z][a-z]+')))) pos from documents),
  f as (select term, min(doc_id * 1000000 + pos) "first" from t where length(term) between 4 and 40 group by 1) select term, "first" from f order by "first" limit 80""")
def glossary_ordered_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Terms by first appearance, the first 80."""
    found = table(spark, d, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("pos", "term"))
    kept = found.filter(F.length("term").between(4, 40)).groupBy("term").agg(F.min(F.col("doc_id") * 1_000_000 + F.col("pos") + 1).alias("first"))
    return kept.orderBy("first").limit(80)


_ROSTER = """h as (select 'k' || c_custkey identity_key, c_name "name", c_mktsegment department, '' "position", case when c_custkey % 5 = 0 then 'former' else 'active' end status, '2024-01-01' first_seen, '2024-06-01' last_confirmed, case when c_custkey % 5 = 0 then '2024-05-01' else '' end former_since, c_custkey % 11 <> 0 ever from customer where c_custkey % 3 <> 0),
  a as (select 'k' || (c_custkey + case when c_custkey % 10 = 4 then 1000000 else 0 end) identity_key, c_name "name", 'new ' || c_mktsegment department, case when c_custkey % 4 = 0 then 'lead' else '' end "position" from customer where c_custkey % 2 = 0)"""


@query(f"""with {_ROSTER}, m as (select a.*, coalesce(h1.identity_key, h2.identity_key) was from a left join h h1 on a.identity_key = h1.identity_key left join h h2 on h1.identity_key is null and a."name" = h2."name"),
  j as (select m.identity_key ak, m."name" an, m.department ad, m."position" ap, h.* from m full join h on m.was = h.identity_key)
  select coalesce(ak, identity_key) identity_key, coalesce(an, "name") "name", coalesce(ad, department) department, coalesce(ap, "position") "position",
  case when ak is not null then 'active' when ever and status <> 'former' then 'former' else status end employment_status, coalesce(first_seen, '2024-07-01') first_seen, case when ak is not null then '2024-07-01' else last_confirmed end last_confirmed,
  case when ak is not null then '' when ever and status <> 'former' then '2024-07-01' else former_since end former_since, ak is not null or ever ever_authoritative, case when ak is not null and identity_key is not null then 'dir,old' when ak is not null then 'dir' else 'old' end sources from j""")
def roster_history_merge(spark: SparkSession, d: str) -> DataFrame:
    """A fresh snapshot over a history, both cut from customers; some keys are new for known names."""
    history, current = roster_tables(spark, d)
    none = current.limit(0)
    return N.merge_history(history, current, none, "2024-07-01", True).withColumn("sources", F.array_join("sources", ","))


def roster_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    former = F.col("c_custkey") % 5 == 0
    history = c.filter("c_custkey % 3 <> 0").select(
        F.concat(F.lit("k"), "c_custkey").alias("identity_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("department"), F.lit("").alias("position"), F.when(former, "former").otherwise("active").alias("employment_status"),
        F.lit("2024-01-01").alias("first_seen"), F.lit("2024-06-01").alias("last_confirmed"), F.when(former, "2024-05-01").otherwise("").alias("former_since"), (F.col("c_custkey") % 11 != 0).alias("ever_authoritative"), F.array(F.lit("old")).alias("sources"),
    )
    key = F.concat(F.lit("k"), (F.col("c_custkey") + F.when(F.col("c_custkey") % 10 == 4, 1_000_000).otherwise(0)).cast("string"))
    current = c.filter("c_custkey % 2 = 0").select(key.alias("identity_key"), F.col("c_name").alias("name"), F.concat(F.lit("new "), "c_mktsegment").alias("department"), F.when(F.col("c_custkey") % 4 == 0, "lead").otherwise("").alias("position"), F.lit("dir").alias("source"))
    return history, current


@query(f"""with {_ROSTER} select status employment_status, "name", department from h order by case status when 'active' then 0 when 'unverified' then 1 else 2 end, "name", department limit 500""")
def roster_order(spark: SparkSession, d: str) -> DataFrame:
    """The roster in order of status, name, department."""
    h, _ = roster_tables(spark, d)
    rank = F.when(F.col("employment_status") == "active", 0).when(F.col("employment_status") == "unverified", 1).otherwise(2)
    return h.orderBy(rank, "name", "department").limit(500).select("employment_status", "name", "department")


@query("select c_name \"name\", c_mktsegment, max(c_acctbal) best from customer where c_acctbal is not null group by 1, 2 having count(*) = 1")
def unique_names(spark: SparkSession, d: str) -> DataFrame:
    """A14 and J16's condition: names that stand once."""
    w = Window.partitionBy("c_name", "c_mktsegment")
    return table(spark, d, "customer").filter("c_acctbal is not null").withColumn("n", F.count("*").over(w)).filter("n = 1").select(F.col("c_name").alias("name"), "c_mktsegment", F.col("c_acctbal").alias("best"))


@query("with i as (select s_name, max_by(s_nationkey, s_suppkey) nation from supplier group by 1) select c_custkey, i.nation::int nation from customer join i on replace(c_name, 'Customer', 'Supplier') = i.s_name")
def attendee_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Attendees against identities, the last row of a name wins, unknown ones left out."""
    ids = table(spark, d, "supplier").groupBy("s_name").agg(F.max_by("s_nationkey", "s_suppkey").alias("nation"))
    return table(spark, d, "customer").withColumn("s_name", F.replace("c_name", F.lit("Customer"), F.lit("Supplier"))).join(ids, "s_name").select("c_custkey", "nation")


@query("select o_orderkey, c_name member from orders join customer on o_custkey = c_custkey where c_name not like '%9' and c_mktsegment is not null and (o_orderstatus is null or o_orderstatus <> 'F') and c_acctbal >= 0 and not c_name like 'X%'")
def members_join(spark: SparkSession, d: str) -> DataFrame:
    """A join with excluding predicates."""
    c = table(spark, d, "customer").filter(~F.col("c_name").like("%9") & F.col("c_mktsegment").isNotNull() & (F.col("c_acctbal") >= 0) & ~F.col("c_name").like("X%"))
    o = table(spark, d, "orders").filter(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != "F"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", F.col("c_name").alias("member"))
