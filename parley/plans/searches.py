"""Queries of search, over documents, benchmark passages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index as I
from ..operators import search as S
from ..operators import terms as M
from .base import query, table

GENERIC = ("the", "and", "for")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    """All tokens of five letters or more of the benchmark passages."""
    t = table(spark, d, "benchmark").select(F.explode(S.tokens(F.col("text"))).alias("term"))
    return t.filter(F.length("term") >= 5).distinct()


_DO = "terms as (select distinct token term from (select unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) token from benchmark) where length(token) >= 5)"
_FIRST = "tk as (select item_id, unnest(r) token, unnest(range(len(r))) pos from (select item_id, regexp_extract_all(lower(text), '[a-z]{3,}') r from benchmark)), ft as (select item_id, token, min(pos) pos from tk where length(token) >= 5 group by 1, 2)"
_IDX = "idx as (select doc_id, token, count(*)::bigint tf from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) token from documents) group by 1, 2)"


@query(f"with {_FIRST} select item_id, token term, n::int rank from (select *, row_number() over (partition by item_id order by pos) n from ft) where n <= 10")
def search_terms(spark: SparkSession, d: str) -> DataFrame:
    """What is searched for a passage: the first ten of its terms, in order."""
    w = F.slice(F.filter(F.array_distinct(S.tokens(F.col("text"))), lambda w: F.length(w) >= 5), 1, 10)
    return table(spark, d, "benchmark").select("item_id", F.posexplode(w).alias("rank", "term")).withColumn("rank", F.col("rank") + 1)


@query(f"with {_IDX} select token, sum(tf)::bigint hits, count(*)::bigint docs from idx group by 1")
def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    """J10's index, summed by token."""
    return S.postings(table(spark, d, "documents"), "doc_id", "text").groupBy("token").agg(F.sum("tf").alias("hits"), F.count("*").alias("docs"))


@query(f"with {_DO}, {_IDX} select term, doc_id, tf, rank::int rank from (select term, doc_id, tf, row_number() over (partition by term order by tf desc, doc_id) rank from idx join terms on token = term) where rank <= 5")
def evidence_search(spark: SparkSession, d: str) -> DataFrame:
    """The five documents of most hits for each term."""
    return S.found(S.distinctive(_terms(spark, d), GENERIC), table(spark, d, "documents"), "doc_id", "text", 5)


@query(f"""with {_FIRST}, q as (select item_id, token from (select *, row_number() over (partition by item_id order by pos) n from ft) where n <= 10), {_IDX}, l as (select doc_id, sum(tf) len from idx group by 1), m as (select count(*) n, avg(len) mean from l), f as (select token, count(*) df from idx group by 1),
  s as (select item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) score from q join f using (token) join idx using (token) join l using (doc_id), m group by 1, 2)
  select item_id, doc_id, score, rank::int rank from (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from s) where rank <= 5""")
def stored_evidence(spark: SparkSession, d: str) -> DataFrame:
    """E12 with J10 stored: the five best documents for the first ten terms of each passage, from blocks of postings."""
    from .files import scratch_folder

    stored = I.write(table(spark, d, "documents"), "doc_id", "text", scratch_folder(spark, "index"), buckets=16)
    found = I.search(spark, stored, search_terms(spark, d).select(F.col("item_id").alias("query"), "term"), 5)
    return found.select(F.col("query").alias("item_id"), F.col("key").alias("doc_id"), "score", "rank")


@query(f"with {_DO} select term, doc_id from terms, documents where contains(regexp_replace(lower(text), '[^ -~]', '?', 'g'), term)")
def substring_search(spark: SparkSession, d: str) -> DataFrame:
    """Terms anywhere in a text."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.lower("text"), "[^ -~]", "?").alias("text"))
    return S.substring_hits(_terms(spark, d), docs, "doc_id", "text", 5)


@query(f"""with {_DO}, n as (select doc_id::varchar "key", n_chars::varchar "day", source title, text from documents where n_chars::varchar >= '3'), h as (select "key", "day", token, bool_or(t) in_title from (select "key", "day", unnest(regexp_extract_all(lower(title), '[a-z]{{3,}}')) token, true t from n union all select "key", "day", unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')), false from n) join terms on token = term where token not in ('the', 'and', 'for') group by 1, 2, 3),
  r as (select *, row_number() over (partition by token order by "day" desc, "key" desc) rank from h) select "key", "day", sum(case when in_title then 3 else 1 end)::bigint score from r where rank <= 25 group by 1, 2 having sum(case when in_title then 3 else 1 end) >= 2 order by 3 desc, 2 desc, 1 desc limit 50""")
def related_doc_score(spark: SparkSession, d: str) -> DataFrame:
    """P11, J12 with its date cut and newest 25 of each term, A9 and T3, over documents and the terms of the benchmark."""
    n = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("n_chars").cast("string").alias("day"), F.col("source").alias("title"), "text")
    return S.related(_terms(spark, d), n, 50, since=F.lit("3"), generic=GENERIC)


@query("""select doc_id, source = 'src0' own, case when source = 'src0' then len(list_filter(string_split(text, chr(10)), lambda x: x <> '')[1:6])::int else 0 end items, len(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))[1:8])::int keywords from documents""")
def masking_projection(spark: SparkSession, d: str) -> DataFrame:
    """Lines of own documents, keywords of all."""
    docs = table(spark, d, "documents")
    items, words = S.masked(F.col("source") == "src0", F.filter(F.split("text", "\n"), lambda x: x != ""), F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))), 6, 8)
    return docs.select("doc_id", (F.col("source") == "src0").alias("own"), F.size(items).alias("items"), F.size(words).alias("keywords"))


@query("""with w as (select item_id, array_to_string(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> ''), ' ') phrase from benchmark), t as (select doc_id, ' ' || array_to_string(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> ''), ' ') || ' ' flat from documents)
  select doc_id, item_id from t, w where contains(flat, ' ' || phrase || ' ')""")
def token_phrase_presence(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark passage as neighbouring whole tokens: one automaton of all passages runs over each text."""
    from ..functions import text as T

    return M.phrases(table(spark, d, "documents"), "doc_id", T.collapsed(F.col("text")), table(spark, d, "benchmark"), "item_id", T.collapsed(F.col("text")))
