"""Search over documents: an inverted index of tokens, scored and ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """ASCII words of three letters or more, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]{3,}"), F.lit(0))


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """How often each token stands in each document."""
    return docs.select(key, F.explode(tokens(F.col(text))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("tf"))


def distinctive(terms: DataFrame, generic: tuple[str, ...]) -> DataFrame:
    """Terms of two characters or more that aren't generic, in any case."""
    return terms.filter((F.length("term") >= 2) & ~F.lower("term").isin(*[g.lower() for g in generic])).distinct()


SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def found(terms: DataFrame, docs: DataFrame, key: str, text: str, top: int) -> DataFrame:
    """For each term the ``top`` documents by (most hits, key). Only the terms' tokens are counted."""
    asked = small(terms.select(F.lower("term").alias("token"), "term").distinct())
    spoken = docs.select(key, F.explode(tokens(F.col(text))).alias("token"))
    hit = spoken.join(asked, "token").groupBy("term", key).agg(F.count("*").alias("tf"))
    w = Window.partitionBy("term").orderBy(F.col("tf").desc(), key)
    return hit.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("term", key, "tf", "rank")


def substring_hits(terms: DataFrame, docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Terms (ASCII letters, ``n`` or more) that stand anywhere in a text, in any case. A term without
    other characters lies within one word, so terms meet the distinct words of all texts, by the runs of ``n``
    letters that a word has, and then the texts that have these words."""
    spoken = docs.select(key, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"[a-z]{{{n},}}"), F.lit(0)))).alias("word"))
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - n + 1), lambda i: F.substring(F.col("word"), i, F.lit(n))))
    asked = terms.filter(F.col("term").rlike(f"^[A-Za-z]{{{n},}}$")).select("term", F.lower("term").alias("l")).withColumn("run", F.substring("l", 1, n))
    met = spoken.select("word").distinct().select("word", F.explode(runs).alias("run")).join(asked, "run").filter(F.expr("contains(word, l)")).select("term", "word")
    return spoken.join(met, "word").select("term", key).distinct()


def matched(terms: DataFrame, notes: DataFrame, since: Column, most: int = 25) -> DataFrame:
    """Notes (key, day, title, text) from ``since`` on that hold a term as a token, in the title or the text: the newest ``most`` of
    each term by (day, key), with whether the term stands in the title."""
    asked = small(terms.select(F.lower("term").alias("token")).distinct())
    spoken = lambda c, title: notes.filter(F.col("day") >= since).select("key", "day", F.explode(F.array_distinct(tokens(F.col(c)))).alias("token"), F.lit(title).alias("in_title"))
    hit = spoken("title", True).union(spoken("text", False)).join(asked, "token").groupBy("token", "key", "day").agg(F.max("in_title").alias("in_title"))
    w = Window.partitionBy("token").orderBy(F.desc("day"), F.desc("key"))
    return hit.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def related(terms: DataFrame, notes: DataFrame, top: int, least: float = 2.0, since: Column | None = None, most: int = 25, generic: tuple[str, ...] = ()) -> DataFrame:
    """The distinctive terms (P11) with the newest notes of each (J12); a note's score is the sum over its terms of 3 for one in the
    title, else 1 (A9); the ``top`` by (score, day, key) of those that reach ``least`` (T3)."""
    hit = matched(distinctive(terms, generic), notes, F.lit("") if since is None else since, most)
    points = F.sum(F.when(F.col("in_title"), 3).otherwise(1))
    return hit.groupBy("key", "day").agg(points.alias("score")).filter(F.col("score") >= least).orderBy(F.desc("score"), F.desc("day"), F.desc("key")).limit(top)


def masked(own: Column, items: Column, keywords: Column, most: int, other: int) -> tuple[Column, Column]:
    """Free-text items for the own team only, keywords for all, both capped."""
    return F.when(own, F.slice(items, 1, most)).otherwise(F.array().cast("array<string>")), F.slice(keywords, 1, other)
