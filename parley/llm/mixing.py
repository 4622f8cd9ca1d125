"""Operator 9, mixing sources to target weights [native]: Efraimidis-Spirakis sampling.

Sizes are words. Each source's target is its weight's share of all sizes, stopped at ``cap`` times
the source's size, with the excess dealt again to the others by weight. A source first gives its
complete epochs (target // size), then a fraction of an epoch: every document draws the key
-ln(u) / w, an exponential whose rate is its quality weight, and documents are taken by ascending
key while the running total of their sizes stays within the rest of the budget. One further document
of the source, the one whose size is nearest to what is then left, closes the gap if that brings the
total nearer. ``u`` is a hash of doc_id and text, so that reruns agree.

No source is one task's work, whatever part of the rows it holds: the running total is taken over
about sqrt(rows) key buckets for each source, and only the bucket in which the budget ends, again
about sqrt(rows) documents, is sorted. What is left of that is one cut (key, doc_id, hash) for each
source, against which every row decides by itself.

Defined results: null text: size 0. Null source: a source of its own, last in order. Size 0: taken
0. All sizes 0 or no rows: targets 0. Null doc_id: an ordinary value, below all others in ties.
Rows equal in source, doc_id and text are taken or left together. Extra columns are left out of the
digest and kept by ``sample``; names never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, fresh, joined, range_ranks, scratch, store

SYMBOLS = r"[#*$%&|<>{}\[\]=~^_\\]"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """In (0.1, 1]: 1 for texts without symbols, falling with symbols per word."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)) / F.greatest(size, F.lit(1))
    return F.lit(0.1) + F.lit(0.9) / (F.lit(1.0) + F.lit(8.0) * symbols)


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def _drawn(text: Column, doc_id: Column, source: Column, seed: int) -> dict[str, Column]:
    """The columns by which a row is drawn: all are functions of the row alone."""
    size = size_of(text)
    digest = F.xxhash64(text, F.lit(seed))
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, digest, F.lit(seed)), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return {"skey": _source_key(source), "size": size, "digest": digest, "id": F.coalesce(doc_id, F.lit(-(2**63))), "key": -F.log(u) / quality_weight(text, size)}


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int, share: float) -> DataFrame:
    """``sources`` (skey, source, source_size, rows) with rank, weight and target."""
    ranked = range_ranks(sources, [F.col("source").asc_nulls_last()], "rank")
    kinds = F.array(*(F.lit(float(w)) for w in weights))
    ranked = store(ranked.withColumn("weight", F.element_at(kinds, (F.col("rank") % len(weights) + 1).cast("int"))), "sources")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    most = F.col("source_size") * F.lit(float(cap))
    level, stopped = 0.0, -1
    while True:  # the level only rises; ends when no further source is stopped
        below = most < F.col("weight") * F.lit(level)
        fixed, free, n = ranked.agg(F.coalesce(F.sum(F.when(below, most)), F.lit(0.0)), F.coalesce(F.sum(F.when(~below, F.col("weight"))), F.lit(0.0)), F.count_if(below)).first()
        if not free or n == stopped:
            break
        level, stopped = max(0.0, (total - fixed) / free), n
    return ranked.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def cuts(drawn: DataFrame, weights: tuple[int, ...], cap: int, share: float) -> tuple[DataFrame, int]:
    """For each source its size, target, epochs, the last (key, id, digest) of the fraction and
    that of the closing document; and the number of sources."""
    sources = store(drawn.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows")), "source-sizes")
    goal = targets(sources, weights, cap, share)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("buckets", F.ceil(F.sqrt("rows")))
    goal = store(goal, "goals")
    n = goal.count()
    place = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("buckets")).cast("long")
    dealt = joined(drawn, goal.select("skey", "rest", "buckets"), ["skey"], n).withColumn("bucket", place)
    per = dealt.groupBy("skey", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("below", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    last = store(per.filter((F.col("below") <= F.col("rest")) & (F.col("below") + F.col("words") > F.col("rest"))).groupBy("skey").agg(F.min_by(F.struct("bucket", "below"), "bucket").alias("edge")).select("skey", "edge.bucket", "edge.below"), "edges")
    edge = joined(dealt, last, ["skey", "bucket"], n).groupBy("skey", "key", "id", "digest").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("below").alias("below"))
    order = Window.partitionBy("skey").orderBy("key", "id", "digest").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("below") + F.sum("words").over(order)
    taken = edge.withColumn("upto", upto).filter(F.col("upto") <= F.col("rest")).groupBy("skey").agg(F.max(F.struct("key", "id", "digest")).alias("cut"), F.max("upto").alias("upto"))
    last = last.join(taken, "skey", "left").join(goal.select("skey", "rest", "buckets"), "skey")
    last = store(last.select("skey", "buckets", F.col("bucket").alias("edge"), "cut", (F.col("rest") - F.coalesce("upto", "below")).alias("gap")), "fractions")
    off = F.abs(F.col("size") - F.col("gap"))
    left = joined(drawn, last, ["skey"], n).filter(~F.coalesce(_under(), F.lit(False)) & (off < F.col("gap")))
    closing = left.groupBy("skey").agg(F.min(F.struct(off.alias("off"), "key", "id", "digest")).alias("best"))
    last = last.join(closing, "skey", "left").select("skey", "edge", "cut", F.struct("best.key", "best.id", "best.digest").alias("closing"))
    return store(goal.join(last, "skey", "left").drop("rank", "rest", "rows"), "cuts"), n


def _under() -> Column:
    place = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("buckets")).cast("long")
    before = (place < F.col("edge")) | ((place == F.col("edge")) & (F.struct("key", "id", "digest") <= F.col("cut")))
    return before & (F.col("size") > 0)  # rows without words come with the epochs alone


def _times(edge_of: DataFrame) -> DataFrame:
    """``times``: how often the mix takes the row."""
    taken = F.coalesce(_under(), F.lit(False)) | F.coalesce(F.struct("key", "id", "digest") == F.col("closing"), F.lit(False))
    return edge_of.withColumn("times", F.col("epochs") + F.when(taken, 1).otherwise(0))


def mix(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0, seed: int = 9) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, epochs, times, taken (words)."""
    with scratch(df.sparkSession):
        return _mixed(documents(df, "source"), weights, cap, share, seed)


def _mixed(docs: DataFrame, weights: tuple[int, ...], cap: int, share: float, seed: int) -> DataFrame:
    drawn = store(docs.select("doc_id", "source", *(c.alias(k) for k, c in _drawn(F.col("text"), F.col("doc_id"), F.col("source"), seed).items())), "drawn")
    cut, n = cuts(drawn, weights, cap, share)
    out = _times(joined(drawn, cut.drop("source"), ["skey"], n))
    out = out.select("doc_id", "source", "size", "source_size", F.col("target").cast("double"), "epochs", "times", (F.col("times") * F.col("size")).cast("long").alias("taken"))
    return store(out, "mixed", keep=True)


def sample(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, share: float = 1.0, seed: int = 9) -> DataFrame:
    """The mixed corpus: the rows of ``df`` with all their columns, each as often as it is taken."""
    row, made = fresh(df, "_row"), ["skey", "size", "digest", "id", "key"]
    whole = df.select(F.struct(*df.columns).alias(row))
    at = lambda c, kind: F.col(f"{row}.{c}").cast(kind)
    marks = _drawn(at("text", "string"), at("doc_id", "long"), at("source", "string"), seed)
    with scratch(df.sparkSession):
        drawn = store(whole.select(at("source", "string").alias("source"), *(marks[k].alias(k) for k in made)), "drawn")
        cut, n = cuts(drawn, weights, cap, share)
        cut = store(cut, "cuts", keep=True)
    full = whole.select(row, *(marks[k].alias(k) for k in made))
    timed = _times(joined(full, cut.drop("source"), ["skey"], n)).filter("times > 0")
    return timed.select(row, F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(f"{row}.*")
