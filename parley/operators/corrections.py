"""Correction patches: which are accepted, and how the accepted ones are applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

CATEGORIES = ("person_name", "proper_noun", "organization", "acronym")
SUFFIXES = ("님께서", "님한테", "님하고", "님에게", "님으로", "님이", "님은", "님을", "님의", "님께", "님", "씨", "한테", "에게", "께", "으로", "은", "는", "이", "가", "을", "를", "과", "와", "로", "도", "만", "의", "에", "건", "야", "라")
LINE = r"^\[\d{2}:\d{2}:\d{2} - \d{2}:\d{2}:\d{2}\] [^:]+: "
MIN_CONFIDENCE, MAX_CHARS, MAX_TOKENS, MAX_SHARE, MAX_EDIT, MIN_COUNT = 0.92, 60, 4, 0.4, 0.05, 5


def decided(patches: DataFrame, lines: DataFrame, ledger: DataFrame, roster: DataFrame, attendees: DataFrame) -> DataFrame:
    """E5: ``patches`` (schemas.PATCHES) with accepted, reason, start, end. The first rule that fails is the
    reason; evidence is the longest ledger variant (with a particle) or a likeness of names."""
    at = patches.join(lines.select("doc", (F.col("line_no") + 1).alias("line"), F.col("line").alias("raw")), ["doc", "line"], "left")
    b, a = F.col("before"), F.col("after")
    body = F.regexp_replace("raw", LINE, "")
    ends = F.array(*(F.lit(s) for s in ("", *SUFFIXES)))
    cuts = at.select("before").distinct().withColumn("suffix", F.explode(F.filter(ends, lambda s: F.col("before").endswith(s)))).withColumn("variant", F.expr("substring(before, 1, length(before) - length(suffix))"))
    longest = cuts.join(ledger.select("variant").distinct(), "variant").groupBy("before").agg(F.max_by(F.struct("variant", "suffix"), F.length("variant")).alias("cut"))
    people = roster.select("name").distinct().withColumn("person", F.lit(True))
    maps = longest.select("before", "cut.variant", "cut.suffix").join(ledger, "variant").withColumn("base", T.target_base(F.col("target"))).join(people.withColumnRenamed("name", "base"), "base", "left").withColumn("person", F.coalesce("person", F.lit(False)))
    expected = maps.select("before", F.when(F.col("person"), F.concat("base", "suffix")).otherwise(F.concat("target", "suffix")).alias("after"), "person", "count")
    good = expected.filter(~F.col("person") | (F.col("count") >= MIN_COUNT)).select("before", "after", F.when(F.col("person"), "person_name").otherwise("other").alias("kind")).distinct().withColumn("in_ledger", F.lit(True))
    x = at.withColumn("kind", F.when(F.col("category") == "person_name", "person_name").otherwise("other")).join(good, ["before", "after", "kind"], "left")
    known = people.select(F.col("name").alias("after_base"), "person").join(attendees.select(F.col("name").alias("after_base"), F.lit(True).alias("here")), "after_base", "left")
    x = x.withColumn("after_base", T.strip_honorific(a)).join(known, "after_base", "left")
    bb = T.strip_honorific(b)
    like = F.greatest(T.jamo_similarity(bb, F.col("after_base")), T.jamo_similarity(bb, T.given_name(F.col("after_base"))))
    honest = (T.honorific(b) == "") | (T.honorific(b) == T.honorific(a))
    by_name = (F.col("category") == "person_name") & F.coalesce("person", F.lit(False)) & bb.rlike("^[가-힣]{2,5}$") & honest & (like >= F.when(F.coalesce("here", F.lit(False)), 0.72).otherwise(0.86))
    acronym = F.regexp_extract(b, rf"^([A-Za-z][A-Za-z0-9_-]{{1,10}})(?:{'|'.join(SUFFIXES)})?$", 1)
    kept = F.regexp_replace(F.lower(a), "[^a-z0-9]+", " ")
    expands = (acronym != "") & F.expr("true") & F.concat(F.lit(" "), kept, F.lit(" ")).contains(F.concat(F.lit(" "), F.regexp_replace(F.lower(acronym), "[^a-z0-9]+", " "), F.lit(" ")))
    blank = F.coalesce(b, F.lit("")).eqNullSafe("") | F.coalesce(a, F.lit("")).eqNullSafe("")
    count = (F.length(body) - F.length(F.replace(body, b, F.lit("")))) / F.greatest(F.length(b), F.lit(1))
    rules: list[tuple[Column, str]] = [
        (F.col("raw").isNull(), "invalid line number"),
        (~F.col("raw").rlike(LINE), "target line is not a transcript utterance"),
        (blank, "before/after must be non-empty strings"),
        (~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)), "category is not auto-applicable"),
        (~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)), "confidence must be between 0 and 1"),
        (F.col("confidence") < MIN_CONFIDENCE, "confidence below threshold"),
        (b == a, "before and after are identical"),
        (expands, "already-canonical acronym expansion"),
        (a.startswith(F.concat(b, F.lit("("))), "already-canonical term expansion"),
        (F.concat(b, a).rlike(r"[\r\n\[\]]"), "patch contains structural characters"),
        ((F.length(b) > MAX_CHARS) | (F.length(a) > MAX_CHARS), "patch exceeds lexical size limit"),
        ((F.size(T.words(b)) > MAX_TOKENS) | (F.size(T.words(a)) > MAX_TOKENS), "patch looks like sentence rewriting"),
        (T.protected(b) != T.protected(a), "protected number/negation/commitment token changed"),
        (count != 1, "before must occur exactly once in the target utterance"),
        (F.length(b) / F.greatest(F.length(body), F.lit(1)) > MAX_SHARE, "patch rewrites too much of one utterance"),
        (~(F.coalesce("in_ledger", F.lit(False)) | by_name), "no deterministic ledger/roster evidence"),
    ]
    reason = F.lit("accepted")
    for broken, name in reversed(rules):
        reason = F.when(broken, name).otherwise(reason)
    start = F.length("raw") - F.length(body) + F.position(b, body) - 1
    out = x.withColumn("reason", reason).withColumn("accepted", F.col("reason") == "accepted")
    return out.select(*patches.columns, "accepted", "reason", F.when(F.col("accepted"), start).alias("start"), F.when(F.col("accepted"), start + F.length(b)).alias("end"))


def budgeted(decisions: DataFrame, sizes: DataFrame, most: float = MAX_EDIT) -> DataFrame:
    """Accepted patches in proposal order; one that overlaps a kept one of its line, or with which the
    changed part of the text (sizes: doc, chars) passes ``most``, is left out and uses no budget.
    A fold over each document's patches."""
    kind = "array<struct<patch_idx:int,line:int,start:int,end:int>>"
    p = decisions.filter("accepted").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("patch_idx", "line", "start", "end"))).cast(kind).alias("patches")).join(sizes, "doc")

    def step(acc: Column, x: Column) -> Column:
        clash = F.exists(acc["kept"], lambda k: (k["line"] == x["line"]) & (k["start"] < x["end"]) & (x["start"] < k["end"]))
        used = acc["used"] + x["end"] - x["start"]
        fits = ~clash & (used / F.greatest(acc["chars"], F.lit(1)) <= most)
        return F.struct(F.when(fits, used).otherwise(acc["used"]).alias("used"), acc["chars"].alias("chars"), F.when(fits, F.concat(acc["kept"], F.array(x))).otherwise(acc["kept"]).alias("kept"))

    first = F.struct(F.lit(0).alias("used"), F.col("chars").cast("int").alias("chars"), F.array().cast(kind).alias("kept"))
    return p.select("doc", F.aggregate("patches", first, step).alias("r")).select("doc", "r.used", F.explode("r.kept").alias("k")).select("doc", "used", "k.*")


def applied(lines: DataFrame, kept: DataFrame) -> DataFrame:
    """Lines (doc, line_no, line) with the kept patches (doc, line, start, end, after) put in, from right to left."""
    edits = kept.groupBy("doc", (F.col("line") - 1).alias("line_no")).agg(F.sort_array(F.collect_list(F.struct("start", "end", "after")), asc=False).alias("edits"))
    put = lambda acc, e: F.concat(F.substring(acc, F.lit(1), e["start"]), e["after"], F.substring(acc, e["end"] + 1, F.length(acc)))
    return lines.join(edits, ["doc", "line_no"], "left").select("doc", "line_no", F.when(F.col("edits").isNull(), F.col("line")).otherwise(F.aggregate("edits", F.col("line"), put)).alias("line"))
