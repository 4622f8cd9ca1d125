"""Operator 10, personal data [native]: base patterns and bootstrapped contextual extraction.

Base kinds are found by regular expressions, leftmost and without overlap within a kind; matches
that fail their test are dropped. The expressions are the plain ones given for each kind, with
possessive repeats and a look back that only skip starts at which the plain one must fail too, so
that no text makes them slow or deep.

These entities are seeds, and so are credentials of plain form (kind ``key``). The two words before a seed are a lexical pattern; so are those before any other
identifier-like token. Patterns that stand before ``MIN_SEEDS`` distinct known words or more form a bipartite graph with
the instances that they extract, scored in rounds: a pattern by the mean confidence of its instances,
an instance by the noisy-or of its patterns. Tokens of confidence ``SURE`` in a pattern of that
confidence are further spans, of kind ``id``. Known words are the seeds, and then such tokens too, wherever they
stand: patterns are admitted and scored anew until no new one appears. Only built-in functions run; the graph is aggregated
by pattern and instance before it is joined, so no frequent pattern gathers rows.

Positions count code points, ends are exclusive. Defined results: null text is empty, without spans. Null doc_id is
an ordinary value. Rows that repeat doc_id and text get the same result each. Extra columns are left
out of the digest and kept by ``redact``. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, fresh, joined, scratch, store

# The expressions of the base kinds, in the order in which kinds are listed.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
KINDS = ("email", "ip", "card", "phone")
# Credentials, which are seeds beside the base kinds: access keys of a known form, and what is assigned to such a name.
KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?<=(?i:password|passwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\"']?)(?=[A-Za-z._/@+-]*+[0-9])[A-Za-z0-9._/@+-]{8,}+"
CUE = r"AKIA|(?i:password|passwd|secret|token|api_?key)\s{0,3}[=:]"
#: An identifier-like token: a run of these characters that holds a digit.
TOKEN = r"(?<![A-Za-z0-9._/@+-])(?=[A-Za-z._/@+-]*+[0-9])[A-Za-z0-9._/@+-]++"
MIN_SEEDS, SURE, ROUNDS = 5, 0.7, 3

#: Characters in which the last two words are looked for first, and matches that are placed one after another.
NEAR, BLOCK = 80, 256

_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,word:string,left:string>>"
_BLOCKS = "array<struct<steps:array<struct<gap:int,len:int,tail:string,word:string>>,tail:string,base:int>>"


def _matches(text: Column, pattern: str, if_any: Column) -> Column:
    return F.when(if_any, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tail(text: Column) -> Column:
    """The last two words of ``text``, whatever their length, from the white space before them on; all of it where it
    has no more. The tail of texts one after another is that of their tails."""
    last = r"\s\S++\s++\S++\s*+\z"
    near = F.regexp_extract(F.right(text, F.lit(NEAR)), last, 0)
    far = F.regexp_extract(text, last, 0)
    return F.when(F.length(text) <= NEAR, text).when(near != "", near).when(far != "", far).otherwise(text)


def _located(text: Column, pattern: str, matches: Column, kind: str, rank: int) -> Column:
    """Spans of ``matches``: the same expression splits the text, and the lengths of what lies
    between add up. They are added in blocks, since appending to one long array would take time in
    the square of its length. ``left`` is the tail of what stands before."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"), _tail(g).alias("tail"), m.alias("word")))

    def step(acc: Column, x: Column) -> Column:
        begin, left = acc["at"] + x["gap"], _tail(F.concat(acc["tail"], x["tail"]))
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (begin + x["len"]).alias("end"), x["word"].alias("word"), left.alias("left"))
        return F.struct((begin + x["len"]).alias("at"), F.concat(left, x["word"]).alias("tail"), F.concat(acc["out"], F.array(span)).alias("out"))

    def block(x: Column) -> Column:
        first = F.struct(x["base"].alias("at"), x["tail"].alias("tail"), F.array().cast(_SPAN).alias("out"))
        return F.aggregate(x["steps"], first, step, lambda acc: acc["out"])

    def whole(s: Column) -> Column:
        def add(acc: Column, steps: Column) -> Column:
            size = F.aggregate(steps, F.lit(0), lambda n, y: n + y["gap"] + y["len"])
            tail = F.aggregate(steps, acc["tail"], lambda t, y: _tail(F.concat(t, y["tail"], y["word"])))
            based = F.struct(steps.alias("steps"), acc["tail"].alias("tail"), acc["at"].alias("base"))
            return F.struct((acc["at"] + size).alias("at"), F.when(F.size(steps) < BLOCK, "").otherwise(tail).alias("tail"), F.concat(acc["out"], F.array(based)).alias("out"))

        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda i: F.slice(s, i * BLOCK + 1, F.lit(BLOCK)))
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(_BLOCKS).alias("out"))
        return F.flatten(F.transform(F.aggregate(blocks, start, add, lambda acc: acc["out"]), block))

    return F.when(F.size(matches) > 0, _let(steps, whole)).otherwise(F.array().cast(_SPAN))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


_TESTS = {
    "email": lambda w: F.lit(True),
    "ip": lambda w: w.rlike(rf"\A{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}\z"),
    "card": lambda w: F.when(F.length(_digits(w)).between(12, 19), luhn(_digits(w))).otherwise(F.lit(False)),
    "phone": lambda w: F.length(_digits(w)).between(9, 15),
}
#: The expression of each kind, and a character that its matches hold; none: a digit.
_FIND = {"email": (EMAIL, "@"), "ip": (IP, None), "card": (CARD, None), "phone": (PHONE, "+")}


def _passes(kind: str) -> Callable[[Column], Column]:
    return lambda x: _TESTS[kind](x["word"])


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def with_base(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the array ``name`` of base spans of the column ``text``, by start, then kind."""
    held = {k: fresh(df, f"_m_{k}") for k in KINDS}
    digit = F.col("_digit")
    df = df.withColumn("_digit", F.col(text).rlike("[0-9]"))  # most texts have none, and are left at once
    df = df.withColumns({held[k]: _matches(F.col(text), p, F.col(text).contains(c) if c else digit) for k, (p, c) in _FIND.items()})
    found = [F.filter(_located(F.col(text), _FIND[k][0], F.col(held[k]), k, i), _passes(k)) for i, k in enumerate(KINDS)]
    return df.withColumn(name, F.array_sort(F.concat(*found))).drop("_digit", *held.values())


def with_seeds(df: DataFrame, text: str, base: str, name: str) -> DataFrame:
    """``df`` with the array ``name``: the spans of ``base``, and the credentials (kind ``key``) apart from these."""
    keys = _located(F.col(text), KEY, F.col("_keys"), "key", len(KINDS))
    apart = F.filter(keys, lambda x: ~F.exists(F.col(base), lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])))
    df = df.withColumn("_keys", _matches(F.col(text), KEY, F.col(text).rlike("[0-9]") & F.col(text).rlike(CUE)))  # most texts have no digit, and are left at once
    return df.withColumn(name, F.when(F.size("_keys") > 0, F.array_sort(F.concat(base, apart))).otherwise(F.col(base))).drop("_keys")


def _context(left: Column) -> Column:
    """The last two words of ``left``, in lower case, digits as 0; empty where there are none."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(left), "[0-9]", "0"), r"\s+", " "))
    return F.regexp_extract(words, r"(?<!\S)(?:\S++ )?+\S++\z", 0)


def occurrences(df: DataFrame, base: str) -> DataFrame:
    """One row per seed and per other identifier-like token of ``df`` (doc_id, text, digest
    and the array ``base`` of seeds): doc_id, digest, start, end, word, seed, context."""
    tokens = df.withColumn("_tokens", _matches(F.col("text"), TOKEN, F.col("text").rlike("[0-9]")))
    spans = _located(F.col("text"), TOKEN, F.col("_tokens"), "id", len(KINDS) + 1)

    def apart(x: Column) -> Column:
        return ~F.exists(F.col(base), lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))

    every = tokens.select("doc_id", "digest", F.concat(F.col(base), F.filter(spans, apart)).alias("spans"))
    # a condition on the size of the array, which explode() would bring along, is moved down and makes all spans once more at each step
    each = every.select("doc_id", "digest", F.explode_outer("spans").alias("x")).filter("x is not null")
    out = each.select("doc_id", "digest", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.col("x.word").alias("word"), (F.col("x.kind") != "id").alias("seed"), _context(F.col("x.left")).alias("context"))
    return out.filter("context <> ''")


def discovered(found: DataFrame, min_seeds: int = MIN_SEEDS, sure: float = SURE, rounds: int = ROUNDS) -> DataFrame:
    """The occurrences that confident patterns extract and that aren't seeds: doc_id, digest, start, end."""
    edges = store(found.groupBy("context", "word").agg(F.max("seed").alias("seed")), "edges")
    # a word may be a seed in one place only; what it is known with grows from step to step
    held = edges.withColumn("sure", F.col("seed").cast("double"))
    good, n = None, 0
    while True:
        support = held.groupBy("context").agg(F.count_if(F.col("sure") >= sure).alias("known"), F.count_if("seed").alias("seeds"), F.count("*").alias("n"))
        live = store(support.filter((F.col("known") >= min_seeds) & (F.col("n") > F.col("seeds"))).select("context"), "patterns")
        before, n = n, live.count()
        if n == before:  # patterns are only added: scores rise with what is known
            break
        graph = store(joined(held, live, ["context"], n), "graph")
        for _ in range(rounds):
            score = graph.groupBy("context").agg((F.sum("sure") / (F.count("*") + 1)).alias("score"))
            known = joined(graph, score, ["context"], n)
            belief = known.filter("not seed").groupBy("word").agg((1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("belief"))
            scored = known.join(belief, "word", "left").withColumn("sure", F.when(F.col("seed"), 1.0).otherwise(F.greatest("sure", F.coalesce("belief", F.lit(0.0)))))
            scored = store(scored.drop("belief"), "graph")
            graph = scored.drop("score")
        good = store(scored.filter((F.col("score") >= sure) & (F.col("sure") >= sure) & ~F.col("seed")).select("context", "word", "sure"), "extractions")
        words = store(good.groupBy("word").agg(F.max("sure").alias("belief")), "known")
        if not (m := words.count()):
            break
        held = joined(edges, words, ["word"], m, "left").withColumn("sure", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))).drop("belief")
    if good is None:
        return found.filter("false").select("doc_id", "digest", "start", "end")
    good = good.select("context", "word")
    return joined(found.filter("not seed"), good, ["context", "word"], good.count()).select("doc_id", "digest", "start", "end")


def _with_spans(docs: DataFrame, min_seeds: int, sure: float) -> DataFrame:
    """``docs`` (doc_id, text, digest, base, seeds and anything else) with ``spans``: seeds and discovered."""
    with scratch(docs.sparkSession):
        more = _found(docs, min_seeds, sure)
    n = more.count()
    if not n:
        return docs.withColumn("spans", F.col("seeds"))
    more = more.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "more")
    same = docs["doc_id"].eqNullSafe(more["_id"]) & (docs["digest"] == more["_digest"])
    both = docs.join(F.broadcast(more) if n <= 100_000 else more, same, "left").drop("_id", "_digest")
    return both.withColumn("spans", F.array_sort(F.concat("seeds", F.coalesce("more", F.array().cast(_SPAN))))).drop("more")


def _found(docs: DataFrame, min_seeds: int, sure: float) -> DataFrame:
    """Per document with discovered spans: doc_id, digest and ``more``, those spans."""
    found = store(occurrences(docs, "seeds"), "occurrences")
    more = discovered(found, min_seeds, sure)
    span = F.struct(F.col("start").cast("int").alias("start"), F.lit(len(KINDS) + 1).alias("rank"), F.lit("id").alias("kind"), F.col("end").cast("int").alias("end"), F.lit("").alias("word"), F.lit("").alias("left"))
    return store(more.groupBy("doc_id", "digest").agg(F.collect_set(span).alias("more")), "discovered", keep=True)


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _prepared(df: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return with_seeds(with_base(df.withColumn("text", text).withColumn("digest", F.xxhash64("text")), "text", "base"), "text", "base", "seeds")


def extract(df: DataFrame, min_seeds: int = MIN_SEEDS, sure: float = SURE) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, base_sha256, spans (kind:start:end, ...), n_spans."""
    out = _with_spans(_prepared(documents(df)), min_seeds, sure)
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(df: DataFrame, min_seeds: int = MIN_SEEDS, sure: float = SURE) -> DataFrame:
    """``df``, all columns, with each span of its text replaced by <KIND>, and n_chars, if there is
    such a column, the new text's length. Null texts stay null. Of spans that overlap the first
    one's tag stands for all that they cover."""
    row = fresh(df, "_row")
    held = df.select(F.struct(*df.columns).alias(row), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = _with_spans(_prepared(held), min_seeds, sure)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        kept = F.substring(F.col("text"), acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        tag = F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        parts = F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(kept, tag))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), parts.alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    text = F.when(F.col(f"{row}.text").isNull(), F.lit(None).cast("string")).when(F.size("spans") > 0, F.aggregate("spans", start, step, rest)).otherwise(F.col("text"))
    out = out.withColumn("masked", text)
    kind = dict(df.dtypes)
    new = {"text": F.col("masked"), "n_chars": F.when(F.size("spans") > 0, F.length("masked").cast(kind.get("n_chars", "long"))).otherwise(F.col(f"{row}.n_chars")) if "n_chars" in kind else None}
    return out.select(*(new[c].alias(c) if c in new else F.col(f"{row}.`{c}`").alias(c) for c in df.columns))
