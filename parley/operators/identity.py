"""Names: roster history, ledgers of confirmed corrections, phonetic candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.predicates import confirmed_target, name_tokens
from . import terms
from .search import small


def identity_key(email: Column, employee_id: Column, fallback: Column, company: str) -> Column:
    """of a company address its local part, else the address, else the id, else the fallback; hashed."""
    mail = F.lower(F.trim(F.coalesce(email, F.lit(""))))
    own = mail.endswith("@" + company)
    base = F.when(own, F.concat(F.lit("alias:"), F.split(mail, "@")[0])).when(mail != "", F.concat(F.lit("mail:"), mail)).when(F.coalesce(employee_id, F.lit("")) != "", F.concat(F.lit("id:"), employee_id)).otherwise(F.concat(F.lit("name:"), fallback))
    return F.substring(F.sha2(base, 256), 1, 24)


def fuzzy_names(tokens: DataFrame, roster: DataFrame, least: float, top: int, similar=T.similarity) -> DataFrame:
    """For each token the ``top`` most similar roster names, by (-similarity, name)."""
    w = Window.partitionBy("token").orderBy(F.col("sim").desc(), "name")
    return fuzzy_pairs(tokens, roster, least, similar).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def fuzzy_pairs(tokens: DataFrame, roster: DataFrame, least: float, similar=T.similarity) -> DataFrame:
    """All pairs of a token and another roster name of similarity ``least`` or more. Names are met
    by shared blocking keys instead of a cross join: a similarity of ``least`` or more over n characters leaves
    at most (1 - least) n edits, so of the pieces that a name falls into when cut that many times
    plus one, some piece stands in the other within that shift."""
    cuts = lambda c: F.greatest(F.floor((1 - least) * F.ceil(F.length(c) / least)).cast("int"), F.lit(0)) + 1

    def pieces(c: Column) -> Column:
        """(start, piece): the name cut into cuts + 1 pieces of near equal length."""
        n, k = F.length(c), cuts(c)
        return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct(F.floor(i * n / k).cast("int").alias("at"), F.substring(c, F.floor(i * n / k).cast("int") + 1, F.floor((i + 1) * n / k).cast("int") - F.floor(i * n / k).cast("int")).alias("piece")))

    def windows(c: Column, size: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - size + 1, F.lit(1))), lambda i: F.substring(c, i, size)))

    held = roster.select("name").distinct().withColumn("p", F.explode(pieces(F.col("name")))).select("name", F.col("p.piece").alias("piece")).filter("piece <> ''").distinct()
    sizes = held.agg(F.array_sort(F.collect_set(F.length("piece"))).alias("sizes"))  # a few numbers
    asked = tokens.select("token").distinct().join(F.broadcast(sizes)).withColumn("size", F.explode("sizes")).withColumn("piece", F.explode(windows(F.col("token"), F.col("size")))).select("token", "piece").distinct()
    met = asked.join(held, "piece").select("token", "name").distinct().filter("token <> name")
    return met.withColumn("sim", similar(F.col("token"), F.col("name"))).filter(F.col("sim") >= least)


def phonetic_hints(transcripts: DataFrame, roster: DataFrame, floor: float = 0.72, bare_floor: float = 0.86, top: int = 2, most: int = 30) -> DataFrame:
    """Per transcript (note, text) its name-like tokens that sound like names of the roster (name, department, position, employment_status):
    the ``top`` names of each token by (-similarity, name) as one candidate text; tokens in a form of address first, longer ones before
    shorter ones, then by place; equal lines once, the first ``most``. Similarity is that of the letters, with the whole name or the given name;
    a token out of address needs ``bare_floor``."""
    found = transcripts.select("note", F.posexplode(name_tokens(F.col("text"))).alias("first", "token"), "text").withColumn("addressed", F.contains("text", F.concat("token", F.lit("님"))) | F.contains("text", F.concat("token", F.lit("씨")))).drop("text")
    names = roster.filter(F.col("name").rlike("^[가-힣]{2,5}$"))
    forms = names.select("name", F.explode(F.array(T.jamo(F.col("name")), T.jamo(T.given_name(F.col("name"))))).alias("form")).distinct()
    asked = found.select("token").distinct().withColumn("letters", T.jamo(F.col("token")))
    near = fuzzy_pairs(asked.select(F.col("letters").alias("token")), forms.select(F.col("form").alias("name")), floor).select(F.col("token").alias("letters"), F.col("name").alias("form"), "sim")
    same = asked.join(forms, F.col("letters") == F.col("form")).select("letters", "form", F.lit(1.0).alias("sim")).distinct()
    pairs = near.union(same).join(asked, "letters").join(forms, "form").groupBy("token", "name").agg(F.max("sim").alias("sim")).filter("token <> name")
    told = pairs.join(names, "name")
    label = F.when(F.col("employment_status") == "former", " · 퇴사").when(F.col("employment_status") == "unverified", " · 재직 미확인").otherwise("")
    place = F.concat(F.col("department"), F.when(F.coalesce("position", F.lit("")) != "", F.concat(F.lit(", "), "position")).otherwise(""), label)
    told = told.select("token", "sim", "name", F.concat("name", F.lit("("), place, F.lit(") 유사도 "), F.format_number("sim", 2)).alias("said"))
    each = found.join(told, "token").filter(F.col("sim") >= F.when(F.col("addressed"), floor).otherwise(bare_floor))
    w = Window.partitionBy("note", "token").orderBy(F.desc("sim"), "name", "said")
    best = each.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top).groupBy("note", "token", "addressed", "first").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "said"))), lambda x: x["said"]), ", ").alias("candidates"))
    order = Window.partitionBy("note").orderBy(F.desc("addressed"), F.desc(F.length("token")), "first")
    return best.dropDuplicates(["note", "token", "candidates"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).drop("first")


def roster_names(lines: DataFrame) -> DataFrame:
    """the names of a roster's lines (line): what stands before the first tab, without the header and blank lines."""
    name = F.trim(F.split("line", "\t")[0])
    return lines.filter((F.trim("line") != "") & ~F.col("line").startswith("name\t")).select(name.alias("name")).filter("name <> ''").distinct()


def confirmed_names(roster: DataFrame, ledger_lines: DataFrame) -> DataFrame:
    """Names known to be real: of the roster (name), and the targets of ledger lines (line) up to a parenthesis."""
    target = F.trim(F.regexp_extract("line", r"→\s*\*\*([^*(]+)", 1))
    return roster.select("name").union(ledger_lines.select(target.alias("name"))).filter("name <> ''").distinct()


def confirmed_mentions(notes: DataFrame, names: DataFrame) -> DataFrame:
    """Per note (note, mentions) the mentions that are confirmed names, each once, in the order of first mention."""
    each = notes.select("note", F.posexplode("mentions").alias("pos", "name")).groupBy("note", "name").agg(F.min("pos").alias("pos")).join(names, "name", "left_semi")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"])
    return each.groupBy("note").agg(ordered.alias("confirmed"))


# What a name may be followed by, and what no name begins within.
BOUNDARY, PARTICLES = "가-힣A-Za-z0-9", "은|는|이|가|을|를|과|와|에게|께|도|만|로|으로|의"
DONE = "검증 완료"


def _begun(df: DataFrame, text: str, ledger: DataFrame, after: int) -> DataFrame:
    """``df`` with each variant of ``ledger`` that stands in ``text`` where no letter or digit comes before it, and ``rest``, the next
    ``after`` characters. One automaton of all variants runs over each text."""
    variants = terms.collected(ledger, "variant")
    if variants is None:
        return _begun_by_join(df, text, ledger, after)
    hit = terms.occurrences(df, text, variants, BOUNDARY, places=True).withColumn("_t", F.explode("_terms")).drop("_terms")
    found = hit.withColumn("variant", F.col("_t.term")).withColumn("rest", F.substring(text, F.col("_t.start") + F.length("variant") + 1, F.lit(after))).drop("_t")
    return found.join(small(ledger), "variant")


def _begun_by_join(df: DataFrame, text: str, ledger: DataFrame, after: int) -> DataFrame:
    """The same for ledgers too large to collect: variants meet the beginnings of what stands at word starts, by equality."""
    top = ledger.agg(F.max(F.length("variant")).alias("n"), F.array_sort(F.collect_set(F.length("variant"))).alias("sizes")).first()
    sizes = [n for n in top["sizes"] if n]  # distinct lengths of names: a few numbers
    piece = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?<![{BOUNDARY}])(?=(.{{1,{(top['n'] or 0) + after}}}))"), F.lit(1)))
    each = df.withColumn("_piece", F.explode(piece)).withColumn("_n", F.explode(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>"))).filter(F.length("_piece") >= F.col("_n"))
    cut = each.withColumn("variant", F.substring("_piece", F.lit(1), F.col("_n"))).withColumn("rest", F.substring("_piece", F.col("_n") + 1, F.lit(after)))
    return cut.drop("_piece", "_n").join(ledger, "variant")


def relevant_ledger(transcripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per transcript (note, text) the ledger entries (variant, target, count) whose variant it holds with nothing before it that could belong to it."""
    rows, entries = transcripts.select("note", "text"), ledger.select("variant", "target", "count").distinct()
    variants = terms.collected(ledger, "variant")
    if variants is None:
        return _begun_by_join(rows, "text", ledger, 0).select("note", "variant", "target", "count").distinct()
    hit = terms.occurrences(rows, "text", variants, BOUNDARY).select("note", F.explode("_terms").alias("variant"))
    return hit.join(small(entries), "variant").select("note", "variant", "target", "count")


def usage_issues(lines: DataFrame, ledger: DataFrame, roster: DataFrame, least: int = 7) -> DataFrame:
    """Lines of notes (note, line_no, line) outside the section of completed checks in which a variant that was confirmed ``least`` times or more
    still stands for its target; with a roster (name) only for targets named there. A variant counts alone, with a form of address, or with a particle."""
    name = F.split(F.trim("target"), r"[\s(]")[0]
    known = ledger.filter((F.col("count") >= least) & F.col("variant").rlike("^[가-힣]{2,8}$")).withColumn("_name", name).filter(F.col("variant") != F.col("_name"))
    if roster.limit(1).count():
        known = known.join(roster.select(F.col("name").alias("_name")).distinct(), "_name", "left_semi")
    heading = F.regexp_extract("line", r"^#{2,3}\s*(?:[0-9]+(?:[.][0-9]+)*[.]?\s*)?(.+?)\s*$", 1)
    ends = rf"^(?:님|씨)?(?:$|[^{BOUNDARY}]|{PARTICLES})"
    told = lines.select("note", "line_no", "line", F.when(heading != "", heading).alias("_heading"))
    window = Window.partitionBy("note").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    outside = F.coalesce(F.last("_heading", ignorenulls=True).over(window) != DONE, F.lit(True))
    known, variants = known.drop("_name"), terms.collected(known, "variant")
    if variants is None:
        body = told.withColumn("_outside", outside).filter("_outside").select("note", "line_no", "line")
        hit = _begun_by_join(body, "line", known, 4).filter(F.col("rest").rlike(ends))
        return hit.select("note", "line_no", F.trim("line").alias("line"), "variant", "target", "count").distinct()
    # a line moves once, with its variants beside it, and only if it has some; headings go without their text
    met = F.array_distinct(F.transform(F.filter("_terms", lambda t: t["rest"].rlike(ends)), lambda t: t["term"]))
    found = terms.occurrences(told.withColumn("_head", F.col("_heading").isNotNull()), "line", variants, BOUNDARY, places=True, after=4, also="_head")
    is_head = F.col("_terms").isNull()
    placed = found.select("note", "line_no", F.when(~is_head, F.trim("line")).alias("line"), met.alias("_variants"), F.when(is_head, F.col("_heading")).alias("_heading")).filter(F.col("_heading").isNotNull() | (F.size("_variants") > 0))
    first = Window.partitionBy("note").orderBy("line_no", F.col("_heading").isNull()).rowsBetween(Window.unboundedPreceding, 0)  # a heading stands over its own line
    kept = placed.withColumn("_section", F.last("_heading", ignorenulls=True).over(first)).filter(F.col("_variants").isNotNull() & F.coalesce(F.col("_section") != DONE, F.lit(True))).select("note", "line_no", "line", "_variants").distinct()
    return kept.withColumn("variant", F.explode("_variants")).join(small(known.select("variant", "target", "count").distinct()), "variant").select("note", "line_no", "line", "variant", "target", "count")


def reported(rows: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key, with how many there are and whether some are left out."""
    total = rows.groupBy(*keys).agg(F.count("*").alias("total"))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= most)
    return first.join(total, keys).withColumn("truncated", F.col("total") > most)


def ledger_counts(confirmed: DataFrame, before: Column | None = None) -> DataFrame:
    """A2: in how many distinct notes each (target, variant) was confirmed; with ``before`` only in notes strictly before that one,
    so that a note that is made anew doesn't learn from itself."""
    confirmed = confirmed if before is None else confirmed.filter(F.col("note") < before)
    return confirmed.select("note", "target", "variant").distinct().groupBy("target", "variant").agg(F.count("*").alias("count"))


def grounded(confirmed: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Only variants that the note's own transcript holds; notes without one stay."""
    t = transcripts.select(F.col("note"), F.col("text").alias("transcript"))
    rest = [c for c in confirmed.columns if c != "note"]
    held = confirmed.groupBy("note").agg(F.collect_list(F.struct(*rest)).alias("x")).join(t, "note", "left")  # each text moves once
    stays = F.filter("x", lambda x: F.col("transcript").isNull() | F.contains(F.col("transcript"), x["variant"]))
    return held.select("note", F.explode(stays).alias("x")).select("note", "x.*").select(*confirmed.columns)


# Sections that confirm corrections or name terms, what a ledger line looks like, and words that no term holds.
CONFIRMED = r"^#{2,3}\s*(?:[0-9]+(?:[.][0-9]+)*[.]?\s*)?검증\s*완료"
CORRECTION = r"^\s*[-*]\s*(.+?)\s*(?:->|→)\s*\*\*([^*]+)\*\*"
NOISE = ("추정", "근거", "원문", "예시", "불명", "또는", "추가", "참고", "이하", "명부", "매칭", "오기", "의심", "있음", "없음", "가능성")
CATEGORY = r"^\s*-\s*\*\*([^*]+?)\*\*\s*[:：]\s*(.+)"
ARROWS = (r"→\s*\*\*([^*\n]+?)\*\*", r"→\s*([A-Za-z가-힣0-9+&.\-]+(?:\s[A-Za-z가-힣0-9+&.\-]+){0,3})")
SECTION = r"(?sm)^#{2,3}\s*(?:[0-9]+(?:[.][0-9]+)*[.]?\s*)?NAME\s*$\n(.*?)(?=^#{2,3}\s|\z)"
PREFACE = ("누적 확정 표기 사전 (과거 회의록 `검증 완료`에서 축적).", "형식: `STT 변형 후보` → 정정 (확정 횟수). 전사 문맥이 맞을 때만 적용하고, 애매하면 검증 필요에 남긴다.", "")


def corrections(notes: DataFrame) -> DataFrame:
    """The confirmed corrections (note, target, variant) of notes (note, text): of bullets in a section of completed checks."""
    lines = notes.select("note", F.posexplode(F.split("text", r"\r\n|\n")).alias("line_no", "line"))
    head = F.when(F.col("line").rlike(r"^#{2,3}\s"), F.col("line").rlike(CONFIRMED))
    inside = F.last(head, ignorenulls=True).over(Window.partitionBy("note").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
    hit = lines.withColumn("inside", inside).filter(F.col("inside") & head.isNull() & F.col("line").rlike(CORRECTION))
    named = hit.select("note", confirmed_target(F.regexp_extract("line", CORRECTION, 2)).alias("target"), F.explode(T.variants(F.regexp_extract("line", CORRECTION, 1))).alias("variant"))
    return named.filter("target is not null and variant <> target").distinct()


def ledger(notes: DataFrame, transcripts: DataFrame, before: Column | None = None, least: int = 1) -> DataFrame:
    """In how many notes, before one if asked, each correction was confirmed, by a variant that the note's own transcript holds."""
    counts = ledger_counts(grounded(corrections(notes), transcripts), before)
    return counts.filter(F.col("count") >= least)


def ledger_lines(counts: DataFrame, most: int = 200) -> DataFrame:
    """The ledger as lines (line_no, line): its preface, then the ``most`` corrections of most notes by (-count, target, variant). No corrections: no lines."""
    spark = counts.sparkSession
    top = counts.orderBy(F.desc("count"), "target", "variant").limit(most)
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "target", "variant"))
    body = top.select((rank + len(PREFACE) - 1).alias("line_no"), F.concat(F.lit("- "), "variant", F.lit(" → **"), "target", F.lit("** ("), F.col("count").cast("string"), F.lit("회)")).alias("line"))
    head = spark.createDataFrame(list(enumerate(PREFACE)), "line_no int, line string")
    return head.join(F.broadcast(body.limit(1).select(F.lit(1).alias("_any"))), how="cross").drop("_any").union(body)


def _section(text: Column, name: str) -> Column:
    return F.regexp_extract(text, SECTION.replace("NAME", name), 1)


def glossary(notes: DataFrame, most: int = 80) -> DataFrame:
    """Terms of notes (note, text) in order of first appearance, the first ``most``: values of marked categories, bold text and code of the section of
    other remarks, then the targets of arrows in the sections of completed and open checks; cleaned, noise left out (P8)."""
    all_ = lambda c, p: F.regexp_extract_all(c, F.lit(p), F.lit(1))
    remarks = F.flatten(F.transform(F.split(_section(F.col("text"), "기타 메모"), r"\r\n|\n"), lambda line: F.when(line.rlike(CATEGORY), F.split(F.regexp_replace(F.regexp_extract(line, CATEGORY, 2), r"\s*\([^)]*\)\s*", " "), "[,、]")).otherwise(F.concat(all_(line, r"\*\*([^*\n]+?)\*\*"), all_(line, "`([^`\n]+?)`")))))
    checks = [F.get(F.transform(F.array(_section(F.col("text"), name)), lambda s: F.concat(*(all_(s, arrow) for arrow in ARROWS))), F.lit(0)) for name in ("검증 완료", "검증 필요")]
    each = notes.select("note", F.posexplode(F.concat(remarks, *checks)).alias("pos", "term")).groupBy("term").agg(F.min(F.struct("note", "pos")).alias("first"))  # a term is cleaned once, not in each note
    bare = T.stripped(F.regexp_replace(T.stripped(F.col("term")), r"^[.,;·「」『』\"'`]+|[.,;·「」『』\"'`]+$", ""))
    balanced = F.when(F.regexp_count(bare, F.lit(r"\(")) != F.regexp_count(bare, F.lit(r"\)")), T.stripped(F.regexp_replace(bare, "[()]", ""))).otherwise(bare)
    kept = each.withColumn("term", balanced).filter(F.length("term").between(2, 40) & ~F.col("term").rlike("|".join(NOISE)) & ~F.col("term").contains("/") & ~F.col("term").contains(" 등"))
    first = kept.groupBy("term").agg(F.min("first").alias("first"))
    return first.orderBy("first").limit(most).select("term", F.col("first.note").alias("note"))


def ledger_lookup(words: DataFrame, ledger: DataFrame, suffixes: list[str]) -> DataFrame:
    """For each word the longest variant that it is, or is with one of the suffixes: an equality
    join on every way to cut the word."""
    ends = F.array(*(F.lit(s) for s in ["", *suffixes]))
    cut = words.withColumn("suffix", F.explode(F.filter(ends, lambda s: F.col("word").endswith(s)))).withColumn("variant", F.expr("substring(word, 1, length(word) - length(suffix))"))
    hit = cut.join(ledger, "variant")
    w = Window.partitionBy("word").orderBy(F.length("variant").desc(), "target")
    return hit.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


def merge_history(history: DataFrame, authoritative: DataFrame, supplemental: DataFrame, snapshot: str, fresh: bool) -> DataFrame:
    """The roster after a snapshot. A fresh one makes its people active and others that an
    authoritative source ever named former; a stale one does neither. A person under a new key takes over an
    old entry if the name is unique on both sides. Supplemental sources only add, as unverified."""
    h = history.withColumn("only", F.count("*").over(Window.partitionBy("name")) == 1)
    a = authoritative.withColumn("only", F.count("*").over(Window.partitionBy("name")) == 1)
    own = a.join(h.select(F.col("identity_key"), F.lit(True).alias("known")), "identity_key", "left")
    renamed = own.filter("known is null and only").join(h.filter("only").select("name", F.col("identity_key").alias("old_key")), "name").select("identity_key", "old_key")
    keyed = own.join(renamed, "identity_key", "left").withColumn("was", F.when(F.col("known"), F.col("identity_key")).otherwise(F.col("old_key")))
    p = h.drop("only").select(*(F.col(c).alias(f"h_{c}") for c in history.columns))
    both = keyed.join(p, keyed["was"] == p["h_identity_key"], "full_outer")
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(""))
    now = F.col("identity_key").isNotNull()
    newer = F.lit(fresh) | F.col("h_identity_key").isNull() | (F.lit(snapshot) >= text("h_last_confirmed"))
    gone = ~now & F.lit(fresh) & F.coalesce("h_ever_authoritative", F.lit(False)) & (F.col("h_employment_status") != "former")
    field = lambda c: F.when(now & newer, F.col(c)).when(now, F.coalesce(F.nullif(F.col(f"h_{c}"), F.lit("")), F.col(c))).otherwise(F.col(f"h_{c}"))
    status = F.when(now & F.lit(fresh), "active").when(now, F.coalesce(F.nullif("h_employment_status", F.lit("")), F.lit("unverified"))).when(gone, "former").otherwise(F.col("h_employment_status"))
    merged = both.select(
        F.coalesce("identity_key", "h_identity_key").alias("identity_key"), field("name").alias("name"), field("department").alias("department"),
        F.when(now & newer, F.coalesce(F.nullif("position", F.lit("")), F.col("h_position"), F.lit(""))).otherwise(field("position")).alias("position"),
        status.alias("employment_status"), F.when(now, F.coalesce(F.nullif("h_first_seen", F.lit("")), F.lit(snapshot))).otherwise(F.col("h_first_seen")).alias("first_seen"),
        F.when(now, F.greatest(text("h_last_confirmed"), F.lit(snapshot))).otherwise(F.col("h_last_confirmed")).alias("last_confirmed"),
        F.when(now & F.lit(fresh), "").when(now, text("h_former_since")).when(gone, snapshot).otherwise(F.col("h_former_since")).alias("former_since"),
        (now | F.coalesce("h_ever_authoritative", F.lit(False))).alias("ever_authoritative"),
        F.array_sort(F.array_union(F.coalesce("h_sources", F.array().cast("array<string>")), F.when(now, F.array("source")).otherwise(F.array().cast("array<string>")))).alias("sources"),
    )
    # supplemental: by key, else by a name that is unique among the entries
    only = merged.withColumn("n", F.count("*").over(Window.partitionBy("name"))).filter("n = 1").select("name", F.col("identity_key").alias("by_name"))
    s = supplemental.join(merged.select("identity_key", F.lit(True).alias("known")), "identity_key", "left").join(only, "name", "left")
    s = s.withColumn("to", F.when(F.col("known"), F.col("identity_key")).otherwise(F.coalesce("by_name", "identity_key"))).withColumn("new", F.col("known").isNull() & F.col("by_name").isNull())
    add = s.filter("not new").groupBy("to").agg(F.collect_set("source").alias("more"), F.min_by("department", "source").alias("more_department"))
    kept = merged.join(add, merged["identity_key"] == add["to"], "left").drop("to")
    kept = kept.withColumn("sources", F.array_sort(F.array_union("sources", F.coalesce("more", F.array().cast("array<string>"))))).withColumn("department", F.when(F.col("more").isNotNull() & ((text("department") == "") | (F.col("department") == "확인 필요")), F.col("more_department")).otherwise(F.col("department"))).drop("more", "more_department")
    fresh_rows = s.filter("new").groupBy("to").agg(F.min_by(F.struct("name", "department", "position"), "source").alias("x"), F.array_sort(F.collect_set("source")).alias("sources"))
    blank = F.lit("")
    new = fresh_rows.select(F.col("to").alias("identity_key"), "x.name", "x.department", "x.position", F.lit("unverified").alias("employment_status"), F.lit(snapshot).alias("first_seen"), blank.alias("last_confirmed"), blank.alias("former_since"), F.lit(False).alias("ever_authoritative"), "sources")
    return kept.unionByName(new)
