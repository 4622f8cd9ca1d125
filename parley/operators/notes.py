"""Meeting notes: sections, items, and the contract that a note must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import FACTS, stripped, without_particle

# The headings of the contract, the forms of its lines, and endings of formulaic reports.
HEADINGS = ("## 1. 핵심 결론 및 결정사항", "## 2. Action Items", "## 3. 미결 쟁점 및 다음 결정", "## 4. 상세 논의와 근거", "## 5. 참석자·용어 검증 부록")
APPENDIX = ("### 5.1 참석자/언급 인물", "### 5.2 검증 완료", "### 5.3 검증 필요")
ENDINGS = ("설명했다", "언급됐다", "제기됐다", "논의했다", "공유됐다", "확인됐다", "의견이 나왔다")
ACTION = r"^- \[(?: |x|X)\] \*\*(A[1-9][0-9]*)\s+·\s+(.+?)\*\*\s*$"
OPEN = r"^- \*\*(M[1-9][0-9]*)\s+·\s+(.+?)\*\*\s*$"
ANONYMOUS = r"(?:^|[\s(/])화자\s+[A-Z?](?:$|[\s)/])"
FIELD_LABELS = "(?:담당|기한|완료 기준|검증 상태|근거(?:/의존성)?):"
UNCERTAIN = "추정|후보|가능성|불명확|확인 필요"
REPLACED = r"`([^`]+)`\s*(?:→|->)"
BOILERPLATE = r"직원 디렉토리에서\s*active로 확인|직원 디렉토리.*확인됨"
META = r"^(?:\t| {2,})(.+?)\s+·\s+(.+?)\s+·\s+(§4\.[0-9]+(?:\s*,\s*§4\.[0-9]+)*)\s*$"


def carried(lines: DataFrame, key: str, heading: Column, name: str = "section") -> DataFrame:
    """The heading that each line stands under."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.last(heading, ignorenulls=True).over(w))


def fences(lines: Column) -> Column:
    """The code fences of an array of lines (first, last: indexes, marks included), in order; a fence ends with the mark that began it, or never.
    A fold over the lines with a mark, since each one's meaning depends on those before."""
    return spans(F.filter(F.transform(lines, lambda x, i: F.when(x.contains("```") | x.contains("~~~"), F.struct(i.alias("at"), x.alias("line")))), lambda m: m.isNotNull()))


def spans(lines: Column) -> Column:
    """The fences of the lines (at: index, line) that may have a mark."""
    marks = F.filter(F.transform(lines, lambda x: F.struct(x["at"].alias("at"), F.regexp_extract(x["line"], r"^\s*(```|~~~)", 1).alias("mark"))), lambda m: m["mark"] != "")
    span = lambda a, b: F.array(F.struct(a.alias("first"), b.alias("last")))

    def step(acc: Column, m: Column) -> Column:
        opens, closes = acc["mark"] == "", m["mark"] == acc["mark"]
        return F.struct(
            F.when(opens, m["mark"]).when(closes, F.lit("")).otherwise(acc["mark"]).alias("mark"), F.when(opens, m["at"]).otherwise(acc["at"]).alias("at"),
            F.when(~opens & closes, F.concat(acc["out"], span(acc["at"], m["at"]))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit("").alias("mark"), F.lit(-1).alias("at"), F.array().cast("array<struct<first: int, last: int>>").alias("out"))
    return F.aggregate(marks, start, step, lambda acc: F.when(acc["mark"] != "", F.concat(acc["out"], span(acc["at"], F.lit(2**31 - 1)))).otherwise(acc["out"]))


def fenced(lines: Column) -> Column:
    """For each line of an array whether it stands in a code fence."""
    inside = lambda closed: F.transform(lines, lambda x, i: F.exists(closed, lambda s: (s["first"] <= i) & (i <= s["last"])))
    return F.get(F.transform(F.array(fences(lines)), inside), F.lit(0))


def sections(notes: DataFrame, key: str, text: str) -> DataFrame:
    """The H2 sections of a text, fences left alone: key, seq, heading, body."""
    split = notes.select(key, F.split(text, "\n").alias("lines")).select(key, F.arrays_zip("lines", fenced(F.col("lines")).alias("fenced")).alias("z"))
    lines = split.select(key, F.posexplode("z").alias("line_no", "x")).select(key, "line_no", F.col("x.lines").alias("line"), F.col("x.fenced").alias("fenced"))
    head = F.col("line").rlike(r"^##\s+\S") & ~F.col("fenced")
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("head", head).withColumn("seq", F.sum(head.cast("int")).over(w)).filter("seq > 0")
    ordered = F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("line_no", "line"))))
    return numbered.groupBy(key, "seq").agg(F.max(F.when(F.col("head"), F.trim("line"))).alias("heading"), F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("body"))


def items(lines: DataFrame, key: str, item: str = ACTION) -> DataFrame:
    """Item lines with the metadata of the next line that isn't blank."""
    w = Window.partitionBy(key).orderBy("line_no")
    filled = lines.filter(F.trim("line") != "").withColumn("next", F.lead("line").over(w))
    meta = lambda i: F.when(F.col("next").rlike(META), F.regexp_extract("next", META, i))
    return filled.filter(F.col("line").rlike(item)).select(key, "line_no", F.regexp_extract("line", item, 1).alias("item_id"), F.regexp_extract("line", item, 2).alias("title"), meta(1).alias("owner"), meta(2).alias("due"), F.transform(F.split(meta(3), ","), lambda x: F.trim(x)).alias("evidence_refs"))


def contiguous(ids: Column, prefix: str) -> Column:
    """Whether sorted ids are prefix1 .. prefixN."""
    numbers = F.array_sort(F.transform(ids, lambda x: F.substring(x, F.lit(len(prefix) + 1), F.length(x)).cast("int")))
    return (F.size(ids) == 0) | (numbers == F.sequence(F.lit(1), F.greatest(F.size(ids), F.lit(1))))


def ending(line: Column, endings: tuple[str, ...] = ENDINGS) -> Column:
    """The reporting ending of a bullet, or null."""
    bare = F.regexp_replace(F.rtrim(line), r"\.+$", "")
    out = F.lit(None).cast("string")
    for e in reversed(endings):
        out = F.when(bare.endswith(e), e).otherwise(out)
    return out


def ending_runs(bullets: DataFrame, key: str) -> DataFrame:
    """Runs of neighbouring bullets (key, pos, ending) with the same ending: ending, begin, length."""
    w = Window.partitionBy(key).orderBy("pos")
    new = ~F.lag("ending").over(w).eqNullSafe(F.col("ending")) | (F.row_number().over(w) == 1)
    runs = bullets.withColumn("_new", new).withColumn("run", F.sum(F.when(F.col("_new"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.filter("ending is not null").groupBy(key, "run", "ending").agg(F.min("pos").alias("begin"), F.count("*").alias("length"))


def _body(text: Column, heading: str, until: str = "^##\\s") -> Column:
    """What stands under the first place of a heading, up to the next heading of the kind ``until``."""
    return stripped(F.regexp_extract(text, rf"(?sm)\Q{heading}\E[^\n]*\n(.*?)(?={until}|\z)", 1))


def _items(body: Column, item: str) -> Column:
    """The items of a section: id, title, whether the line after has their metadata, and the owner that it names."""
    lines = F.split(body, r"\r\n|\n")

    def one(line: Column, i: Column) -> Column:
        after = F.coalesce(F.try_element_at(lines, i + 2), F.lit(""))
        part = lambda k: F.regexp_extract(stripped(line), item, k)
        return F.struct(part(1).alias("id"), part(2).alias("title"), after.rlike(META).alias("meta"), F.regexp_extract(after, META, 1).alias("owner"))

    return F.filter(F.transform(lines, one), lambda x: x["id"] != "")


def _occurs(text: Column, part: Column) -> Column:
    """How often ``part`` stands in ``text``, without overlap."""
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def contract(notes: DataFrame, summary_chars: int = 1400, summary_items: int = 7, bilingual: tuple[str, ...] = ()) -> DataFrame:
    """note_key and errors, an array of the rules that the note breaks, in their order. ``bilingual``: names in two scripts, as the
    house writes them, that a note should spell out twice at most."""
    text = F.col("text")
    first = F.element_at(F.concat(F.filter(F.transform(F.split(text, r"\r\n|\n"), stripped), lambda x: x != ""), F.array(F.lit(""))), 1)
    heads = F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^##\s+.+$"), F.lit(0)), stripped)
    facts = F.array_contains(heads, FACTS)
    known = F.array(*map(F.lit, (*HEADINGS, FACTS)))
    required = F.array(*map(F.lit, HEADINGS))
    named = {name: _body(text, h) for name, h in zip(("summary", "actions", "open", "detail", "appendix", "facts"), (*HEADINGS, FACTS))}
    named |= {name: _body(text, h, "^#{2,3}\\s") for name, h in zip(("attendees", "verified", "pending"), APPENDIX)}
    x = notes.select("note_key", "text", first.alias("first"), heads.alias("heads"), *(c.alias(n) for n, c in named.items()))
    x = x.withColumn("a", _items(F.col("actions"), ACTION)).withColumn("o", _items(F.col("open"), OPEN))
    heads, at = F.col("heads"), [F.position(F.lit(h), text) for h in APPENDIX]
    want = F.when(F.array_contains(heads, FACTS), known).otherwise(required)
    points = F.size(F.filter(F.split("summary", "\n"), lambda l: stripped(l).rlike(r"^(?:[-*+]\s+|[0-9]+[.)]\s+)")))
    summary = F.col("summary")

    def listed(name: str, items: str, prefix: str) -> dict[str, Column]:
        body, of = F.col(name), F.col(items)
        used = (body != "") & (body != "- 해당 없음")
        ids, titles = F.transform(of, lambda i: i["id"]), F.transform(of, lambda i: i["title"])
        numbers = F.array_sort(F.transform(F.array_distinct(ids), lambda i: F.substring(i, F.lit(2), F.length(i)).cast("int")))
        whole = F.when(F.size(of) == 0, F.lit(True)).otherwise(numbers == F.sequence(F.lit(1), F.greatest(F.size(of), F.lit(1))))
        return {
            "none": used & (F.size(of) == 0), "ids": used & (F.size(ids) != F.size(F.array_distinct(ids))), "titles": used & (F.size(titles) != F.size(F.array_distinct(titles))), "gaps": used & ~whole,
            "elsewhere": used & F.exists(titles, lambda t: _occurs(text, t) > 1), "bare": used & F.exists(of, lambda i: ~i["meta"]), "anonymous": used & F.exists(of, lambda i: i["meta"] & i["owner"].rlike(ANONYMOUS)), "used": used,
        }

    act, opened = listed("actions", "a", "A"), listed("open", "o", "M")
    bullets = F.filter(F.transform(F.split("detail", "\n"), stripped), lambda l: l.startswith("- ") | l.startswith("* "))
    x = x.withColumn("ends", F.transform(bullets, lambda b: ending(b)))
    told = F.filter("ends", lambda e: e.isNotNull())
    most = F.coalesce(F.array_max(F.transform(F.array_distinct(told), lambda e: F.size(F.filter(told, lambda y: y == e)))), F.lit(0))
    run = lambda a, e: F.when(e.isNull(), 0).when(e == a["last"], a["n"] + 1).otherwise(1)
    runs = F.aggregate("ends", F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("n"), F.lit(0).alias("most")), lambda a, e: F.struct(e.alias("last"), run(a, e).alias("n"), F.greatest(a["most"], run(a, e)).alias("most")), lambda a: a["most"])
    n = F.size("ends")
    sources = lambda part, p: F.transform(F.regexp_extract_all(part, F.lit(p), F.lit(1)), without_particle)
    checked, found = F.array_contains(heads, FACTS), F.col("facts")
    fact_ids = F.transform(F.regexp_extract_all(found, F.lit(r"(?m)^### F([1-9][0-9]*)[.]\s+"), F.lit(1)), lambda i: i.cast("int"))
    against = checked & found.contains("객관 사실과 충돌")
    primary = ("summary", "actions", "open", "detail")
    rules: list[tuple[Column, str]] = [
        (~F.col("first").startswith("# ") | F.col("first").startswith("## "), "title"),
        *((~F.array_contains(heads, h), f"missing section: {h}") for h in HEADINGS),
        (F.size(F.array_except(heads, known)) > 0, "unexpected section"),
        ((F.size(F.array_except(required, heads)) == 0) & (heads != want), "section order"),
        *((p == 0, f"missing subsection: {h}") for p, h in zip(at, APPENDIX)),
        ((at[0] > 0) & (at[1] > 0) & (at[2] > 0) & ~((at[0] < at[1]) & (at[1] < at[2])), "subsection order"),
        (text.rlike(r"(?m)^##\s+.*Task Handoff"), "task handoff"),
        (F.length(summary) > summary_chars, "summary length"),
        ((summary != "") & ~points.between(1, summary_items), "summary items"),
        (act["ids"], "action ids repeat"), (act["titles"], "action text repeats"), (act["elsewhere"], "action text elsewhere"), (act["bare"], "action without metadata"), (act["anonymous"], "anonymous owner"),
        (act["none"], "no action"), (act["gaps"], "action ids not contiguous"), (act["used"] & F.col("actions").contains("|"), "action table"), (act["used"] & F.col("actions").rlike(FIELD_LABELS), "action field labels"),
        (opened["ids"], "open ids repeat"), (opened["elsewhere"], "open text elsewhere"), (opened["bare"], "open item without metadata"), (opened["anonymous"], "anonymous open owner"), (opened["none"], "no open item"), (opened["gaps"], "open ids not contiguous"),
        *((F.col(c).contains("<table") | F.col(c).rlike(r"(?m)^[ \t]*\|"), f"table: {h}") for c, h in zip(primary, HEADINGS)), *((F.col(c).rlike("`[^`]+`"), f"inline code: {h}") for c, h in zip(primary, HEADINGS)),
        (F.col("verified").rlike(UNCERTAIN), "uncertain verification"),
        (F.exists(F.regexp_extract_all("verified", F.lit(REPLACED), F.lit(1)), lambda s: s.rlike("[0-9]")), "verified number"),
        (F.size(F.array_intersect(sources(F.col("verified"), REPLACED), sources(F.col("pending"), "`([^`]+)`"))) > 0, "verified and pending"),
        (checked & ~found.contains("- 웹검색:"), "search state missing"), (checked & (F.size(fact_ids) > 0) & (fact_ids != F.sequence(F.lit(1), F.greatest(F.size(fact_ids), F.lit(1)))), "fact ids not contiguous"),
        (against & ~(found.contains("- 바로잡기:") & found.contains("- 틀린 이유:")), "contradicted without correction"), (against & ~found.rlike("(?m)^- 근거: .+"), "contradicted without evidence"),
        (against & F.exists(F.regexp_extract_all(found, F.lit(r"\]\(([^)]+)\)"), F.lit(1)), lambda u: ~u.startswith("https://")), "indirect link"),
        *((F.regexp_count(F.concat_ws("\n", *primary), F.lit(rf"\Q{p}\E")) > 2, f"repeated product name: {p}") for p in bilingual),
        (runs >= 4, "repeated ending"), ((n >= 12) & (F.size(told) >= 8) & (F.size(told) / n >= 0.45), "formulaic endings"), ((most >= 10) & (most / F.greatest(n, F.lit(1)) >= 0.25), "overused ending"),
        (F.regexp_count("attendees", F.lit(BOILERPLATE)) >= 2, "roster boilerplate"),
    ]
    errors = F.filter(F.array(*(F.when(broken, F.lit(name)) for broken, name in rules)), lambda e: e.isNotNull())
    return x.select("note_key", errors.alias("errors"))


def previous(notes: DataFrame, group: str, key: str, turn: str, most: int, wide: int = 1000) -> DataFrame:
    """W14 for every key: the ``most`` notes of its group by (-key, -turn) among those of smaller keys, as group,
    at (the key asked for), key, turn. The last ones of ``wide`` neighbouring keys are told to the next ones, so no
    group is one task."""
    last = notes.withColumn("r", F.row_number().over(Window.partitionBy(group, key).orderBy(F.desc(turn)))).filter(F.col("r") <= most)
    newest = lambda c: F.slice(F.sort_array(c, asc=False), 1, most)
    held = last.groupBy(group, key).agg(newest(F.collect_list(F.struct(key, turn))).alias("own")).withColumn("part", F.floor(F.col(key) / wide))
    none = F.array().cast(held.schema["own"].dataType)

    def before(w: Window) -> Column:
        """Each row before has one note at least, so ``most`` rows do."""
        return F.concat(*(F.coalesce(F.lag("own", i).over(w), none) for i in range(1, most + 1)))

    top = held.withColumn("n", F.row_number().over(Window.partitionBy(group, "part").orderBy(F.desc(key)))).filter(F.col("n") <= most)
    parts = top.groupBy(group, "part").agg(newest(F.flatten(F.collect_list("own"))).alias("own"))
    told = parts.select(group, "part", before(Window.partitionBy(group).orderBy("part")).alias("told"))
    near = held.select(group, "part", F.col(key).alias("at"), before(Window.partitionBy(group, "part").orderBy(key)).alias("near"))
    found = near.join(told, [group, "part"]).select(group, "at", F.explode(F.slice(F.concat("near", "told"), 1, most)).alias("x"))
    return found.select(group, "at", f"x.{key}", f"x.{turn}")
