"""Readable forms of meeting notes, and the picture that suits one, as columns.

A note is taken apart within its own row: lines, the fences among them (W10), sections, items with the line that tells of them (W11), titles of the
evidence. Forms and pictures are built of these parts, so nothing is shuffled and no Python runs. White space and letters are Unicode's.

Functions within arrays are interpreted, so a line is stripped once, and only lines with a mark go to an expression. Forms are matched to stripped lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .notes import spans

# What the sections and items of a note look like, and the words of its readable form.
H1, H2, EVIDENCE = r"#\s+(.+)", r"##\s+(.+)", r"###\s+(4\.\d+)\s+(.+)"
ACTIONS, OPENS = "Action Items", "미결 쟁점"
ACTION_LINE = r"-\s*\[([ xX])\]\s*\*\*(A\d+)\s*[·.]\s*(.+)\*\*"
OPEN_LINE = r"-\s*(\*)\*(M\d+)\s*[·.]\s*(.+)\*\*"
REF = r"§(4\.\d+)"
NO_TITLE, NO_REFS = "근거", "확인 필요"
LABELS = {ACTIONS: ("담당", "일정", "근거"), OPENS: ("담당", "결정 시점", "근거")}
# The four kinds of pictures and what speaks for each.
STAGES = (("공개", r"공개|릴리즈|release"), ("온보딩", r"온보딩|교육"), ("파일럿", r"파일럿|pilot"), ("품질 검증", r"\bQC\b|\bBVT\b|검증|테스트"), ("피드백 반영", r"피드백|보완|수정"), ("확산", r"확산|전면 적용"), ("운영 이관", r"운영 이관|챔피언 이관|현업.*이관"))
STRONG = ("공개", "온보딩", "파일럿", "확산")
PARTS = (
    ("layer1", r"Layer\s*1|레이어\s*1"), ("layer2", r"Layer\s*2|레이어\s*2"), ("layer3", r"Layer\s*3|레이어\s*3"), ("ready-data", r"AI[- ]?ready Data|AI Ready Data"), ("mcp", r"\bMCP\b"),
    ("skill", r"\bSkill\b"), ("marketplace", r"marketplace|마켓플레이스"), ("control-plane", r"Control Plane|컨트롤 플레인"),
)
CONNECTED = r"연결|구조|아키텍처|레이어|Layer"
DATES = r"20\d{2}[-./]\d{1,2}[-./]\d{1,2}|\d{1,2}월\s*\d{1,2}일|\d{1,2}/\d{1,2}"
CHOICES = r"할지|인지|여부|둘지|나눌지|어느|어디|누가|어떻게|몇\s*점|먼저"

#: White space of Unicode.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: What most notes have of it at the ends of lines; all else of it and more, as two tests for a character.
COMMON = " \t"
RARE = r"[\x0B\f\x1C\x1D\x1E\x1F\x85\xA0\u1680-\u3000]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NODES = "array<struct<id: string, label: string, detail: string, ref: string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it. The end of a fold over nothing, as it takes over what the body makes;
    transform copies it, with all its parts, at each level."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, _: a, body)


def _whole(line: Column, form: str, group: int) -> Column:
    """A group of a form that a stripped line is as a whole; empty if it isn't."""
    return F.regexp_extract(line, rf"(?sU)\A{form}\z", group)


def _groups(line: Column, form: str, groups: str) -> Column:
    """The groups of a form that a stripped line is as a whole, by one match; the line alone if it isn't."""
    return F.split(F.regexp_replace(line, rf"(?sU)\A{form}\z", groups), "\n")


def _met(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?iuU){pattern}")


def _first(values: Column, of: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(values, of), F.lit(0))


def _some(values: Column, of: Callable[[Column, Column], Column]) -> Column:
    """What ``of`` makes of values and their indexes, where it isn't null."""
    return F.filter(F.transform(values, of), lambda x: x.isNotNull())


def taken_apart(text: Column) -> Column:
    """A note's parts: space (what is stripped of its lines), title (of the first H1, else empty), top (that line, null if it isn't before
    the first section), about (the lines between the two that aren't blank), sections (heading, body: lines, bare: the same stripped) and titles
    (no: line of the evidence, that is of all sections numbered 4., ref, title), the last first."""
    lines = F.split(F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text), "\n")
    space = F.when(text.rlike(RARE), SPACE).otherwise(COMMON)
    return let(space, lambda sp: let(lines, lambda ls: let(F.transform(ls, lambda x: F.trim(x, sp)), lambda bare: _parts(ls, bare, sp))))


def _parts(lines: Column, bare: Column, space: Column) -> Column:
    marked = _some(bare, lambda x, i: F.when(x.startswith("#") | x.startswith("```") | x.startswith("~~~"), F.struct(i.alias("no"), x.alias("line"))))

    def with_marks(marked: Column) -> Column:
        fenced = F.transform(F.filter(marked, lambda m: ~m["line"].startswith("#")), lambda m: F.struct(m["no"].alias("at"), F.get(lines, m["no"]).alias("line")))
        return let(spans(fenced), lambda closed: with_fences(marked, closed))

    def with_fences(marked: Column, closed: Column) -> Column:
        open_at = lambda i: ~F.exists(closed, lambda s: (s["first"] <= i) & (i <= s["last"]))
        level = lambda m, mark: m["line"].startswith(mark) & ~m["line"].startswith(f"{mark}#")
        heads = F.filter(F.transform(marked, lambda m: F.when(level(m, "##") & open_at(m["no"]), F.struct(m["no"].alias("no"), F.trim(_whole(m["line"], H2, 1), space).alias("heading")))), lambda h: h["heading"] != "")
        tops = F.filter(F.transform(marked, lambda m: F.when(level(m, "#"), F.struct(m["no"].alias("no"), m["line"].alias("line"), _whole(m["line"], H1, 1).alias("title")))), lambda t: t["title"] != "")
        return let(heads, lambda hs: let(F.get(tops, F.lit(0)), lambda top: with_sections(hs, top)))

    def with_sections(heads: Column, top: Column) -> Column:
        end = lambda k: F.coalesce(F.get(heads, k)["no"], F.size(lines))
        of = lambda all_, h, k: F.slice(all_, h["no"] + 2, end(k + 1) - h["no"] - 1)
        sections = F.transform(heads, lambda h, k: F.struct(h["heading"].alias("heading"), of(lines, h, k).alias("body"), of(bare, h, k).alias("bare")))
        first = end(F.lit(0))
        about = F.when(top["no"] < first, F.filter(F.slice(bare, top["no"] + 2, first - top["no"] - 1), lambda x: x != ""))
        return let(sections, lambda ss: F.struct(space.alias("space"), F.coalesce(top["title"], F.lit("")).alias("title"), F.when(top["no"] < first, top["line"]).alias("top"), about.alias("about"), ss.alias("sections"), _titles(under(ss, "4.", "bare")).alias("titles")))

    return let(marked, with_marks)


def under(sections: Column, start: str, lines: str = "body") -> Column:
    """The lines of all sections whose heading begins so."""
    return F.flatten(F.transform(F.filter(sections, lambda s: s["heading"].startswith(start)), lambda s: s[lines]))


def _titles(evidence: Column) -> Column:
    each = F.filter(_some(evidence, lambda x, i: F.when(x.startswith("###"), F.struct(i.alias("no"), _groups(x, EVIDENCE, "$1\n$2").alias("of")))), lambda t: F.size(t["of"]) == 2)
    return F.reverse(F.transform(each, lambda t: F.struct(t["no"].alias("no"), F.get(t["of"], F.lit(0)).alias("ref"), F.get(t["of"], F.lit(1)).alias("title"))))


def items(sections: Column, kind: str, space: Column | None = None) -> Column:
    """The items (id, done, title, owner, when, refs, broken) of the first section of a kind, ACTIONS or OPENS. The next line that isn't blank tells
    of owner, time and evidence; an item without is broken. A line that was taken so begins no item."""
    form = ACTION_LINE if kind == ACTIONS else OPEN_LINE
    stripped = lambda x: F.trim(x, F.lit(SPACE) if space is None else space)
    bare = F.coalesce(_first(sections, lambda s: F.contains(s["heading"], F.lit(kind)))["bare"], F.array().cast("array<string>"))
    kept = "array<struct<no: int, of: array<string>>>"

    def step(acc: Column, x: Column) -> Column:
        return F.when(F.get(acc, F.size(acc) - 1)["no"] == x["no"] - 1, acc).otherwise(F.concat(acc, F.array(x)))

    def of(filled: Column) -> Column:
        begun = F.filter(_some(filled, lambda x, i: F.when(x.startswith("-"), F.struct(i.alias("no"), _groups(x, form, "$2\n$1\n$3").alias("of")))), lambda x: F.size(x["of"]) == 3)
        return F.transform(F.aggregate(begun, F.array().cast(kept), step), lambda x: item(x, F.coalesce(F.get(filled, x["no"] + 1), F.lit(""))))

    def item(x: Column, next_: Column) -> Column:
        about = let(next_, lambda n: F.when(n.startswith("-") & n.rlike(r"(?U)^-\s*\["), F.lit("")).otherwise(n)) if kind == ACTIONS else next_
        told = lambda parts: F.struct(
            F.get(x["of"], F.lit(0)).alias("id"), F.get(x["of"], F.lit(1)).isin("x", "X").alias("done"), stripped(F.get(x["of"], F.lit(2))).alias("title"), F.get(parts, F.lit(0)).alias("owner"),
            F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), " · ").alias("when"),
            F.array_distinct(F.regexp_extract_all(F.get(parts, F.size(parts) - 1), F.lit(f"(?U){REF}"), F.lit(1))).alias("refs"), (F.size(parts) < 3).alias("broken"),
        )
        return let(F.transform(F.split(F.replace(about, F.lit(" · "), F.lit("\n")), "\n"), stripped), told)

    return let(F.filter(bare, lambda x: x != ""), of)


def _linked(ref: Column, title: Column) -> Column:
    name = F.concat(ref, F.lit(" "), title)
    bare = F.translate(F.trim(F.regexp_replace(name, "[^0-9A-Za-z가-힣 -]+", "")), CAPITALS, CAPITALS.lower())
    return F.concat(F.lit("["), name, F.lit("](#"), F.regexp_replace(bare, "[ -]+", "-"), F.lit(")"))


def links(titles: Column) -> Column:
    """for each title of evidence (ref, title) the link to it."""
    return F.transform(titles, lambda t: F.struct(t["ref"].alias("ref"), _linked(t["ref"], t["title"]).alias("link")))


def link(links: Column, ref: Column) -> Column:
    """a link to the heading of a piece of evidence."""
    return F.coalesce(_first(links, lambda t: t["ref"] == ref)["link"], _linked(ref, F.lit(NO_TITLE)))


def expanded(line: Column, links: Column) -> Column:
    """F16: a text in which each § number of evidence is a link."""
    refs = F.regexp_extract_all(line, F.lit(f"(?U){REF}"), F.lit(1))
    rest = F.split(line, f"(?U){REF}")
    return let(refs, lambda rs: F.array_join(F.transform(rest, lambda x, i: F.concat(x, F.coalesce(link(links, F.get(rs, i)), F.lit("")))), ""))


def _broken(items: Column) -> Column:
    return F.exists(items, lambda x: x["broken"])


def _of_parts(text: Column, of: Callable[[Column, Column, Column], Column]) -> Column:
    """A column of a note's parts, its actions and its open questions; null for null."""
    made = lambda n: let(items(n["sections"], ACTIONS, n["space"]), lambda acts: let(items(n["sections"], OPENS, n["space"]), lambda opens: of(n, acts, opens)))
    return let(text, lambda t: F.when(t.isNotNull(), let(taken_apart(t), made)))


def readable_text(text: Column, marker: Column) -> Column:
    """A note as people read it: metadata quoted, items on one line each with links to their evidence, sections parted
    by rules. ``marker`` is a picture's place before the actions, null or empty for none. Null for a note that is null, has no title before its
    sections, no sections, or a broken item."""

    def line(to: Column, kind: str) -> Callable[[Column], Column]:
        owner, when, why = LABELS[kind]

        def one(x: Column) -> Column:
            box = F.when(x["done"], "[x] ").otherwise("[ ] ") if kind == ACTIONS else F.lit("")
            refs = F.when(F.size(x["refs"]) == 0, F.lit(NO_REFS)).otherwise(F.array_join(F.transform(x["refs"], lambda r: link(to, r)), ", "))
            return F.concat(F.lit("- "), box, F.lit("**"), x["id"], F.lit(" · "), x["title"], F.lit(f"** — **{owner}** · "), x["owner"], F.lit(f" · **{when}** · "), x["when"], F.lit(f" · **{why}** · "), refs)

        return one

    def form(n: Column, acts: Column, opens: Column) -> Column:
        of_acts = lambda s: F.contains(s["heading"], F.lit(ACTIONS)) & (F.size(acts) > 0)
        of_opens = lambda s: ~of_acts(s) & F.contains(s["heading"], F.lit(OPENS))
        place = F.when(F.coalesce(marker, F.lit("")) != "", F.concat(marker, F.lit("\n\n"))).otherwise("")

        def block(s: Column, to: Column) -> Column:
            def shown(body: Column) -> Column:
                told = F.when(s["heading"].startswith("1.") & F.contains(body, F.lit("§")), expanded(body, to)).otherwise(body)
                return F.when(body != "", F.concat(F.lit("\n\n"), told)).otherwise("")

            told = (
                F.when(of_acts(s), F.concat(F.lit("\n\n"), place, F.array_join(F.transform(acts, line(to, ACTIONS)), "\n"))).when(of_opens(s) & (F.size(opens) > 0), F.concat(F.lit("\n\n"), F.array_join(F.transform(opens, line(to, OPENS)), "\n")))
                .otherwise(let(F.rtrim(F.regexp_replace(F.array_join(s["body"], "\n"), r"(?U)\A\s*\n", ""), F.concat(n["space"], F.lit("\n"))), shown))
            )
            return F.concat(F.lit("## "), s["heading"], told)

        def whole(to: Column) -> Column:
            quoted = F.when(F.size(n["about"]) > 0, F.concat(F.lit("> "), F.array_join(n["about"], "\n> "), F.lit("\n"))).otherwise("")
            return F.concat(n["top"], F.lit("\n\n"), quoted, F.lit("\n"), F.array_join(F.transform(n["sections"], lambda s: block(s, to)), "\n\n---\n\n"), F.lit("\n"))

        bad = (F.exists(n["sections"], lambda s: F.contains(s["heading"], F.lit(ACTIONS))) & _broken(acts)) | (F.exists(n["sections"], of_opens) & _broken(opens))
        return F.when((F.size(n["sections"]) > 0) & n["top"].isNotNull() & ~bad, let(links(n["titles"]), whole))

    return _of_parts(text, form)


def picture_of(text: Column, parts: tuple[tuple[str, str], ...] = PARTS) -> Column:
    """Of the four kinds of pictures the one that most speaks for, the first if equal: kind, score and nodes (id, label, detail, ref); nulls if
    nothing does, or an item is broken. ``parts``: what a system consists of, by name and pattern; a house adds its own."""
    node = lambda i, label, detail, ref: F.struct(i.alias("id"), label.alias("label"), detail.alias("detail"), ref.alias("ref"))
    there = lambda values: F.filter(F.array(*values), lambda x: x.isNotNull())

    def heading(n: Column, pattern: str) -> Column:
        """The evidence heading that the first line with the pattern stands under."""
        at = F.array_min(F.transform(under(n["sections"], "4."), lambda x, i: F.when(_met(x, pattern), i)))
        return let(at, lambda a: F.coalesce(let(_first(n["titles"], lambda t: t["no"] <= a), lambda t: F.concat(t["ref"], F.lit(" "), t["title"])), F.lit("")))

    def rollout(n: Column, told: Column) -> Column:
        place = lambda p: F.regexp_instr(told, F.lit(f"(?iuU){p}"))
        stages = F.array_sort(there(F.when(_met(told, p), F.struct(place(p).alias("at"), F.lit(k).alias("k"), F.lit(label).alias("label"))) for k, (label, p) in enumerate(STAGES)))

        def one(s: Column, i: Column) -> Column:
            detail = F.coalesce(*(F.when(s["k"] == k, F.regexp_extract(told, f"(?iuU){p}", 0)) for k, (_, p) in enumerate(STAGES)))
            ref = F.coalesce(*(F.when(s["k"] == k, heading(n, p)) for k, (_, p) in enumerate(STAGES)))
            return node(F.concat(F.lit("S"), (i + 1).cast("string")), s["label"], detail, ref)

        def scored(met: Column) -> Column:
            strong = F.size(F.filter(met, lambda s: s["label"].isin(*STRONG)))
            titled = F.regexp_count(n["title"], F.lit(f"(?iuU){'|'.join(STRONG)}"))
            return F.when((F.size(met) >= 4) & (strong >= 2), kind("rollout-map", 0, 3 * F.size(met) + 2 * strong + 4 * titled, F.transform(met, one)))

        return let(stages, scored)

    def system(n: Column, told: Column) -> Column:
        seen = there(F.when(_met(told, p), F.struct(F.lit(k).alias("k"), F.lit(name).alias("name"))) for k, (name, p) in enumerate(parts))
        links = F.regexp_count(told, F.lit(f"(?iuU){CONNECTED}"))
        one = lambda s: node(s["name"], s["name"], F.lit(""), F.coalesce(*(F.when(s["k"] == k, heading(n, p)) for k, (_, p) in enumerate(parts))))

        def scored(seen: Column) -> Column:
            layers = F.size(F.filter(seen, lambda s: s["name"].startswith("layer")))
            return F.when((F.size(seen) >= 6) & (layers >= 2) & (links >= 2), kind("system-map", 1, 2 * F.size(seen) + 4 * layers + F.least(links, F.lit(6)), F.transform(seen, one)))

        return let(seen, scored)

    of_item = lambda x: node(x["id"], x["title"], x["when"], F.coalesce(F.get(x["refs"], F.lit(0)), F.lit("")))

    def milestones(acts: Column) -> Column:
        days = lambda x: F.regexp_extract_all(x["when"], F.lit(f"(?U){DATES}"), F.lit(0))
        told = lambda dated: let(F.size(F.array_distinct(F.flatten(F.transform(dated, days)))), lambda n: F.when((F.size(dated) >= 3) & (n >= 2), kind("milestone-timeline", 2, 3 * F.size(dated) + 2 * n, F.transform(dated, of_item))))
        return let(F.filter(acts, lambda x: F.size(days(x)) > 0), told)

    def decisions(opens: Column) -> Column:
        chosen = F.size(F.filter(opens, lambda x: x["title"].rlike(f"(?U){CHOICES}")))
        return let(chosen, lambda n: F.when(n >= 5, kind("decision-map", 3, 3 * n, F.transform(opens, of_item))))

    def kind(name: str, order: int, score: Column, nodes: Column) -> Column:
        return F.struct(score.cast("int").alias("score"), F.lit(-order).alias("order"), F.lit(name).alias("kind"), nodes.cast(NODES).alias("nodes"))

    def best(n: Column, acts: Column, opens: Column) -> Column:
        of_section = lambda s: F.when(s["heading"].startswith("1."), s["body"]).when(s["heading"].startswith("4."), F.filter(s["body"], lambda x, i: F.get(s["bare"], i).startswith("### "))).otherwise(F.array().cast("array<string>"))
        told = F.array_join(F.concat(F.array(n["title"]), F.flatten(F.transform(n["sections"], of_section))), "\n")
        made = let(told, lambda t: F.array_max(there((rollout(n, t), system(n, t), milestones(acts), decisions(opens)))))
        return F.when(~_broken(acts) & ~_broken(opens), made)

    return let(_of_parts(text, best), lambda p: F.struct(p["kind"].alias("kind"), p["score"].alias("score"), p["nodes"].alias("nodes")))


def projected(notes: DataFrame, marker: Column | None = None) -> DataFrame:
    """Notes (note_key, text) with their readable form."""
    return notes.withColumn("readable", readable_text(F.col("text"), F.lit("") if marker is None else marker))


def faithful(notes: DataFrame, marker: Column | None = None) -> DataFrame:
    """Whether the readable form that is there (``candidate``) is exactly the note's."""
    made = projected(notes, marker)
    return made.select("note_key", F.coalesce(F.col("readable") == F.col("candidate"), F.lit(False)).alias("faithful"))
