"""Streaming steps, sinks, fact checks, readable notes and batch audits on fixtures."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.operators import batch, identity, intervals, readable, review
from parley.operators import state as states
from parley.plans.notes import BROKEN, FACT_NOTE, NOTE
from parley.sources import sinks
from parley.streaming import watch


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# ---- streaming and sinks ----


def test_versions_keep_history(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    read = lambda n: sorted(tuple(r) for r in spark.read.parquet(f"{path}/current={n}").collect())
    assert watch.merged_version(frame(("a", 1), ("b", 2)), 0, path, "k")
    assert not watch.merged_version(frame(("a", 1)), 1, path, "k")  # nothing new: nothing written
    assert watch.versions(spark, path) == [0]
    assert watch.merged_version(frame(("b", 3), ("b", 1), ("c", None)), 2, path, "k") and read(2) == [("a", 1), ("b", 3), ("c", None)]
    assert watch.merged_version(frame(("b", 3), ("b", 1), ("c", None)), 2, path, "k") and read(2) == [("a", 1), ("b", 3), ("c", None)]  # a batch that is tried again
    assert watch.merged_version(frame(("d", 1)), 5, path, "k") and watch.versions(spark, path) == [2, 5]
    with pytest.raises(RuntimeError):
        watch.merged_version(frame(("a", 1)), 3, str(tmp_path / "other"), "k")


def test_upsert_stream(spark, tmp_path):
    for i, rows in enumerate(([("a", 1), ("b", 2)], [("b", 5)], [("b", 5)])):
        (tmp_path / f"in{i}").mkdir()
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = watch.watched(spark, str(tmp_path / "in"), "k string, v int", 1)
        watch.upserted(stream, str(tmp_path / "out"), "k", str(tmp_path / "cp")).awaitTermination()
    last = watch.versions(spark, str(tmp_path / "out"))
    assert last == [0, 1] and sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/current=1").collect()) == [("a", 1), ("b", 5)]


def test_feedback_uses_earlier_notes_only(spark, tmp_path):
    for rows in ([("n1", "T", "v"), ("n1", "T", "w")], [("n2", "T", "v"), ("n2", "U", "x")], [("n3", "T", "v")]):
        spark.createDataFrame(rows, "note string, target string, variant string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = watch.watched(spark, str(tmp_path / "in"), "note string, target string, variant string", 1)
        watch.fed_back(stream, str(tmp_path / "fb"), str(tmp_path / "cp")).awaitTermination()
    ledger = lambda n: sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/fb/ledger/batch={n}").collect())
    assert ledger(0) == [] and ledger(1) == [("T", "v", 1), ("T", "w", 1)] and ledger(2) == [("T", "v", 2), ("T", "w", 1), ("U", "x", 1)]


def test_stream_is_classified_by_rules_of_now(spark, tmp_path):
    items = spark.createDataFrame([("Sales-1",), ("salesforce",), ("ops",), ("x",)], "name string")
    rules = spark.createDataFrame([(1, "sales", "s"), (0, "SALESF", "f"), (2, "op", "o"), (3, "sales", "never")], "idx int, prefix string, project string")
    want = {"Sales-1": "s", "salesforce": "f", "ops": "o", "x": "unsorted"}
    assert {r.name: r.project for r in watch.classified(items, rules, "name").collect()} == want
    items.write.json(str(tmp_path / "in"))
    stream = watch.classified(watch.watched(spark, str(tmp_path / "in"), "name string"), rules, "name")
    q = stream.writeStream.format("memory").queryName("classified_items").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.name: r.project for r in spark.table("classified_items").collect()} == want


def test_jobs_advance(spark):
    jobs = spark.createDataFrame([("a", "note"), ("b", "review"), ("c", "note"), ("e", "note")], "key string, stage string")
    events = spark.createDataFrame([("a", 1, "noted"), ("a", 2, "reviewed"), ("b", 1, "failed"), ("c", 2, "noted"), ("c", 1, "reviewed"), ("d", 1, "recorded")], "key string, seq long, kind string")
    assert {r.key: r.stage for r in watch.advanced(jobs, events).collect()} == {"b": "review", "c": "review", "d": "note", "e": "note"}


def test_promotion_keeps_a_backup(spark, tmp_path):
    path, staged = str(tmp_path / "p"), str(tmp_path / "s")
    spark.range(3).write.parquet(path)
    spark.range(5).write.parquet(staged)
    sinks.promoted(spark, staged, path, str(tmp_path / "b"))
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(str(tmp_path / "b")).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.promoted(spark, str(tmp_path / "none"), path)
    assert spark.read.parquet(path).count() == 5
    for n in (1, 2):
        sinks.transcripts(spark.createDataFrame([(f"m{n}", "x\ny")], "meeting string, transcript string"), str(tmp_path / "t"))
    assert {r.meeting for r in spark.read.text(str(tmp_path / "t")).collect()} == {"m2"} and not list(tmp_path.glob("t.*"))


# ---- text ----


def test_wrapped_lines(spark):
    cases = {"": [""], "a b": ["a b"], "alpha beta gamma": ["alpha beta", "gamma"], "alpha beta gamma delta": ["alpha beta", "gamma…"], "x" * 30: ["x" * 30], "one two three four five six": ["one two", "three…"]}
    for text, want in cases.items():
        assert one(spark, T.wrapped(F.lit(text), 10)) == want, text
    assert one(spark, T.shortened(F.lit("abcdef"), 4)) == "abc…"
    assert one(spark, T.string_list(F.array(F.lit(" a  b "), F.lit(" "), F.lit("cdefg")), 3)) == ["a b", "cde…"]
    stripped = one(spark, T.without_facts(F.lit(FACT_NOTE)))
    assert stripped == NOTE and one(spark, T.without_facts(F.lit(NOTE))) == NOTE
    assert one(spark, T.note_hash(F.lit(FACT_NOTE))) == one(spark, T.note_hash(F.lit(NOTE)))


# ---- readable notes ----


def note(actions=(), opens=(), first="", evidence=("일정", "예산 (안)")):
    acts = "".join(f"- [{'x' if done else ' '}] **A{i} · {title}**\n  {about}\n" for i, (done, title, about) in enumerate(actions, 1))
    open_ = "".join(f"- **M{i} · {title}**\n\n  {about}\n" for i, (title, about) in enumerate(opens, 1))
    heads = "".join(f"### 4.{i} {t}\n\n- 말\n" for i, t in enumerate(evidence, 1))
    return f"# 회의\n날짜 · 장소\n\n## 1. 핵심\n{first}\n## 2. Action Items\n\n{acts}\n## 3. 미결 쟁점\n\n{open_}\n## 4. 상세\n\n{heads}"


def form(spark, text, marker=None):
    return one(spark, readable.readable_text(F.lit(text), F.lit(marker)))


def picture(spark, text, *parts):
    p = one(spark, readable.picture_of(F.lit(text), *parts))
    return None if p.kind is None else (p.kind, p.score, p.nodes)


def test_readable_form(spark):
    text = note([(True, "표", "홍 · 5월 1일 · 낮 · §4.1, §4.9"), (False, "글", "김 · 없음 · 근거 없음")], [("예산", "미정 · 다음 · §4.2")], "- 확정 §4.2")
    assert form(spark, text, "![p](x)") == (
        "# 회의\n\n> 날짜 · 장소\n\n## 1. 핵심\n\n- 확정 [4.2 예산 (안)](#42-예산-안)\n\n---\n\n## 2. Action Items\n\n![p](x)\n\n"
        "- [x] **A1 · 표** — **담당** · 홍 · **일정** · 5월 1일 · 낮 · **근거** · [4.1 일정](#41-일정), [4.9 근거](#49-근거)\n- [ ] **A2 · 글** — **담당** · 김 · **일정** · 없음 · **근거** · 확인 필요\n\n---\n\n"
        "## 3. 미결 쟁점\n\n- **M1 · 예산** — **담당** · 미정 · **결정 시점** · 다음 · **근거** · [4.2 예산 (안)](#42-예산-안)\n\n---\n\n## 4. 상세\n\n### 4.1 일정\n\n- 말\n### 4.2 예산 (안)\n\n- 말\n"
    )
    for bad in ("## 1. x\n", "# t\nno sections", note([(True, "표", "홍 · 5월")])):
        assert form(spark, bad) is None
    fenced = "# t\n## 1. a\n```\n## not\n~~~\n```\n## b\n~~~\n## never closed\n"
    assert [x.heading for x in one(spark, readable.taken_apart(F.lit(fenced))).sections] == ["1. a", "b"]
    assert form(spark, fenced.replace("\n", "\r\n")) == "# t\n\n\n## 1. a\n\n```\n## not\n~~~\n```\n\n---\n\n## b\n\n~~~\n## never closed\n"


def test_items_of_notes(spark):
    opens = "# t\n## 3. 미결 쟁점\n- **M1 · 가 · 나**\n- **M2 · 다 · 라**\n- **M3 · 마**\n\n  홍 · 낮 · §4.1§4.12 §4.1\n## 4. 미결 쟁점\n## 4. b\n### 4.1 옛\n### 4.1 새\n"
    found = one(spark, readable.let(readable.taken_apart(F.lit(opens)), lambda n: readable.items(n["sections"], readable.OPENS)))
    # the line of M2 tells of M1, so it begins no item
    assert [(x.id, x.title, x.owner, x.when, x.refs, x.broken) for x in found] == [("M1", "가 · 나", "- **M2", "다", [], False), ("M3", "마", "홍", "낮", ["4.1", "4.12"], False)]
    line = "- **M3 · 마** — **담당** · 홍 · **결정 시점** · 낮 · **근거** · [4.1 새](#41-새), [4.12 근거](#412-근거)"
    assert form(spark, opens).count(line) == 2  # of two sections of a kind both show the first one's items, and the last title of a number counts
    assert form(spark, "# t\n## 2. Action Items\n- [ ] **A1 · 가**\n- [ ] **A2 · 나**\n  a · b · c\n") is None
    assert form(spark, "# t\n## 1. a\n\n  §4.2, §4.20.\n\n## 4. b\n### 4.2 c d!\n") == "# t\n\n\n## 1. a\n\n  [4.2 c d!](#42-c-d), [4.20 근거](#420-근거).\n\n---\n\n## 4. b\n\n### 4.2 c d!\n"


def test_pictures(spark):
    assert picture(spark, note()) is None and picture(spark, None) is None and picture(spark, "") is None
    dated = [(False, f"일{i}", f"홍 · 5월 {i % 2 + 1}일 · §4.1") for i in range(3)]
    kind, score, nodes = picture(spark, note(dated))
    assert (kind, score, [n.id for n in nodes], nodes[0].ref) == ("milestone-timeline", 3 * 3 + 2 * 2, ["A1", "A2", "A3"], "4.1")
    asked = [(f"무엇을 할지 {i}", "미정 · 다음 · §4.2") for i in range(5)]
    assert picture(spark, note(opens=asked))[:2] == ("decision-map", 15)
    assert picture(spark, note(dated, asked))[0] == "decision-map"
    assert picture(spark, note(opens=asked[:4])) is None
    rollout = note(first="- 파일럿 뒤 공개하고 온보딩, 검증 후 확산", evidence=("파일럿", "확산"))
    kind, score, nodes = picture(spark, rollout)
    assert (kind, score) == ("rollout-map", 5 * 3 + 4 * 2) and [n.label for n in nodes] == ["파일럿", "공개", "온보딩", "품질 검증", "확산"] and nodes[0].ref == "4.1 파일럿" and [n.id for n in nodes] == [f"S{i}" for i in range(1, 6)]
    kind, score, nodes = picture(spark, note(first="- Layer 1, Layer 2, MCP, Skill, Control Plane, marketplace 연결 구조"))
    assert (kind, score) == ("system-map", 6 * 2 + 2 * 4 + 4) and {n.id for n in nodes} == {"layer1", "layer2", "control-plane", "mcp", "skill", "marketplace"}
    assert picture(spark, note(first="- Layer 1, Layer 2, MCP, Skill, Gaon, marketplace 연결 구조"), (*readable.PARTS, ("gaon", "Gaon")))[0] == "system-map"


def test_readable_columns(spark):
    texts = [("a", note([(True, "표", "홍 · 낮 · §4.1")])), ("b", "no note"), ("c", None)]
    made = readable.projected(spark.createDataFrame(texts, "note_key string, text string"), F.lit("![p](x)"))
    got = {r.note_key: r.readable for r in made.collect()}
    assert got == {"a": form(spark, texts[0][1], "![p](x)"), "b": None, "c": None}
    same = made.withColumn("candidate", F.when(F.col("note_key") == "a", F.col("readable")).otherwise("x"))
    assert {r.note_key: r.faithful for r in readable.faithful(same.drop("readable"), F.lit("![p](x)")).collect()} == {"a": True, "b": False, "c": False}


# ---- fact checks ----

SOURCES = "array<struct<title: string, url: string, source_type: string, locator: string, why_relevant: string>>"


def evidence(spark, *rows):
    base = {"meeting": "m", "verdict": "verified", "corrected_fact": "", "explanation": "맞다", "error_type": "none", "confidence": "high", "valid_as_of": "2024", "sources": [("t", "https://a.example/x", "official_primary", "p1", "관련")]}
    kind = f"meeting string, candidate_id string, verdict string, corrected_fact string, explanation string, error_type string, confidence string, valid_as_of string, sources {SOURCES}"
    names = [x.split()[0] for x in kind.split(f", sources")[0].split(", ")] + ["sources"]
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], kind)


def test_evidence_rules(spark):
    weak = lambda *urls: [("t", u, "reliable_secondary", "p", "관련") for u in urls]
    cases = {
        "C1": ({}, []), "C2": ({"verdict": "speaker_conflict"}, ["bad verdict"]), "C3": ({"explanation": "yes"}, ["explanation not Korean"]), "C4": ({"sources": []}, ["verdict without sources"]),
        "C5": ({"verdict": "contradicted", "corrected_fact": "셋", "sources": weak("https://a.example", "https://b.example")}, []), "C6": ({"verdict": "contradicted", "corrected_fact": "셋", "sources": weak("https://a.example", "https://a.example/2")}, ["contradicted on one weak source"]),
        "C7": ({"verdict": "contradicted", "confidence": "low"}, ["contradicted without high confidence", "contradicted without the fact"]), "C8": ({"sources": weak("https://google.com/search")}, ["source not a direct https address"]),
        "C9": ({"sources": [("t", "", "deterministic", " ", "관련")]}, ["deterministic source without evidence", "source without locator"]), "C10": ({"verdict": "not_assessable", "sources": [], "error_type": "x", "confidence": None}, ["bad error type", "bad confidence"]),
        "X": ({}, ["unknown candidate"]),
    }
    asked = spark.createDataFrame([("m", f"C{i}") for i in range(1, 12)], "meeting string, candidate_id string")
    got = {r.candidate_id: r.errors for r in review.evidence_errors(evidence(spark, *({"candidate_id": k} | c for k, (c, _) in cases.items())), asked).collect()}
    assert got == {k: want for k, (_, want) in cases.items()}
    twice = review.evidence_errors(evidence(spark, {"candidate_id": "C1"}, {"candidate_id": "C1"}), asked).collect()
    assert [r.errors for r in twice] == [["more than one result"]] * 2


def test_merge_and_lines(spark):
    kind = "id string, speaker string, start_seconds double, end_seconds double, claim_text string, checkability string, stt_risk boolean, counterpart_claims array<struct<speaker: string, start_seconds: double, claim_text: string>>"
    rows = [("C1", "A", 3.0, 4.0, 'x "y"', "public_web", True, []), ("C2", "B", 3700.5, 4.0, "z", "speaker_conflict", False, [("A", 1.0, "w")]), ("C3", "A", 1.0, 2.0, "i", "internal_authority", True, []), ("C4", "A", 1.0, 2.0, "n", "public_web", False, []), ("C5", "A", 1.0, 2.0, "c", "deterministic", True, [])]
    ev = evidence(spark, {"candidate_id": "C1", "verdict": "contradicted", "corrected_fact": "셋"}, {"candidate_id": "C5"}, {"candidate_id": "C2"}).drop("meeting")
    audio = spark.createDataFrame([("C5", "confirmed"), ("C1", "uncertain"), ("C2", "confirmed")], "candidate_id string, status string")
    checked = review.merged(spark.createDataFrame(rows, kind), ev, audio)
    got = {r.id: r for r in checked.collect()}
    assert {k: (r.verdict, r.confidence, r.audio) for k, r in got.items()} == {"C1": ("stt_review_needed", "low", "uncertain"), "C2": ("speaker_conflict", "low", None), "C3": ("not_assessable", "low", None), "C4": ("not_assessable", "low", None), "C5": ("verified", "high", "confirmed")}
    assert got["C1"].explanation == review.MISHEARD + "맞다" and got["C3"].explanation == review.INTERNAL and got["C4"].explanation == review.NOT_FOUND and got["C2"].sources == []
    unseen = {r.id: r.explanation for r in review.merged(spark.createDataFrame(rows, kind), ev, audio, F.lit(False)).collect()}
    assert unseen["C1"] == review.UNOBSERVED and unseen["C2"] == review.CONFLICT
    lines = {r.id: r.lines for r in review.item_lines(checked.withColumn("number", F.substring("id", 2, 1).cast("int"))).collect()}
    assert lines["C1"][:3] == ["### F1. STT 확인 필요", "- 발언: “x ”y””", "- 위치: 화자 A · 00:00:03"] and lines["C1"][-2:] == ["- 오디오 재검증: 구간 재전사로도 불명확", "- STT 확인: 원음 재청취 필요"]
    assert "- 상충 발언: “w” · 화자 A · 00:00:01" in lines["C2"] and "- 근거: [t](https://a.example/x) — p1; 관련" in lines["C5"] and "- 확신도: 높음" in lines["C5"]


def test_quality_evaluation(spark):
    kind = "id string, reference string, hypothesis string, reviewed boolean, reviewer string, evidence string, critical map<string, array<string>>, speaker_labels array<struct<reference: string, hypothesis: string>>"
    ok = ("a b c d", "a b c d", True, "r", "e", {"numbers": ["b c"]}, [("A", " A ")])
    rows = [("ok", *ok), ("none", None, None, True, "r", "e", None, None), ("unread", *ok[:3], " ", *ok[4:]), ("lexical", "a 10 b", "a 100 b", True, "r", "e", {"numbers": ["10"]}, None), ("speaker", *ok[:6], [("A", "B")]), ("wer", "a b c d", "a b c x", True, "r", "e", None, None)]
    cases = spark.createDataFrame(rows, kind)
    import hashlib

    def verdicts(limits):
        found = {r.id_sha256: r.verdict for r in review.evaluated(cases, limits).collect()}
        return {r[0]: found[hashlib.sha256(r[0].encode()).hexdigest()] for r in rows}

    assert verdicts({"wer": 0.5, "cer": 0.9}) == {"ok": "gated_pass", "none": "not_evaluated", "unread": "not_reviewed", "lexical": "gated_fail", "speaker": "gated_fail", "wer": "gated_pass"}
    assert verdicts({"wer": 0.2})["wer"] == "gated_fail" and set(verdicts({}).values()) == {"measured_not_gated", "not_evaluated", "not_reviewed"}
    lacks = {(r.id, r.category): (r.phrases, r.present, r.missing, r.reference_lacks) for r in review.critical_counts(cases.filter("critical is not null")).collect()}
    assert lacks["lexical", "numbers"] == (1, 0, 1, 0) and lacks["ok", "numbers"] == (1, 1, 0, 0)


def test_rates_without_a_distance_add_no_units(spark):
    rated = spark.createDataFrame([("g", 2, 10, 1, 4), ("g", None, 90, None, 50)], "lang string, char_distance int, char_units int, word_distance int, word_units int")
    assert tuple(review.micro(rated, ["lang"]).first()) == ("g", 2, 0.2, 0.25)


# ---- batch audit, ledgers, state ----


def test_batch_audit(spark):
    good = form(spark, NOTE)
    rows = [
        ("ok", NOTE, True, ["홍길동"], good, True, True, True), ("source", NOTE, False, ["홍길동", "이서연"], good, True, True, False), ("refs", NOTE.replace("§4.1", "§4.7"), True, [], None, None, True, True),
        ("stale", NOTE, True, None, good + "[x](#none)\n" + "줄\n" * 3, False, False, True), ("dense", NOTE.replace("일정표 공유", "가" * 91), True, [], "줄\n" * 70 + "## 4. 상세 논의와 근거\n", True, True, True),
    ]
    kind = "note_key string, text string, transcript boolean, confirmed array<string>, candidate string, faithful boolean, assets boolean, review boolean"
    got = {r.note_key: (r.status, r.errors, r.warnings) for r in batch.audited(spark.createDataFrame(rows, kind)).collect()}
    assert got["ok"] == ("pass", [], [])
    assert got["source"] == ("fail", ["no transcript", "attendees missing: 이서연", "no review"], [])
    assert got["refs"] == ("fail", ["evidence missing: 4.7", "no readable form"], [])
    assert got["stale"] == ("fail", ["readable form differs", "broken links: #none", "pictures missing or changed"], [])
    assert got["dense"] == ("pass", [], ["first screen is dense", "long action titles: 1"])


def test_receipt_shape(spark):
    base = {"schema_version": 1} | {f: "x" for f in states.READINESS} | {"review_artifacts": {a: "h" for a in states.ARTIFACTS}}
    kind = "struct<schema_version: int, " + ", ".join(f"{f}: string" for f in states.READINESS) + ", review_artifacts: map<string, string>>"
    cases = [(base, True), (base | {"schema_version": 2}, False), (base | {"review_dir": ""}, False), (base | {"review_artifacts": {"review.md": "h"}}, False), (base | {"review_artifacts": {a: "" for a in states.ARTIFACTS}}, False), ({}, False)]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, j string").select("i", F.from_json("j", kind).alias("r"))
    assert [r.ok for r in df.orderBy("i").select(states.receipt_shape(F.col("r")).alias("ok")).collect()] == [w for _, w in cases]


def test_phonetic_hints(spark):
    """Candidates against all pairs by hand, addressed tokens first; the roster name itself is no candidate."""
    from difflib import SequenceMatcher  # noqa: F401  (similarity here is by edits, not blocks)

    def letters(s):
        return one(spark, T.jamo(F.lit(s)))

    roster = [("김민준", "팀", "매니저", "active"), ("김민지", "팀", "", "former"), ("박서연", "부", "", "unverified"), ("남궁민수", "과", "", "active")]
    text = "김민중님 그리고 박서영씨와 김민준 씨가 남궁민소 말했다 김민중님"
    got = identity.phonetic_hints(spark.createDataFrame([("n", text)], "note string, text string"), spark.createDataFrame(roster, "name string, department string, position string, employment_status string"))
    rows = {r.token: r for r in got.collect()}
    from parley.functions.text import edits

    def best(token, floor):
        out = []
        for name, dept, pos, status in roster:
            a, forms = letters(token), {letters(name), letters(one(spark, T.given_name(F.lit(name))))}
            sim = max(1 - edits(a, f) / max(len(a), len(f)) for f in forms)
            if token != name and sim >= floor:
                out.append((-sim, name, f"{name}({dept}{', ' + pos if pos else ''}{ {'former': ' · 퇴사', 'unverified': ' · 재직 미확인'}.get(status, '')}) 유사도 {sim:.2f}"))
        return ", ".join(x for *_, x in sorted(out)[:2])

    assert rows["김민중"].addressed and rows["김민중"].candidates == best("김민중", 0.72) and rows["박서영"].candidates == best("박서영", 0.72)
    assert rows["남궁민소"].candidates == best("남궁민소", 0.86) and not rows["남궁민소"].addressed
    assert rows["김민중"].rank < rows["남궁민소"].rank and "김민준" not in rows


def test_simultaneous_equals_all_pairs(spark):
    r = random.Random(11)
    turns = [(0, i, r.choice(["A", "B", "C", None]), s := r.randint(0, 300), s + r.randint(0, 30)) for i in range(300)]
    words = [(0, i, s := r.randint(0, 300), s + r.randint(0, 20)) for i in range(200)]
    got = {x.word: x.simultaneous for x in intervals.simultaneous(spark.createDataFrame(words, "meeting int, word int, ws long, we long"), spark.createDataFrame(turns, "meeting int, turn int, speaker string, ts long, te long"), 40).collect()}
    for _, w, a, z in words:
        inside = [(s, max(a, x), min(z, y)) for _, _, s, x, y in turns if s and min(z, y) > max(a, x)]
        want = any(p[0] != q[0] and min(p[2], q[2]) > max(p[1], q[1]) for i, p in enumerate(inside) for q in inside[i + 1 :])
        assert got.get(w, False) == want


def test_every_rule_of_the_contract_has_a_breaking_note():
    named = {e.split(":")[0] for _, errors in BROKEN.values() for e in errors.split(",") if e}
    assert len(named) >= 40 - 6


def test_pages_by_cursor(spark):
    """A service that is busy first, then gives three pages, each with the cursor of the next."""
    import http.server
    import threading
    from urllib.parse import parse_qs, urlparse

    from parley.sources.paged import Pages

    asked = []

    class Service(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            cursor = parse_qs(urlparse(self.path).query).get("cursor", [""])[0]
            asked.append(cursor)
            if len(asked) == 1:
                self.send_response(429)
                self.send_header("Retry-After", "0.1")
                self.end_headers()
                return
            n = int(cursor or 0)
            body = json.dumps({"results": [{"id": f"p{2 * n + i}", "t": "가"} for i in range(2)], "next_cursor": str(n + 1) if n < 2 else None}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(Pages)
        rows = spark.read.format("pages").option("url", f"http://127.0.0.1:{server.server_port}/list").load().collect()
    finally:
        server.shutdown()
    assert [r.id for r in rows] == [f"p{i}" for i in range(6)] and json.loads(rows[0].body)["t"] == "가" and asked == ["", "", "1", "2"]


def test_glossary_and_ledger_of_a_note(spark):
    text = """# t
### 기타 메모
- **제품**: 알파 (옛 이름), 베타·, 근거 없음
- **굵게** 말하고 `코드` 씀
### 5.2 검증 완료
- `가옹님`, 가옴 / 가온 (화자 B) → **가온**
- 비티 -> **BT 추정**
- 큰 → **"인용"**
- 둘 → Delta One 2 가 나 다
### 5.3 검증 필요
- x → **감마(a**
"""
    notes = spark.createDataFrame([("n2", text), ("n1", text.replace("알파", "오메가")), ("n3", "none")], "note string, text string")
    got = [(r.term, r.note) for r in identity.glossary(notes).collect()]
    assert got == [("오메가", "n1"), ("베타", "n1"), ("굵게", "n1"), ("코드", "n1"), ("가온", "n1"), ("BT 추정", "n1")][:5] + [('인용', "n1"), ("Delta One 2 가", "n1"), ("감마a", "n1"), ("알파", "n2")]
    assert [r.term for r in identity.glossary(notes, 2).collect()] == ["오메가", "베타"]
    fixed = {(r.note, r.target, r.variant) for r in identity.corrections(notes).collect()}
    assert fixed == {(n, "가온", v) for n in ("n1", "n2") for v in ("가옹", "가옴")}
    said = spark.createDataFrame([("n1", "가옹 있다")], "note string, text string")
    counts = identity.ledger(notes, said)
    assert {(r.variant, r["count"]) for r in counts.collect()} == {("가옹", 2), ("가옴", 1)}
    assert [r.line for r in identity.ledger_lines(counts, 1).orderBy("line_no").collect()] == [*identity.PREFACE, "- 가옹 → **가온** (2회)"]
    assert identity.ledger_lines(counts.limit(0)).count() == 0


def test_upload_outcomes(spark):
    local = [(k, e, t, h, p) for k, e, t, h, p in (
        ("gone.md", False, "g", "1", None), ("text.txt", True, "x", "1", None), ("same.MD", True, "s", "1", None), ("people.md", True, "p", "1", "kim"), ("archived.md", True, "a", "1", "kim"), ("base.md", True, "b", "1", None),
        ("live.md", True, "l", "2", None), ("lost.md", True, "o", "2", None), ("titled.md", True, "t", "1", None), ("new1.md", True, "n", "1", None), ("new2.md", True, "n", "1", None), ("none.md", True, None, None, None), ("none2.md", None, "z", "1", None),
    )]
    known = [("same.MD", "1", "p1", None, False), ("people.md", "1", "p2", None, None), ("archived.md", "1", "p3", "lee", False), ("base.md", "1", None, None, True), ("live.md", "1", "p4", None, False), ("lost.md", "1", "p9", None, False)]
    pages = [("p1", "s", False), ("p2", "p", None), ("p3", "a", True), ("p4", "l", False), ("p6", "t", False), ("p5", "t", False), ("p0", "t", True)]
    rows = lambda r, s: spark.createDataFrame(r, s)
    tables = rows(local, "key string, exists boolean, title string, hash string, participants string"), rows(known, "key string, hash string, page_id string, participants string, baseline boolean"), rows(pages, "page_id string, title string, archived boolean")
    got = {r.key: (r.action, r.page_id) for r in states.upload_outcomes(*tables, refresh_participants=True).collect()}
    assert got == {
        "gone.md": ("missing", None), "text.txt": ("skipped", None), "same.MD": ("skipped", "p1"), "people.md": ("refresh", "p2"), "archived.md": ("skipped", "p3"), "base.md": ("skipped", None), "live.md": ("update", "p4"),
        "lost.md": ("create", None), "titled.md": ("adopt", "p5"), "new1.md": ("create", None), "new2.md": ("adopt", None), "none.md": ("create", None), "none2.md": ("missing", None),
    }
    got = {r.key: r.action for r in states.upload_outcomes(*tables, upload_baseline=True).filter("key in ('base.md', 'people.md')").collect()}
    assert got == {"base.md": "create", "people.md": "skipped"}
    empty = [t.limit(0) for t in tables]
    assert states.upload_outcomes(*empty).count() == 0 and {r.action for r in states.upload_outcomes(tables[0], *empty[1:]).collect()} == {"missing", "skipped", "create", "adopt"}


def test_segments_of_meetings(spark):
    segments = spark.createDataFrame([("m", 0, 0, 10, "a b"), ("m", 1, 10, 20, " whole "), ("m", 2, 20, 30, "none"), ("m", 3, 90, 99, None)], "meeting string, segment int, ss long, se long, text string")
    words = spark.createDataFrame([
        ("m", 0, 0, 0, 2, "a"), ("m", 0, 1, 2, 4, " b"), ("m", 0, 2, 6, 9, "c"), ("m", 0, 3, None, 9, "lost"), ("m", 1, 4, 11, 12, None), ("m", 1, 5, 40, 41, ""), ("m", 1, 6, 50, 51, ""), ("m", 1, 7, 13, 14, "d"), ("m", 9, 8, 1, 2, "stray"),
    ], "meeting string, segment int, word int, ws long, we long, text string")
    turns = spark.createDataFrame([("m", 0, "A", 0, 5), ("m", 1, "B", 5, 30)], "meeting string, turn int, speaker string, ts long, te long")
    rows = lambda split: sorted(tuple(r) for r in intervals.assign_segments(segments, words, turns, 7, split).collect())
    assert rows(True) == [("m", 0, 1, 0, 4, "A", "a b"), ("m", 0, 2, 6, 9, "B", "c"), ("m", 1, 1, 11, 12, "B", "whole"), ("m", 1, 2, 40, 51, None, "whole"), ("m", 1, 3, 13, 14, "B", "d"), ("m", 2, 1, 20, 30, "B", "none"), ("m", 3, 1, 90, 99, None, None)]
    assert rows(False) == [("m", 0, 1, 0, 10, "A", "a b"), ("m", 1, 1, 10, 20, "B", " whole "), ("m", 2, 1, 20, 30, "B", "none"), ("m", 3, 1, 90, 99, None, None)]
