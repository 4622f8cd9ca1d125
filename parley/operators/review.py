"""Quality of transcripts, and fact checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.times import clock

# The states of a fact check, the labels that they are shown by, and the sentences that explain them.
CHECKABLE_ON_WEB = ("deterministic", "public_web")
CHECKABILITIES = (*CHECKABLE_ON_WEB, "internal_authority", "speaker_conflict")
CHECKED = ("verified", "contradicted", "partially_verified")
VERDICTS = ("contradicted", "not_assessable", "partially_verified", "speaker_conflict", "stt_review_needed", "verified")
EVIDENCE_VERDICTS = (*CHECKED, "not_assessable")
SOURCE_TYPES = ("deterministic", "official_primary", "standard", "public_data", "company_authority", "reliable_secondary")
ERROR_TYPES = ("none", "definition_mismatch", "unit_or_calculation", "date_or_version", "scope_overgeneralization", "correlation_causation", "outdated_fact", "wrong_authority", "other")
AUDIO_STATUSES = ("confirmed", "not_confirmed", "uncertain")
MOST_CANDIDATES, MOST_COUNTERPARTS, MOST_SOURCES = 8, 4, 5
VERDICT_LABELS = {"verified": "객관 사실과 일치", "contradicted": "객관 사실과 충돌", "partially_verified": "부분 확인", "speaker_conflict": "상충 발언", "not_assessable": "판정 불가", "stt_review_needed": "STT 확인 필요"}
CONFIDENCE_LABELS = {"high": "높음", "medium": "중간", "low": "낮음"}
ERROR_LABELS = {"definition_mismatch": "정의 불일치", "unit_or_calculation": "단위·계산 오류", "date_or_version": "날짜·버전 불일치", "scope_overgeneralization": "적용 범위 과도 일반화", "correlation_causation": "상관관계·인과관계 혼동", "outdated_fact": "오래된 사실", "wrong_authority": "정본·권위 출처 오류", "other": "기타"}
AUDIO_LABELS = {"confirmed": "구간 재전사에서 명제 확인", "not_confirmed": "구간 재전사에서 명제 미확인", "uncertain": "구간 재전사로도 불명확"}
CONFLICT = "상충하는 발언이 있으나 공개된 객관 기준만으로 어느 쪽이 맞는지 정할 수 없다."
INTERNAL = "사내 정본이 필요한 명제로 공개 웹검색 대상에서 제외했다."
UNOBSERVED = "실제 웹검색 실행 증거가 없어 외부 검증을 확정하지 않았다."
NOT_FOUND = "웹검색 결과에서 이 명제의 검증 결과를 찾지 못했다."
MISHEARD = "외부 근거와 비교 결과는 확보했지만 전사 정확도가 불확실하다. 원음에서 명제가 정확히 발화됐는지 확인한 뒤 최종 판정해야 한다. "
CRITICAL = ("numbers", "negation", "owner", "deadline")


# ---- quality of transcripts ----


def token_distance(a: Column, b: Column) -> Column:
    """F2 over tokens, however many distinct ones there are."""
    return T.token_edit_distance(a, b)


def rates(cases: DataFrame) -> DataFrame:
    """``cases`` (id, reference, hypothesis) with distances and units of characters and tokens."""
    u = cases.withColumn("rc", T.cer_units(F.col("reference"))).withColumn("hc", T.cer_units(F.col("hypothesis"))).withColumn("rw", T.words(F.col("reference"))).withColumn("hw", T.words(F.col("hypothesis")))
    return u.select(*cases.columns, T.edit_distance("rc", "hc").alias("char_distance"), F.length("rc").alias("char_units"), token_distance(F.col("rw"), F.col("hw")).alias("word_distance"), F.size("rw").alias("word_units"))


def micro(rated: DataFrame, keys: list[str]) -> DataFrame:
    """A5: summed distances over summed units; null without units. A case without a distance adds no units either."""
    unit = lambda k: F.when(F.col(f"{k}_distance").isNotNull(), F.col(f"{k}_units"))
    part = lambda k: (F.sum(f"{k}_distance") / F.nullif(F.sum(unit(k)), F.lit(0))).alias({"char": "cer", "word": "wer"}[k])
    return rated.groupBy(*keys).agg(F.count("*").alias("cases"), part("char"), part("word"))


def critical_counts(cases: DataFrame) -> DataFrame:
    """A10: per case and category of ``critical`` (a map of category to phrases): how many phrases there are, and how many stand
    in the hypothesis as neighbouring whole tokens, or don't. ``reference_lacks`` counts those that not even the reference has: such a case is invalid."""
    tokens = lambda c: T.words(T.normalized(F.col(c)))
    each = cases.select("id", tokens("reference").alias("rt"), tokens("hypothesis").alias("ht"), F.explode("critical").alias("category", "phrases")).filter(F.col("category").isin(*CRITICAL))
    each = each.select("id", "category", "rt", "ht", F.explode("phrases").alias("phrase")).withColumn("p", T.words(T.normalized(F.col("phrase"))))
    found, known = T.has_phrase(F.col("ht"), F.col("p")), T.has_phrase(F.col("rt"), F.col("p"))
    return each.groupBy("id", "category").agg(F.count("*").alias("phrases"), F.count_if(found).alias("present"), F.count_if(~found).alias("missing"), F.count_if(~known).alias("reference_lacks"))


def speaker_counts(cases: DataFrame) -> DataFrame:
    """Per case with ``speaker_labels`` (pairs of reference and hypothesis): pairs, and those that match, composed and trimmed, or don't."""
    each = cases.select("id", F.explode("speaker_labels").alias("x"))
    same = T.stripped(T.nfc(F.col("x.reference"))) == T.stripped(T.nfc(F.col("x.hypothesis")))
    return each.groupBy("id").agg(F.count("*").alias("pairs"), F.count_if(same).alias("matching"), F.count_if(~same).alias("mismatched"))


def reviewed(cases: DataFrame) -> Column:
    """whether a case is reviewed, by someone, on some evidence."""
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.coalesce(F.col("reviewed"), F.lit(False)) & given("reviewer") & given("evidence")


def manifest_errors(cases: DataFrame) -> DataFrame:
    """per case of a manifest (manifest, idx, id, reference, hypothesis: relative paths) what is wrong with it: ids that aren't opaque slugs or repeat,
    paths that are blank or lead out of the manifest's folder, a reference without a hypothesis, and a file that is a reference here and a hypothesis anywhere."""
    path = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), r"(^|/)(?:\./)+", "$1"), "/{2,}", "/")
    bad = lambda c: F.col(c).isNotNull() & ((F.trim(c) == "") | F.col(c).startswith("/") | F.col(c).rlike(r"(?:^|/)\.\.(?:/|$)"))
    x = cases.withColumn("_r", path("reference")).withColumn("_h", path("hypothesis"))
    heard = x.filter("_h is not null").select("manifest", F.col("_h").alias("_r")).distinct().withColumn("_both", F.lit(True))
    x = x.join(heard, ["manifest", "_r"], "left").join(cases.groupBy("manifest", "id").agg(F.count("*").alias("_ids")), ["manifest", "id"])
    rules = [
        (~F.coalesce(F.col("id").rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$"), F.lit(False)), "id isn't an opaque slug"), (F.col("_ids") > 1, "id repeats"), (bad("reference"), "reference outside the folder"), (bad("hypothesis"), "hypothesis outside the folder"),
        (F.col("reference").isNotNull() & F.col("hypothesis").isNull(), "no hypothesis"), (F.coalesce("_both", F.lit(False)), "reference is a hypothesis"),
    ]
    return x.select("manifest", "idx", _broken(rules).alias("errors"))


def evaluated(cases: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Per case (id, reference, hypothesis, reviewed, reviewer, evidence, critical, speaker_labels): distances, units and rates,
    lexical and speaker mismatches, and the verdict. Without a reference: not_evaluated. Ids come out as their sha256."""
    with_text = cases.filter("reference is not null").withColumn("reference", T.normalized(F.col("reference"))).withColumn("hypothesis", T.normalized(F.coalesce("hypothesis", F.lit(""))))
    rated = rates(with_text.select("id", "reference", "hypothesis")).drop("reference", "hypothesis")
    lexical = critical_counts(with_text.select("id", "reference", "hypothesis", "critical")).groupBy("id").agg(F.sum("missing").alias("lexically_missing"))
    speakers = speaker_counts(with_text.select("id", "speaker_labels")).select("id", F.col("mismatched").alias("speakers_mismatched"))
    x = cases.select("id", F.col("reference").isNotNull().alias("has"), reviewed(cases).alias("ok")).join(rated, "id", "left").join(lexical, "id", "left").join(speakers, "id", "left")
    x = x.withColumn("cer", F.col("char_distance") / F.col("char_units")).withColumn("wer", F.col("word_distance") / F.col("word_units"))
    failed = (F.coalesce("lexically_missing", F.lit(0)) > 0) | (F.coalesce("speakers_mismatched", F.lit(0)) > 0)
    for name, most in thresholds.items():
        failed = failed | (F.col(name) > most)
    result = F.when(~F.col("has"), "not_evaluated").otherwise(verdict(F.col("ok"), F.lit(bool(thresholds)), failed))
    return x.select(F.sha2("id", 256).alias("id_sha256"), "char_distance", "char_units", "word_distance", "word_units", "cer", "wer", "lexically_missing", "speakers_mismatched", result.alias("verdict"))


def verdict(reviewed: Column, gated: Column, failed: Column) -> Column:
    """The verdict of a measured case of E10."""
    return F.when(~reviewed, "not_reviewed").when(~gated, "measured_not_gated").when(failed, "gated_fail").otherwise("gated_pass")


# ---- fact checks ----


def searchable(candidates: DataFrame) -> DataFrame:
    """What a public search may see of the candidates that it may be asked about."""
    asked = candidates.filter(F.col("web_search_allowed") & F.col("checkability").isin(*CHECKABLE_ON_WEB))
    return asked.select(F.col("id").alias("candidate_id"), "public_claim", "checkability", "importance", "stt_risk")


def candidate_errors(candidates: DataFrame) -> DataFrame:
    """Per candidate (meeting, idx from 1, and CANDIDATES) what is wrong with it."""
    n = F.col("idx")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = [
        (n > MOST_CANDIDATES, "too many candidates"), (~F.col("id").eqNullSafe(F.concat(F.lit("C"), n.cast("string"))), "ids not contiguous"),
        *((F.col(c).isNull(), f"no {c}") for c in ("speaker", "claim_text", "public_claim", "required_evidence", "importance")),
        *((F.coalesce(F.col(c) < 0, F.lit(True)), f"bad {c}") for c in ("start_seconds", "end_seconds")), (F.col("end_seconds") < F.col("start_seconds"), "ends before it starts"),
        (~F.coalesce(F.col("checkability").isin(*CHECKABILITIES), F.lit(False)), "bad checkability"), (~F.coalesce(F.col("importance").isin("high", "medium"), F.lit(False)), "bad importance"),
        (F.col("stt_risk").isNull() | F.col("web_search_allowed").isNull(), "bad flags"), (F.col("web_search_allowed") & ~F.col("checkability").isin(*CHECKABLE_ON_WEB), "search not possible"),
        (F.col("web_search_allowed") & blank("public_claim"), "search without a public claim"), ((F.col("checkability") == "internal_authority") & blank("required_evidence"), "no authority named"),
        (F.col("counterpart_claims").isNull(), "no counterpart list"), ((F.col("checkability") == "speaker_conflict") & (F.size("counterpart_claims") == 0), "no counterpart"), (F.size("counterpart_claims") > MOST_COUNTERPARTS, "too many counterparts"),
    ]
    return candidates.select("meeting", "id", _broken(rules).alias("errors"))


def evidence_errors(evidence: DataFrame, asked: DataFrame) -> DataFrame:
    """Per result of a search (meeting, candidate_id, and EVIDENCE) what is wrong with it; ``asked`` are the candidates (meeting, candidate_id) that may have one."""
    known = asked.select("meeting", "candidate_id").distinct().withColumn("known", F.lit(True))
    times = evidence.groupBy("meeting", "candidate_id").agg(F.count("*").alias("times"))
    x = evidence.join(known, ["meeting", "candidate_id"], "left").join(times, ["meeting", "candidate_id"])
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    isin = lambda c, values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    lacks = lambda c: lambda s: blank(s[c])
    any_source = lambda f: F.coalesce(F.exists("sources", f), F.lit(False))
    hosts = F.size(F.array_distinct(F.transform(F.filter("sources", lambda s: F.coalesce(s["url"], F.lit("")) != ""), lambda s: F.lower(F.coalesce(F.try_parse_url(s["url"], F.lit("AUTHORITY")), F.lit(""))))))
    strong = any_source(lambda s: s["source_type"].isin(*SOURCE_TYPES[:-1]))
    contradicted = F.col("verdict") == "contradicted"
    rules = [
        (F.col("known").isNull(), "unknown candidate"), (F.col("times") > 1, "more than one result"), (~isin("verdict", EVIDENCE_VERDICTS), "bad verdict"), (~isin("error_type", ERROR_TYPES), "bad error type"), (~isin("confidence", CONFIDENCE_LABELS), "bad confidence"),
        *((F.col(c).isNull(), f"no {c}") for c in ("corrected_fact", "explanation", "valid_as_of")), (~F.coalesce(T.contains_korean(F.col("explanation")), F.lit(False)), "explanation not Korean"), (~blank("corrected_fact") & ~T.contains_korean(F.col("corrected_fact")), "corrected fact not Korean"),
        (F.col("sources").isNull(), "no source list"), (F.size("sources") > MOST_SOURCES, "too many sources"), (any_source(lambda s: ~F.coalesce(s["source_type"].isin(*SOURCE_TYPES), F.lit(False))), "bad source type"),
        (any_source(lambda s: (s["source_type"] == "deterministic") & blank(s["locator"])), "deterministic source without evidence"), (any_source(lambda s: ~s["source_type"].eqNullSafe(F.lit("deterministic")) & ~F.coalesce(T.direct_https(s["url"]), F.lit(False))), "source not a direct https address"),
        *((any_source(lacks(c)), f"source without {c}") for c in ("title", "locator", "why_relevant")), (any_source(lambda s: ~F.coalesce(T.contains_korean(s["why_relevant"]), F.lit(False))), "relevance not Korean"),
        (isin("verdict", CHECKED) & (F.size("sources") == 0), "verdict without sources"), (contradicted & ~F.col("confidence").eqNullSafe(F.lit("high")), "contradicted without high confidence"), (contradicted & blank("corrected_fact"), "contradicted without the fact"), (contradicted & ~strong & (hosts < 2), "contradicted on one weak source"),
    ]
    return x.select("meeting", "candidate_id", _broken(rules).alias("errors"))


def _broken(rules: list[tuple[Column, str]]) -> Column:
    return F.filter(F.array(*(F.when(broken, F.lit(name)) for broken, name in rules)), lambda x: x.isNotNull())


def merged(candidates: DataFrame, evidence: DataFrame, reviews: DataFrame, searched: Column | None = None) -> DataFrame:
    """Each candidate's verdict. A conflict of speakers stays one; what needs an internal authority, wasn't searched
    (``searched``, of a candidate) or has no result can't be assessed; a checked claim that may be misheard needs the audio's confirmation."""
    searched = F.lit(True) if searched is None else searched
    kept = ("corrected_fact", "explanation", "error_type", "confidence", "valid_as_of", "sources")
    has = [c for c in kept if c in evidence.columns]
    e = evidence.select(F.col("candidate_id").alias("id"), F.col("verdict").alias("found"), *(F.col(c).alias(f"_{c}") for c in has))
    r = reviews.select(F.col("candidate_id").alias("id"), F.col("status").alias("audio"))
    x = candidates.join(e, "id", "left").join(r, "id", "left").withColumn("searched", searched)
    reason = F.when(F.col("checkability") == "speaker_conflict", CONFLICT).when(F.col("checkability") == "internal_authority", INTERNAL).when(~F.col("searched"), UNOBSERVED).when(F.col("found").isNull(), NOT_FOUND)
    misheard = F.col("stt_risk") & ~F.coalesce(F.col("audio") == "confirmed", F.lit(False)) & F.col("found").isin(*CHECKED)
    x = x.withColumn("_reason", reason).withColumn("_misheard", misheard & F.col("_reason").isNull())
    final = F.when(F.col("checkability") == "speaker_conflict", "speaker_conflict").when(F.col("_reason").isNotNull(), "not_assessable").when(F.col("_misheard"), "stt_review_needed").otherwise(F.col("found"))
    default = {"corrected_fact": F.lit(""), "explanation": F.col("_reason"), "error_type": F.lit("none"), "confidence": F.lit("low"), "valid_as_of": F.lit("")}
    value = {c: F.when(F.col("_reason").isNotNull(), default[c] if c in default else F.array().cast(evidence.schema[c].dataType)).otherwise(F.col(f"_{c}")) for c in has}
    if "explanation" in value:
        value["explanation"] = F.when(F.col("_misheard"), F.concat(F.lit(MISHEARD), F.col("_explanation"))).otherwise(value["explanation"])
    if "confidence" in value:
        value["confidence"] = F.when(F.col("_misheard"), "low").otherwise(value["confidence"])
    audio = F.when(F.col("_reason").isNull(), F.col("audio"))
    return x.select(*candidates.columns, final.alias("verdict"), audio.alias("audio"), *(v.alias(c) for c, v in value.items()))


def verdict_counts(checked: DataFrame) -> DataFrame:
    """A3: counts of all verdicts, zeros too."""
    return checked.groupBy().pivot("verdict", list(VERDICTS)).agg(F.count(F.lit(1))).fillna(0)


def _label(of: Column, labels: dict[str, str], other: str | None = None) -> Column:
    out = F.lit(other)
    for k, v in labels.items():
        out = F.when(of == k, F.lit(v)).otherwise(out)
    return out


def item_lines(checked: DataFrame) -> DataFrame:
    """The Markdown lines of each merged claim (with ``number``, its place among the shown ones), as an array."""
    c = lambda name: T.one_line(F.coalesce(F.col(name), F.lit("")))
    if_any = lambda cond, line: F.when(cond, line)
    sources = F.transform("sources", lambda s: F.concat(F.lit("- 근거: "), F.when(F.coalesce(s["url"], F.lit("")) != "", F.concat(F.lit("["), T.link_text(s["title"]), F.lit("]("), s["url"], F.lit(")"))).otherwise(T.one_line(s["title"])), F.lit(" — "), T.one_line(s["locator"]), F.lit("; "), T.one_line(s["why_relevant"])))
    against = F.transform("counterpart_claims", lambda s: F.concat(F.lit("- 상충 발언: “"), T.one_line(s["claim_text"]), F.lit("” · 화자 "), s["speaker"], F.lit(" · "), clock(s["start_seconds"])))
    head = F.array(F.concat(F.lit("### F"), F.col("number").cast("string"), F.lit(". "), _label(F.col("verdict"), VERDICT_LABELS)), F.concat(F.lit("- 발언: “"), c("claim_text"), F.lit("”")), F.concat(F.lit("- 위치: 화자 "), F.col("speaker"), F.lit(" · "), clock(F.col("start_seconds"))))
    why = F.when(F.col("verdict") == "contradicted", "틀린 이유").otherwise("판정 이유")
    told = F.array(if_any(F.coalesce("corrected_fact", F.lit("")) != "", F.concat(F.lit("- 바로잡기: "), c("corrected_fact"))), F.concat(F.lit("- "), why, F.lit(": "), c("explanation")), if_any(F.coalesce("error_type", F.lit("none")) != "none", F.concat(F.lit("- 오류 유형: "), _label(F.col("error_type"), ERROR_LABELS))))
    tail = F.array(
        if_any(F.coalesce("valid_as_of", F.lit("")) != "", F.concat(F.lit("- 기준 시점: "), c("valid_as_of"))), F.concat(F.lit("- 확신도: "), _label(F.col("confidence"), CONFIDENCE_LABELS)),
        if_any(F.col("stt_risk") & F.col("audio").isNotNull(), F.concat(F.lit("- 오디오 재검증: "), _label(F.col("audio"), AUDIO_LABELS, "재검증 상태 확인 필요"))), if_any(F.col("verdict") == "stt_review_needed", F.lit("- STT 확인: 원음 재청취 필요")),
    )
    lines = F.concat(head, F.coalesce(against, F.array().cast("array<string>")), told, F.coalesce(sources, F.array().cast("array<string>")), tail)
    return checked.withColumn("lines", F.filter(lines, lambda x: x.isNotNull()))


def independent_hosts(urls: Column) -> Column:
    """Distinct hosts among an array of addresses."""
    return F.size(F.array_distinct(F.transform(F.filter(urls, lambda u: F.coalesce(u, F.lit("")) != ""), lambda u: F.lower(F.coalesce(F.try_parse_url(u, F.lit("AUTHORITY")), F.lit(""))))))


def listening_windows(candidates: DataFrame, evidence: DataFrame, pad: float) -> DataFrame:
    """What to transcribe again: claims that may be misheard and whose verdict was checked."""
    checked = evidence.filter(F.col("verdict").isin(*CHECKED)).select(F.col("candidate_id").alias("id")).distinct()
    return candidates.filter("stt_risk").join(checked, "id").select("id", F.greatest(F.col("start_seconds") - pad, F.lit(0.0)).alias("start"), (F.col("end_seconds") + pad).alias("end"))
