"""Queries of corrections, quality, fact checks and pipeline state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corrections as C
from ..operators import notes as N
from ..operators import review as R
from ..operators import state as S
from .base import query, table

LINES = [("d", 0, "[00:00:01 - 00:00:04] A: 김민중 님이 비티에 서비스를 설명했다"), ("d", 1, "[00:00:05 - 00:00:09] B: 예산은 3억이고 가옹 도입은 안 한다고 했다"), ("d", 2, "notes"), ("d", 3, "[00:00:10 - 00:00:14] A: API 문서를 가옹 팀이 공유했다")]
PATCHES = [
    (0, 1, "김민중", "김민준", "person_name", 0.99), (1, 1, "비티에", "BT", "proper_noun", 0.95), (2, 2, "3억", "4억", "proper_noun", 0.99), (3, 2, "가옹", "가온", "proper_noun", 0.97), (4, 3, "notes", "note", "proper_noun", 0.99),
    (5, 9, "x", "y", "proper_noun", 0.99), (6, 1, "비티에", "BT", "sentence", 0.99), (7, 1, "비티에", "BT", "proper_noun", 0.5), (8, 1, "비티에", "비티에", "proper_noun", 0.99), (9, 4, "API", "API 게이트웨이", "acronym", 0.99),
    (10, 4, "문서를", "문서를(doc)", "proper_noun", 0.99), (11, 4, "공유했다", "공[유]", "proper_noun", 0.99), (12, 4, "가옹", "가올라", "proper_noun", 0.99), (13, 1, "", "BT", "proper_noun", 0.99), (14, 1, "비티에", "BT", "proper_noun", 1.5), (15, 4, "에러로그", "BT", "proper_noun", 0.99),
]
_EXPECTED = {0: "accepted", 1: "accepted", 2: "protected number/negation/commitment token changed", 3: "accepted", 4: "target line is not a transcript utterance", 5: "invalid line number", 6: "category is not auto-applicable", 7: "confidence below threshold", 8: "before and after are identical", 9: "already-canonical acronym expansion", 10: "already-canonical term expansion", 11: "patch contains structural characters", 12: "no deterministic ledger/roster evidence", 13: "before/after must be non-empty strings", 14: "confidence must be between 0 and 1", 15: "before must occur exactly once in the target utterance"}


def _decided(spark: SparkSession) -> DataFrame:
    lines = spark.createDataFrame(LINES, "doc string, line_no int, line string")
    patches = spark.createDataFrame([("d", *p) for p in PATCHES], "doc string, patch_idx int, line int, before string, after string, category string, confidence double")
    ledger = spark.createDataFrame([("비티에", "BT", 7), ("가옹", "가온", 9)], "variant string, target string, count int")
    roster = spark.createDataFrame([("김민준",), ("이서연",)], "name string")
    return C.decided(patches, lines, ledger, roster, roster.filter("name = '김민준'"))


@query("select * from (values " + ", ".join(f"({i}, '{r}')" for i, r in _EXPECTED.items()) + ") t(patch_idx, reason)")
def patch_decision_rules(spark: SparkSession, d: str) -> DataFrame:
    """E5: each rule on a literal patch that breaks it first."""
    return _decided(spark).select("patch_idx", "reason")


@query("""select * from (values (0, '[00:00:01 - 00:00:04] A: 김민준 님이 BT 서비스를 설명했다'), (1, '[00:00:05 - 00:00:09] B: 예산은 3억이고 가온 도입은 안 한다고 했다'), (2, 'notes'), (3, '[00:00:10 - 00:00:14] A: API 문서를 가옹 팀이 공유했다')) t(line_no, line)""")
def patch_application(spark: SparkSession, d: str) -> DataFrame:
    """The kept patches put into their lines."""
    decided = _decided(spark)
    sizes = spark.createDataFrame([("d", 1000)], "doc string, chars int")
    kept = C.budgeted(decided, sizes).join(decided.select("doc", "patch_idx", "after"), ["doc", "patch_idx"])
    lines = spark.createDataFrame(LINES, "doc string, line_no int, line string")
    return C.applied(lines, kept).select("line_no", "line")


@query("""with recursive p as (select l_orderkey doc, l_linenumber i, (l_partkey % 3)::int line, (l_suppkey % 40)::int s, (l_suppkey % 40 + 1 + l_quantity % 9)::int e, 100 + 2 * (l_orderkey % 400) chars from lineitem),
  o as (select *, row_number() over (partition by doc order by i, line, s, e) n from p),
  f as (select doc, chars, 0::bigint n, 0::bigint used, [] :: struct(i int, line int, s int, e int)[] kept from (select distinct doc, chars from o)
    union all select f.doc, f.chars, f.n + 1, case when x.ok then f.used + o.e - o.s else f.used end, case when x.ok then list_append(f.kept, {'i': o.i::int, 'line': o.line, 's': o.s, 'e': o.e}) else f.kept end
    from f join o on o.doc = f.doc and o.n = f.n + 1, lateral (select not coalesce(list_bool_or(list_transform(f.kept, lambda k: k.line = o.line and k.s < o.e and o.s < k.e)), false) and (f.used + o.e - o.s)::double / f.chars <= 0.05 ok) x)
  select doc, max(used)::bigint used, max(len(kept))::bigint kept from f group by 1 having max(len(kept)) > 0""")
def patch_budget_fold(spark: SparkSession, d: str) -> DataFrame:
    """E6 and W15 over patches made of the order lines."""
    p = table(spark, d, "lineitem")
    s = (F.col("l_suppkey") % 40).cast("int")
    made = p.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("patch_idx"), (F.col("l_partkey") % 3).cast("int").alias("line"), s.alias("start"), (s + 1 + F.col("l_quantity") % 9).cast("int").alias("end"), F.lit(True).alias("accepted"))
    sizes = p.select(F.col("l_orderkey").alias("doc"), (100 + 2 * (F.col("l_orderkey") % 400)).alias("chars")).distinct()
    return C.budgeted(made, sizes).groupBy("doc").agg(F.max("used").cast("long").alias("used"), F.count("*").alias("kept"))


@query()
def cer_wer_micro(spark: SparkSession, d: str) -> DataFrame:
    """A5 over F2 of whole documents: error rates by language of their lower case with every seventh word gone."""
    w = T.words(F.regexp_replace("text", "[^ -~]", "?"))
    gone = F.filter(F.col("w"), lambda x, i: i % 7 != 6)
    docs = table(spark, d, "documents").select("doc_id", "lang", "text").filter(F.col("text").rlike(r"\S")).repartition("doc_id").select("doc_id", "lang", w.alias("w"))
    cases = docs.select(F.col("doc_id").alias("id"), "lang", F.array_join("w", " ").alias("reference"), F.lower(F.array_join(gone, " ")).alias("hypothesis"))
    return R.micro(R.rates(cases), ["lang"])


@query("select doc_id, case when not coalesce(quality is not null, false) then 'not_reviewed' when n_chars % 10 = 0 then 'measured_not_gated' when quality = 0 or toxic = 1 then 'gated_fail' else 'gated_pass' end verdict from documents left join labels using (doc_id)")
def quality_gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    """The verdict of E10, without its A10 and A11, with labels as reviews."""
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return x.select("doc_id", R.verdict(F.col("quality").isNotNull(), F.col("n_chars") % 10 != 0, (F.col("quality") == 0) | (F.col("toxic") == 1)).alias("verdict"))


_FACT = """cand as (select doc_id::varchar id, doc_id % 4 = 0 stt_risk, (doc_id % 100)::double s, case doc_id % 5 when 0 then 'internal_authority' when 1 then 'speaker_conflict' when 2 then 'deterministic' else 'public_web' end checkability, doc_id % 11 <> 0 searched from documents),
  ev as (select doc_id::varchar id, case when doc_id % 13 = 0 then 'not_assessable' when toxic = 1 then 'partially_verified' when quality = 1 then 'verified' else 'contradicted' end verdict from labels where doc_id % 3 <> 0),
  rv as (select doc_id::varchar id, case doc_id % 12 when 0 then 'confirmed' when 4 then 'not_confirmed' else 'uncertain' end status from documents where doc_id % 8 = 0)"""
_MERGED = """m as (select id, case when checkability = 'speaker_conflict' then 'speaker_conflict' when checkability = 'internal_authority' or not searched or ev.verdict is null then 'not_assessable'
  when stt_risk and ev.verdict in ('verified', 'contradicted', 'partially_verified') and (status is null or status <> 'confirmed') then 'stt_review_needed' else ev.verdict end verdict,
  case when checkability in ('speaker_conflict', 'internal_authority') or not searched or ev.verdict is null then null else status end audio,
  case when checkability in ('speaker_conflict', 'internal_authority') or not searched or ev.verdict is null or (stt_risk and ev.verdict in ('verified', 'contradicted', 'partially_verified') and (status is null or status <> 'confirmed')) then 'low' else 'high' end confidence
  from cand left join ev using (id) left join rv using (id))"""


def _facts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    n, start = F.col("doc_id") % 5, (F.col("doc_id") % 100).cast("double")
    kind = F.when(n == 0, "internal_authority").when(n == 1, "speaker_conflict").when(n == 2, "deterministic").otherwise("public_web")
    c = docs.select(F.col("doc_id").cast("string").alias("id"), (F.col("doc_id") % 4 == 0).alias("stt_risk"), start.alias("start_seconds"), (start + 5).alias("end_seconds"), kind.alias("checkability"), (F.col("doc_id") % 11 != 0).alias("searched"), F.substring("text", 1, 40).alias("public_claim"), F.lit("high").alias("importance"))
    found = F.when(F.col("doc_id") % 13 == 0, "not_assessable").when(F.col("toxic") == 1, "partially_verified").when(F.col("quality") == 1, "verified").otherwise("contradicted")
    e = labels.filter("doc_id % 3 <> 0").select(F.col("doc_id").cast("string").alias("candidate_id"), found.alias("verdict"), F.lit("high").alias("confidence"))
    heard = F.when(F.col("doc_id") % 12 == 0, "confirmed").when(F.col("doc_id") % 12 == 4, "not_confirmed").otherwise("uncertain")
    r = docs.filter("doc_id % 8 = 0").select(F.col("doc_id").cast("string").alias("candidate_id"), heard.alias("status"))
    return c, e, r


def _merged(spark: SparkSession, d: str) -> DataFrame:
    c, e, r = _facts(spark, d)
    return R.merged(c, e, r, F.col("searched"))


@query(f"with {_FACT}, {_MERGED} select id, verdict, audio, confidence from m")
def factcheck_merge(spark: SparkSession, d: str) -> DataFrame:
    """J13 and E15."""
    return _merged(spark, d).select("id", "verdict", "audio", "confidence")


@query(f"with {_FACT}, {_MERGED} select " + ", ".join(f"count(*) filter (verdict = '{v}')::bigint {v}" for v in R.VERDICTS) + " from m")
def verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    """A3: zeros for verdicts that no candidate has."""
    return R.verdict_counts(_merged(spark, d))


@query(f"with {_FACT} select id candidate_id, checkability from cand where checkability in ('deterministic', 'public_web') and searched")
def public_projection(spark: SparkSession, d: str) -> DataFrame:
    """What a search may see."""
    c, _, _ = _facts(spark, d)
    return R.searchable(c.withColumnRenamed("searched", "web_search_allowed")).select("candidate_id", "checkability")


@query(f"with {_FACT} select id, greatest(s - 3, 0.0)::double \"start\", (s + 8)::double \"end\" from cand where stt_risk and id in (select id from ev where verdict in ('verified', 'contradicted', 'partially_verified'))")
def listening_windows(spark: SparkSession, d: str) -> DataFrame:
    """J14."""
    c, e, _ = _facts(spark, d)
    return R.listening_windows(c, e, 3.0)


@query("""with t as (select conv_id id, turn, trim(regexp_replace(lower(regexp_replace(text, '[^ -~]', '?', 'g')), '\\s+', ' ', 'g')) x from conversations), r as (select a.id, a.x hyp, string_split(b.x, ' ') w from t a join t b on a.id = b.id and a.turn = b.turn + 1 where b.x <> ''),
  p as (select id, hyp, unnest([list_extract(w, 1), list_extract(w, -1)]) phrase from r) select id, count(*)::bigint phrases, count(*) filter (contains(' ' || hyp || ' ', ' ' || phrase || ' '))::bigint present, count(*) filter (not contains(' ' || hyp || ' ', ' ' || phrase || ' '))::bigint missing from p group by 1""")
def critical_counts(spark: SparkSession, d: str) -> DataFrame:
    """A10: whether the first and last word of a turn stand in the next one."""
    t = table(spark, d, "conversations").select("conv_id", "turn", T.collapsed(F.lower(F.regexp_replace("text", "[^ -~]", "?"))).alias("x"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = t.withColumn("reference", F.when(F.lag("turn").over(w) == F.col("turn") - 1, F.lag("x").over(w))).filter("reference <> ''").withColumnRenamed("x", "hypothesis")
    words = F.split("reference", " ")
    cases = pairs.select(F.struct("conv_id", "turn").alias("id"), "reference", "hypothesis", F.create_map(F.lit("owner"), F.array(words[0], F.element_at(words, -1))).alias("critical"))
    counts = R.critical_counts(cases)
    return counts.groupBy(F.col("id.conv_id").alias("id")).agg(*(F.sum(c).alias(c) for c in ("phrases", "present", "missing")))


@query("""select conv_id id, count(*)::bigint pairs, count(*) filter (a = b)::bigint matching, count(*) filter (a <> b)::bigint mismatched from (select conv_id, role a, case when turn % 3 = 0 then 'other' else role end b from conversations) group by 1""")
def speaker_counts(spark: SparkSession, d: str) -> DataFrame:
    """Labels of turns, each third one changed, others with white space."""
    c = table(spark, d, "conversations")
    pair = F.struct(F.col("role").alias("reference"), F.when(F.col("turn") % 3 == 0, "other").otherwise(F.concat(F.lit(" "), "role", F.lit("\t"))).alias("hypothesis"))
    return R.speaker_counts(c.groupBy(F.col("conv_id").alias("id")).agg(F.collect_list(pair).alias("speaker_labels")))


@query("""select conv_id, turn, list_filter([case when turn % 6 = 5 then 'id isn''t an opaque slug' end, case when turn % 5 = 3 then 'reference outside the folder' end, case when turn % 7 = 2 then 'hypothesis outside the folder' end, case when turn % 4 = 3 then 'no hypothesis' end, case when turn = 1 then 'reference is a hypothesis' end], lambda x: x is not null)::varchar[] errors from conversations""")
def manifest_errors(spark: SparkSession, d: str) -> DataFrame:
    """cases by turn, with ids and paths that a manifest may not have."""
    t = F.col("turn")
    n = t.cast("string")
    reference = F.when(t % 5 == 3, F.concat(F.lit("a/../"), n)).when(t == 1, "./h/x").otherwise(F.concat(F.lit("r/"), n))
    hypothesis = F.when(t % 7 == 2, F.concat(F.lit("/h/"), n)).when(t % 4 == 3, None).when(t == 0, "h//x").otherwise(F.concat(F.lit("h/"), n))
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("manifest"), t.alias("idx"), F.concat(F.when(t % 6 == 5, "Case_").otherwise("case-"), n).alias("id"), reference.alias("reference"), hypothesis.alias("hypothesis"))
    return R.manifest_errors(c).select(F.col("manifest").alias("conv_id"), F.col("idx").alias("turn"), "errors")


@query("""with c as (select conv_id, turn, text, role from conversations), g as (select c.*, p.text ref from c left join c p on p.conv_id = c.conv_id and p.turn = c.turn - 1 and p.text <> '')
  select sha256(conv_id || '-' || turn) id_sha256, case when ref is null then 'not_evaluated' when turn % 4 = 0 or conv_id % 5 = 0 then 'not_reviewed' when turn % 3 = 0 or ref <> text then 'gated_fail' else 'gated_pass' end verdict from g""")
def quality_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Turns against the ones before as references; any error fails, as do speakers that differ."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    before = c.filter("text <> ''").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    x = c.join(before, ["conv_id", "turn"], "left")
    label = F.struct(F.lit("A").alias("reference"), F.when(F.col("turn") % 3 == 0, "B").otherwise("A").alias("hypothesis"))
    cases = x.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "reference", F.col("text").alias("hypothesis"), (F.col("turn") % 4 != 0).alias("reviewed"), F.when(F.col("conv_id") % 5 == 0, " ").otherwise("r").alias("reviewer"), F.lit("e").alias("evidence"),
        F.create_map(F.lit("numbers"), F.array().cast("array<string>")).alias("critical"), F.array(label).alias("speaker_labels"),
    )
    return R.evaluated(cases, {"cer": 0.0, "wer": 0.0}).select("id_sha256", "verdict")


@query("""with u as (select p.page_id, [p.url, upper(p.url), q.url, ''] urls from pages p left join pages q on q.page_id = p.page_id + 1) select page_id, len(list_distinct(list_transform(list_filter(urls, lambda x: x is not null and x <> ''), lambda x: lower(regexp_extract(x, '^[a-zA-Z]+://([^/?#]+)', 1)))))::int hosts from u""")
def independent_hosts(spark: SparkSession, d: str) -> DataFrame:
    """The hosts of a page's address, of the same in capitals, and of the next page's."""
    p = table(spark, d, "pages").select("page_id", "url")
    after = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    return p.join(after, "page_id", "left").select("page_id", R.independent_hosts(F.array("url", F.upper("url"), "next", F.lit(""))).alias("hosts"))


_FLAGS = {"readable": 23, "valid": 3, "transcript": 7, "preview": 11, "preview_faithful": 4, "review": 13, "review_valid": 6, "receipt": 5, "receipt_valid": 17, "receipt_current": 9}
_KEY = "case when doc_id % 29 = 0 then 'notes/../' || doc_id || '.md' else 'notes/' || source || '/' || doc_id || '.md' end"
_STATE = f"""n as (select {_KEY} k, doc_id % 8 <> 1 ex, {', '.join(f"doc_id % {m} <> 0 {f}" for f, m in _FLAGS.items())} from documents), p as (select distinct {_KEY} k from documents join labels using (doc_id) where doc_id % 3 <> 1),
  j as (select {_KEY} k, case when doc_id % 2 = 0 then 'note' else 'review' end stage from documents where doc_id % 7 = 0), u as (select {_KEY} k from documents where doc_id % 10 = 0),
  x as (select n.*, p.k is not null queued, j.stage, u.k is not null published, not contains(n.k, '/../') sound from n left join p using (k) left join j using (k) left join u using (k) where ex or p.k is not null or j.k is not null),
  y as (select *, ex and sound there, ex and sound and readable op from x),
  a as (select k, queued, stage, transcript, list_sort(list_filter([case when not sound then 'NOTE_REFERENCE_INVALID' end, case when sound and not ex then 'NOTE_MISSING' end, case when there and not readable then 'NOTE_UNREADABLE' end, case when op and not valid then 'NOTE_INVALID' end, case when op and not transcript then 'TRANSCRIPT_MISSING' end,
    case when op and not preview then 'PREVIEW_MISSING' when op and not preview_faithful then 'PREVIEW_STALE' end, case when op and not review then 'REVIEW_MISSING' when op and not review_valid then 'REVIEW_INVALID' end, case when op and not receipt then 'READINESS_MISSING' when op and not receipt_valid then 'READINESS_INVALID' when op and not (review and transcript and receipt_current) then 'READINESS_STALE' end,
    case when queued and not there then 'QUEUE_ORPHAN_REF' end, case when stage = 'note' then 'JOB_STAGED_NOTE' when stage = 'review' then 'JOB_STAGED_REVIEW' end, case when stage is not null and not there then 'JOB_ORPHAN_REF' end, case when there and not queued and stage is null and not receipt and not published then 'LEGACY_NOTE_UNTRACKED' end], lambda i: i is not null)) issues from y),
  r as (select *, case when len(issues) = 0 then null when list_contains(issues, 'TRANSCRIPT_MISSING') or (list_contains(issues, 'NOTE_MISSING') and not transcript) then 'restore_source_required' when list_contains(issues, 'NOTE_MISSING') then 'generate_missing_note' when list_contains(issues, 'NOTE_INVALID') then 'regenerate_invalid_note'
    when list_has_any(issues, ['READINESS_INVALID', 'NOTE_REFERENCE_INVALID']) then 'manual_triage_required' when list_has_any(issues, ['PREVIEW_MISSING', 'PREVIEW_STALE', 'REVIEW_MISSING', 'REVIEW_INVALID', 'READINESS_MISSING', 'READINESS_STALE', 'JOB_STAGED_REVIEW']) then 'repair_preview_or_review' else 'manual_triage_required' end act from a)"""


def _audit(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    id_ = F.col("doc_id").cast("string")
    keyed = docs.select("doc_id", F.when(F.col("doc_id") % 29 == 0, F.concat(F.lit("notes/../"), id_, F.lit(".md"))).otherwise(F.concat(F.lit("notes/"), "source", F.lit("/"), id_, F.lit(".md"))).alias("key"))
    notes = keyed.select("key", (F.col("doc_id") % 8 != 1).alias("exists"), *((F.col("doc_id") % m != 0).alias(f) for f, m in _FLAGS.items()))
    pending = keyed.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id").filter("doc_id % 3 <> 1").select("key")
    jobs = keyed.filter("doc_id % 7 = 0").select("key", F.when(F.col("doc_id") % 2 == 0, "note").otherwise("review").alias("stage"))
    return S.audit(notes, pending, jobs, keyed.filter("doc_id % 10 = 0").select("key"))


@query(f"with {_STATE} select k \"key\", array_to_string(issues, ',') issues from r")
def state_audit_issues(spark: SparkSession, d: str) -> DataFrame:
    """J20 and E17."""
    return _audit(spark, d).select("key", F.array_join("issues", ",").alias("issues"))


@query(f"with {_STATE} select issue, count(*)::bigint n, count(*) filter (queued)::bigint n_queued from (select queued, unnest(issues) issue from r) group by 1")
def issue_counts(spark: SparkSession, d: str) -> DataFrame:
    """A4."""
    return S.issue_counts(_audit(spark, d))


@query(f"""with {_STATE} select k "key", act "action" from r""")
def recovery_action(spark: SparkSession, d: str) -> DataFrame:
    """E17's actions."""
    return _audit(spark, d).select("key", "action")


@query(f"""with {_STATE} select count(*)::bigint notes, count(*) filter (queued)::bigint pending, count(stage)::bigint jobs, count(*) filter (len(issues) > 0)::bigint actionable, count(*) filter (len(issues) > 0 and queued)::bigint pending_actionable, sum(len(issues))::bigint issues,
  case when bool_or(list_has_any(issues, ['READINESS_INVALID', 'NOTE_REFERENCE_INVALID'])) then 2 when bool_or(len(issues) > 0) then 1 else 0 end status from r""")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    """E17's counts and status."""
    return S.audit_summary(_audit(spark, d))


_B = "b as (select o_orderkey k, o_orderstatus st, o_totalprice pr from orders where o_orderkey % 10 <> 3), a as (select o_orderkey k, case when o_orderkey % 17 = 0 then 'X' else o_orderstatus end st, o_totalprice pr from orders)"


@query(f"with {_B} select a.k \"key\", case when b.k is null then 'new' else 'changed' end kind from a left join b using (k) where b.k is null or a.st is distinct from b.st or a.pr is distinct from b.pr")
def change_detection(spark: SparkSession, d: str) -> DataFrame:
    """E21, J25 and K3."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("st"), F.col("o_totalprice").alias("pr"))
    after = o.withColumn("st", F.when(F.col("key") % 17 == 0, "X").otherwise(F.col("st")))
    return S.changed(o.filter("key % 10 <> 3"), after, "key", ["st", "pr"])


@query("""select doc_id "key", case when (doc_id % 11 = 0 or lb.doc_id is null) and (doc_id % 11 = 0 or doc_id % 7 = 0 or doc_id % 2 = 0) then 'note' when lb.doc_id is not null and doc_id % 7 = 0 then 'review' else 'none' end plan from documents left join (select distinct doc_id from labels) lb using (doc_id)""")
def job_plan(spark: SparkSession, d: str) -> DataFrame:
    """E25."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"))
    return S.planned(docs, table(spark, d, "labels").select(F.col("doc_id").alias("key")), docs.filter("key % 7 = 0"), docs.filter("key % 2 = 0"), F.col("key") % 11 == 0)


@query("""select doc_id, coalesce((select project from (values (0, 'src1', 'one'), (1, 'SRC', 'all'), (2, 'src2', 'two')) r(idx, prefix, project) where lower(source) like lower(prefix) || '%' order by idx limit 1), 'unsorted') project from documents""")
def routing_first_match(spark: SparkSession, d: str) -> DataFrame:
    """P19."""
    rules = spark.createDataFrame([(0, "src1", "one"), (1, "SRC", "all"), (2, "src2", "two")], "idx int, prefix string, project string")
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(S.routed(docs.select("source").distinct(), rules, "source", None), "source").select("doc_id", "project")


@query("""with x as (select doc_id::varchar source, lower(regexp_replace(trim(substr(text, 1, 6)), '[^0-9A-Za-z가-힣._-]+', '-', 'g')) base from documents), r as (select *, row_number() over (partition by base order by source) r from x), t as (select source, case when r = 1 then base else base || '-' || substr(sha256(source), 1, 8) end target from r), a as (select *, row_number() over (partition by target order by source) n from t) select source, case when n = 1 then target else target || '-' || n end target from a""")
def collision_names(spark: SparkSession, d: str) -> DataFrame:
    """E30."""
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source"), F.substring("text", 1, 6).alias("name"))
    return S.collision_names(files)


@query("""with l as (select o_orderkey k, o_orderpriority || o_custkey title, o_orderstatus h from orders), r as (select k + case when k % 5 = 0 then 1000000 else 0 end k, title, case when k % 3 = 0 then 'Z' else h end h from l where k % 2 = 0), t as (select title, count(*) n from r group by 1)
  select l.k "key", case when r.h = l.h then 'skip' when r.h is not null then 'update' when n = 1 then 'adopt' else 'create' end decision from l left join r using (k) left join t on l.title = t.title""")
def upload_decision(spark: SparkSession, d: str) -> DataFrame:
    """E31 and K9."""
    local = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.concat("o_orderpriority", F.col("o_custkey").cast("string")).alias("title"), F.col("o_orderstatus").alias("hash"))
    remote = local.filter("key % 2 = 0").select((F.col("key") + F.when(F.col("key") % 5 == 0, 1_000_000).otherwise(0)).alias("key"), "title", F.when(F.col("key") % 3 == 0, "Z").otherwise(F.col("hash")).alias("hash"))
    return S.upload_decision(local, remote)


@query("""with l as (select o_orderkey k, 'n' || o_orderkey || case when o_orderkey % 17 = 0 then '.txt' else '.md' end "key", o_orderkey % 19 <> 0 there, 't' || (o_custkey * 10 + o_orderkey % 7) title, o_orderstatus h, case when o_orderkey % 4 <> 0 then 'p' || o_custkey % 5 end people from orders),
  n as (select "key", case when k % 3 = 0 then 'old' else h end h, case when k % 5 <> 0 then 'page' || k end page, case when k % 6 = 1 then people else 'q' end people, k % 8 = 1 base from l where k % 2 = 1),
  p as (select 'page' || k page_id, case when k % 7 = 0 then title else 'x' || k end title, k % 11 = 0 archived from l where k % 3 <> 2), live as (select * from p where not archived), t as (select title, min(page_id) titled from live group by 1),
  x as (select l.*, n.page, coalesce(n.h = l.h, false) same, coalesce(n.base, false) base, n.people before, live.page_id is not null live, titled from l left join n using ("key") left join live on live.page_id = n.page left join t on t.title = l.title),
  y as (select *, case when not there then 'missing' when "key" not like '%.md' then 'not md' when same and people is not null and live and people is distinct from before then 'refresh' when same and base then 'baseline' when same then 'same' when live then 'update' when titled is not null then 'adopt' else 'create' end a from x),
  z as (select *, case when a = 'create' and row_number() over (partition by title, a order by "key") > 1 then 'adopt' else a end b from y)
  select "key", case b when 'not md' then 'skipped' when 'baseline' then 'skipped' when 'same' then 'skipped' else b end "action", case b when 'missing' then 'no such file' when 'not md' then 'not Markdown' when 'refresh' then 'participants' when 'same' then 'same hash' when 'update' then 'changed' when 'adopt' then 'title is there' when 'create' then 'new' else b end reason,
    case when b in ('refresh', 'baseline', 'same', 'update') then page when b = 'adopt' and a = 'adopt' then titled end page_id from z""")
def upload_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Notes by order; some missing, not Markdown, known before, with pages that are live, archived or gone, titles that are shared."""
    o = table(spark, d, "orders")
    s = lambda c: c.cast("string")
    k = F.col("o_orderkey")
    local = o.select(
        k.alias("k"), F.concat(F.lit("n"), s(k), F.when(k % 17 == 0, ".txt").otherwise(".md")).alias("key"), (k % 19 != 0).alias("exists"), F.concat(F.lit("t"), s(F.col("o_custkey") * 10 + k % 7)).alias("title"),
        F.col("o_orderstatus").alias("hash"), F.when(k % 4 != 0, F.concat(F.lit("p"), s(F.col("o_custkey") % 5))).alias("participants"),
    )
    k, page = F.col("k"), F.concat(F.lit("page"), s(F.col("k")))
    known = local.filter(k % 2 == 1).select("key", F.when(k % 3 == 0, "old").otherwise(F.col("hash")).alias("hash"), F.when(k % 5 != 0, page).alias("page_id"), F.when(k % 6 == 1, F.col("participants")).otherwise("q").alias("participants"), (k % 8 == 1).alias("baseline"))
    pages = local.filter(k % 3 != 2).select(page.alias("page_id"), F.when(k % 7 == 0, F.col("title")).otherwise(F.concat(F.lit("x"), s(k))).alias("title"), (k % 11 == 0).alias("archived"))
    return S.upload_outcomes(local.drop("k"), known, pages, refresh_participants=True)


@query("""with recursive b as (select c_custkey id, case when c_custkey > 1 then c_custkey // 2 end parent, case when c_custkey % 3 = 0 then c_name else '' end title from customer),
  u as (select b.id, p.id "at", p.title, 1 depth from b join b p on b.parent = p.id union all select u.id, p.id, p.title, depth + 1 from u join b c on u."at" = c.id join b p on c.parent = p.id where depth < 6)
  select id, arg_min(title, depth) title, min(depth)::int depth from u where title <> '' group by 1""")
def parent_walk(spark: SparkSession, d: str) -> DataFrame:
    """J19 over a tree of customers."""
    c = table(spark, d, "customer")
    blocks = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") > 1, F.floor(F.col("c_custkey") / 2).cast("long")).alias("parent_id"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise("").alias("title"))
    return S.ancestors(blocks)


@query("select o_orderkey \"key\", o_orderdate from orders where o_orderstatus = 'O' order by o_orderdate desc, o_orderkey desc limit 100")
def queue_topk(spark: SparkSession, d: str) -> DataFrame:
    """The newest hundred of a queue."""
    return table(spark, d, "orders").filter("o_orderstatus = 'O'").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(100).select(F.col("o_orderkey").alias("key"), "o_orderdate")


@query("""with k as (select distinct role, conv_id asked from conversations) select k.role, k.asked "at", p.conv_id, p.turn from k, lateral (select c.conv_id, c.turn from conversations c where c.role = k.role and c.conv_id < k.asked order by c.conv_id desc, c.turn desc limit 3) p""")
def previous_notes(spark: SparkSession, d: str) -> DataFrame:
    """For each conversation and role, the three most recent turns of that role in the conversations before."""
    held = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return N.previous(held, "role", "conv_id", "turn", 3)
