"""Queries of ledgers, name checks, recordings and batch audits, over the tables that stand for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batch as B
from ..operators import identity as N
from ..operators import recordings as Q
from .base import query, table


@query("""with l as (select token variant, upper(token) target, count(*)::int "count" from (select unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) token from benchmark) where length(token) >= 5 group by 1, 2), t as (select doc_id, ' ' || regexp_replace(text, '[^가-힣A-Za-z0-9]', ' ', 'g') x from documents)
  select doc_id note, variant, target, "count" from t, l where contains(x, ' ' || variant)""")
def relevant_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The terms of the benchmark as variants, where words begin with them."""
    token = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)))
    ledger = table(spark, d, "benchmark").select(token.alias("variant")).filter(F.length("variant") >= 5).groupBy("variant").agg(F.count("*").cast("int").alias("count")).withColumn("target", F.upper("variant"))
    return N.relevant_ledger(table(spark, d, "documents").select(F.col("doc_id").alias("note"), "text"), ledger)


_LINES = ("가옹이 발표했다", "나가옹 참석", "오늘 가옹님.", "## 5.2 검증 완료", "x 가옹다시", "비티에에게 보냄", "## 4. 상세", "다람, 가옹", "그 다람의 말", "다람쥐 둘", "(가옹씨는) 다람도")


def _usage(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    said = F.element_at(F.array(*map(F.lit, _LINES)), (F.col("c_custkey") * 7 % len(_LINES) + 1).cast("int"))
    lines = c.select(F.col("c_nationkey").alias("note"), F.col("c_custkey").cast("int").alias("line_no"), said.alias("line"))
    ledger = spark.createDataFrame([("가옹", "가온 (팀)", 9), ("비티에", "BT", 3), ("다람", "다람쥐", 8), ("가온", "가온", 30), ("x", "y", 40)], "variant string, target string, count int")
    return N.usage_issues(lines, ledger, spark.createDataFrame([], "name string"))


_ISSUES = f"""l as (select c_nationkey note, c_custkey::int line_no, [{', '.join(f"'{x}'" for x in _LINES)}][c_custkey * 7 % {len(_LINES)} + 1] line from customer),
  s as (select *, last_value(nullif(regexp_extract(line, '^#{{2,3}}\\s*(?:[0-9]+(?:[.][0-9]+)*[.]?\\s*)?(.+?)\\s*$', 1), '') ignore nulls) over (partition by note order by line_no rows unbounded preceding) sec from l),
  v as (select * from (values ('가옹', '가온 (팀)', 9), ('다람', '다람쥐', 8)) t(variant, target, "count")),
  i as (select note, line_no, line, variant, target, "count" from s, v where coalesce(sec <> '검증 완료', true) and regexp_matches(line, '(?:^|[^가-힣A-Za-z0-9])' || variant || '(?:님|씨)?(?:$|[^가-힣A-Za-z0-9]|은|는|이|가|을|를|과|와|에게|께|도|만|로|으로|의)'))"""


@query(f"with {_ISSUES} select * from i")
def usage_gate(spark: SparkSession, d: str) -> DataFrame:
    """Lines by nation, in which variants stand alone, within other words, with particles, and in a section of completed checks."""
    return _usage(spark, d)


@query(f"""with {_ISSUES} select note, line_no, variant, rank::int rank, total::bigint total, total > 3 truncated from (select *, row_number() over (partition by note order by line_no, variant) rank, count(*) over (partition by note) total from i) where rank <= 3""")
def usage_report(spark: SparkSession, d: str) -> DataFrame:
    """The first three issues of each note, and whether there are more."""
    return N.reported(_usage(spark, d), ["note"], ["line_no", "variant"], 3).select("note", "line_no", "variant", "rank", "total", "truncated")


#: Latin letters as syllables, some of them particles, so that words of documents are Hangul words; every twelfth line is a heading instead.
_LATIN, _SYLLABLES = "abcdefghijklmnopqrstuvwxyz", "은나다라이바사아가차카타파하의너더러를버도로저처만터"
_HEADS = ("## 5.2 검증 완료", "### 4. 상세")


@query(f"""with v as (select translate(x, '{_LATIN}', '{_SYLLABLES}') variant, upper(x) target, count(*)::int "count" from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) x from benchmark) where length(x) between 3 and 8 group by 1, 2 having count(*) >= 2),
  l as (select doc_id note, unnest(s) x, unnest(range(len(s)))::int line_no from (select doc_id, string_split(text, chr(10)) s from documents)),
  h as (select note, line_no, case when (note + line_no) % 12 = 5 then case when note % 2 = 0 then '{_HEADS[0]}' else '{_HEADS[1]}' end else trim(translate(regexp_replace(lower(x), '[^ -~]', '?', 'g'), '{_LATIN}', '{_SYLLABLES}')) end line from l),
  s as (select *, last_value(nullif(regexp_extract(line, '^#{{2,3}}\\s*(?:[0-9]+(?:[.][0-9]+)*[.]?\\s*)?(.+?)\\s*$', 1), '') ignore nulls) over (partition by note order by line_no rows unbounded preceding) sec from h),
  w as (select distinct note, line_no, line, unnest(regexp_extract_all(line, '[가-힣A-Za-z0-9]+')) word from s where coalesce(sec <> '검증 완료', true)), k as (select distinct word from w),
  m as (select word, variant, target, "count" from k, v where starts_with(word, variant) and regexp_matches(substr(word, length(variant) + 1), '^(?:님|씨)?(?:$|은|는|이|가|을|를|과|와|에게|께|도|만|로|으로|의)'))
  select distinct note, line_no, line, variant, target, "count" from w join m using (word)""")
def usage_in_documents(spark: SparkSession, d: str) -> DataFrame:
    """E14 over the lines of whole documents, with the repeated words of the benchmark as a ledger."""
    hangul = lambda c: F.translate(c, _LATIN, _SYLLABLES)
    word = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w")).filter(F.length("w").between(3, 8))
    ledger = word.groupBy(hangul(F.col("w")).alias("variant"), F.upper("w").alias("target")).agg(F.count("*").cast("int").alias("count"))
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("note"), F.posexplode(F.split("text", "\n")).alias("line_no", "x"))
    head = F.when(F.col("note") % 2 == 0, _HEADS[0]).otherwise(_HEADS[1])
    said = F.when((F.col("note") + F.col("line_no")) % 12 == 5, head).otherwise(F.trim(hangul(F.regexp_replace(F.lower("x"), "[^ -~]", "?"))))
    return N.usage_issues(lines.select("note", "line_no", said.alias("line")), ledger, spark.createDataFrame([], "name string"), least=2)


@query("""with n as (select distinct unnest(regexp_extract_all(text, '[A-Z][a-z]+')) "name" from benchmark), m as (select doc_id note, unnest(r) "name", unnest(range(len(r))) pos from (select doc_id, regexp_extract_all(text, '[A-Z][a-z]+') r from documents)), f as (select note, "name", min(pos) pos from m where "name" in (select "name" from n) group by 1, 2)
  select note, string_agg("name", ',' order by pos) confirmed from f group by 1""")
def confirmed_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised words of documents that the benchmark has as well, in order."""
    words = F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0))
    names = table(spark, d, "benchmark").select(F.explode(words).alias("name")).distinct()
    notes = table(spark, d, "documents").select(F.col("doc_id").alias("note"), words.alias("mentions"))
    return N.confirmed_mentions(notes, names).select("note", F.array_join("confirmed", ",").alias("confirmed"))


_W = "w as (select doc_id note, lower(x) variant, x target from (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{3,}'))) x from documents))"


@query(f"with {_W} select target, variant, count(distinct note)::bigint \"count\" from w where note < 100 group by 1, 2")
def ledger_before(spark: SparkSession, d: str) -> DataFrame:
    """E8's strict cut: counts of notes before one note."""
    w = table(spark, d, "documents").select(F.col("doc_id").alias("note"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{3,}"), F.lit(0)))).alias("target"))
    return N.ledger_counts(w.withColumn("variant", F.lower("target")), F.lit(100))


@query()
def phonetic_hints(spark: SparkSession, d: str) -> DataFrame:
    """Hangul names made of the keys of suppliers, heard with one letter changed in turns that customers stand for."""
    hangul = lambda n: F.decode(F.unhex(F.hex((n + 0xAC00).cast("long"))), "UTF-16BE")
    syllable = lambda key, a, b: hangul((key * a + b) % 11172)
    name = lambda key, shift: F.concat(syllable(key, 7919, 11), syllable(key, 104729, 5), hangul((key * 31 + 7) % 11172 + shift))
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    roster = table(spark, d, "supplier").select(name(s, F.lit(0)).alias("name"), F.lit("팀").alias("department"), F.lit("").alias("position"), F.when(s % 3 == 0, "former").otherwise("active").alias("employment_status")).dropDuplicates(["name"])
    heard = name(c % 100 + 1, F.when(c % 28 == 27, 0).otherwise(1))
    turns = table(spark, d, "customer").select((c % 40).alias("note"), F.concat(heard, F.when(c % 2 == 0, "님 ").otherwise(" ")).alias("x")).groupBy("note").agg(F.array_join(F.array_sort(F.collect_list("x")), " ").alias("text"))
    return N.phonetic_hints(turns, roster).select("note", "token", "candidates", "rank")


_ITEMS = """i as (select event_type project, event_id::varchar path, epoch_us(ts) / 1000000.0 "start", case when event_id % 17 = 0 then null else 20.0 + event_id % 90 end dur from events), done as (select event_type project, event_id::varchar path from events where event_id % 10 = 0),
  sl as (select path, 0.02 a, dur * 0.1 z from i where path::bigint % 3 = 0 union all select path, dur * 0.8, case when path::bigint % 8 = 0 then null else dur end from i where path::bigint % 4 = 0 union all select path, dur * 0.15, dur * 0.79 from i where path::bigint % 5 = 0 and dur is not null)"""


@query(f"""with {_ITEMS}, n as (select i.* from i anti join done using (project, path)), e as (select n.path, n.dur, min(a) a, arg_min(z, a) az, max(a) b, arg_max(coalesce(z, dur), a) bz from n join sl using (path) where n.dur is not null group by 1, 2),
  w as (select path, dur, case when a <= 0.05 and az is not null then greatest(az - 0.25, 0.0) else 0.0 end f, case when bz >= dur - 0.05 and b < dur then least(b + 0.25, dur) else dur end t from e), t as (select path, f, t from w where t > f and (f > 0 or t < dur)),
  x as (select n.project, n.path, n."start", n.dur, coalesce(t.f + n.dur - t.t >= 1, false) trimmed, case when coalesce(t.f + n.dur - t.t >= 1, false) then t.f else 0.0 end f, case when coalesce(t.f + n.dur - t.t >= 1, false) then t.t else n.dur end t from n left join t using (path)),
  q as (select x.*, (select sum(greatest(least(coalesce(z, x.t), x.t) - greatest(a, x.f), 0.0)) from sl where sl.path = x.path) silent from x), r as (select project, path, "start" + f "start", t - f duration, trimmed, case when t - f is null then 'no duration' when t - f < 30 then 'too short' when coalesce(silent, 0) / nullif(t - f, 0) >= 0.6 then 'silent' end reason from q),
  g as (select *, case when "start" - lag("start" + duration) over o between 0 and 7200 then 0 else 1 end nw from r where reason is null window o as (partition by project order by "start", path)), h as (select project, path, sum(nw) over (partition by project order by "start", path rows unbounded preceding) grp from g)
  select project, path, round(duration, 6) duration, trimmed, reason, grp::bigint grp from r left join h using (project, path)""")
def prepared_queue(spark: SparkSession, d: str) -> DataFrame:
    """P5, P4, P3 with A8, and W2, over events as recordings."""
    e = table(spark, d, "events")
    n = F.col("event_id")
    items = e.select(F.col("event_type").alias("project"), n.cast("string").alias("path"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("start"), F.when(n % 17 != 0, 20.0 + n % 90).alias("duration"))
    done = e.filter("event_id % 10 = 0").select(F.col("event_type").alias("project"), n.cast("string").alias("path"))
    key = F.col("path").cast("long")
    part = lambda rows, a, z: rows.select("path", a.alias("silence_start"), z.alias("silence_end"))
    dur = F.col("duration")
    silences = part(items.filter(key % 3 == 0), F.lit(0.02), dur * 0.1).union(part(items.filter(key % 4 == 0), dur * 0.8, F.when(key % 8 != 0, dur))).union(part(items.filter((key % 5 == 0) & dur.isNotNull()), dur * 0.15, dur * 0.79))
    out = Q.prepared(items, done, silences, most_silent=0.6, gap=7200.0)
    return out.select("project", "path", F.round("duration", 6).alias("duration"), "trimmed", "reason", F.col("grp").cast("long").alias("grp"))


@query(f"with {_ITEMS} select path, round(sum(greatest(coalesce(z, i.dur) - a, 0.0)), 6) silent from sl join i using (path) where i.dur is not null group by 1")
def silence_totals(spark: SparkSession, d: str) -> DataFrame:
    """Seconds of silence of each recording."""
    n = F.col("event_id")
    items = table(spark, d, "events").select(n.cast("string").alias("path"), (20.0 + n % 90).alias("duration")).filter(F.col("path").cast("long") % 17 != 0)
    key, dur = F.col("path").cast("long"), F.col("duration")
    part = lambda rows, a, z: rows.select("path", "duration", a.alias("silence_start"), z.alias("silence_end"))
    silences = part(items.filter(key % 3 == 0), F.lit(0.02), dur * 0.1).union(part(items.filter(key % 4 == 0), dur * 0.8, F.when(key % 8 != 0, dur))).union(part(items.filter(key % 5 == 0), dur * 0.15, dur * 0.79))
    return Q.silence_totals(silences).withColumn("silent", F.round("silent", 6))


@query("""with r as (select o_orderkey k, list_sort(list_distinct(list_filter(['4.' || o_orderkey % 7, '4.' || o_custkey % 5, '4.1'], lambda x: not list_contains(list_transform(range(1, o_orderkey % 4 + 1), lambda i: '4.' || i), x)))) missing, list_sort(list_distinct(list_filter(['#4' || o_orderkey % 7 || '-a-b', '#41-a-b', '#x'], lambda x: not list_contains(list_transform(range(1, o_orderkey % 4 + 1), lambda i: '#4' || i || '-a-b'), x)))) broken from orders)
  select k o_orderkey, array_to_string(missing, ',') missing, array_to_string(broken, ',') broken from r""")
def evidence_links(spark: SparkSession, d: str) -> DataFrame:
    """References without a heading, and links without one."""
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    heads = F.array_join(F.transform(F.slice(F.array(*map(F.lit, "123")), F.lit(1), (k % 4).cast("int")), lambda i: F.concat(F.lit("### 4."), i, F.lit(" a_  B"))), "\n")
    primary = F.concat(F.lit("x §4."), s(k % 7), F.lit(", §4."), s(F.col("o_custkey") % 5), F.lit(" §4.1"))
    readable = F.concat(heads, F.lit("\n[t](#4"), s(k % 7), F.lit("-a-b) [u](#41-a-b) [v](#x) [w](https://x)"))
    o = table(spark, d, "orders").select("o_orderkey", heads.alias("text"), primary.alias("primary"), readable.alias("readable"))
    return o.select("o_orderkey", F.array_join(B.missing_refs(F.col("primary"), F.col("text")), ",").alias("missing"), F.array_join(B.broken_anchors(F.col("readable")), ",").alias("broken"))


@query("""with c as (select conv_id, list(distinct role order by role) roles, string_agg(text, ' ' order by turn) t from conversations group by 1) select conv_id, array_to_string(list_filter(list_concat(roles, ['nobody']), lambda r: not contains(t, r)), ',') missing from c""")
def missing_attendees(spark: SparkSession, d: str) -> DataFrame:
    """Roles that the text of their conversation doesn't name."""
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ")
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("roles"), ordered.alias("t"))
    return c.select("conv_id", F.array_join(B.missing_attendees(F.concat("roles", F.array(F.lit("nobody"))), F.col("t")), ",").alias("missing"))


@query("""with q as (select item_id, unnest(r) v, unnest(range(len(r))) i from (select item_id, regexp_extract_all(lower(text), '[a-z]{6,}') r from benchmark)), t as (select item_id, list(v order by i) w from (select item_id, v, min(i) i from q group by 1, 2) group by 1), x as (select item_id, [w[1], w[2]] terms, w[1] t1, w[2] t2 from t where len(w) >= 2), f as (select s_suppkey, s_name, 'src' || s_suppkey % 3 src, s_nationkey from supplier where s_suppkey <= 2)
  select item_id note, '# 회의 전 근거 컨텍스트' || chr(10) || chr(10) || '## 검색어' || chr(10) || '- `' || t1 || '`' || chr(10) || '- `' || t2 || '`' || chr(10) || chr(10) || '## 관련 회의' || chr(10) || case when item_id % 2 = 0 then '- 관련 회의 없음' else chr(10) || '### 2024-01-01 · 팀 — 회의' || chr(10) || '- 집계: 결정 1 · 미결액션 0 · 리스크 ' || item_id % 3 || chr(10) || '- 주제: a, b' end || chr(10)
   || chr(10) || '## 근거 후보' || chr(10) || chr(10) || '### `' || t1 || '`' || chr(10) || '- source presence: doc, note' || chr(10) || '- [note] T (2024)' || chr(10) || '  - ref: `u`' || chr(10) || '  - snippet: s' || chr(10) || '- [doc] U (date unknown)' || chr(10) || '  - ref: `v`' || chr(10) || '  - snippet: snippet 없음' || chr(10) || chr(10) || '### `' || t2 || '`' || chr(10) || '- hit 없음' || chr(10) context from x""")
def evidence_context(spark: SparkSession, d: str) -> DataFrame:
    """What was found for the first two longer words of each passage."""
    w = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0)))
    t = table(spark, d, "benchmark").select(F.col("item_id").alias("note"), w.alias("w")).filter(F.size("w") >= 2).select("note", F.slice("w", 1, 2).alias("terms"))
    meeting = F.struct(F.lit("회의").alias("title"), F.lit("2024-01-01").alias("date"), F.lit("팀").alias("team"), F.lit(1).alias("decision_count"), F.lit(None).cast("int").alias("open_action_count"), (F.col("note") % 3).cast("int").alias("risk_count"), F.array(F.lit("a"), F.lit("b")).alias("topics"), F.array().cast("array<string>").alias("mentions"), F.array().cast("array<string>").alias("decisions"))
    hit = lambda source, title, day, place, snippet: F.struct(F.col("terms")[0].alias("term"), F.lit(source).alias("source"), F.lit(title).alias("title"), F.lit(day).cast("string").alias("day"), F.lit(place).alias("place"), F.lit(snippet).alias("snippet"))
    rows = t.withColumn("related", F.when(F.col("note") % 2 == 1, F.array(meeting)).otherwise(F.slice(F.array(meeting), 1, 0))).withColumn("confirmed", F.array().cast("array<string>")).withColumn("found", F.array(hit("note", "T", "2024", "u", "s"), hit("doc", "U", None, "v", "")))
    return B.context(rows)


@query("""select doc_id, list_filter([case when len(w) > 8 then 'too many candidates' end, case when doc_id % 4 = 1 then 'ids not contiguous' end, case when doc_id % 6 = 1 then 'ends before it starts' end, case when doc_id % 5 = 2 then 'bad checkability' end, case when doc_id % 3 = 0 and doc_id % 5 not in (0, 1) then 'search not possible' end, case when doc_id % 3 = 0 and doc_id % 7 = 0 then 'search without a public claim' end, case when doc_id % 5 = 4 then 'no counterpart' end], lambda x: x is not null)::varchar[] errors
  from (select doc_id, range(doc_id % 12 + 1) w from documents)""")
def candidate_errors(spark: SparkSession, d: str) -> DataFrame:
    """Candidates made of documents, each with what is wrong with it."""
    from ..operators import review as R

    n = F.col("doc_id")
    kind = F.when(n % 5 == 0, "public_web").when(n % 5 == 1, "deterministic").when(n % 5 == 2, "other").when(n % 5 == 3, "internal_authority").otherwise("speaker_conflict")
    idx = (n % 12 + 1).cast("int")
    c = table(spark, d, "documents").select(
        n.alias("meeting"), idx.alias("idx"), F.concat(F.lit("C"), F.when(n % 4 == 1, idx + 1).otherwise(idx).cast("string")).alias("id"), F.lit("A").alias("speaker"), F.lit(1.0).alias("start_seconds"), F.when(n % 6 == 1, 0.5).otherwise(2.0).alias("end_seconds"),
        F.lit("c").alias("claim_text"), F.when(n % 7 == 0, " ").otherwise("p").alias("public_claim"), F.lit("e").alias("required_evidence"), kind.alias("checkability"), F.lit("high").alias("importance"), F.lit(False).alias("stt_risk"), (n % 3 == 0).alias("web_search_allowed"), F.array().cast("array<struct<speaker: string>>").alias("counterpart_claims"),
    )
    return R.candidate_errors(c).select(F.col("meeting").alias("doc_id"), "errors")


def _noted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Notes made of customers: two corrections each, one in a section of open checks; and their transcripts."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    target = F.concat(F.lit("표준"), n, F.when(k % 6 == 0, " 추정").otherwise(""))
    text = F.concat(F.lit("# t\n- `밖` → **안**\n### 5.2 검증 완료\n- `가"), n, F.lit("님`, 나"), n, F.lit(" (화자 A) → **"), target, F.lit("**, ok\n- 글 없음\n### 기타 메모\n- **제품**: 알파"), n, F.lit(" (옛), 근거 말\n- `코드"), n, F.lit("` 씀\n### 5.3 검증 필요\n- `다` → **라"), n, F.lit("**\n"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # keys move, not the notes made of them
    said = c.filter("c_custkey % 5 <> 0").select(k.alias("note"), F.concat(F.lit("가"), n, F.when(k % 4 != 0, F.concat(F.lit(" 나"), n)).otherwise("")).alias("text"))
    return c.select(k.alias("note"), text.alias("text")), said


_CORRECTED = "c as (select c_custkey k, c_nationkey n from customer where c_custkey % 6 <> 0), g as (select k, '표준' || n target, '가' || n variant from c union all select k, '표준' || n, '나' || n from c where k % 5 = 0 or k % 4 <> 0)"


@query(f"""with {_CORRECTED}, l as (select target, variant, count(*) m from g where k < 120 group by 1, 2 having count(*) >= 2), r as (select *, row_number() over (order by m desc, target, variant) i from l qualify i <= 20)
  select i::int + 2 line_no, '- ' || variant || ' → **' || target || '** (' || m || '회)' line from r union all select * from (values {", ".join(f"({i}, '{x}')" for i, x in enumerate(N.PREFACE))}) t""")
def ledger_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of notes before one, of corrections that two notes or more confirm, as its lines."""
    notes, said = _noted(spark, d)
    return N.ledger_lines(N.ledger(notes, said, F.lit(120), 2), 20)


@query("""with t as (select c_custkey k, unnest(['알파' || c_nationkey, '코드' || c_nationkey, '표준' || c_nationkey, '라' || c_nationkey]) term, unnest([0, 1, 2, 3]) p, c_custkey % 6 = 0 hedged from customer), f as (select term, min((k, p)) f from t where not (hedged and p = 2) group by 1) select term, f[1] note from f order by f limit 80""")
def glossary_terms(spark: SparkSession, d: str) -> DataFrame:
    """The terms of notes by first appearance."""
    return N.glossary(_noted(spark, d)[0])
