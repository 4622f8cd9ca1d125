"""Queries of text functions, sources' parsers and rendering, over documents, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import times
from ..sources import parsers as P
from .base import query, table

ASCII = r"[^ -~]"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("select doc_id, len(list_filter(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> ''))::bigint words, length(regexp_replace(text, '\\s+', '', 'g'))::bigint chars from documents")
def text_units(spark: SparkSession, d: str) -> DataFrame:
    """units of word and character error rates."""
    return _docs(spark, d).select("doc_id", F.size(T.words(F.col("text"))).cast("long").alias("words"), F.length(T.cer_units(F.col("text"))).cast("long").alias("chars"))


@query("select doc_id, case when length(c) > 160 then rtrim(substr(c, 1, 160)) || '…' else c end short from (select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) c from documents)")
def capped_text(spark: SparkSession, d: str) -> DataFrame:
    """F10."""
    return _docs(spark, d).select("doc_id", T.capped(F.col("text"), 160).alias("short"))


@query("select doc_id, (i - 1)::bigint piece, substr(text, (i - 1) * 2000 + 1, 2000) part from (select doc_id, text, unnest(generate_series(1, ceil(length(text) / 2000.0)::bigint)) i from documents)")
def chunk_string(spark: SparkSession, d: str) -> DataFrame:
    """K10."""
    return _docs(spark, d).select("doc_id", F.posexplode(T.chunked(F.col("text"))).alias("piece", "part")).withColumn("piece", F.col("piece").cast("long"))


@query("""select doc_id, case when s = '' then 'untitled' else s end slug from (select doc_id, rtrim(substr(regexp_replace(regexp_replace(regexp_replace(trim(split_part(text, chr(10), 1)), '^[-*•\\s]+', ''), '[\\\\/:*?"<>|#%&{}$!''@+`=]', '', 'g'), '\\s+', '-', 'g'), 1, 60)) s from documents)""")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    """F12 of first lines."""
    return _docs(spark, d).select("doc_id", T.slug(F.split("text", "\n")[0]).alias("slug"))


@query("select page_id, '#' || regexp_replace(lower(trim(regexp_replace('4.' || page_id || ' ' || url, '[^0-9A-Za-z가-힣 -]+', '', 'g'))), '[ -]+', '-', 'g') anchor from pages")
def heading_anchors(spark: SparkSession, d: str) -> DataFrame:
    """F14."""
    return table(spark, d, "pages").select("page_id", T.anchor(F.concat(F.lit("4."), F.col("page_id").cast("string"), F.lit(" "), "url")).alias("anchor"))


@query("select page_id, lower(split_part(url, '://', 1)) = 'https' and regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) <> '' and lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) not in ('google.com', 'www.google.com', 'bing.com', 'www.bing.com', 'search.naver.com', 'duckduckgo.com') direct from (select page_id, url from pages union all select -page_id, 'https://' || case page_id % 6 when 0 then 'Google.com' when 1 then 'naver.com' when 2 then 'search.naver.com' when 3 then 'maps.google.com' when 4 then 'duckduckgo.com' else 'www.bing.com' end || '/q?' || page_id from pages)")
def direct_url_check(spark: SparkSession, d: str) -> DataFrame:
    """The addresses of pages, and as many at hosts that are search pages, or only look like them."""
    p = table(spark, d, "pages").select("page_id", "url")
    host = F.element_at(F.array(*map(F.lit, ("Google.com", "naver.com", "search.naver.com", "maps.google.com", "duckduckgo.com", "www.bing.com"))), (F.col("page_id") % 6 + 1).cast("int"))
    more = p.select((-F.col("page_id")).alias("page_id"), F.concat(F.lit("https://"), host, F.lit("/q?"), F.col("page_id").cast("string")).alias("url"))
    return p.union(more).select("page_id", T.direct_https(F.col("url")).alias("direct"))


@query("select page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<body[^>]*>(.*?)</body>', 1), '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) body from pages")
def transcript_extract_html(spark: SparkSession, d: str) -> DataFrame:
    """S14's extraction of a tagged block, on page bodies."""
    body = F.regexp_extract("html", r"(?is)<body[^>]*>(.*?)</body>", 1)
    return table(spark, d, "pages").select("page_id", T.collapsed(F.regexp_replace(body, r"(?s)<[^>]+>", " ")).alias("body"))


@query("select event_id, json_keys(props)::varchar[] is not null valid, coalesce(try_cast(json_extract_string(props, '$.page') as bigint), 0) page, coalesce(json_extract_string(props, '$.ref'), '') ref from events")
def json_props_safe_int(spark: SparkSession, d: str) -> DataFrame:
    """properties read safely."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$").isNotNull().alias("valid"), T.safe_int(F.get_json_object("props", "$.page")).alias("page"), F.coalesce(F.get_json_object("props", "$.ref"), F.lit("")).alias("ref"))


@query("select doc_id, sha256(text) sha, 'note-' || substr(sha256(source || '/' || doc_id), 1, 16) opaque from documents")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    """F45 and P23."""
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha"), F.concat(F.lit("note-"), F.substring(F.sha2(F.concat_ws("/", "source", F.col("doc_id").cast("string")), 256), 1, 16)).alias("opaque"))


@query("select doc_id, len(regexp_extract_all(text, '[0-9]+'))::bigint numbers, len(regexp_extract_all(regexp_replace(lower(text), '[^ -~]', '?', 'g'), '\\b(?:not|no|nicht|pas|non)\\b'))::bigint negations, len(regexp_extract_all(text, '[A-Za-z]{3,}'))::bigint terms from documents")
def risk_marker_counts(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, negations and ASCII terms."""
    n = lambda c, p: F.regexp_count(c, F.lit(p)).cast("long")
    return _docs(spark, d).select("doc_id", n(F.col("text"), "[0-9]+").alias("numbers"), n(F.regexp_replace(F.lower("text"), ASCII, "?"), r"\b(?:not|no|nicht|pas|non)\b").alias("negations"), n(F.col("text"), "[A-Za-z]{3,}").alias("terms"))


@query("select o_orderkey, printf('%02d:%02d:%02d', (o_totalprice::bigint // 3600)::bigint, (o_totalprice::bigint % 3600 // 60)::bigint, o_totalprice::bigint % 60) clock from (select o_orderkey, floor(o_totalprice) o_totalprice from orders)")
def clock_format(spark: SparkSession, d: str) -> DataFrame:
    """F29."""
    return table(spark, d, "orders").select("o_orderkey", times.clock(F.col("o_totalprice")).alias("clock"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') \"day\", o_orderdate >= timestamp '1998-08-02' - interval 186 days recent from orders")
def cutoff_filter(spark: SparkSession, d: str) -> DataFrame:
    """six months of 31 days before a fixed day."""
    now = F.lit("1998-08-02").cast("timestamp")
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (F.col("o_orderdate").cast("timestamp") >= times.cutoff(now, 6)).alias("recent"))


@query("""select doc_id, (i - 1)::bigint line_no, x line, regexp_extract(x, '^([A-Za-z0-9]+):', 1) speaker from (select doc_id, unnest(range(1, len(s) + 1)) i, unnest(s) x from (select doc_id, string_split(text, chr(10)) s from documents))""")
def transcript_lines(spark: SparkSession, d: str) -> DataFrame:
    """S3: texts to numbered lines with what a row expression finds."""
    lines = P.numbered_lines(_docs(spark, d).select(F.col("doc_id"), "text"), "doc_id", "text")
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line", F.regexp_extract("line", "^([A-Za-z0-9]+):", 1).alias("speaker"))


@query()
def edit_distance(spark: SparkSession, d: str) -> DataFrame:
    """F2 and the rate of F9's errors, on whole ASCII-mapped texts."""
    a, b = (F.substring(F.regexp_replace(c, ASCII, "?"), F.lit(i), F.length(c)) for c, i in ((F.col("text"), 1), (F.lower("text"), 3)))
    x = _docs(spark, d).filter(F.length("text") > 0).select("doc_id", a.alias("a"), b.alias("b")).repartition("doc_id").withColumn("distance", T.edit_distance("a", "b").cast("long"))
    return x.select("doc_id", "distance", F.greatest(F.length("a"), F.length("b")).cast("long").alias("longer"), (F.col("distance").cast("double") / F.length("a")).alias("rate"))


#: Turns of a task that compares them, about.
TURNS = 5_000


@query()
def ab_text_compare(spark: SparkSession, d: str) -> DataFrame:
    """Matching ratio of each conversation turn with the one before."""
    from pyspark.sql import Window

    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), c.count() // TURNS)  # a number given isn't lowered: a turn costs far more than its bytes
    return c.withColumn("before", before).filter("before is not null").repartition(parts, "conv_id", "turn").select("conv_id", "turn", T.matching_ratio(F.col("before"), F.col("text")).alias("ratio"))


_TIME = r"(?:[0-9]{1,2}:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]+)?"
_SPEAKER = r"^\s*(?:(?:화자|[Ss][Pp][Ee][Aa][Kk][Ee][Rr])\s*(?:[A-Za-z0-9가-힣_-]{1,32}|\?)\s*[:：]|(?:[A-Z]|S[1-9][0-9]*|\?)\s*[:：])\s*"
_PREFIXES = ("[00:01 - 00:02] 화자 A: ", "00:01 B:  ", "1:02:03.5 nobody ", "Speaker x_2 : ", "[1:02] ", "S12: ")


@query(f"""with t as (select conv_id, turn, nfc_normalize([{', '.join(f"'{p}'" for p in _PREFIXES)}][turn % {len(_PREFIXES)} + 1] || text || chr(10) || ' ' || chr(10) || 'C: e' || chr(769)) t from conversations), l as (select conv_id, turn, unnest(string_split_regex(t, '\\r\\n|\\r|\\n')) x, generate_subscripts(string_split_regex(t, '\\r\\n|\\r|\\n'), 1) i from t),
  b as (select *, regexp_replace(x, '^\\s*\\[\\s*{_TIME}(?:\\s*-\\s*{_TIME})?\\s*\\]\\s*', '') bare, regexp_replace(x, '^\\s*{_TIME}(\\s+)', '\\1') opened from l),
  c as (select conv_id, turn, i, trim(regexp_replace(regexp_replace(case when bare <> x then bare when regexp_matches(opened, '{_SPEAKER}') then opened else x end, '{_SPEAKER}', ''), '\\s+', ' ', 'g')) y from b) select conv_id, turn, string_agg(y, ' ' order by i) filter (y <> '') "text" from c group by 1, 2""")
def normalized_text(spark: SparkSession, d: str) -> DataFrame:
    """F8: composed, prefixes of times and speakers stripped from every line."""
    prefix = F.element_at(F.array(*map(F.lit, _PREFIXES)), (F.col("turn") % len(_PREFIXES) + 1).cast("int"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.normalized(F.concat(prefix, F.col("text"), F.lit("\n \nC: e\u0301"))).alias("text"))


@query("""with n as (select s_suppkey, case when s_suppkey % 4 = 0 then '남궁' else chr((44032 + (s_suppkey * 7919 + 11) % 11172)::int) end || chr((44032 + (s_suppkey * 104729 + 5) % 11172)::int) || case s_suppkey % 3 when 0 then '' when 1 then 'b' else chr((44032 + s_suppkey * 31 % 11172)::int) end "name" from supplier)
  select s_suppkey, array_to_string(list_transform(string_split("name", ''), lambda c: case when unicode(c) between 44032 and 55203 then substr('ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ', (unicode(c) - 44032) // 588 + 1, 1) || substr('ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ', (unicode(c) - 44032) % 588 // 28 + 1, 1) || trim(substr(' ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ', (unicode(c) - 44032) % 28 + 1, 1)) else c end), '') jamo,
  case when length("name") >= 4 and s_suppkey % 4 = 0 then substr("name", 3) when length("name") >= 3 then substr("name", 2) else "name" end given from n""")
def jamo_given_names(spark: SparkSession, d: str) -> DataFrame:
    """F1 and F4 on Hangul names made of the keys of suppliers."""
    k = F.col("s_suppkey")
    hangul = lambda n: F.decode(F.unhex(F.hex((n % 11172 + 0xAC00).cast("long"))), "UTF-16BE")
    name = F.concat(F.when(k % 4 == 0, "남궁").otherwise(hangul(k * 7919 + 11)), hangul(k * 104729 + 5), F.when(k % 3 == 0, "").when(k % 3 == 1, "b").otherwise(hangul(k * 31)))
    return table(spark, d, "supplier").select("s_suppkey", T.jamo(name).alias("jamo"), T.given_name(name).alias("given"))


@query("""select doc_id, greatest(length(regexp_replace(text, '\\*\\*([^*]+)\\*\\*', '\\1', 'g')), 0)::bigint n from documents""")
def bold_stripped(spark: SparkSession, d: str) -> DataFrame:
    """F15, its bold part: lengths without the marks."""
    return _docs(spark, d).select("doc_id", F.length(F.regexp_replace("text", r"\*\*([^*]+)\*\*", "$1")).cast("long").alias("n"))


_F = "'## 6. 객관 명제 팩트체크'"


@query(f"""select doc_id, sha256(rtrim(x, chr(10) || ' ') || chr(10)) hash, rtrim(x, chr(10) || ' ') || chr(10) = case when doc_id % 3 = 0 then rtrim(t, chr(10) || ' ') || chr(10) else rtrim(x, chr(10) || ' ') || chr(10) end same from (select doc_id, t, t x from (select doc_id, regexp_replace(text, '[^ -~\\n]', '?', 'g') t from documents))""")
def fact_section(spark: SparkSession, d: str) -> DataFrame:
    """a third of the texts end in a fact-check section; the hash is that of the text without it, once or twice stripped."""
    t = _docs(spark, d).select("doc_id", F.regexp_replace("text", r"[^ -~\n]", "?").alias("t"))
    noted = F.when(F.col("doc_id") % 3 == 0, T.with_facts(F.col("t"), F.concat(F.lit(T.FACTS), F.lit("\n\n- x\n## y\n")))).otherwise(F.col("t"))
    x = t.withColumn("text", noted)
    return x.select("doc_id", T.note_hash(F.col("text")).alias("hash"), (T.without_facts(T.without_facts(F.col("text"))) == T.without_facts(F.col("t"))).alias("same"))


@query("""select page_id, replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '"', '”') line, translate(replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '"', '”'), '[]', '()') link, replace(replace(replace(url, '\\', '\\\\'), '%', '\\%'), '_', '\\_') likes from (select page_id, url, regexp_replace(html, '[^ -~]', ' ', 'g') || '["x_%"]' t from pages)""")
def inline_forms(spark: SparkSession, d: str) -> DataFrame:
    """F11 and F27."""
    t = F.concat(F.regexp_replace("html", "[^ -~]", " "), F.lit('["x_%"]'))
    p = table(spark, d, "pages").select("page_id", "url", t.alias("t"))
    return p.select("page_id", T.one_line(F.col("t")).alias("line"), T.link_text(F.col("t")).alias("link"), T.like_escaped(F.col("url")).alias("likes"))


@query("""select conv_id, turn, case when length(w) = 0 then '' when list_bool_or(list_transform(p, lambda x: contains(trim(x), ' '))) then trim(array_to_string(p, '')) else trim(case when turn % 2 = 0 then array_to_string(p, '') else array_to_string(p, ' ') end) end joined from (select conv_id, turn, w, case when turn % 2 = 0 then list_transform(string_split(w, ' '), lambda x: ' ' || x) else string_split(w, ' ') end p from (select conv_id, turn, trim(regexp_replace(regexp_replace(text, '[^ -~]', ' ', 'g'), '\\s+', ' ', 'g')) w from conversations))""")
def joined_words(spark: SparkSession, d: str) -> DataFrame:
    """words that bring their spaces along, and words that don't."""
    w = T.collapsed(F.regexp_replace("text", "[^ -~]", " "))
    pieces = F.split("w", " ")
    c = table(spark, d, "conversations").select("conv_id", "turn", w.alias("w"))
    return c.select("conv_id", "turn", T.joined_words(F.when(F.col("turn") % 2 == 0, F.transform(pieces, lambda x: F.concat(F.lit(" "), x))).otherwise(pieces)).alias("joined"))
