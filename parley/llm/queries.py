"""The queries opN_<name>: each gives the digest of one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fill_middle, language_id, licences, matroska, mixing, packing, pii, repair_tokens, repetition, resample, rule_ensemble, sharding, shingle_join
from .common import read, scratch, store


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(read(spark, sf_dir), read(spark, sf_dir, "labels"))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir))


def op3_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.classes(read(spark, sf_dir), k=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op4_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark):  # the files go once they have been read back
        return store(repair_tokens.digest(repair_tokens.stored(read(spark, sf_dir), special=True)), "digest", keep=True)


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir), special=True)


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.score(read(spark, sf_dir))


def op7_licence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(read(spark, sf_dir))


def op8_matroska_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark):  # the files go once they have been read back
        return store(matroska.digest(matroska.stored(read(spark, sf_dir))), "digest", keep=True)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir))


def op10_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(read(spark, sf_dir))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(read(spark, sf_dir))


def op12_clock_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read(spark, sf_dir, "clicks"), "linear", "Asia/Kolkata")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.transform(read(spark, sf_dir)))


_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Exact links over whole shingle sets, and what they reach.
OP3 = f"""with recursive d as (select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} w from documents),
  s as (select doc_id, unnest(list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) when len(w) > 0 then ['1: ' || array_to_string(w, ' ')] else [] end)) g from d),
  n as (select doc_id, count(*) n from s group by 1), m as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
  l as (select a, b from m join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)), e as (select a, b from l union all select b, a from l),
  r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
  select doc_id, coalesce(n, 0)::bigint n_shingles, least(doc_id, coalesce((select min(b) from r where a = doc_id), doc_id)) component_id from documents left join n using (doc_id)"""


def _repeats(k: int) -> str:
    """Per document and word position whether it stands in a window of k words that the document has twice."""
    window = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(k))
    found = f"g{k} as (select doc_id, g, list(i) ps from (select doc_id, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: struct_pack(g := {window}, i := i)), recursive := true) from d where len(w) >= {k}) group by 1, 2 having count(*) > 1)"
    return f"{found}, c{k} as (select doc_id, count(*) n, sum(length(w[p])) chars from (select distinct doc_id, i + j p from (select doc_id, unnest(ps) i from g{k}), range({k}) t(j)) join d using (doc_id) group by 1)"


_SIZES = (3, *repetition.COVERAGE)
_MOST = " or ".join([
    f"dup_line_chars / greatest(word_chars, 1) > {repetition.LINE_CHARS}", f"n_dup_lines > {repetition.LINES} * n_lines", f"n_symbols > {repetition.SYMBOLS} * n_words",
    *(f"covered_{k} / greatest(word_chars, 1) > {most}" for k, most in repetition.COVERAGE.items()),
])
#: Windows and lines as strings in place of hashes.
OP6 = f"""with d as (select doc_id, coalesce(text, '') t, {_WORDS.format("coalesce(text, '')")} w from documents), {", ".join(map(_repeats, _SIZES))},
  x as (select doc_id, i, x, sum(len({_WORDS.format("x")}))::bigint k, sum(length(x))::bigint chars from (select doc_id, unnest(string_split(t, chr(10))) x, generate_subscripts(string_split(t, chr(10)), 1) i from d) group by 1, 2, 3),
  y as (select *, row_number() over (partition by doc_id, x order by i) r from x where k > 0), z as (select doc_id, count(*) n_lines, count(*) filter (r > 1) n_dup_lines, coalesce(sum(chars) filter (r > 1), 0) dup_line_chars from y group by 1),
  o as (select doc_id, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda v: length(v))), 0)::bigint word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint n_symbols, coalesce(n_dup_lines, 0)::bigint n_dup_lines, coalesce(c3.n, 0)::bigint n_repeat_words, coalesce(n_lines, 0)::bigint n_lines, coalesce(dup_line_chars, 0)::bigint dup_line_chars,
    {", ".join(f"coalesce(c{k}.chars, 0)::bigint covered_{k}" for k in repetition.COVERAGE)} from d left join z using (doc_id) {" ".join(f"left join c{k} using (doc_id)" for k in _SIZES)}),
  b as (select *, n_words < {repetition.MIN_WORDS} or 100 * n_repeat_words > {repetition.REPEAT_PERCENT} * n_words base_failed from o) select *, not (base_failed or {_MOST}) kept from b"""


_FLOOR = "(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def _twice(u: str) -> str:
    """Twice the integral of the first u seconds of a segment."""
    return f"2::hugeint * v * {u} + " + _FLOOR.format(a=f"(w - v)::hugeint * {u} * {u}", b="d")


#: Points by a window, segments to the next point, which an hour's end cuts into two pieces at most.
OP12 = f"""with p as (select client_id, epoch_us(date_trunc('second', ts)) // 1000000 t, floor(100 * value + 0.5)::bigint v from clicks where client_id is not null and ts is not null and value is not null
    qualify row_number() over (partition by client_id, date_trunc('second', ts) order by click_id desc, value desc) = 1),
  h as (select *, t - (t + 19800) % 3600 hr, lead(t) over (partition by client_id order by t) - t d, lead(v) over (partition by client_id order by t) w from p),
  s as (select *, least(d, hr + 3600 - t) u from h where d <= 3600),
  k as (select client_id, hr, 0 n, u secs, {_twice("u")} area from s union all
    select client_id, hr + 3600, 0, d - u, {_twice("d")} - ({_twice("u")}) from s where d > u union all select client_id, hr, 1, 0, 0 from h),
  b as (select client_id, hr, sum(n)::bigint n_points, sum(secs)::bigint covered_seconds, sum(area)::hugeint area from k group by 1, 2)
  select client_id, hr::bigint bucket_start, n_points, covered_seconds, area::bigint area2, case when covered_seconds > 0 then {_FLOOR.format(a="area", b="2 * covered_seconds")} end::bigint avg_cents from b"""

#: The cuts as positions in the text: a line ends behind each line break, and at the text's end.
OP13 = """with t as (select doc_id, coalesce(text, '') x, sha256('7:' || doc_id) h from documents), l as (select *, string_split(x, chr(10)) y, list_transform([1, 9, 17, 25], lambda i: ('0x' || h[i : i + 7])::ubigint) r from t),
  n as (select *, (len(y) - (y[-1] = '')::int)::bigint n from l),
  e as (select *, list_transform([least(r[1] % (n + 1), r[2] % (n + 1)), greatest(r[1] % (n + 1), r[2] % (n + 1))], lambda k: least(length(x), coalesce(list_sum(list_transform(y[1 : k], lambda s: length(s) + 1)), 0))::bigint) c from n),
  f as (select *, case when x = '' or x similar to '(.|\n)*<[PSM]>(.|\n)*' then 'plain' when r[4] % 100 < 50 then 'spm' else 'psm' end form, left(x, c[1]) p, substr(x, c[1] + 1, c[2] - c[1]) m, substr(x, c[2] + 1) s from e)
  select doc_id, n, form, case when form <> 'plain' then c[1] end prefix_chars, case when form <> 'plain' then c[2] - c[1] end middle_chars,
    sha256(case form when 'plain' then x when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256, sha256(x) restored_sha256 from f"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_rule_ensemble, op2_kd_shards, op3_order_join, op4_repair_files, op5_pattern_packing, op6_repetition_rules, op7_licence_windows, op8_matroska_columns, op9_source_mix, op10_bootstrapped_pii, op11_language_id, op12_clock_hours, op13_fill_middle)}


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL expresses: exact links, repeated windows, integrals and cuts."""
    return {"op3_order_join": OP3, "op6_repetition_rules": OP6, "op12_clock_hours": OP12, "op13_fill_middle": OP13}
