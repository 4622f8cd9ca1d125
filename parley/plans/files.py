"""Queries of readers and parsers: each writes a table in the form that a reader takes, and reads it back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import parsers as P
from ..sources import readers as R
from .base import query, table

PER_FILE = 200


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, removed when the application ends; without one set, a temporary one, with a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="parley-files-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)  # results are read lazily, so it stays until the application ends
    return path


def _written(lines: DataFrame, column: str, name: str) -> str:
    """A text file for each partition."""
    path = scratch_folder(lines.sparkSession, name)
    lines.select(F.col(column).alias("value")).write.text(path)
    return path


def _documents(rows: DataFrame, key: Column, value: Column, name: str, whole: Column | None = None) -> str:
    """Files that each hold one JSON document: an array of ``value`` (or what ``whole`` makes of it) of about PER_FILE keys."""
    path = scratch_folder(rows.sparkSession, name)
    n = max(1, -(-rows.count() // PER_FILE))
    dealt = rows.withColumn("file", F.pmod(F.xxhash64(key), F.lit(n))).groupBy("file").agg(F.collect_list(value).alias("all"))
    dealt.select("file", F.to_json("all" if whole is None else whole).alias("value")).write.partitionBy("file").text(path)
    return f"{path}/*/part-*"


def _segments(spark: SparkSession, d: str, diarized: bool) -> str:
    c = table(spark, d, "conversations")
    at = (F.col("turn") * 10).cast("double")
    words = F.transform(F.filter(F.split("text", " "), lambda w: w != ""), lambda w, i: F.struct(F.when(i % 7 != 6, at + i * 0.5).alias("start"), (at + i * 0.5 + 0.4).alias("end"), w.alias("word")))
    one = F.struct(at.alias("start"), F.when(F.col("turn") % 5 == 4, at - 1).otherwise(at + 9).alias("end"), *([F.col("role").alias("speaker")] if diarized else [F.col("text").alias("text"), words.alias("words")]))
    m = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("s")))).alias("x"))
    value = F.struct(F.col("conv_id").cast("string").alias("meeting_id"), F.lit("en").alias("language"), F.transform("x", lambda x: x["s"]).alias("segments"))
    return _documents(m, F.col("conv_id"), value, "segments")


@query("""with w as (select conv_id, turn, unnest(p) word, unnest(range(len(p))) i from (select conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') p from conversations)) select conv_id::varchar meeting_id, row_number() over (partition by conv_id order by turn * 10 + i * 0.5, turn * 10 + i * 0.5 + 0.4)::int - 1 word_idx, round(turn * 10 + i * 0.5, 6)::double "start" from w where i % 7 <> 6""")
def segment_words(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with nested words, from JSON files; words without a start are left out."""
    return P.words_of(R.segments(spark, _segments(spark, d, False))).select("meeting_id", "word_idx", F.round("start", 6).alias("start"))


@query("""select conv_id::varchar meeting_id, (row_number() over (partition by conv_id order by turn) - 1)::int turn_idx, role speaker, (turn * 10)::double "start" from conversations qualify turn % 5 <> 4""")
def diarized_turns(spark: SparkSession, d: str) -> DataFrame:
    """Diarization from JSON files; turns that end before they begin are left out."""
    from .. import schemas

    rows = spark.read.schema(schemas.DIARIZED).option("multiLine", True).json(_segments(spark, d, True))
    return P.turns_of(rows).select("meeting_id", "turn_idx", "speaker", "start")


@query("""select c_name "name", c_mktsegment department, case when c_custkey % 3 = 0 then '' else 'p' end "position", case when c_custkey % 2 = 0 then 'active' else 'unverified' end employment_status from customer""")
def roster_files(spark: SparkSession, d: str) -> DataFrame:
    """Rosters with a header in each file, rows without their last cells, and blank lines."""
    key = F.col("c_custkey")
    row = F.when(key % 6 == 3, F.concat_ws("\t", F.concat(F.lit(" "), "c_name"), "c_mktsegment")).otherwise(F.concat_ws("\t", "c_name", "c_mktsegment", F.when(key % 3 == 0, "").otherwise("p"), F.when(key % 2 == 0, "active").otherwise("")))
    c = table(spark, d, "customer")
    head = spark.createDataFrame([("name\tdepartment\tposition\temployment_status\tlast_confirmed\tsource",), ("",)], "row string")
    path = _written(head.union(c.select(row.alias("row"))), "row", "roster")
    return R.roster_tsv(spark, path).select("name", "department", "position", "employment_status")


@query("select s_name \"name\", s_nationkey::varchar nation, 'a,\"b\"' note from supplier")
def roster_csv_files(spark: SparkSession, d: str) -> DataFrame:
    """CSV with quoted cells, and a header that begins with a byte order mark."""
    s, path = table(spark, d, "supplier"), scratch_folder(spark, "csv")
    n = max(1, -(-s.count() // PER_FILE))
    quoted = F.concat(F.col("s_name"), F.lit(","), F.col("s_nationkey").cast("string"), F.lit(',"a,""b"""'))
    files = s.groupBy(F.pmod(F.col("s_suppkey"), F.lit(n)).alias("file")).agg(F.collect_list(quoted).alias("rows"))
    files.select("file", F.concat(F.lit("\ufeffName, Nation ,NOTE\n"), F.array_join("rows", "\n")).alias("value")).write.partitionBy("file").text(path)
    path = f"{path}/*/part-*"
    return R.roster_csv(spark, path).select("name", "nation", "note")


@query("""select n_regionkey::varchar r, n_name "name", 'k' || n_nationkey "key" from nation""")
def directory_table(spark: SparkSession, d: str) -> DataFrame:
    """Markdown tables under headings, one text per region: names with the heading above them."""
    n = table(spark, d, "nation")
    lines = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("x"))
    rows = F.transform("x", lambda x: F.concat(F.lit("| "), x["n_name"], F.lit(" |  k"), x["n_nationkey"].cast("string"), F.lit(" |")))
    text = F.array_join(F.concat(F.array(F.concat(F.lit("## "), F.col("n_regionkey").cast("string")), F.lit("|:--|---|")), rows, F.array(F.lit("end"))), "\n")
    t = P.pipe_table(P.numbered_lines(lines.select(F.col("n_regionkey").alias("key"), text.alias("text")), "key", "text"), "key")
    return t.select(F.col("department").alias("r"), F.col("cells")[0].alias("name"), F.col("cells")[1].alias("key"))


@query("""select 'u' || c_custkey id, c_name "name", 'c' || c_custkey || '@corp.example' email from customer where c_custkey % 3 <> 0""")
def user_files(spark: SparkSession, d: str) -> DataFrame:
    """Objects of users by id, from JSON files; those of other companies are left out."""
    key = F.col("c_custkey").cast("string")
    mail = F.concat(F.lit("C"), key, F.when(F.col("c_custkey") % 3 == 0, "@other.example").otherwise("@corp.example"))
    entry = F.struct(F.concat(F.lit("u"), key), F.struct(F.concat(F.lit(" "), "c_name").alias("name"), mail.alias("email")))
    path = _documents(table(spark, d, "customer"), F.col("c_custkey"), entry, "users", F.map_from_entries("all"))
    return R.users_json(spark, path, "corp.example")


@query("""with l as (select p_partkey, lower(p_brand) a, p_type b, p_size n from part where p_partkey % 4 <> 0) select a || p_partkey variant, b target, n::int "count" from l union all select 'x' || p_partkey, b, n::int from l where p_partkey % 2 = 0""")
def ledger_lines(spark: SparkSession, d: str) -> DataFrame:
    """Ledger lines with one or two variants; others are no entries."""
    k = F.col("p_partkey")
    a = F.concat(F.lit("- `"), F.lower("p_brand"), k.cast("string"), F.lit("`"), F.when(k % 2 == 0, F.concat(F.lit(" / x"), k.cast("string"))).otherwise(""))
    line = F.when(k % 4 == 0, "# no entry").otherwise(F.concat(a, F.when(k % 3 == 0, " -> **").otherwise(" → **"), "p_type", F.lit("** ("), F.col("p_size").cast("string"), F.lit("회)")))
    return P.ledger(table(spark, d, "part").select(line.alias("line"))).select("variant", "target", "count")


@query("select * from (values (1, '김민준,이서연'), (2, ''), (3, '박지호')) t(i, names)")
def listed_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of a list, first ones kept."""
    rows = spark.createDataFrame([(1, "김민준, 이서연/김민준\nbob"), (2, "미정 안건"), (3, "박지호")], "i int, text string")
    return rows.select("i", F.array_join(P.names_in(F.col("text")), ",").alias("names"))


@query("""with n as (select s_suppkey k, s_nationkey g, chr((44032 + (s_suppkey * 7919 + 11) % 11172)::int) || chr((44032 + (s_suppkey * 104729 + 5) % 11172)::int) x from supplier)
  select g, string_agg(x, ',' order by k) "names" from (select g, x, min(k) k from n where k % 4 <> 3 group by 1, 2) group by 1""")
def listed_names_of_suppliers(spark: SparkSession, d: str) -> DataFrame:
    """Lists of Hangul names made of the keys of suppliers, split in three ways, with names that repeat and entries that are none."""
    k = F.col("s_suppkey")
    hangul = lambda n: F.decode(F.unhex(F.hex((n % 11172 + 0xAC00).cast("long"))), "UTF-16BE")
    name = F.concat(hangul(k * 7919 + 11), hangul(k * 104729 + 5))
    entry = F.when(k % 4 == 3, F.concat(F.lit("Mr. "), name)).otherwise(F.concat(name, F.when(k % 4 == 0, F.concat(F.lit(" / "), name)).otherwise(" "), F.when(k % 4 == 1, "\n").when(k % 4 == 2, ", ").otherwise("/")))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("g")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", entry.alias("e")))), lambda x: x["e"]), ", ").alias("text"))
    return s.select("g", F.array_join(P.names_in(F.col("text")), ",").alias("names")).filter("names <> ''")


@query("""with c as (select c_custkey id, c_name title, c_custkey % 5 <> 0 alive from customer where c_custkey > 1) select 'b' || p.c_custkey parent, string_agg(k.title || '!', chr(10) order by k.id desc) "text" from customer p join c k on k.id // 2 = p.c_custkey where k.alive and (p.c_custkey % 5 <> 0) group by 1""")
def block_texts(spark: SparkSession, d: str) -> DataFrame:
    """The titles of living children, in the order that their parent names them."""
    return P.block_text(_blocks(spark, d))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("n"), F.col("c_name").alias("title"))
    named = lambda k: F.concat(F.lit("b"), k.cast("string"))
    content = F.to_json(F.array(named(F.col("n") * 2 + 1), named(F.col("n") * 2), F.lit("gone")))
    title = F.concat(F.lit('{"title": [["'), "title", F.lit('"], ["!", [["b"]]]], "other": 1}'))
    return c.select(named(F.col("n")).alias("id"), title.alias("properties"), content.alias("content"), F.when(F.col("n") % 5 != 0, 1).otherwise(0).alias("alive"))


def _database(rows: DataFrame, key: str, table_: str, name: str) -> str:
    """SQLite files of about 20,000 rows each in the shared folder, each written by one task; their pattern."""
    from ..sources.database import plain, written

    spark = rows.sparkSession
    folder = plain(scratch_folder(spark, name))
    n = max(2, -(-rows.count() // 20_000))
    if written(rows.repartition(n, key), folder, table_) == 0:
        raise ValueError("no rows")
    return f"{folder}/*.db"


def _pushing(spark: SparkSession) -> SparkSession:
    """A session of the same application in which filters are pushed into data sources in Python; the caller's stays as it is."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return own


@query("""select c_custkey id, c_name "name", c_acctbal balance from customer where c_custkey > 40 and c_mktsegment in ('BUILDING', 'MACHINERY', 'retail') and c_name is not null and c_acctbal >= 0""")
def database_rows(spark: SparkSession, d: str) -> DataFrame:
    """Customers from SQLite files, in key ranges, with the filters in the files' own queries."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    found = R.sqlite(_pushing(spark), _database(c, "id", "users", "users-db"), "users", partitions=4)
    return found.filter((F.col("id") > 40) & F.col("segment").isin("BUILDING", "MACHINERY", "retail") & F.col("name").isNotNull() & (F.col("balance") >= 0)).select("id", "name", "balance")


@query("""with c as (select c_custkey id, c_name title, c_custkey % 5 <> 0 alive from customer where c_custkey > 1) select 'b' || p.c_custkey parent, string_agg(k.title || '!', chr(10) order by k.id desc) "text" from customer p join c k on k.id // 2 = p.c_custkey where k.alive and (p.c_custkey % 5 <> 0) group by 1""")
def database_blocks(spark: SparkSession, d: str) -> DataFrame:
    """S10 with S11: a block tree in SQLite files, to the texts of its parents."""
    path = _database(_blocks(spark, d), "id", "block", "blocks-db")
    return P.block_text(R.sqlite(_pushing(spark), path, "block", "id string, properties string, content string, alive long"))


@query("""with l as (select o_orderkey n, case when o_orderkey % 7 = 0 then '# c' when o_orderkey % 11 = 0 then ' ' else ' notes/' || o_custkey || ' ' end line from orders) select trim(line) entry, min(n)::bigint line_no from l where trim(line) <> '' and trim(line) not like '#%' group by 1""")
def queue_file(spark: SparkSession, d: str) -> DataFrame:
    """S17 and K8."""
    n = F.col("o_orderkey")
    line = F.when(n % 7 == 0, "# c").when(n % 11 == 0, " ").otherwise(F.concat(F.lit(" notes/"), F.col("o_custkey").cast("string"), F.lit(" ")))
    return P.queue_entries(table(spark, d, "orders").select(n.alias("line_no"), line.alias("line")))


@query("""select event_id, case when event_id % 4 = 3 then null else event_id % 10 end a, case when event_id % 4 = 3 then false else true end ok from events""")
def fenced_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON alone, in code fences, and text that is none; ``ok``: whether it has the shape."""
    n = F.col("event_id")
    doc = F.concat(F.lit('{"a": '), (n % 10).cast("string"), F.lit("}"))
    text = F.when(n % 4 == 0, doc).when(n % 4 == 1, F.concat(F.lit("so\n```json\n"), doc, F.lit("\n```"))).when(n % 4 == 2, F.concat(F.lit("```\n"), doc, F.lit("```"))).otherwise("no json")
    e = table(spark, d, "events").select("event_id", P.json_or_empty(text, "a long").alias("j"))
    return e.select("event_id", F.col("j.a").alias("a"), F.col("j.a").isNotNull().alias("ok"))


@query("""with l as (select user_id::varchar path, event_id n, event_id % 3 k, event_id / 10.0 t from events), e as (select *, lead(k) over w nk, lead(t) over w nt from l where k < 2 window w as (partition by path order by n)) select path, case when n % 30 = 0 then 0.0 else t end::double silence_start, case when nk = 1 then nt end::double silence_end from e where k = 0""")
def silence_log(spark: SparkSession, d: str) -> DataFrame:
    """A detector's log by user: starts, the ends that follow, and other lines."""
    n = F.col("event_id")
    t = (n / 10.0).cast("string")
    line = F.when(n % 3 == 0, F.concat(F.lit("[x] silence_start: "), F.when(n % 30 == 0, F.lit("-0.01")).otherwise(t))).when(n % 3 == 1, F.concat(F.lit("silence_end: "), t, F.lit(" | silence_duration: 1"))).otherwise("other")
    return P.silences(table(spark, d, "events").select(F.col("user_id").cast("string").alias("path"), n.alias("line_no"), line.alias("line")))


@query("""select 'r' || r_regionkey "name", (length(r_name) + 1)::bigint "length" from region""")
def recording_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder with their sizes; other kinds are left out."""
    path = scratch_folder(spark, "recordings")
    table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("name"), F.col("r_name").alias("value")).write.partitionBy("name").text(path)
    found = R.recordings(spark, path, "*.txt")
    return found.select(F.regexp_extract("path", "name=([^/]+)/", 1).alias("name"), "length")
