"""Data sources: SQLite files in key ranges with filters pushed down, and pages of a service in batches and as a stream."""

from __future__ import annotations

import contextlib
import http.server
import json
import sqlite3
import threading
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualNullSafe, EqualTo, GreaterThan, In, IsNull, Not, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import LongType, StringType

from parley.sources import database, paged, readers

ROWS = [(1, "a", 1.5, 1), (2, "b%", None, 0), (None, "가나", -2.0, None), (9, None, 3.0, 1), (50, "A", 0.0, 0), (50, "", 1e300, 1)]


@pytest.fixture
def file(tmp_path):
    con = sqlite3.connect(tmp_path / "one.db")
    con.execute('CREATE TABLE "t t" (id INTEGER, "na""me" VARCHAR(9), x REAL, ok BOOLEAN, raw BLOB)')
    con.executemany('INSERT INTO "t t" VALUES (?, ?, ?, ?, ?)', [(*r, b"\x00\xff") for r in ROWS])
    con.execute("INSERT INTO \"t t\" VALUES ('text', 7, 'y', 'z', 'w')")  # SQLite keeps what it is given
    con.execute("CREATE TABLE keyed (k TEXT PRIMARY KEY, v INTEGER) WITHOUT ROWID")
    con.executemany("INSERT INTO keyed VALUES (?, ?)", [("a", 1), ("b", 2)])
    con.execute("CREATE TABLE hollow (k INTEGER)")
    con.commit()
    con.close()
    return str(tmp_path / "one.db")


@contextlib.contextmanager
def pushing(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield own


def test_tables_of_a_file(spark, file):
    df = readers.sqlite(spark, file, "t t", partitions=3)
    assert dict(df.dtypes) == {"id": "bigint", 'na"me': "string", "x": "double", "ok": "boolean", "raw": "binary"}
    want = [(i, n, x, None if ok is None else bool(ok), b"\x00\xff") for i, n, x, ok in ROWS] + [(None, "7", None, None, None)]
    assert sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect()), key=repr) == sorted(want, key=repr)
    assert df.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, readers.sqlite(spark, file, "keyed").collect())) == [("a", 1), ("b", 2)]
    assert readers.sqlite(spark, file, "hollow").count() == 0
    with pytest.raises(Exception, match="no table"):
        readers.sqlite(spark, file, "absent").count()
    with pytest.raises(Exception, match="FileNotFound"):
        readers.sqlite(spark, file + "x", "t t").count()
    with database.connect(file) as con, pytest.raises(sqlite3.OperationalError, match="readonly"):
        con.execute("DELETE FROM keyed")


def test_filters_are_pushed_and_change_nothing(spark, file):
    name = F.col('`na"me`')
    filters = [
        F.col("id") > 1, F.col("id") >= 9, F.col("id") == 50, F.col("id") != 50, F.col("id").isNull(), F.col("id").isNotNull() & (F.col("x") < 2), F.col("id").isin(1, 2, 77), ~F.col("id").isin(1, 2), F.col("x") <= -2, F.col("id").eqNullSafe(9),
        name == "A", name.startswith("b%"), name.endswith("나"), name.endswith(""), name.contains("%"), name > "B", F.col("ok"), ~F.col("ok"), F.col("ok") == F.lit(True), (F.col("id") > 1) | (name == "a"), F.length(name) == 1,
    ]
    schema = '`id` long, `na"me` string, x double, ok boolean'
    plain = readers.sqlite(spark, file, "t t", schema).filter("id is null or id <> 0").cache()
    with pushing(spark) as own:
        for f in filters:
            got, want = readers.sqlite(own, file, "t t", schema, partitions=2).filter(f), plain.filter(f)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), f
        scan = readers.sqlite(own, file, "t t", schema).filter(F.col("id") > 8)._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan database_pushed" in scan and "Filter (" not in scan and "Filter isnotnull" not in scan  # nothing is left for Spark to filter


def test_conditions():
    types = {"n": LongType(), "s": StringType()}
    told = lambda f: database.condition(f, types)
    n, c = (database.seen(k, v) for k, v in types.items())
    assert told(EqualTo(("n",), 3)) == (f"{n} = ?", [3]) and told(GreaterThan(("s",), "x")) == (f"{c} > ?", ["x"]) and told(IsNull(("s",))) == (f"{c} IS NULL", [])
    assert told(Not(EqualTo(("n",), 3))) == (f"NOT ({n} = ?)", [3]) and told(EqualNullSafe(("n",), 3)) == (f"{n} IS ?", [3])
    assert told(In(("n",), (1, 2))) == (f"{n} IN (?, ?)", [1, 2]) and told(StringContains(("s",), "x")) == (f"instr({c}, ?) > 0", ["x"])
    for stays in (EqualTo(("n",), "3"), EqualTo(("s",), 3), EqualTo(("n",), True), In(("n",), (1, None)), EqualTo(("n", "m"), 1), EqualTo(("other",), 1), EqualTo(("n",), float("nan")), StringStartsWith(("n",), "x"), StringEndsWith(("n",), "x"), Not(EqualTo(("n",), "x"))):
        assert told(stays) is None


class Rows:
    """A service of ``rows`` in pages of three; busy at every ``busy``-th call."""

    def __init__(self, n, busy=0):
        self.rows, self.busy, self.asked = [{"id": i, "t": "가"} for i in range(n)], busy, []

    def __enter__(self):
        service = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                service.asked.append(q)
                if service.busy and len(service.asked) % service.busy == 0:
                    self.send_response(429 if len(service.asked) % 2 else 503)
                    self.send_header("Retry-After", "0.01")
                    self.end_headers()
                    return
                rows = [r for r in service.rows if int(q.get("since", 0)) <= r["id"] < int(q.get("until", 1 << 30))]
                at = int(q.get("cursor", 0))
                more = at + 3 < len(rows)
                body = json.dumps({"results": rows[at : at + 3], "next_cursor": str(at + 3) if more else None}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/list"
        return self

    def __exit__(self, *_):
        self.server.shutdown()


def test_pages_by_time_ranges(spark):
    spark.dataSource.register(paged.Pages)
    with Rows(20, busy=4) as service:
        df = spark.read.format("pages").option("url", service.url).option("ranges", "0,7,7,15,40").option("wait", "0.01").load()
        assert sorted(int(r.id) for r in df.collect()) == list(range(20)) and df.rdd.getNumPartitions() == 4
    with Rows(5, busy=1) as service, pytest.raises(Exception, match="HTTP Error"):
        spark.read.format("pages").option("url", service.url).option("tries", "2").load().collect()


def test_pages_as_a_stream_that_fails_in_the_middle(spark, tmp_path):
    """Each start reads at most two pages; one fails once its rows are half written. The batch is read again from the same cursors, and rows
    that come later on the last page are read then, so a sink by batch number has each row once."""
    spark.dataSource.register(paged.Pages)
    fails = {"left": 1}

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"file://{tmp_path}/out/{number}")
        if number == 1 and fails["left"]:
            fails["left"] -= 1
            raise RuntimeError("lost in the middle")

    def start(url):
        stream = spark.readStream.format("pages").option("url", url).option("pages", 2).option("wait", "0.01").load()
        q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception as e:
            assert "lost in the middle" in str(e)

    def ids():
        return sorted(int(r.id) for r in spark.read.schema("id string, body string").parquet(f"file://{tmp_path}/out/*").collect())

    with Rows(14, busy=5) as service:
        for _ in range(6):
            start(service.url)
        assert fails["left"] == 0 and ids() == list(range(14))
        service.rows += [{"id": i, "t": "나"} for i in range(14, 19)]
        for _ in range(3):
            start(service.url)
        assert ids() == list(range(19))
