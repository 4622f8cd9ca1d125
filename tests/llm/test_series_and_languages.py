"""Language ID, resampling and fill-in-middle against brute force, held-out labels and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import fill_middle, language_id, resample
from parley.llm.common import read

SF = "/root/testdata/sf0.001"
TEXTS = ["", "\n", "\n\n", "a", "a\n", "\na", "é\n\U0001f44d\r\nß", "x <P> y\nz", "<S>", "a\n<M", "P>\n" * 3, "l\n" * 2000, "Z" * 300_000, "w é\n" * 60_000, None, "<P", "tail <\nS>\n", " \x85b c\nd"]


# ---- fill-in-middle ----


def brute_middle(doc_id, text, rate=100, first=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < first else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate,first", [(100, 50), (40, 0), (0, 50)])
def test_middles(spark, rate, first):
    rows = [(i, t, 1, 2, 3) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc\n", 1, 2, 3), (5, "a\nb\nc\n", 1, 2, 3), (5, "a\nb\nc\n", 1, 2, 3), (-3, "a\nb", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output int, form int, batch int")
    made = fill_middle.transform(df, rate=rate, suffix_first=first)
    got = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    want = [(d, *brute_middle(d, t, rate, first)) for d, t, *_ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    back = Counter((r.doc_id, r.restored) for r in fill_middle.restore(made).collect())
    assert back == Counter((d, t or "") for d, t, *_ in rows)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    sums = Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in fill_middle.digest(made).collect())
    assert sums == Counter((d, sha(w[-1]), sha(t or "")) for (d, t, *_), w in zip(rows, want))


def test_middles_of_an_empty_table_and_slices(spark):
    docs = read(spark, SF)
    assert fill_middle.digest(fill_middle.transform(docs.limit(0))).count() == 0
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (1, fill_middle.SLICE, 2, 3, fill_middle.SLICE * 2, 0)]})
    parts = list(fill_middle._slices(batch, "text"))
    assert [p.num_rows for p in parts] == [1, 1, 2, 1, 1] and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


# ---- resampling ----


def brute_buckets(rows, kind, first=19800, width=3600, hold=3600):
    """Whole seconds one by one, in fractions."""
    seen = defaultdict(dict)
    for c, t, v, i in rows:
        if c is not None and t is not None and v is not None and v == v and abs(v) < 9e16:
            at, cents = (t - datetime(1970, 1, 1)) // timedelta(seconds=1), int(np.floor(100 * v + 0.5))
            seen[c][at] = max(seen[c].get(at, (-1 << 62, 0)), (i, cents))
    out = defaultdict(lambda: [0, 0, 0])
    start = lambda at: at - (at + first) % width
    for c, points in seen.items():
        ordered = sorted((at, x[1]) for at, x in points.items())
        for (at, v), nxt in zip(ordered, [*ordered[1:], None]):
            out[c, start(at)][0] += 1
            if kind == "linear":
                if nxt is None or nxt[0] - at > hold:
                    continue
                d, w = nxt[0] - at, nxt[1]
            else:
                d, w = (hold if nxt is None else min(hold, nxt[0] - at)), v
            twice = lambda u: 2 * v * u + (Fraction((w - v) * u * u, d)).__floor__()
            for u in range(d):
                out[c, start(at + u)][1] += 1
                out[c, start(at + u)][2] += twice(u + 1) - twice(u)
    return sorted((c, b, n, s, a if -(1 << 63) <= a < 1 << 63 else None, Fraction(a, 2 * s).__floor__() if s else None) for (c, b), (n, s, a) in out.items())


CLICKS = "client_id long, ts timestamp_ntz, value double, click_id long, bucket_start string, series int"


def _clicks(seed, n, span):
    rng, base = random.Random(seed), datetime(2024, 1, 31, 20, 0)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), base + timedelta(microseconds=rng.randrange(span * 1_000_000)), rng.choice([None, rng.uniform(-50, 500), round(rng.uniform(0, 9), 2), 0.005]), i // 2) for i in range(n)]
    return [r if rng.random() > 0.02 else (r[0], None, *r[2:]) for r in rows] + rows[:5]


@pytest.mark.parametrize("kind", ["linear", "step"])
@pytest.mark.parametrize("n,span,block", [(60, 90_000, 21_600), (200, 20_000, 3600), (40, 400_000, 7200)])
def test_buckets_equal_brute_force(spark, kind, n, span, block):
    rows = _clicks(n, n, span)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CLICKS).repartition(3)
    got = sorted(tuple(r) for r in resample.resample(df, kind, block=block, groups=2).collect())
    assert got == brute_buckets(rows, kind)


def test_bucket_edges(spark):
    day = datetime(2024, 3, 1)
    at = lambda s, us=0: day + timedelta(seconds=s, microseconds=us)
    rows = [
        (1, at(0), 1.0, 1), (1, at(3600), 2.0, 2), (1, at(7201), 3.0, 3),  # just within reach, and just not
        (2, at(21599), 5.0, 1), (2, at(21600), -5.0, 2), (2, at(21600, 999_999), -7.0, 3), (2, at(21601), 1.0, 4), (2, at(21602), 9.0, 5),  # on the edge of a block, a second twice
        (3, at(1000), 4e14, 1), (3, at(4000), -4e14, 2), (3, at(4001), 9e15, 3), (3, at(7000), 9e15, 4),  # beyond a long
        (4, at(5), 1.0, 7), (4, at(5), 3.0, 7), (4, at(5), 2.0, 6), (5, at(9), float("nan"), 1), (6, at(9), float("inf"), 1), (7, None, 1.0, 1), (None, at(9), 1.0, 1),
        (8, datetime(1969, 12, 31, 23, 59, 59, 500_000), 1.0, 1), (8, datetime(1970, 1, 1, 0, 0, 3), 2.0, 2),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CLICKS)
    for kind in ("linear", "step"):
        assert sorted(tuple(r) for r in resample.resample(df, kind).collect()) == brute_buckets(rows, kind)
    assert resample.resample(df.limit(0)).count() == 0
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:  # times without a zone are UTC, whatever the session says
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert sorted(tuple(r) for r in resample.resample(df).collect()) == brute_buckets(rows, "linear")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_hot_client_is_many_groups(spark):
    """All rows are one client's: no group gets more than a block and its halo, and the sums are those of one pass."""
    base = datetime(2024, 1, 1)
    rows = [(1, base + timedelta(seconds=37 * i), float(i % 100), i) for i in range(6000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CLICKS)
    got = sorted(tuple(r) for r in resample.resample(df, block=3600).collect())
    one = resample.Buckets(True, 3600, 3600, 1 << 40, 19800)
    for _, t, v, _ in rows:
        at = (t - datetime(1970, 1, 1)) // timedelta(seconds=1)
        one.point(0, 1, at, int(100 * v))
    one.flush()
    assert [x[:5] for x in got] == one.done and len(got) > 60


def test_zones():
    assert resample.phase("Asia/Kolkata", 3600) == 1800 and resample.phase("UTC", 3600) == 0 and resample.phase("Europe/Berlin", 3600) == 0
    with pytest.raises(ValueError, match="Lord_Howe"):
        resample.phase("Australia/Lord_Howe", 3600)
    with pytest.raises(ValueError, match="cubic"):
        resample.resample(None, "cubic")


# ---- language ID ----


def brute_grams(text):
    """Lower case, other characters than letters as one space, a space on both sides; all n-grams of one to four characters."""
    text = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower())
    if not text.strip():
        return None
    text = f" {' '.join(text.split())} "
    return Counter(text[i : i + k] for k in language_id.SIZES for i in range(len(text) - k + 1))


def _bucket(gram):
    mask, total = (1 << 32) - 1, 0
    for c, m in zip(gram, language_id._SPREAD):
        total = (total + ord(c) * int(m)) & mask
    return (((total ^ (total >> 15)) * int(language_id._SPREAD[-1]) + int(language_id._SPREAD[len(gram) - 1])) & mask) >> (32 - language_id.BITS)


def test_bags_equal_brute_force(spark):
    texts = [r.text for r in read(spark, SF).select("text").limit(30).collect()] + [None, "", " 12 \n", "a", "É", "éa1Ωß ", "  x", "x\ty", "日本語 テキスト", "\U00010400", "a" * 50_000, "ǅ"]
    got = list(language_id.bags(pa.array(texts, pa.string())))
    assert len(got) == len(texts)
    for text, bag in zip(texts, got):
        want = brute_grams(text or "")
        if want is None:
            assert bag is None
            continue
        sums = Counter()
        for gram, n in want.items():
            sums[_bucket(gram)] += n
        assert dict(zip(bag.buckets.tolist(), bag.counts.tolist())) == dict(sums) and (np.diff(bag.buckets) > 0).all()


def test_frequencies_equal_brute_force(spark):
    docs = read(spark, SF).select("text")
    n, count = language_id.frequencies(docs.repartition(5))
    bags = [b for b in language_id.bags(pa.array([r.text for r in docs.collect()])) if b]
    want = np.zeros(language_id.BUCKETS, int)
    for b in bags:
        want[b.buckets] += 1
    assert n == len(bags) and (count == want).all()


def test_leader_follows_its_rule():
    """Weights against a plain restatement, step by step: the minimum of the summed linear losses with both penalties."""
    rng = np.random.default_rng(3)
    leader = language_id.Leader(6, 3, 0.5, 1.0, 0.2, 0.1)
    g_sum, n, shift = np.zeros((6, 3)), np.zeros((6, 3)), np.zeros((6, 3))
    for _ in range(200):
        at = np.sort(rng.choice(6, 3, replace=False))
        x, y = rng.random(3), int(rng.integers(3))
        w = np.zeros((6, 3))
        for i in range(6):
            for j in range(3):
                z = g_sum[i, j] - shift[i, j]
                if abs(z) > 0.2:
                    w[i, j] = -(z - 0.2 * np.sign(z)) / ((1 + n[i, j] ** 0.5) / 0.5 + 0.1)
        assert np.allclose(leader.weights(), w)
        e = np.exp(x @ w[at])
        grad = x[:, None] * (e / e.sum() - np.eye(3)[y])
        for r, i in enumerate(at):
            for j in range(3):
                g = grad[r, j]
                shift[i, j] += ((n[i, j] + g * g) ** 0.5 - n[i, j] ** 0.5) / 0.5 * w[i, j]
                n[i, j] += g * g
                g_sum[i, j] += g
        leader.learn(at, x, y)
    assert (leader.weights() == 0).any() and (leader.weights() != 0).any()


def test_temperature_calibrates():
    """Scores that are three times too sharp are divided by about three."""
    rng = np.random.default_rng(5)
    scores = rng.normal(size=(20_000, 4))
    p = language_id.softmax(scores)
    labels = (p.cumsum(1) < rng.random((len(p), 1))).sum(1)
    assert abs(language_id.temperature(3 * scores, labels) - 3) < 0.15
    sure = np.eye(4)[labels[:100]] * 5
    assert language_id.temperature(sure, labels[:100]) > 0.1  # separable rows leave it above its lower end


def test_predictions(spark):
    docs = read(spark, "/root/testdata/sf0.01")
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = language_id.predict(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == want[r.doc_id] for r in held]) > 0.98
    # neither held-out labels nor other columns reach the model
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).withColumn("score", F.lit("s")).withColumn("held_out", F.lit(1))
    assert sorted(map(tuple, language_id.predict(other).collect())) == sorted(map(tuple, got))


def test_prediction_edges(spark):
    schema = "doc_id long, text string, lang string, lang_pred int, bucket int"
    learn = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "the cat and the hat" if i % 2 else "el gato y la casa", "en" if i % 2 else "es", 1, 2) for i in learn]
    more = [(101, None, "en", 1, 2), (102, "", None, 1, 2), (103, "12 + 3 \n", "es", 1, 2), (None, "the hat", "en", 1, 2), (104, "the hat", None, 1, 2), (104, "the hat", None, 1, 2), (105, "la casa " * 40_000, "es", 1, 2)]
    got = {}
    for r in language_id.predict(spark.createDataFrame(rows + more, schema)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
    assert got[101][0][:2] == got[102][0][:2] == got[103][0][:2] == ("und", 0.0)
    assert got[None][0][0] == "en" and got[None][0][2] is False and [x[0] for x in got[104]] == ["en", "en"] and got[104][0] == got[104][1] and got[105][0][0] == "es"
    one = language_id.predict(spark.createDataFrame([r for r in rows if r[2] == "en"] + more[:1], schema)).collect()
    assert {(r.lang_pred, r.score) for r in one if r.doc_id != 101} == {("en", 1.0)}
    none = language_id.predict(spark.createDataFrame([(*r[:2], None, 1, 2) for r in rows], schema)).collect()
    assert len(none) == len(rows) and {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language_id.predict(spark.createDataFrame([], schema)).count() == 0


# ---- the queries ----


@pytest.mark.parametrize("name", ["op12_clock_hours", "op13_fill_middle"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    from parley.llm import queries

    duck = duckdb.connect()
    for t in ("clicks", "documents"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    result = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(names).collect()), key=repr) == sorted(result.fetchall(), key=repr)
