"""Operators against plain restatements, on random and boundary cases."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from parley.functions import text as T
from parley.functions import times
from parley.operators import identity, intervals, notes, review, search
from parley.operators import state as states
from parley.sources import parsers, sinks


def midpoint_restated(w, turns):
    m2 = w[0] + w[1]
    for s, a, b in turns:
        if 2 * a <= m2 <= 2 * b:
            return s
    best = max(((min(w[1], b) - max(w[0], a), -i) for i, (s, a, b) in enumerate(turns)), default=(0, 0))
    return turns[-best[1]][0] if turns and best[0] > 0 else None


def overlap_restated(w, turns, margin=0.15):
    if w[0] == w[1]:
        hits = [s for s, a, b in turns if a <= w[0] <= b]
        return (hits[0] if hits else None, True)
    score, first = {}, {}
    for s, a, b in turns:
        o = min(w[1], b) - max(w[0], a)
        if o > 0:
            score[s] = score.get(s, 0) + o
            first[s] = min(first.get(s, a), a)
    if not score:
        return (None, True)
    ranked = sorted(score, key=lambda s: (-score[s], first[s], s))
    lead = (score[ranked[0]] - (score[ranked[1]] if len(ranked) > 1 else 0)) / (w[1] - w[0])
    both = any(x[0] != y[0] and min(w[1], x[2], y[2]) > max(w[0], x[1], y[1]) for i, x in enumerate(turns) for y in turns[i + 1 :])
    return (ranked[0], both or (len(ranked) > 1 and lead < margin))


def test_interval_joins_random(spark):
    r = random.Random(5)
    words, turns = [], []
    for m in range(6):
        t = 0
        for i in range(40):
            t += r.randint(0, 6)
            turns.append((m, i, r.choice("ABC"), t, t + r.randint(0, 15)))
        for i in range(80):
            s = r.randint(0, 150)
            words.append((m, i, s, s + r.choice((0, 1, 3, 9))))
    w = spark.createDataFrame(words, "meeting int, word int, ws long, we long")
    t = spark.createDataFrame(turns, "meeting int, turn int, speaker string, ts long, te long")
    by = {m: [(s, a, b) for mm, _, s, a, b in turns if mm == m] for m in range(6)}
    for width in (7, 50, 10_000):  # buckets narrower and wider than the turns give the same
        got = {(x.meeting, x.word): x.speaker for x in intervals.assign_midpoint(w, t, width).collect()}
        assert got == {(m, i): midpoint_restated((a, b), by[m]) for m, i, a, b in words}
        got = {(x.meeting, x.word): (x.speaker, x.uncertain) for x in intervals.assign_overlap(w, t, width).collect()}
        assert got == {(m, i): overlap_restated((a, b), by[m]) for m, i, a, b in words}


def test_vad_union(spark):
    s = spark.createDataFrame([("k", 0, 2000), ("k", 4000, 4750), ("k", 4600, 4700)], "key string, start long, end long")
    got = [(x.start, x.end) for x in intervals.interval_union(s, 250, 500).orderBy("start").collect()]
    assert got == [(0, 2250), (3750, 5000)]


def test_merge_turns_takes_the_last_end(spark):
    rows = [(1, 0, "A", 0.0, 9.0, "a"), (1, 1, "A", 1.0, 2.0, "b"), (1, 2, None, 2.0, 3.0, "c"), (1, 3, None, 5.0, 6.0, "d"), (1, 4, None, 8.5, 9.0, "e")]
    got = intervals.merge_turns(spark.createDataFrame(rows, "meeting int, seq int, speaker string, start double, end double, text string"), 2.0).orderBy("turn").collect()
    assert [(x.speaker, x.start, x.end, x.text) for x in got] == [("A", 0.0, 2.0, "a b"), (None, 2.0, 6.0, "c d"), (None, 8.5, 9.0, "e")]


def test_speech_window(spark):
    rows = [("a", 10.0, 0.0, 2.0), ("a", 10.0, 9.0, None), ("b", 10.0, 4.0, 5.0)]
    got = {x.path: (x.start, x.end) for x in intervals.speech_window(spark.createDataFrame(rows, "path string, duration double, silence_start double, silence_end double")).collect()}
    assert got == {"a": (1.75, 9.25), "b": (None, None)}


def test_fuzzy_names_equal_all_pairs(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(2, 7))) for _ in range(90)})
    tokens, roster = words[:60], words[30:]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for least in (0.6, 0.72, 0.86):
        want = set()
        for t in tokens:
            scored = sorted((-(1 - distance(t, n) / max(len(t), len(n))), n) for n in roster if n != t and 1 - distance(t, n) / max(len(t), len(n)) >= least)
            want |= {(t, n) for _, n in scored[:2]}
        got = identity.fuzzy_names(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(n,) for n in roster], "name string"), least, 2)
        assert {(x.token, x.name) for x in got.collect()} == want


def test_roster_stale_snapshot_and_supplemental(spark):
    from parley import schemas

    history = spark.createDataFrame([("k1", "Kim", "A", "", "former", "2024-01-01", "2024-03-01", "2024-02-01", True, ["x"]), ("k2", "Lee", "확인 필요", "", "active", "2024-01-01", "2024-03-01", "", True, ["x"])], schemas.HISTORY)
    current = spark.createDataFrame([("k1", "Kim", "B", "lead", "dir")], schemas.EMPLOYEES)
    extra = spark.createDataFrame([("other", "Lee", "C", "", "wiki"), ("new", "Park", "D", "", "wiki")], schemas.EMPLOYEES)
    got = {x.identity_key: x for x in identity.merge_history(history, current, extra, "2024-04-01", False).collect()}
    assert set(got) == {"k1", "k2", "new"}
    assert (got["k1"].employment_status, got["k1"].department, got["k1"].former_since) == ("former", "B", "2024-02-01")
    assert (got["k2"].employment_status, got["k2"].department, got["k2"].sources) == ("active", "C", ["wiki", "x"])
    assert (got["new"].employment_status, got["new"].ever_authoritative) == ("unverified", False)
    fresh = {x.identity_key: x for x in identity.merge_history(history, current, extra.limit(0), "2024-04-01", True).collect()}
    assert (fresh["k1"].employment_status, fresh["k2"].employment_status, fresh["k2"].former_since) == ("active", "former", "2024-04-01")


def test_token_distance(spark):
    rows = [("a b c", "a x c"), ("", "a b"), ("a a a", "a"), ("x y", "x y")]
    df = spark.createDataFrame(rows, "a string, b string").select(review.token_distance(T.words(F.col("a")), T.words(F.col("b"))).alias("d"))
    assert [x.d for x in df.collect()] == [1, 2, 2, 0]


def levenshtein_restated(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_equal_brute_force():
    r = random.Random(7)
    for _ in range(400):
        a, b = ("".join(r.choice("abé") for _ in range(r.choice((0, 1, 5, 40, 130)))) for _ in "12")
        assert T.edits(a, b) == levenshtein_restated(a, b)
        assert T.edits(a, a[3:] + b[:2]) == levenshtein_restated(a, a[3:] + b[:2])
    for _ in range(40):  # long enough for a band
        a = [r.choice("abcd") for _ in range(r.choice((200, 400)))]
        b = list(a)
        for _ in range(r.choice((1, 20, 90))):
            i = r.randrange(len(b))
            b[i : i + r.randint(0, 2)] = r.choices("abcd", k=r.choice((0, 1, 1, 9)))
            b = b or ["a"]
        assert T.edits(a, b) == levenshtein_restated(a, b)
    many = [f"t{i}" for i in range(7000)]
    assert T.edits(many, ["x", *many[:6000], *many[6001:]]) == 2


def test_distances_of_whole_texts(spark, tmp_path):
    """What stands after the 60th word or the 200th character counts, and 7,000 distinct tokens have a distance."""
    from parley.plans import audits, texts

    docs = [(1, "en", " ".join(f"Ab{i}" for i in range(150))), (2, "de", " ".join(f"w{i}" for i in range(7000))), (3, "en", "x" * 250 + "ABCDEF" + "y" * 50)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rate = {}
    for _, lang, t in docs:
        w = t.split()
        gone = [x.lower() for i, x in enumerate(w) if i % 7 != 6]
        # lower-case long texts only lose words, so the distance is what is gone
        pair = [(len(w) - len(gone), len("".join(w)) - len("".join(gone)))] if lang == "de" else [(levenshtein_restated(w, gone), levenshtein_restated("".join(w), "".join(gone)))]
        n = rate.setdefault(lang, [0, 0, 0, 0])
        rate[lang] = [n[0] + pair[0][0], n[1] + len(w), n[2] + pair[0][1], n[3] + len("".join(w))]
    got = {x.lang: (round(x.wer, 9), round(x.cer, 9)) for x in audits.cer_wer_micro(spark, str(tmp_path)).collect()}
    assert got == {k: (round(n[0] / n[1], 9), round(n[2] / n[3], 9)) for k, n in rate.items()}
    whole = {x.doc_id: (x.distance, x.longer) for x in texts.edit_distance(spark, str(tmp_path)).collect()}
    assert whole[1] == (levenshtein_restated(docs[0][2], docs[0][2].lower()[2:]), len(docs[0][2]))
    assert whole[3] == (levenshtein_restated(docs[2][2], docs[2][2].lower()[2:]), 306)


def test_text_functions(spark):
    df = spark.createDataFrame([("[00:01 - 00:02] 화자 A:  x  y \n\nB: 각",)], "t string")
    assert df.select(T.normalized(F.col("t"))).first()[0] == "x y 각"
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(times.clock(F.lit(-3.5))) == "00:00:00"
    assert one(times.clock(F.lit(3661.9))) == "01:01:01"
    assert one(times.seconds(F.lit("01:01:01"))) == 3661
    assert one(T.strip_honorific(F.lit("김민준님"))) == "김민준"
    assert one(T.jamo_similarity(F.lit(""), F.lit("가"))) == 0.0
    assert one(T.without_particle(F.lit("가온는"))) == "가온"
    assert one(T.is_noise(F.lit(" 음 "))) is True
    assert one(T.capped(F.lit("a" * 20), 5)) == "aaaaa…"
    assert one(T.capped(F.lit("a b  c"), 4)) == "a b…" and one(T.capped(F.lit(" a  b "), 3)) == "a b"
    assert one(times.stem_time(F.lit("meet 20240501 093000")).cast("string")) == "2024-05-01 09:30:00"


def test_parsers(spark):
    lines = parsers.numbered_lines(spark.createDataFrame([("k", "## Sales\n| name | x |\n|---|---|\n| Kim | 1 |\n- 가옹 / `비티`님 → **가온**, ok (3회)\n- `{'긴' * 45}`, 님·나비씨 (화자 A), b → **다람** (2회)".replace("{'긴' * 45}", "긴" * 45))], "key string, text string"), "key", "text")
    assert [(x.department, x.cells) for x in parsers.pipe_table(lines, "key").orderBy("line_no").collect()] == [("Sales", ["name", "x"]), ("Sales", ["Kim", "1"])]
    assert sorted((x.variant, x.target, x["count"]) for x in parsers.ledger(lines).collect()) == sorted([("가옹", "가온", 3), ("비티`", "가온", 3), ("긴" * 45, "다람", 2), ("나비씨 (화자 A)", "다람", 2), ("b", "다람", 2)])
    assert [x.variant for x in parsers.ledger(lines, "build").orderBy("variant").collect()] == ["b", "가옹", "나비", "비티`"]
    assert [x.variant for x in parsers.ledger(lines, "usage").collect()] == []
    usage = parsers.numbered_lines(spark.createDataFrame([("k", "- `가옹`, 비티에씨, 나/다, abc → **가온** (9회)")], "key string, text string"), "key", "text")
    assert sorted(x.variant for x in parsers.ledger(usage, "usage").collect()) == ["가옹", "비티에"]
    log = spark.createDataFrame([("p", 0, "silence_start: -0.1"), ("p", 1, "silence_end: 2.5 |"), ("p", 2, "silence_start: 9")], "path string, line_no int, line string")
    assert [(x.silence_start, x.silence_end) for x in parsers.silences(log).orderBy("silence_start").collect()] == [(0.0, 2.5), (9.0, None)]
    blocks = spark.createDataFrame([("p", "transcription", None, '["b","a"]', None, "x", 1, 1), ("a", "text", '{"title":[["A"],["!"]]}', None, "p", "block", 1, 1), ("b", "text", '{"title":[["B"]]}', None, "p", "block", 1, 1)], "id string, type string, properties string, content string, parent_id string, parent_table string, alive int, created_time long")
    assert parsers.block_text(blocks).first().text == "B\nA!"
    q = spark.createDataFrame([(0, "# c"), (1, "b"), (2, ""), (3, "a"), (4, "b")], "line_no int, line string")
    assert [x.entry for x in parsers.queue_entries(q).orderBy("line_no").collect()] == ["b", "a"]


def test_write_if_changed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    assert sinks.if_changed(df, path, "k")
    assert not sinks.if_changed(df.orderBy(F.desc("k")), path, "k")
    assert sinks.if_changed(df.limit(1), path, "k")


def test_empty_inputs(spark):
    w = spark.createDataFrame([], "meeting int, word int, ws long, we long")
    t = spark.createDataFrame([], "meeting int, turn int, speaker string, ts long, te long")
    assert intervals.assign_overlap(w, t, 10).count() == 0
    assert search.postings(spark.createDataFrame([], "k int, text string"), "k", "text").count() == 0
    assert notes.contract(spark.createDataFrame([], "note_key string, text string")).count() == 0
