"""Steps whose memory, moved bytes or longest task must not follow the largest batch, key or partition."""

from __future__ import annotations

import random
import re

import pandas as pd
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.operators import identity, publication, readable
from parley.plans import ledgers, notes, texts


def test_distances_of_a_batch_go_in_parts(monkeypatch):
    r = random.Random(3)
    xs = ["".join(r.choice("abc") for _ in range(r.randrange(60))) if i % 7 else None for i in range(80)]
    ys = [x and x[1:] + "c" for x in xs]
    seen = []

    def of(a, b, otherwise):
        seen.append(sum(map(len, a)) + sum(map(len, b)))
        return T.distance.of_texts(a, b, otherwise)

    monkeypatch.setattr(T, "TOGETHER", 200)
    got = T._distances(pd.Series(xs, index=range(5, 85)), pd.Series(ys, index=range(5, 85)), of)
    assert [None if pd.isna(x) else int(x) for x in got] == [None if x is None else T.edits(x, y) for x, y in zip(xs, ys)]
    assert len(seen) > 5 and max(seen) <= 200


def test_admission_moves_each_side_once(spark):
    h = lambda c: c * 64
    receipts = [(1, "a", h("0")), (1, "b", h("1")), (2, "a", h("2")), (3, "a", "plain"), (4, "a", None), (5, "a", h("3")), (5, None, h("3")), (None, "a", h("0")), (6, "a", h("A")), (7, "a", h("4")), (7, "a", h("5"))]
    artifacts = [(1, "a", h("0")), (1, "b", h("9")), (3, "a", "plain"), (4, "a", h("0")), (5, "a", None), (5, None, h("3")), (None, "a", h("0")), (6, "a", h("a")), (7, "a", h("4")), (7, "a", h("6")), (8, "a", h("0"))]
    want: dict = {}
    for k, kind, sha in receipts:
        met = [s for a, b, s in artifacts if None not in (k, kind) and (a, b) == (k, kind)] or [None]
        m, s = want.get(k, (0, 0))
        want[k] = (m + met.count(None), s + sum(x is not None and sha is not None and x != sha for x in met))
    frame = lambda rows: spark.createDataFrame(rows, "key long, kind string, sha256 string")
    found = publication.admitted(frame(receipts), frame(artifacts))
    assert {r.key: (r.missing, r.stale) for r in found.collect()} == want and all(r.ready == (r.missing + r.stale == 0) for r in found.collect())
    plan = publication.admitted(frame(receipts), frame(artifacts))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_turns_are_compared_in_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(texts, "TURNS", 10, raising=False)
    spark.createDataFrame([(c, t, f"turn {t} of {c}") for c in range(40) for t in range(4)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert texts.ab_text_compare(spark, str(tmp_path)).rdd.getNumPartitions() >= 16


def test_glossary_cleans_each_term_once(spark, tmp_path, monkeypatch):
    """Notes of one file are read by many tasks, and terms meet before they are cleaned: the same term in another form still has its first note."""
    spark.range(1, 41).selectExpr("id c_custkey", "cast(id % 5 as int) c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert ledgers._noted(spark, str(tmp_path))[0].rdd.getNumPartitions() > 1
    text = "### 기타 메모\n- **TERM** 말\n"
    notes = spark.createDataFrame([(n, text.replace("TERM", t)) for n, t in ((4, "베타"), (3, "베타."), (2, "감마"), (5, " 베타"))], "note long, text string")
    assert [tuple(r) for r in identity.glossary(notes).collect()] == [("감마", 2), ("베타", 3)]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_of_notes_are_not_copied_from_level_to_level(spark):
    """A value that is used often is kept without a copy of all its parts, unlike transform does with what it makes."""
    notes = spark.createDataFrame([("a", "# t\n## 1. b\n")], "note_key string, text string")
    for plan in (_plan(readable.projected(notes)), _plan(notes.select(readable.picture_of(F.col("text"))))):
        assert "transform(array(" not in plan and "aggregate(" in plan


def test_white_space_of_lines(spark):
    """A note with rare white space is stripped of all of it, others of what they have; a line break in any form, and marks after it."""
    text = " # t　\r\n\x1c날 \r## 1. a\x85\n ```\n ~~~\n## no\n~~~\n- §4.1 \n## 2. Action Items\n - [X] **A1 · **가**** \n　홍 ·  ·  낮 · §4.1\n## 4. b\n###　4.1 다 ABC\x1f\n"
    made = spark.createDataFrame([(text,), (text.replace("홍 · ", "홍 "),)], "text string").select(readable.readable_text(F.col("text"), F.lit(None).cast("string")).alias("r")).collect()
    assert [x.r for x in made] == [
        "# t\n\n> 날\n\n## 1. a\n\n ```\n ~~~\n## no\n~~~\n- [4.1 다 ABC](#41-다-abc)\n\n---\n\n## 2. Action Items\n\n- [x] **A1 · **가**** — **담당** · 홍 · **일정** ·  · 낮 · **근거** · [4.1 다 ABC](#41-다-abc)\n\n---\n\n## 4. b\n\n###　4.1 다 ABC\n",
        "# t\n\n> 날\n\n## 1. a\n\n ```\n ~~~\n## no\n~~~\n- [4.1 다 ABC](#41-다-abc)\n\n---\n\n## 2. Action Items\n\n- [x] **A1 · **가**** — **담당** · 홍 · **일정** · 낮 · **근거** · [4.1 다 ABC](#41-다-abc)\n\n---\n\n## 4. b\n\n###　4.1 다 ABC\n",
    ]


def test_forms_are_made_once_to_be_compared(spark):
    assert _plan(notes.readable_faithful(spark, "/root/testdata/sf0.001")).count("Action Items") <= _plan(notes.readable_projection(spark, "/root/testdata/sf0.001")).count("Action Items") + 2
