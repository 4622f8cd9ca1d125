"""E14 over random lines: the automaton's path and the join's agree, and no line moves once for each of its variants."""

from __future__ import annotations

import random
import re

from parley.operators import identity, terms


def test_usage_moves_a_line_once(spark, monkeypatch):
    r = random.Random(9)
    words = ["가나", "가나님", "가나는", "다라마", "x다라마", "다라마가", "바사,", "바사", "말", "## 검증 완료", "### 1. 기타"]
    rows = [(n, i, " ".join(r.choice(words[:9]) for _ in range(r.randrange(9))) if r.random() < 0.7 else r.choice(words[9:])) for n in range(30) for i in range(20)]
    rows += [(0, 3, rows[3][2]), (1, 4, None)]
    lines = spark.createDataFrame(rows, "note long, line_no int, line string")
    ledger = spark.createDataFrame([("가나", "하하", 9), ("가나", "호호", 9), ("가나", "호호", 9), ("다라마", "나나", 8), ("바사", "바사", 9), ("말", "마", 9)], "variant string, target string, count int")
    roster = spark.createDataFrame([], "name string")
    found = identity.usage_issues(lines, ledger, roster)
    got = sorted(map(tuple, found.collect()))
    assert not re.search(r"hashpartitioning\([^)]*\bline#[^)]* variant#", found._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(terms, "MOST_CHARS", 0)
    assert got == sorted(map(tuple, identity.usage_issues(lines, ledger, roster).collect())) and len(got) > 100
