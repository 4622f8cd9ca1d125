"""Titles of ancestors: over more rows than a recursive statement may give, cycles and rows without a parent."""

from __future__ import annotations

from parley.operators.state import ancestors


def test_ancestors_beyond_a_recursion_limit(spark):
    rows = [(i, i // 2 if i > 1 else None, "" if i % 3 else f"t{i}") for i in range(1, 400)] + [(1000, 1001, None), (1001, 1000, ""), (1002, 1000, "x"), (1003, 77, "own")]
    parent, title = {i: p for i, p, _ in rows}, {i: t for i, _, t in rows}
    want = {}
    for i in parent:
        at, depth = parent[i], 1
        while at is not None and depth <= 6 and not title[at]:
            at, depth = parent[at], depth + 1
        if at is not None and depth <= 6:
            want[i] = (title[at], depth)
    limit = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(limit, "100")
    try:
        got = ancestors(spark.createDataFrame(rows, "id long, parent_id long, title string")).collect()
    finally:
        spark.conf.unset(limit)
    assert {r.id: (r.title, r.depth) for r in got} == want and len(got) == len(want)
