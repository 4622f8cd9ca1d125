"""Queries over whole tables against brute force on small fixtures."""

from __future__ import annotations

import random

from parley.functions.text import edits
from parley.plans import audits, identities, searches


def written(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_patch_budget_fold_takes_all_orders(spark, tmp_path):
    r = random.Random(5)
    rows = [(o, i, r.randrange(1000), r.randrange(1000), r.randrange(1, 50)) for o in (1, 2, 3999, 4000, 4001, 70_399, 149_999, *range(9_300, 9_400)) for i in range(1, r.randint(2, 8))]
    where = written(spark, tmp_path, "lineitem", rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity int")
    want = {}
    for o in sorted({x[0] for x in rows}):
        used, kept = 0, []
        for _, _, p, s, q in sorted(x for x in rows if x[0] == o):
            line, a, z = p % 3, s % 40, s % 40 + 1 + q % 9
            if not any(k == line and b < z and a < e for k, b, e in kept) and (used + z - a) / (100 + 2 * (o % 400)) <= 0.05:
                used, kept = used + z - a, [*kept, (line, a, z)]
        if kept:
            want[o] = (used, len(kept))
    assert {x.doc: (x.used, x.kept) for x in audits.patch_budget_fold(spark, where).collect()} == want and max(want) >= 4000


def test_previous_notes_of_every_key(spark, tmp_path):
    r = random.Random(6)
    rows = [(c, t, r.choice(("user", "assistant", "system"))) for c in (*range(0, 40), 79, 80, 990, 1000, 1001, 2500, 9000) for t in range(r.randint(1, 6))]
    where = written(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string")
    want = set()
    for c, role in {(c, role) for c, _, role in rows}:
        want |= {(role, c, x, t) for x, t in sorted(((x, t) for x, t, k in rows if k == role and x < c), reverse=True)[:3]}
    got = [tuple(x) for x in audits.previous_notes(spark, where).select("role", "at", "conv_id", "turn").collect()]
    assert set(got) == want and len(got) == len(want)


def test_fuzzy_names_of_all_parts(spark, tmp_path):
    r = random.Random(8)
    names = sorted({" ".join("".join(r.choice("ab") for _ in range(r.randint(3, 5))) for _ in "12") for _ in range(70)})
    where = written(spark, tmp_path, "part", list(enumerate(names, 1)), "p_partkey long, p_name string")
    tokens = {n.replace(" ", "") for n in names}
    want = set()
    for t in tokens:
        scored = sorted((-(1 - edits(t, n) / max(len(t), len(n))), n) for n in {x + "x" for x in tokens} if n != t and 1 - edits(t, n) / max(len(t), len(n)) >= 0.72)
        want |= {(t, n, i) for i, (_, n) in enumerate(scored[:2], 1)}
    assert {(x.token, x.name, x.rank) for x in identities.fuzzy_name_join(spark, where).collect()} == want


def test_substrings_of_all_terms(spark, tmp_path):
    passages = [(1, "Their harbour lantern thistle"), (2, "quarry Lantern walnut é")]
    docs = [(1, "LANTERNS and unquarried stone"), (2, "the thistledown"), (3, "walnu t"), (4, "theirs: harbours"), (5, None)]
    written(spark, tmp_path, "benchmark", passages, "item_id long, text string")
    where = written(spark, tmp_path, "documents", docs, "doc_id long, text string")
    terms = {"their", "harbour", "lantern", "thistle", "quarry", "walnut"}
    want = {(t, d) for t in terms for d, x in docs if x and t in x.lower()}
    assert {(x.term, x.doc_id) for x in searches.substring_search(spark, where).collect()} == want
