"""The automaton of many terms against a search for each term, and the operators that use it."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.functions import automaton
from parley.functions import text as T
from parley.operators import identity, terms


def places(text, wanted):
    return sorted((i, w) for w in wanted for i in range(len(text) - len(w) + 1) if text[i : i + len(w)] == w)


def found(made, wanted, texts):
    out = [[] for _ in texts]
    for first, f in automaton.scan(made, pa.array(texts, pa.string())):
        for r, s, t, b, e in zip(f.row, f.start, f.term, f.before, f.behind):
            text, word = texts[first + r], wanted[t]
            out[first + r].append((int(s), word))
            assert b == (ord(text[s - 1]) if s else 0) and e == (ord(text[s + len(word)]) if s + len(word) < len(text) else 0)
    return out


@pytest.mark.parametrize("block,together,most", [(512, 1 << 21, 1 << 23), (3, 40, 1 << 23), (1, 7, 60), (16, 1, 30)])
def test_every_occurrence(monkeypatch, block, together, most):
    monkeypatch.setattr(automaton, "BLOCK", block)
    monkeypatch.setattr(automaton, "TOGETHER", together)
    rng = random.Random(block)
    for _ in range(15):
        letters = rng.choice(["ab", "abcé", "가나\U0001f44dx"])
        word = lambda most: "".join(rng.choice(letters) for _ in range(rng.randrange(most)))
        wanted = sorted({word(7) for _ in range(rng.randrange(12))} - {""})
        texts = [word(60) for _ in range(12)] + ["", None, "a" * 50, "z"]
        made = automaton.automata(wanted, most)
        assert sum(len(a.lengths) for a in made) == len(wanted) and (most > 1000 or len(made) > 1 or len(wanted) < 6)
        assert found(made, wanted, texts) == [places(t or "", wanted) for t in texts]


def test_terms_that_end_within_each_other():
    wanted = ["a", "aa", "aaa", "aaaa", "ba"]
    assert found(automaton.automata(wanted), wanted, ["aaaab", "baaa"]) == [places("aaaab", wanted), places("baaa", wanted)]


def test_work_follows_the_texts():
    """Terms that are beginnings of one another all along a text take one step a character."""
    wanted = ["a" * k for k in (50, 100, 200)]
    texts = ["a" * 400_000, "ab" * 1000]
    began = time.perf_counter()
    n = sum(len(f.row) for _, f in automaton.scan(automaton.automata(wanted), pa.array(texts)))
    assert n == sum(400_000 - k + 1 for k in (50, 100, 200)) and time.perf_counter() - began < 10


def test_ledger_by_automaton_and_by_join(spark, monkeypatch):
    rng = random.Random(7)
    text = lambda: "".join(rng.choice("가나다 ab,\n") for _ in range(rng.randrange(60)))
    rows = [(i, text() if i % 9 else None) for i in range(40)]
    ledger = spark.createDataFrame([("가", "X", 1), ("가나", "Y", 2), ("가나", "Z", 3), ("나다 a", "W", 4), ("b", "V", 5), ("가나", "Y", 2)], "variant string, target string, count int")
    df = spark.createDataFrame(rows, "note int, text string")
    told = {(n, v, t, c) for n, x in rows if x for v, t, c in ledger.distinct().collect() for i, w in places(x, [v]) if i == 0 or not x[i - 1].isalnum()}
    assert sorted(map(tuple, identity.relevant_ledger(df, ledger).collect())) == sorted(told)
    both = [sorted({(r.note, r.variant, r.rest) for r in f(df, "text", ledger, 2).collect()}) for f in (identity._begun, identity._begun_by_join)]
    assert both[0] == both[1] and both[0]
    monkeypatch.setattr(terms, "MOST_CHARS", 3)
    assert sorted(map(tuple, identity.relevant_ledger(df, ledger).collect())) == sorted(told)
    assert identity.relevant_ledger(df, ledger.limit(0)).count() == 0 and identity.relevant_ledger(df.limit(0), ledger).count() == 0


def test_phrases(spark):
    df = spark.createDataFrame([(1, "a b\tc\n\nb c a"), (2, "ab c"), (3, ""), (4, None), (5, "x " * 5000 + "a b")], "k int, text string")
    wanted = spark.createDataFrame([(1, "a  b"), (2, "b c"), (3, "c"), (4, " "), (5, "a b"), (6, "b c a"), (7, None)], "i int, p string")
    got = sorted(map(tuple, terms.phrases(df, "k", T.collapsed(F.col("text")), wanted, "i", T.collapsed(F.col("p"))).collect()))
    assert got == [(1, 1), (1, 2), (1, 3), (1, 5), (1, 6), (2, 3), (5, 1), (5, 5)]


def test_occurrences_keep_columns(spark):
    df = spark.createDataFrame([(1, "x", "ab ab"), (2, "y", "cab"), (3, "z", "q")], "k int, `_terms x` string, text string")
    got = terms.occurrences(df, "text", ["ab", "b"], "a-z", places=True).orderBy("k").collect()
    assert [(r.k, r["_terms x"], [(t.term, t.start) for t in r["_terms"]]) for r in got] == [(1, "x", [("ab", 0), ("ab", 3)])]
    first = terms.occurrences(df, "text", ["ab", "b"]).orderBy("k").collect()
    assert [(r.k, r["_terms"]) for r in first] == [(1, ["ab", "b"]), (2, ["ab", "b"])]
    assert np.array_equal(terms._letters("가-힣a-z"), [[0xAC00, 0xD7A3], [97, 122]])
