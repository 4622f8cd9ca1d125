"""Edit distances by furthest-reaching diagonals and matching blocks by a suffix automaton, against plain forms."""

from __future__ import annotations

import random
import time
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parley.functions import distance, matching
from parley.functions import text as T


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def changed(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(out) + 1), rng.randrange(3)
        out[i : i + (kind > 0)] = [rng.choice(letters)] if kind < 2 else []
    return "".join(out)


@pytest.mark.parametrize("far,cells", [(400, 1 << 21), (2, 40), (0, 1)])
def test_distances(monkeypatch, far, cells):
    monkeypatch.setattr(distance, "CELLS", cells)
    rng = random.Random(far)
    letters = "ab\U0001f44d가"
    word = lambda n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    xs = [word(50) for _ in range(150)] + ["", "", "abc", "a" * 60, "ab" * 40]
    ys = [changed(rng, x, rng.randrange(9), letters) for x in xs[:75]] + [word(50) for _ in range(75)] + ["", "xyz", "", "a" * 45, "ba" * 40]
    asked = []
    other = lambda i: asked.append(i) or T.edits(xs[i], ys[i])
    want = [plain(x, y) for x, y in zip(xs, ys)]
    monkeypatch.setattr(distance.distances, "__defaults__", (far,))
    if far < 400:
        monkeypatch.setattr(distance, "limits", lambda n: n)
    assert distance.of_texts(xs, ys, other).tolist() == want
    least = [min(far, int(k)) for k in distance.limits(np.array([max(len(x), len(y)) for x, y in zip(xs, ys)]))]
    assert sorted(asked) == [i for i, n in enumerate(want) if n > least[i]]
    assert distance.of_tokens([list(x) for x in xs], [list(y) for y in ys], other).tolist() == want
    assert distance.of_texts([], [], other).tolist() == []


def test_work_follows_the_edits():
    """Texts of a hundred thousand characters with few edits take as many rounds as they have edits."""
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef ") for _ in range(100_000))
    other = changed(rng, text, 40, "xyz")
    began = time.perf_counter()
    assert distance.of_texts([text, "a" * 100_000], [other, "a" * 99_990], lambda i: 1 / 0).tolist() == [T.edits(text, other), 10]
    assert time.perf_counter() - began < 5


def test_distance_columns(spark):
    rows = [(1, "kitten", "sitting"), (2, None, "a"), (3, "", ""), (4, "가나다", "가다"), (5, "a", None)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = df.select("k", T.edit_distance("a", "b").alias("c"), T.token_edit_distance(F.split("a", ""), F.split("b", "")).alias("t")).orderBy("k").collect()
    assert [(r.c, r.t) for r in got] == [(3, 3), (None, None), (0, 0), (1, 1), (None, None)]


def test_ratio_equals_the_plain_matcher():
    rng = random.Random(9)
    for letters in ("ab", "abc ", "가나\U0001f44dabcdefgh"):
        for _ in range(150):
            a = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
            b = changed(rng, a, rng.randrange(6), letters) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
            m = SequenceMatcher(None, a, b, autojunk=False)
            assert matching.longest(a, b)[2] == m.find_longest_match().size and (not matching.longest(a, b)[2] or matching.longest(a, b) == tuple(m.find_longest_match()))
            assert matching.ratio(a, b) == m.ratio(), (a, b)
    assert matching.ratio("", "") == 1 and matching.ratio("a", "") == 0


def test_long_texts_are_matched_in_time():
    rng = random.Random(2)
    a = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(20_000))
    b = changed(rng, a, 30, "xyz")
    began = time.perf_counter()
    assert 0.999 < matching.ratio(a, b) < 1
    assert time.perf_counter() - began < 20


def test_ratio_column(spark):
    df = spark.createDataFrame([(1, "abcd", "bcde"), (2, None, ""), (3, "x", None)], "k int, a string, b string")
    assert [r[0] for r in df.orderBy("k").select(T.matching_ratio("a", "b")).collect()] == [0.75, 1.0, 0.0]


@pytest.mark.parametrize("lanes,step", [(8, 0), (4096, 0), (4096, 25)])
def test_far_pairs_go_together(monkeypatch, lanes, step):
    """Bands of many pairs in one step, wider ones where the first doesn't hold a shortest path, and words that are no other's."""
    monkeypatch.setattr(distance, "LANES", lanes)
    monkeypatch.setattr(distance, "STEP", step)
    rng = random.Random(lanes + step)
    pairs = [("", ""), ("", "abc"), ("abc", "abc"), ("abc", "xabcy"), ("a" * 64, "b" * 64), ("a" * 65, "b" * 129)]
    for n in (40, 130, 400):
        for letters in ("ab", "abcdefgh ", "가나\U0001f44d xyz"):
            a = "".join(rng.choice(letters) for _ in range(rng.randrange(n // 2, n)))
            cut = rng.randrange(len(a))
            pairs += [(a, "".join(c for i, c in enumerate(a) if i % 7 != 6)), (a.upper(), a.lower()), (a[cut:] + a[:cut], a), (a, a + a[:cut]), (a, changed(rng, a, 9, letters))]
    want = [plain(*p) for p in pairs]
    asked = []
    other = lambda i: asked.append(i) or want[i]
    assert distance.in_vectors(pairs, other).tolist() == want and (step or not asked)
    assert distance.in_vectors([(list(a), list(b)) for a, b in pairs], other).tolist() == want


def test_many_far_pairs_take_few_calls(monkeypatch):
    """Texts a seventh apart are compared together, not one after another."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300, 1200))) for _ in range(200)]
    other, calls, alone = ["".join(c for i, c in enumerate(t) if i % 7 != 6) for t in texts], [], T.edits
    monkeypatch.setattr(T, "edits", lambda a, b: calls.append(1) or alone(a, b))
    assert T._distances(pd.Series(texts), pd.Series(other), distance.of_texts).tolist() == [alone(a, b) for a, b in zip(texts, other)]
    assert len(calls) < 20
