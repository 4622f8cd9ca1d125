"""F2 for whole batches of pairs: the furthest-reaching form of the edit distance, in numpy over all pairs at once.

With ``e`` edits, diagonal k (how far the second sequence is ahead) reaches at best row ``far[k]``; one more edit reaches from
the three diagonals around it, and matches are slid over at no cost. A pair takes as many rounds as it has edits, a round as many
diagonals: n steps of sliding and d squared of rounds in all, whatever the sequences' length. Sliding compares sixteen items in one step,
by hashes of runs, and then one after another. Pairs far apart leave the rounds for bit vectors (``text.edits``), whose work
follows n times n over the word size and not the edits: at the latest after as many rounds as cost a quarter of that (``limits``), or at once if their lengths differ by more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd

#: Edits after which any pair is given to the other form, and diagonals of all pairs that are held at once.
FAR, CELLS = 2000, 1 << 21
_RUN = 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _runs(items: np.ndarray) -> np.ndarray:
    """A hash of the _RUN items from each place on: of fewer at the end, and then of no other's kind."""
    total = items.astype(np.uint64) + np.uint64(1)
    total *= _MULTIPLIER
    step = 1
    while step < _RUN:
        later = np.zeros_like(total)
        later[:-step] = total[step:]
        total = (total ^ (total >> np.uint64(29))) * _MULTIPLIER + later
        step *= 2
    return total


def distances(a: np.ndarray, a_off: np.ndarray, b: np.ndarray, b_off: np.ndarray, otherwise: Callable[[int], int], far: int = FAR) -> np.ndarray:
    """Distances of the pairs a[a_off[i]:a_off[i + 1]], b[b_off[i]:b_off[i + 1]] of integers; ``otherwise(i)`` gives those of more than ``far`` edits.
    """
    n = len(a_off) - 1
    out = np.zeros(n, np.int64)
    if not n:
        return out
    pad = np.zeros(_RUN, np.int64) - 1
    a, b = np.concatenate([a, pad]).astype(np.int64), np.concatenate([b, pad]).astype(np.int64)
    ra, rb = _runs(a), _runs(b)
    la, lb = np.diff(a_off), np.diff(b_off)
    most = np.minimum(limits(np.maximum(la, lb)), far)
    todo, first = np.argsort(most, kind="stable"), 0  # pairs of like limits together
    while first < n:  # so many of them that their diagonals fit
        size = np.arange(1, n - first + 1) * (2 * most[todo[first:]] + 3)
        some = todo[first : first + max(1, int(np.searchsorted(size, CELLS, "right")))]
        first += len(some)
        left = _rounds(a, ra, a_off[some], la[some], b, rb, b_off[some], lb[some], some, out, most[some])
        for i in left:
            out[i] = otherwise(int(i))
    return out


def limits(n: np.ndarray) -> np.ndarray:
    """Rounds for sequences of n items whose diagonals cost about a quarter of bit vectors of n items over n columns, by measurement."""
    return (0.5 * np.sqrt(n * (13 + n / 300))).astype(np.int64)


def _slide(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray, pa: np.ndarray, pb: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many items match from places pa and pb on, of ``room`` at most."""
    went = np.zeros(len(pa), np.int64)
    live = np.flatnonzero(room > 0)
    while len(live):  # whole runs
        x = live[room[live] - went[live] >= _RUN]
        x = x[ra[pa[x] + went[x]] == rb[pb[x] + went[x]]]
        went[x] += _RUN
        live = x
    live = np.flatnonzero(room > went)
    while len(live):
        live = live[a[pa[live] + went[live]] == b[pb[live] + went[live]]]
        went[live] += 1
        live = live[went[live] < room[live]]
    return went


def _rounds(a, ra, a0, la, b, rb, b0, lb, names: np.ndarray, out: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Fill ``out`` for the pairs of at most ``most`` edits; the others' names."""
    far = int(most.max())
    none = np.int64(-1 << 40)
    goal = lb - la  # the diagonal on which both end
    reach = np.full((len(a0), 2 * far + 3), none)
    mid = far + 1
    live = np.flatnonzero(np.abs(goal) <= most)
    late = [np.flatnonzero(np.abs(goal) > most)]
    for e in range(far + 1):
        if not len(live):
            break
        k = np.arange(-e, e + 1)
        if e == 0:
            row = np.zeros((len(live), 1), np.int64)
        else:
            was = reach[live, mid - e - 1 : mid + e + 2]
            row = np.maximum(np.maximum(was[:, 1:-1] + 1, was[:, 2:] + 1), was[:, :-2])  # an item replaced, one of the first left out, one of the second put in
        row = np.minimum(row, np.minimum(la[live][:, None], lb[live][:, None] - k))
        ok = (row >= 0) & (row + k >= 0)
        at, col = np.nonzero(ok)
        x = row[at, col]
        i, kk = live[at], k[col]
        room = np.minimum(la[i] - x, lb[i] - (x + kk))
        x = x + _slide(a, ra, b, rb, a0[i] + x, b0[i] + x + kk, room)
        row = np.where(ok, row, none)
        row[at, col] = x
        reach[live, mid - e : mid + e + 1] = row
        done = np.zeros(len(live), bool)
        near = np.abs(goal[live]) <= e
        done[near] = row[np.flatnonzero(near), goal[live][near] + e] >= la[live][near]
        out[names[live[done]]] = e
        late.append(live[~done & (most[live] <= e)])
        live = live[~done & (most[live] > e)]
    return names[np.concatenate(late)]


def numbered(sequences: Sequence[Sequence]) -> tuple[np.ndarray, np.ndarray]:
    """Items of sequences of anything hashable one after another, equal ones by equal numbers; and n + 1 offsets."""
    number: dict = {}
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
    flat = np.fromiter((number.setdefault(x, len(number)) for s in sequences for x in s), np.int64, int(offsets[-1]))
    return flat, offsets


def of_texts(xs: Sequence[str], ys: Sequence[str], otherwise: Callable[[int], int]) -> np.ndarray:
    def points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), offsets

    return distances(*points(xs), *points(ys), otherwise)


def of_tokens(xs: Sequence[Sequence[str]], ys: Sequence[Sequence[str]], otherwise: Callable[[int], int]) -> np.ndarray:
    flat, offsets = numbered([*xs, *ys])
    cut = offsets[len(xs)]
    return distances(flat[:cut], offsets[: len(xs) + 1], flat[cut:], offsets[len(xs) :] - cut, otherwise)


#: Words of all pairs in one step, words of the pairs' tables, and columns of all pairs that are held at once.
LANES, TABLE, COLUMNS = 8192, 1 << 21, 1 << 21
#: What a step costs at least, and what a column of one pair and a word more cost the other form than this one, in microseconds by measurement.
STEP, COLUMN, WORD = 25, 3.5, 0.08
_ONES, _TOP, _ONE = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(63), np.uint64(1)


def _symbols(a: Sequence, b: Sequence) -> tuple[np.ndarray, np.ndarray, int]:
    """The shorter sequence by numbers of its items, the longer by the same, or one more than them all; and how many there are. Equal ends are left out."""
    if len(a) > len(b):
        a, b = b, a
    if isinstance(a, str):
        x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    else:
        both = np.empty(len(a) + len(b), object)
        both[: len(a)], both[len(a) :] = a, b
        x, y = np.split(pd.factorize(both, use_na_sentinel=False)[0], [len(a)])
    low = int(np.argmax(np.append(x != y[: len(x)], True)))
    x, y = x[low:], y[low:]
    high = int(np.argmax(np.append(x[::-1] != y[::-1][: len(x)], True)))
    x, y = x[: len(x) - high], y[: len(y) - high]
    if not len(x):
        return x, y, 0
    most = int(max(x.max(), y.max()))
    if most < 4096 or most < 4 * len(x):
        there = np.zeros(most + 1, np.int64)
        there[x] = 1
        total = int(there.sum())
        there = np.where(there > 0, np.cumsum(there) - 1, total).astype(np.int32)
        return there[x], there[y], total
    known, x = np.unique(x, return_inverse=True)
    at = np.minimum(np.searchsorted(known, y), len(known) - 1)
    return x.astype(np.int32), np.where(known[at] == y, at, len(known)).astype(np.int32), len(known)


def in_vectors(pairs: Sequence[tuple[Sequence, Sequence]], otherwise: Callable[[int], int]) -> np.ndarray:
    """F2 of pairs of sequences that are far apart, by bit vectors of many pairs in one step. A pair's first band is its ends' diagonals and a few around them;
    if a path beyond it may be shorter, it is done once more in a band as wide as the distance found. ``otherwise(i)`` is asked for pairs that too few others are like."""
    made = [_symbols(*p) for p in pairs]
    size = np.array([(len(x), len(y)) for x, y, _ in made], np.int64).reshape(-1, 2)
    out, more = size[:, 1].copy(), size[:, 1] - size[:, 0]
    live, side = np.flatnonzero(size[:, 0] > 0), 32 + more // 16
    for _ in range(2):
        again = [live[:0]]
        for some in _alike(live, size, more + 2 * side, [n for *_, n in made]):
            wide = int(side[some].max())
            words = np.minimum(more[some] + 2 * wide, size[some, 0]) / 64
            if (COLUMN + WORD * words).sum() < STEP:
                out[some] = [otherwise(int(i)) for i in some]
                continue
            out[some] = _banded([made[i] for i in some], size[some], wide)
            again.append(some[out[some] > more[some] + 2 * wide + 1])
        live = np.concatenate(again)
        side[live] = (out[live] - more[live]) // 2 + 1
    return out


def _alike(live: np.ndarray, size: np.ndarray, wide: np.ndarray, symbols: list[int]) -> list[np.ndarray]:
    """Pairs of like lengths and bands together, so many that a step's vectors stay small."""
    groups: list[list[int]] = []
    longest = most = least = held = 0
    for i in sorted(live.tolist(), key=lambda i: (-size[i, 1], wide[i])):
        columns, words = int(size[i, 1]), min(int(wide[i]), int(size[i, 0])) // 64 + 2
        table = (symbols[i] + 1) * (int(size[i, 0]) // 64 + 1)
        if groups and 10 * columns >= 6 * longest and most <= 2 * words <= 4 * least:
            n = len(groups[-1]) + 1
            if max(most, words) * n <= LANES and longest * n <= COLUMNS and held + table <= TABLE:
                groups[-1].append(i)
                most, least, held = max(most, words), min(least, words), held + table
                continue
        groups.append([i])
        longest, most, least, held = columns, words, words, table
    return [np.array(g) for g in groups]


def _banded(pairs: list[tuple[np.ndarray, np.ndarray, int]], size: np.ndarray, side: int) -> np.ndarray:
    """The fewest edits of paths within ``side`` diagonals of those that the ends lie on, or a little more. A word is 64 items of the first
    sequence; in step t word w is at column t - w of the second, so that all words of all pairs move at once, each with what the word above
    it told of the same column a step before. Above the band's first word a column is one more than the last."""
    last = (size[:, 0] - 1) // 64
    order = np.argsort(-(size[:, 1] + last), kind="stable")
    last, m, n = last[order], size[order, 0], size[order, 1]
    words, columns, count = int(last.max()) + 1, int(n.max()), len(order)
    w = np.arange(words, dtype=np.int64)
    begins = np.maximum(1, 64 * w + 1 - side)
    los = np.searchsorted(np.minimum(columns, 64 * w + 64 + int((n - m).max()) + side) + w, np.arange(columns + words + 1), "left").tolist()
    his = np.searchsorted(begins + w, np.arange(columns + words + 1), "right").tolist()
    rows = np.array([pairs[i][2] + 1 for i in order]) * (last + 1)
    at = np.concatenate([[0], np.cumsum(rows)])
    table = np.zeros(int(at[-1]) + words, np.uint64)
    asked = np.empty((columns, count), np.int64)  # the second sequences from their ends on: where each item's words begin
    for k, i in enumerate(order):
        x, y, none = pairs[i]
        place = np.arange(len(x))
        np.add.at(table, at[k] + x * (last[k] + 1) + place // 64, _ONE << (place % 64).astype(np.uint64))
        asked[: columns - len(y), k] = at[k] + none * (last[k] + 1)
        asked[columns - len(y) :, k] = (at[k] + y * (last[k] + 1))[::-1]
    up, down = np.full((words, count), _ONES), np.zeros((words, count), np.uint64)
    plus, minus = np.ones((words + 1, count), np.uint64), np.zeros((words + 1, count), np.uint64)
    score = np.repeat((64 * w + 64).astype(np.uint64)[:, None], count, 1)
    w = w[:, None]
    ends, out, left, lo, hi = (n + last).tolist(), np.zeros(count, np.int64), count, -1, -1
    for t in range(1, ends[0] + 1):
        while ends[left - 1] < t:
            left -= 1
        if 4 * left <= 3 * up.shape[1]:
            up, down, plus, minus, score, asked = (np.ascontiguousarray(z[:, :left]) for z in (up, down, plus, minus, score, asked))
            lo = -1
        if los[t] != lo or his[t] != hi:
            if his[t] > hi > 0 and begins[hi] > 1:  # a word that begins below the one before
                score[hi] = score[hi - 1] - plus[hi] + minus[hi] + np.uint64(64)
            moved, lo, hi = los[t] > max(lo, 0), los[t], his[t]
            pv, mv, s, hp, hm, np_, nm = up[lo:hi], down[lo:hi], score[lo:hi], plus[lo:hi], minus[lo:hi], plus[lo + 1 : hi + 1], minus[lo + 1 : hi + 1]
            eq, xv, x, ph, mh = (np.empty(pv.shape, np.uint64) for _ in range(5))
            idx, ws = np.empty(pv.shape, np.int64), w[lo:hi]
        else:
            moved = False
        np.add(asked[columns - t + lo : columns - t + hi], ws, out=idx)
        np.take(table, idx, out=eq, mode="clip")
        np.bitwise_or(eq, mv, out=xv)
        np.bitwise_or(eq, hm, out=eq)
        np.bitwise_and(eq, pv, out=x)
        np.add(x, pv, out=x)
        np.bitwise_xor(x, pv, out=x)
        np.bitwise_or(x, eq, out=x)
        np.bitwise_or(x, pv, out=ph)
        np.invert(ph, out=ph)
        np.bitwise_or(ph, mv, out=ph)
        np.bitwise_and(pv, x, out=mh)
        np.left_shift(ph, _ONE, out=x)
        np.bitwise_or(x, hp, out=x)
        np.left_shift(mh, _ONE, out=eq)
        np.bitwise_or(eq, hm, out=eq)
        np.bitwise_or(xv, x, out=pv)
        np.invert(pv, out=pv)
        np.bitwise_or(pv, eq, out=pv)
        np.bitwise_and(x, xv, out=mv)
        np.right_shift(ph, _TOP, out=np_)
        np.right_shift(mh, _TOP, out=nm)
        np.add(s, np_, out=s)
        np.subtract(s, nm, out=s)
        if moved or lo and t == 1:
            plus[lo], minus[lo] = 1, 0
        k = left - 1
        while k >= 0 and ends[k] == t:  # the rows of the last word that are none of the first sequence's are taken off
            beyond = _ONES << np.uint64(m[k] - 64 * last[k]) if m[k] < 64 * last[k] + 64 else np.uint64(0)
            out[k] = int(score[last[k], k]) - int(up[last[k], k] & beyond).bit_count() + int(down[last[k], k] & beyond).bit_count()
            k -= 1
    found = np.zeros(count, np.int64)
    found[order] = out
    return found
