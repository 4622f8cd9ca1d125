"""Many terms found in many texts at once: a trie with failure links, kept as flat arrays, stepped in numpy.

The trie is completed to an automaton that has one next state for each state and character, so a text takes one
step a character however its terms overlap. Texts are laid out as blocks of equal length that overlap by the longest
term, and all blocks of a batch step together: a step is one lookup in a table for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Most entries of the table (states times characters, four bytes each) that one automaton may have; more terms make several.
MOST_CELLS = 1 << 23
#: Characters of a block without its overlap, and characters of text that are laid out together.
BLOCK, TOGETHER = 512, 1 << 21


@dataclass
class Automaton:
    """``table[state, symbol]`` is the next state; symbol 0 stands for characters of no term. ``ends[state]`` is the term
    that ends there or -1, ``shorter[state]`` the nearest state by failure links where another term ends, or 0."""

    first: int
    alphabet: np.ndarray
    table: np.ndarray
    ends: np.ndarray
    shorter: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, terms: Sequence[str], first: int = 0) -> Automaton:
        """Distinct terms, none empty; they are numbered from ``first``."""
        alphabet = np.array(sorted({ord(c) for t in terms for c in t}), np.uint32)
        symbol = {chr(c): i + 1 for i, c in enumerate(alphabet)}
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for n, term in enumerate(terms):
            at = 0
            for c in term:
                s = symbol[c]
                if s not in children[at]:
                    children[at][s] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][s]
            ends[at] = n
        table = np.zeros((len(children), len(alphabet) + 1), np.int32)
        fail, shorter = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
        level = [0]
        while level:  # by depth: a state's failure link leads to one of less depth, whose row is complete
            below = []
            for at in level:
                row = table[fail[at]].copy() if at else table[0].copy()
                for s, child in children[at].items():
                    fail[child] = row[s] if at else 0
                    shorter[child] = fail[child] if ends[fail[child]] >= 0 else shorter[fail[child]]
                    row[s] = child
                    below.append(child)
                table[at] = row
            level = below
        return cls(first, alphabet, table, np.array(ends, np.int32), shorter, np.array([len(t) for t in terms], np.int64))

    def run(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends (positions in ``points``, behind the last character) and numbers of all occurrences in the texts
        points[offsets[i]:offsets[i + 1]]; no occurrence crosses two texts."""
        overlap = int(self.lengths.max()) - 1
        sizes = np.diff(offsets)
        pieces = np.maximum(-(-sizes // BLOCK), 0)
        text = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = offsets[text] + nth * BLOCK
        lead = np.minimum(nth * BLOCK, overlap)  # what a block sees of the text before it
        start, stop = begin - lead, np.minimum(begin + BLOCK, offsets[text + 1])
        symbol = np.zeros(int(self.alphabet[-1]) + 2, np.int32)
        symbol[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        symbols = symbol[np.minimum(points, np.uint32(len(symbol) - 1))]
        order = np.argsort(start - stop, kind="stable")  # longest first: the blocks that still run are the first ones
        start, stop, begin = start[order], stop[order], begin[order]
        length = stop - start
        state = np.zeros(len(start), np.int32)
        flat, width = self.table.ravel(), self.table.shape[1]
        found, where = [], []
        alive = len(start)
        for k in range(int(length[0]) if len(length) else 0):
            while alive and length[alive - 1] <= k:
                alive -= 1
            at = start[:alive] + k
            now = flat[state[:alive] * width + symbols[at]]
            state[:alive] = now
            hit = np.flatnonzero((self.ends[now] >= 0) | (self.shorter[now] > 0))
            hit = hit[at[hit] >= begin[hit]]  # an end in the lead is the block's before
            if len(hit):
                found.append(now[hit])
                where.append(at[hit] + 1)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        states, where = np.concatenate(found), np.concatenate(where)
        out_end, out_term = [], []
        while len(states):
            own = self.ends[states] >= 0
            out_end.append(where[own])
            out_term.append(self.ends[states[own]])
            states = self.shorter[states]
            where, states = where[states > 0], states[states > 0]
        return np.concatenate(out_end), np.concatenate(out_term).astype(np.int64)


def automata(terms: Sequence[str], most: int = MOST_CELLS) -> list[Automaton]:
    """The terms in as few automata as their tables' size allows; a term too long for one by itself gets it all the same."""
    made, some, chars, seen = [], [], 0, set()
    first = 0
    for term in terms:
        more = seen | set(term)
        if some and (chars + len(term) + 1) * (len(more) + 1) > most:
            made.append(Automaton.of(some, first))
            first += len(some)
            some, chars, more = [], 0, set(term)
        some.append(term)
        chars, seen = chars + len(term), more
    if some:
        made.append(Automaton.of(some, first))
    return made


@dataclass
class Found:
    """Occurrences in a batch of texts, by text and start: row, start and term (its number), and the characters before and behind each (0: none)."""

    row: np.ndarray
    start: np.ndarray
    term: np.ndarray
    before: np.ndarray
    behind: np.ndarray


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of a string column one after another, and n + 1 offsets; a null is an empty text."""
    texts = ["" if t is None else t for t in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def scan(made: list[Automaton], column: pa.Array) -> Iterator[tuple[int, Found]]:
    """(first row, what stands in the next rows), for runs of texts of about TOGETHER characters; whole texts, of any length."""
    i = 0
    sizes = np.array([0 if t is None else len(t) for t in column.to_pylist()], np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    while i < len(column):
        j = min(max(i + 1, int(np.searchsorted(total, total[i] + TOGETHER, "right")) - 1), len(column))
        points, offsets = code_points(column.slice(i, j - i))
        ends, terms = [], []
        for a in made:
            end, term = a.run(points, offsets)
            ends.append(end)
            terms.append(term + a.first)
        end, term = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (ends, terms))
        lengths = np.concatenate([a.lengths for a in made]) if made else np.empty(0, np.int64)
        start = end - lengths[term]
        row = np.searchsorted(offsets, start, "right") - 1
        order = np.lexsort((term, start))
        start, end, term, row = start[order], end[order], term[order], row[order]
        pad = np.concatenate([[0], points, [0]])
        before, behind = np.where(start > offsets[row], pad[start], 0), np.where(end < offsets[row + 1], pad[end + 1], 0)
        yield i, Found(row, start - offsets[row], term, before, behind)
        i = j
