"""the share of two texts that longest matching blocks cover, by a suffix automaton.

The longest block that both texts have is found first, the earliest in the first text and then in the second of several; then the same is done
on the left of it and on its right. The automaton of the second text's part takes the first text's part in one pass, so a step is linear in its
parts. Parts that lie in the first text are never built twice: what is left of a block is a new, smaller pair.
"""

from __future__ import annotations


def longest(a: str, b: str) -> tuple[int, int, int]:
    """(place in a, place in b, length) of the longest common block: of several the first in ``a``, then the first in ``b``."""
    if not a or not b:
        return 0, 0, 0
    # states of the automaton of b: transitions, length of the longest text of a state, link to the next shorter one, first end in b
    go: list[dict[str, int]] = [{}]
    length, link, end = [0], [-1], [0]
    last = 0
    for i, c in enumerate(b):
        now = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        end.append(i + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = now
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = len(go)
                go.append(go[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                end.append(end[q])  # texts of the twin end where q's first do, or earlier ones of its own kind: the first of all
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    state = best = held = 0
    at = where = 0
    for i, c in enumerate(a):
        while state and c not in go[state]:
            state = link[state]
            held = length[state]
        if c in go[state]:
            state = go[state][c]
            held += 1
        if held > best:
            best, at, where = held, i + 1 - held, end[state] - held
    return at, where, best


def blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """All matching blocks (place in a, place in b, length), in order of place."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        at, where, n = longest(a[a0:a1], b[b0:b1])
        if n:
            found.append((a0 + at, b0 + where, n))
            todo += [(a0, a0 + at, b0, b0 + where), (a0 + at + n, a1, b0 + where + n, b1)]
    return sorted(found)


def ratio(a: str, b: str) -> float:
    """Twice the matched characters over all; 1 for two empty texts. Equal ends are no special case: the longest block comes first."""
    whole = len(a) + len(b)
    return 2.0 * sum(n for _, _, n in blocks(a, b)) / whole if whole else 1.0
