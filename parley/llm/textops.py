"""Vectorised text kernels over Arrow string columns, shared by the free-style operators.

A word is a maximal run of bytes other than space and 0x09..0x0D, so it may hold any UTF-8
character. All kernels see whole texts: an Arrow column is walked in chunks of whole documents of
about ``CHUNK`` bytes, which bounds the temporaries whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_P = tuple(np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))
_PINV = tuple(np.uint64(pow(int(p), -1, 1 << 64)) for p in _P)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _pow(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept up to 2 chunks, computed anew beyond."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.empty(max(n, CHUNK + (1 << 16)), dtype=np.uint64)
        have[0] = 1
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        if len(have) <= 2 * CHUNK:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, off


@dataclass
class Chunk:
    """Documents first .. first + n - 1 of a batch: their bytes, and where each begins in them."""

    first: int
    raw: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def words(self, lower: bool = False, between: np.ndarray | None = None) -> Words:
        """``between``: which bytes separate words, if not white space alone."""
        return Words.of(self.raw, self.offsets, lower, between)


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Whole documents in runs of about ``limit`` bytes; a longer document is a run of its own."""
    raw, off = text_buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Chunk(i, raw[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def run_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of the byte runs raw[start:end], from one prefix sum of a polynomial; by one of two, told apart by ``which``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[which][raw] * _pow(_P[which], len(raw)), out=total[1:])
    return mix((total[ends] - total[starts]) * _pow(_PINV[which], len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of a chunk in order: byte spans, document numbers, hashes."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray  # words of each document

    @classmethod
    def of(cls, raw: np.ndarray, offsets: np.ndarray, lower: bool, between: np.ndarray | None = None) -> Words:
        n = len(offsets) - 1
        if lower:
            raw = _LOWER[raw]
        inside = ~(_SEP if between is None else between)[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(raw))]
        first[cuts] = inside[cuts]  # a word never crosses a document
        last[cuts - 1] = inside[cuts - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, starts, "right") - 1
        return cls(raw, starts, ends, doc, run_hash(raw, starts, ends), np.bincount(doc, minlength=n))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and positions of all runs of k words within one document."""
        m = len(self.hashes) - k + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(m, np.uint64)
        for j in range(k):
            total += self.hashes[j : j + m] * _SLOT[j]
        at = np.flatnonzero(self.doc[:m] == self.doc[k - 1 :])
        return mix(total[at] + np.uint64(k)), at

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and document numbers of all k-word shingles, by document; a document of fewer
        words has its whole sequence as its one shingle, one without words has none."""
        hashes, at = self.windows(k)
        owner = self.doc[at]
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if len(short):
            begin = np.cumsum(self.counts) - self.counts
            more = np.array([mix(np.array([(self.hashes[b : b + c] * _SLOT[:c]).sum(dtype=np.uint64) + np.uint64(1000 + c)]))[0] for b, c in zip(begin[short], self.counts[short])], np.uint64)
            hashes, owner = np.concatenate([hashes, more]), np.concatenate([owner, short])
            order = np.argsort(owner, kind="stable")
            hashes, owner = hashes[order], owner[order]
        return hashes, owner


_SLOT = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


def repeated(values: np.ndarray) -> np.ndarray:
    """True where a value stands more than once."""
    out = np.zeros(len(values), bool)
    if len(values) < 2:
        return out
    ordered = np.sort(values)
    again = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return out
    low = np.uint64((1 << 16) - 1)
    maybe = np.zeros(1 << 16, bool)
    maybe[(again & low).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(values & low).astype(np.int64)])
    where = np.minimum(np.searchsorted(again, values[at]), len(again) - 1)
    out[at] = again[where] == values[at]
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """True for the positions of 0 .. n - 1 inside any run of ``width`` from one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, n), -1)
    return np.cumsum(step[:-1]) > 0
