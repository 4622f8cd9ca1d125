"""Operator 5, best-fit packing: patterns of few documents by non-negative least squares.

Documents become ids and an end id; only one longer than a sequence is cut, into pieces of full
length, the first of which may be shorter. The histogram of lengths (as many numbers as a sequence
has tokens, whatever the input) is packed on the driver: patterns of two or three lengths that fill
a sequence are enumerated over length classes, their repeat counts fitted to the histogram by
non-negative least squares and rounded down, and what is left goes by best fit, longest first, into
the gaps and new sequences. The plan says which ranks of each length stand where, so that pieces
find their sequence by their rank among pieces of their length, without meeting each other.

Defined results: null text is empty: a piece that holds the end id alone. Null doc_id is an ordinary value. Rows
that repeat are packed each. No rows: no pieces. Extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ranked_within, scratch, store
from .tokens import SPACED, encoder, together, vocabulary

SEQUENCE, END, VOCABULARY = 2048, 0, "byte_bpe_50k.json"
UNIT = 8


def pieces(df: DataFrame, sequence: int = SEQUENCE, end: int = END, path: str | None = None, special: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""
    path = path or vocabulary(VOCABULARY)
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, SPACED, special)
        for b in together(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(enc.encode(b.column("text"))):
                ids += tail
                n = len(ids) // 4
                first = n if n <= sequence else n % sequence or sequence
                begin, stop, k = 0, first, 0
                while begin < n:
                    row.append(i)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop - begin)
                    crc.append(zlib.crc32(ids[4 * begin : 4 * stop]))
                    begin, stop, k = stop, stop + sequence, k + 1
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents(df).mapInArrow(run, "doc_id long, piece long, start long, length long, ids_crc32 long").withColumn("piece", F.col("piece").cast("int"))


# ---- the plan, from the histogram alone ----


def patterns(units: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """Two or three classes that fill ``units`` exactly, of those present, largest first."""
    has = set(np.flatnonzero(present).tolist())
    out = [(i, units - i) for i in range((units + 1) // 2, units) if i in has and units - i in has]
    for i in range(-(-units // 3), units - 1):
        if i in has:
            out += [(i, j, units - i - j) for j in range(-(-(units - i) // 2), min(i, units - i - 1) + 1) if j in has and units - i - j in has]
    return out


def nnls(shapes: list[tuple[int, ...]], goal: np.ndarray, sweeps: int = 25) -> list[float]:
    """Repeat counts x >= 0 that minimise |A x - goal|, column by column (A's columns count the
    classes of a shape)."""
    x, rest = [0.0] * len(shapes), goal.astype(float).tolist()
    cols = [(p, float(sum(p.count(u) for u in p))) for p in shapes]
    for _ in range(sweeps):
        moved = 0.0
        for k, (p, norm) in enumerate(cols):
            step = max(-x[k], sum(rest[u] for u in p) / norm)
            if step:
                x[k] += step
                moved = max(moved, abs(step))
                for u in p:
                    rest[u] -= step
        if moved < 0.25:
            break
    return x


def plan(counts: dict[int, int], sequence: int = SEQUENCE, unit: int = UNIT) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences): every piece stands in one."""
    bins: list[tuple[tuple[int, ...], int]] = []
    left = {length: n for length, n in counts.items() if n > 0}
    if sequence in left:
        bins.append(((sequence,), left.pop(sequence)))
    units = sequence // unit
    klass: dict[int, list[int]] = defaultdict(list)  # lengths of a class, longest first
    for length in sorted(left, reverse=True):
        klass[-(-length // unit)].append(length)
    goal = np.zeros(units + 1)
    for u, lengths in klass.items():
        goal[u] = sum(left[x] for x in lengths)
    goal[units] = 0  # such a length shares its sequence with what is left, if anything
    shapes = patterns(units, goal)
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for shape, repeats in sorted(zip(shapes, nnls(shapes, goal)), key=lambda p: -p[1]):
        n = int(repeats + 1e-6)
        while n > 0:
            lengths = []
            for i, u in enumerate(shape):  # the longest length of the class that has a piece left, given the ones before;
                # the last one may be longer than its class, by what the classes before were rounded up
                choice = klass[u] if i + 1 < len(shape) else range(sequence - sum(lengths), (u - 1) * unit, -1)
                found = next((x for x in choice if left.get(x, 0) > lengths.count(x)), None)
                if found is None:
                    break
                lengths.append(found)
            if len(lengths) < len(shape):
                break
            k = min([n, *(left[x] // lengths.count(x) for x in lengths)])
            for x in lengths:
                left[x] -= k
            for u in {-(-x // unit) for x in lengths}:
                klass[u] = [x for x in klass[u] if left[x]]
            open_bins[sequence - sum(lengths)].append((tuple(lengths), k))
            n -= k
    # best fit, longest first
    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n = left[length]
        for gap in sorted(g for g in open_bins if g >= length):
            each = gap // length
            while n and open_bins[gap]:
                shape, k = open_bins[gap].pop()
                full = min(k, n // each)
                if full:
                    open_bins[gap - each * length].append((shape + (length,) * each, full))
                    n -= full * each
                    k -= full
                if k and 0 < n < each:
                    open_bins[gap - n * length].append((shape + (length,) * n, 1))
                    n, k = 0, k - 1
                if k:
                    open_bins[gap].append((shape, k))
                    if not n:
                        break
            if not open_bins[gap]:
                del open_bins[gap]
            if not n:
                break
        each = sequence // length
        if n // each:
            open_bins[sequence - each * length].append(((length,) * each, n // each))
        if n % each:
            open_bins[sequence - n % each * length].append(((length,) * (n % each), 1))
    return bins + [x for group in open_bins.values() for x in group]


def places(bins: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset): ranks of a length to places."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for shape, n in bins:
        offset = 0
        for length in shape:
            out.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return out


def pack(df: DataFrame, sequence: int = SEQUENCE, end: int = END, path: str | None = None, special: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``special``: special tokens in a text are found, not spelled."""
    with scratch(df.sparkSession):
        return store(_packed(df.sparkSession, store(pieces(df, sequence, end, path, special), "pieces"), sequence), "packed", keep=True)


def _packed(spark: SparkSession, cut: DataFrame, sequence: int) -> DataFrame:
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # no more rows than ``sequence``
    where = places(plan(counts, sequence))
    table = spark.createDataFrame(where or [(0, 0, 0, 0, 0)], "length long, low long, high long, first long, offset long")
    ranked = ranked_within(cut, ["length"], ["doc_id", "piece", "ids_crc32", "start"], "rank")
    at = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")) & (ranked["length"] == table["length"])
    out = ranked.join(F.broadcast(table) if len(where) <= 200_000 else table, at)
    return out.select("doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")
