"""Operator 6, quality rules: repetition coverage by rolling hashes in numpy.

For each whole text, hashes of its words roll over windows of several lengths; the characters
(code points) of words inside any window that the text has twice or more are what that length
covers. Lines equal to an earlier line cover theirs. A document is kept unless the base rule fails,
a coverage is over its threshold, or its words carry too many symbols.

Defined results: null or empty text, or one of white space only: all counts 0, base_failed true, kept
false. Every row gives one row (repeated rows too); doc_id may be null; other columns are left out
of the digest. A text of any length is read whole, in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, fresh, ship
from .textops import Chunk, Words, chunks, covered, distinct, mix, repeated, run_hash

#: Words of a window, and the largest part of a text's word characters that windows of that
#: length, met more than once, may cover.
COVERAGE = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
#: Largest parts of characters in repeated lines, and of symbols per word.
LINE_CHARS, LINES, SYMBOLS = 0.30, 0.50, 0.10
MIN_WORDS, REPEAT_PERCENT = 50, 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ", ".join([*(f"{c} long" for c in _COUNTS), "n_lines long", "dup_line_chars long", *(f"covered_{k} long" for k in COVERAGE)])


def _per_doc(weights: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=weights, minlength=n).astype(np.int64)


def _lines(chunk: Chunk, w: Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have a word, those of them equal to an earlier one, and the latter's characters."""
    n, raw, off = chunk.n, chunk.raw, chunk.offsets
    cut = np.flatnonzero(raw == 10)
    starts = distinct(np.concatenate([off[:-1], cut + 1]))
    starts = starts[starts < len(raw)]
    ends = np.append(starts[1:], len(raw))[: len(starts)]
    # a line ends before its \n, or where its document ends
    ends = ends - ((ends > starts) & (raw[np.maximum(ends - 1, 0)] == 10))
    words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
    starts, ends = starts[words > 0], ends[words > 0]
    doc = np.searchsorted(off, starts, "right") - 1
    key = run_hash(raw, starts, ends) ^ mix(doc.astype(np.uint64) + np.uint64(1))
    again = np.flatnonzero(repeated(key))
    _, first = np.unique(key[again], return_index=True)
    later = np.ones(len(again), bool)
    later[first] = False
    at = again[later]
    return np.bincount(doc, minlength=n), np.bincount(doc[at], minlength=n), _per_doc((chars[ends[at]] - chars[starts[at]]).astype(float), doc[at], n)


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """The counts of SCHEMA for the documents of a chunk."""
    n, raw = chunk.n, chunk.raw
    w = chunk.words()
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
    length = chars[w.ends] - chars[w.starts]
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[raw])])[chunk.offsets]
    out = {"n_words": w.counts, "word_chars": _per_doc(length.astype(float), w.doc, n), "n_symbols": np.diff(symbols)}
    salt = mix(w.doc.astype(np.uint64) + np.uint64(1))  # windows of different documents never meet
    alive = None
    for k in (3, *COVERAGE):
        hashes, at = w.windows(k)
        if alive is not None:  # a repeated window of k words holds two repeated windows of k - 1
            here = alive[at]
            hashes, at = hashes[here], at[here]
        again = at[repeated(hashes ^ salt[at])]
        inside = covered(again, k, len(w.doc))
        if k == 3:
            out["n_repeat_words"] = np.bincount(w.doc[inside], minlength=n)
        else:
            out[f"covered_{k}"] = _per_doc(length[inside].astype(float), w.doc[inside], n)
        alive = np.zeros(len(w.doc), bool)
        alive[again] = True
    out["n_lines"], out["n_dup_lines"], out["dup_line_chars"] = _lines(chunk, w, chars)
    return out


def measured(df: DataFrame) -> DataFrame:
    """``df`` (any columns; its text in ``text``) with the counts of SCHEMA in the struct ``_counts``
    (more underscores if that name is taken)."""
    ship(df.sparkSession)
    name, names = fresh(df, "_counts"), [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [measure(c) for c in chunks(b.column("text"))]
            cols = [pa.array(np.concatenate([np.asarray(p[k], np.int64) for p in parts]) if parts else np.empty(0, np.int64)) for k in names]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.StructArray.from_arrays(cols, names)], names=[*b.schema.names, name])

    fields = ", ".join(f"{x.split()[0]}: bigint" for x in SCHEMA.split(", "))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"{name} struct<{fields}>"])
    return df.mapInArrow(run, schema)


def judged(df: DataFrame, counts: str) -> DataFrame:
    """``df`` with base_failed and kept, from its struct of counts."""
    c = lambda k: F.col(f"{counts}.{k}")
    part = lambda k: c(k) / F.greatest(c("word_chars"), F.lit(1))
    failed = (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words"))
    bad = (part("dup_line_chars") > LINE_CHARS) | (c("n_dup_lines") > LINES * c("n_lines")) | (c("n_symbols") > SYMBOLS * c("n_words"))
    for k, most in COVERAGE.items():
        bad = bad | (part(f"covered_{k}") > most)
    return df.withColumns({"base_failed": failed, "kept": ~(failed | bad)})


def score(df: DataFrame) -> DataFrame:
    """Per document: doc_id, all counts, base_failed, kept."""
    out = measured(documents(df)).drop("text")
    out = judged(out, "_counts")
    return out.select("doc_id", "_counts.*", "base_failed", "kept")


def keep(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that the rules keep, with all their columns."""
    row = fresh(df, "_row")
    out = measured(df.select(F.struct(*df.columns).alias(row), F.col("text").cast("string").alias("text")).select("text", row))
    return judged(out, "_counts").filter("kept").select(f"{row}.*")
