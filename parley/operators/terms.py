"""Terms in texts: which of many terms stand in which texts, and where, by one automaton that runs over each text once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.automaton import Automaton, automata, scan
from ..shipping import ship
from .search import small

#: Characters of all terms up to which they are collected to build the automaton, which goes to the tasks; more meet by a join.
MOST_CHARS = 2_000_000


def collected(terms: DataFrame, term: str) -> list[str] | None:
    """The distinct terms, in order; None if they have more than MOST_CHARS characters."""
    distinct = terms.select(F.col(term).alias("term")).filter("term <> ''").distinct()
    if (distinct.agg(F.sum(F.length("term"))).first()[0] or 0) > MOST_CHARS:
        return None
    return sorted(r[0] for r in distinct.collect())


def _letters(ranges: str) -> np.ndarray:
    """Code points of a character class given as pairs, such as ``a-z0-9``, as an array of lower and upper ends."""
    return np.array([[ord(ranges[i]), ord(ranges[i + 2])] for i in range(0, len(ranges), 3)], np.uint32)


def _inside(points: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    return ((points[:, None] >= ranges[:, 0]) & (points[:, None] <= ranges[:, 1])).any(1)


def occurrences(df: DataFrame, text: str, terms: list[str], alone: str = "", places: bool = False, after: int = 0, also: str | None = None) -> DataFrame:
    """The other columns of ``df`` and ``_terms``: the distinct terms that stand in ``text``, in the order of their first place; rows without one
    are left out. ``alone`` is a character class, such as ``a-z0-9``: before a term none of it may stand. With
    ``places`` the text is kept, and ``_terms`` has a struct (term, start from 0) for each place, in order; with ``after`` also ``rest``, so many characters
    behind it. A null text has no terms. Rows in which the boolean column ``also`` is true come once more, with null for their terms."""
    ship(df.sparkSession)
    made, ranges, keep = automata(terms), _letters(alone), [f for f in df.schema if places or f.name != text]
    kind = f"struct<term: string, start: int{', rest: string' if after else ''}>" if places else "string"
    sizes = np.array([len(t) for t in terms], np.int64)
    words = pa.array(terms, pa.string())

    def rows(batch: pa.RecordBatch, automata_: list[Automaton]) -> Iterator[pa.RecordBatch]:
        for first, found in scan(automata_, batch.column(text)):
            ok = ~_inside(found.before, ranges) if len(ranges) else np.ones(len(found.row), bool)
            row, start, term = found.row[ok], found.start[ok], found.term[ok]
            if not places and len(row):  # the first place of each term in each row
                _, at = np.unique(row * len(terms) + term, return_index=True)
                at.sort()
                row, start, term = row[at], start[at], term[at]
            some, count = np.unique(row, return_counts=True)
            if not len(some):
                continue
            values = words.take(pa.array(term))
            if places:
                cols = {"term": values, "start": pa.array(start.astype(np.int32))}
                if after:
                    said = dict(zip(some.tolist(), batch.column(text).take(pa.array(some + first)).to_pylist()))
                    cols["rest"] = pa.array([said[r][e : e + after] for r, e in zip(row.tolist(), (start + sizes[term]).tolist())], pa.string())
                values = pa.StructArray.from_arrays(list(cols.values()), list(cols))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), values)
            picked = batch.take(pa.array(some + first))
            yield pa.RecordBatch.from_arrays([*(picked.column(f.name) for f in keep), lists], names=[*(f.name for f in keep), "_terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows(batch, made)
            if also and len(extra := pa.Table.from_batches([batch]).filter(pa.compute.field(also)).combine_chunks()):
                none = pa.nulls(len(extra), pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), *([("rest", pa.string())] if after else [])]) if places else pa.string()))
                yield pa.RecordBatch.from_arrays([*(extra.column(f.name).combine_chunks() for f in keep), none], names=[*(f.name for f in keep), "_terms"])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"_terms array<{kind}>"]))


def phrases(texts: DataFrame, key: str, text: Column, wanted: DataFrame, id_: str, phrase: Column) -> DataFrame:
    """P17 for many phrases: (key, id_) where the tokens of ``phrase`` stand in ``text`` as neighbours; both have one space between two
    tokens. With one at both ends as well, a phrase of whole tokens is a term. A blank or null phrase stands nowhere."""
    flat = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    asked = wanted.select(id_, F.when(phrase != "", flat(phrase)).alias("_phrase")).filter("_phrase is not null")
    terms = collected(asked, "_phrase")
    if terms is None:
        raise ValueError(f"phrases of more than {MOST_CHARS} characters: ask for them in parts")
    hit = occurrences(texts.select(key, flat(text).alias("_flat")), "_flat", terms)
    return hit.select(key, F.explode("_terms").alias("_phrase")).join(small(asked), "_phrase").select(key, id_)
