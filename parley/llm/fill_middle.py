"""Operator 13, fill-in-middle: documents cut at two line ends and written prefix, suffix, middle or suffix, prefix, middle.

Each Arrow batch of a task is registered in a DuckDB connection of that task, and one SQL statement makes
its rows: lines by regexp_extract_all, the cuts by hash of the document's id, its parts by
list_slice and array_to_string. No row passes through Python. A second statement rebuilds the texts from
outputs and forms alone. Batches are cut into slices of about ``SLICE`` bytes of text, so the memory of a task
doesn't follow the length of the texts in a batch; a longer text is a slice of its own.

Defined results: null or empty text: no lines, plain, output empty. A text that holds a mark (``<P>``, ``<S>``, ``<M>``):
plain, output the text itself. A text of one line: parts may be empty, their marks stand all the same.
Null doc_id: hashed like an empty one. Repeated rows: one result each, equal. Empty table: no rows. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents
from .textops import text_buffers

#: Percent of the documents that are cut at all, percent of these that begin with their suffix, and the hashes' seed.
RATE, SUFFIX_FIRST, SEED = 100, 50, 7
SLICE = 4 << 20

_FORM = "doc_id long, n long, form string, prefix_chars long, middle_chars long"

_CUT = r"""
with hashed as (select doc_id, coalesce(text, '') as whole, sha256('{seed}:' || coalesce(doc_id::varchar, '')) as h from batch),
drawn as (
  select doc_id, whole, regexp_extract_all(whole, '[^\n]*\n|[^\n]+') as units,
    ('0x' || substr(h, 1, 8))::ubigint as h1, ('0x' || substr(h, 9, 8))::ubigint as h2, ('0x' || substr(h, 17, 8))::ubigint as h3, ('0x' || substr(h, 25, 8))::ubigint as h4 from hashed),
placed as (
  select doc_id, whole, units, len(units) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1))::bigint as a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1))::bigint as b,
    case when whole = '' or contains(whole, '<P>') or contains(whole, '<S>') or contains(whole, '<M>') or h3 % 100 >= {rate} then 'plain' when h4 % 100 < {suffix_first} then 'spm' else 'psm' end as form from drawn),
parted as (
  select *, array_to_string(list_slice(units, 1, a), '') as prefix, array_to_string(list_slice(units, a + 1, b), '') as middle, array_to_string(list_slice(units, b + 1, n), '') as suffix from placed)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars, case when form <> 'plain' then length(middle) end::bigint as middle_chars,
  case form when 'plain' then whole when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output from parted
"""

#: No part holds a mark, and two parts with a mark between them make no other, so the marks cut an output into its parts.
_BACK = """
with cut as (select *, string_split_regex(coalesce(output, ''), case when form = 'plain' then '$^' else '<[PSM]>' end) as part from batch),
back as (select *, case form when 'psm' then part[2] || part[4] || part[3] when 'spm' then part[3] || part[4] || part[2] else coalesce(output, '') end as restored from cut)
"""
_RESTORE = _BACK + "select doc_id, form, restored from back"
_DIGEST = _BACK + "select doc_id, n, form, prefix_chars, middle_chars, sha256(coalesce(output, '')) as output_sha256, sha256(restored) as restored_sha256 from back"


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    _, off = text_buffers(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = i + 1
        while j < n and off[j + 1] - off[i] <= SLICE:
            j += 1
        yield batch.slice(i, j - i)
        i = j


def _by_sql(sql: str, text: str, schema: str) -> Callable[[DataFrame], DataFrame]:
    """The rows of ``sql`` over each batch of a table, which the statement calls ``batch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        try:
            for batch in batches:
                for some in _slices(batch, text):
                    con.register("batch", pa.Table.from_batches([some]))
                    yield from con.sql(sql).to_arrow_table().to_batches()
                    con.unregister("batch")
        finally:
            con.close()

    return lambda df: df.mapInArrow(run, schema)


def transform(df: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n (its lines), form (plain, psm, spm), prefix_chars, middle_chars, output."""
    sql = _CUT.format(rate=int(rate), suffix_first=int(suffix_first), seed=int(seed))
    return _by_sql(sql, "text", f"{_FORM}, output string")(documents(df))


def restore(made: DataFrame) -> DataFrame:
    """doc_id, form and the ``restored`` text of rows of ``transform``, from output and form alone."""
    return _by_sql(_RESTORE, "output", "doc_id long, form string, restored string")(made.select("doc_id", "form", "output"))


def digest(made: DataFrame) -> DataFrame:
    """Rows of ``transform`` with SHA-256 of the output and of the text rebuilt from it in place of the output."""
    return _by_sql(_DIGEST, "output", f"{_FORM}, output_sha256 string, restored_sha256 string")(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
