"""The corpus pipeline: documents are filtered, near copies dropped, personal data masked, sources
mixed to their target weights, and what remains is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared
folder and read again as the next one's docs. All but the last return the columns of documents. An operator removes
what it stored for itself, but a small table that its result reads; run() removes all but the last stage's rows.
SQL can't express the stages' hashes, sampling keys and token ids, so ORACLE_SQL is None and the
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import mixing, packing, pii, repetition, shingle_join
from parley.llm.common import read, scratch, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return shingle_join.survivors(docs, k=5, percent=80)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the source weights takes them."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("mask_pii", mask_pii),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, over the documents of ``sf_dir``."""
    docs, (last, _) = read(spark, sf_dir), STAGES[-1]
    with scratch(spark):
        for name, stage in STAGES:
            docs = store(stage(spark, docs, sf_dir), name, keep=name == last)
        return docs
