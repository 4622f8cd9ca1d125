"""What the operators of this subpackage share: the shared folder, cut lineage, ranks, size-checked joins."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a small side is broadcast; its width is a few numbers or short strings.
BROADCAST_ROWS = 200_000
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_own_dir: str | None = None
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: their Python may not find it.
    Batches to Python become BATCH_ROWS rows where the session leaves that at Spark's default, since texts
    are long and both sides hold a batch whole."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if (app := spark.sparkContext.applicationId) not in _shipped:
        _shipped.add(app)
        root = Path(__file__).resolve().parents[1]
        if root.is_dir():  # else it was shipped here itself
            out = Path(tempfile.mkdtemp(prefix="parley-ship-")) / "parley-package.zip"
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for f in sorted(root.rglob("*.py")):
                    z.write(f, f.relative_to(root.parent))
            spark.sparkContext.addPyFile(str(out))
            atexit.register(shutil.rmtree, out.parent, ignore_errors=True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset a temporary
    folder that goes when Python ends, with a local master only: on a cluster others wouldn't see it."""
    global _own_dir
    if where := spark.conf.get("spark.checkpoint.dir", None):
        return where.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="parley-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


class Scratch:
    """The tables that one call of an operator has stored for itself."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def drop(self, *names: str) -> None:
        """Remove the tables of these names, or all: nothing that is still to be computed may read them."""
        for path in [p for p in self.paths if not names or p.rpartition("/")[2].rpartition("-")[0] in names]:
            self.paths.remove(path)
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open_scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What store() writes inside belongs to this block and is removed at its end, however it ends. A table stored
    with ``keep`` belongs to the block around it; without one it stays until the shared folder is cleaned."""
    own = Scratch(spark)
    token = _open.set((*_open.get(), own))
    try:
        yield own
    finally:
        _open.reset(token)
        own.drop()


def store(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, and what was
    computed outlives the executors that computed it. ``scratch`` says how long it stays."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/parley/{name}-{uuid.uuid4().hex}"
    owners = _open.get()[: -1 if keep else None]
    if owners:
        owners[-1].paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(df: DataFrame, *also: str) -> DataFrame:
    """doc_id, text and ``also`` of a documents table: extra columns are left out, so that their
    names can't clash with what an operator adds."""
    ship(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(c) for c in also))


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def joined(big: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """Join with a small side that is broadcast if its counted rows are few, else left to a
    shuffle join, in which adaptive execution splits hot keys."""
    return big.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def row_hash(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


def ranked_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 .. within each group, gapless, in no order that matters.

    A group may hold most rows, so none is one task's work: its rows are dealt by a hash of
    ``order`` to about the square root of its count in buckets, a window numbers each bucket, and
    the buckets' running totals (square roots of the counts, not rows) give each its first number.
    Equal rows get numbers next to each other, in any order: results are the same on a rerun.
    """
    n, bucket, first = fresh(df, "_n"), fresh(df, "_bucket"), fresh(df, "_first")
    deal = F.xxhash64(*order, F.lit(11))
    sizes = df.groupBy(*group).agg(F.ceil(F.sqrt(F.count("*"))).cast("long").alias(n))
    keys = [F.col(c) for c in group]
    dealt = joined(df, sizes, group, sizes.count()).withColumn(bucket, F.pmod(deal, F.col(n))).drop(n)
    dealt = store(dealt, "dealt")
    per = dealt.groupBy(*group, bucket).agg(F.count("*").alias(n))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(*group, bucket, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    inside = Window.partitionBy(*keys, F.col(bucket)).orderBy(*order)
    numbered = dealt.withColumn(n, F.row_number().over(inside) - 1)
    return numbered.join(base, [*group, bucket]).withColumn(name, (F.col(n) + F.col(first)).cast("long")).drop(n, bucket, first)


def range_ranks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 .. in the given global order, from sorted ranges that are
    numbered by themselves; only one count for each range meets in one place."""
    part, n = fresh(df, "_part"), fresh(df, "_n")
    ranged = store(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    per = ranged.groupBy(part).agg(F.count("*").alias(n))
    base = per.select(part, F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(n))
    inside = Window.partitionBy(part).orderBy(*order)
    return ranged.join(F.broadcast(base), part).withColumn(name, (F.row_number().over(inside) - 1 + F.col(n)).cast("long")).drop(part, n)
