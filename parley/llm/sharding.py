"""Operator 2, sharding: k-d tree partitioning.

Every document is a point in metadata dimensions (language, source, length, a hash of its text). A
node that is to hold k shards is split along its widest dimension, at the point where the bytes
of k // 2 shards are reached, the weighted median for even k; all nodes of a level at once. The
point is found by histograms: tasks add up the bytes of up to BINS bins for each node, and the bin
that holds the point is cut into bins anew until a single key is left. Only these sums, bounded
by shards times BINS, meet in one place.

A point's key along a dimension is its coordinate, then a hash of doc_id and text: so a great many equal
coordinates, such as a group of copies, are split too, and sizes come out near equal.

Equal texts are groups, and one of them may hold more than a shard's bytes: the law of bytes comes first, so a
group is cut where a median falls into it, and its members go by their hash to the shards on both sides.

Defined results: null text: no bytes, crc32 0. Null lang, source or doc_id: values of their own. Rows equal in
doc_id and text share a shard. Fewer documents than shards: some shards are empty. No rows: no rows.
Extra columns are left out. ``grown_shard`` is null under the law of bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, ranked_within, scratch, store

SHARDS, OVERHEAD, BINS = 40, 16, 1024
DIMENSIONS = ("d_lang", "d_source", "d_size", "d_text")
_LOW = 1 << 31  # keys are coordinate * 2**31 + hash, coordinates below 2**31


@dataclass
class Node:
    """A node of the tree: it holds ``shards`` shards from ``first`` on; split once it has a cut."""

    first: int
    shards: int
    dimension: int = -1
    cut: int = 0  # keys up to it go left
    left: Node | None = None
    right: Node | None = None

    def leaf_of(self, keys: list[Column]) -> Column:
        if self.left is None:
            return F.lit(self.first)
        return F.when(keys[self.dimension] <= F.lit(self.cut), self.left.leaf_of(keys)).otherwise(self.right.leaf_of(keys))


def _code(c: Column) -> Column:
    return F.pmod(F.xxhash64(c.cast("string"), F.lit(5)), F.lit(_LOW))


def points(df: DataFrame, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, a coordinate for each of DIMENSIONS and ``low``, the hash that orders
    equal coordinates."""
    docs = documents(df, "lang", "source")
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    crc = F.crc32(raw)
    size = (F.octet_length(raw) + overhead).cast("long")
    return docs.select(
        "doc_id", size.alias("size"), crc.alias("text_crc32"), _code(F.col("lang")).alias("d_lang"), _code(F.col("source")).alias("d_source"),
        F.least(size, F.lit(_LOW - 1)).alias("d_size"), F.pmod(crc, F.lit(_LOW)).alias("d_text"), F.pmod(F.xxhash64("doc_id", crc, size, F.lit(3)), F.lit(_LOW)).alias("low"),
    )


def _keys() -> list[Column]:
    return [F.col(d) * _LOW + F.col("low") for d in DIMENSIONS]


def split_level(at: DataFrame, root: Node, nodes: list[Node]) -> None:
    """Give each node of ``nodes`` its cut and children."""
    keys = _keys()
    tagged = at.withColumn("node", root.leaf_of(keys)).filter(F.col("node").isin([n.first for n in nodes]))
    spread = tagged.groupBy("node").agg(F.sum("size").alias("bytes"), *(f(d).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))), F.min("low").alias("min_low"), F.max("low").alias("max_low"))
    found = {r["node"]: r for r in spread.collect()}  # one row for each node
    todo: dict[int, list] = {}  # node -> low key, high key, bytes below, bytes sought
    for n in nodes:
        n.left, n.right = Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2)
        if (r := found.get(n.first)) is None:
            n.dimension = 0
            continue
        width = [r[f"max_{d}"] - r[f"min_{d}"] for d in DIMENSIONS]
        scaled = [w / 2**31 if d != "d_size" else w / max(1, r[f"max_{d}"]) for w, d in zip(width, DIMENSIONS)]
        n.dimension = max(range(len(DIMENSIONS)), key=lambda j: (scaled[j], j))
        d = DIMENSIONS[n.dimension]
        todo[n.first] = [r[f"min_{d}"] * _LOW, r[f"max_{d}"] * _LOW + _LOW - 1, 0, r["bytes"] * (n.shards // 2) / n.shards]
    by = {n.first: n for n in nodes}
    while todo:
        about = F.create_map(*(x for first, (a, z, below, goal) in todo.items() for x in (F.lit(first), F.struct(F.lit(by[first].dimension + 1).alias("d"), F.lit(a).alias("a"), F.lit(z).alias("z"), F.lit((z - a) // BINS + 1).alias("step"), F.lit(float(goal - below)).alias("goal")))))
        of = tagged.select("node", "size", F.element_at(about, F.col("node")).alias("p"), F.array(*keys).alias("keys")).filter(F.col("p").isNotNull())
        keyed = of.select("node", "size", "p", F.element_at("keys", F.col("p.d")).alias("key")).filter((F.col("key") >= F.col("p.a")) & (F.col("key") <= F.col("p.z")))
        sums = keyed.groupBy("node", F.floor((F.col("key") - F.col("p.a")) / F.col("p.step")).cast("long").alias("bin")).agg(F.sum("size").alias("bytes"), F.max("key").alias("last"), F.min("key").alias("first"), F.first("p.goal").alias("goal"))
        upto = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        reach = sums.withColumn("upto", F.sum("bytes").over(upto)).withColumn("before", F.lag("last").over(Window.partitionBy("node").orderBy("bin"))).filter(F.col("upto") >= F.col("goal"))
        edge = reach.groupBy("node").agg(F.min_by(F.struct("first", "last", "bytes", "upto", "before"), "bin").alias("e"))
        again: dict[int, list] = {}
        for r in edge.collect():  # one row for each node
            a, z, below, goal = todo[r["node"]]
            e, node = r["e"], by[r["node"]]
            if e["first"] == e["last"]:  # one key: it goes to the side that comes nearer
                over, under = below + e["upto"] - goal, goal - (below + e["upto"] - e["bytes"])
                node.cut = e["last"] if over <= under else (e["before"] if e["before"] is not None else e["first"] - 1)
            else:
                again[r["node"]] = [e["first"], e["last"], below + e["upto"] - e["bytes"], goal]
        todo = again


def tree(at: DataFrame, shards: int) -> Node:
    root = Node(0, shards)
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        split_level(at, root, level)
        level = [x for n in level for x in (n.left, n.right)]
    return root


def shard(df: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    with scratch(df.sparkSession):
        at = store(points(df, overhead), "points")
        root = tree(at, shards)
        placed = at.select("doc_id", "size", "text_crc32", root.leaf_of(_keys()).alias("shard"))
        return store(_slotted(placed), "shards", keep=True)


def _slotted(placed: DataFrame) -> DataFrame:
    ranked = ranked_within(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def shards_for(df: DataFrame, target_bytes: int, overhead: int = OVERHEAD) -> int:
    """How many shards of about ``target_bytes`` the documents fill."""
    total = points(df, overhead).agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // target_bytes))
