"""Operator 3, n-gram Jaccard join: multiple-global-order filtering.

Texts become sets of k-word shingles (64-bit hashes). Two sets with Jaccard similarity t or more
share a token among the first |x| - ceil(t |x|) + 1 of each, whatever global order the tokens are
put in. Three orders are used, all with rare tokens first by a count sketch over all documents, told apart by
the coarseness of the counts and a hash: candidates are met under the first, kept only if they share
a prefix token under the second and third as well, then verified on the whole sets.

Copies (equal sets: equal 128-bit signature and size) are one class and never paired. Prefix tokens that no other prefix has bound what
two sets can share at all. Within a token's list pairs are made of its
first ``ALL_PAIRS`` members and of each further member with the first ``STARS``, the most typical; after
these are verified and joined to components, every pair of a longer list that is still apart is
compared, members outside the list's largest component against all. So no link is lost, yet a
group of n near copies makes about n pairs rather than n * n. The list of a token that stands in very
many documents is dealt to sublists, whose first members are then paired with one another, so that
no list is one task's work.

Defined results: lower case is A-Z only. Fewer than k words: the whole sequence is the one shingle.
Null or empty text, or white space only: 0 shingles, linked with nothing, its own component. Null
doc_id: joined by its text like any row, never named as a component while the class has an id. Repeated rows: one result
row each. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, documents, fresh, scratch, store
from .textops import chunks, distinct, mix

#: Cells of the count sketch, in slices that are summed apart: 4 MB in all, whatever the input.
CELLS, SLICES = 1 << 20, 64
ALL_PAIRS, STARS = 4, 1
#: Documents from which on (by the sketch) a token's list is dealt to SALTS sublists.
HOT, SALTS = 100_000, 256
_SEEDS = np.array([0x51ED270B, 0x2545F491, 0x9E3779B1], np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for c in chunks(column):
        hashes, owner = c.words(lower=True).shingles(k)
        cuts = np.searchsorted(owner, np.arange(c.n + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield distinct(hashes[a:b])


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(44)).astype(np.int64) & (CELLS - 1)


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """In how many documents (about; never fewer) the tokens of each cell stand: summed slice by slice on the
    executors, so that only the sketch itself, of fixed size, reaches the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint32)
        for b in batches:
            held, size = [], 0
            for s in shingle_sets(b.column("text"), k):
                held.append(_cells(s))
                size += len(s)
                if size > CELLS:
                    total += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
        for i, part in enumerate(total.reshape(SLICES, -1)):
            at = np.flatnonzero(part).astype(np.uint16)
            if len(at):
                dense = 3 * len(at) > len(part)
                kind = np.uint8 if part.max() < 256 else np.uint32
                held = (part if dense else part[at]).astype(kind)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([b"" if dense else at.tobytes()], pa.binary()), pa.array([held.tobytes()], pa.binary()), pa.array([kind().itemsize], pa.int32())], names=["slice", "at", "n", "width"])

    def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS // SLICES, np.uint64)
        for t in tables:
            for at, n, width in zip(t.column("at"), t.column("n"), t.column("width")):
                counts = np.frombuffer(n.as_py(), np.uint8 if width.as_py() == 1 else np.uint32)
                where = at.as_py()
                total[np.frombuffer(where, np.uint16) if where else slice(None)] += counts
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], names=["slice", "n"])

    parts = docs.select("text").mapInArrow(counted, "slice int, at binary, n binary, width int").groupBy("slice").applyInArrow(add, "slice int, n binary").collect()
    out = np.zeros((SLICES, CELLS // SLICES), np.uint32)
    for r in parts:
        out[r["slice"]] = np.frombuffer(r["n"], np.uint32)
    return out.ravel()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def order_keys(tokens: np.ndarray, counts: np.ndarray, which: int) -> np.ndarray:
    """By these keys global order ``which`` sorts: by count (0), its logarithm to base 2 (1) or 4 (2),
    each with ties by a hash of its own."""
    n = counts[_cells(tokens)].astype(np.uint64)
    rank = n if not which else (np.log2(n + 1.0) / which).astype(np.uint64)
    return (np.minimum(rank, np.uint64((1 << 27) - 1)) << np.uint64(36)) | (mix(tokens ^ _SEEDS[which]) >> np.uint64(28))


def _digest() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def signed(docs: DataFrame, k: int, percent: int, counts: np.ndarray, hot: int) -> DataFrame:
    """Per document: n (set size), s1 and s2 (a 128-bit signature of the set), typical (how common
    its tokens are), its prefix under the first order, how many tokens of that aren't hot (those come first), and the key
    of the prefix's last token."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                n, s1, s2, typical, prefix, last, cool = [], [], [], [], [], [], []
                for s in shingle_sets(part.column("text"), k):
                    n.append(len(s))
                    s1.append(int(mix(s).sum(dtype=np.uint64)) if len(s) else 0)
                    s2.append(int(mix(s ^ _SEEDS[0]).sum(dtype=np.uint64)) if len(s) else 0)
                    typical.append(float(np.log2(table[_cells(s)] + 1.0).mean()) if len(s) else 0.0)
                    key = order_keys(s, table, 0)
                    first = np.argsort(key, kind="stable")[: prefix_length(len(s), percent) if len(s) else 0]
                    prefix.append(s[first])
                    last.append(int(key[first[-1]]) if len(s) else 0)
                    cool.append(int(np.count_nonzero(table[_cells(s[first])] < hot)))
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                flat = np.concatenate(prefix).view(np.int64) if prefix else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("digest"), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(typical, pa.float32()), pa.array(last, pa.int64()), pa.array(cool, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "digest", "n", "s1", "s2", "typical", "last", "cool", "prefix"],
                )

    return docs.select("doc_id", "text", _digest().alias("digest")).mapInArrow(run, "doc_id long, digest long, n long, s1 long, s2 long, typical float, last long, cool int, prefix array<long>")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by token, those of tokens that stand in more than one class, or are hot."""
    last, told = None, False  # the last posting of the batch before, and whether it was given
    for b in batches:
        if not b.num_rows:
            continue
        t = b.column("token").to_numpy()
        same = t[1:] == t[:-1]
        keep = np.zeros(len(t), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep |= b.column("salt").to_numpy() >= 0
        if last is not None and last.column("token")[0].as_py() == t[0]:
            keep[0] = True
            if not told:
                yield last
        yield b.filter(pa.array(keep))
        last, told = b.slice(b.num_rows - 1), bool(keep[-1])


def _fits(x: list, y: list, percent: int) -> np.ndarray:
    """Whether two sets (n, core, last) can be similar. Of the set whose prefix ends first in the
    order, a prefix token that the other set has is in that one's prefix too: so no more than its core is shared."""
    (n1, c1, l1), (n2, c2, l2) = x, y
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    core = np.where(l1 < l2, c1, np.where(l2 < l1, c2, np.minimum(c1, c2)))
    return (100 * small >= percent * large) & ((100 + percent) * core >= percent * (n1 + n2))


def _list_pairs(percent: int):
    """Over postings sorted by token, salt and falling typicality: kind 0 pairs (a < b), kind 1 the
    postings of lists longer than ALL_PAIRS and of sublists, kind 2 the first members of sublists.
    ``salt`` is negative where a token's list is whole."""

    def emit(rows: list, lead: list, cols: list, start: int) -> None:
        for k, (c, *about) in enumerate(lead):
            first, stop = max(0, k + 1 - start), len(cols[0]) if k < STARS else max(0, ALL_PAIRS - start)
            if first < stop:
                other = cols[0][first:stop][_fits(about, [v[first:stop] for v in cols[1:]], percent)]
                if len(other):
                    rows.append((np.minimum(other, c), np.maximum(other, c)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, lead, seen = None, [], 0  # of the list that a batch may leave open
        for b in batches:
            if not b.num_rows:
                continue
            t, salt, *cols = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6))  # token, salt; class, n, core, last
            cuts = np.flatnonzero((np.diff(t) != 0) | (np.diff(salt) != 0)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.append(cuts, len(t))
            pairs: list = []
            long: list = []
            heads: list = []
            single = (ends - starts == 1) & (salt[starts] < 0)
            single[0] &= (t[0], salt[0]) != token
            single[-1] = False  # may go on in the next batch
            for s, e in zip(starts[~single], ends[~single]):
                if (t[s], salt[s]) != token:
                    token, lead, seen = (t[s], salt[s]), [], 0
                begin = seen
                for i in range(s, min(e, s + max(0, ALL_PAIRS - len(lead)))):
                    lead.append(tuple(v[i] for v in cols))
                    if salt[s] >= 0:
                        heads.append((t[s], *lead[-1]))
                emit(pairs, lead, [v[s:e] for v in cols], begin)
                if begin + e - s > ALL_PAIRS or salt[s] >= 0:
                    if begin <= ALL_PAIRS and salt[s] < 0:
                        long += [(t[s], *x) for x in lead[:begin]]
                    long.append((t[s:e], *(v[s:e] for v in cols)))
                seen = begin + e - s
            if pairs:
                a, z = np.concatenate([x[0] for x in pairs]), np.concatenate([x[1] for x in pairs])
                keep = np.unique(np.stack([a, z], 1), axis=0)
                none = np.zeros(len(keep), np.int64)
                yield _listed(0, keep[:, 0], keep[:, 1], none, none, none)
            for kind, found in ((1, long), (2, heads)):
                if found:
                    yield _listed(kind, *(np.concatenate([np.atleast_1d(x[i]) for x in found]) for i in range(5)))

    return run


_LISTS = "kind int, a long, b long, n int, core int, last long"


def _listed(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, core: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(a), kind, np.int32))
    return pa.RecordBatch.from_arrays([kinds, pa.array(a), pa.array(b), pa.array(n, pa.int32()), pa.array(core, pa.int32()), pa.array(last)], names=[x.split()[0] for x in _LISTS.split(", ")])


def _short(tokens: np.ndarray) -> np.ndarray:
    """32 bits of each token: enough for a filter that must lose nothing."""
    return (tokens >> np.uint64(8)).astype(np.uint32).view(np.int32)


def _overlap(s: np.ndarray, t: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    both = np.concatenate([s, t])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under the other orders and whose sets are similar."""
    part = lambda x: sets.select(F.col("cls").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("second", "third", "tokens")))
    n = pairs.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            x, y = b.column("tokens_a"), b.column("tokens_b")
            for i in range(b.num_rows):
                s, t = np.frombuffer(x[i].as_py(), "<u8"), np.frombuffer(y[i].as_py(), "<u8")
                shared = _overlap(s, t)
                keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the pairs meet each set where it lies, so that only sets of pairs move, to the place of their a
    carried = part("b").join(F.broadcast(pairs) if n <= 5 * BROADCAST_ROWS else pairs, "b")
    heads = pairs.select("a").distinct()
    leading = part("a").join(F.broadcast(heads) if n <= 5 * BROADCAST_ROWS else heads, "a", "left_semi")
    met = carried.join(leading, "a").filter(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
    return met.select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(cls, label): the smallest node that edges reach, for every node with an edge. Labels are hooked to the least
    label next to them and pointers are jumped, until nothing changes. What is gathered for a label is summed before it
    is shuffled and stored before it is joined, so that adaptive execution can split a label that many nodes have."""
    spark = edges.sparkSession
    with scratch(spark) as own:
        e = store(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges")
        # labels only fall: label = least label of the node, its neighbours and its label's own label
        label = store(e.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels-0")
        for i in count(1):
            near = e.join(label.select(F.col("cls").alias("b"), "label"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("label").alias("near"))
            hook = store(label.join(near, "cls").select("cls", "label", F.least("label", "near").alias("new")), "hooks")
            # a label's own node takes the least of what the nodes under it have found
            root = store(hook.groupBy(F.col("label").alias("cls")).agg(F.min("new").alias("root")), "roots")
            step = store(hook.join(root, "cls", "left").select("cls", F.col("label").alias("old"), F.least("new", F.coalesce("root", "new")).alias("label")), "steps")
            up = step.filter("cls <> label").select(F.col("cls").alias("label"), F.col("label").alias("up"))
            jump = store(step.join(up, "label", "left").select("cls", "old", F.least("label", F.coalesce("up", "label")).alias("label")), f"labels-{i}")
            label = jump.select("cls", "label")
            if not jump.filter("label <> old").limit(1).count():
                return store(label, "components", keep=True)
            own.drop("hooks", "roots", "steps", f"labels-{i - 1}")


def classes(df: DataFrame, k: int = 5, percent: int = 80, hot: int = HOT) -> DataFrame:
    """Per row of ``df``: doc_id, n_shingles, cls (null without words) and component_id."""
    return labelled(df, k, percent, hot).drop("digest", "label")


def labelled(df: DataFrame, k: int, percent: int, hot: int = HOT) -> DataFrame:
    """``classes`` with the digest of the row's text and the label of its component, which is null without words."""
    with scratch(df.sparkSession) as own:
        docs = documents(df)
        counts = sketch(docs, k)
        key = ["s1", "s2", "n"]
        full = store(signed(docs, k, percent, counts, hot), "signed")
        made = full.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("least"), F.first("typical").alias("typical"), F.first("last").alias("last"), F.first("cool").alias("cool"), F.first("prefix").alias("prefix"))
        # a class is told apart by its whole 128-bit signature and its size, and numbered
        distinct = store(made.withColumn("cls", F.monotonically_increasing_id()), "distinct")
        rows = store(full.select("doc_id", "digest", *key).join(distinct.select(*key, "cls", "least"), key, "left"), "rows")
        own.drop("signed")
        about = distinct.select("cls", F.col("n").cast("int").alias("n"), F.size("prefix").alias("m"), "typical", "last")
        salt = F.when(F.col("pos") >= F.col("cool"), F.pmod(F.xxhash64("cls", "token"), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))
        posts = distinct.select("cls", "cool", F.posexplode("prefix").alias("pos", "token")).withColumn("salt", salt)
        ordered = posts.select("token", "salt", "cls").repartition("token", "salt").sortWithinPartitions("token", "salt")
        met = store(ordered.mapInArrow(_shared, "token long, salt int, cls long"), "shared")
        # of a set's tokens all but the prefix tokens that no other prefix has
        many = met.groupBy("cls").agg(F.count("*").cast("int").alias("many"))
        core = about.join(many, "cls").withColumn("core", F.col("n") - F.col("m") + F.col("many"))
        first = [F.col("token"), F.col("salt"), (F.col("n") - F.col("core")).asc(), F.col("typical").desc(), F.col("cls")]
        ordered = met.join(core, "cls").repartition("token", "salt").sortWithinPartitions(*first).select("token", "salt", "cls", "n", "core", "last")
        lists = store(ordered.mapInArrow(_list_pairs(percent), _LISTS), "lists")
        heads = lists.filter("kind = 2").select(F.col("a").alias("token"), F.lit(-1).alias("salt"), F.col("b").alias("cls"), "n", "core", "last")
        over = heads.repartition("token").sortWithinPartitions("token", F.col("n") - F.col("core"), "cls").mapInArrow(_list_pairs(percent), _LISTS).filter("kind = 0")
        pairs = store(lists.unionByName(over).filter("kind = 0").select("a", "b").distinct(), "pairs")
        long = lists.filter("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("cls"), "n", "core", "last")
        ids = store(distinct.select("cls", *key, "least"), "ids")
        own.drop("distinct", "shared")
        wanted = store(ids.join(_nodes(pairs), "cls"), "wanted")
        sets = _sets(docs, wanted, k, percent, counts)
        links = store(verified(pairs, sets, percent), "links")
        label = components(links)
        more = _apart(long, label, percent)
        if more is not None:
            rest = store(more.join(pairs, ["a", "b"], "left_anti"), "rest")
            if rest.limit(1).count():
                further = store(ids.join(_nodes(rest), "cls").join(wanted.select("cls"), "cls", "left_anti"), "further")
                sets = sets.union(_sets(docs, further, k, percent, counts)) if further.limit(1).count() else sets
                links = store(links.union(verified(rest, sets, percent)), "links")
                label = components(links)
        least = store(label.join(ids.select("cls", "least"), "cls").groupBy("label").agg(F.min("least").alias("component_id")), "least")
        named = store(label.join(least, "label").select("cls", "label", "component_id"), "named")
        out = rows.join(named, "cls", "left").select("doc_id", "digest", F.col("n").alias("n_shingles"), "cls", F.coalesce("label", "cls").alias("label"), F.coalesce("component_id", "least", "doc_id").alias("component_id"))
        return store(out, "classes", keep=True)


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()


def _sets(docs: DataFrame, wanted: DataFrame, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """The whole sets, and the prefixes under the second and third order, of the wanted classes."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                cols: list[list] = [[] for _ in range(6)]
                for s in shingle_sets(part.column("text"), k):
                    if len(s):
                        p = prefix_length(len(s), percent)
                        two, three = (s[np.argsort(order_keys(s, table, j), kind="stable")] for j in (1, 2))
                        for col, v in zip(cols, (int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ _SEEDS[0]).sum(dtype=np.uint64)), len(s), _short(two[:p]), _short(three[:p]), s.astype("<u8").tobytes())):
                            col.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
                arrays = [pa.array(np.array(c, np.uint64).view(np.int64), t) if i < 2 else pa.array(c, t) for i, (c, t) in enumerate(zip(cols, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names=["s1", "s2", "n", "second", "third", "tokens"])

    n = wanted.count()
    keys = wanted.select(F.col("least").alias("id")).distinct()
    some = docs.join(F.broadcast(keys) if n <= 10 * BROADCAST_ROWS else keys, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    made = some.select("text").mapInArrow(run, "s1 long, s2 long, n long, second array<int>, third array<int>, tokens binary")
    keep = wanted.select("cls", "s1", "s2", "n")  # a doc_id that repeats brings other texts along
    made = made.join(F.broadcast(keep) if n <= 5 * BROADCAST_ROWS else keep, ["s1", "s2", "n"]).select("cls", "second", "third", "tokens")
    made = store(made, "sets")
    if not made.groupBy("cls").count().filter("count > 1").limit(1).count():
        return made
    return store(made.dropDuplicates(["cls"]), "sets")  # doc_ids that repeat, with other texts


def _apart(long: DataFrame, label: DataFrame, percent: int) -> DataFrame | None:
    """Pairs of the same long list in different components, not yet compared: members outside the
    largest component against all others that the filters allow. Pairs that meet in a short list
    were compared there, so of the pairs left none shares a prefix token other than of long lists."""
    many = long.groupBy("cls").agg(F.count("*").alias("many"))
    core = F.floor((F.col("n") * percent + 99) / 100) - 1 + F.col("many")  # what isn't in the prefix, and that
    # of a set's tokens that may be shared, any slack + 1 hold a shared one: the token's number among
    # the long ones of its set says whether the pair has to be met there
    turn = F.row_number().over(Window.partitionBy("cls").orderBy("token")) - 1
    long = long.withColumn("turn", turn)
    at = store(long.join(many, "cls").join(label, "cls", "left").select("token", "cls", "n", (core - F.col("turn")).cast("int").alias("core"), "last", F.coalesce("label", "cls").alias("label")), "members")
    share = at.groupBy("token", "label").agg(F.count("*").alias("m"))
    main = share.groupBy("token").agg(F.max(F.struct("m", "label")).alias("main"), F.count("*").alias("kinds")).filter("kinds > 1").select("token", F.col("main.label").alias("main"))
    main = store(main, "split-lists")
    if not main.limit(1).count():
        return None
    split = store(at.join(main, "token").withColumn("few", F.col("label") != F.col("main")).drop("main"), "split-members")
    # The set of a pair whose prefix ends first bounds what they share by its core, and so the size of the other one: sets
    # meet only those of sizes that this allows, and a set that allows none begins no pair.
    high = F.least(F.floor(F.col("core") * (100 + percent) / percent) - F.col("n"), F.floor(F.col("n") * 100 / percent))
    low = F.ceil(F.col("n") * percent / 100)
    step = lambda size: F.floor(F.log(size.cast("double")) / F.log(F.lit(1.1))).cast("int")
    begin = split.withColumn("low", low).withColumn("high", high).filter("low <= high")
    begin = begin.select("token", F.explode(F.sequence(step(F.col("low")), step(F.col("high")))).alias("size"), *(F.col(c).alias(f"{c}1") for c in ("cls", "last", "label", "few")), "low", "high")
    other = split.withColumn("size", step(F.col("n")))
    after = (F.col("last1") < F.col("last")) | ((F.col("last1") == F.col("last")) & (F.col("cls1") < F.col("cls")))
    fits = after & (F.col("label1") != F.col("label")) & F.col("n").between(F.col("low"), F.col("high"))
    met = begin.filter("few1").join(other, ["token", "size"]).filter(fits).union(begin.filter("not few1").join(other.filter("few"), ["token", "size"]).filter(fits))
    return met.select(F.least("cls1", "cls").alias("a"), F.greatest("cls1", "cls").alias("b")).distinct()


def survivors(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``df`` without near copies: one row of each component stays, that of the smallest doc_id (none comes
    last) and, where a doc_id repeats within it, of the least digest of its text; rows without words all stay."""
    id_, text = (fresh(df, x) for x in ("_id", "_text"))
    with scratch(df.sparkSession):
        found = labelled(df, k, percent).filter("n_shingles > 0").select("doc_id", "digest", "label")
        rows = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("stays"), F.count("*").alias("n"))
        many = store(rows.filter("n > 1").drop("n"), "groups")
        members = found.join(many, "label").groupBy("doc_id", "digest").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
        stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("digest") == F.col("stays.digest"))
        members = store(members.select(F.col("doc_id").alias(id_), F.col("digest").alias(text), stays.alias("stays"), "n"), "members", keep=True)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (_digest() == F.col(text))
    small = lambda x: F.broadcast(x) if x.count() <= BROADCAST_ROWS else x
    gone = members.filter("not stays or n > 1").select(id_, text)
    kept = df.join(small(gone), same, "left_anti")
    again = members.filter("stays and n > 1").select(id_, text)  # rows equal in both that stay: one of them
    if again.limit(1).count():
        kept = kept.union(df.join(small(again), same).dropDuplicates([id_, text]).select(*(F.col(f"`{c}`") for c in df.columns)))
    return kept
