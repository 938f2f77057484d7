"""Groups of near copies at a likeness of word shingles, for operator 9 in the pipeline.

Fingerprints of 64 bits within two bits find few pairs of likeness 0.8 (their expected distance is about 10 bits, that of unrelated texts
32), and keys of Golay codewords for such distances are hundreds per text and hardly tell texts apart. So the groups that
operator 9 forms are one of several kinds of buckets here; the others are bands of minima of the shingles. In every bucket a tree of
greatest estimated likeness proposes pairs, fewer than members; each is then verified on the whole sets of shingles. Buckets
that hold several components after that verify all other likely pairs between these in the tasks where they meet and hand on only the links that
join components, so no link between components rests on a tree or a part, and rows grow with the members of a bucket and not with its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm import golay
from vulnlake.llm.arrays import as_bytes, by_run, ragged, runs, slices
from vulnlake.llm.components import stars
from vulnlake.llm.tables import cut_lineage, pick

SHINGLE, LIKENESS = 5, 0.8
# A pair of likeness 0.8 shares no band with a probability of (1 - 0.8 ** ROWS) ** BANDS, 3e-6.
BANDS, ROWS = 32, 5
# Pairs are proposed from an estimate (the share of equal minima, here with a deviation of 0.03) this much below the likeness.
SLACK = 0.12
# Members of a bucket that are compared in one task. Of larger buckets every part of about so many also has the bucket's least member;
# where that leaves several components, any two parts meet.
BUCKET = 4096
# Up to so many members, all pairs with a high estimate are proposed and not only a tree.
SMALL = 4
# Shingles of a part's texts, about, where pairs are verified in the task in which they meet.
CELL = 1 << 21
# Pairs that a task holds at once.
PAIRS = 1 << 18
# Bytes of a text that are split into words at once.
PART = 1 << 20
BLANK = re.compile(rb"\s")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(5)
_TURN = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_SPREAD = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)


# ---- shingles and minima -----------------------------------------------------------------------
def _word_hashes(text: bytes) -> np.ndarray:
    out, at = [], 0
    while at < len(text):
        blank = BLANK.search(text, at + PART) if at + PART < len(text) else None
        end = blank.start() if blank else len(text)
        words = text[at:end].lower().split()
        out.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct runs of `size` words, in order; of the whole sequence if it is shorter. A-Z count as small letters."""
    words = _word_hashes(text)
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * _ODD + words[k : k + n]
    return np.unique((out ^ (out >> np.uint64(32))) * _ODD)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Per set its least values under BANDS * ROWS hash functions; no set is empty."""
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    sizes = [len(s) for s in sets]
    for i, j in slices(sizes, 1 << 17):
        data = np.concatenate(sets[i:j])
        starts = np.cumsum([0, *sizes[i : j - 1]])
        for k in range(BANDS * ROWS):
            out[i:j, k] = np.minimum.reduceat((data ^ _TURN[k]) * _SPREAD[k], starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(least), 0)
    own = least.reshape(len(least), BANDS, ROWS)
    for r in range(ROWS):
        keys = (keys ^ (keys >> np.uint64(31))) * _ODD + own[:, :, r]
    return keys


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """h1, h2, n (distinct shingles), keys, sketch (a byte of every minimum) of every row (h1, h2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = as_bytes(batch.column(2))
            for i, j in slices([len(t) for t in own]):
                sets = [shingle_set(t, size) for t in own[i:j]]
                at = np.flatnonzero([len(s) > 0 for s in sets])
                least = minima([sets[k] for k in at]) if len(at) else np.zeros((0, BANDS * ROWS), np.uint64)
                keys, sketch = [[] for _ in sets], [b"" for _ in sets]
                for k, own_keys, own_least in zip(at, band_keys(least).view(np.int64), (least >> np.uint64(56)).astype(np.uint8)):
                    keys[k], sketch[k] = own_keys, own_least.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["h1", "h2", "n", "keys", "sketch"],
                )

    return texts.select("h1", "h2", "text").mapInArrow(run, "h1 bigint, h2 bigint, n bigint, keys array<bigint>, sketch binary")


# ---- pairs -------------------------------------------------------------------------------------
def _estimates(sketches: np.ndarray, sizes: np.ndarray, row: int, others: np.ndarray, likeness: float) -> np.ndarray:
    """Estimated likeness of a row to the others, 0 where it cannot be enough."""
    share = (sketches[others] == sketches[row]).mean(axis=1)
    ratio = np.minimum(sizes[others], sizes[row]) / np.maximum(sizes[others], sizes[row])
    return np.where((ratio >= likeness) & (share >= likeness - SLACK), share, 0.0)


def proposed(sketches: np.ndarray, sizes: np.ndarray, likeness: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose estimated likeness may be enough: all of a small group, else the edges of a spanning forest of greatest
    estimates, which joins what any threshold on the estimates joins."""
    n = len(sketches)
    a, b = [], []
    if n <= SMALL:
        for row in range(n - 1):
            others = np.arange(row + 1, n)
            hit = others[_estimates(sketches, sizes, row, others, likeness) > 0]
            a += [row] * len(hit)
            b += hit.tolist()
        return np.array(a, np.int64), np.array(b, np.int64)
    left, at = np.arange(1, n), 0
    best, parent = np.zeros(n - 1), np.zeros(n - 1, np.int64)
    while len(left):
        own = _estimates(sketches, sizes, at, left, likeness)
        better = own > best
        best[better], parent[better] = own[better], at
        k = int(best.argmax())
        if best[k] > 0:
            a.append(int(parent[k]))
            b.append(int(left[k]))
        at = int(left[k])  # without an edge a new tree begins
        keep = np.arange(len(left)) != k
        left, best, parent = left[keep], best[keep], parent[keep]
    return np.array(a, np.int64), np.array(b, np.int64)


def _buckets(keyed: DataFrame, bucket: int) -> DataFrame:
    """key, size, parts, h1: members of the keys that several texts have; `keyed` has key and h1. Large buckets are dealt into parts."""
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    sizes = cut_lineage(sizes.select("key", "size", F.ceil(F.col("size") / bucket).cast("int").alias("parts")), "copies-buckets")
    # a key that many rows have is an ordinary skewed join
    return cut_lineage(keyed.join(sizes, "key"), "copies-members")


def _part() -> Column:
    return F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")


def _pairs(keyed: DataFrame, nodes: DataFrame, likeness: float, bucket: int) -> DataFrame:
    """(a, b), a < b: pairs that the trees of all buckets propose; `keyed` is the result of `_buckets`, `nodes` has h1, node, n, sketch.

    Keys of one text go first, so only texts that share a key meet with their sketches.
    """
    members = keyed.join(nodes.select("h1", "node", "n", "sketch"), "h1")
    own = members.withColumn("part", _part())
    firsts = members.where("parts > 1").groupBy("key", "parts").agg(F.min(F.struct("node", "n", "sketch")).alias("first"))
    firsts = firsts.select("key", "first.*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = own.select("key", "node", "n", "sketch", "part").unionByName(firsts)
    rows = rows.select(F.xxhash64("key", "part").alias("cell"), "node", "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in by_run(batches, "cell", 16 * bucket):
            table = table.combine_chunks()
            bounds = runs(table.column("cell").to_numpy())
            count, data = table.column("n").to_numpy(), _sketches(table)
            left, right = [], []
            for i, j in zip(bounds[:-1], bounds[1:]):
                a, b = proposed(data[i:j], count[i:j], likeness)
                left.append(a + i)
                right.append(b + i)
            yield _chosen(table, np.concatenate(left), np.concatenate(right))

    return _met(rows, run, nodes)


def _rest(
    keyed: DataFrame, nodes: DataFrame, joined: DataFrame, known: DataFrame, likeness: float, bucket: int,
    sets: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(a, b), a < b: all pairs with a high estimate that lie in two components and are not among the `known` ones. With `sets`, which gives
    the node and shingles of nodes, only links that join components: pairs are verified where they meet and never become rows.

    `joined` has node and root. Only buckets of several components take part, and any two parts of a large one meet in a task.
    """
    placed = nodes.select("h1", "node", "n", "sketch").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # all pairs of small buckets are known
    bare = keyed.where(F.col("size") > SMALL).join(placed.select("h1", "root", "n"), "h1")
    several = bare.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.sum("n").alias("whole")).where("least < most")
    parts = F.greatest("parts", F.ceil(F.col("whole") / CELL).cast("int")) if sets else F.col("parts")
    members = keyed.join(several.select("key", "whole"), "key").join(placed, "h1").withColumn("parts", parts).withColumn("part", _part())
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    rows = members.select("key", "node", "n", "sketch", "root", "part", other).select(
        F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("cell"), "node", "n", "sketch",
        F.xxhash64("root").alias("root"),
    )

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list, list]]:
        """Pieces of a cell's table, and the rows of likely pairs in them."""
        for table, _ in by_run(batches, "cell", 16 * bucket):
            table = table.combine_chunks()
            bounds = runs(table.column("cell").to_numpy())
            count, root, data = table.column("n").to_numpy(), table.column("root").to_numpy(), _sketches(table)
            left, right, found = [], [], 0
            for i, j in zip(bounds[:-1], bounds[1:]):
                for row in range(i, j - 1):
                    others = np.flatnonzero(root[row + 1 : j] != root[row]) + row + 1
                    others = others[_estimates(data, count, row, others, likeness) > 0]
                    left.append(np.full(len(others), row))
                    right.append(others)
                    found += len(others)
                    if found >= PAIRS:
                        yield table, left, right
                        left, right, found = [], [], 0
            if found:
                yield table, left, right

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, left, right in likely(batches):
            yield _chosen(table, np.concatenate(left), np.concatenate(right))

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, left, right in likely(batches):
            yield from table.take(pa.array(np.unique(np.concatenate(left + right)))).combine_chunks().to_batches()

    def joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in by_run(batches, "cell", 16 * bucket):
            table = table.combine_chunks()
            bounds = runs(table.column("cell").to_numpy())
            count, root, data = table.column("n").to_numpy(), table.column("root").to_numpy(), _sketches(table)
            left, right = [], []
            for i, j in zip(bounds[:-1], bounds[1:]):
                shingles = _flat(table.column("shingles").slice(i, j - i))
                a, b = forest(data[i:j], count[i:j], root[i:j], shingles, likeness)
                left.append(a + i)
                right.append(b + i)
            yield _chosen(table, np.concatenate(left), np.concatenate(right))

    if sets is None:
        return _met(rows, pairs, nodes).join(known, ["a", "b"], "left_anti")
    kind = nodes.schema["node"].dataType.simpleString()
    met = rows.repartition("cell").sortWithinPartitions("cell", "node")
    met = cut_lineage(met.mapInArrow(partners, f"cell bigint, node {kind}, n bigint, sketch binary, root bigint").distinct(), "copies-partners")
    return _met(met.join(sets(met.select("node").distinct()), "node"), joining, nodes)


def forest(
    sketches: np.ndarray, sizes: np.ndarray, root: np.ndarray, shingles: np.ndarray, likeness: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows, fewer than rows, that join what all links between their components join. `shingles` has the sets one after the other."""
    a, b, root = [], [], root.copy()
    values, of = np.unique(shingles, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    own = np.zeros(len(values), bool)
    for row in range(len(sizes) - 1):
        others = np.flatnonzero(root[row + 1 :] != root[row]) + row + 1
        others = others[_estimates(sketches, sizes, row, others, likeness) > 0]
        mine = of[starts[row] : starts[row] + sizes[row]]
        own[mine] = True
        for i, j in slices(sizes[others].tolist(), CELL):
            some = others[i:j]
            begins = np.cumsum(sizes[some]) - sizes[some]
            both = np.add.reduceat(own[of[ragged(starts[some], sizes[some])]], begins, dtype=np.int64)
            for k in some[both >= likeness * (sizes[row] + sizes[some] - both)]:
                if root[k] != root[row]:
                    a.append(row)
                    b.append(int(k))
                    root[root == root[k]] = root[row]
        own[mine] = False
    return np.array(a, np.int64), np.array(b, np.int64)


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in lists.chunks])


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), -1)


def _chosen(table: pa.Table, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    node = table.column("node").combine_chunks() if isinstance(table.column("node"), pa.ChunkedArray) else table.column("node")
    return pa.RecordBatch.from_arrays([node.take(pa.array(x)) for x in (left, right)], names=["a", "b"])


def _met(rows: DataFrame, run: Callable, nodes: DataFrame) -> DataFrame:
    """The distinct pairs that `run` finds in the cells."""
    kind = nodes.schema["node"].dataType.simpleString()
    found = rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, f"a {kind}, b {kind}").where("a <> b")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _wanted_sets(wanted: DataFrame, nodes: DataFrame, own: DataFrame, shingle: int) -> DataFrame:
    """node, shingles of the wanted nodes; `own` has the texts."""
    wanted = wanted.join(nodes.select("node", "h1", "h2", "first_id"), "node")
    # one row of every text, which more rows only have if they repeat an id or have none
    single = own.join(wanted, ["h1", "h2"]).where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    return cut_lineage(_sets(single, shingle).dropDuplicates(["node"]), "copies-sets")


def _verified(pairs: DataFrame, nodes: DataFrame, own: DataFrame, likeness: float, shingle: int) -> DataFrame:
    """The pairs whose whole sets of shingles are alike; `own` has the texts."""
    sets = _wanted_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, own, shingle)
    sides = [sets.select(F.col("node").alias(x), F.col("shingles").alias(f"of_{x}")) for x in ("a", "b")]
    both = F.size(F.array_intersect("of_a", "of_b"))
    met = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b")).alias("all"))
    return met.where(F.col("both") >= likeness * (F.col("all") - F.col("both"))).select("a", "b")


def near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", likeness: float = LIKENESS, shingle: int = SHINGLE, bucket: int = BUCKET
) -> DataFrame:
    """doc_id, component_id: one row per document, with the smallest id that links of at least `likeness` reach.

    Likeness is the Jaccard coefficient of the sets of word shingles. Null texts and texts without words are copies of each other, as are
    equal texts; repeated rows stay repeated; null ids take part but name no component that has another id. Long texts are read whole.
    No pair is linked without being verified; a pair just at the likeness can be missed if the estimate of its minima is SLACK too low.
    """
    own = pick(docs, doc_id, text).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    own = own.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    prints = golay.fingerprints(own)
    marked = cut_lineage(prints, "copies-prints")
    node = F.col("h1").cast("decimal(38,0)") * F.lit(10**18).cast("decimal(19,0)") + F.pmod("h2", F.lit(10**18)).cast("decimal(19,0)")
    first = marked.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.first("fp").alias("fp"))
    first = cut_lineage(first.withColumn("node", node.cast("decimal(38,0)")), "copies-texts")
    # texts stay where they are read; only their sketches travel
    sketched = _sketched(own, shingle).dropDuplicates(["h1", "h2"])
    nodes = cut_lineage(sketched.join(first, ["h1", "h2"]), "copies-nodes")
    roots = stars(golay.near_links(first.select("fp").distinct()), "copies-golay").select(F.col("a").alias("fp"), F.col("b").alias("root"))
    keyed = nodes.where("n > 0").join(roots, "fp", "left").withColumn("keys", F.concat("keys", F.array(F.coalesce("root", "fp"))))
    keyed = keyed.select(F.explode("keys").alias("key"), "h1")
    some = nodes.where("n > 0")
    members = _buckets(keyed, bucket)
    pairs = cut_lineage(_pairs(members, some, likeness, bucket), "copies-pairs")
    links = cut_lineage(_verified(pairs, nodes, own, likeness, shingle), "copies-verified")
    joined = cut_lineage(stars(links, "copies-trees").select(F.col("a").alias("node"), F.col("b").alias("root")), "copies-joined")
    rest = _rest(members, some, joined, pairs, likeness, bucket, lambda wanted: _wanted_sets(wanted, nodes, own, shingle))
    links = links.unionByName(cut_lineage(rest, "copies-rest"))
    none = nodes.where("n = 0")
    least = none.groupBy("n").agg(F.min("node").alias("b"))
    links = links.unionByName(none.join(least, "n").select(F.col("node").alias("a"), "b").where("a <> b"))
    joined = stars(links, "copies-links").select(F.col("a").alias("node"), F.col("b").alias("root"))
    named = first.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(named.join(smallest, "root").select("h1", "h2", "component_id"), ["h1", "h2"]).select("doc_id", "component_id")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """node, shingles of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = as_bytes(batch.column(1))
            for i, j in slices([len(t) for t in own]):
                sets = [shingle_set(t, size).view(np.int64) for t in own[i:j]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
                )

    kind = texts.schema["node"].dataType.simpleString()
    return texts.select("node", "text").mapInArrow(run, f"node {kind}, shingles array<bigint>")
