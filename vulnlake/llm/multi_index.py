"""Operator 4: nearest neighbours by multi-index hashing of learned binary codes.

Codes are signs after a learned rotation. They are split into substrings, and every substring is an index of its own: postings by
value. Two codes within R bits agree in at least one substring up to floor(R / m) bits (pigeonhole; the last substrings even
up to one bit less), so probing all values that near retrieves every code within R. What lies within R is scored with the floats. R is set
from the exact neighbours of a few sample queries; queries that find too few within it are searched without a limit.

The work is dealt into cells: a block of queries, one substring index, and a part of the postings, all of bounded
size. So hot values or clusters never meet in one task, and partial results per cell are the best k of each query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm.arrays import by_run, runs
from vulnlake.llm.tables import cut_lineage, pick

BITS = 64
SUBSTRINGS = 8
WIDTH = BITS // SUBSTRINGS
NEIGHBOURS = 20
# Rows that the rotation is learned from, and queries that set the radius: the first by a hash of their id.
SAMPLE = 4096
CALIBRATION = 64
# Share of the sample queries' true neighbours that the radius must cover.
COVER = 0.97
ROTATIONS = 30
# Candidates of a query in a cell that are scored again beyond those asked for.
SPARE = 8
# Largest block of queries and largest part of the postings that meet in a cell. Every cell gives each of its queries at most
# k + 1 rows, so larger parts mean fewer rows to merge.
QUERY_BLOCK = 4096
PART_ROWS = 1 << 16


# ---- codes -------------------------------------------------------------------------------------
@dataclass
class Coder:
    """`longest`: the largest norm. Vectors get one more component that makes all norms equal, so that the largest inner product
    is the smallest angle; queries get a zero there."""

    longest: float
    projection: np.ndarray

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        bits = np.column_stack([vectors, extra]) @ self.projection > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def learn(sample: np.ndarray, longest: float, seed: int = 7) -> Coder:
    """Iterative quantisation: principal axes, then the rotation that brings the sample nearest to the corners of a cube.

    With fewer dimensions than bits the axes repeat under other rotations.
    """
    extra = np.sqrt(np.maximum(longest**2 - (sample**2).sum(axis=1), 0))
    data = np.column_stack([sample, extra])
    _, _, axes = np.linalg.svd(data, full_matrices=False)
    rng, parts, left = np.random.default_rng(seed), [], BITS
    while left:
        own = axes[: min(left, len(axes))].T
        flat = data @ own
        turn = np.linalg.qr(rng.normal(size=(own.shape[1], own.shape[1])))[0]
        for _ in range(ROTATIONS):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        parts.append(own @ turn)
        left -= own.shape[1]
    return Coder(longest, np.column_stack(parts))


def radii(radius: int) -> list[int]:
    """Bits that each substring may differ in, -1 for none: every code within `radius` is retrieved."""
    least, more = divmod(radius, SUBSTRINGS)
    return [least if k <= more else least - 1 for k in range(SUBSTRINGS)]


def substrings(codes: np.ndarray) -> np.ndarray:
    """One byte per substring."""
    return codes.view(np.uint8).reshape(-1, SUBSTRINGS)


# ---- tables ------------------------------------------------------------------------------------
def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v: the rows that take part, with doubles. Not null, not empty, not zero, all components finite; rows without an id
    and repeated rows do not count."""
    own = pick(rows, vec_id, embedding).toDF("vec_id", "v").where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    own = own.withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return own.where((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """v, ids: every distinct vector once with its k + 1 smallest ids in order; a neighbour list can use no others.

    Ranks are cut before the shuffle, so a vector that many rows share does not pile up.
    """
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ranked = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _coded(vectors: DataFrame, coder: Coder, query: bool) -> DataFrame:
    """node, code and the vector's bytes."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = _matrix(batch.column(1))
                raw = pa.array([x.tobytes() for x in np.ascontiguousarray(data)], pa.binary())
                codes = shared.value.codes(data, query)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64)), raw], names=["node", "code", "raw"])

    return vectors.select("node", "v").mapInArrow(run, "node bigint, code bigint, raw binary")


# ---- search ------------------------------------------------------------------------------------
class Best:
    """The k best candidates of every query so far, by score and then by node."""

    def __init__(self, queries: int, k: int):
        self.k, self.n, self.least = k, queries, np.full(queries, -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, query: np.ndarray, node: np.ndarray, score: np.ndarray) -> None:
        self.held.append((query, node, score))
        self.size += len(query)
        if self.size > 40 * self.n * self.k:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, node, score = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((node, -score, query))
        query, node, score = query[order], node[order], score[order]
        bounds = runs(query)
        rank = np.arange(len(query)) - np.repeat(bounds[:-1], np.diff(bounds))
        keep = rank < self.k
        query, node, score = query[keep], node[keep], score[keep]
        last = np.flatnonzero(rank[keep] == self.k - 1)
        self.least[query[last]] = score[last]
        self.held, self.size = [(query, node, score)], len(query)
        return query, node, score


def _cell(index: int, allowed: int, earlier: list[int], radius: int, k: int, q, p) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of each query of a block among the postings of one part that substring `index` retrieves.

    q and p are (node, code, vectors); a pair that an earlier substring retrieves too is left to that one.
    """
    (q_node, q_code, q_vec), (p_node, p_code, p_vec) = q, p
    q_sub, p_sub = substrings(q_code), substrings(p_code)
    order = np.argsort(p_sub[:, index], kind="stable")
    bounds = np.searchsorted(p_sub[order, index], np.arange((1 << WIDTH) + 1))
    values = np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint8)[:, None] ^ q_sub[:, index][None, :])
    # products of matrices rank the candidates; a few more than k are kept and scored again row by row, so that
    # a score does not depend on what else is in the cell
    best = Best(len(q_node), k + SPARE)
    for value in range(1 << WIDTH):
        own = order[bounds[value] : bounds[value + 1]]
        asking = np.flatnonzero(values[value] <= allowed)
        if not len(own) or not len(asking):
            continue
        for at in range(0, len(own), 256):
            part = own[at : at + 256]
            scores = q_vec[asking] @ p_vec[part].T
            row, col = np.nonzero(scores >= best.least[asking][:, None])
            score = scores[row, col]
            row, col = asking[row], part[col]
            near = np.bitwise_count(q_code[row] ^ p_code[col]) <= radius
            for other in range(index):
                near &= np.bitwise_count(q_sub[row, other] ^ p_sub[col, other]).astype(np.int64) > earlier[other]
            best.add(row[near], col[near], score[near])
        if best.size > 4 * best.n * best.k:
            best.shrink()
    query, node, _ = best.shrink()
    again = Best(len(q_node), k)
    again.add(query, p_node[node], (q_vec[query] * p_vec[node]).sum(axis=1))
    query, node, score = again.shrink()
    return q_node[query], node, score


def _search(queries: DataFrame, postings: DataFrame, radius: int, k: int, n_queries: int, n_postings: int) -> DataFrame:
    """query, node, score: per query node the best k of all postings within the radius."""
    blocks, parts = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_postings // PART_ROWS))
    allowed = radii(radius)
    used = [i for i in range(SUBSTRINGS) if allowed[i] >= 0]
    cells = F.explode(F.array(*(F.lit(i) for i in used)))
    spread = [
        queries.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("index", cells).withColumn("asks", F.lit(True)),
        postings.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("index", cells).withColumn("asks", F.lit(False)),
    ]
    rows = spread[0].unionByName(spread[1]).withColumn("cell", (F.col("block").cast("long") * parts + F.col("part")) * SUBSTRINGS + F.col("index"))
    rows = rows.select("cell", "index", "asks", "node", "code", "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in by_run(batches, "cell", 1 << 62):
            bounds = runs(table.column("cell").to_numpy())
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = table.slice(a, b - a).combine_chunks()
                asks = own.column("asks").to_numpy()
                raw = own.column("raw").to_pylist()
                vectors = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
                node, code = own.column("node").to_numpy(), own.column("code").to_numpy().view(np.uint64)
                q, p = ((node[m], np.ascontiguousarray(code[m]), vectors[m]) for m in (asks, ~asks))
                if len(q[0]) and len(p[0]):
                    index = own.column("index")[0].as_py()
                    query, found, score = _cell(index, allowed[index], allowed, radius, k, q, p)
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(found), pa.array(score)], names=["query", "node", "score"])

    dealt = rows.repartition("cell").sortWithinPartitions("cell")
    found = dealt.mapInArrow(run, "query bigint, node bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def calibrate(queries: DataFrame, postings: DataFrame, coder: Coder, k: int) -> int:
    """The radius that covers COVER of the true neighbours of the first CALIBRATION queries, found against all rows."""
    sample = queries.orderBy(F.xxhash64("node")).limit(CALIBRATION).select("code", "raw").collect()
    if not sample:
        return 0
    codes = np.array([r["code"] for r in sample]).view(np.uint64)
    data = np.stack([np.frombuffer(bytes(r["raw"])) for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.stack([np.frombuffer(x) for x in batch.column(1).to_pylist()])
            scores = data @ own.T
            n = min(k, batch.num_rows)
            top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
            query = np.repeat(np.arange(len(data)), n)
            bits = np.bitwise_count(codes[query] ^ batch.column(0).to_numpy().view(np.uint64)[top.ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(scores[query, top.ravel()]), pa.array(bits.astype(np.int64))], names=["query", "score", "bits"]
            )

    found = postings.select("code", "raw").mapInArrow(run, "query bigint, score double, bits bigint")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "bits"))
    bits = [r["bits"] for r in found.withColumn("rank", rank).where(F.col("rank") <= k).collect()]
    return int(np.quantile(bits, COVER, method="higher"))


def nearest(
    rows: DataFrame, asked, vec_id: str = "vec_id", embedding: str = "embedding", k: int = NEIGHBOURS, radius: int | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that `asked(id column)` selects its k nearest other rows by inner product.

    Rows that take no part (see `usable`) are neither queries nor neighbours. Vectors of different lengths have no inner product: every
    length is searched by itself, one after the other. An id with several vectors is a query for each. Ties go to the smaller id.
    Rows with the query's own id are never its neighbours. `radius` replaces the calibrated one. A query with fewer than k rows in
    reach gets them all.
    """
    own = cut_lineage(usable(rows, vec_id, embedding), "ann-rows")
    lengths = [r["n"] for r in own.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_of_length(own.where(F.size("v") == n) if len(lengths) > 1 else own, asked, k, radius) for n in lengths]
    return reduce(DataFrame.unionByName, found)


def _of_length(own: DataFrame, asked, k: int, radius: int | None) -> DataFrame:
    """`nearest` among rows (vec_id, v) whose vectors have one length."""
    whole = cut_lineage(distinct_vectors(own, k).withColumn("node", F.col("ids")[0]), "ann-distinct")
    stats = whole.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    sample = whole.orderBy(F.xxhash64("node")).limit(SAMPLE).select("v").collect()
    coder = learn(np.array([r["v"] for r in sample]), float(stats[1]) * (1 + 1e-12))
    postings = cut_lineage(_coded(whole, coder, False), "ann-postings")
    asking = own.where(asked(F.col("vec_id"))).select("vec_id", "v")
    nodes = whole.select("node", "v", "ids")
    members = cut_lineage(asking.distinct().join(nodes.select("v", "node"), "v").select("vec_id", "node"), "ann-members")
    vectors = nodes.join(members.select("node").distinct(), "node", "left_semi")
    queries = cut_lineage(_coded(vectors, coder, True), "ann-queries")
    n_queries = queries.count()
    if radius is None:
        radius = calibrate(queries, postings, coder, k)
    ids = whole.select("node", "ids")
    # one more neighbour than asked for: a node may hold only the query itself
    found = cut_lineage(_search(queries, postings, radius, k + 1, n_queries, stats[0]), "ann-found")
    enough = found.join(ids, "node").groupBy("query").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > k)
    short = queries.join(enough, queries["node"] == enough["query"], "left_anti")
    short = cut_lineage(short, "ann-short")
    n_short = short.count() if radius < BITS else 0
    if n_short:
        rest = cut_lineage(_search(short, postings, BITS, k + 1, n_short, stats[0]), "ann-rest")
        found = found.join(short.select(F.col("node").alias("query")), "query", "left_anti").unionByName(rest)
    listed = found.join(ids, "node").select("query", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    lists = listed.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    of = members.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(lists, "query")
    others = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return of.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )
