"""Operator 9: SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into segments of 22, 21 and 21 bits. Two fingerprints within two differing bits
have, for one of the segment pairs (0, 1), (1, 2), (2, 0), no error in the first segment and at most one in the
second. A segment with one error still shares a codeword: the binary Golay code of length 23 is perfect, every
word lies within 3 bits of exactly one codeword, so its neighbour lies within 4 bits of that codeword. All
codewords within 4 bits of a segment (1 or 6 of them) are its keys. Fingerprints that meet under the same (first
segment, key of the second) are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, by_run, ragged, runs, slices
from vulnlake.llm.components import stars
from vulnlake.llm.tables import cut_lineage, pick

RADIUS = 2
SHINGLE = 3
SEED = 42
# Fingerprints under one key that a task compares in memory; the rest goes to the exact join in `_ball_links`.
GROUP_LIMIT = 100_000
# Groups up to this size are compared pair by pair, larger ones by a search from link to link.
PAIRWISE = 16

# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0xC75
# Widths of the segments from the highest bit, and the pairs (exact segment, segment with keys).
SEGMENTS = ((42, 22), (21, 21), (0, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))


# ---- fingerprints ------------------------------------------------------------------------------
def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every run of three words; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: -SHINGLE + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist())], np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Per document: the bits set in over half of its hashes; zero without hashes."""
    counts = np.zeros((len(hashes), 64), np.int64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        whole = np.concatenate([hashes[i] for i in filled]).astype(">u8")
        starts = np.concatenate([[0], np.cumsum(sizes[filled])])
        for first, last in slices(sizes[filled].tolist(), 1 << 18):
            part = whole[starts[first] : starts[last]]
            at = starts[first:last] - starts[first]
            if last - first == 1:  # possibly one very long document
                for k in range(0, len(part), 1 << 18):
                    bits = np.unpackbits(part[k : k + (1 << 18)].view(np.uint8).reshape(-1, 8), axis=1)
                    counts[filled[first]] += bits.sum(axis=0, dtype=np.int64)
            else:
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
                counts[filled[first:last]] = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > sizes[:, None], axis=1).view(">i8").ravel().astype(np.int64)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with `fp`, its signed 64-bit fingerprint, in place of the text."""
    kept = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
            out = [majority([shingle_hashes(x) for x in texts[i:j]]) for i, j in slices([len(x) for x in texts])]
            fp = pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept] + [fp], names=[*kept, "fp"]
            )

    return docs.mapInArrow(run, f"{schema}{', ' if kept else ''}fp bigint")


# ---- keys --------------------------------------------------------------------------------------
def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders modulo the generator, 11 bits."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@cache
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of at most 4 bits (6 slots) and how many there are."""
    from itertools import combinations

    words = np.array(
        [sum(1 << b for b in bits) for weight in range(5) for bits in combinations(range(23), weight)], np.int64
    )
    of = _syndromes(words)
    order = np.argsort(of, kind="stable")
    words, of = words[order], of[order]
    count = np.bincount(of, minlength=2048)
    table = np.zeros((2048, 6), np.int64)
    table[of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)] = words
    return table, count


def codewords(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within 4 bits, one after the other, and their number per segment."""
    table, count = _patterns()
    of = _syndromes(segments)
    n = count[of]
    slot = ragged(np.zeros(len(n), np.int64), n)
    near = np.repeat(segments, n) ^ table[np.repeat(of, n), slot]
    return near >> 11, n


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys under which each fingerprint is found, 18 at most."""
    wide = fps.astype(np.uint64)
    segments = [((wide >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for k, (exact, coded) in enumerate(PAIRS):
        index, n = codewords(segments[coded])
        rows.append(np.repeat(np.arange(len(fps)), n))
        keys.append((k << 34) | np.repeat(segments[exact], n) << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


# ---- links -------------------------------------------------------------------------------------
def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= RADIUS


@cache
def _ball() -> np.ndarray:
    """All differences of at most RADIUS bits."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    two = (one[:, None] | one[None, :])[np.triu_indices(64, 1)]
    return np.concatenate([one, two])


def spanning_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly what all links within the group would join; one less than members at most.

    `fps` is sorted and distinct. A search goes from link to link: with few members left by comparing, else
    by looking up every value within the radius. So the work grows with the members, not with their pairs.
    """
    left = fps.copy()
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            if len(left) > 8192:
                want = _ball() ^ at
                pos = np.minimum(np.searchsorted(left, want), len(left) - 1)
                hit = np.zeros(len(left), bool)
                hit[pos[left[pos] == want]] = True
            else:
                hit = _near(left, at)
            if hit.any():
                found = left[hit]
                a.append(np.full(len(found), at))
                b.append(found)
                queue.extend(found)
                left = left[~hit]
    none = np.zeros(0, np.uint64)
    return np.concatenate(a) if a else none, np.concatenate(b) if b else none


def _links_of(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within every run of equal keys; rows are sorted by key and fingerprint."""
    bounds = runs(keys)
    sizes = np.diff(bounds)
    a, b = [], []
    run = np.repeat(np.arange(len(sizes)), np.where(sizes <= PAIRWISE, sizes, 0))
    small = np.repeat(sizes <= PAIRWISE, sizes)
    own = fps[small]
    for step in range(1, PAIRWISE):
        if len(own) <= step:
            break
        hit = (run[step:] == run[:-step]) & _near(own[step:], own[:-step])
        a.append(own[:-step][hit])
        b.append(own[step:][hit])
    for i in np.flatnonzero(sizes > PAIRWISE):
        x, y = spanning_links(np.unique(fps[bounds[i] : bounds[i + 1]]))
        a.append(x)
        b.append(y)
    none = np.zeros(0, np.uint64)
    return np.concatenate(a) if a else none, np.concatenate(b) if b else none


def _ball_links(members: DataFrame) -> DataFrame:
    """Exact links among fingerprints of oversized keys: every value within the radius is looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                fps = batch.column(0).slice(k, 256).to_numpy().astype(np.uint64)
                other = (fps[:, None] ^ _ball()[None, :]).ravel().astype(np.int64)
                own = np.repeat(fps, len(_ball())).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(other)], names=["a", "b"])

    return members.mapInArrow(run, "a bigint, b bigint").where("a < b").join(
        members.select(F.col("fp").alias("b")), "b", "left_semi"
    ).select("a", "b")


def near_links(distinct_fps: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within two bits. `distinct_fps` has the column fp."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            row, key = fuzzy_keys(fps)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], names=["key", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, whole in by_run(batches, "key", group_limit):
            fps = rows.column("fp").to_numpy().astype(np.uint64)
            if whole:
                a, b = _links_of(rows.column("key").to_numpy(), fps)
            else:
                a = b = fps  # a link to oneself marks a member of an oversized key
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], names=["a", "b"]
                )

    keyed = distinct_fps.select("fp").mapInArrow(spread, "key bigint, fp bigint")
    met = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = cut_lineage(met.mapInArrow(link, "a bigint, b bigint"), "golay-met")
    crowded = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    return found.where("a <> b").unionByName(_ball_links(crowded))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, fp, component_id: one row per document, with the smallest doc_id that links reach.

    Equal fingerprints are one node; a null text has the fingerprint zero, like a text without words. Null ids take part,
    but never name a component that has another id. Repeated rows stay repeated.
    """
    own = pick(docs, doc_id, text).toDF("doc_id", "text")
    marked = cut_lineage(fingerprints(own), "golay-prints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = stars(near_links(nodes.select("fp"), group_limit), "golay").select(F.col("a").alias("fp"), F.col("b").alias("root"))
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(nodes.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", groups: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """The documents without their near-duplicates: of every component one row stays, one with the smallest id. `groups` names the
    components of a table of doc_id and text.

    A row is known by its id and a 128-bit hash of its text, so rows that share an id, or have none, go only where their texts are near
    copies. Rows without an id stay where no row of the component has one. The texts are shuffled once: the join and the choice share a key.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns))).alias("row"))
    own, words = F.col(f"row.v{columns.index(doc_id)}"), F.col(f"row.v{columns.index(text)}")
    name = F.struct(own.isNull().alias("none"), own.alias("id"), F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2"))
    found = groups(packed.select(name.alias("doc_id"), words.alias("text")))
    kept = found.where("doc_id <=> component_id").select(_key(F.col("doc_id")).alias("key")).distinct()
    rows = packed.withColumn("key", _key(name)).join(kept, "key", "left_semi")
    # rows under one key are copies
    first = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    rows = rows.withColumn("first", first).where("first = 1")
    return rows.select(*(F.col(f"row.v{i}").alias(c) for i, c in enumerate(columns)))


def _key(name: Column) -> Column:
    """A text that equals only itself, also for a null id."""
    return F.concat_ws("\x00", name["h1"].cast("string"), name["h2"].cast("string"), name["id"].cast("string"))
