"""Operator 5: removal of repeated byte strings with suffix arrays sorted in two stages.

Every window of WINDOW bytes belongs to one anchor: the smallest hash among its GRAM-byte strings, the leftmost
of equals. Equal windows have equal anchors at equal places, so windows are only compared with those of the same
anchor hash, and each window in one group. The windows of one anchor in one place form a context: a
stretch of text that is shipped once per distinct content, and only where an anchor has different contexts.
Contexts that occur twice are repeated as a whole; the rest is decided by the suffix array of a group's contexts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, by_run, ragged, runs, slices
from vulnlake.llm.tables import cut_lineage

WINDOW = 400
GRAM = 64
# Bytes that are hashed at once; the place of an anchor takes the 20 low bits of its rank.
CHUNK = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
# Contexts of one anchor whose suffixes a task sorts in memory; beyond it windows are compared by 128-bit hashes.
GROUP_LIMIT = 4096
SORT_BYTES = 1 << 18
# Never part of UTF-8.
SEPARATOR = 0xFF

# An odd multiplier for rolling hashes and one for mixing.
ROLL = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9


# ---- anchors -----------------------------------------------------------------------------------
@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = 1 << 20
    up, down = np.full(n, ROLL, np.uint64), np.full(n, pow(ROLL, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the `gram` bytes from every place on."""
    up, down = _powers()
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[gram:] - total[:-gram]) * down[: len(data) - gram + 1]
    value ^= value >> np.uint64(32)
    value *= np.uint64(MIX)
    value ^= value >> np.uint64(29)
    return value


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, gram: int):
    """(first window, windows, anchor hash) of every context in the pieces [start, end) of `data`."""
    count = np.maximum(ends - starts - window + 1, 0)
    none = np.zeros(0, np.int64)
    if not count.sum():
        return none, none, none
    hashes = gram_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least((hashes & ~PLACE) | places, window - gram + 1)
    at = ragged(starts, count)
    place = (least[at] & PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), hashes[place[first]].view(np.int64)


def _contexts(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc_id, mark, lo, n, anchor, c1, c2: n windows from byte `lo` on, and the hash of all they cover."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(2))
            pieces = [
                (row, at) for row, text in enumerate(texts) if len(text) >= window
                for at in range(0, len(text) - window + 1, CHUNK - window + 1)
            ]
            sizes = [min(CHUNK, len(texts[row]) - at) for row, at in pieces]
            for i, j in slices(sizes, CHUNK):
                part = [texts[row][at : at + size] for (row, at), size in zip(pieces[i:j], sizes[i:j])]
                joined = b"".join(part)
                ends = np.cumsum([len(x) for x in part])
                starts = np.concatenate([[0], ends[:-1]])
                lo, n, anchor = anchors(np.frombuffer(joined, np.uint8), starts, ends, window, gram)
                digest = xxhash.xxh3_128_digest
                content = b"".join([digest(joined[a : a + k]) for a, k in zip(lo.tolist(), (n + window - 1).tolist())])
                both = np.frombuffer(content, np.int64).reshape(-1, 2)
                of = np.searchsorted(starts, lo, side="right") - 1
                rows = np.array([row for row, _ in pieces[i:j]], np.int64)[of]
                offset = np.array([at for _, at in pieces[i:j]], np.int64)[of]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(lo - starts[of] + offset), pa.array(n),
                     pa.array(anchor), pa.array(both[:, 0]), pa.array(both[:, 1])],
                    names=["doc_id", "mark", "lo", "n", "anchor", "c1", "c2"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, mark bigint, lo bigint, n bigint, anchor bigint, c1 bigint, c2 bigint")


# ---- suffix arrays -----------------------------------------------------------------------------
def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first `depth` bytes; equal beginnings stay together in any order.

    First stage: only suffixes smaller than their successors are sorted directly. Second stage: the buckets of first
    bytes are scanned in ascending order, and every suffix found puts its predecessor, if that one is larger than
    its successor, at the next free place at the front of its bucket.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    bounds = runs(data)
    following = np.append(data[bounds[1:-1]].astype(np.int64), -1)
    smaller = np.repeat(following > data[bounds[:-1]], np.diff(bounds))
    raw = data.tobytes()
    # one bucket of first two bytes after the other, so that the keys of one bucket only are in memory
    direct = np.flatnonzero(smaller)
    pair = data[direct].astype(np.int64) << 8 | data[direct + 1]
    direct = direct[np.argsort(pair, kind="stable")]
    cut = runs(np.sort(pair))
    buckets = [direct[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])]
    for bucket in buckets:
        bucket.sort(key=lambda i: raw[i : i + depth])
    own = np.array([i for bucket in buckets for i in bucket], np.int64)
    first = data[own] if len(own) else np.zeros(0, np.uint8)
    edges = np.searchsorted(first, np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not smaller[n - 1]:
        front[data[n - 1]].append(np.array([n - 1]))
    out = []
    for c in np.unique(data).tolist():
        wave = np.concatenate(front[c]) if front[c] else np.zeros(0, np.int64)
        scanned = [wave]
        while len(wave):  # larger suffixes of the same bucket come from one another
            wave = wave[wave > 0] - 1
            wave = wave[(data[wave] == c) & ~smaller[wave]]
            scanned.append(wave)
        scanned.append(own[edges[c] : edges[c + 1]])
        bucket = np.concatenate(scanned)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(data[before] > c) & ~smaller[before]]
        if len(before):
            to = data[before]
            order = np.argsort(to, kind="stable")
            before, to = before[order], to[order]
            cut = runs(to)
            for s, e in zip(cut[:-1], cut[1:]):
                front[to[s]].append(before[s:e])
    return np.concatenate(out)


def repeated_starts(parts: list[bytes], window: int) -> np.ndarray:
    """For all windows of all parts, one after the other: does the same string start anywhere else in them?"""
    joined = bytes([SEPARATOR]).join(parts) + bytes([SEPARATOR])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(p) for p in parts])
    begins = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
    counts = np.maximum(sizes - window + 1, 0)
    starts = ragged(begins, counts)
    index = np.full(len(data), -1, np.int64)
    index[starts] = np.arange(len(starts))
    order = suffix_order(data, window)
    order = order[index[order] >= 0]
    # adjacent common prefixes, eight bytes at a time, only while they go on
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words |= padded[k : k + len(data)] << np.uint64(8 * k)
    steps = [*range(0, window - 7, 8)] + ([window - 8] if window % 8 else [])
    alive = np.arange(len(order) - 1) if len(order) else np.zeros(0, np.int64)
    for k in steps:
        alive = alive[words[order[alive] + k] == words[order[alive + 1] + k]]
    found = np.zeros(len(starts), bool)
    found[index[order[alive]]] = True
    found[index[order[alive + 1]]] = True
    return found


def _spans(found: np.ndarray, counts: np.ndarray) -> tuple[list[list[int]], list[list[int]]]:
    """Per part: first and last of every run of found windows."""
    firsts, lasts, at = [], [], 0
    for n in counts.tolist():
        own = np.concatenate([[False], found[at : at + n], [False]]).astype(np.int8)
        step = np.diff(own)
        firsts.append(np.flatnonzero(step == 1).tolist())
        lasts.append((np.flatnonzero(step == -1) - 1).tolist())
        at += n
    return firsts, lasts


def _sorted_groups(contexts: DataFrame, window: int, group_limit: int) -> DataFrame:
    """anchor, c1, c2, t0, t1: runs of repeated windows. No anchor has more than `group_limit` contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "c1", "c2", "t0", "t1"]
        for rows, _ in by_run(batches, "anchor", group_limit):
            keys = [rows.column(c).combine_chunks() for c in names[:3]]
            texts = rows.column("text").to_pylist()
            bounds = runs(rows.column("anchor").to_numpy())
            sizes = [sum(map(len, texts[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
            for i, j in slices(sizes, SORT_BYTES):
                a, b = int(bounds[i]), int(bounds[j])
                counts = np.array([len(t) - window + 1 for t in texts[a:b]])
                t0, t1 = _spans(repeated_starts(texts[a:b], window), counts)
                yield pa.RecordBatch.from_arrays(
                    [k.slice(a, b - a) for k in keys] + [pa.array(t0, pa.list_(pa.int64())), pa.array(t1, pa.list_(pa.int64()))],
                    names=names,
                )

    schema = "anchor bigint, c1 bigint, c2 bigint, t0 array<bigint>, t1 array<bigint>"
    grouped = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return cut_lineage(grouped.mapInArrow(run, schema), "suffix-sorted")


def _hashed_groups(contexts: DataFrame, window: int) -> DataFrame:
    """The same for the contexts of oversized anchors, a row per window: linear, and no group meets in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(3).to_pylist()):
                n = len(text) - window + 1
                both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(text[t : t + window]) for t in range(n)]), np.int64)
                keys = [batch.column(k).take(pa.array(np.full(n, row))) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(np.arange(n)), pa.array(both[0::2]), pa.array(both[1::2])],
                    names=["anchor", "c1", "c2", "t", "h1", "h2"],
                )

    windows = contexts.select("anchor", "c1", "c2", "text").mapInArrow(
        run, "anchor bigint, c1 bigint, c2 bigint, t bigint, h1 bigint, h2 bigint"
    )
    windows = cut_lineage(windows, "suffix-windows")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1").select("h1", "h2")
    return windows.join(twice, ["h1", "h2"]).groupBy("anchor", "c1", "c2").agg(F.sort_array(F.collect_list("t")).alias("t0")).withColumn("t1", F.col("t0"))


def _texts(docs: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """anchor, c1, c2, hot, text: every distinct context once, cut out of the row named by its `at`."""
    key = ["anchor", "c1", "c2"]
    wanted = distinct.groupBy(F.col("at.doc_id").alias("w_doc"), F.col("at.mark").alias("w_mark")).agg(
        F.collect_list(F.struct("anchor", "c1", "c2", "at.lo", "at.n", "hot")).alias("cuts")
    )
    # a repeated row has the same cuts once more; one of them is enough
    sources = docs.select("doc_id", "mark", "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("mark") == F.col("w_mark"))
    ).select("text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cuts in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                out += [(x["anchor"], x["c1"], x["c2"], x["hot"], text[x["lo"] : x["lo"] + x["n"] + window - 1]) for x in cuts]
            columns = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*key, "hot", "text"])

    return sources.mapInArrow(cut, "anchor bigint, c1 bigint, c2 bigint, hot boolean, text binary").dropDuplicates(key)


# ---- spans of whole documents ------------------------------------------------------------------
def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, mark, spans: byte ranges [s, e), unordered and overlapping, of every document that has any.

    `docs` has doc_id, mark and text; doc_id and mark (a hash of the text) name a row. A repeated row repeats all its windows.
    """
    key = ["anchor", "c1", "c2"]
    members = cut_lineage(_contexts(docs.select("doc_id", "mark", "text"), window, gram), "suffix-contexts")
    met = members.groupBy("anchor").agg(F.count("*").alias("times"), F.min("c1").alias("x"), F.max("c1").alias("y"))
    # written, so that both sides of the join are plain exchanges and a hot anchor can be split
    met = cut_lineage(met.where("times > 1").select("anchor", (F.col("x") != F.col("y")).alias("mixed")), "suffix-anchors")
    members = cut_lineage(members.join(met, "anchor"), "suffix-met")

    mixed = members.where("mixed").groupBy(*key).agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "mark", "lo", "n")).alias("at")
    )
    mixed = cut_lineage(mixed, "suffix-distinct")
    # anchors with too many contexts for one task never meet in one
    crowded = mixed.groupBy("anchor").agg(F.count("*").alias("contexts")).where(F.col("contexts") > group_limit)
    crowded = cut_lineage(crowded.select("anchor"), "suffix-crowded")
    if crowded.isEmpty():
        runs_ = _sorted_groups(_texts(docs, mixed.withColumn("hot", F.lit(False)), window), window, group_limit)
    else:
        flagged = mixed.join(crowded.withColumn("hot", F.lit(True)), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        # stored, so that the whole texts travel once for both kinds
        contexts = cut_lineage(_texts(docs, flagged, window), "suffix-texts")
        runs_ = _sorted_groups(contexts.where("not hot"), window, group_limit).unionByName(_hashed_groups(contexts.where("hot"), window))
    runs_ = mixed.select(*key, "times").join(runs_, key, "left").select(
        *key,
        F.when(F.col("times") > 1, F.lit(True)).alias("whole"),
        F.arrays_zip("t0", "t1").alias("parts"),
    )
    # written, so that the join with the members can split a hot context
    runs_ = cut_lineage(runs_, "suffix-runs")
    whole = F.array(F.struct(F.col("lo").alias("s"), (F.col("lo") + F.col("n") + (window - 1)).alias("e")))
    parts = F.transform(
        "parts", lambda x: F.struct((F.col("lo") + x["t0"]).alias("s"), (F.col("lo") + x["t1"] + window).alias("e"))
    )
    spans = members.where("not mixed").select("doc_id", "mark", whole.alias("spans")).unionByName(
        members.where("mixed").join(runs_, key).select(
            "doc_id", "mark", F.when(F.col("whole"), whole).otherwise(parts).alias("spans")
        )
    )
    return spans.where(F.size("spans") > 0).groupBy("doc_id", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching ones."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for s, e in spans:
        out.append(text[at:s])
        at = e
    out.append(text[at:])
    return b"".join(out)


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def long_enough(text: bytes, spans: list[tuple[int, int]], least_words: int) -> list[tuple[int, int]]:
    """The spans with at least so many words, cut ones included."""
    if not least_words:
        return spans
    return [(s, e) for s, e in spans if sum(1 for _ in WORD.finditer(text, s, e)) >= least_words]


def whole_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans shrunk to code points that they cover as a whole."""
    out = []
    for s, e in spans:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, group_limit: int = GROUP_LIMIT,
    least_words: int = 0, into: str = "repeats",
) -> DataFrame:
    """All columns of `docs` and, under the name `into`, a struct: n_bytes, n_removed, n_spans, kept_sha256, text.

    Every byte under a string of `window` bytes that also starts anywhere else in the table is removed; with `least_words` only
    if the maximal run of such bytes has so many words. The struct's `text` is the
    rest as text: there a code point stays that is only partly covered; null stays null. The counts and the hash are
    exact to the byte, with null as empty. Repeated rows repeat each other's strings. A text shorter than the window loses nothing, however
    often it occurs; an empty table gives an empty one. Columns of `docs` can have any names but `into`.
    """
    columns = docs.columns
    marked = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns))).alias("row"),
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"),
    )
    found = repeated_spans(marked.select("doc_id", "mark", "text"), window, gram, group_limit)
    found = found.toDF("s_doc", "s_mark", "spans")
    joined = marked.select("row", "doc_id", "mark").join(
        found, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("mark") == F.col("s_mark")), "left"
    ).select("row", F.col(f"row.v{columns.index(text)}").alias("text"), "spans")
    result = pa.struct(
        [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            valid = batch.column(1).is_valid().to_pylist()
            for own, there, spans in zip(as_bytes(batch.column(1)), valid, batch.column(2).to_pylist()):
                spans = long_enough(own, merge_spans(spans), least_words)
                out.append({
                    "n_bytes": len(own), "n_removed": sum(e - s for s, e in spans), "n_spans": len(spans),
                    "kept_sha256": hashlib.sha256(without(own, spans)).hexdigest(),
                    "text": without(own, whole_points(own, spans)) if there else None,
                })
                if there:
                    out[-1]["text"] = out[-1]["text"].decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, result)], names=["row", "repeats"])

    row = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns))).alias("row")).schema["row"].dataType
    done = joined.mapInArrow(
        run,
        f"row {row.simpleString()}, repeats struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,text:string>",
    )
    return done.select(*(F.col(f"row.v{i}").alias(c) for i, c in enumerate(columns)), F.col("repeats").alias(into))
