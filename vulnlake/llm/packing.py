"""Operator 8: sequences of a fixed length by hierarchical residual packing.

Every task packs the pieces it has just tokenised by best fit, largest first, and emits bins that are nearly full. What remains are
underfull bins. They are items of the next round: groups of a bounded number of them are packed by best fit again, and
so on, until one group is left or a round joins hardly any bins.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, by_run, runs, slices
from vulnlake.llm.bpe import encode_slices
from vulnlake.llm.slice_table import SliceTable
from vulnlake.llm.tables import cut_lineage, pick

CAPACITY = 1024
END = 2
# Free tokens up to which a bin counts as nearly full.
NEARLY_FULL = 1
# Pieces that a task packs at once in the first round, and bins that meet in one group of a later round.
LOCAL = 1 << 16
GROUP = 4096
# A round that joins a smaller share of the bins is the last one.
LEAST_GAIN = 0.01

NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "fill"]


# ---- best fit ----------------------------------------------------------------------------------
def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, fill of each bin), the largest items first, equal ones in their order.

    Bins are kept by free room, and the bits of one integer say which rooms occur; so an item finds the fullest bin
    that takes it in constant time.
    """
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    free: list[int] = []
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = there >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                there &= ~(1 << room)
        else:
            room, b = capacity, len(free)
            free.append(0)
        bins[i], offsets[i] = b, capacity - room
        room -= size
        free[b] = room
        if not rooms[room]:
            there |= 1 << room
        rooms[room].append(b)
    return bins, offsets, capacity - np.array(free, np.int64)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only a longer one is cut, and its first piece may be shorter."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


# ---- tokens ------------------------------------------------------------------------------------
@cache
def _slice_ids(path: str) -> SliceTable:
    """Ids of the tokeniser's own slices, each encoded once; one table per worker process and vocabulary."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def learn(new: list[bytes]) -> list[bytes]:
        found = tokenizer.encode_batch([x.decode() for x in new], add_special_tokens=False)
        return [np.array(x.ids, np.int32).tobytes() for x in found]

    return SliceTable(learn)


@cache
def _added(path: str) -> tuple[re.Pattern[bytes] | None, dict[bytes, int]]:
    """A pattern for the added tokens of the tokeniser file, the longest first, and their ids."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"an added token that takes its neighbours into account: {t}")
    ids = {t["content"].encode(): t["id"] for t in tokens}
    longest = sorted(ids, key=len, reverse=True)
    return re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if ids else None, ids


def token_ids(texts: list[bytes], path: str, end: int, added: bool = False) -> Iterator[np.ndarray]:
    """Ids of every text and `end`, as little-endian 32-bit numbers. `added` tokens have their ids, and texts are cut there first."""
    pattern, numbers = _added(path) if added else (None, {})
    if pattern and any(map(pattern.search, texts)):
        cut = [pattern.split(t) for t in texts]
        parts = _split_ids([x for own in cut for x in own[::2]], path)
        for own in cut:
            out = [next(parts)]
            for token in own[1::2]:
                out += [np.array([numbers[token]]), next(parts)]
            yield np.concatenate([*out, [end]]).astype("<u4")
        return
    for ids, counts in encode_slices(texts, _slice_ids(path)):
        stops = np.cumsum(counts)
        yield from np.split(np.insert(ids, stops, end).astype("<u4"), stops[:-1] + np.arange(1, len(stops)))


def _split_ids(texts: list[bytes], path: str) -> Iterator[np.ndarray]:
    for ids, counts in encode_slices(texts, _slice_ids(path)):
        yield from np.split(ids, np.cumsum(counts)[:-1])


# ---- rounds ------------------------------------------------------------------------------------
def _local_round(docs: DataFrame, path: str, capacity: int, end: int, local: int, added: bool) -> DataFrame:
    """All pieces, packed by the tasks that tokenise them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bin_base = TaskContext.get().partitionId() << 36
        ids, numbers = [], []

        def packed() -> pa.RecordBatch:
            nonlocal bin_base, ids, numbers
            table = np.array(numbers, np.int64).reshape(-1, 4)
            bins, offsets, fill = best_fit(table[:, 2], capacity)
            columns = [pa.concat_arrays(ids), *map(pa.array, table.T), pa.array(bin_base + bins), pa.array(offsets), pa.array(fill[bins])]
            bin_base += len(fill)
            ids, numbers = [], []
            return pa.RecordBatch.from_arrays(columns, names=NAMES)

        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in slices([len(t) for t in texts]):
                rows = []
                for row, own in enumerate(token_ids(texts[i:j], path, end, added)):
                    view = memoryview(own).cast("B")
                    for piece, (start, length) in enumerate(cut(len(own), capacity)):
                        numbers.append((piece, start, length, zlib.crc32(view[4 * start : 4 * (start + length)])))
                        rows.append(i + row)
                ids.append(batch.column(0).take(pa.array(rows)))
                if len(numbers) >= local:
                    yield packed()
        if numbers:
            yield packed()

    return docs.mapInArrow(run, f"doc_id {kind}, piece bigint, start bigint, length bigint, ids_crc32 bigint, bin bigint, `offset` bigint, fill bigint")


def _merge_round(open_: DataFrame, groups: int, capacity: int) -> DataFrame:
    """Underfull bins of a group packed into common bins; members keep their order and move by their bin's offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in by_run(batches, "group_", 1 << 62):
            group, bin_ = rows.column("group_").to_numpy(), rows.column("bin").to_numpy()
            offset, fill = rows.column("offset").to_numpy().copy(), rows.column("fill").to_numpy().copy()
            bin_ = bin_.copy()
            bounds = runs(group)
            for a, b in zip(bounds[:-1], bounds[1:]):
                names, first, which = np.unique(bin_[a:b], return_index=True, return_inverse=True)
                to, at, filled = best_fit(fill[a:b][first], capacity)
                leader = np.full(len(filled), -1, np.int64)
                leader[to[::-1]] = names[::-1]
                offset[a:b] += at[which]
                bin_[a:b], fill[a:b] = leader[to[which]], filled[to[which]]
            out = rows.drop_columns(["group_"])
            for name, values in (("bin", bin_), ("offset", offset), ("fill", fill)):
                out = out.set_column(out.column_names.index(name), name, pa.array(values))
            yield from out.combine_chunks().to_batches()

    grouped = open_.withColumn("group_", F.pmod(F.xxhash64("bin"), F.lit(groups)))
    grouped = grouped.repartition("group_").sortWithinPartitions("group_", "bin", "offset")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_.schema.fields)
    return grouped.mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END,
    local: int = LOCAL, group: int = GROUP, added: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids by the tokeniser file `path` and the id `end`; so a null or empty text is one token. With `added`
    the file's added tokens count, as the tokeniser has them when it is loaded; without, such strings are ordinary text. Repeated rows are documents of their own. Within a sequence offsets are gapless from 0.
    """
    own = pick(docs, doc_id, text).toDF("doc_id", "text")
    now = cut_lineage(_local_round(own, path, capacity, end, local, added), "pack-local")
    done = []
    before = None
    while True:
        done.append(now.where(F.col("fill") >= capacity - NEARLY_FULL))
        open_ = now.where(F.col("fill") < capacity - NEARLY_FULL)
        # a bin without room for the least filled one takes no other either
        bins, least = open_.agg(F.count_if(F.col("offset") == 0), F.min("fill")).first()
        if bins < 2 or before is not None and (groups == 1 or bins > before * (1 - LEAST_GAIN)):
            done.append(open_)
            break
        done.append(open_.where(F.col("fill") + least > capacity))
        open_ = open_.where(F.col("fill") + least <= capacity)
        before, groups = bins, -(-bins // group)
        now = cut_lineage(_merge_round(open_, groups, capacity), "pack-round")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
