"""Helpers for work on whole texts inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that a task turns into numpy arrays at once; a longer document is a batch of its own.
BATCH_BYTES = 1 << 20


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows with at most `limit` in total, one row at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def runs(keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal values, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def by_run(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by `key`, regrouped so that no key is cut.

    Yields (rows, True) with whole keys only. A key with more than `limit` rows comes as pieces marked
    False, so that it is never held in memory as a whole.
    """
    held: pa.Table | None = None
    oversize = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
            held = None
        keys = table.column(key).to_numpy()
        if oversize is not None:
            more = int(np.searchsorted(keys, oversize, side="right"))
            if more:
                yield table.slice(0, more), False
                table, keys = table.slice(more), keys[more:]
            if not len(keys):
                continue
            oversize = None
        bounds = runs(keys)
        large = np.flatnonzero(np.diff(bounds) > limit)
        done = 0
        for i in large:
            if bounds[i] > done:
                yield table.slice(done, bounds[i] - done), True
            yield table.slice(bounds[i], bounds[i + 1] - bounds[i]), False
            done = int(bounds[i + 1])
            if done == len(keys):
                oversize = keys[-1]
        last = int(bounds[-2])
        if last >= done:
            if last > done:
                yield table.slice(done, last - done), True
            held = table.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield held, True
