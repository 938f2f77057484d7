"""Operator 6: byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points are mapped to classes; every class acts on the states of a small automaton. The functions that strings of
classes induce on the states form a finite monoid, so they have small numbers and one table for composition. An
associative scan over the numbers gives the state before every character, and with it the token boundaries, without a
regular expression. The slices between boundaries are merged by rank once each and then found in a cache.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, ragged, slices
from vulnlake.llm.slice_table import SliceTable

# ---- classes -----------------------------------------------------------------------------------
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, SHORT, DOUBLE, CUT = range(9)
# States: what the last character was, as far as it matters for the next one.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_BLANK, QUOTED, HALF = range(8)

# Fixed value: the white space of the pattern that lies outside the separator categories.
CONTROL_BLANKS = (9, 10, 11, 12, 13, 0x85)
# Endings after an apostrophe; of one letter, and pairs.
SINGLE_ENDINGS = "stmd"
DOUBLE_ENDINGS = ("re", "ve", "ll")
# Characters scanned at once, and the length of the scan's blocks.
SCAN = 1 << 19
BLOCK = 64
# Slices over so many bytes are merged one by one, with a heap.
LONG_SLICE = 64
# Fixed value: an odd multiplier for hashing.
SPREAD = 0x9E3779B97F4A7C15


@cache
def class_table() -> np.ndarray:
    """The class of every code point: letters L*, numbers N*, white space, the rest."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
        elif kind == "Z":
            table[point] = BLANK
    table[list(CONTROL_BLANKS)] = BLANK
    table[ord(" ")] = SPACE
    table[ord("'")] = QUOTE
    return table


def classes(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Classes of the code points. Letters that end a contraction differ only where they follow an apostrophe."""
    out = class_table()[points]
    out[cuts] = CUT
    quotes = np.flatnonzero(out[:-1] == QUOTE)
    first = points[quotes + 1]
    for c in SINGLE_ENDINGS:
        out[quotes[first == ord(c)] + 1] = SHORT
    quotes = quotes[quotes + 2 < len(points)]
    for a, b in DOUBLE_ENDINGS:
        out[quotes[(points[quotes + 1] == ord(a)) & (points[quotes + 2] == ord(b))] + 1] = DOUBLE
    return out


def _step(state: int, kind: int) -> int:
    """The state after one more character."""
    if kind == CUT:
        return FRESH
    if kind == SPACE:
        return AFTER_SPACE
    if kind == BLANK:
        return AFTER_BLANK
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == OTHER:
        return IN_OTHERS
    if kind == QUOTE:
        return IN_OTHERS if state in (IN_OTHERS, AFTER_SPACE, QUOTED) else QUOTED
    if state == HALF:
        return FRESH
    if state == QUOTED and kind in (SHORT, DOUBLE):
        return FRESH if kind == SHORT else HALF
    return IN_LETTERS


def _begins(state: int, kind: int) -> bool:
    """Does a character of this class start a token after this state? White space is settled by its neighbours."""
    if kind in (SPACE, BLANK):
        return state not in (AFTER_SPACE, AFTER_BLANK)
    if state == AFTER_SPACE:
        return False
    if kind == NUMBER:
        return state != IN_NUMBERS
    if kind in (OTHER, QUOTE):
        return state not in (IN_OTHERS, QUOTED)
    if state == QUOTED:
        return kind not in (SHORT, DOUBLE)
    return state not in (IN_LETTERS, HALF)


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the functions per class, their composition, where they lead from FRESH, and the starts after them.

    There are at most 16 functions, so that a pair of numbers is one byte.
    """
    basic = [tuple(_step(s, k) for s in range(8)) for k in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys(basic))}
    queue = list(known)
    for f in queue:
        for g in basic:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    compose, begins = np.zeros((16, 16), np.uint8), np.zeros((16, 16), bool)
    for f, i in known.items():
        for g, j in known.items():
            compose[i, j] = known[tuple(g[s] for s in f)]
        begins[i, :9] = [_begins(f[FRESH], k) for k in range(9)]
    leads = np.array([f[FRESH] for f in known], np.uint8)
    return np.array([known[f] for f in basic], np.uint8), compose.ravel(), leads, begins.ravel()


def _scan(numbers: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Composition of all functions up to and with each place: an associative scan by blocks."""
    n = len(numbers)
    if n <= BLOCK:
        out = numbers.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1] << 4 | out[i]]
        return out
    rows = -(-n // BLOCK)
    grid = np.zeros(rows * BLOCK, np.uint8)
    grid[:n] = numbers
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    for i in range(1, BLOCK):
        grid[i] = compose[grid[i - 1] << 4 | grid[i]]
    whole = _scan(grid[-1].copy(), compose)
    grid[:, 1:] = compose[(whole[None, :-1] << 4) | grid[:, 1:]]
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def token_starts(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where tokens start in concatenated texts. `cuts` marks the one separating character after every text."""
    kinds = classes(points, cuts)
    basic, compose, _, starts = _monoid()
    before = np.empty(len(points), np.uint8)
    before[0] = basic[CUT]
    before[1:] = _scan(basic[kinds], compose)[:-1]
    begins = starts[before << 4 | kinds]
    # the last of several blanks leaves the run if something follows it
    blank = kinds <= BLANK
    begins[1:-1] |= blank[1:-1] & blank[:-2] & ~blank[2:] & (kinds[2:] != CUT)
    begins[cuts] = False
    return np.flatnonzero(begins)


def piece_bounds(texts: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """(number of texts, their joined bytes, first and last byte of every slice, slices of each text).

    Texts follow each other with a separating byte. A long text is scanned in parts that end where a token starts.
    """
    for i, j in slices([len(t) for t in texts], SCAN):
        if j == i + 1 and len(texts[i]) > 2 * SCAN:
            starts = _long_starts(texts[i])
            yield 1, texts[i], starts, np.append(starts[1:], len(texts[i])), np.array([len(starts)])
            continue
        joined = b"\0".join(texts[i:j]) + b"\0"
        raw = np.frombuffer(joined, np.uint8)
        points = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        if len(points) == len(raw):
            starts = token_starts(points, ends - 1)
        else:
            place = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of every code point
            starts = place[token_starts(points, np.searchsorted(place, ends - 1))]
        bounds = np.searchsorted(starts, ends)
        stops = np.append(starts[1:], 0)
        filled = np.flatnonzero(np.diff(bounds, prepend=0))
        stops[bounds[filled] - 1] = ends[filled] - 1
        yield j - i, joined, starts, stops, np.diff(bounds, prepend=0)


def _long_starts(text: bytes) -> np.ndarray:
    whole = text.decode()
    out, at, base, width = [], 0, 0, SCAN
    while at < len(whole):
        part = whole[at : at + width]
        raw = np.frombuffer(part.encode(), np.uint8)
        points = np.frombuffer((part + "\0").encode("utf-32-le"), np.uint32)
        own = token_starts(points, np.array([len(part)]))
        place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        if at + width < len(whole):  # starts near the end may change with what follows
            own = own[own < len(part) - 4]
            if len(own) < 2:
                width *= 2
                continue
            out.append(base + place[own[:-1]])
            base += int(place[own[-1]])
            at += int(own[-1])
        else:
            out.append(base + place[own])
            at = len(whole)
        width = SCAN
    return np.concatenate(out)


def encode_slices(texts: list[bytes], cache: SliceTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids of some texts, number of ids of each): every slice has the ids that the cache knows or learns for it."""
    for _, joined, starts, stops, counts in piece_bounds(texts):
        ids, sizes = cache.ids(joined, starts, stops)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        yield ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


# ---- merging -----------------------------------------------------------------------------------
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: base64 and id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank, the leftmost of equals, is joined until none is left."""
    n = len(raw)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    waiting = [(ranks[raw[i : i + 2]], i, i + 2) for i in range(n - 1) if raw[i : i + 2] in ranks]
    heapq.heapify(waiting)
    alive = [True] * n
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        j = following[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], alive[j] = stop, False
        following[i] = following[j]
        if following[i] < n:
            before[following[i]] = i
            last = end[following[i]]
            if raw[i:last] in ranks:
                heapq.heappush(waiting, (ranks[raw[i:last]], i, last))
        if before[i] >= 0 and raw[before[i] : stop] in ranks:
            heapq.heappush(waiting, (ranks[raw[before[i] : stop]], before[i], stop))
    return [ranks[raw[i : end[i]]] for i in range(n) if alive[i]]


class Pairs:
    """The id that two neighbouring ids are joined to, for arrays of ids: a table with open addressing."""

    MISS = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for raw, i in ranks.items():
            for k in range(1, len(raw)):
                a, b = ranks.get(raw[:k]), ranks.get(raw[k:])
                if a is not None and b is not None:
                    found[a << 32 | b] = i
        self.bits = max(4, (4 * len(found)).bit_length())
        keys, values = np.array(list(found), np.uint64), np.array(list(found.values()), np.int32)
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << self.bits, self.MISS, np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):
            at = self._place(keys[left]) + self.probes & (len(self.keys) - 1)
            free = self.values[at] == self.MISS
            _, once = np.unique(at[free], return_index=True)
            taken = np.flatnonzero(free)[once]
            self.keys[at[taken]], self.values[at[taken]] = keys[left[taken]], values[left[taken]]
            left = np.delete(left, taken)
            self.probes += 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(SPREAD)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """MISS where the two are not joined or one of them is negative."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        at = self._place(keys)
        out = np.where(self.keys[at] == keys, self.values[at], self.MISS)
        open_ = np.flatnonzero((out == self.MISS) & (self.values[at] != self.MISS))
        for step in range(1, self.probes):
            if not len(open_):
                break
            at_ = at[open_] + step & (len(self.keys) - 1)
            hit = self.keys[at_] == keys[open_]
            out[open_[hit]] = self.values[at_[hit]]
            open_ = open_[~hit & (self.values[at_] != self.MISS)]
        return out


def merge_many(slices_: list[bytes], pairs: Pairs, single: np.ndarray) -> list[bytes]:
    """Ids of many short slices at once, as bytes of 32-bit numbers: in every round each slice joins its leftmost
    pair of lowest rank."""
    sizes = np.array([len(x) for x in slices_])
    width = int(sizes.max())
    raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in slices_), np.uint8).reshape(-1, width)
    ids = single[raw]
    ids[np.arange(width)[None, :] >= sizes[:, None]] = -1
    ranks = np.full((len(ids), width), Pairs.MISS, np.int32)
    ranks[:, :-1] = pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    done: list = [None] * len(ids)
    row = np.arange(len(ids))
    columns = np.arange(width)[None, :]
    while len(row):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(row)), at]
        over = best == Pairs.MISS
        if over.any():
            ready = ids[over]
            raw, sizes = ready.tobytes(), 4 * (ready >= 0).sum(axis=1)
            for k, at_, n in zip(row[over].tolist(), range(0, len(raw), 4 * width), sizes.tolist()):
                done[k] = raw[at_ : at_ + n]
            row, at, best, ids, ranks = row[~over], at[~over], best[~over], ids[~over], ranks[~over]
            if not len(row):
                break
        later = columns[:, :-1] > at[:, None]
        ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
        ranks[:, :-1] = np.where(later, ranks[:, 1:], ranks[:, :-1])
        ids[:, -1], ranks[:, -1] = -1, Pairs.MISS
        every = np.arange(len(row))
        ids[every, at] = best
        right = ids[every, np.minimum(at + 1, width - 1)]
        ranks[every, at] = np.where(at + 1 < width, pairs(best, right), Pairs.MISS)
        inner = np.flatnonzero(at > 0)
        ranks[inner, at[inner] - 1] = pairs(ids[inner, at[inner] - 1], best[inner])
    return done


class Coder:
    """Encodes and decodes with one vocabulary; keeps the ids of slices it has met."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.pairs = Pairs(self.ranks)
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)], np.int32)
        self.cache = SliceTable(self._learn)
        token = [b""] * (max(self.ranks.values()) + 1)
        for raw, i in self.ranks.items():
            token[i] = raw
        self.lengths = np.array([len(x) for x in token])
        self.raw = np.frombuffer(b"".join(token), np.uint8)
        decimals = [f"{i},".encode() for i in range(len(token))]
        self.digits = np.array([len(x) for x in decimals])
        self.decimals = np.frombuffer(b"".join(decimals), np.uint8)

    def _learn(self, new: list[bytes]) -> list[bytes]:
        out: list = [None] * len(new)
        by_width: dict[int, list[int]] = {}
        for k, x in enumerate(new):
            i = self.ranks.get(x)
            if i is not None:
                out[k] = np.int32(i).tobytes()
            elif len(x) > LONG_SLICE:
                out[k] = np.array(merge_long(x, self.ranks), np.int32).tobytes()
            else:
                by_width.setdefault((len(x) + 3) // 4, []).append(k)
        for group in by_width.values():
            for at in range(0, len(group), 1 << 14):
                part = group[at : at + (1 << 14)]
                for k, ids in zip(part, merge_many([new[k] for k in part], self.pairs, self.single)):
                    out[k] = ids
        return out

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of some texts, number of ids of each), in their order."""
        return encode_slices(texts, self.cache)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The first byte of every token in its text, and the end."""
        return np.concatenate([[0], np.cumsum(self.lengths[ids])])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens."""
        return _gathered(self.raw, self.lengths, ids)


def _gathered(raw: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    return raw[ragged((np.cumsum(lengths) - lengths)[ids], lengths[ids])].tobytes()


@cache
def coder(path: str) -> Coder:
    """One coder per worker process and vocabulary."""
    return Coder(path)


# ---- operator ----------------------------------------------------------------------------------
def _mapped(docs: DataFrame, text: str, result: pa.DataType, ddl: str, each) -> DataFrame:
    """All columns of `docs` and the struct `coded`, one value per row from `each(texts)`."""
    columns = docs.columns
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns) if c != text)).alias("row"),
        F.col(f"`{text}`").alias("text"),
    ) if len(columns) > 1 else docs.select(F.struct(F.lit(0).alias("v")).alias("row"), F.col(f"`{text}`").alias("text"))
    row = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in slices([len(t) for t in texts]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(list(each(texts[i:j])), result)], names=["row", "coded"]
                )

    done = packed.mapInArrow(run, f"row {row}, coded {ddl}")
    return done.select(*(F.col(f"row.v{i}").alias(c) for i, c in enumerate(columns) if c != text), "coded")


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row with `coded`, a struct of ids and offsets (first byte of each token, and the end), in place of the text.

    A null or empty text has no ids. `path` is the rank file, which every executor must find there.
    """

    def each(texts):
        c = coder(path)
        for ids, counts in c.encode(texts):
            for own in np.split(ids, np.cumsum(counts)[:-1]):
                yield {"ids": own, "offsets": c.offsets(own)}

    result = pa.struct([("ids", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64()))])
    return _mapped(docs, text, result, "struct<ids:array<int>,offsets:array<bigint>>", each)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row with `coded` in place of the text: n_tokens, ids_sha256 and the hash of the bytes that the ids decode to."""

    def each(texts):
        c = coder(path)
        for ids, counts in c.encode(texts):
            ends = np.cumsum(counts)
            decoded, decimals = c.decode(ids), _gathered(c.decimals, c.digits, ids)
            byte = np.concatenate([[0], np.cumsum(c.lengths[ids])])[np.concatenate([[0], ends])].tolist()
            digit = np.concatenate([[0], np.cumsum(c.digits[ids])])[np.concatenate([[0], ends])].tolist()
            for k, n in enumerate(counts.tolist()):
                yield {
                    "n_tokens": n,
                    "ids_sha256": hashlib.sha256(decimals[digit[k] : max(digit[k], digit[k + 1] - 1)]).hexdigest(),
                    "decoded_sha256": hashlib.sha256(decoded[byte[k] : byte[k + 1]]).hexdigest(),
                }

    result = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return _mapped(docs, text, result, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>", each)
