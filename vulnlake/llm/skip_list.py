"""An indexable skip list over the units (lines) of one text.

The lowest stored lane has a link per part of the text, every higher lane joins LANE links of the lane below. A link carries two
widths: how many units end in it and how many code points it spans. A descent adds up widths and reaches the place
behind any unit in a bounded number of steps per lane. The lanes of the units themselves are built for the one part that a descent
ends in, so a text of any length needs memory for its parts and for one part's units.
"""

from __future__ import annotations

import numpy as np

# Links that one link of the next lane spans.
LANE = 16
# Bytes of text under a link of the lowest stored lane.
PART = 1 << 18

NEWLINE = 10


def _lanes(units: np.ndarray, chars: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The given links and the lanes above them, the lowest first; each lane is (units, code points, bytes) per link."""
    lanes = [(units, chars, size)]
    while len(lanes[-1][0]) > LANE:
        firsts = np.arange(0, len(lanes[-1][0]), LANE)
        lanes.append(tuple(np.add.reduceat(width, firsts) for width in lanes[-1]))
    return lanes


def _descend(lanes: list, rank: int) -> tuple[int, int, int, int]:
    """(link of the lowest lane, units, code points, bytes before it): the link in which unit `rank` (from 1) ends."""
    link = units = chars = size = 0
    for level in range(len(lanes) - 1, -1, -1):
        own_units, own_chars, own_size = lanes[level]
        while link + 1 < len(own_units) and units + own_units[link] < rank:
            units += int(own_units[link])
            chars += int(own_chars[link])
            size += int(own_size[link])
            link += 1
        if level:
            link *= LANE
    return link, units, chars, size


def _starts(raw: np.ndarray) -> np.ndarray:
    """Which bytes start a code point."""
    return (raw & 0xC0) != 0x80


class SkipList:
    """Lines of `text` (UTF-8): each ends with its line feed, the last one may end without."""

    def __init__(self, text: bytes, part: int = PART) -> None:
        self.raw = np.frombuffer(text, np.uint8)
        self.part = part
        firsts = range(0, len(text), part)
        parts = [self.raw[i : i + part] for i in firsts]
        units = np.array([np.count_nonzero(x == NEWLINE) for x in parts], np.int64)
        chars = np.array([np.count_nonzero(_starts(x)) for x in parts], np.int64)
        size = np.array([len(x) for x in parts], np.int64)
        if len(text) and text[-1] != NEWLINE:
            units[-1] += 1
        self.units, self.chars = int(units.sum()), int(chars.sum())
        self.lanes = _lanes(units, chars, size)

    def reach(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) of the first `rank` units."""
        if rank <= 0:
            return 0, 0
        link, units, chars, size = _descend(self.lanes, rank)
        own = self.raw[link * self.part : (link + 1) * self.part]
        stops = np.flatnonzero(own == NEWLINE) + 1
        if units + len(stops) < rank:  # the last unit, without a line feed
            return self.chars, len(self.raw)
        own = own[: stops[-1]]
        points = np.add.reduceat(_starts(own), np.concatenate([[0], stops[:-1]]), dtype=np.int64)
        lanes = _lanes(np.ones(len(stops), np.int64), points, np.diff(stops, prepend=0))
        unit, _, more_chars, more_size = _descend(lanes, rank - units)
        return chars + more_chars + int(lanes[0][1][unit]), size + more_size + int(lanes[0][2][unit])
