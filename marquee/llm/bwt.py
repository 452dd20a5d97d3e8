"""Burrows-Wheeler transforms of shards of strings, and their merge by interleave refinement.

A shard sorts the suffixes of its own strings once and keeps, of each, the byte in front of it: its
transform. ``END`` closes each string; it is a byte that UTF-8 never has, and the ends of different strings
differ, the earlier string's being smaller. From the transform alone follows the place of the suffix that is
one byte longer (``longer``), and by walking it from the ends, the string and the length of every suffix.

The merge begins with the rows of all shards one after the other, one block. A step reads the rows in the
order so far, deals them by the bytes in front, and puts in their place the rows of the suffixes longer by
these: within a shard rows come in the order of its transform, so only the interleave of the shards is
refined and no suffix is compared or sorted again. Rows then stand in the order of their first h bytes, and
a block ends where these differ: its rows' common prefix is what they were read to. Rows alone in their block
share h bytes with no other, nor do the rows longer than they, so they leave the merge. What is left are the
intervals whose common prefix has h bytes.
"""

from __future__ import annotations

import numpy as np

END = 0xFF
_FIRST = 7  # bytes that the first sort of a shard looks at


class Transform:
    """The transform of some byte strings, none of which holds END."""

    def __init__(self, strings: list[bytes]) -> None:
        text = np.frombuffer(bytes([END]).join([*strings, b""]), np.uint8)
        order = _suffix_order(text)
        self.count = len(strings)
        self.before = text[order - 1]
        # The k-th row in front of which stands a byte becomes the k-th row that begins with it.
        rows = np.argsort(self.before, kind="stable")
        self.longer = np.empty(len(text), np.int32)
        self.longer[rows] = np.arange(len(text), dtype=np.int32)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: its string, and the length of the suffix without END."""
        size = len(self.before)
        string, length = np.empty(size, np.int32), np.empty(size, np.int32)
        names = np.arange(self.count, dtype=np.int32)
        rows, steps = names + (size - self.count), 0
        while len(rows):
            string[rows], length[rows] = names, steps
            going = self.before[rows] != END
            names, rows, steps = names[going], self.longer[rows[going]], steps + 1
        return string, length


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order; prefixes double until all ranks differ."""
    size = len(text)
    if not size:
        return np.empty(0, np.int64)
    ends = np.flatnonzero(text == END)
    left = ends[np.searchsorted(ends, np.arange(size))] - np.arange(size)  # bytes before the end
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray((size,), ">u8", padded, 0, (1,)).astype(np.uint64) >> np.uint64(8)
    short = np.flatnonzero(left < _FIRST)
    key[short] &= np.uint64((1 << 56) - 1) << (np.uint64(8) * (_FIRST - 1 - left[short]).astype(np.uint64))
    order = np.argsort(key, kind="stable")
    ended = left[order] < _FIRST
    apart = np.ones(size, bool)
    apart[1:] = (key[order][1:] != key[order][:-1]) | ended[1:] | ended[:-1]
    rank = np.empty(size, np.int64)
    depth = _FIRST
    at = np.arange(size)
    while True:
        rank[order] = np.maximum.accumulate(np.where(apart, at, 0))
        alone = apart & np.append(apart[1:], True)
        if alone.all():
            return order
        tied = np.flatnonzero(~alone)
        starts = order[tied]
        both = rank[starts] * (size + 1) + rank[starts + depth]
        by = np.argsort(both, kind="stable")
        order[tied] = starts[by]
        apart[tied[1:]] |= both[by][1:] != both[by][:-1]
        depth *= 2


def merged_intervals(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows, numbered through all shards, whose first ``depth`` bytes another row has as well, in merged
    order, and where each interval of rows with one common prefix begins."""
    before = np.concatenate([s.before for s in shards])
    offsets = np.cumsum([0, *[len(s.before) for s in shards]])
    longer = np.concatenate([s.longer + np.int32(o) for s, o in zip(shards, offsets)])
    pair, closed, by_two = before.astype(np.uint16), before == END, longer[longer]
    pair |= pair[longer] << np.uint16(8)
    closed_pair = closed | closed[longer]
    rows = np.arange(len(before), dtype=np.int32)
    block = np.zeros(len(before), np.int32)
    # Two bytes a step halve the steps; the byte further in front counts more.
    for front, ended, onward in [(pair, closed_pair, by_two)] * (depth // 2) + [(before, closed, longer)] * (depth % 2):
        going = ~ended[rows]
        if not going.all():
            rows, block = rows[going], block[going]
        front_bytes = front[rows]
        order = np.argsort(front_bytes, kind="stable")
        front_bytes, block = front_bytes[order], block[order]
        begins = np.ones(len(order) + 1, bool)
        begins[1:-1] = (front_bytes[1:] != front_bytes[:-1]) | (block[1:] != block[:-1])
        shared = ~(begins[:-1] & begins[1:])
        rows = onward[rows[order[shared]]]
        block = np.cumsum(begins[:-1], dtype=np.int32)[shared]
        if not len(rows):
            break
    return rows, np.flatnonzero(np.diff(block, prepend=-1))
