"""Burrows-Wheeler transforms of sets of byte strings, and their merge by interleave refinement.

The rows of a transform are the suffixes of all strings in order; a row's symbol is what stands before its
suffix, as byte + 1, and 0 where nothing does. String i ends with a mark of its own that is smaller than
any byte and than the mark of string i + 1, so its empty suffix is row i. Bytes are those of UTF-8, below 0xFF.
"""

from __future__ import annotations

import numpy as np

_WORD = 5  # symbols of a byte that fit a sort key beside the number of a group
_STEPS = (5, 4, 3, 2, 1)


def row_heads(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _sorted(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """An order by group and key; ties in any order."""
    if not len(group) or int(group.max()) >= 1 << (63 - 8 * _WORD):
        return np.lexsort((key, group))
    return np.argsort(group << (8 * _WORD) | key)


def transforms(strings: list[bytes], groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The transforms of groups of strings, one after another, and where each string's group begins and ends.

    ``groups`` numbers the strings' groups in ascending order, one group by default. Returned are all symbols and, for
    each group that occurs, the end of its rows. Suffixes are ordered by words of five symbols, then by the ranks of what
    stands behind the part that is equal, which doubles each time.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    groups = np.zeros(len(strings), dtype=np.int64) if groups is None else np.asarray(groups, dtype=np.int64)
    gap = _WORD + 1
    begins = np.cumsum(sizes + gap) - (sizes + gap)
    symbols = np.zeros(int((sizes + gap).sum()) + _WORD, dtype=np.uint8)
    at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    symbols[at] = np.frombuffer(b"".join(strings), dtype=np.uint8) + np.uint8(1)
    words = np.zeros(len(symbols) - _WORD + 1, dtype=np.int64)
    for i in range(_WORD):
        words = (words << 8) | symbols[i : i + len(words)]
    # All suffixes, the empty ones too, string by string.
    place = np.repeat(begins - (np.cumsum(sizes + 1) - (sizes + 1)), sizes + 1) + np.arange((sizes + 1).sum())
    group = np.repeat(groups, sizes + 1)
    order = _sorted(group, words[place])
    group, key = group[order], words[place[order]]
    new = row_heads(group, key)
    number = np.cumsum(new) - 1
    tied = np.bincount(number)[number] > 1
    same = np.flatnonzero(tied & ((key & 0xFF) == 0))  # equal to their ends: the earlier string first
    order[same] = order[same][np.lexsort((order[same], number[same]))]
    new[same] = True
    # A row's rank is the place of the first row that is not known to differ from it.
    rank = np.zeros(len(symbols), dtype=np.int64)
    rank[place[order]] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    open_ = np.flatnonzero(tied & ~((key & 0xFF) == 0))
    depth = _WORD
    while len(open_):
        rows = order[open_]
        own, behind = rank[place[rows]], rank[place[rows] + depth]
        again = np.argsort(own << 32 | behind)
        order[open_] = rows = rows[again]
        new = row_heads(own[again], behind[again])
        rank[place[rows]] = open_[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        number = np.cumsum(new) - 1
        open_ = open_[np.bincount(number)[number] > 1]
        depth *= 2
    at = place[order]
    found = np.where(at > 0, symbols[at - 1], np.uint8(0)).astype(np.uint8)
    ends = np.cumsum(sizes + 1)[np.flatnonzero(np.append(groups[1:] != groups[:-1], True))] if len(groups) else sizes
    return found, ends


def transform(strings: list[bytes]) -> np.ndarray:
    """The transform of one shard's strings."""
    return transforms(strings)[0]


class Shards:
    """Transforms laid one after another; rows are numbered over all of them."""

    def __init__(self, shards: list[np.ndarray]):
        self.symbols = np.concatenate([np.zeros(0, np.uint8), *shards])
        sizes = np.array([len(s) for s in shards], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        self.before = np.empty(len(self.symbols), dtype=np.int32)  # the row of the suffix that begins one symbol earlier
        for shard, start in zip(shards, starts.tolist()):
            self.before[start + np.argsort(shard, kind="stable")] = np.arange(start, start + len(shard), dtype=np.int32)
        marks = [np.arange(o, o + int((s == 0).sum()), dtype=np.int32) for o, s in zip(starts.tolist(), shards)]
        self.ends = np.concatenate([np.zeros(0, np.int32), *marks])  # rows of the empty suffixes, string by string

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row its string, numbered over all shards, and the length of its suffix.

        All strings are walked from their ends at once.
        """
        string = np.empty(len(self.symbols), dtype=np.int32)
        length = np.empty(len(self.symbols), dtype=np.int32)
        row, number, walked = self.ends, np.arange(len(self.ends), dtype=np.int32), 0
        while len(row):
            string[row], length[row] = number, walked
            goes_on = self.symbols[row] != 0
            row, number, walked = self.before[row[goes_on]], number[goes_on], walked + 1
        return string, length

    def texts(self, string: np.ndarray, length: np.ndarray) -> list[bytes]:
        """All strings, from what ``suffixes`` returns."""
        inner = self.symbols != 0
        whole = np.zeros(len(self.ends), dtype=np.int64)
        whole[string[~inner]] = length[~inner]  # nothing stands before a whole string
        ends = np.cumsum(whole)
        data = np.zeros(int(whole.sum()), dtype=np.uint8)
        # The symbol before a suffix of n bytes is the one n + 1 bytes before its string's end.
        data[ends[string[inner]] - length[inner] - 1] = self.symbols[inner] - np.uint8(1)
        held = data.tobytes()
        return [held[a:b] for a, b in zip((ends - whole).tolist(), ends.tolist())]


class Merge(Shards):
    """Several transforms as one, ordered by the first ``depth`` symbols of each suffix.

    The interleave starts as one block of all rows. A round moves every row to the row some symbols earlier, stably by
    these symbols, and so refines the order by as many; suffixes too short to be reached that way have their places by
    their own few symbols. No two suffixes are compared. Where neighbours part in a round, their common prefix is what
    the rounds before have shown (``common``, a multiple of the step; ``depth`` where they never part).

    ``step`` symbols are taken at a time: a divisor of ``depth`` such that the different ones can be told by 16 bits.
    """

    def __init__(self, shards: list[np.ndarray], depth: int, step: int | None = None):
        super().__init__(shards)
        n = len(self.symbols)
        self.rows, self.block = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
        self.common = np.full(n, depth, dtype=np.int32)
        if n:
            self._interleave(depth, step)

    def _steps(self, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The symbols before each row as one number, the row before them, and rows and symbols of the suffixes shorter than ``step``."""
        n = len(self.symbols)
        code, row = np.zeros(n, dtype=np.int64), np.arange(n, dtype=np.int32)
        whole = np.ones(n, dtype=bool)
        for i in range(step):
            symbol = self.symbols[row]
            whole &= symbol != 0
            code |= symbol.astype(np.int64) << (8 * i)
            row = self.before[row]
        short_rows, short_codes = [], []
        row, own = self.ends, np.zeros(len(self.ends), dtype=np.int64)
        for _ in range(step):
            short_rows.append(row)
            short_codes.append(own)
            symbol = self.symbols[row].astype(np.int64)
            goes_on = symbol != 0
            own = own[goes_on] >> 8 | symbol[goes_on] << (8 * (step - 1))
            row = self.before[row[goes_on]]
        return np.where(whole, code, -1), self._moved(step), np.concatenate(short_rows), np.concatenate(short_codes)

    def _moved(self, step: int) -> np.ndarray:
        row = self.before
        for _ in range(step - 1):
            row = self.before[row]
        return row

    def _interleave(self, depth: int, step: int | None) -> None:
        n = len(self.symbols)
        for size in (step,) if step else (s for s in _STEPS if depth % s == 0):
            code, before, short, short_code = self._steps(size)
            known, number = np.unique(np.concatenate([code, short_code]), return_inverse=True)
            if len(known) <= 1 << 16 or size == 1:
                break
        number = number.astype(np.uint16 if len(known) <= 1 << 16 else np.int32)
        if known[0] >= 0:  # every row has one before it, as far as this step goes: never with any string
            number += 1
        symbols, last = number[:n], number[n:]
        # Suffixes that no move reaches come behind the others in each round; each is a block of its own.
        lost = int((symbols == 0).sum())
        alone = np.arange(n, n + len(short), dtype=np.int32)
        rows, block, blocks = self.rows, self.block, 0
        parted = np.zeros(n, dtype=bool)
        keys = np.concatenate([symbols, last])
        for h in range(0, depth, size):
            np.take(symbols, rows, out=keys[:n])
            order = np.argsort(keys, kind="stable")[lost:]
            rows = np.concatenate([before[rows], short])[order]
            key, block = keys[order], np.concatenate([block, alone])[order]
            now = np.ones(n, dtype=bool)
            np.logical_or(key[1:] != key[:-1], block[1:] != block[:-1], out=now[1:])
            block = np.cumsum(now, dtype=np.int32) - np.int32(1)
            if block[-1] + 1 > blocks:  # else all neighbours that part have done so before
                self.common[now & ~parted] = h
                parted, blocks = now, int(block[-1]) + 1
            if blocks == n:
                break
        self.rows, self.block = rows, block
