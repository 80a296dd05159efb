"""Words of UTF-8 text as byte positions, and their hashes, with numpy over parts of Arrow batches.

A word is ``[^\\x20\\x09-\\x0D]+``. The separators are single bytes and no part of any other UTF-8
character, so cutting the bytes cuts the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, data)`` of a string column; a NULL is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return bounds - bounds[0], held[bounds[0] : bounds[-1]]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose ``column`` holds at most ``max_bytes``, or a single longer row."""
    if not batch.num_rows:
        return
    ends = text_bytes(batch.column(batch.schema.get_field_index(column)))[0][1:]
    start = 0
    while start < len(ends):
        limit = (ends[start - 1] if start else 0) + max_bytes
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


@dataclass
class Words:
    """Words of several texts. ``first[i]:first[i + 1]`` are the words of text ``i``."""

    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # where each text begins in data, and the end
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def find_words(array: pa.Array) -> Words:
    bounds, data = text_bytes(array)
    inside = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[:-1])
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside[:-1]
    # A word ends where its text ends, even if the next text goes on without a separator.
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    start = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(before & (~inside | cut))
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input changes about half of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit word hashes, and from them hashes of sequences of words; ``lane`` gives independent ones.

    Eight bytes at a time are folded in with a non-linear mix, so no structure of a word cancels out.
    """

    def __init__(self, lane: int):
        rng = np.random.Generator(np.random.PCG64(0x5EED + lane))
        self.seed, self.step, self.pair = (rng.integers(1, 2**63, dtype=np.uint64) | np.uint64(1) for _ in range(3))

    def words(self, words: Words) -> np.ndarray:
        padded = np.concatenate([words.data, np.zeros(8, dtype=np.uint8)])
        size = words.end - words.start
        state = mix(size.astype(np.uint64) * self.step + self.seed)
        left, at, place = size.copy(), words.start.copy(), np.arange(len(size))
        while len(place):
            eight = np.zeros(len(place), dtype=np.uint64)
            for i in range(8):
                byte = padded[np.minimum(at + i, len(padded) - 1)].astype(np.uint64)
                eight |= np.where(left > i, byte, 0).astype(np.uint64) << np.uint64(8 * i)
            state[place] = mix(state[place] * self.step + mix(eight + self.seed))
            more = left > 8
            place, at, left = place[more], at[more] + 8, left[more] - 8
        return state

    def runs(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Hash of ``hashes[i : i + length]`` for each ``i``, in about log2(length) passes."""
        if len(hashes) < length:
            return np.zeros(0, dtype=np.uint64)
        power, size, done, out = hashes, 1, 0, None
        while True:
            if length & size:
                if out is None:
                    out = power
                else:
                    out = self._join(out, power[done:])
                done += size
            size *= 2
            if size > length:
                return out[: len(hashes) - length + 1]
            power = self._join(power, power[size // 2 :])

    def _join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = min(len(a), len(b))
        return mix(a[:n] * self.pair + b[:n] + self.seed)
