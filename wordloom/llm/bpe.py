"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

Every node holds the smallest ``(rank, place)`` below it, so the root is the leftmost pair of the
lowest rank; a merge changes three leaves and their paths. Trees of all new pretokens of a part of a
batch advance together, one merge per round, as numpy arrays; pretokens seen before come from a
cache of bounded size. A tokenizer file is only read, never trained.
"""

from __future__ import annotations

import ctypes
import gc
import json
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wordloom.llm.words import slices

CACHE_WORDS = 600_000
CACHE_BYTES = 64 << 20  # of pretokens and their ids; long ones reach it before their number does
_DECODED_ROWS = 256
FEW_ROWS = 8  # trees that are advanced one by one
_TREE_CELLS = 1 << 21  # bounds the memory of trees that advance together
# The published byte-level pattern; its \s is Unicode white space.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in visible else extra))
        extra += byte not in visible
    return out


class PairTable:
    """Ranks of pairs of ids in an open-addressing table that numpy probes for many pairs at once."""

    EMPTY = -1

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.merged = merged.astype(np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 3))))
        self.keys = np.full(1 << self.bits, self.EMPTY, dtype=np.int64)
        self.ranks = np.zeros(1 << self.bits, dtype=np.int64)
        # Later duplicates of a pair lose against the first.
        wanted = (left.astype(np.int64) << 32) | right.astype(np.int64)
        _, first = np.unique(wanted, return_index=True)
        rest = np.sort(first)
        slot = self._slot(wanted[rest])
        while len(rest):
            free = self.keys[slot] == self.EMPTY
            self.keys[slot[free]] = wanted[rest[free]]
            self.ranks[slot[free]] = rest[free]
            placed = self.keys[slot] == wanted[rest]
            rest, slot = rest[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    @cached_property
    def known(self) -> dict[int, int]:
        """Ranks by pair, for those who ask for one at a time."""
        held = self.keys != self.EMPTY
        return dict(zip(self.keys[held].tolist(), self.ranks[held].tolist()))

    @cached_property
    def merged_ids(self) -> list[int]:
        return self.merged.tolist()

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray, none: int) -> np.ndarray:
        """Rank of each pair, ``none`` where it is no merge or an id is negative."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(len(keys), none, dtype=np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[open_])
        while len(open_):
            held = self.keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            more = ~hit & (held != self.EMPTY)
            open_, slot = open_[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out


def merge_symbols(symbols: np.ndarray, sizes: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of ``symbols`` (its first ``sizes[i]`` cells) until no pair is left.

    Returns the final ids of all rows one after another, and their number in each row.
    """
    rows, width = symbols.shape
    bits = width.bit_length() - 1
    none = np.int64(1) << np.int64(62)
    place = np.arange(width)
    symbols = np.where(place < sizes[:, None], symbols, -1).astype(np.int32)
    after = np.where(place + 1 < sizes[:, None], place + 1, -1).astype(np.int32)
    before = np.broadcast_to(place - 1, (rows, width)).astype(np.int32)
    tree = np.full((rows, 2 * width), none, dtype=np.int64)
    ranks = pairs.rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), -1).reshape(rows, width - 1)
    tree[:, width : 2 * width - 1] = np.where(ranks >= 0, (ranks << bits) | place[:-1], none)
    level = width
    while level > 1:
        np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, level // 2 : level])
        level //= 2
    at = np.flatnonzero(tree[:, 1] < none)
    while len(at):
        if len(at) <= FEW_ROWS:
            for row in at.tolist():
                symbols[row] = _merge_alone(symbols[row], after[row], before[row], tree[row], int(none), pairs)
            break
        best = tree[at, 1]
        p, rank = best & (width - 1), best >> bits
        q = after[at, p]
        beyond = after[at, q]
        symbols[at, p] = pairs.merged[rank]
        symbols[at, q] = -1
        after[at, p] = beyond
        linked = beyond >= 0
        before[at[linked], beyond[linked]] = p[linked]
        # The merged symbol's pair with what follows and with what comes before; the gone symbol's pair.
        ahead = before[at, p].astype(np.int64)
        own, follows = symbols[at, p], np.where(linked, symbols[at, beyond], -1)
        led = np.where(ahead >= 0, symbols[at, ahead], -1)
        found = pairs.rank(np.concatenate([own, led]), np.concatenate([follows, own]), -1)
        leaf = np.concatenate([p, np.maximum(ahead, 0), q.astype(np.int64)])
        value = np.full(len(leaf), none, dtype=np.int64)
        known = np.flatnonzero(found >= 0)
        value[known] = (found[known] << bits) | leaf[known]
        row = np.concatenate([at, at, at])
        keep = np.concatenate([np.ones(len(at), bool), ahead >= 0, np.ones(len(at), bool)])
        row, node = row[keep], leaf[keep] + width
        tree[row, node] = value[keep]
        for _ in range(bits):
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        at = at[tree[at, 1] < none]
    alive = symbols >= 0
    return symbols[alive], alive.sum(axis=1)


def _merge_alone(
    symbols: np.ndarray, after: np.ndarray, before: np.ndarray, tree: np.ndarray, none: int, pairs: PairTable
) -> np.ndarray:
    """The same merges for one row, without arrays: cheaper than rounds that advance few rows."""
    width = len(symbols)
    bits = width.bit_length() - 1
    symbol, later, earlier = (array("i", np.ascontiguousarray(x, dtype=np.int32).tobytes()) for x in (symbols, after, before))
    nodes = array("q", np.ascontiguousarray(tree).tobytes())
    ranks, merged = pairs.known, pairs.merged_ids

    def put(leaf: int, value: int) -> None:
        node = leaf + width
        nodes[node] = value
        while node > 1:
            other = nodes[node ^ 1]
            least = value if value < other else other
            node >>= 1
            if nodes[node] == least:
                return  # nothing above changes
            nodes[node] = value = least

    while nodes[1] < none:
        place, rank = nodes[1] & (width - 1), nodes[1] >> bits
        gone = later[place]
        behind, ahead = later[gone], earlier[place]
        own = symbol[place] = merged[rank]
        symbol[gone] = -1
        later[place] = behind
        put(gone, none)
        if behind >= 0:
            earlier[behind] = place
            found = ranks.get(own << 32 | symbol[behind])
            put(place, none if found is None else found << bits | place)
        else:
            put(place, none)
        if ahead >= 0:
            found = ranks.get(symbol[ahead] << 32 | own)
            put(ahead, none if found is None else found << bits | ahead)
    return np.frombuffer(symbol, dtype=np.int32)


class Bpe:
    """The merges of a tokenizer file (tokenizers' JSON form) and a bounded cache of encoded pretokens."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        columns = zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        self.pairs = PairTable(*(np.array(c, dtype=np.int64) for c in columns))
        letters = byte_characters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.last = np.array([vocab[c + suffix] for c in letters], dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.pattern = regex.compile(BYTE_PATTERN)
        back = {c: byte for byte, c in enumerate(letters)}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            plain = token[: -len(suffix)] if suffix and token.endswith(suffix) else token
            self.token_bytes[i] = bytes(back[c] for c in plain) if all(c in back for c in plain) else plain.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.cache_words, self.cache = cache_words, {}
        self._forget()

    def _forget(self) -> None:
        self.cache = {token: np.int32(i).tobytes() for token, i in self.special.items()}
        self.held_bytes = 0

    def room(self) -> None:
        """Call between parts of a batch: drops the cache when it has reached its bound."""
        if len(self.cache) > self.cache_words or self.held_bytes > CACHE_BYTES:
            self._forget()

    def pretokens(self, text: str) -> list[str]:
        if "<" not in text or not self.special_pattern.search(text):
            return self.pattern.findall(text)
        out, start = [], 0
        for found in self.special_pattern.finditer(text):
            out += self.pattern.findall(text[start : found.start()])
            out.append(found.group())
            start = found.end()
        return out + self.pattern.findall(text[start:])

    def learn(self, words: list[str]) -> None:
        """Encode pretokens into the cache, those of like length together."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(b) for b in raw], dtype=np.int64)
        self.held_bytes += int(sizes.sum())
        widths = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        for width in np.unique(widths):
            chosen = np.flatnonzero(widths == width)
            step = max(1, _TREE_CELLS // int(width))
            for lo in range(0, len(chosen), step):
                part = chosen[lo : lo + step]
                n = sizes[part]
                cells = np.zeros((len(part), width), dtype=np.uint8)
                cells[np.arange(width) < n[:, None]] = np.frombuffer(b"".join(raw[i] for i in part), dtype=np.uint8)
                symbols = self.inner[cells]
                symbols[np.arange(len(part)), n - 1] = self.last[cells[np.arange(len(part)), n - 1]]
                ids, counts = merge_symbols(symbols, n, self.pairs)
                held, ends = ids.astype(np.int32).tobytes(), np.cumsum(counts) * 4
                self.held_bytes += len(held)
                begin = 0
                for i, end in zip(part.tolist(), ends.tolist()):
                    self.cache[words[i]] = held[begin:end]
                    begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        self.room()
        cut = [self.pretokens(t) for t in texts]
        fresh = set().union(*cut).difference(self.cache) if cut else set()
        if fresh:
            self.learn(list(fresh))
        return [b"".join(map(self.cache.__getitem__, c)) for c in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_MODELS: dict[tuple, object] = {}


def release_memory() -> None:
    """Give back what an operator that ran in this worker before has freed; only glibc needs the call."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def held(kind: Callable, *arguments) -> object:
    """One model per Python worker: tasks that reuse the worker find it, and its cache, again."""
    key = (kind, *arguments)
    if key not in _MODELS:
        forget_models()
        _MODELS[key] = kind(*arguments)
        release_memory()  # what reading the file took
    return _MODELS[key]


def forget_models() -> None:
    """Give back the worker's model."""
    _MODELS.clear()
    release_memory()


def id_lists(encoded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(e) // 4 for e in encoded])
    values = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in kept), values], names=[*(batch.schema.names[i] for i in kept), name]
    )


def schema_with(df: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema if f.name != out), T.StructField(out, kind)])


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", cache_words: int = CACHE_WORDS) -> DataFrame:
    """Add ``out``, the ids of the whole ``text`` as ``array<int>``.

    A NULL or empty text has no ids. Texts of any length are encoded whole: a long pretoken is one
    larger tree. All rows stay as they are, repeated ones too; a column named ``out`` is replaced.
    Special tokens of the file that stand in a text become their ids, as in the tokenizers library.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(Bpe, path, cache_words)
        for batch in batches:
            for part in slices(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                yield with_column(part, out, id_lists(bpe.encode(texts)))

    return df.mapInArrow(run, schema_with(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the text of the array ``ids``; special tokens stay. NULL or no ids: empty text.

    An id that the file doesn't have, or a NULL id, fails the job: there is no text to give for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(Bpe, path, CACHE_WORDS)
        for batch in batches:
            for start in range(0, batch.num_rows, _DECODED_ROWS):
                part = batch.slice(start, _DECODED_ROWS)
                texts = [bpe.decode(row.as_py() or []) for row in part.column(ids)]
                yield with_column(part, out, pa.array(texts, type=pa.string()))

    return df.mapInArrow(run, schema_with(df, out, T.StringType()))
