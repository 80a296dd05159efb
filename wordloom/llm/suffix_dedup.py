"""Remove repeated byte strings by merging Burrows-Wheeler transforms of shards.

A corpus has no single suffix order that one task could hold, so it is first dealt by content. Among the grams of a
string of ``length`` bytes the one with the smallest hash is its anchor: equal strings have equal anchors. Starts that
stand next to each other and share an anchor are kept together as one run of bytes, and only runs whose anchor occurs
again go on. Runs of one range of anchors meet in one task, as the transforms (``bwt.py``) that the pieces of the corpus
have made of them. There the transforms are merged by interleave refinement, common prefixes fall out of it, and suffixes
that share ``length`` bytes stand in one interval. All but the earliest of an interval are removed.

Pieces of the corpus stay where they are, in a table bucketed by piece. Equal runs of a piece are one run, so a text that
stands in a third of all documents is one run per piece. If all runs of an anchor are equal, the interval is known without
a merge, and only their places travel. An anchor with very many different runs is split into strings of exactly ``length`` bytes,
dealt by their own hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.bpe import release_memory
from wordloom.llm.bwt import Merge, Shards, row_heads, transforms
from wordloom.llm.words import mix, slices, text_bytes
from wordloom.session import durable, new_path

LENGTH = 100
PIECE_BYTES = 8 << 20
CHUNK = 1 << 18  # bytes that are hashed at a time
MOST_STARTS = 64  # of one run
HOT_RUNS = 1 << 11  # different runs of one anchor that are merged in one task
ANCHORS_A_RANGE = 1 << 20
SUFFIXES_A_RANGE = 1 << 18
_OUT = ("n_bytes", "n_removed", "n_spans", "kept")
# What is known of an anchor: nothing, all its runs are equal, they differ, they are very many.
NONE, EQUAL, MIXED, HOT = range(4)
_rng = np.random.Generator(np.random.PCG64(0xB17E))
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 2**63)) | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    n = min(len(a), len(b))
    return a[:n] * _power(size) + b[:n]


def run_hashes(hashes: np.ndarray, size: int, have: int = 1) -> np.ndarray:
    """Polynomial hashes of ``size`` bytes from those of ``have`` bytes, at every place that has as many; ``have`` divides ``size``."""
    times, out, done, power, reach = size // have, None, 0, hashes, 1
    while True:
        if times & reach:
            out = power if out is None else _joined(out, power[done * have :], reach * have)
            done += reach
        reach *= 2
        if reach > times:
            return out
        power = _joined(power, power[reach // 2 * have :], reach // 2 * have)


def _extreme(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Smallest or largest of each ``width`` neighbours."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = pick(out[:-size], out[size:]), 2 * size
    return pick(out[: len(values) - width + 1], out[width - size :]) if width > size else out


@dataclass
class Runs:
    """Runs of starts with one anchor: first byte, number of starts, anchor, and a hash of the run's bytes, 0 if starts in
    it may repeat each other."""

    start: np.ndarray
    starts: np.ndarray
    anchor: np.ndarray
    name: np.ndarray

    @classmethod
    def joined(cls, parts: list[Runs]) -> Runs:
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        columns = zip(*((p.start, p.starts, p.anchor, p.name) for p in parts)) if parts else ([],) * 4
        return cls(*(np.concatenate([np.zeros(0, kind), *column]) for kind, column in zip(kinds, columns)))


class Finder:
    """Cuts texts into runs of starts."""

    def __init__(self, length: int):
        self.length = length
        self.gram = max(1, length // 2)
        self.width = length - self.gram + 1  # grams of one string
        self.most = min(MOST_STARTS, length)

    def runs(self, data: np.ndarray, bounds: np.ndarray) -> Runs:
        """The runs of texts that lie one after another in ``data``, hashed a chunk at a time."""
        found = []
        for a in range(0, max(0, len(data) - self.length + 1), CHUNK):
            part = data[a : a + CHUNK + self.length - 1]
            lo, hi = np.searchsorted(bounds, (a, a + len(part)), side="right")
            cut = np.unique(np.clip(bounds[max(0, lo - 1) : hi + 1] - a, 0, len(part)))
            runs = self._runs(part, cut)
            runs.start += a
            found.append(runs)
        return Runs.joined(found)

    def _runs(self, data: np.ndarray, bounds: np.ndarray) -> Runs:
        length, gram, width = self.length, self.gram, self.width
        n = len(data) - length + 1
        plain = run_hashes(_BYTES[data], gram)
        whole = plain if length == gram else run_hashes(plain, 2 * gram, gram)
        if length > 2 * gram:
            whole = _joined(whole, _BYTES[data[2 * gram :]], 1)
        hashes = plain ^ (plain >> np.uint64(32))
        hashes *= np.uint64(0x9E3779B97F4A7C15)
        least = _extreme(hashes, width, np.minimum)[:n]
        new = np.ones(n + 1, dtype=bool)
        np.not_equal(least[1:], least[:-1], out=new[1:n])
        # A string lies in one text: no start in its last bytes, and a new run behind them.
        crossing = np.zeros(n + 1, dtype=bool)
        for end in bounds[1:].tolist():
            crossing[max(0, end - length + 1) : end] = True
            new[min(end, n)] = new[min(max(0, end - length + 1), n)] = True
        edges = np.flatnonzero(new)
        heads = edges[:-1]
        inside = ~crossing[heads]
        starts, heads = np.diff(edges)[inside], heads[inside]
        parts = -(-starts // self.most)
        if (parts > 1).any():
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            ends = np.repeat(heads + starts, parts)
            heads = np.repeat(heads, parts) + number * self.most
            starts = np.minimum(ends - heads, self.most)
        name = mix(whole[heads] * np.uint64(0xD6E8FEB86659FD93) + whole[heads + starts - 1] + starts.astype(np.uint64)) | np.uint64(1)
        # Two equal smallest grams in one run: its starts may repeat each other.
        reach = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        chosen = np.flatnonzero(hashes[: n + width - 1] == _extreme(reach, width, np.maximum))
        twice = np.flatnonzero((hashes[chosen[1:]] == hashes[chosen[:-1]]) & (np.diff(chosen) <= width + self.most))
        if len(twice):
            marked = np.concatenate([[0], np.cumsum(covered(n, np.maximum(chosen[twice] - width + 1, 0), np.minimum(chosen[twice + 1] + 1, n)))])
            name[marked[heads + starts] > marked[heads]] = 0
        return Runs(heads, starts, mix(least[heads]), name)


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the half-open ranges."""
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def range_ends(ordered: np.ndarray, ranges: int) -> list[int]:
    """Where each range of hashes ends in sorted hashes."""
    number = ((ordered >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(number, np.arange(ranges), side="right").tolist()


@dataclass
class Anchors:
    """The distinct anchors of a piece, sorted: the name of its runs or 0 for several, how many different ones, how many runs; and
    the number of each run's anchor."""

    anchor: np.ndarray
    name: np.ndarray
    different: np.ndarray
    counts: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, runs: Runs) -> Anchors:
        order = np.lexsort((runs.name, runs.anchor))
        anchor, name = runs.anchor[order], runs.name[order]
        new = row_heads(anchor)
        first = np.flatnonzero(new)
        different = np.add.reduceat(row_heads(anchor, name), first, dtype=np.int64) if len(first) else first
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        counts = np.diff(np.append(first, len(anchor)))
        return cls(anchor[first], np.where(different > 1, np.uint64(0), name[first]), different, counts, number)


def judge_anchors(table: pa.Table, hot: int) -> pa.Table:
    """For the blocks of one range of anchors: what is known of each anchor in each block, where that is anything."""
    anchors = [np.frombuffer(b, np.uint64) for b in table.column("anchors").to_pylist()]
    names = [np.frombuffer(b, np.uint64) for b in table.column("names").to_pylist()]
    counts = [np.frombuffer(b, np.uint32) for b in table.column("counts").to_pylist()]
    _, number, blocks = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
    name, count = np.concatenate(names), np.concatenate(counts)
    order = np.argsort(number, kind="stable")
    first = np.flatnonzero(row_heads(number[order]))
    equal = (np.minimum.reduceat(name[order], first) == np.maximum.reduceat(name[order], first)) & (name[order][first] != 0)
    runs = np.add.reduceat(count[order], first, dtype=np.int64)
    known = np.select([blocks == 1, equal, runs > hot], [NONE, EQUAL, HOT], MIXED).astype(np.uint8)
    codes, start = [], 0
    for block in anchors:
        codes.append(known[number[start : start + len(block)]])
        start += len(block)
    some = pa.array([bool(c.any()) for c in codes], pa.bool_())
    mixed = np.array([int((c >= MIXED).sum()) for c in codes], dtype=np.int64)
    answers = {"range": table.column("range"), "piece": table.column("piece"), "answer": pa.array([c.tobytes() for c in codes], pa.binary()), "mixed": pa.array(mixed)}
    return pa.table(answers).filter(some)


class Piece:
    """The texts of one piece, one after another in the order of their documents."""

    def __init__(self, table: pa.Table, length: int):
        self.number = table.column("piece")[0].as_py() if table.num_rows else 0
        key, no = table.column("held_key"), table.column("held_no").to_numpy()
        null, key = key.is_null().to_numpy(), key.fill_null(0).to_numpy()
        self.order = np.lexsort((no, key, null))
        self.null, self.key = null[self.order], key[self.order]
        self.bounds, self.data = text_bytes(table.column("held_text").take(pa.array(self.order)))
        self.length = length
        self.runs = Finder(length).runs(self.data, self.bounds)
        self.anchors = Anchors.of(self.runs)

    def codes(self, answers: dict[int, bytes], ranges: int) -> np.ndarray:
        """What is known of each run's anchor, from the answers by range and from this piece."""
        own = self.anchors
        code = np.zeros(len(own.anchor), dtype=np.uint8)
        start = 0
        for i, end in enumerate(range_ends(own.anchor, ranges)):
            if i in answers:
                code[start:end] = np.frombuffer(answers[i], np.uint8)
            start = end
        # Anchors that no other piece has: repeated here, or in one run.
        here = np.where((own.different > 1) | (own.name == 0), MIXED, np.where(own.counts > 1, EQUAL, NONE))
        return np.where(code == NONE, here, code).astype(np.uint8)[own.number]

    def places(self, starts: np.ndarray) -> np.ndarray:
        """What orders strings that begin at these bytes: NULL keys last, key, row, place in the text."""
        row = np.searchsorted(self.bounds, starts, side="right") - 1
        return np.stack([self.null[row], self.key[row], row, starts - self.bounds[row]], axis=1).astype(np.int64)

    def found(self, codes: np.ndarray, ranges: int) -> Found:
        runs = self.runs
        equal = np.flatnonzero(codes == EQUAL)
        anchor, first = np.unique(runs.anchor[equal], return_index=True)  # runs are in the order of the documents
        whole, seen = self.data.tobytes(), {}
        start, count, string, hashed = [], [], [], []
        mixed = np.flatnonzero(codes >= MIXED)
        columns = (runs.start[mixed].tolist(), runs.starts[mixed].tolist(), runs.anchor[mixed].tolist(), codes[mixed].tolist())
        for at, starts, name, code in zip(*columns):
            # A very frequent anchor's strings are dealt one by one.
            for a, n in ((at, starts),) if code == MIXED else ((at + k, 1) for k in range(starts)):
                text = whole[a : a + n + self.length - 1]
                number = seen.setdefault(text, len(seen))
                if number == len(hashed):
                    hashed.append(name if code == MIXED else xxhash.xxh64_intdigest(text))
                start.append(a)
                count.append(n)
                string.append(number)
        dealt = ((np.array(hashed, dtype=np.uint64) >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        return Found(self, equal, anchor, equal[first], list(seen), dealt.astype(np.int64), *(np.array(x, dtype=np.int64) for x in (start, count, string)))


@dataclass
class Found:
    """The runs of a piece that go on: those with an anchor whose runs are all equal, and the others as strings.

    ``start``, ``count`` and ``string`` are the places of the strings in the piece, in order; equal strings have one number.
    """

    piece: Piece
    equal: np.ndarray
    anchor: np.ndarray
    first: np.ndarray  # the first run of each of these anchors
    texts: list[bytes]
    dealt: np.ndarray  # the range that each string is sent to
    start: np.ndarray
    count: np.ndarray
    string: np.ndarray

    def __post_init__(self):
        self.sent = np.argsort(self.dealt, kind="stable")
        _, at = np.unique(self.string, return_index=True)
        self.head = at  # where each string stands first
        sizes = self.count[at][self.sent]
        self.begin = np.empty(len(self.sent), dtype=np.int64)
        self.begin[self.sent] = np.cumsum(sizes) - sizes  # of its starts among all that are sent

    def blocks(self, ranges: int) -> pa.Table:
        """One row per range: anchors and their first places, the strings' transform and their first places."""
        rows, texts = transforms([self.texts[i] for i in self.sent.tolist()], self.dealt[self.sent])
        ends = np.searchsorted(self.dealt[self.sent], np.arange(ranges), side="right").tolist()
        anchor_ends = range_ends(self.anchor, ranges)
        equal_places = self.piece.places(self.piece.runs.start[self.first])
        places = self.piece.places(self.start[self.head][self.sent])
        out = {name: [] for name in ("range", "piece", "equal", "equal_places", "strings", "places")}
        a = b = done = number = 0
        for i, (c, d) in enumerate(zip(anchor_ends, ends)):
            if c > a or d > b:
                upto = int(texts[number]) if d > b else done
                number += d > b
                values = (self.anchor[a:c], equal_places[a:c], rows[done:upto], places[b:d])
                for column, value in zip(out.values(), (i, self.piece.number, *(v.tobytes() for v in values))):
                    column.append(value)
                done = upto
            a, b = c, d
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
        return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)})

    def gone(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """Which bytes of the piece go, by the answers of the ranges: bits of the anchors, and of all starts of the strings."""
        piece, length = self.piece, self.piece.length
        ranges = sorted(answers)
        later = np.zeros(len(self.anchor), dtype=bool)
        flags = np.zeros(int(self.count[self.head].sum()), dtype=bool)
        a = b = 0
        for i in ranges:
            equal, strings, n_equal, n_starts = answers[i]
            later[a : a + n_equal], flags[b : b + n_starts] = _bits(equal, n_equal), _bits(strings, n_starts)
            a, b = a + n_equal, b + n_starts
        # Every run but the first of its kind goes as a whole; the first as far as earlier pieces have it.
        again = np.ones(len(piece.runs.start), dtype=bool)
        again[self.first] = later
        runs = self.equal[again[self.equal]]
        repeated = np.ones(len(self.start), dtype=bool)
        repeated[self.head] = False
        size = self.count[self.head]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        single = (np.repeat(self.start[self.head], size) + within)[flags[np.repeat(self.begin, size) + within]]
        starts = np.concatenate([piece.runs.start[runs], self.start[repeated], single])
        counts = np.concatenate([piece.runs.starts[runs], self.count[repeated], np.ones(len(single), np.int64)])
        return covered(len(piece.data), starts, starts + counts + length - 1)


def _least(group: np.ndarray, places: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Which rows come first in their group; ``places`` are (null, key, row, start)."""
    order = np.lexsort((places[:, 3], places[:, 2], piece, places[:, 1], places[:, 0], group))
    first = np.zeros(len(group), dtype=bool)
    first[order[row_heads(group[order])]] = True
    return first


def merge_range(table: pa.Table, length: int) -> pa.Table:
    """For the blocks of one range: bits of the anchors and of the starts of all strings that repeat an earlier one."""

    def arrays(name: str, kind: type, width: int = 1) -> list[np.ndarray]:
        return [np.frombuffer(b, kind).reshape(-1, width) if width > 1 else np.frombuffer(b, kind) for b in table.column(name).to_pylist()]

    pieces = table.column("piece").to_numpy()
    equal, equal_places, places = arrays("equal", np.uint64), arrays("equal_places", np.int64, 4), arrays("places", np.int64, 4)

    def owner(blocks: list[np.ndarray]) -> np.ndarray:
        return np.repeat(pieces, [len(b) for b in blocks])

    equal_later = ~_least(np.concatenate(equal), np.concatenate(equal_places), owner(equal))
    where, from_ = np.concatenate([np.zeros((0, 4), np.int64), *places]), owner(places)
    # A string that several pieces send is merged once, with the place that comes first; for the others all starts repeat.
    shards = Shards(arrays("strings", np.uint8))
    string, size = shards.suffixes()
    texts = shards.texts(string, size)
    names: dict[bytes, int] = {}
    kind = np.array([names.setdefault(t, len(names)) for t in texts], dtype=np.int64)
    kept = _least(kind, where, from_)
    counts = np.array([len(t) - length + 1 for t in texts], dtype=np.int64)
    begins = np.cumsum(counts) - counts
    flags = np.ones(int(counts.sum()), dtype=bool)
    rows_of = np.cumsum([0, *map(len, arrays("strings", np.uint8))])
    stays = kept[string]
    merge = Merge([shards.symbols[a:b][stays[a:b]] for a, b in zip(rows_of[:-1].tolist(), rows_of[1:].tolist())], length)
    own, left = merge.suffixes()
    own = np.flatnonzero(kept)[own]
    # Suffixes of at least ``length`` bytes that share as many stand in one interval.
    rows = merge.rows[left[merge.rows] >= length]
    block = merge.block[left[merge.rows] >= length]
    own, at = own[rows], counts[own[rows]] + length - 1 - left[rows]
    several = np.zeros(len(rows), dtype=bool)
    edge = row_heads(block)
    several[:-1] = ~edge[1:]
    several |= ~edge
    flags[begins[own] + at] = False
    own, at, block = own[several], at[several], block[several]
    places_now = where[own]
    places_now[:, 3] += at
    flags[begins[own] + at] = ~_least(block, places_now, from_[own])
    out = {"range": [], "piece": [], "equal": [], "starts": [], "n_equal": [], "n_starts": []}
    a = b = c = 0
    for number, piece, anchors, held in zip(table.column("range").to_pylist(), pieces.tolist(), equal, places):
        n = int(counts[b : b + len(held)].sum())
        bits = (np.packbits(x).tobytes() for x in (equal_later[a : a + len(anchors)], flags[c : c + n]))
        for column, value in zip(out.values(), (number, piece, *bits, len(anchors), n)):
            column.append(value)
        a, b, c = a + len(anchors), b + len(held), c + n
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def _bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def cut(data: np.ndarray, bounds: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each text its bytes, those that go, their maximal runs, and what is left."""
    before = np.concatenate([[0], np.cumsum(gone)])
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    inner = bounds[:-1][np.diff(bounds) > 0]
    edge[inner] = gone[inner]  # a run ends with its text
    edges = np.concatenate([[0], np.cumsum(edge)])
    offsets = (bounds - before[bounds]).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[~gone].tobytes())])
    return np.diff(bounds), np.diff(before[bounds]), np.diff(edges[bounds]), kept


def _pieces(df: DataFrame, key: str, text: str, row: Column) -> DataFrame:
    """The rows with the number of their piece, at most ``PIECE_BYTES`` or one longer row, and their place in it."""
    slim = df.select(F.col(key).cast("long").alias("held_key"), F.coalesce(F.col(text), F.lit("")).alias("held_text"), row.alias("held_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, size, rows = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for part in slices(batch, "held_text"):
                more = len(text_bytes(part.column(1))[1])
                if rows and size + more > PIECE_BYTES:
                    piece, size, rows = piece + 1, 0, 0
                numbers = [pa.array(np.full(part.num_rows, piece)), pa.array(np.arange(rows, rows + part.num_rows))]
                size, rows = size + more, rows + part.num_rows
                yield pa.RecordBatch.from_arrays([*numbers, *part.columns], names=["piece", "held_no", *part.schema.names])

    fields = [T.StructField("piece", T.LongType()), T.StructField("held_no", T.LongType()), *slim.schema]
    return slim.mapInArrow(run, T.StructType(fields))


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """Replace ``text`` by ``kept``, its bytes without repeats; add ``n_bytes``, ``n_removed`` and ``n_spans``.

    Texts are taken as UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
    document with a smaller key, or earlier in the same one. Strings overlap and are judged on the input. ``kept`` is
    binary, as a cut may fall into a character; ``n_spans`` are the maximal removed runs.

    A NULL text is empty; texts shorter than ``length`` lose nothing. NULL keys come after all others; rows that share a
    key, and those without one, are ordered by their place in the input. ``key`` is a whole number. Columns of ``df`` with the names of new
    ones are replaced. Anchors and equal runs are compared by 64 bits each, all else byte by byte.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in df.columns if c not in (text, *_OUT)]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(True)
    path, name = new_path(spark, "pieces"), f"pieces_{uuid.uuid4().hex}"
    _pieces(df, key, text, row).write.bucketBy(max(1, tasks), "piece").option("path", path).saveAsTable(name)
    docs = spark.table(name)
    slim = docs.select("piece", "held_key", "held_no", "held_text")
    total = docs.agg(F.sum(F.octet_length("held_text"))).first()[0] or 0
    ranges = max(2 * tasks, total // (length // 4 + 1) // ANCHORS_A_RANGE)

    def first(table: pa.Table) -> pa.Table:
        piece = Piece(table, length)
        own = piece.anchors
        out = {"range": [], "piece": [], "anchors": [], "names": [], "counts": []}
        start = 0
        for i, end in enumerate(range_ends(own.anchor, ranges)):
            if end > start:
                values = (x[start:end].tobytes() for x in (own.anchor, own.name, own.different.astype(np.uint32)))
                for column, value in zip(out.values(), (i, piece.number, *values)):
                    column.append(value)
            start = end
        del piece, own
        release_memory()
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    anchors = slim.groupBy("piece").applyInArrow(first, "range long, piece long, anchors binary, names binary, counts binary")
    judged = durable(
        anchors.groupBy("range").applyInArrow(lambda t: judge_anchors(t, hot_runs), "range long, piece long, answer binary, mixed long"),
        "anchors",
    )
    mixed = judged.agg(F.sum("mixed")).first()[0] or 0
    merges = max(2 * tasks, mixed * (length + length // 4) // SUFFIXES_A_RANGE)

    def again(table: pa.Table, answers: pa.Table) -> Found:
        piece = Piece(table, length)
        told = answers.filter(answers.column("answer").is_valid())
        codes = piece.codes(dict(zip(told.column("range").to_pylist(), told.column("answer").to_pylist())), ranges)
        return piece.found(codes, merges)

    def second(table: pa.Table, answers: pa.Table) -> pa.Table:
        sent = again(table, answers).blocks(merges)
        release_memory()
        return sent

    blocks = slim.groupBy("piece").cogroup(judged.groupBy("piece")).applyInArrow(
        second, "range long, piece long, equal binary, equal_places binary, strings binary, places binary"
    )

    def merged(table: pa.Table) -> pa.Table:
        out = merge_range(table, length)
        release_memory()
        return out

    repeats = blocks.groupBy("range").applyInArrow(
        merged, "range long, piece long, equal binary, starts binary, n_equal long, n_starts long"
    )
    both = judged.drop("mixed").unionByName(durable(repeats, "repeats"), allowMissingColumns=True)

    def third(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = again(table, answers)
        told = answers.filter(answers.column("answer").is_null())
        columns = (told.column(c).to_pylist() for c in ("equal", "starts", "n_equal", "n_starts"))
        gone = found.gone(dict(zip(told.column("range").to_pylist(), zip(*columns))))
        piece = found.piece
        done = pa.table(
            {
                "held_row": table.column("held_row").take(pa.array(piece.order)),
                **{name: pa.array(values) for name, values in zip(_OUT, cut(piece.data, piece.bounds, gone))},
            }
        )
        del found, piece, gone
        release_memory()
        return done

    done = docs.groupBy("piece").cogroup(both.groupBy("piece")).applyInArrow(
        third,
        T.StructType(
            [
                docs.schema["held_row"],
                *(T.StructField(c, T.LongType()) for c in _OUT[:3]),
                T.StructField("kept", T.BinaryType()),
            ]
        ),
    )
    return done.select(*(F.col(f"held_row.`{c}`") for c in others), *_OUT)
