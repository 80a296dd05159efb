"""Pack token sequences of documents into windows of a fixed length, in bounded space.

Every partition keeps a fixed number of open windows and writes each piece as soon as it is placed.
A document's whole windows stand alone; its rest goes to the open window with the least room that
still holds it. When none does, the fullest one is closed: its gap is filled with a cut of the
piece unless it is small. Windows still open at the end of a partition are merged, many partitions
at a time, by their fill alone.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark import TaskContext

from wordloom.llm.bpe import Bpe, forget_models, held, id_lists
from wordloom.llm.words import slices
from wordloom.session import durable

LENGTH = 2048
OPEN_WINDOWS = 32
SMALL_GAP = 16
MERGED_PARTITIONS = 256
END_ID = 1
CACHE_BYTES = 128 << 20  # of words and their ids
_ENTRY_BYTES = 160  # of one word in the cache, besides its letters and ids
PART_BYTES = 1 << 19  # of text that is encoded at a time
CACHE_PIECES = 40_000  # pieces of new words; words that come again need none
# The published pattern of the lower-case tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


_PLAIN = bytes([*range(0x21, 0x7F), 0xC3, *range(0x80, 0xC0)])
_MARK = np.int32(-1).tobytes()


class WordIds:
    """Ids of a tokenizer that drops white space and lower-cases, word by word.

    White space ends every pretoken, so words are encoded apart and kept in a bounded cache. Words of
    visible ASCII and Latin-1 letters go through the segment trees; all others, and those that may
    hold a special token, through the tokenizers library itself.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.path = path
        self.bpe = Bpe(path, CACHE_PIECES)
        self.pattern = regex.compile(WORD_PATTERN + r"|\n")
        self.cache_bytes, self.held_bytes, self.cache = cache_bytes, 0, {}

    @cached_property
    def tokenizer(self):
        """The library's tokenizer; most texts need none."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if not w.translate(None, _PLAIN) and b"<|" not in w]
        self.bpe.room()
        # All words at once, each ended by a line feed, whose "ids" are a mark that no id equals.
        pieces = self.pattern.findall(b"\n".join([*plain, b""]).decode().lower())
        fresh = set(pieces).difference(self.bpe.cache, "\n")
        if fresh:
            self.bpe.learn(list(fresh))
        self.bpe.cache["\n"] = _MARK
        encoded = b"".join(map(self.bpe.cache.__getitem__, pieces))
        begin = 0
        for word, end in zip(plain, (4 * np.flatnonzero(np.frombuffer(encoded, "<i4") == -1)).tolist()):
            self.cache[word] = encoded[begin:end]
            begin = end + 4
        self.held_bytes += len(encoded)
        rest = list(set(words).difference(plain))
        found = self.tokenizer.encode_batch([w.decode() for w in rest], add_special_tokens=False) if rest else []
        for word, one in zip(rest, found):
            self.cache[word] = b"".join(i.to_bytes(4, "little") for i in one.ids)
            self.held_bytes += 4 * len(one.ids)
        self.held_bytes += sum(map(len, words)) + _ENTRY_BYTES * len(words)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held_bytes > self.cache_bytes:
            self.cache, self.held_bytes = {}, 0
        # Lower-casing A-Z early changes nothing but the number of words, unless it made a special token.
        raw = [t.encode() for t in texts]
        cut = [(r if b"<|" in r else r.lower()).split() for r in raw]
        fresh = set().union(*cut).difference(self.cache) if cut else set()
        if fresh:
            self._learn(list(fresh))
        return [b"".join(map(self.cache.__getitem__, c)) for c in cut]


class OpenWindows:
    """At most ``limit`` windows of ``length`` with room left, ordered by their room."""

    def __init__(self, length: int = LENGTH, limit: int = OPEN_WINDOWS, small_gap: int = SMALL_GAP):
        self.length, self.limit, self.small_gap = length, limit, small_gap
        self.rooms: list[tuple[int, int]] = []
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, size: int) -> Iterator[tuple[int, int, int, int]]:
        """Place a document of ``size`` tokens: ``(start, length, window, offset)`` of each piece."""
        start = 0
        while size - start >= self.length:
            yield start, self.length, self._new(), 0
            start += self.length
        while start < size:
            rest = size - start
            at = bisect.bisect_left(self.rooms, (rest, -1))
            if at < len(self.rooms):
                room, window = self.rooms.pop(at)
                taken = rest
            elif len(self.rooms) < self.limit:
                room, window, taken = self.length, self._new(), rest
            else:
                room, window = self.rooms.pop(0)
                if room <= self.small_gap:
                    continue
                taken = room
            yield start, taken, window, self.length - room
            start += taken
            if room > taken:
                bisect.insort(self.rooms, (room - taken, window))

    def left(self) -> list[tuple[int, int]]:
        """``(window, fill)`` of what is still open."""
        return [(window, self.length - room) for room, window in self.rooms]


def merge_left(table: pa.Table, length: int) -> pa.Table:
    """Best-fit decreasing over the fills of left-over windows: into which window each one goes, and where."""
    rows = sorted(zip(*[table.column(c).to_pylist() for c in ("_fill", "_part", "_window")]), key=lambda r: (-r[0], r[1:]))
    rooms: list[tuple[int, int]] = []
    bins: list[tuple[int, int]] = []
    out = []
    for fill, part, window in rows:
        at = bisect.bisect_left(rooms, (fill, -1))
        if at < len(rooms):
            room, into = rooms.pop(at)
        else:
            room, into = length, len(bins)
            bins.append((part, window))
        out.append((part, window, *bins[into], length - room))
        if room > fill:
            bisect.insort(rooms, (room - fill, into))
    names = ("_part", "_window", "_to_part", "_to_window", "_base")
    return pa.table({n: pa.array([r[i] for r in out], type=pa.int64()) for i, n in enumerate(names)})


def pack(
    df: DataFrame,
    path: str,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    end_id: int | None = END_ID,
    with_ids: bool = True,
    make: Callable[[str, int], object] = WordIds,
    cache_bytes: int = CACHE_BYTES,
    keep_model: bool = True,
) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids``.

    ``path`` names the tokenizer file. Every document gets ``end_id`` at its end, so a NULL or empty
    text is a piece of that one id; without ``end_id`` it has no piece. Repeated rows, equal and NULL
    keys are packed like any others. Other columns of ``df`` play no part. Sequences are gapless from
    offset 0; the room after their last piece is padding. An empty table gives no rows.

    A task holds encoded words of at most ``cache_bytes``, and those of one part of a batch. A worker keeps its model for the
    next task, unless ``keep_model`` is off, which leaves the memory to other operators.
    """
    kind = df.schema[key].dataType.simpleString()
    ending = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held(make, path, cache_bytes)
        windows = OpenWindows(length, open_windows)
        part_no = TaskContext.get().partitionId()
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for part in slices(batch, "_text", PART_BYTES):
                encoded = model.encode([t or "" for t in part.column(1).to_pylist()])
                rows, pieces, ids = [], [], []
                for i, held_ids in enumerate(encoded):
                    held_ids += ending
                    size = len(held_ids) // 4
                    for start, taken, window, offset in windows.place(size):
                        cut = held_ids[4 * start : 4 * (start + taken)]
                        rows.append(i)
                        pieces.append((start, taken, zlib.crc32(cut), size, window, offset))
                        if with_ids:
                            ids.append(cut)
                yield _pieces(part.column(0).take(pa.array(rows, type=pa.int64())), pieces, part_no, ids if with_ids else None)
        left = windows.left()
        if left:
            yield _pieces(pa.nulls(len(left), key_type), [(-1, 0, 0, 0, w, fill) for w, fill in left], part_no, [b""] * len(left) if with_ids else None)
        if not keep_model:
            del model
            forget_models()

    numbers = "start long, length long, ids_crc32 long, doc_tokens long, _window long, offset long, _part long"
    slim = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    placed = durable(
        slim.mapInArrow(run, f"_key {kind}, {numbers}" + (", ids array<int>" if with_ids else "")), "pieces"
    )
    left = placed.filter("start < 0").select(
        "_part", "_window", F.col("offset").alias("_fill"), F.expr(f"_part div {MERGED_PARTITIONS}").alias("_group")
    )
    moved = left.groupBy("_group").applyInArrow(
        lambda table: merge_left(table, length), "_part long, _window long, _to_part long, _to_window long, _base long"
    )
    numbered = F.coalesce("_to_part", "_part") * F.lit(1 << 32) + F.coalesce("_to_window", "_window")
    return (
        placed.filter("start >= 0")
        .join(moved, ["_part", "_window"], "left")
        .select(
            F.col("_key").alias(key),
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            numbered.alias("sequence_id"),
            (F.col("offset") + F.coalesce("_base", F.lit(0))).alias("offset"),
            *(["ids"] if with_ids else []),
        )
    )


def _pieces(keys: pa.Array, pieces: list[tuple], part: int, ids: list[bytes] | None) -> pa.RecordBatch:
    names = ["_key", "start", "length", "ids_crc32", "doc_tokens", "_window", "offset", "_part"]
    columns = [pa.array([p[i] for p in pieces], type=pa.int64()) for i in range(6)]
    arrays = [keys, *columns, pa.array([part] * len(pieces), type=pa.int64())]
    if ids is not None:
        arrays.append(id_lists(ids))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)
