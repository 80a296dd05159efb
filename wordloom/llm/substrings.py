"""Remove long passages that stand in several places, found with difference-cover anchors.

Hashes are taken only at word positions that lie in a difference cover modulo its period: any two
equal windows share an anchor at the same distance from their starts. Windows around repeated
anchors are then hashed whole, which extends each match to its true length. Documents stay where
they are, in a table bucketed by the partition they were read in; only blocks of sorted, distinct
hashes travel to their hash range, and bit masks travel back. A passage that stands in a third of
all documents is thus one hash per partition, never a group of pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.bpe import release_memory
from wordloom.llm.words import Hasher, find_words, slices
from wordloom.session import durable, new_path

WINDOW = 35
# Perfect difference sets; every difference modulo the period occurs.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_OUT = ("n_words", "n_removed", "kept")


@dataclass
class Cover:
    """Period and residues for windows of ``window`` words; an anchor has ``length`` words."""

    window: int

    def __post_init__(self):
        if self.window < 1:
            raise ValueError("a window has at least one word")
        self.period = max(p for p in COVERS if p == 1 or self.window - p + 1 >= 0.4 * self.window)
        self.residues = np.array(COVERS[self.period])
        self.length = self.window - self.period + 1


@dataclass
class Hashed:
    """Words of a part of a partition with their hashes, and their places in their documents."""

    words: object
    lanes: list[np.ndarray]
    place: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, array: pa.Array, hashers: list[Hasher]) -> Hashed:
        words = find_words(array)
        counts = words.counts()
        place = np.arange(len(words.start)) - np.repeat(words.first[:-1], counts)
        return cls(words, [h.words(words) for h in hashers], place, np.repeat(counts, counts) - place)


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the half-open ranges."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


class Matcher:
    """Finds anchors, candidate windows and removed words of one partition's documents."""

    def __init__(self, cover: Cover, buckets: int):
        self.cover, self.buckets = cover, buckets
        self.hashers = [Hasher(0), Hasher(1)]

    def bucket_ends(self, ordered: np.ndarray) -> np.ndarray:
        """Where each bucket, a range of hashes, ends in sorted hashes."""
        bucket = ((ordered >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(self.buckets), side="right")

    def anchors(self, part: Hashed) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and hashes of the anchors."""
        chosen = np.isin(part.place % self.cover.period, self.cover.residues) & (part.left >= self.cover.length)
        at = np.flatnonzero(chosen)
        return at, self.hashers[0].runs(part.lanes[0], self.cover.length)[at] if len(at) else np.zeros(0, np.uint64)

    def candidates(self, part: Hashed, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of these anchors at a distance below the period."""
        first = np.maximum(anchors - part.place[anchors], anchors - (self.cover.period - 1))
        return np.flatnonzero(_covered(len(part.place), first, anchors + 1) & (part.left >= self.cover.window))

    def windows(self, part: Hashed, starts: np.ndarray) -> np.ndarray:
        """128-bit hashes, two columns."""
        if not len(starts):
            return np.zeros((0, 2), dtype=np.uint64)
        return np.stack([h.runs(lane, self.cover.window)[starts] for h, lane in zip(self.hashers, part.lanes)], axis=1)

    def removed(self, part: Hashed, starts: np.ndarray) -> np.ndarray:
        return _covered(len(part.place), starts, starts + self.cover.window)

    def parts(self, texts: pa.ChunkedArray, lanes: int) -> Iterator[Hashed]:
        for batch in pa.table({"t": texts}).to_batches():
            for piece in slices(batch, "t"):
                yield Hashed.of(piece.column(0), self.hashers[:lanes])

    def send(self, part_no: int, hashes: np.ndarray) -> pa.Table:
        """Distinct hashes (one or two columns, sorted) cut into the blocks of their buckets."""
        ends = self.bucket_ends(hashes if hashes.ndim == 1 else hashes[:, 0])
        rows, start = [], 0
        for bucket, end in enumerate(ends.tolist()):
            if end > start:
                rows.append((bucket, hashes[start:end].tobytes()))
            start = end
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], type=pa.int64()),
                "part": pa.array([part_no] * len(rows), type=pa.int64()),
                "block": pa.array([r[1] for r in rows], type=pa.binary()),
            }
        )

    def receive(self, hashes: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
        """For the same sorted hashes: which ones another partition has too."""
        ends = self.bucket_ends(hashes if hashes.ndim == 1 else hashes[:, 0])
        out, start = np.zeros(len(hashes), dtype=bool), 0
        for bucket, end in enumerate(ends.tolist()):
            if bucket in replies:
                mask = np.unpackbits(np.frombuffer(replies[bucket], dtype=np.uint8), count=end - start)
                out[start:end] = mask.astype(bool)
            start = end
        return out

    def repeated_anchors(self, texts: pa.ChunkedArray, replies: dict[int, bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distinct anchor hashes of the partition that are repeated, in it or elsewhere."""
        found = np.concatenate([np.zeros(0, np.uint64), *(self.anchors(p)[1] for p in self.parts(texts, 1))])
        distinct, counts = np.unique(found, return_counts=True)
        return distinct[(counts > 1) | self.receive(distinct, replies)]

    def candidate_windows(self, texts: pa.ChunkedArray, repeated: np.ndarray) -> Iterator[tuple[Hashed, np.ndarray, np.ndarray]]:
        for part in self.parts(texts, 2):
            starts = self.starts(part, repeated)
            yield part, starts, self.windows(part, starts)

    def starts(self, part: Hashed, repeated: np.ndarray) -> np.ndarray:
        """Starts of the candidate windows around repeated anchors."""
        at, hashes = self.anchors(part)
        slot = np.searchsorted(repeated, hashes)
        hit = np.zeros(len(at), dtype=bool)
        inside = slot < len(repeated)
        hit[inside] = repeated[slot[inside]] == hashes[inside]
        return self.candidates(part, at[hit])


def _distinct_pairs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows, how often each occurs, and each input row's place among them."""
    if not len(hashes):
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    ordered = hashes[order]
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    number = np.cumsum(fresh) - 1
    places = np.empty(len(ordered), dtype=np.int64)
    places[order] = number
    return ordered[fresh], np.bincount(number), places


def shared_hashes(table: pa.Table, columns: int) -> pa.Table:
    """For the blocks of one bucket: a bit mask per block of the hashes that other blocks hold too."""
    blocks = [np.frombuffer(b, dtype=np.uint64).reshape(-1, columns) for b in table.column("block").to_pylist()]
    _, counts, places = _distinct_pairs(np.concatenate(blocks)) if columns == 2 else _distinct_single(np.concatenate(blocks)[:, 0])
    shared = counts[places] > 1
    masks, start = [], 0
    for block in blocks:
        masks.append(np.packbits(shared[start : start + len(block)]).tobytes())
        start += len(block)
    answers = pa.table({"bucket": table.column("bucket"), "part": table.column("part"), "mask": pa.array(masks, pa.binary())})
    return answers.filter(pa.array([any(m) for m in masks], type=pa.bool_()))


def _distinct_single(hashes: np.ndarray) -> tuple[None, np.ndarray, np.ndarray]:
    _, places, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return None, counts, places


def _replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(*[table.column(c).to_pylist() for c in ("kind", "bucket", "mask")])
    return {bucket: mask for k, bucket, mask in rows if k == kind}


def _kept_text(data: bytes, keep: np.ndarray, words, spacing: bool) -> str:
    if spacing:
        return b" ".join(compress(data.split(), keep.tolist())).decode()
    if keep.all():
        return data.decode()
    # A removed run goes with the white space behind it.
    starts, base = words
    edges = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
    out, at = [], 0
    for first, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(data[at : starts[first] - base])
        at = starts[stop] - base if stop < len(starts) else len(data)
    return b"".join([*out, data[at:]]).decode()


def dedup_substrings(df: DataFrame, text: str = "text", window: int = WINDOW, single_space: bool = False) -> DataFrame:
    """Replace ``text`` by ``kept``, the text without repeated passages; add ``n_words``, ``n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``window`` words that covers it has the
    same words as a window that starts anywhere else, in the same text or another; all copies go,
    and windows are judged on the input. With ``single_space`` the kept words are joined by one space,
    otherwise white space stays, and texts that lose nothing stay exactly as they are.

    A NULL or empty text has no words and an empty ``kept``. Shorter texts than a window lose nothing.
    Repeated rows are copies of each other. Columns of ``df`` with the names of new ones are replaced.
    Windows are compared by 128-bit hashes.
    """
    spark = df.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cover = Cover(window)
    others = [c for c in df.columns if c not in (text, *_OUT)]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(True)
    path, name = new_path(spark, "parts"), f"parts_{uuid.uuid4().hex}"
    held = df.select(
        F.spark_partition_id().cast("long").alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("held_text"),
        row.alias("held_row"),
    )
    # A bucketed table is read back without a shuffle, as often as it takes.
    held.write.bucketBy(max(1, buckets // 2), "part").option("path", path).saveAsTable(name)
    docs = spark.table(name)
    slim = docs.select("part", "held_text")

    def first(table: pa.Table) -> pa.Table:
        matcher = Matcher(cover, buckets)
        texts = table.column("held_text")
        found = [matcher.anchors(p)[1] for p in matcher.parts(texts, 1)]
        sent = matcher.send(table.column("part")[0].as_py(), np.unique(np.concatenate([np.zeros(0, np.uint64), *found])))
        release_memory()  # the worker outlives the group
        return sent

    def second(table: pa.Table, answers: pa.Table) -> pa.Table:
        matcher = Matcher(cover, buckets)
        texts = table.column("held_text")
        repeated = matcher.repeated_anchors(texts, _replies(answers, 1))
        found = [h for _, _, h in matcher.candidate_windows(texts, repeated)]
        hashes = _distinct_pairs(np.concatenate([np.zeros((0, 2), np.uint64), *found]))[0]
        sent = matcher.send(table.column("part")[0].as_py(), hashes)
        del found, hashes
        release_memory()
        return sent

    def third(table: pa.Table, answers: pa.Table) -> pa.Table:
        matcher = Matcher(cover, buckets)
        texts = table.column("held_text")
        repeated = matcher.repeated_anchors(texts, _replies(answers, 1))
        # Only the places of candidate windows are held for all texts, then their words are found again.
        found = [h for _, _, h in matcher.candidate_windows(texts, repeated)]
        distinct, counts, places = _distinct_pairs(np.concatenate([np.zeros((0, 2), np.uint64), *found]))
        gone = ((counts > 1) | matcher.receive(distinct, _replies(answers, 2)))[places] if len(places) else np.zeros(0, bool)
        del found, distinct
        totals, lost, kept, at = [], [], [], 0
        for part in matcher.parts(texts, 1):
            starts = matcher.starts(part, repeated)
            removed = matcher.removed(part, starts[gone[at : at + len(starts)]])
            at += len(starts)
            words = part.words
            for i in range(len(words.bounds) - 1):
                lo, hi = words.first[i], words.first[i + 1]
                keep = ~removed[lo:hi]
                base = int(words.bounds[i])
                data = words.data[base : words.bounds[i + 1]].tobytes()
                kept.append(_kept_text(data, keep, (words.start[lo:hi], base), single_space))
                totals.append(int(hi - lo))
                lost.append(int(hi - lo - keep.sum()))
        done = pa.table(
            {
                "held_row": table.column("held_row"),
                "n_words": pa.array(totals, pa.int64()),
                "n_removed": pa.array(lost, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )
        del kept, totals, lost, gone, repeated
        release_memory()
        return done

    block, mask = "bucket long, part long, block binary", "bucket long, part long, mask binary"
    anchors = slim.groupBy("part").applyInArrow(first, block)
    answers = durable(
        anchors.groupBy("bucket").applyInArrow(lambda t: shared_hashes(t, 1), mask).withColumn("kind", F.lit(1)), "anchors"
    )
    windows = slim.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(second, block)
    more = windows.groupBy("bucket").applyInArrow(lambda t: shared_hashes(t, 2), mask).withColumn("kind", F.lit(2))
    both = answers.unionByName(durable(more, "windows"))
    done = docs.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(
        third,
        T.StructType(
            [
                docs.schema["held_row"],
                *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")),
                T.StructField("kept", T.StringType()),
            ]
        ),
    )
    return done.select(*(F.col(f"held_row.`{c}`") for c in others), *_OUT)
