"""How filters of documents interact: every order of them, audited from one walk over their subsets.

Documents with the same failures are alike, so a part is a table of at most 2^n mask cells with counts.
A Gray code visits all subsets of the filters and toggles one filter at a time: each cell keeps how
many active filters it fails, and enters or leaves the running survivors when that number leaves or reaches
zero. The survivors of all subsets are stored; a step of any order is the difference of two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import slices, text_bytes
from wordloom.session import durable

FILTERS = "ABCDE"
MAX_FILTERS = 7  # fixed value: 5,040 orders
# Least words, share of distinct words and of capitals in percent, symbols.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, b"#$%&*|"
_MARKED = np.isin(np.arange(256), list(SYMBOLS))
_SUMS = ("docs", "good", "toxic")
_STEP = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
_PARTS = 64


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each text's bytes."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_failures(array: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """For each text the bits of the filters A to D that it fails, and a digest of the text."""
    bounds, data = text_bytes(array)
    whole = data.tobytes()
    words, distinct, digests = [], [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        text = whole[a:b]
        found = text.split()
        words.append(len(found))
        distinct.append(len(set(found)))
        digests.append(hashlib.blake2b(text, digest_size=16).digest())
    n, different = np.array(words, dtype=np.int64), np.array(distinct, dtype=np.int64)
    points = _sums((data & 0xC0) != 0x80, bounds)
    capitals = _sums((data >= 0x41) & (data <= 0x5A), bounds)
    fails = [
        n < LEAST_WORDS,
        100 * different < LEAST_DISTINCT * n,
        100 * capitals > MOST_CAPITALS * points,
        _sums(_MARKED[data], bounds) > 0,
    ]
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails)), digests


def document_failures(docs: DataFrame, part: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, part, mask)`` of every row: the bits of the filters A to E that it fails, A the lowest.

    A: under 100 words; B: under 80 % distinct words; C: over 10 % capitals A-Z among the code points; D: any of
    ``#$%&*|``; E: the text stands under a smaller key, too. A NULL text is empty. NULL keys count as larger than all
    others and as equal to each other, so rows that share a key don't repeat each other. Texts are compared by
    128-bit digests. Other columns play no part.
    """
    slim = docs.select(F.col(key).alias("key"), part.cast("string").alias("part"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                masks, digests = text_failures(piece.column(2))
                arrays = [piece.column(0), piece.column(1), pa.array(masks), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "part", "mask", "digest"])

    kind = slim.schema["key"].dataType.simpleString()
    marks = durable(slim.mapInArrow(run, f"key {kind}, part string, mask int, digest binary"), "failures")
    # The first row of each text is met by (text, key), so no group of copies is one task's work.
    firsts = marks.groupBy("digest").agg(F.min("key").alias("first_key"), F.lit(True).alias("first"))
    met = marks.join(
        firsts.withColumnRenamed("digest", "first_digest"),
        (F.col("digest") == F.col("first_digest")) & F.col("key").eqNullSafe(F.col("first_key")),
        "left",
    )
    repeated = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    return met.select("key", "part", F.col("mask").bitwiseOR(repeated).alias("mask"))


def mask_cells(failures: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``part, mask, docs, good, toxic``: documents, and those that a label calls good or toxic.

    Several labels of a key count once; a document is good or toxic if any of them says so.
    """
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = failures.join(known, "key", "left")
    return marked.groupBy("part", "mask").agg(
        F.count("*").alias("docs"), *(F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in _SUMS[1:])
    )


def survivors(cells: np.ndarray) -> np.ndarray:
    """What is left after each subset of the filters; ``cells`` is (parts, masks, sums) and so is the result."""
    n = cells.shape[1].bit_length() - 1
    masks = np.arange(1 << n)
    failed = np.zeros(1 << n, dtype=np.int64)  # active filters that a cell fails
    left = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = left
    active = 0
    for step in range(1, 1 << n):
        bit = step & -step  # the filter that the Gray code toggles
        active ^= bit
        met = (masks & bit) != 0
        if active & bit:
            failed[met] += 1
            left = left - cells[:, met & (failed == 1)].sum(axis=1)
        else:
            failed[met] -= 1
            left = left + cells[:, met & (failed == 0)].sum(axis=1)
        states[:, active] = left
    return states


def order_steps(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each order and step: the filter's number, and the subsets before and after it."""
    orders = np.array(list(permutations(range(n))), dtype=np.int64)
    after = np.cumsum(1 << orders, axis=1)
    return orders, after - (1 << orders), after


def shapley(states: np.ndarray) -> np.ndarray:
    """For each part and filter: documents removed, summed over all orders."""
    n = states.shape[1].bit_length() - 1
    subsets = np.arange(1 << n)
    size = np.bitwise_count(subsets)
    out = []
    for f in range(n):
        without = subsets[(subsets >> f) & 1 == 0]
        weight = np.array([factorial(int(k)) * factorial(n - 1 - int(k)) for k in size[without]], dtype=np.int64)
        out.append(((states[:, without, 0] - states[:, without | 1 << f, 0]) * weight).sum(axis=1))
    return np.stack(out, axis=1)


def audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``part, mask, docs, good, toxic``.

    ``kept`` and ``removed`` are the documents after and in the step; ``redundant`` fail its filter but went earlier;
    ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` are among the removed; ``shapley`` is what the
    filter removes, summed over all orders. A part without documents has no rows.
    """
    n = len(names)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"from 1 to {MAX_FILTERS} filters")
    lists = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *_SUMS)).alias("cells"))  # at most 2^n each
    orders, before, after = order_steps(n)
    labels = ["".join(names[f] for f in order) for order in orders.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _PARTS):
                batch = whole.slice(start, _PARTS)
                parts, lists = batch.column(0), batch.column(1)
                owner = lists.value_parent_indices().to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                table = np.zeros((batch.num_rows, 1 << n, len(_SUMS)), dtype=np.int64)
                at = flat.field("mask").to_numpy(zero_copy_only=False)
                for i, name in enumerate(_SUMS):
                    table[owner, at, i] = flat.field(name).to_numpy(zero_copy_only=False)
                states = survivors(table)
                lost = states[:, before] - states[:, after]  # parts, orders, steps, sums
                failing = (states[:, :1, 0] - states[:, 1 << np.arange(n), 0])[:, orders]
                every = (1 << n) - 1
                alone = (states[:, every - (1 << np.arange(n)), 0] - states[:, every, 0, None])[:, orders]
                values = [states[:, after, 0], lost[..., 0], failing - lost[..., 0], alone, lost[..., 1], lost[..., 2], shapley(states)[:, orders]]
                rows = batch.num_rows * orders.size
                yield pa.RecordBatch.from_arrays(
                    [
                        parts.take(pa.array(np.repeat(np.arange(batch.num_rows), orders.size))),
                        pa.array(np.tile(np.repeat(labels, n), batch.num_rows).tolist(), pa.string()),
                        pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), rows // n)),
                        *(pa.array(np.ascontiguousarray(v).reshape(-1)) for v in values),
                    ],
                    names=[field.split()[0] for field in _STEP.split(", ")],
                )

    return lists.mapInArrow(run, _STEP)
