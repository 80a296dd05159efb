"""SimHash near-duplicates: a self-join of the fingerprints' binary trie within a Hamming budget.

Two nodes of the trie are visited together with the number of bits in which their prefixes differ;
a pair of nodes beyond the budget is dropped with all below it. Bits are cut into blocks, and of two
fingerprints within the budget some choice of blocks agrees exactly. So there is one bit order for
each choice, with those blocks on top: there both nodes are the same, which makes the top of the
trie a key that Spark can shuffle by. A key with very many fingerprints is split further into pairs
of its sub-nodes. Each task keeps only links that join different groups, never all pairs.

Groups of texts that share most of their shingles (``similar_groups``) are found exactly, without fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.components import components
from wordloom.llm.words import mix, slices
from wordloom.operators.lookups import fits_broadcast
from wordloom.session import bucketed, durable

SHINGLE = 3
BUDGET = 2
SEED = 42
BLOCKS = {1: (3, 1), 2: (4, 2), 3: (5, 2), 4: (6, 2), 5: (7, 2), 6: (8, 2)}  # budget: (blocks, of which equal)
HOT_KEY = 1 << 14
_MAX_SPLIT_BITS = 10
_PAIRS = 1 << 20
_SMALL = 64
SAMPLED = 1 << 13  # documents whose shingles tell which ones are frequent
FREQUENT = 1 << 17  # the most shingles that are ordered by their count
HOT_SHINGLE = 1 << 13
_SEEN = 1 << 20
SENT_BYTES = 16 << 20  # of ids, the most that is broadcast


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by one space; of all words if there are fewer."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is 1 in over half of the hashes; 0 for none."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), _PAIRS // 16):
        part = np.ascontiguousarray(hashes[start : start + _PAIRS // 16]).astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    value = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return int(value)


def lower_words(array: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text, A-Z lower-cased."""
    for text in array.to_pylist():
        yield (text or "").encode().lower().split()


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp", lanes: int = 1) -> DataFrame:
    """Add ``out``, the SimHash of the text's ``shingle``-word runs as a signed 64-bit integer.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; repeated shingles count each time. A text with
    fewer words is one shingle; NULL and empty texts have fingerprint 0. A column ``out`` is replaced.
    With several ``lanes`` it is an array of independent fingerprints, made from remixed hashes.
    """
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = []
                for words in lower_words(part.column(text)):
                    hashes = shingle_hashes(words, shingle)
                    for lane in range(lanes):
                        found.append(fingerprint(hashes if lane == 0 else mix(hashes + np.uint64(lane))))
                values = pa.array(_signed(np.array(found, dtype=np.uint64)))
                if lanes > 1:
                    values = pa.ListArray.from_arrays(pa.array(np.arange(0, len(found) + 1, lanes), pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), values], names=[*kept, out])

    kind = T.LongType() if lanes == 1 else T.ArrayType(T.LongType())
    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField(out, kind)]))


class Orders:
    """The bit orders for a budget: each puts one choice of blocks on top."""

    def __init__(self, budget: int):
        if budget not in BLOCKS:
            raise ValueError(f"the Hamming budget is one of {sorted(BLOCKS)}")
        blocks, equal = BLOCKS[budget]
        edges = [64 * i // blocks for i in range(blocks + 1)]
        self.budget = budget
        self.tops = list(combinations(range(blocks), equal))
        self.order = [[*top, *(b for b in range(blocks) if b not in top)] for top in self.tops]
        self.edges = edges
        self.masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in top) for top in self.tops]
        self.top_bits = [sum(edges[b + 1] - edges[b] for b in top) for top in self.tops]

    def arranged(self, fps: np.ndarray, number: int) -> np.ndarray:
        """Fingerprints with the bits in order ``number``, the first ones on top."""
        out = np.zeros_like(fps)
        for block in self.order[number]:
            width = self.edges[block + 1] - self.edges[block]
            piece = (fps >> np.uint64(self.edges[block])) & np.uint64((1 << width) - 1)
            out = (out << np.uint64(width)) | piece if width < 64 else piece
        return out


def trie_pairs(
    keys: np.ndarray, first: np.ndarray, second: np.ndarray, depth: int, budget: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs in sorted distinct ``keys`` that differ in at most ``budget`` bits.

    ``first`` and ``second`` are the ranges ``(lo, hi)`` of the pairs of nodes to start from; equal ranges
    mean a node with itself. Prefixes of ``depth`` bits are not split again. The visit goes depth first
    in parts of bounded size, so its memory doesn't grow with the number of pairs.
    """
    if not len(first):
        return
    top = np.uint64(0) if depth == 0 else ~np.uint64(0) << np.uint64(64 - depth)
    apart = np.bitwise_count((keys[first[:, 0]] ^ keys[second[:, 0]]) & top).astype(np.int64)
    stack = [(depth, np.concatenate([first, second, apart[:, None]], axis=1))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > _PAIRS // 8:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half]), (depth, nodes[half:])]
            continue
        sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
        same = (nodes[:, 0] == nodes[:, 2]) & (nodes[:, 1] == nodes[:, 3])
        small = (sizes <= _SMALL) | (depth >= 64)
        yield from _compare(keys, nodes[small], budget)
        nodes, same = nodes[~small], same[~small]
        if not len(nodes):
            continue
        lo1, hi1, lo2, hi2, apart = nodes.T
        bit = np.uint64(1) << np.uint64(63 - depth)
        above = ~np.uint64(0) << np.uint64(64 - depth) if depth else np.uint64(0)
        mid1 = np.clip(np.searchsorted(keys, (keys[lo1] & above) | bit), lo1, hi1)
        mid2 = np.clip(np.searchsorted(keys, (keys[lo2] & above) | bit), lo2, hi2)
        children = [
            np.stack([lo1, mid1, lo2, mid2, apart], axis=1),
            np.stack([mid1, hi1, mid2, hi2, apart], axis=1),
            np.stack([lo1, mid1, mid2, hi2, apart + 1], axis=1),
            np.stack([mid1, hi1, lo2, mid2, apart + 1], axis=1)[~same],
        ]
        found = np.concatenate(children)
        found = found[(found[:, 0] < found[:, 1]) & (found[:, 2] < found[:, 3]) & (found[:, 4] <= budget)]
        if len(found):
            stack.append((depth + 1, found))


def _compare(keys: np.ndarray, nodes: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if not len(nodes):
        return
    width = nodes[:, 3] - nodes[:, 2]
    sizes = (nodes[:, 1] - nodes[:, 0]) * width
    ends = np.cumsum(sizes)
    start = 0
    while start < len(nodes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, side="right")))
        part, n = nodes[start:stop], sizes[start:stop]
        owner = np.repeat(np.arange(len(part)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = width[start:stop][owner]
        a, b = part[owner, 0] + within // w, part[owner, 2] + within % w
        hit = (a != b) & (np.bitwise_count(keys[a] ^ keys[b]) <= budget)
        hit &= (a < b) | (part[owner, 0] != part[owner, 2])
        yield a[hit], b[hit]
        start = stop


class Groups:
    """Union-find over places, many links at a time; tells which links joined two groups."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of links that join groups that were apart."""
        used = []
        open_ = np.arange(len(a))
        while True:
            ra, rb = self.root[a[open_]], self.root[b[open_]]
            open_, ra, rb = open_[ra != rb], ra[ra != rb], rb[ra != rb]
            if not len(open_):
                return np.concatenate([np.zeros(0, np.int64), *used])
            high, one = np.unique(np.maximum(ra, rb), return_index=True)
            self.root[high] = np.minimum(ra, rb)[one]
            used.append(open_[one])
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further


def _links(
    orders: Orders, number: int, width: int, fps: np.ndarray, units: np.ndarray, node: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Links within the units of one bit order, whose keys are split by ``width`` further bits."""
    arranged = orders.arranged(fps, number)
    order = np.lexsort((arranged, units))
    arranged, fps, units, node = arranged[order], fps[order], units[order], node[order]
    starts = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]]))
    ends = np.concatenate([starts[1:], [len(units)]])
    depth = orders.top_bits[number] + width
    crossing = node[starts] >> 32 != node[starts] & 0xFFFFFFFF if width else np.zeros(len(starts), bool)
    groups = Groups(len(fps))

    def kept(pairs: Iterator[tuple[np.ndarray, np.ndarray]], base: int = 0) -> Iterator[pa.RecordBatch]:
        for a, b in pairs:
            used = groups.join(a + base, b + base)
            if len(used):
                ends = [pa.array(_signed(fps[x[used] + base])) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    sizes = ends - starts
    small = (sizes >= 2) & (sizes * sizes <= _SMALL) & ~crossing
    nodes = np.stack([starts, ends, starts, ends, np.zeros(len(starts), np.int64)], axis=1)
    large = np.flatnonzero((sizes >= 2) & ~small)
    for limit in sorted({min(2, orders.budget), orders.budget}):
        yield from kept(_compare(arranged, nodes[small], limit))
        for i in large.tolist():
            lo, hi = int(starts[i]), int(ends[i])
            keys = arranged[lo:hi]
            first = second = np.array([[0, hi - lo]])
            if crossing[i]:
                other = np.flatnonzero((keys ^ keys[0]) >> np.uint64(64 - depth))
                if not len(other):
                    continue
                first, second = np.array([[0, other[0]]]), np.array([[other[0], hi - lo]])
            yield from kept(trie_pairs(keys, first, second, depth, limit), lo)


def links(nodes: DataFrame, budget: int = BUDGET, fp: str = "fp", hot_key: int = HOT_KEY) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all within ``budget`` bits.

    Any two fingerprints within the budget are connected, closer ones first, by links within it. A key
    of more than ``hot_key`` fingerprints is split into pairs of sub-nodes.
    """
    orders = Orders(budget)
    tops = F.array(
        *[
            F.struct(F.lit(i).alias("number"), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64))).alias("key"))
            for i, m in enumerate(orders.masks)
        ]
    )
    rows = nodes.filter(F.col(fp).isNotNull()).select(F.col(fp).alias("fp")).distinct().select("fp", F.inline(tops))
    hot = durable(rows.groupBy("number", "key").count().filter(F.col("count") > hot_key), "hot-keys")
    units = rows.withColumn("node", F.lit(0).cast("long")).withColumn("bits", F.lit(0))
    if not hot.isEmpty():
        cold = rows.join(hot, ["number", "key"], "left_anti").select("fp", "number", "key", F.lit(0).cast("long").alias("node"), F.lit(0).alias("bits"))
        split = rows.join(hot, ["number", "key"]).mapInArrow(
            lambda batches: _split(orders, hot_key, batches), "fp long, number int, key long, node long, bits int"
        )
        units = cold.unionByName(split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit_rows in _whole_units(batches):
            number, bits = unit_rows["number"], unit_rows["bits"]
            for n in np.unique(number):
                for width in np.unique(bits[number == n]):
                    chosen = (number == n) & (bits == width)
                    fps, unit, node = (unit_rows[c][chosen] for c in ("fp", "unit", "node"))
                    yield from _links(orders, int(n), int(width), fps.view(np.uint64), unit, node)

    key = ["number", "key", "node"]
    return units.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def _split(orders: Orders, hot_key: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of hot keys, one for each pair of sub-nodes within the budget that a fingerprint belongs to."""
    for batch in batches:
        fps, number, key, count = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "number", "key", "count"))
        width = np.minimum(_MAX_SPLIT_BITS, np.ceil(np.log2(count / hot_key)).astype(np.int64) + 1)
        for n in np.unique(number):
            for w in np.unique(width[number == n]).tolist():
                at = np.flatnonzero((number == n) & (width == w))
                arranged = orders.arranged(fps[at].view(np.uint64), int(n))
                own = ((arranged >> np.uint64(64 - orders.top_bits[n] - w)) & np.uint64((1 << w) - 1)).astype(np.int64)
                for flips in range(orders.budget + 1):
                    for changed in combinations(range(w), flips):
                        other = own ^ sum(1 << i for i in changed)
                        node = (np.minimum(own, other) << 32) | np.maximum(own, other)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(fps[at]),
                                pa.array(number[at].astype(np.int32)),
                                pa.array(key[at]),
                                pa.array(node),
                                pa.array(np.full(len(at), w, dtype=np.int32)),
                            ],
                            names=["fp", "number", "key", "node", "bits"],
                        )


def _whole_units(
    batches: Iterator[pa.RecordBatch],
    names: tuple[str, ...] = ("fp", "number", "key", "node", "bits"),
    unit: tuple[str, ...] = ("number", "key", "node"),
) -> Iterator[dict[str, np.ndarray]]:
    """Arrays of rows that never cut a unit; ``unit`` numbers the units."""
    waiting: list[dict[str, np.ndarray]] = []

    def changes(rows: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c in unit])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        waiting.append(rows)
        if all(rows[c][0] == waiting[0][c][0] and rows[c][-1] == waiting[0][c][0] for c in unit):
            continue
        carried = {c: np.concatenate([w[c] for w in waiting]) for c in names}
        last = int(np.flatnonzero(changes(carried))[-1]) + 1
        done = {c: v[:last] for c, v in carried.items()}
        done["unit"] = np.concatenate([[0], np.cumsum(changes(done))])
        yield done
        waiting = [{c: v[last:] for c, v in carried.items()}]
    if waiting:
        rest = {c: np.concatenate([w[c] for w in waiting]) for c in names}
        if len(rest[names[0]]):
            rest["unit"] = np.concatenate([[0], np.cumsum(changes(rest))])
            yield rest


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, budget: int = BUDGET
) -> DataFrame:
    """``(key, fingerprint, component_id)`` of every row: fingerprints link at ``budget`` or fewer bits.

    ``fingerprint`` is 16 lower-case hex digits. ``component_id`` is the smallest key that can be reached,
    itself included; NULL keys are no candidates for it, so a component of only NULL keys has NULL.
    Repeated rows are kept and share a fingerprint, and so do NULL and empty texts, whose fingerprint 0
    links like any other. Very long texts are hashed whole. Other columns play no part.
    """
    slim = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    marked = durable(fingerprints(slim, "_text", shingle, "_fp").drop("_text"), "fingerprints")
    nodes = durable(marked.groupBy("_fp").agg(F.min("_key").alias("_least")), "nodes")
    roots = components(links(nodes, budget, "_fp")).select(F.col("node").alias("_fp"), F.col("root").alias("_root"))
    named = nodes.join(roots, "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_fp = named.join(least, "_root").select("_fp", "component_id")
    digits = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return marked.join(by_fp, "_fp").select(F.col("_key").alias(key), digits, "component_id")


def _name(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set of shingles."""
    digest = xxhash.xxh128_intdigest(own.tobytes())
    return digest & ((1 << 64) - 1), digest >> 64


def shingle_sets(df: DataFrame, text: str, shingle: int, out: str = "shingles") -> DataFrame:
    """``(name, out)``: the digest and the distinct 32-bit hashes of each text's ``shingle``-word runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                whole = [np.unique(shingle_hashes(w, shingle)) for w in lower_words(part.column(text))]
                names = _signed(np.array([_name(own)[0] for own in whole], dtype=np.uint64))
                sets = [np.unique(own.astype(np.uint32)) for own in whole]
                ends = np.cumsum([0, *map(len, sets)])
                values = np.concatenate([np.zeros(0, np.uint32), *sets]).view(np.int32)
                arrays = [pa.array(names), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", out])

    return df.select(text).mapInArrow(run, f"name long, {out} array<int>")


def frequent_shingles(df: DataFrame, text: str, key: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, sorted, and in how many. They only set an order."""
    step = max(1, df.count() // SAMPLED)
    sample = df.filter(F.pmod(F.xxhash64(key), F.lit(step)) == 0).select(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = [np.unique(shingle_hashes(w, shingle)) for w in lower_words(part.column(text))]
                values = pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *sets])))
                yield pa.RecordBatch.from_arrays([values], names=["shingle"])

    counts = sample.mapInArrow(run, "shingle long").groupBy("shingle").count().filter("count > 2")
    rows = counts.orderBy(F.desc("count"), "shingle").limit(FREQUENT).collect()
    found = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], np.array([r[1] for r in rows], dtype=np.int64)[order]


def prefix_size(size: int, similarity: float) -> int:
    """Two sets of at least this similarity share one of their first ``prefix_size`` members, in any one order."""
    return size - math.ceil(similarity * size - 1e-9) + 1


def shingle_prefixes(
    df: DataFrame, text: str, key: str, similarity: float, shingle: int, often: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """``(key, name, rest, size, prefix)``: digests, number and first members of each text's set of shingles.

    The order of the members is by their count in ``often``, the rare ones first. A set that the same task
    has met before has no prefix.
    """
    hashes, counts = often

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(batch, text):
                names, sizes, prefixes = [], [], []
                for words in lower_words(part.column(text)):
                    own = np.unique(shingle_hashes(words, shingle))
                    name = _name(own)
                    names.append(name)
                    sizes.append(len(own))
                    if name in seen or not len(own):
                        prefixes.append(own[:0])
                        continue
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(name)
                    if len(hashes):
                        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                        own = own[np.argsort(np.where(hashes[at] == own, counts[at], 0), kind="stable")]
                    prefixes.append(own[: prefix_size(len(own), similarity)])
                digests = np.array(names, dtype=np.uint64).reshape(-1, 2)
                ends = np.cumsum([0, *map(len, prefixes)])
                values = pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *prefixes])))
                arrays = [
                    part.column(key),
                    *(pa.array(_signed(np.ascontiguousarray(digests[:, i]))) for i in (0, 1)),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "name", "rest", "size", "prefix"])

    added = [T.StructField(n, T.LongType()) for n in ("name", "rest")]
    added += [T.StructField("size", T.IntegerType()), T.StructField("prefix", T.ArrayType(T.LongType()))]
    return df.select(key, text).mapInArrow(run, T.StructType([df.schema[key], *added]))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``shingle`` those whose shingle is in several rows."""
    last, matched = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks().to_batches()[0]
        shingle = table.column(0).to_numpy()
        same = shingle[1:] == shingle[:-1]
        keep = np.zeros(len(shingle), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= matched
        yield table.slice(0, len(shingle) - 1).filter(pa.array(keep[:-1]))
        last, matched = table.slice(len(shingle) - 1), bool(keep[-1])
    if matched:
        yield last


_SHARED = ("shingle", "low", "high", "block", "name", "place", "size", "root")


def _open_pairs(rows: dict[str, np.ndarray], similarity: float, turn: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names of pairs in a unit, of different roots, that may reach ``similarity``.

    A pair passes at the first shingle that both prefixes have, if what comes behind it in both sets is
    enough. Without ``turn`` all pairs, otherwise only neighbours in an order of that turn.
    """
    by = rows["size"] if turn is None else mix(rows["name"].view(np.uint64) ^ mix(rows["shingle"].view(np.uint64) + np.uint64(turn)))
    order = np.lexsort((rows["name"], by, rows["unit"]))
    rows = {c: v[order] for c, v in rows.items()}
    new = np.ones(len(order), bool)
    new[1:] = (rows["unit"][1:] != rows["unit"][:-1]) | (rows["name"][1:] != rows["name"][:-1])
    rows = {c: v[new] for c, v in rows.items()}
    unit, name, size, root = (rows[c] for c in ("unit", "name", "size", "root"))
    size, left = size.astype(np.int64), size.astype(np.int64) - rows["place"]
    share = similarity / (1 + similarity)

    def fit(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good = (root[i] != root[j]) & (np.minimum(left[i], left[j]) >= share * (size[i] + size[j]) - 1e-9)
        good &= (rows["low"][i] == rows["high"][i]) | (rows["block"][i] != rows["block"][j])
        return name[i[good]], name[j[good]]

    if turn is not None:
        i = np.flatnonzero(unit[1:] == unit[:-1])
        yield fit(i, i + 1)
        return
    most = np.floor(size / similarity + 1e-9).astype(np.int64)
    stop = np.searchsorted((unit << 32) + size, (unit << 32) + most, side="right")
    here = np.arange(len(unit))
    ends = np.cumsum(stop - here - 1)
    start = 0
    while start < len(unit):
        to = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, side="right")))
        n = (stop - here - 1)[start:to]
        i = np.repeat(here[start:to], n)
        yield fit(i, i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        start = to


def open_pairs(
    shared: DataFrame, roots: DataFrame | None, similarity: float, turn: int | None = None, hot: int = HOT_SHINGLE
) -> DataFrame:
    """``(a, b)``: names that share a member of their prefixes, may be similar and have different roots.

    A shingle in more than ``hot`` prefixes is dealt to pairs of blocks (in a turn to blocks), so that no task
    has all its rows.
    """
    rows = shared.withColumn("root", F.col("name"))
    if roots is not None:
        known = sent_if_small(roots.select(F.col("node").alias("name"), F.col("root").alias("_root")), ["name", "_root"])
        rows = shared.join(known, "name", "left").withColumn("root", F.coalesce("_root", "name"))
    zero = F.lit(0)
    placed = rows.select("shingle", zero.alias("low"), zero.alias("high"), zero.alias("block"), *_SHARED[4:])
    counts = durable(shared.groupBy("shingle").count().filter(F.col("count") > hot), "hot-shingles")
    if not counts.isEmpty():
        cold = placed.join(counts, "shingle", "left_anti").select(*_SHARED)
        blocks = rows.join(counts, "shingle").withColumn("_n", F.ceil(F.col("count") / hot).cast("int"))
        blocks = blocks.withColumn("block", F.pmod(F.xxhash64("name", F.lit(turn or 0)), F.col("_n")).cast("int"))
        other = F.col("block") if turn is not None else F.explode(F.sequence(zero, F.col("_n") - 1))
        blocks = blocks.withColumn("_other", other)
        blocks = blocks.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
        placed = cold.unionByName(blocks.select(*_SHARED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit_rows in _whole_units(batches, _SHARED, _SHARED[:3]):
            for a, b in _open_pairs(unit_rows, similarity, turn):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    unit = list(_SHARED[:3])
    return placed.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "a long, b long").distinct()


def sent_if_small(table: DataFrame, columns: list[str], limit: int = SENT_BYTES) -> DataFrame:
    """``table``, written, with a broadcast hint if its measured size is below ``limit``; otherwise it is shuffled."""
    held = durable(table.select(*columns), "side")
    return F.broadcast(held) if fits_broadcast(held, columns, limit) else held


def similar_groups(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    similarity: float = 0.8,
    shingle: int = 5,
    hot: int = HOT_SHINGLE,
) -> DataFrame:
    """``(key, component_id)`` of every key that is in a group of near-duplicates, with its smallest key.

    Two texts are near-duplicates if the Jaccard similarity of their distinct ``shingle``-word runs, compared by
    32-bit hashes, reaches ``similarity``; groups are what such pairs connect. No pair is lost: in one order
    of all shingles, two sets that similar share one of their first members (``prefix_size``), and
    every pair that does is compared unless its two texts are in one group by compared links already. Texts with
    the same set are one from the start. First, neighbours in turns of random orders are compared, as long
    as most of them are similar, so that large groups don't need all their pairs.

    Rows that repeat a key are one document, which has the links of all its rows.
    NULL keys are in no group. NULL and empty texts are near-duplicates of each other.
    """
    known = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    often = frequent_shingles(known, "_text", "_key", shingle)
    marked = durable(shingle_prefixes(known, "_text", "_key", similarity, shingle, often), "prefixes")
    nodes = durable(marked.groupBy("name", "rest").agg(F.min("_key").alias("_least")), "nodes")
    members = marked.select("name", "size", F.posexplode("prefix").alias("place", "shingle")).select("shingle", "name", "place", "size")
    dealt = members.repartition("shingle").sortWithinPartitions("shingle")
    shared = durable(dealt.mapInArrow(_repeated, members.schema), "shared")

    def alike(pairs: DataFrame) -> DataFrame:
        # A pair's first end is either of the two, so that a text with very many pairs isn't one side of all.
        swap = F.xxhash64("a", "b") % 2 == 0
        turned = pairs.select(F.when(swap, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("b"))
        names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        wanted = sent_if_small(nodes.join(names, "name", "left_semi").select(F.col("_least").alias("_key")).distinct(), ["_key"])
        made = shingle_sets(known.join(wanted, "_key", "left_semi"), "_text", shingle).groupBy("name").agg(F.first("shingles").alias("s"))
        sets = bucketed(made, ["name"], "shingles")
        compared = turned.join(sets.select(F.col("name").alias("a"), F.col("s").alias("s1")), "a").join(
            sets.select(F.col("name").alias("b"), F.col("s").alias("s2")), "b"
        )
        both = F.size(F.array_intersect("s1", "s2"))
        union = F.size("s1") + F.size("s2") - both
        return durable(compared.filter(both >= F.lit(similarity) * union).select("a", "b"), "alike")

    found, roots, turn = None, None, 0
    while True:
        pairs = durable(open_pairs(shared, roots, similarity, turn, hot), "pairs")
        compared, right = pairs.count(), 0
        if compared:
            new = alike(pairs)
            right = new.count()
        if right:
            found = new if found is None else found.unionByName(new)
        if turn is None:
            break
        if right:
            roots = components(found)
        turn = turn + 1 if 2 * right > compared else None
    ends = ["name", "rest"]
    links_ = marked.select("_key", *ends).join(nodes, ends).select(F.col("_least").alias("a"), F.col("_key").alias("b"))
    if found is not None:
        first, second = (nodes.select(F.col("name").alias(c), F.col("_least").alias(f"_{c}")) for c in ("a", "b"))
        links_ = links_.unionByName(found.join(first, "a").join(second, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return components(links_.filter("a <> b")).select(F.col("node").alias(key), F.col("root").alias("component_id"))
