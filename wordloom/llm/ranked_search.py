"""Ranked lexical search: Block-Max MaxScore over compressed posting lists, shard by shard.

A shard is what a task reads until it has a bounded amount of text. Its index is one row: the lengths of its
documents, and for each term the list of documents in blocks, with the largest impact of each block outside the
compressed part. A query goes through the documents of a shard in windows. The bounds of whole lists tell which
lists are essential, that is needed for a document to reach the best found so far; only these propose
documents. For the others the block's bound is asked first, and blocks without a document left stay
compressed. The best of all shards are merged in the end.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.bpe import release_memory
from wordloom.llm.words import slices, text_bytes
from wordloom.operators.ids import dense_id
from wordloom.operators.lookups import fits_broadcast
from wordloom.session import durable

TOP = 50
SHARD_BYTES = 32 << 20  # of text
BLOCK = 128  # postings
QUERY_ROWS = 1024
ASKED_BYTES = 16 << 20  # of distinct query terms, the most that are sent to all tasks
FIRST_WINDOW = 512  # documents; later windows are larger
# Bytes of a term, A-Z lower-cased; scale of an impact; saturation; share of the length.
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLDED = bytes(b + 32 if 0x41 <= b <= 0x5A else b if _TERM[b] else 0x20 for b in range(256))
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 20, 50


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in order: runs of letters, digits and all that isn't ASCII, A-Z lower-cased."""
    return text.translate(_FOLDED).split()


def count_terms(array: pa.Array) -> np.ndarray:
    bounds, data = text_bytes(array)
    inside = _TERM[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    starts[edges] = inside[edges]  # a term ends with its text
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(docs: DataFrame, text: str) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.concatenate([np.zeros(0, np.int64), *(count_terms(p.column(0)) for p in slices(batch, text))])
            yield pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], names=["n", "l"])

    row = docs.select(text).mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return row[0] or 0, row[1] or 0


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // max(1, n_terms)


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + SATURATION * norms)


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def pack_list(docs: np.ndarray, tf: np.ndarray, norms: np.ndarray) -> tuple[bytes, int]:
    """A posting list as bytes, and its largest impact.

    Sizes, then first document and largest impact of each block, then distances from the block's first
    document and frequencies, each in the fewest bytes that hold the list's largest.
    """
    heads = np.arange(0, len(docs), BLOCK)
    most = np.maximum.reduceat(impacts(tf, norms[docs]), heads)
    far = _narrow(docs - np.repeat(docs[heads], np.diff([*heads, len(docs)])))
    often = _narrow(tf)
    sizes = np.array([len(docs), far.itemsize, often.itemsize], dtype=np.int32)
    parts = [sizes, docs[heads].astype(np.int32), most.astype(np.int32), far, often]
    return b"".join(p.tobytes() for p in parts), int(most.max())


class Postings:
    """A packed list; only sizes and block bounds are read until documents are asked for."""

    def __init__(self, data: bytes, weight: int, bound: int):
        self.data, self.weight, self.bound = data, weight, bound * weight
        self.size, self.far_width, self.often_width = np.frombuffer(data, np.int32, 3).tolist()
        blocks = -(-self.size // BLOCK)
        self.first = np.frombuffer(data, np.int32, blocks, 12)
        self.most = np.frombuffer(data, np.int32, blocks, 12 + 4 * blocks)
        self.begin = 12 + 8 * blocks

    def blocks_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that may hold each document; -1 before the first."""
        return np.searchsorted(self.first, docs, side="right") - 1

    def block_bounds(self, blocks: np.ndarray) -> np.ndarray:
        return np.where(blocks >= 0, self.most[blocks].astype(np.int64) * self.weight, 0)

    def scores(self, blocks: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their scores in these ascending blocks, which are decompressed."""
        if not len(blocks):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.minimum(self.size - blocks * BLOCK, BLOCK)
        if int(blocks[-1]) - int(blocks[0]) + 1 == len(blocks):
            at = slice(int(blocks[0]) * BLOCK, int(blocks[0]) * BLOCK + int(sizes.sum()))
        else:
            at = (np.repeat(blocks * BLOCK - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()))
        far = np.frombuffer(self.data, f"u{self.far_width}", self.size, self.begin)[at]
        tf = np.frombuffer(self.data, f"u{self.often_width}", self.size, self.begin + self.size * self.far_width)[at].astype(np.int64)
        docs = np.repeat(self.first[blocks].astype(np.int64), sizes) + far
        return docs, self.weight * impacts(tf, norms[docs])


@dataclass
class Best:
    """The ``top`` best documents so far, by score and then ``order``."""

    top: int
    order: np.ndarray
    docs: np.ndarray
    scores: np.ndarray
    least: int = 0  # a document below this score can't be among them

    @classmethod
    def none(cls, top: int, order: np.ndarray) -> Best:
        return cls(top, order, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        if len(docs) > self.top:
            chosen = np.lexsort((self.order[docs], -scores))[: self.top]
            docs, scores = docs[chosen], scores[chosen]
        self.docs, self.scores = docs, scores
        if len(docs) == self.top:
            self.least = int(scores.min())


def search_shard(lists: list[Postings], norms: np.ndarray, order: np.ndarray, top: int) -> Best:
    """The best documents of a shard for the posting lists of one query; ties go by ``order``."""
    best = Best.none(top, order)
    lists = sorted((p for p in lists if p.weight > 0), key=lambda p: p.bound)
    if not lists:
        return best
    upto = np.cumsum([p.bound for p in lists])  # the most that this list and all below it can add
    low, width = 0, FIRST_WINDOW
    while low < len(norms):
        high = min(low + width, len(norms))
        essential = int(np.searchsorted(upto, max(best.least, 1)))  # lists below can't reach the score together
        if essential == len(lists):
            return best
        summed = np.zeros(high - low, dtype=np.int64)
        for p in lists[essential:]:
            a, b = int(p.blocks_of(low)), int(p.blocks_of(high - 1))
            docs, scores = p.scores(np.arange(max(a, 0), b + 1), norms)
            inside = slice(*np.searchsorted(docs, (low, high)))
            summed[docs[inside] - low] += scores[inside]
        found = np.flatnonzero(summed)
        scores, found = summed[found], found + low
        for i in range(essential - 1, -1, -1):
            p, rest = lists[i], int(upto[i - 1]) if i else 0
            open_ = scores + p.bound + rest >= best.least
            found, scores = found[open_], scores[open_]
            blocks = p.blocks_of(found)
            open_ = scores + p.block_bounds(blocks) + rest >= best.least
            found, scores, blocks = found[open_], scores[open_], blocks[open_]
            if not len(found):
                break
            docs, added = p.scores(np.unique(blocks[blocks >= 0]), norms)
            at = np.searchsorted(docs, found)
            at[at == len(docs)] = 0
            hit = docs[at] == found if len(docs) else np.zeros(len(found), bool)
            scores = scores + np.where(hit, added[at], 0) if len(docs) else scores
        enough = scores >= max(best.least, 1)
        best.add(found[enough], scores[enough])
        low, width = high, min(2 * width, 8 * FIRST_WINDOW)
    return best


class Shard:
    """Collects the documents of one shard."""

    def __init__(self, asked: frozenset[bytes] | None):
        self.asked = asked
        self.size, self.ids, self.lengths = 0, [], []
        self.docs, self.tf = defaultdict(list), defaultdict(list)

    def add(self, key: object, text: bytes) -> None:
        terms = terms_of(text)
        self.size += len(text)
        if not terms:
            return
        number = len(self.ids)
        self.ids.append(key)
        self.lengths.append(len(terms))
        counts = Counter(terms)
        for term in counts if self.asked is None else self.asked.intersection(counts):
            self.docs[term].append(number)
            self.tf[term].append(counts[term])

    def row(self, shard: int, kind: pa.DataType, n_docs: int, n_terms: int) -> pa.RecordBatch:
        norms = length_norms(np.array(self.lengths, dtype=np.int64), n_docs, n_terms)
        terms = sorted(self.docs)
        packed = [pack_list(np.array(self.docs[t]), np.array(self.tf[t], dtype=np.int64), norms) for t in terms]
        columns = {
            "shard": pa.array([shard], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(kind)),
            "norms": pa.array([norms.tobytes()], pa.binary()),
            "terms": pa.array([[t.decode() for t in terms]], pa.list_(pa.string())),
            "df": pa.array([[len(self.docs[t]) for t in terms]], pa.list_(pa.int64())),
            "bounds": pa.array([[bound for _, bound in packed]], pa.list_(pa.int64())),
            "postings": pa.array([[data for data, _ in packed]], pa.list_(pa.binary())),
        }
        return pa.RecordBatch.from_pydict(columns)


def build_index(
    docs: DataFrame, n_docs: int, n_terms: int, asked: DataFrame | None = None, text: str = "text", key: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The written index of all texts, one row per shard.

    With ``asked``, a column ``term``, only these terms get lists, as long as they measure less than
    ``ASKED_BYTES``; beyond that all terms do.
    """
    kind = docs.schema[key].dataType.simpleString()
    only = None
    if asked is not None and fits_broadcast(asked, ["term"], ASKED_BYTES):
        only = frozenset(r["term"].encode() for r in asked.select("term").collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(only), TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, text):
                for name, value in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    shard.add(name, (value or "").encode())
                if shard.size >= shard_bytes:
                    yield shard.row(number, piece.column(0).type, n_docs, n_terms)
                    shard, number = Shard(only), number + 1
                    release_memory()
        if shard.ids:
            yield shard.row(number, piece.column(0).type, n_docs, n_terms)
        del shard
        release_memory()

    return durable(
        docs.select(key, text).mapInArrow(
            run,
            f"shard long, ids array<{kind}>, norms binary, terms array<string>, df array<long>, bounds array<long>, postings array<binary>",
        ),
        "index",
    )


def query_terms(queries: DataFrame, text: str, id: str) -> DataFrame:
    """The written queries ``query, id, terms``: distinct terms, one row for rows with the same id and text."""
    named = queries.select(
        F.sha2(F.to_json(F.struct(F.col(id).alias("i"), F.col(text).alias("t"))), 256).alias("query"),
        F.col(id).alias("id"), F.col(text).alias("text"),
    ).dropDuplicates(["query"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [sorted({t.decode() for t in terms_of((text or "").encode())}) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cut, pa.list_(pa.string()))], names=["query", "id", "terms"])

    kind = named.schema["id"].dataType.simpleString()
    return durable(named.mapInArrow(run, f"query string, id {kind}, terms array<string>"), "queries")


def _order(ids: list) -> np.ndarray:
    """The rank of each document by id, NULL last, rows with one id by their place."""
    out = np.empty(len(ids), dtype=np.int64)
    out[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, i))] = np.arange(len(ids))
    return out


def rank(
    docs: DataFrame, queries: DataFrame, text: str = "text", key: str = "doc_id", query_text: str = "text",
    query_id: str = "item_id", top: int = TOP, shard_bytes: int = SHARD_BYTES, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, key, score)``: for each query its ``top`` documents with the highest scores above 0.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the whole text, A-Z lower-cased. With N documents that
    have a term, L terms of them all, n of one document, df documents with a term and tf its occurrences in one:
    w = floor(1000 ln((2N+2)/(2df+1))), m = 50 + 50nN div L, and the score is the sum of w ((10^9 tf) div (1000 tf + 20 m))
    over the distinct terms of the query. Equal scores go by ascending key, NULL last.

    NULL and empty texts have no terms: such documents are not found and such queries find nothing. Repeated
    documents stand for themselves. Queries that repeat id and text are one; those that share only the id are
    ranked apart. Other columns play no part. ``key`` is a number.
    """
    asked = query_terms(queries, query_text, query_id)
    words = asked.select(F.explode("terms").alias("term")).distinct()
    n_docs, n_terms = statistics(docs, text)
    index = build_index(docs, n_docs, n_terms, words, text, key, shard_bytes)
    listed = index.select(F.explode(F.arrays_zip("terms", "df")).alias("l")).select("l.terms", "l.df")
    found = listed.groupBy(F.col("terms").alias("term")).agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).alias("weight")
    weighed = (
        asked.select("query", "id", F.explode("terms").alias("term"))
        .join(found, "term")
        .groupBy("query", "id")
        .agg(F.collect_list(F.struct("term", weight)).alias("terms"))
    )
    weighed = durable(weighed, "weighed")
    numbered = dense_id(index.select("shard"), ["shard"], out="number")
    n_shards, n_parts = index.count(), max(1, -(-weighed.count() // query_rows))
    # Every shard meets every part of the queries; both sides' keys have one type.
    left = index.join(numbered.select("shard", F.col("number").cast("int").alias("number")), "shard").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))
    )
    right = weighed.select(
        "query", "id", "terms", F.pmod(F.xxhash64("query"), F.lit(n_parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(max(0, n_shards - 1)))).alias("number"),
    )
    kinds = {c: d.schema[n].dataType.simpleString() for c, d, n in (("id", queries, query_id), ("doc", docs, key))}
    names = ["query", "id", "doc", "place", "shard", "score"]

    def run(shards: pa.Table, part: pa.Table) -> pa.Table:
        rows = []
        if shards.num_rows and part.num_rows:
            shard = shards.to_pylist()[0]
            ids, norms = shard["ids"], np.frombuffer(shard["norms"], np.int64)
            order, at = _order(ids), {t: i for i, t in enumerate(shard["terms"])}
            for name, own, terms in zip(*(part.column(c).to_pylist() for c in ("query", "id", "terms"))):
                held = [(at[t["term"]], t["weight"]) for t in terms if t["term"] in at]
                best = search_shard([Postings(shard["postings"][i], w, shard["bounds"][i]) for i, w in held], norms, order, top)
                rows += [(name, own, ids[d], d, shard["shard"], s) for d, s in zip(best.docs.tolist(), best.scores.tolist())]
        types = [pa.string(), part.column("id").type, shards.column("ids").type.value_type, pa.int64(), pa.int64(), pa.int64()]
        return pa.table({n: pa.array([r[i] for r in rows], types[i]) for i, n in enumerate(names)})

    heaps = left.groupBy("number", "part").cogroup(right.groupBy("number", "part")).applyInArrow(
        run, f"query string, id {kinds['id']}, doc {kinds['doc']}, place long, shard long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "shard", "place")
    return (
        heaps.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select(F.col("id").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score")
    )
