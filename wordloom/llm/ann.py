"""Nearest neighbours by cosine with randomly rotated one-bit codes.

A unit vector is turned by a fixed random rotation and kept as the signs of its coordinates, packed
into bits, with one correction: how much of the vector its code holds. From it comes an unbiased
estimate of every inner product and a bound on its error; the vectors of the best estimates are compared exactly,
and then only those whose upper bound reaches the k-th best of them. Queries and vectors meet in blocks of bounded size, and each
pair of blocks sends on its k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.session import durable

TOP = 5
QUERY_ROWS = 1024
BLOCK_ROWS = 4096
DEVIATIONS = 3.0  # width of the error bound
_FIRST_LOOK = 32
SEED = 20
_PAIRS = 1 << 22


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for all tasks."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the inner product of each with its code."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ turn.T
    held = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), held.astype(np.float64)


def bounds(queries: np.ndarray, codes: np.ndarray, held: np.ndarray, turn: np.ndarray, deviations: float = DEVIATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of every query with every code, and the half width of its error bound."""
    dim = queries.shape[1]
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = ((unit @ turn.T).astype(np.float32) @ signs.T) / np.sqrt(dim) / held
    width = deviations * np.sqrt(np.maximum(0.0, 1 - held**2)) / held / np.sqrt(max(1, dim - 1))
    return estimate, width


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of ``a`` and ``b`` in double precision."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search_blocks(
    queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray,
    codes: np.ndarray, held: np.ndarray, turn: np.ndarray, top: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of the queries: number of the query, number of the vector and exact score of its best."""
    step = max(1, _PAIRS // max(1, len(vectors)))
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        estimate, width = bounds(part, codes, held, turn)
        own = query_rows[start : start + step, None] == rows[None, :]
        estimate[own] = -np.inf
        n, first = estimate.shape[1], max(_FIRST_LOOK, 2 * top)
        if n > first:
            # The exact scores of the most promising vectors give a threshold that is no guess.
            ahead = np.argpartition(estimate, n - first, axis=1)[:, n - first :]
            seen = cosine(np.repeat(part, first, axis=0), vectors[ahead.ravel()]).reshape(len(part), first)
            seen[np.take_along_axis(own, ahead, axis=1)] = -np.inf
            least = np.partition(seen, first - top, axis=1)[:, first - top]
        else:
            least = np.full(len(part), -np.inf)
        # Single precision may round an estimate a little.
        q, v = np.nonzero((estimate + width + 1e-5 >= least[:, None]) & ~own)
        score = np.zeros(len(q))
        for i in range(0, len(q), _PAIRS // 64):
            some = slice(i, i + _PAIRS // 64)
            score[some] = cosine(part[q[some]], vectors[v[some]])
        order = np.lexsort((rows[v], ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        best = rank < top
        yield q[best] + start, v[best], score[best]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def index(df: DataFrame, id: str, vector: str, dim: int | None = None) -> DataFrame:
    """The written index: ``row, id, vector, code, held`` of every usable row."""
    usable = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(_usable(F.col("vector")))
    if dim is None:
        sizes = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dim = sizes["n"] if sizes else 1
    numbered = usable.filter(F.size("vector") == dim).withColumn("row", F.monotonically_increasing_id())
    turn = rotation(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            codes, held = encode(vectors, turn) if len(vectors) else (np.zeros((0, 1), np.uint8), np.zeros(0))
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(held)], names=["id", "vector", "row", "code", "held"])

    return durable(numbered.mapInArrow(run, "id long, vector array<double>, row long, code binary, held double"), "codes")


def nearest(
    df: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", top: int = TOP,
    query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS, dim: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``top`` nearest rows of each query row.

    ``is_query`` is a condition on the id. Every row is indexed and every other row is a candidate, a
    repeated one with the query's own id too; with fewer candidates than ``top`` all are returned. The score is the
    cosine of the original vectors in double precision; ties go to the smaller id. Vectors that are
    NULL, zero, of another length than most, or hold NULL or non-finite components take no part, and
    neither do NULL ids. Other columns play no part.
    """
    codes = index(df.filter(F.col(id).isNotNull()), id, vector, dim)
    named = codes.withColumnRenamed("id", id)
    asked = named.filter(is_query).withColumnRenamed(id, "id")
    counts = [int(x.count()) for x in (codes, asked)]
    n_blocks, n_parts = (max(1, -(-n // size)) for n, size in zip(counts, (block_rows, query_rows)))
    dim_now = codes.select(F.size("vector").alias("n")).first()
    turn = rotation(dim_now["n"] if dim_now else 1)
    # Hashed row numbers deal evenly, whatever the ids are; every block meets every part of the queries.
    # Both sides' keys have one type, or equal numbers would be dealt to different tasks.
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")
    part = F.pmod(F.xxhash64(F.lit("query"), "row"), F.lit(n_parts)).cast("int")
    left = codes.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))
    right = asked.select(
        F.col("id").alias("query_id"), F.col("row").alias("query_row"), F.col("vector").alias("query"),
        part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
    )

    def run(block_table: pa.Table, query_table: pa.Table) -> pa.Table:
        names = ["query_id", "query_row", "vec_id", "row", "score"]
        if not block_table.num_rows or not query_table.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})

        def matrix(table: pa.Table, name: str) -> np.ndarray:
            return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

        def numbers(table: pa.Table, name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        bits = np.frombuffer(b"".join(block_table.column("code").to_pylist()), np.uint8).reshape(block_table.num_rows, -1)
        ids, rows = numbers(block_table, "id"), numbers(block_table, "row")
        query_ids, query_numbers = numbers(query_table, "query_id"), numbers(query_table, "query_row")
        found = search_blocks(
            matrix(query_table, "query"), query_numbers, matrix(block_table, "vector"), ids, rows, bits, numbers(block_table, "held"), turn, top
        )
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        for q, v, score in found:
            for column, values in zip(columns, (query_ids[q], query_numbers[q], ids[v], rows[v], score)):
                column.append(values)
        return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(names, columns)})

    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        run, "query_id long, query_row long, vec_id long, row long, score double"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
