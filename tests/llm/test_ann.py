import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import ann
from wordloom.llm.queries import QUERIES


def brute_force(rows, is_query, top):
    """(query, rank, id, score): rows are (id, vector); every other row is a candidate."""
    out = []
    for i, (q, v) in enumerate(rows):
        if not is_query(q):
            continue
        a = np.array([v])
        scored = [(-float(ann.cosine(a, np.array([w]))[0]), k) for j, (k, w) in enumerate(rows) if j != i]
        out += [(q, rank, k, -s) for rank, (s, k) in enumerate(sorted(scored)[:top], 1)]
    return out


def test_bounds_hold():
    rng = np.random.default_rng(0)
    vectors, queries = rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, held = ann.encode(vectors, turn)
    assert codes.shape == (2000, 8)
    estimate, width = ann.bounds(queries, codes, held, turn)
    exact = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T
    assert (np.abs(estimate - exact) <= width).mean() > 0.99
    assert abs((estimate - exact).mean()) < 0.005


@pytest.fixture
def scattered(spark):
    """Many shuffle partitions that are not joined again, so every key is in a task of its own."""
    settings = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("blocks", [(7, 50), (1000, 8192)])
def test_small_tables(spark, scattered, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype("float32").tolist()) for i in range(200)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (10, rows[10][1])]  # ties and a repeated row
    bad = [(300, None), (301, [0.0] * 8), (302, [1.0, None] + [0.0] * 6), (303, [float("nan")] * 8), (304, [float("inf")] + [0.0] * 7), (305, [1.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows + bad], "vec_id long, embedding array<float>, rank int, row string")
    got = ann.nearest(df.repartition(3), F.col("vec_id") % 5 == 0, query_rows=blocks[0], block_rows=blocks[1])
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, lambda k: k % 5 == 0, 5))


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 1), (2, 2)] and got[1]["score"] == 0.0
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(df.limit(1), F.col("vec_id") == 0).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_force(rows, lambda k: k % 50 == 0, 5)
    got = list(map(tuple, QUERIES["op10_ann"](spark, sf).collect()))
    assert len(got) == len(want)
    recall = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}) / len(want)
    assert recall >= 0.99
