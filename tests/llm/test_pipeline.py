import random
import re
from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from wordloom.llm import packing
from wordloom.session import durable

from .test_packing import check_pieces, reference_ids
from .test_secrets import brute_force as secret_spans
from .test_simhash import brute_components, brute_fingerprint
from .test_substrings import brute_force as cut_words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def near():
    """Prose with groups of exact copies and of copies with a few changed words."""
    chance = random.Random(4)
    words = [f"word{i}" for i in range(3000)]
    rows = []
    for _ in range(60):
        base = [chance.choice(words) for _ in range(chance.randint(100, 300))]
        for k in range(chance.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(0 if k % 2 == 0 else chance.randint(1, max(1, len(base) // 100))):
                copy[chance.randrange(len(copy))] = chance.choice(words)
            rows.append(" ".join(copy))
    return rows


def near_docs(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def groups_of(rows):
    """The places of each group, the smallest id first and NULL last, by the operator's definition."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    fps = [brute_fingerprint(rows[i][1]) for i in order]
    found = {}
    for i, root in zip(order, brute_components(range(len(rows)), fps, 2)):
        found.setdefault(root, []).append(i)
    return list(found.values())


def test_one_of_each_near_group_stays(spark, near):
    rows = list(enumerate(near)) + [(None, near[0]), (None, "only this one has no id"), (None, "only this one has no id"), (5, near[5]), (7, None), (8, "")]
    kept = [tuple(r)[:2] for r in pipeline.drop_near_copies(spark, near_docs(spark, rows).repartition(4), "").collect()]
    groups = groups_of(rows)
    assert any(len(g) > 1 for g in groups) and sorted(map(repr, kept)) == sorted(repr(rows[g[0]]) for g in groups)


def test_a_clashing_column_stays(spark):
    docs = near_docs(spark, [(1, "a b c"), (2, "a b c"), (3, "x y z w")]).withColumn("row", F.lit("mine"))
    got = pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == [*COLUMNS, "row"] and sorted((r["doc_id"], r["row"]) for r in got.collect()) == [(1, "mine"), (3, "mine")]


def test_a_result_outlives_the_next_run(spark, sf):
    first = pipeline.run(spark, sf)
    second = pipeline.run(spark, sf)
    rows = sorted(map(tuple, first.collect()))
    assert len(rows) > 0 and len(rows) == second.count()


def test_whole_run_equals_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, sf), name)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = pipeline.run(spark, sf).collect()
    assert check_pieces(pieces, reference_ids(texts), packing.LENGTH) < 0.1


def test_each_stage_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "passages", "secrets", "packing"]

    kept = durable(stages["quality"](spark, docs, sf), "t1")
    assert kept.columns == COLUMNS and kept.exceptAll(docs).count() == 0
    left = {r["doc_id"] for r in kept.collect()}
    good = [k for k, q in labels.items() if q == 1]
    assert sum(k in left for k in good) >= 0.95 * len(good)

    single = durable(stages["near_copies"](spark, kept, sf), "t2")
    assert single.columns == COLUMNS and single.exceptAll(kept).count() == 0
    texts = Counter(r["text"] for r in single.collect())
    assert max(texts.values()) == 1 and set(texts) <= {r["text"] for r in kept.collect()}

    cut = durable(stages["passages"](spark, single, sf), "t3")
    before = single.orderBy("doc_id").collect()
    after = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == COLUMNS and len(after) == len(before)
    for r, (_, removed, words) in zip(before, cut_words([r["text"] for r in before], 35)):
        got = after[r["doc_id"]]
        assert " ".join(re.findall(r"[^\x20\x09-\x0D]+", got["text"])) == words and got["n_chars"] == len(got["text"])
        assert removed or got["text"] == r["text"]

    masked = durable(stages["secrets"](spark, cut, sf), "t4")
    assert masked.columns == COLUMNS
    for r in masked.collect():
        source = after[r["doc_id"]]["text"]
        for start, _, end in reversed(secret_spans(source)[1]):
            assert source[start:end] not in r["text"]
        assert secret_spans(source)[1] or r["text"] == source

    pieces = stages["packing"](spark, masked, sf).collect()
    assert check_pieces(pieces, reference_ids({r["doc_id"]: r["text"] for r in masked.collect()}), packing.LENGTH) < 0.1


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_nulls_and_repeated_rows(spark, sf):
    text = "some plain words that go on for a while and end here " * 1
    rows = [(None, None, None, None, None), (1, text, "en", None, 5), (1, text, "en", None, 5), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        stage(spark, docs, sf).collect()
