"""Registered queries on the smallest tables: SQL counterparts agree, the stream equals the batch."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wordloom.operators import generate, ngram
from wordloom.session import drop_tables, durable, new_path, shared_dir
from wordloom.streaming import requests as streams

CHECKED = [
    "scan_csv", "write_snippets", "random_snippet", "dense_id", "sample_n_rows", "trial_samples", "encode_context",
    "vocabulary", "context_vectors", "ngram_counts", "ngram_mle", "next_word_topk", "next_word_draw", "ngram_accuracy",
    "ngram_log_loss", "generate_topk", "generate_ngram", "route_requests", "write_corpus", "split_train_test",
    "accuracy_summary", "accuracy_histogram", "generate_scored", "everygrams", "ngram_accuracy_drawn", "score_plugin", "tokenize_treebank", "learned_abbreviations",
    "model_cost_summary", "accuracy_interval", "vocabulary_summaries",
]


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, db, name):
    got = entry.queries()[name](spark, sf)
    columns = sorted(got.columns)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want))


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and all(r["correct"] <= r["total"] for r in rows)


def test_a_round_does_not_move_the_model(spark):
    texts = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} w{i % 3} end") for i in range(60)], "id long, text string")
    cells, totals = ngram.draw_buckets(ngram.draw_table(ngram.fit(texts)))
    asked = durable(spark.createDataFrame([(1, "w1 w2")], "id long, context string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        drawn = ngram.draw(asked, cells, F.col("id"), "x", context_totals=totals)
        plan = drawn._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The cells and the totals of all orders are read in their buckets; only what asks is moved.
    assert plan.count("Bucketed: true") == 4
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert all("_c2" not in line and "_c3" not in line and "_t_" not in line for line in moved), moved


def test_written_tables_can_be_dropped(spark):
    frame = durable(spark.range(5), "short-lived")
    assert frame.count() == 5
    folder = pathlib_of(shared_dir(spark))
    assert any(folder.glob("short-lived-*"))
    spark.range(3).write.parquet(f"{shared_dir(spark)}/own/kept")
    drop_tables(spark)
    assert not folder.exists()


def pathlib_of(uri):
    return Path(uri.removeprefix("file:"))


def test_stream_equals_batch(spark):
    def make():
        return lambda texts, counts: [t + "!" * n for t, n in zip(texts, counts)]

    models = {name: lambda r: generate.generate_plugin(r, make) for name in generate.MODEL_NAMES.values()}
    rows = [(i, f"text {i}", i % 3, i % 5) for i in range(40)]
    asked = spark.createDataFrame(rows, streams.REQUEST_SCHEMA)
    source, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "check"))
    asked.repartition(4).write.parquet(source)

    def run():
        streams.answer_stream(
            streams.read_requests(spark, source, max_files=2), lambda b: generate.answer(b, models), out, checkpoint
        ).awaitTermination()
        return spark.read.parquet(out).drop("batch")

    batch = generate.answer(asked, models)
    streamed = run()
    assert sorted(streamed.collect()) == sorted(batch.collect())
    asked.limit(1).selectExpr("100L AS request_id", "text", "n", "model_n").write.mode("append").parquet(source)
    assert run().count() == 41
