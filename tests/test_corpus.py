import pytest
from pyspark.sql import functions as F

from wordloom.operators import corpus, examples, ids
from wordloom.sources import tables


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ("t", "pop", "a", 1999, 5, "{}", 'line one\nline "two", end', 1, "en", "en", "en"),
        ("t", "rap", "a", 1999, 5, None, " spaces kept ", 2, "en", "en", "en"),
        (None, None, None, None, None, None, "x", 3, None, None, "pt"),
    ]
    df = spark.createDataFrame(rows, tables.SONGS_SCHEMA)
    tables.write_csv(df, str(tmp_path / "songs"), header=True)
    back = tables.read_csv(spark, str(tmp_path / "songs"))
    assert sorted(back.collect(), key=lambda r: r["id"]) == df.orderBy("id").collect()


def test_csv_as_written_by_others(spark, tmp_path):
    names = ",".join(tables.SONGS_SCHEMA.names)
    (tmp_path / "s.csv").write_text(f'{names}\nT,pop,A,2000,1,x,"say ""hi""\nthere",7,en,en,en\nT,pop,A,2000,1,x,,8,en,en,en\n')
    songs = tables.read_csv(spark, str(tmp_path / "s.csv"))
    assert {r["id"]: r["lyrics"] for r in songs.collect()} == {7: 'say "hi"\nthere', 8: None}
    kept = corpus.prepare_corpus(songs)
    assert kept.columns == ["title", "tag", "features", "lyrics", "language"] and kept.count() == 1


def test_prepare_corpus_takes_values_literally(spark):
    df = spark.createDataFrame([("pop' OR '1'='1", "x"), ("pop", "y"), (None, "z")], "tag string, lyrics string")
    got = corpus.prepare_corpus(df, drop=(), wanted={"tag": "pop' OR '1'='1"})
    assert [r["lyrics"] for r in got.collect()] == ["x"]


def test_parquet_files(spark, tmp_path):
    df = spark.range(100)
    tables.write_parquet(df, str(tmp_path / "a"), files=5)
    tables.write_parquet(df.coalesce(1), str(tmp_path / "b"), max_records_per_file=30)
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 5
    assert len(list((tmp_path / "b").glob("*.parquet"))) == 4
    assert tables.read_parquet(spark, str(tmp_path / "b")).count() == 100


def test_snippet_file_and_vectors(spark, tmp_path):
    df = spark.createDataFrame([('a "b"\nc',), ("plain",)], "snippet string")
    tables.write_snippets(df, str(tmp_path / "s"))
    assert sorted(tables.read_snippets(spark, str(tmp_path / "s")).collect()) == sorted(df.collect())
    (tmp_path / "v.txt").write_text(", 0.5 -1.25 3\nword 1 2 -0.001\n")
    got = {r["word"]: r["vector"] for r in tables.read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert got[","] == [0.5, -1.25, 3.0] and got["word"] == pytest.approx([1, 2, -0.001])


def test_audit(spark):
    df = spark.createDataFrame([("a b",), ("",), (None,), ("a b c d",)], "text string")
    assert tables.audit(df, min_tokens=3).first().asDict() == {
        "n_rows": 4, "null_texts": 1, "empty_texts": 1, "short_texts": 2,
    }
    assert tables.describe(df).collect() == [("text", "string", True)]


def test_split_is_stable_and_complete(spark):
    df = spark.range(500)
    train, test = corpus.split(df)
    assert train.unionByName(test).exceptAll(df).isEmpty() and train.count() + test.count() == 500
    again, _ = corpus.split(df.repartition(7))
    assert again.exceptAll(train).isEmpty()
    assert 350 < train.count() < 450
    unkeyed = spark.createDataFrame([(None,), (3,)], "id long")
    assert [part.filter("id IS NULL").count() for part in corpus.split(unkeyed)] == [1, 0]
    assert sum(part.count() for part in corpus.random_split(df)) == 500


@pytest.mark.parametrize("n", [0, 1, 50, 500, 900])
def test_sample_exact(spark, n):
    df = spark.range(500)
    got = corpus.sample_exact(df, n)
    assert got.count() == min(n, 500) == got.distinct().count()


def test_samples_and_trials(spark):
    df = spark.range(2000)
    assert 120 < corpus.sample_fraction(df, 0.1).count() < 280
    assert corpus.sample_rows(df, 5000).count() == 2000
    per_trial = {r["trial"]: r["count"] for r in corpus.trials(df).groupBy("trial").count().collect()}
    assert set(per_trial) == set(range(10)) and all(120 < c < 280 for c in per_trial.values())


def test_lookup_of_an_absent_key(spark):
    df = spark.range(5)
    keys = spark.createDataFrame([(2,), (2,), (9,)], "id bigint")
    assert [r["id"] for r in corpus.lookup(df, keys).collect()] == [2]


def test_short_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a b c"), (3, "a b c d"), (4, "")], "id int, text string")
    assert {r["id"]: r["n_tokens"] for r in corpus.short_texts(df, n=3).collect()} == {1: 2, 2: 3, 4: 0}


@pytest.fixture(params=["true", "false"])
def coalescing(spark, request):
    """With small partitions joined, and with every range partition kept."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.unset(name)


def test_running_total_matches_brute_force(spark, coalescing):
    # Group 0 holds most rows, so it spans several partitions.
    rows = [(0 if i % 4 else i % 3, (i * 37) % 1009, i % 5 + 1) for i in range(1009)]
    df = spark.createDataFrame(rows, "g int, k int, v bigint")
    got = ids.running_total(df, "v", ["k"], ["g"], total="t", rows="n").collect()
    assert len(got) == len(rows)
    for r in got:
        same = [v for g, k, v in rows if g == r["g"]]
        assert r["before"] == sum(v for g, k, v in rows if g == r["g"] and k < r["k"])
        assert (r["t"], r["n"]) == (sum(same), len(same))


@pytest.mark.parametrize("size", [1, 64, 100, 1000])
def test_dense_ids_and_batches(spark, coalescing, size):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "key").repartition(5)
    got = ids.batches(ids.dense_id(df, ["key"]), size).orderBy("key").collect()
    assert [r["id"] for r in got] == list(range(334))
    assert [r["batch_id"] for r in got] == [i // size for i in range(334)]
    assert ids.dense_id(df.limit(0), ["key"]).count() == 0


def test_examples(spark):
    words = [f"w{i}" for i in range(13)]
    df = spark.createDataFrame(
        [(n, " ".join(words[:n])) for n in (0, 9, 10, 11, 13)] + [(99, None)], "id int, text string"
    )
    sliding = examples.sliding_examples(df).collect()
    assert sorted((r["id"], r["pos"], r["next_word"]) for r in sliding) == [
        (11, 0, "w10"), (13, 0, "w10"), (13, 1, "w11"), (13, 2, "w12"),
    ]
    assert all(r["context"] == " ".join(words[r["pos"] : r["pos"] + 10]) for r in sliding)
    one = {r["id"]: r for r in examples.random_examples(df).collect()}
    assert set(one) == {11, 13} and one[11]["next_word"] == "w10"
    assert one[13]["next_word"] == words[one[13]["pos"] + 10]
    many = examples.random_examples(df, passes=20).collect()
    assert len(many) == 40 and {r["pass"] for r in many} == set(range(20))
    assert len({r["pos"] for r in many if r["id"] == 13}) == 3
