import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.functions.rand import pick

TEXTS = [
    "Don't stop",
    "",
    None,
    "  É ñ_1\tß!\nœuvre ",
    "one two three four five six seven eight nine ten",
    "one two three four five six seven eight nine ten eleven",
    "...!?",
]


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = df.select("id", expression.alias("out")).orderBy("id").collect()
    return [r["out"] for r in rows]


def test_word_tokens_equal_python(spark):
    got = column(spark, TEXTS, tx.word_tokens(F.col("text")))
    assert got == [None if t is None else re.findall(r"\b\w+\b", t) for t in TEXTS]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    # Old code points only: Python and the JVM may know different versions of Unicode.
    st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40), min_size=5, max_size=20)
)
def test_word_tokens_property(spark, texts):
    assert column(spark, texts, tx.word_tokens(F.col("text"))) == [re.findall(r"\b\w+\b", t) for t in texts]


def test_vocabulary_normalisation(spark):
    text = F.col("text")
    assert column(spark, ["Don't (stop), A_b!"], tx.standardize(text)) == ["dont stop ab"]
    assert column(spark, [" Don't\n -- stop "], tx.standard_tokens(text)) == [["dont", "stop"]]
    assert column(spark, ["[\\]^`{|}~\"#$%&*+/:;<=>?@"], tx.standard_tokens(text)) == [[]]


def test_wordpunct_and_padding(spark):
    tokens = tx.wordpunct_tokens(F.col("text"))
    assert column(spark, ["Don't go!"], tokens) == [["don", "'", "t", "go", "!"]]
    assert column(spark, ["a"], tx.pad(tokens)) == [["<s>", "<s>", "a", "</s>", "</s>"]]
    assert column(spark, ["a"], tx.pad(tokens, 2, 2)) == [["<s>", "<s>", "a", "</s>", "</s>"]]
    assert column(spark, ["a"], tx.without_markers(tx.pad(tokens))) == [["a"]]


@pytest.mark.parametrize("size", [0, 1, 2, 3, 5])
def test_windows(spark, size):
    words = [f"w{i}" for i in range(size)]
    got = column(spark, [" ".join(words)], tx.windows(tx.word_tokens(F.col("text")), 3))[0]
    assert [tuple(w) for w in got] == [tuple(words[i : i + 3]) for i in range(size - 2)]


def test_snippets(spark):
    text = F.col("text")
    texts = ["A b C", " ".join("ABCDEFGHIJ"), " ".join("ABCDEFGHIJK"), None]
    plain = column(spark, texts, tx.snippet(text, tx.lower_tokens(text), F.col("id")))
    # Up to ten tokens the text stays raw; of eleven tokens only the first window can be chosen.
    assert plain == ["A b C", " ".join("ABCDEFGHIJ"), " ".join("abcdefghij"), None]
    inclusive = column(spark, texts, tx.snippet_inclusive(tx.word_tokens(text), F.col("id")))
    assert inclusive[0] is None and inclusive[1] == " ".join("ABCDEFGHIJ")
    assert inclusive[2] in (" ".join("ABCDEFGHIJ"), " ".join("BCDEFGHIJK"))


def test_inclusive_snippet_reaches_the_last_window(spark):
    words = [f"w{i}" for i in range(12)]
    df = spark.range(200).select("id", F.lit(" ".join(words)).alias("text"))
    tokens = tx.word_tokens(F.col("text"))
    open_end = df.select(tx.snippet(F.col("text"), tokens, F.col("id"))).distinct().collect()
    closed = df.select(tx.snippet_inclusive(tokens, F.col("id"))).distinct().collect()
    assert {r[0].split()[0] for r in open_end} == {"w0", "w1"}
    assert {r[0].split()[0] for r in closed} == {"w0", "w1", "w2"}


def test_slide_and_prompt(spark):
    tokens = tx.word_tokens(F.col("text"))
    assert column(spark, ["a b c", ""], tx.slide(tokens, F.lit("d"))) == [["b", "c", "d"], []]
    asked = tx.add_prompt(F.col("text"), "P: ")
    assert column(spark, ["a P: b"], tx.drop_prompt(asked, "P: ")) == ["a b"]


def test_pick_is_a_function_of_the_key(spark):
    df = spark.range(1000).select("id", pick("s", F.col("id"), 7).alias("p"))
    again = df.repartition(3).select("id", pick("s", F.col("id"), 7).alias("p"))
    assert df.exceptAll(again).isEmpty()
    counts = {r["p"]: r["count"] for r in df.groupBy("p").count().collect()}
    assert set(counts) == set(range(7)) and min(counts.values()) > 90
    assert spark.range(1).select(pick("s", F.col("id"), F.lit(-3))).first()[0] == 0
