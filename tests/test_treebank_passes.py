"""Fewer passes over the text, the same tokens as rule by rule."""

import random

from pyspark.sql import functions as F

from wordloom.functions import treebank
from wordloom.functions.text import NON_SPACE
from wordloom.operators import sentences

PARTS = [
    "a", "7", "B", "é", "s", "ll", " ", " ", " ", "\t", "\n", ".", "..", "...", ",", ":", ";", "@", "%", "?", "!", "*", "(", ")", "[", "]", "{", "}", "<", ">",
    "-", "--", "can", "not", "cannot", "Gonna", "wanna", "lemme", "x ", "\x0b",
]
MARKED = ["'", "n't", "'ll", "'s", "'tis", "'twas", "d'ye", "more'n", "m"]
QUOTED = ["''", '"', "`", "``", "«", "»", "“", "”", "‘", "’", "„"]


def by_rules(text):
    """Every rule by itself, in the published order."""
    padded = F.concat(F.lit(" "), treebank.rewrite(F.lower(text), treebank.RULES), F.lit(" "))
    done = treebank.rewrite(padded, treebank.ENDING_RULES + treebank.contraction_rules())
    return F.regexp_extract_all(done, F.lit(NON_SPACE), F.lit(0))


def test_passes_equal_the_rules(spark):
    rng = random.Random(5)
    texts = [
        "".join(rng.choices(PARTS + more, k=rng.randint(0, 14))) for more in ([], MARKED, MARKED * 3, MARKED + QUOTED) for _ in range(4000)
    ]
    texts += ["cannot cannot cannot", "\tcannot\n", "gonna  wanna lemme", "can not", " 'tis 'twas 'tis", "''", "a'' b", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    rows = df.select("text", by_rules(F.col("text")).alias("a"), treebank.treebank_tokens(F.col("text")).alias("b")).collect()
    assert len(rows) == len(texts) and [r for r in rows if r["a"] != r["b"]] == []


def test_a_plain_sentence_meets_few_rules(spark):
    """A sentence without quotes and apostrophes goes through a handful of rewrites."""
    df = spark.createDataFrame([("a b, c.",)], "text string").select(treebank.treebank_tokens(F.col("text")).alias("t"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    plain = plan.split("ELSE")[1].split(" END")[0]
    assert plain.count("regexp_replace") <= 5 and plan.count("regexp_replace") < 40


def test_abbreviations_read_the_texts_once(spark):
    rows = [(1, "Dr. Who ran. He ran."), (2, "dr. 7. no"), (3, None), (1, "e.g. this")]
    told = sentences.abbreviations(spark.createDataFrame(rows, "id int, text string").repartition(2))
    told.collect()
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "Reused" in plan


def test_sentence_starts_are_found_once_for_a_text(spark):
    """No list of a text's pieces is made again for each of its pieces."""
    df = spark.createDataFrame([(1, "a dr. b. " * 3000)], "id int, text string")
    cut = sentences.sentences(df, spark.createDataFrame([("dr",)], "type string"))
    assert cut.first()["sentences"] == ["a dr. b."] * 3000
    starts = next(line for line in cut._jdf.queryExecution().optimizedPlan().toString().split("\n") if "AS _starts" in line)
    assert "transform(_pieces" not in starts
