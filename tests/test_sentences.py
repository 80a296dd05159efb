import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.functions import treebank
from wordloom.operators import sentences

EXPECTED = {
    "I can't go, it's 3,000 miles.": "i ca n't go , it 's 3,000 miles .",
    'She said "hello there" twice.': "she said `` hello there '' twice .",
    "cannot gonna gimme wanna 'tis 'twas": "can not gon na gim me wan na 't is 't was",
    "gonna gonna gonna": "gon na gon na gon na",
    "we'll they've you're don't DON'T": "we 'll they 've you 're do n't do n't",
    "wait... what?! (yes) [no] {x} <y>": "wait ... what ? ! ( yes ) [ no ] { x } < y >",
    "a--b; c@d #e $5 10% f&g *h": "a -- b ; c @ d # e $ 5 10 % f & g * h",
    "at 5:30 note: this, that": "at 5:30 note : this , that",
    "the dogs' bone": "the dogs ' bone",
    "«quoted» “text” ‘so’": "« quoted » “ text ” ‘ so ’",
    "mr. smith left. ": "mr. smith left .",
    "he said 'a b' and": "he said ' a b ' and",
    "": "", "   ": "", ".": ".", "end": "end", "x.": "x .", "a, b:\n": "a , b :", "c.\n": "c .", "é'll ü's": "é 'll ü 's",
}


def test_rules(spark):
    df = spark.createDataFrame([(t,) for t in EXPECTED], "text string")
    for r in df.select("text", treebank.treebank_tokens(F.col("text")).alias("t")).collect():
        assert " ".join(r["t"]) == EXPECTED[r["text"]], r["text"]
    assert spark.sql("SELECT CAST(NULL AS STRING) AS text").select(treebank.treebank_tokens(F.col("text")).alias("t")).first()["t"] is None


@pytest.mark.parametrize("text", ['"a" (b) c\'s d.', "x,y:z,", "a.. b... `q` ''r''", "cannot  not can", "[»] 'm 's' ''", "*?!;"])
def test_each_rule_alone(spark, text):
    """Every rule by itself equals Python's regular expressions."""
    rules = treebank.RULES + treebank.ENDING_RULES + treebank.contraction_rules()
    padded = f" {text} "
    names = {"\\p{L}\\p{N}_": "\\w", "\\z": "\\Z"}
    df = spark.createDataFrame([(padded,)], "text string")
    got = df.select(*[treebank.rewrite(F.col("text"), [r]).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    for i, (pattern, replacement) in enumerate(rules):
        for name, other in names.items():
            pattern = pattern.replace(name, other)
        assert got[i] == re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", replacement), padded), rules[i]


CORPUS = ["Dr. Who met Mr. X at the e.g. shop. The shop was shut.", "Dr. Who ran. He ran. It ran", "the the the the the dr. no", None, ""] * 5


def test_abbreviations(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CORPUS)], "id int, text string")
    words = [w for t in CORPUS if t for w in re.findall(r"\w+(?:\.\w+)*\.?", t.lower())]
    ends, rest = Counter(w[:-1] for w in words if w.endswith(".")), Counter(w for w in words if not w.endswith("."))
    share = sum(ends.values()) / len(words)
    got = {r["type"]: r for r in sentences.abbreviations(df).collect()}
    assert set(got) == {t for t in ends if re.search(r"[^\W\d_]", t)}
    for t, r in got.items():
        a, b = ends[t], rest[t]
        usual = a * math.log(share) + b * math.log(1 - share)
        one = a * math.log(0.99) + b * math.log(1 - 0.99)
        periods = t.count(".") + 1
        letters = len(t) - periods + 1
        assert (r["with_period"], r["without_period"]) == (a, b)
        assert r["score"] == pytest.approx(-2 * (usual - one) * math.exp(-letters) * periods * letters**-b)
    known = {t for t, r in got.items() if r["score"] >= sentences.LEAST_SCORE}
    assert {"dr", "mr", "e.g"} <= known and "shop" not in known and "ran" not in known


def test_sentences_and_tokens(spark):
    known = spark.createDataFrame([("dr",), ("e.g",), ("dr",)], "type string")
    rows = [
        (1, "Dr. Who ran. He (e.g. fast.) fell! Why?  Dr. No."), (2, None), (3, ""), (4, "dr. dr. dr."), (5, 'He said "no." Then left.\n'),
        (6, "a\x01b. c"), (7, "no end"),
    ]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r["id"]: r for r in sentences.sentences(df, known).collect()}
    assert got[1]["sentences"] == ["Dr. Who ran.", "He (e.g. fast.)", "fell!", "Why?", "Dr. No."]
    assert got[2]["sentences"] is None and got[3]["sentences"] == [""] and got[4]["sentences"] == ["dr. dr. dr."]
    assert got[5]["sentences"] == ['He said "no."', "Then left."] and got[6]["sentences"] == ["a b.", "c"] and got[7]["sentences"] == ["no end"]
    tokens = {r["id"]: r["tokens"] for r in sentences.sentence_tokens(df, known).collect()}
    assert " ".join(tokens[1]) == "dr. who ran . he ( e.g. fast . ) fell ! why ? dr. no ."
    assert tokens[2] is None and tokens[3] == []
    assert sentences.sentences(df.limit(0), known).count() == 0
