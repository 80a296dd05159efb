import hashlib
import random
import re
from collections import Counter

import pytest

from wordloom.llm import substrings
from wordloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(texts, window):
    cut = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["é", "ß,", "中"]
    def prose(n): return " ".join(chance.choice(words) for _ in range(n))
    passages = [prose(n) for n in (5, 12, 20, 36, 60)]
    made = []
    for _ in range(80):
        pieces = [prose(chance.randint(0, 30)) for _ in range(3)]
        for _ in range(chance.randint(0, 3)):
            pieces.insert(chance.randint(0, 3), chance.choice(passages))
        made.append(chance.choice([" ", "\n", " \t "]).join(pieces))
    return [*made, None, "", "  ", made[0], made[0], "again " * 90, passages[4] + " " + passages[4], prose(3000)]


@pytest.mark.parametrize("window", [1, 2, 7, 12, 20, 35])
def test_equals_brute_force(spark, texts, window):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept int, part string")
    for shaped in (df.coalesce(1), df.repartition(5)):
        got = substrings.dedup_substrings(shaped, window=window, single_space=True)
        rows = sorted(got.collect(), key=lambda r: r["doc_id"])
        assert [(r["n_words"], r["n_removed"], r["kept"]) for r in rows] == brute_force(texts, window)
        assert {r["part"] for r in rows} == {"x"}


def test_white_space_stays(spark):
    shared = " ".join(f"s{i}" for i in range(6))
    texts = [f" a\n\nb {shared}\tc\n", f"{shared} ", f"d  e {shared}", "f \t g\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.dedup_substrings(df, window=6).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {0: " a\n\nb c\n", 1: "", 2: "d  e ", 3: "f \t g\n"}


@pytest.mark.parametrize("period", [p for p in substrings.COVERS if p > 1])
def test_covers(period):
    residues = substrings.COVERS[period]
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))


def test_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    rows = substrings.dedup_substrings(df, window=2).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept"]) for r in rows) == [(0, 0, ""), (2, 2, ""), (2, 2, "")]
    assert substrings.dedup_substrings(df.limit(0)).count() == 0
    assert substrings.dedup_substrings(df.select("text")).columns == ["n_words", "n_removed", "kept"]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in docs], brute_force([r["text"] for r in docs], 35)))
    got = QUERIES["op2_substrings"](spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        n, removed, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
    assert sum(r["n_removed"] for r in got) > 0
