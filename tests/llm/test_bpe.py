import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wordloom.llm import bpe
from wordloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip_equals_tokenizers(spark, odd_texts):
    reference = Tokenizer.from_file(PATH)
    rows = [(i, t, "mine") for i, t in enumerate(odd_texts)] + [(None, "no key", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")  # `ids` clashes and is replaced
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(got) == len(rows)
    for row in got:
        want = reference.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == reference.decode(want, skip_special_tokens=False)


def test_every_id_and_broken_bytes_decode(spark):
    reference = Tokenizer.from_file(PATH)
    lists = [[i] for i in range(0, 50257, 97)] + [[50256, 221, 187], [], None]
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>")
    for row in bpe.decode(df, PATH).collect():
        assert row["decoded"] == reference.decode(row["ids"] or [], skip_special_tokens=False)


def test_cache_bound_changes_nothing():
    texts = [f"word{i} other{i % 7} <|endoftext|>" for i in range(200)]
    small, large = bpe.Bpe(PATH, cache_words=5), bpe.Bpe(PATH)
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)
    assert len(small.cache) < 20


def test_merges_are_leftmost_lowest():
    # Pairs (0,1)->3 of rank 0 and (1,0)->4 of rank 1.
    pairs = bpe.PairTable(*(np.array(x) for x in ([0, 1], [1, 0], [3, 4])))
    ids, counts = bpe.merge_symbols(np.array([[0, 1, 0, 1], [1, 0, 0, 0]], dtype=np.int32), np.array([4, 2]), pairs)
    assert ids.tolist() == [3, 3, 4] and counts.tolist() == [2, 1]


def test_long_pretokens():
    """Runs without a space, alone and among many short ones."""
    chance, model = random.Random(7), bpe.Bpe(PATH)
    reference = Tokenizer.from_file(PATH)
    letters = "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    texts = [letters, "a" * 30_000, "the" * 7_000, "é" * 5_000, " ".join(letters[i : i + 9] for i in range(0, 3000, 9)) + letters[:4000]]
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_few_and_many_rows_agree(monkeypatch):
    words = ["".join(random.Random(i).choices("etaoin", k=1 + i % 60)) for i in range(300)]
    found = []
    for few in (0, 8, 1000):
        monkeypatch.setattr(bpe, "FEW_ROWS", few)
        found.append([x for w in (words[:3], words) for x in bpe.Bpe(PATH).encode([" ".join(w)])])
    assert found[0] == found[1] == found[2]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).count() == 0


def test_query(spark, sf):
    reference = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = reference.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
