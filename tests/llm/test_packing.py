import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wordloom.llm import packing
from wordloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_pieces(rows, ids_of, length):
    """Each id lies in one piece, sequences are gapless, digests agree; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids_of[doc])
            cut = ids_of[doc][at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(cut, dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids_of[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
    held = sum(r["length"] for r in rows)
    return 1 - held / (length * len(by_sequence))


def reference_ids(texts):
    reference = Tokenizer.from_file(PATH)
    return {k: [*reference.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}


def test_word_ids_equal_tokenizers(odd_texts):
    reference = Tokenizer.from_file(PATH)
    model = packing.WordIds(PATH, cache_bytes=9000)
    for text in odd_texts:
        want = reference.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(model.encode([text or ""])[0], "<i4").tolist() == want


def test_pieces(spark, odd_texts):
    texts = dict(enumerate(odd_texts))
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in texts.items()], "doc_id long, text string, start int, _part int")
    rows = packing.pack(df.repartition(3), PATH, length=64, open_windows=4).collect()
    ids = reference_ids(texts)
    check_pieces(rows, ids, 64)
    for r in rows:
        assert r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, None), (7, None)], "doc_id long, text string")
    rows = packing.pack(df, PATH, with_ids=False).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 3), (0, 3), (7, 1), (7, 1)]
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_merged_partitions_share_windows(spark):
    df = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', 30) AS text").repartition(20)
    rows = packing.pack(df, PATH, length=256, open_windows=4).collect()
    assert check_pieces(rows, {i: [*r["ids"]] for i, r in {r["doc_id"]: r for r in rows}.items()}, 256) < 0.08


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op4_packing"](spark, sf).collect()
    assert check_pieces(rows, reference_ids(texts), packing.LENGTH) < 0.1
