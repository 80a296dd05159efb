import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from wordloom.llm import filter_audit
from wordloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, mask int, part string"


def failing(text, key, first):
    words = WORD.findall(text)
    return [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        re.search(r"[#$%&*|]", text) is not None,
        first[text] != (key is None, key),
    ]


def brute_force(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    first, out = {}, {}
    for key, text, _ in rows:
        first[text or ""] = min(first.get(text or "", (True, None)), (key is None, key), key=lambda k: (k[0], k[1] or 0))
    parts = {}
    for key, text, lang in rows:
        parts.setdefault(lang or "", []).append((key, failing(text or "", key, first)))
    for part, docs in parts.items():
        removed = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                lost = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                removed[f] += len(lost)
                out[part, "".join("ABCDE"[x] for x in order), step] = [
                    len(left), len(lost), sum(d[1][f] for d in docs) - len(lost), sum(d[1][f] and sum(d[1]) == 1 for d in docs),
                    sum(d[0] in good for d in lost), sum(d[0] in toxic for d in lost),
                ]
        for order in permutations(range(5)):
            for step, f in enumerate(order, 1):
                out[part, "".join("ABCDE"[x] for x in order), step].append(removed[f])
    return out


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(13)
    words = [f"w{i}" for i in range(400)] + ["A", "HIGH", "é", "ÀB", "a#b", "$", "|", "中"]
    texts = [None, "", " \t", "ABC", "w1 " * 120, "long " * 30000, "#", "Z" * 9000]
    texts += [" ".join(chance.choice(words[: chance.choice([50, 400, 408])]) for _ in range(chance.randint(50, 200))) for _ in range(60)]
    made = [(i, chance.choice(texts), chance.choice(["en", "de", "", None])) for i in range(200)]
    return [*made, (None, texts[8], "en"), (None, texts[8], "en"), (7, made[7][1], made[7][2]), (7, texts[9], "en"), (None, "only here", "xx")]


@pytest.fixture(scope="module")
def labels():
    chance = random.Random(31)
    made = [(i, chance.choice([0, 1, None]), chance.choice([0, 1])) for i in range(0, 210, 2)]
    return [*made, (0, 1, 1), (0, 0, 0), (None, 1, 1)]


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 3, "clash") for r in rows], DOCS).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    failures = filter_audit.document_failures(docs, F.coalesce("lang", F.lit("")))
    got = filter_audit.audit(filter_audit.mask_cells(failures, known)).collect()
    return {tuple(r)[:3]: list(r)[3:] for r in got}, len(got)


def test_equals_brute_force(spark, rows, labels):
    got, n = audited(spark, rows, labels)
    want = brute_force(rows, labels)
    assert got == want and n == len(want) == 600 * len({r[2] or "" for r in rows})


def test_no_labels_and_empty_table(spark, rows):
    got, _ = audited(spark, rows, [])
    assert got == brute_force(rows, [])
    assert audited(spark, [], [(1, 1, 1)]) == ({}, 0)


def test_parts_beyond_one_block(spark):
    rows = [(i, "x #"[: i % 4], f"p{i % 150}") for i in range(300)]
    got, n = audited(spark, rows, [(5, 1, 0)])
    assert got == brute_force(rows, [(5, 1, 0)]) and n == 150 * 600


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 0, 2), ("p", 3, 2, 1, 1)], "part string, mask int, docs long, good long, toxic long")
    got = {tuple(r)[1:3]: list(r)[3:] for r in filter_audit.audit(cells, "xy").collect()}
    assert got == {
        ("xy", 1): [5, 5, 0, 3, 1, 3, 8], ("xy", 2): [5, 0, 2, 0, 0, 0, 2],
        ("yx", 1): [8, 2, 0, 0, 1, 1, 2], ("yx", 2): [5, 3, 2, 3, 0, 2, 8],
    }
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "abcdefgh")


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = {tuple(r)[:3]: list(r)[3:] for r in QUERIES["op13_filter_audit"](spark, sf).collect()}
    assert got == brute_force(docs, labels)
