import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from wordloom.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, queries, top=50):
    """``(item, rank, key, score)`` for each distinct (item, text)."""
    cut = [(k, Counter(terms(t))) for k, t in docs]
    cut = [(k, c, sum(c.values())) for k, c in cut if c]
    total, df = sum(n for *_, n in cut), Counter(t for _, c, _ in cut for t in c)
    out = []
    for item, text in set(queries):
        found = []
        for place, (key, counts, n) in enumerate(cut):
            m = 50 + (50 * n * len(cut)) // total
            score = 0
            for t in set(terms(text)) & set(counts):
                w = math.floor(1000 * math.log((2 * len(cut) + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, place))
        out += [(item, i + 1, None if null else key, -s) for i, (s, null, key, _) in enumerate(sorted(found)[:top])]
    return out


def ranked(spark, docs, queries, parts=3, **options):
    left = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, rank int, score double").repartition(parts)
    right = spark.createDataFrame([(*q, "x") for q in queries], "item_id long, text string, query string")
    got = rs.rank(left, right, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return [tuple(r) for r in got.collect()]


def shown(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def docs():
    chance = random.Random(12)
    words = [f"w{i}" for i in range(300)] + ["É", "é", "Ünï", "A1", "x_y", "it's", "中文"]
    weights = [1 / (i + 1) for i in range(len(words))]
    made = [" ".join(chance.choices(words, weights, k=chance.choice([1, 5, 40, 200]))) for _ in range(500)]
    made += [None, "", "  --- ", made[0], made[0], "w1 " * 20000, "rare " * 3, "w1\x00w2\x7fw3{w4}W5"]
    return [(chance.randint(0, 10**12), t) for t in made] + [(5, made[3]), (5, made[3]), (None, made[4]), (None, made[4])]


QUERIES = [(1, "w0 w1 w2 W3 rare"), (2, "the É é ünï it's"), (3, None), (4, ""), (5, "nothing known"), (1, "w250 w9"), (6, "w1 " * 5000), (6, "w1 " * 5000), (None, "w7 w8"), (7, " ".join(f"w{i}" for i in range(300)))]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 4000, "query_rows": 3}, {"top": 3, "shard_bytes": 20000}])
def test_equals_brute_force(spark, docs, options):
    assert shown(ranked(spark, docs, QUERIES, **options)) == shown(brute_force(docs, QUERIES, options.get("top", 50)))


def test_all_terms_when_the_asked_ones_are_many(spark, docs, monkeypatch):
    monkeypatch.setattr(rs, "ASKED_BYTES", 0)
    assert shown(ranked(spark, docs, QUERIES)) == shown(brute_force(docs, QUERIES))


def test_empty_tables(spark, docs):
    assert ranked(spark, [], QUERIES) == ranked(spark, docs[:5], []) == ranked(spark, [(1, None), (2, "")], QUERIES) == []


def test_blocks_stay_compressed(monkeypatch):
    """Many documents in one shard: the same best ones as by adding everything, with few blocks read."""
    rng = np.random.default_rng(3)
    n = 40_000
    lengths = rng.integers(5, 400, n)
    norms = rs.length_norms(lengths, n, int(lengths.sum()))
    lists, total = [], np.zeros(n, dtype=np.int64)
    for share in (0.9, 0.7, 0.5, 0.2, 0.01, 0.003):
        docs = np.flatnonzero(rng.random(n) < share)
        tf = rng.geometric(0.5, len(docs))
        weight = math.floor(1000 * math.log((2 * n + 2) / (2 * len(docs) + 1)))
        data, bound = rs.pack_list(docs, tf, norms)
        lists.append(rs.Postings(data, weight, bound))
        total[docs] += weight * rs.impacts(tf, norms[docs])
    read = []
    whole = rs.Postings.scores
    monkeypatch.setattr(rs.Postings, "scores", lambda self, blocks, norms: read.append(len(blocks)) or whole(self, blocks, norms))
    order = rng.permutation(n)
    best = rs.search_shard(lists, norms, order, 10)
    want = np.lexsort((order, -total))[:10]
    assert sorted(best.docs.tolist()) == sorted(want.tolist()) and sorted(best.scores) == sorted(total[want])
    assert sum(read) < 0.6 * sum(len(p.first) for p in lists)


def test_packed_lists():
    rng = np.random.default_rng(4)
    for n, most, often in ((1, 10, 3), (128, 200, 300), (129, 10**6, 5), (1000, 2 * 10**9, 70_000)):
        docs = np.unique(rng.integers(0, most, n))
        tf = rng.integers(1, often, len(docs))
        norms = np.full(int(docs.max()) + 1 if most < 10**7 else 0, 100)
        if not len(norms):
            continue
        data, bound = rs.pack_list(docs, tf, norms)
        p = rs.Postings(data, 7, bound)
        got, scores = p.scores(np.arange(len(p.first)), norms)
        assert got.tolist() == docs.tolist() and scores.tolist() == (7 * rs.impacts(tf, norms[docs])).tolist()
        assert p.bound == scores.max() and p.block_bounds(np.arange(len(p.first))).max() == p.bound
        some = np.arange(0, len(p.first), 2)
        assert p.scores(some, norms)[0].tolist() == [d for i, d in enumerate(docs.tolist()) if i // rs.BLOCK % 2 == 0]
