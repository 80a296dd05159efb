import random
import re

import numpy as np
import pytest
import xxhash

from wordloom.llm import simhash
from wordloom.llm.components import components
from wordloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, size=3):
    words = WORD.findall((text or "").encode().lower().decode())
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(keys, fps, budget):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    array = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= budget).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, key in enumerate(keys):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(fps))]


def clusters(chance, n, bits):
    out = []
    while len(out) < n:
        centre = chance.getrandbits(64)
        for _ in range(chance.randint(1, 12)):
            other = centre
            for _ in range(chance.randint(0, bits)):
                other ^= 1 << chance.randrange(64)
            out.append(other)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("budget", [1, 2, 3, 4, 6])
@pytest.mark.parametrize("hot", [1 << 14, 6])
def test_links_connect_what_is_near(spark, budget, hot):
    chance = random.Random(budget)
    fps = [*clusters(chance, 300, budget), 0, 1, (1 << 64) - 1]
    # One crowded key: the same upper half, many lower ones.
    fps += [(0xABCD << 48) | x for x in clusters(chance, 60, 3)]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = simhash.links(df, budget, hot_key=hot).collect()
    for a, b in found:
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= budget
    assert len(found) <= len(fps) * len(simhash.Orders(budget).tops)
    roots = dict(components(simhash.links(df, budget, hot_key=hot)).collect())
    got = [roots.get(signed(f), signed(f)) for f in fps]
    want = brute_components(range(len(fps)), fps, budget)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_trie_pairs_of_a_dense_node():
    keys = np.unique(np.array([random.Random(i).getrandbits(12) for i in range(900)], dtype=np.uint64))
    got = {(int(a), int(b)) for x, y in simhash.trie_pairs(keys, np.array([[0, len(keys)]]), np.array([[0, len(keys)]]), 0, 2) for a, b in zip(x, y)}
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if bin(int(keys[i] ^ keys[j])).count("1") <= 2}
    assert got == want


def test_components_of_chain_star_and_noise(spark):
    rows = [(i, i + 1) for i in range(100, 200)] + [(0, i) for i in range(1, 50)] + [(7, 7), (300, 301), (301, 300), (None, 3)]
    got = dict(components(spark.createDataFrame(rows, "a long, b long")).collect())
    assert {got[i] for i in range(101, 201)} == {100} and {got[i] for i in range(1, 50)} == {0} and got[301] == 300


def test_rows(spark, odd_texts):
    words = "one two three four five six seven eight nine ten".split()
    texts = [*odd_texts, " ".join(words * 9), " ".join(words * 9) + " x", "ONE two", "one TWO", "É", "é"]
    rows = [(None if i % 50 == 3 else i, t, "f") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted(map(tuple, simhash.near_duplicates(df.repartition(3)).collect()), key=str)
    fps = [brute_fingerprint(t) for t in texts]
    want = zip([r[0] for r in rows], [f"{f:016x}" for f in fps], brute_components([r[0] for r in rows], fps, 2))
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    keys, fps = [r["doc_id"] for r in docs], [brute_fingerprint(r["text"]) for r in docs]
    want = sorted(zip(keys, [f"{f:016x}" for f in fps], brute_components(keys, fps, 2)))
    got = QUERIES["op7_simhash"](spark, sf).collect()
    assert sorted(map(tuple, got)) == want
