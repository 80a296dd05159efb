import random
from collections import Counter

import pytest

from wordloom.operators import heavy, vocab


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    return [" ".join(chance.choices(words, weights, k=chance.randint(0, 120))) for _ in range(600)] + [None, ""]


@pytest.mark.parametrize("size", [4, 50, 300, 10_000])
def test_summary_bounds(texts, size):
    true, summary = Counter(), heavy.Summary(size)
    for t in texts:
        words = (t or "").split()
        true.update(words)
        summary.add(words)
        assert len(summary.counts) <= size
    for keep in (size, max(1, size // 3)):
        summary.keep(keep)
        assert all(summary.counts[w] <= c <= summary.counts[w] + summary.error for w, c in true.items())
    assert size < 3000 or summary.error > 0 or len(summary.counts) == len(true)


@pytest.mark.parametrize("n", [1, 5, 30, 200])
@pytest.mark.parametrize("size", [60, 900, 1 << 17])
def test_same_rows_or_none(spark, texts, n, size):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    true = Counter(w for t in texts for w in (t or "").split())
    found = heavy.frequent_counts(df, n, size=size)
    if found is None:
        assert size == 60 or n == 200 and size < 1 << 17
        return
    got = {r["token"]: r["freq"] for r in found.collect()}
    level = sorted(true.values(), reverse=True)[n - 1]
    assert all(true[w] == c for w, c in got.items()) and {w for w, c in true.items() if c >= level} <= set(got)


@pytest.mark.parametrize("cap", [2, 3, 12, 400, 10_000])
def test_vocabulary_is_the_same(spark, texts, cap, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    want = vocab.vocabulary(df, max_tokens=cap).orderBy("idx").collect()
    assert vocab.vocabulary(df, max_tokens=cap, summaries=True).orderBy("idx").collect() == want
    monkeypatch.setattr(heavy, "SENT_BYTES", 0)  # the way when there are too many candidates
    assert vocab.vocabulary(df, max_tokens=cap, summaries=True).orderBy("idx").collect() == want
    assert vocab.vocabulary(df.limit(0), max_tokens=cap, summaries=True).count() == 2
