import random
import re

import pytest
from wordloom.llm import simhash


def runs(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_groups(rows, similarity=0.8):
    sets = [runs(t) for _, t in rows]
    root = {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            a, b = find(rows[i][0]), find(rows[j][0])
            if a != b and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                root[max(a, b)] = min(a, b)
    groups = {k: find(k) for k in root}
    large = [g for g in groups.values() if list(groups.values()).count(g) > 1]
    return {k: g for k, g in groups.items() if g in large}


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return dict(map(tuple, simhash.similar_groups(df, **options).collect()))


def template_rows(chance, n):
    """Texts of one source: a common text with blocks of their own (0.5 to 0.8 alike), some of them copied closely."""
    words = [f"w{i}" for i in range(5000)]
    common, rows = [chance.choice(words) for _ in range(300)], []
    while len(rows) < n:
        text = list(common)
        for _ in range(3):
            at = chance.randrange(280)
            text[at : at + 8] = [chance.choice(words) for _ in range(8)]
        rows.append(text)
        for _ in range(chance.choice([0, 0, 1, 2])):
            copy = list(chance.choice(rows))
            at = chance.randrange(270)
            copy[at : at + chance.randint(1, 24)] = [chance.choice(words) for _ in range(chance.randint(1, 24))]
            rows.append(copy)
    chance.shuffle(rows)
    return [(i, " ".join(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize("hot", [simhash.HOT_SHINGLE, 40])
def test_no_pair_of_a_hot_source_is_lost(spark, hot):
    rows = template_rows(random.Random(5), 400)
    want = brute_groups(rows)
    assert 20 < len(want) and len(set(want.values())) > 5
    assert found(spark, rows, hot=hot) == want


def test_a_rejected_link_hides_no_other(spark):
    # a-b and b-c below 0.8, a-c above; and a hub that is not alike to what it links.
    words = [f"w{i}" for i in range(120)]
    a, c = words, words[:118] + ["x", "y"]
    b = words[:95] + [f"b{i}" for i in range(20)] + words[115:]
    rows = [(7, " ".join(a)), (1, " ".join(b)), (9, " ".join(c))]
    assert brute_groups(rows) == found(spark, rows) == {7: 7, 9: 7}


def test_repeated_and_empty_rows(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(1, "one two"), (1, long), (2, long + " x"), (3, None), (4, " "), (5, "other"), (6, "One  Two")]
    assert found(spark, rows) == {1: 1, 2: 1, 6: 1, 3: 3, 4: 3}
    assert found(spark, [(None, long), (1, long)]) == {} == found(spark, [])


@pytest.mark.parametrize("change", ["scattered", "appended", "cut", "block"])
def test_copies_at_the_threshold(spark, change):
    """Copies that are 0.8 to 0.9 alike, all of which must be found."""
    chance, rows = random.Random(change), []
    words = [f"w{i}" for i in range(5000)]
    while len(rows) < 160:
        text = [chance.choice(words) for _ in range(chance.randint(120, 300))]
        copy, share = list(text), chance.uniform(0.05, 0.24)
        if change == "scattered":
            for _ in range(max(1, int(len(text) * share / 10))):
                copy[chance.randrange(len(copy))] = chance.choice(words)
        elif change == "appended":
            copy += [chance.choice(words) for _ in range(int(len(text) * share))]
        elif change == "cut":
            del copy[: int(len(text) * share * 0.8)]
        else:
            size = int(len(text) * share / 2)
            copy[20 : 20 + size] = [chance.choice(words) for _ in range(size)]
        a, b = runs(" ".join(text)), runs(" ".join(copy))
        if 0.8 <= len(a & b) / len(a | b) <= 0.9:
            rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(copy))]
    assert found(spark, rows) == {k: k - k % 2 for k, _ in rows}
