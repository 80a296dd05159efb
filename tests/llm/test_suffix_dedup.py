import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from wordloom.llm import suffix_dedup
from wordloom.llm.bwt import Merge, Shards, transform, transforms
from wordloom.llm.queries import QUERIES

SLIM = pa.schema([("piece", pa.int64()), ("held_key", pa.int64()), ("held_no", pa.int64()), ("held_text", pa.string())])


def brute_force(rows, length):
    """``(bytes, removed, spans, kept)`` of each ``(key, text)``, in the order of the rows."""
    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        data = (rows[i][1] or "").encode()
        gone = [False] * len(data)
        for a in range(len(data) - length + 1):
            if data[a : a + length] in seen:
                gone[a : a + length] = [True] * length
            seen.add(data[a : a + length])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)
    return out


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["é", "中中", "ß"]
    def prose(n): return " ".join(chance.choice(words) for _ in range(n))
    passages = [prose(n) for n in (5, 20, 40, 60)]
    made = []
    for _ in range(80):
        parts = [prose(chance.randint(0, 30)) for _ in range(3)]
        for _ in range(chance.randint(0, 3)):
            parts.insert(chance.randint(0, 3), chance.choice(passages))
        made.append(" ".join(parts))
    same = [None, "", "  ", made[0], made[0], "again " * 90, "a" * 500, "a" * 700, "ab" * 300, passages[3] + " " + passages[3], prose(3000)]
    return list(enumerate(made + same))


def found(df, **options):
    got = suffix_dedup.remove_repeats(df, **options).collect()
    return {r["i"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got}


@pytest.mark.parametrize("hot", [2, suffix_dedup.HOT_RUNS])
@pytest.mark.parametrize("length", [1, 7, 35, 100])
def test_equals_brute_force(spark, texts, length, hot):
    rows = [(k, t, i, "c") for i, (k, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, i int, n_spans string")
    want = brute_force(texts, length)
    for shaped in (df.coalesce(1), df.repartition(5)):
        assert found(shaped, length=length, hot_runs=hot) == want


def _laid(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


@pytest.mark.parametrize("size", [1 << 18, 4096, 300])
def test_every_start_is_in_one_run(texts, size, monkeypatch):
    """Also in texts far longer than what is hashed at a time."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", size)
    whole = [t for _, t in texts if t is not None] + ["x y " * 900 + "tail of a long text " * 30, ""]
    data, bounds = _laid(whole)
    runs = suffix_dedup.Finder(35).runs(data, bounds)
    starts = [a + k for a, n in zip(runs.start.tolist(), runs.starts.tolist()) for k in range(n)]
    assert len(set(starts)) == len(starts) and runs.starts.max() <= 35
    assert set(starts) == {a for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()) for a in range(lo, hi - 34)}


@pytest.mark.parametrize("length", [1, 2, 5, 20])
def test_anchors_depend_on_the_string_alone(length):
    """Equal strings have one anchor, wherever they stand, and runs with one name are equal."""
    chance = random.Random(8)
    core = "".join(chance.choice("abcde ") for _ in range(60))
    texts = ["".join(chance.choice("abcde ") for _ in range(chance.randint(0, 90))) + core + "z" * chance.randint(0, 50) for _ in range(30)]
    data, bounds = _laid(texts)
    runs = suffix_dedup.Finder(length).runs(data, bounds)
    anchors, names = {}, {}
    for a, n, anchor, name in zip(runs.start.tolist(), runs.starts.tolist(), runs.anchor.tolist(), runs.name.tolist()):
        text = data[a : a + n + length - 1].tobytes()
        own = [text[k : k + length] for k in range(n)]
        assert all(anchors.setdefault(s, anchor) == anchor for s in own)
        assert name == 0 or (len(set(own)) == n and names.setdefault(name, text) == text)


@pytest.mark.parametrize("size", [1 << 23, 2000])
def test_small_pieces(spark, texts, size, monkeypatch):
    """All in this process: many pieces that exchange answers, as the job does it."""
    want = brute_force(texts, 35)
    pieces, held = [], []
    for i, (key, text) in enumerate(texts):
        held.append((len(pieces), key, i, text or ""))
        if sum(len(h[3]) for h in held) > size:
            pieces.append(held)
            held = []
    pieces.append(held)
    tables = [pa.table({n: [h[j] for h in p] for j, n in enumerate(("piece", "held_key", "held_no", "held_text"))}, schema=SLIM) for p in pieces if p]
    made = [suffix_dedup.Piece(t, 35) for t in tables]
    rows = []
    for piece in made:
        own, start = piece.anchors, 0
        for i, end in enumerate(suffix_dedup.range_ends(own.anchor, 3)):
            rows.append((i, piece.number, own.anchor[start:end].tobytes(), own.name[start:end].tobytes(), own.different[start:end].astype(np.uint32).tobytes()))
            start = end
    judged = [suffix_dedup.judge_anchors(pa.table(dict(zip(("range", "piece", "anchors", "names", "counts"), map(list, zip(*[r for r in rows if r[0] == i]))))), 4) for i in range(3)]
    answers = pa.concat_tables(judged).to_pylist()
    found = [p.found(p.codes({a["range"]: a["answer"] for a in answers if a["piece"] == p.number}, 3), 5) for p in made]
    blocks = pa.concat_tables([f.blocks(5) for f in found])
    merged = [suffix_dedup.merge_range(blocks.filter(pa.array(blocks["range"].to_numpy() == i)), 35) for i in range(5)]
    told = pa.concat_tables(merged).to_pylist()
    for f in found:
        gone = f.gone({r["range"]: (r["equal"], r["starts"], r["n_equal"], r["n_starts"]) for r in told if r["piece"] == f.piece.number})
        sizes, lost, spans, kept = suffix_dedup.cut(f.piece.data, f.piece.bounds, gone)
        numbers = [h[2] for h in pieces[f.piece.number]]
        for i, got in zip(np.array(numbers)[f.piece.order].tolist(), zip(sizes.tolist(), lost.tolist(), spans.tolist(), kept.to_pylist())):
            assert got == want[i]


def test_keys_order_the_copies(spark):
    text = "one two three four five six"
    rows = [(None, text, 0), (9, text, 1), (3, text, 2), (3, text + "!", 3), (None, text, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, i int").coalesce(1)
    got = found(df, length=10)
    assert [got[i][3] for i in range(5)] == [b"", b"", text.encode(), b"!", b""]


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([(1, "ab"), (None, None)], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, 0, 0, b"ab"), (None, 0, 0, 0, b"")]


def _suffixes(shards):
    flat = [s for shard in shards for s in shard]
    return sorted((tuple(b + 1 for b in s[j:]) + (0,), i, j) for i, s in enumerate(flat) for j in range(len(s) + 1))


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\x00", bytes(range(0xF5))])
def test_merge_equals_sorting(alphabet):
    chance = random.Random(len(alphabet))
    for _ in range(60):
        shards = [[bytes(chance.choices(alphabet, k=chance.randint(0, 30))) for _ in range(chance.randint(1, 5))] for _ in range(chance.randint(1, 4))]
        made = [transform(s) for s in shards]
        for shard, got in zip(shards, made):
            assert got.tolist() == [0 if j == 0 else shard[i][j - 1] + 1 for _, i, j in _suffixes([shard])]
        whole = _suffixes(shards)
        merge = Merge(made, 31)  # deeper than any suffix: the full order
        string, length = merge.suffixes()
        flat = [s for shard in shards for s in shard]
        assert [(i, len(flat[i]) - n) for i, n in zip(string[merge.rows].tolist(), length[merge.rows].tolist())] == [(i, j) for _, i, j in whole]
        assert merge.texts(string, length) == flat
        together, ends = transforms(flat, np.repeat(np.arange(len(shards)) * 3, [len(s) for s in shards]))
        assert [x.tolist() for x in np.split(together, ends[:-1])] == [x.tolist() for x in made]
        depth, step = chance.choice([(1, None), (5, None), (7, None), (8, 2), (9, 3), (10, 5), (12, 4)])
        merge = Merge(made, depth, step)
        step = step or {1: 1, 5: 5, 7: 1}[depth]
        string, length = merge.suffixes()
        cut = [flat[i][len(flat[i]) - n :] for i, n in zip(string[merge.rows].tolist(), length[merge.rows].tolist())]
        for k in range(1, len(cut)):
            common = next((x for x, (a, b) in enumerate(zip(cut[k - 1], cut[k])) if a != b), min(len(cut[k - 1]), len(cut[k])))
            assert merge.common[k] == (depth if common >= depth else common // step * step)
            assert (merge.block[k] != merge.block[k - 1]) == (common < depth)
            assert cut[k - 1][:depth] <= cut[k][:depth]


def test_no_rows():
    merge = Merge([], 5)
    assert len(merge.rows) == 0 and [len(x) for x in merge.suffixes()] == [0, 0]
    assert Merge([np.zeros(0, np.uint8)], 5).rows.tolist() == [] and Shards([]).texts(*merge.suffixes()) == []
    assert [x.tolist() for x in transforms([])] == [[], []]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_force(rows, 100)
    got = {r["doc_id"]: r for r in QUERIES["op11_suffix_dedup"](spark, sf).collect()}
    assert len(got) == len(rows) and sum(r["n_removed"] for r in got.values()) > 0
    for i, (key, _) in enumerate(rows):
        n, removed, spans, kept = want[i]
        r = got[key]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, spans, hashlib.sha256(kept).hexdigest())
