import public_tokenizers
from tokenizers import Tokenizer

from wordloom.llm import token_counts
from wordloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_force(text, sections=None):
    """Rows (section, start, end, tokens) by comparing every token with every section."""
    text = text or ""
    if sections is None:
        sections, at = [], 0
        for line in text.split("\n"):
            sections.append((at, min(len(text), at + len(line) + 1)))
            at += len(line) + 1
    counts = [0] * (len(sections) + 1)
    for a, b in Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).offsets:
        held = [max(0, min(b, d) - max(a, c)) for c, d in sections]
        best = max(held, default=0)
        counts[held.index(best) if best else -1] += 1
    rows = [(i, c, d, counts[i]) for i, (c, d) in enumerate(sections)]
    return rows + ([(-1, 0, 0, counts[-1])] if counts[-1] else [])


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    return {k: sorted(v, key=lambda r: (r[0] < 0, r[0])) for k, v in out.items()}


def test_lines(spark, odd_texts):
    texts = [t for t in odd_texts if t is None or len(t) < 5000]
    texts += ["a\n\nb", "\n\n\n", "one  \n  two", "end\n", "中\n😀\n"]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, section int")
    got = collected(token_counts.section_tokens(df.repartition(3), PATH))
    assert got == {i: brute_force(t) for i, t in enumerate(texts)}


def test_given_sections(spark):
    text = "heading and body text of unbelievable length, 中文😀 end"
    cuts = {0: [(0, 3), (3, 3), (3, 20), (25, 50)], 1: [], 2: None, 3: [(0, len(text))], 4: [(i, i + 1) for i in range(len(text))]}
    df = spark.createDataFrame([(k, text, v) for k, v in cuts.items()], "doc_id long, text string, cuts array<struct<start:long,end:long>>")
    got = collected(token_counts.section_tokens(df, PATH, sections="cuts"))
    assert got == {k: brute_force(text, v or []) for k, v in cuts.items()}


def test_null_keys_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    got = collected(token_counts.section_tokens(df, PATH))
    assert got == {None: [(0, 0, 3, 2)] * 2, 1: [(0, 0, 0, 0)]}
    assert token_counts.section_tokens(df.limit(0), PATH).count() == 0


def test_query(spark, sf):
    reference = Tokenizer.from_file(PATH)
    got = collected(QUERIES["op8_token_counts"](spark, sf))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        assert sum(x[3] for x in got[r["doc_id"]]) == len(reference.encode(r["text"], add_special_tokens=False).ids)
        assert len(got[r["doc_id"]]) == r["text"].count("\n") + 1
