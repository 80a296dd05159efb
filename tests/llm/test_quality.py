import re
from collections import Counter

from wordloom.llm import quality
from wordloom.llm.queries import QUERIES, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    twice = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)


def test_statistics(spark, odd_texts):
    more = ["a b c d e " * 3, "a b c d e f a b c d e", "x\nx\n \n\ny\nx", "a a a a a a a", "# * é\r\n# * é\r\n", "中 文" * 9, "a b c d e a b c d"]
    texts = [*odd_texts, *more]
    rows = [(i, t, "mine") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {r["doc_id"]: r for r in quality.judge(df, []).collect()}
    for i, text in enumerate(texts):
        want = brute_force(text)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, text
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert got[i]["base_failed"] == failed and got[i]["kept"] == (not failed)
    assert quality.judge(df.limit(0), []).count() == 0


def test_rules_cover_what_is_bad(spark):
    good = [(i, "plain words that say something else each time " * 2 + str(i)) for i in range(300)]
    bad = [(1000 + i, "# $ % & # $ % | " * 3 + str(i)) for i in range(150)] + [(2000 + i, "LOUD WORDS ONLY!! " * 4 + str(i)) for i in range(150)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = [(k, 1) for k, _ in good] + [(k, 0) for k, _ in bad] + [(None, 0), (5, None), (1001, 1)]
    rules = quality.learn_rules(quality.labelled(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
    assert 1 <= len(rules) <= quality.MAX_RULES
    rejected = {r["doc_id"] for r in quality.judge(docs, rules).filter("rule IS NOT NULL").collect()}
    assert rejected == {k for k, _ in bad}


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(1, 0)]):
        assert quality.learn_rules(quality.labelled(docs, spark.createDataFrame(rows, "doc_id long, quality int"))) == []


def test_first_rule_wins(spark):
    rules = [(quality.Term("n_words", 5, True),), (quality.Term("n_words", 3, True), quality.Term("n_words", 9, False))]
    df = spark.createDataFrame([(n,) for n in (1, 3, 5, 9)], "n_words long")
    assert [r[0] for r in df.select(quality.decision(rules)).collect()] == [None, 2, 1, 1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    held = labels.filter("pmod(xxhash64(doc_id), 3) = 0")
    rules = quality.learn_rules(quality.labelled(docs, labels.join(held, "doc_id", "left_anti")))
    judged = quality.judge(docs.join(held, "doc_id"), rules).groupBy("quality").agg({"rule": "count", "*": "count"}).collect()
    share = {r["quality"]: r["count(rule)"] / r["count(1)"] for r in judged}
    assert share[1] <= 0.01 and share[0] >= 0.6, share


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    frame = QUERIES["op6_quality"](spark, sf)
    got = frame.collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_force(docs[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
