"""Sentences: a period ends one unless its word is an abbreviation, which the corpus itself tells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.treebank import treebank_tokens

# Least score of an abbreviation, and how probable a period behind one is.
LEAST_SCORE, PERIOD_SHARE = 0.3, 0.99
TYPE = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*\.?"
_CUT = "\x01"


def abbreviations(df: DataFrame, text: str = "text") -> DataFrame:
    """``(type, with_period, without_period, score)`` of every word that stands before a period, lower-cased.

    The score compares how often a word has a period with how often any word has one (a likelihood ratio, for a word that has it
    nearly always), and favours short words, inner periods, and those that never stand without. It is NULL where every word of the
    corpus has a period. From ``LEAST_SCORE`` on a word counts as an abbreviation. Numbers don't.
    """
    found = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(TYPE), F.lit(0))).alias("word"))
    ends = F.endswith("word", F.lit("."))
    counts = found.groupBy(F.when(ends, F.expr("left(word, length(word) - 1)")).otherwise(F.col("word")).alias("type")).agg(
        F.count_if(ends).alias("with_period"), F.count_if(~ends).alias("without_period")
    )
    whole = counts.agg(F.sum("with_period").alias("_periods"), F.sum(F.col("with_period") + F.col("without_period")).alias("_words"))
    # The filter reads the count too, so it stays above the shuffle that both uses of the counts share.
    word_type = F.when(F.col("type").rlike(r"\p{L}"), F.col("with_period")).otherwise(F.lit(0)) > 0
    told = counts.filter(word_type).join(F.broadcast(whole))  # one row
    both, share = F.col("with_period") + F.col("without_period"), F.col("_periods") / F.col("_words")
    usual = F.col("with_period") * F.log(share) + F.col("without_period") * F.log(1 - share)
    as_one = F.col("with_period") * F.log(F.lit(PERIOD_SHARE)) + (both - F.col("with_period")) * F.log(F.lit(1 - PERIOD_SHARE))
    periods = F.length("type") - F.length(F.replace("type", F.lit("."))) + 1
    letters = F.length("type") - periods + 1
    score = -2 * (usual - as_one) * F.exp(-letters) * periods * F.pow(letters, -F.col("without_period"))
    return told.select("type", "with_period", "without_period", F.when(share < 1, score).alias("score"))


def _pieces(text: Column) -> Column:
    """The text cut behind every period, question or exclamation mark that white space follows."""
    marked = F.regexp_replace(F.translate(text, _CUT, " "), "([.?!][\"')\\]»”’]*)\\s+", f"$1{_CUT}")
    return F.split(F.regexp_replace(marked, f"{_CUT}$", ""), _CUT)


def sentences(df: DataFrame, known: DataFrame, text: str = "text", key: str = "id", out: str = "sentences") -> DataFrame:
    """Add ``out``, the sentences of each text; NULL text gives NULL.

    ``known`` has the abbreviations in column ``type``. ``key`` identifies a row. Only numbers of pieces meet the abbreviations
    and come back; texts move only if these are many.
    """
    cut = df.withColumn("_pieces", _pieces(F.col(text)))
    # The word holds no space, so only what follows a piece's last one is searched.
    last = F.transform(
        "_pieces", lambda p: F.regexp_extract(F.lower(F.substring_index(p, " ", -1)), r"([\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*)\.$", 1)
    )
    ends = (
        df.withColumn("_pieces", _pieces(F.col(text)))
        .select(key, F.posexplode(last).alias("_i", "type"))
        .filter("type <> ''")
        .join(known.select("type").distinct(), "type", "left_semi")
        .groupBy(key)
        .agg(F.collect_set("_i").alias("_open"))
    )
    opened = F.coalesce(F.col("_open"), F.array().cast("array<int>"))
    # A piece behind an abbreviation goes on with the sentence before it.
    starts = F.array_except(F.sequence(F.lit(0), F.size("_pieces") - 1), F.transform(opened, lambda i: i + 1))
    upto = F.transform(
        "_starts",
        lambda s, i: F.array_join(F.slice("_pieces", s + 1, F.coalesce(F.get(F.col("_starts"), i + 1), F.size("_pieces")) - s), " "),
    )
    joined = cut.join(ends, key, "left").withColumn("_starts", starts)
    return joined.withColumn(out, upto).drop("_pieces", "_open", "_starts")


def sentence_tokens(df: DataFrame, known: DataFrame, text: str = "text", key: str = "id", out: str = "tokens") -> DataFrame:
    """Add ``out``, the tokens of all sentences of each text in order."""
    cut = sentences(df, known, text, key, "_sentences")
    return cut.withColumn(out, F.flatten(F.transform("_sentences", treebank_tokens))).drop("_sentences")
