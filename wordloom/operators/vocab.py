"""Capped frequency vocabulary, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import CONTEXT_TOKENS, standard_tokens
from wordloom.operators.heavy import frequent_counts
from wordloom.operators.lookups import BROADCAST_BYTES, lookup_positions
from wordloom.session import durable

# Reserved entries and the caps of the three models.
PAD, UNK = "", "[UNK]"
PAD_IDX, UNK_IDX, FIRST_IDX = 0, 1, 2
MAX_TOKENS = 15_000
MAX_TOKENS_VECTORS = 20_000


def token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``(token, freq)`` over all texts; counts are summed on the map side before the shuffle."""
    return (
        df.select(F.explode(standard_tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"))
    )


def vocabulary(df: DataFrame, text: str = "text", max_tokens: int = MAX_TOKENS, summaries: bool = False) -> DataFrame:
    """``(idx, token, freq)``: padding, unknown, then the most frequent tokens.

    Equal counts are ordered by token, descending. ``max_tokens`` includes the two reserved rows. With ``summaries`` the texts
    are read twice and only candidates are shuffled (``heavy.py``); where these can't decide, all words are counted as without.
    """
    room = max(max_tokens - FIRST_IDX, 0)
    found = frequent_counts(df, room, text) if summaries else None
    counts = durable(token_counts(df, text) if found is None else found, "token-counts")
    # The frequency of the last word that gets in: then only the words of the cap and its ties are ordered.
    spectrum = counts.groupBy("freq").count()
    order = Window.orderBy(F.desc("freq")).rowsBetween(Window.unboundedPreceding, 0)
    cut = spectrum.withColumn("_upto", F.sum("count").over(order)).filter(F.col("_upto") >= room).agg(F.max("freq")).first()[0]
    near = counts.filter(F.col("freq") >= cut) if cut is not None else counts
    top = near.orderBy(F.desc("freq"), F.desc("token")).limit(room)
    # The window has no partition, but at most ``max_tokens`` rows.
    rank = F.row_number().over(Window.orderBy(F.desc("freq"), F.desc("token")))
    words = top.select((rank + (FIRST_IDX - 1)).alias("idx"), "token", "freq")
    reserved = df.sparkSession.createDataFrame(
        [(PAD_IDX, PAD, None), (UNK_IDX, UNK, None)], "idx int, token string, freq bigint"
    )
    return reserved.unionByName(words)


def vocabulary_head(vocab: DataFrame, n: int = 100) -> DataFrame:
    return vocab.orderBy("idx").limit(n)


def encode(
    df: DataFrame,
    text: Column,
    vocab: DataFrame,
    row_key: list[str],
    n: int = CONTEXT_TOKENS,
    out: str = "context_ids",
    limit: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``out``: indexes of the first ``n`` tokens, unknown as 1, padded with 0 on the right."""
    words = vocab.filter(F.col("idx") >= FIRST_IDX)
    found = lookup_positions(
        df, F.slice(standard_tokens(text), 1, n), n, words, "token", "idx", F.lit(UNK_IDX), out, row_key, limit
    )
    padding = F.array_repeat(F.lit(PAD_IDX), F.lit(n) - F.size(out))
    return found.withColumn(out, F.concat(F.col(out), padding))


def encode_word(
    df: DataFrame, word: Column, vocab: DataFrame, row_key: list[str], out: str = "label", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``out``: the index of one word, that is of its first standardised piece."""
    return encode(df, word, vocab, row_key, 1, "_ids", limit).withColumn(out, F.get("_ids", F.lit(0))).drop("_ids")


def decode(df: DataFrame, vocab: DataFrame, idx: str = "idx", out: str = "token") -> DataFrame:
    """Add the token of an index column."""
    words = vocab.select(F.col("idx").alias(idx), F.col("token").alias(out))
    return df.join(words, idx, "left")
