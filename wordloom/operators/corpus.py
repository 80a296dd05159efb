"""Corpus preparation: projection, filters, splits, samples, trials and row lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.rand import hash60, pick
from wordloom.functions.text import CONTEXT_TOKENS, word_tokens

# Columns not kept, genre and language wanted, split seed, sampling parameters.
DROPPED = ("artist", "year", "views", "id", "language_cld3", "language_ft")
WANTED = {"tag": "pop", "language": "en"}
SPLIT_SEED = "69"
TRAIN_PERCENT = 80
TRIALS = 10
_CELL_BITS = 16
TRIAL_ONE_IN = 10  # one row in ten


def prepare_corpus(
    df: DataFrame,
    text: str = "lyrics",
    drop: tuple[str, ...] = DROPPED,
    wanted: dict[str, str] = WANTED,
) -> DataFrame:
    """Drop columns, keep rows with the wanted values, leave out rows without a text."""
    out = df.drop(*drop)
    for column, value in wanted.items():
        out = out.filter(F.col(column) == F.lit(value))
    return out.filter(F.col(text).isNotNull())


def is_train(key: Column, percent: int = TRAIN_PERCENT, seed: str = SPLIT_SEED) -> Column:
    return pick(seed, key, 100) < percent


def split(df: DataFrame, key: str = "id", percent: int = TRAIN_PERCENT, seed: str = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test tables by a hash of the key: narrow, and the same after any repartitioning.

    Every row is in one of them; rows with a NULL key are in train.
    """
    train = F.coalesce(is_train(F.col(key), percent, seed), F.lit(True))
    return df.filter(train), df.filter(~train)


def random_split(df: DataFrame, weights: list[float] | None = None, seed: int = 69) -> list[DataFrame]:
    """Spark's own sampler; depends on the partitioning of ``df``."""
    return df.randomSplit(weights or [0.8, 0.2], seed)


def sample_fraction(df: DataFrame, fraction: float, key: str = "id", salt: str = "sample") -> DataFrame:
    """Bernoulli sample without replacement by a hash of the key."""
    return df.filter(hash60(salt, F.col(key)) < F.lit(int(fraction * 2**60)))


def sample_rows(df: DataFrame, n: int, key: str = "id", salt: str = "sample-rows") -> DataFrame:
    """About ``n`` rows: a Bernoulli sample with the fraction n / count."""
    rows = df.count()
    return df if rows <= n else sample_fraction(df, n / rows, key, salt)


def sample_exact(df: DataFrame, n: int, key: str = "id", salt: str = "sample-rows") -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer: those with the smallest hashes, ties by key.

    A histogram of the leading hash bits tells in which of its cells the n-th row lies. Rows in earlier cells
    pass by a filter alone; only that one cell, about ``rows / 2^16`` rows, is ordered. NULL keys come last.
    """
    hashed = df.withColumn("_hash", F.coalesce(hash60(salt, F.col(key)), F.lit(2**60 - 1)))
    cell = F.shiftright("_hash", 60 - _CELL_BITS)
    counts = sorted(tuple(r) for r in hashed.groupBy(cell.alias("cell")).count().collect())
    taken, edge = 0, None
    for number, count in counts:
        if taken + count > n:
            edge = number
            break
        taken += count
    if edge is None:
        return df
    inside = hashed.filter(cell < edge)
    last = hashed.filter(cell == edge).orderBy("_hash", F.col(key).asc_nulls_last()).limit(n - taken)
    return inside.unionByName(last).drop("_hash")


def trials(df: DataFrame, key: str = "id", n: int = TRIALS, one_in: int = TRIAL_ONE_IN, salt: str = "trial") -> DataFrame:
    """``n`` independent samples in one pass: a row appears once for each trial that drew it."""
    chosen = F.filter(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda t: pick(F.concat(F.lit(salt), t.cast("string")), F.col(key), one_in) == 0,
    )
    return df.select("*", F.explode(chosen).alias("trial"))


def short_texts(df: DataFrame, text: str = "text", n: int = CONTEXT_TOKENS) -> DataFrame:
    """Texts too short to give an example, with their token counts."""
    counted = df.withColumn("n_tokens", F.size(word_tokens(F.col(text))))
    return counted.filter(F.col("n_tokens") <= n)


def known_targets(examples: DataFrame, label: str = "label") -> DataFrame:
    """Examples whose target is in the vocabulary (index 1 marks an unknown word)."""
    return examples.filter(F.col(label) != 1)


def lookup(df: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``df`` whose key is listed; an absent key gives no row."""
    return df.join(keys.select(key), key, "left_semi")
