"""The most frequent words of a corpus without a shuffle of every distinct word.

First pass: each task keeps a summary of at most ``size`` counters; when it is full, the smallest half of the counts is taken off
all counters (Misra and Gries, by halves). Summaries of tasks add up to one with the sum of their errors, so any word that
occurs more often than the whole error is in some summary. Second pass: these candidates, and only they, are counted exactly
in each task. If the last word that gets into the vocabulary isn't above the error, or ties reach it, the words are all counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import standard_tokens
from wordloom.operators.lookups import fits_broadcast
from wordloom.session import durable

SUMMARY_WORDS = 1 << 17  # counters of a task
KEPT = 4  # counters that a task sends, for each word that is asked for
SENT_BYTES = 16 << 20  # of candidates, the most that all tasks get


class Summary:
    """Counts that are too low by at most ``error``; words without a counter occurred at most ``error`` times."""

    def __init__(self, size: int):
        self.size, self.error, self.counts = size, 0, Counter()

    def add(self, words: list[str]) -> None:
        self.counts.update(words)
        while len(self.counts) > self.size:
            # The count of rank size / 2 goes off all counters, so at least half of them are free again.
            cut = sorted(self.counts.values())[len(self.counts) - self.size // 2 - 1]
            self.counts = Counter({w: c - cut for w, c in self.counts.items() if c > cut})
            self.error += cut

    def keep(self, n: int) -> None:
        """Drop all counters but the ``n`` largest and those that equal the last of them."""
        if len(self.counts) > n:
            cut = sorted(self.counts.values(), reverse=True)[n - 1]
            self.error += max((c for c in self.counts.values() if c < cut), default=0)
            self.counts = Counter({w: c for w, c in self.counts.items() if c >= cut})


def summaries(texts: DataFrame, text: str, keep: int, size: int = SUMMARY_WORDS) -> DataFrame:
    """``(word, least, error)``: the ``keep`` largest counters of every task, and one row without a word per task with its error."""
    tokens = texts.select(standard_tokens(F.col(text)).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                summary.add(batch.column(0).slice(start, 256).flatten().to_pylist())
        summary.keep(keep)
        words = list(summary.counts)
        columns = [pa.array([*words, None], pa.string()), pa.array([*(summary.counts[w] for w in words), 0], pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([0] * len(words) + [summary.error], pa.int64())], names=["word", "least", "error"])

    return tokens.mapInArrow(run, "word string, least long, error long")


def frequent_counts(df: DataFrame, n: int, text: str = "text", size: int = SUMMARY_WORDS) -> DataFrame | None:
    """``(token, freq)``, exact, of words among which the ``n`` most frequent ones and all that tie with the last are.

    None if the summaries can't tell: fewer than ``n`` words are certain to occur more often than any word may that has no
    counter, or there are too many candidates to send to all tasks.
    """
    if n < 1:
        return None
    held = durable(summaries(df, text, KEPT * n, size), "summaries")
    error = held.agg(F.sum("error")).first()[0] or 0
    merged = held.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("least").alias("least"))
    merged = durable(merged, "counters")
    # The n-th largest of the lower bounds: the n-th word occurs at least that often.
    last = merged.orderBy(F.desc("least")).limit(n).agg(F.count("*").alias("n"), F.min("least").alias("least")).first()
    if error and (last["n"] < n or last["least"] <= error):
        return None
    # A word below this can't be among them: its count is at most its lower bound and the whole error.
    level = last["least"] - error if last["n"] == n else 0
    candidates = merged.filter(F.col("least") >= level).select("word")
    if not fits_broadcast(candidates, ["word"], SENT_BYTES):
        return None
    known = frozenset(r["word"] for r in candidates.collect())
    tokens = df.select(standard_tokens(F.col(text)).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found.update(filter(known.__contains__, batch.column(0).slice(start, 256).flatten().to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["token", "freq"])

    return tokens.mapInArrow(count, "token string, freq long").groupBy("token").agg(F.sum("freq").alias("freq"))
