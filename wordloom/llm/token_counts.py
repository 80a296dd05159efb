"""Tokens of the sections of a document, from one encoding of the whole document.

Encoding sections apart gives other tokens where they meet. So the whole text is encoded once, each
token gets its span of characters, and spans are joined with the sections by interval: both are in
order, so a binary search finds the sections a token meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.bpe import CACHE_WORDS, Bpe, held
from wordloom.llm.words import slices


def token_spans(text: str, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last of each token, from the tokens' lengths in bytes.

    A token with only some bytes of a character has that whole character in its span.
    """
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    begins = (data & 0xC0) != 0x80
    number = np.cumsum(begins) - 1
    ends = np.cumsum(widths)
    return number[ends - widths], number[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Section of each token: the one that holds most of its characters, the earlier on a tie; -1 for none.

    Sections ``first[i]:last[i]`` are in order and don't overlap; empty ones hold nothing.
    """
    if not len(first):
        return np.full(len(starts), -1)
    at = np.searchsorted(last, starts, side="right")  # the first section that ends behind the token's start
    best = np.full(len(starts), -1)
    most = np.zeros(len(starts), dtype=np.int64)
    open_ = np.arange(len(starts))
    while len(open_):
        open_ = open_[at[open_] < len(first)]
        open_ = open_[first[at[open_]] < ends[open_]]
        held_chars = np.minimum(ends[open_], last[at[open_]]) - np.maximum(starts[open_], first[at[open_]])
        better = held_chars > most[open_]
        best[open_[better]], most[open_[better]] = at[open_[better]], held_chars[better]
        at[open_] += 1
    return best


def _lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    feeds = np.flatnonzero(points == 10) + 1
    edges = np.concatenate([[0], feeds, [len(points)]])
    return edges[:-1], edges[1:]


def section_tokens(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", sections: str | None = None) -> DataFrame:
    """``key, section, start, end, n_tokens`` for each section of each row, numbered from 0.

    ``sections`` names an array of ``(start, end)`` in characters, in order and without overlap; without it
    every line with its line feed is one, and a text has one more than line feeds. A token counts
    for the section that holds most of its characters, the earlier on a tie, so counts add up to the
    tokens of the whole text; tokens outside all sections are in a last row with section -1.

    NULL and empty texts have no tokens: one empty line, or their own sections with 0. A NULL array has no
    sections. Repeated rows and NULL keys are counted each for itself; other columns play no part.
    """
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"), *([F.col(sections).alias("cut")] if sections else []))
    names = ["key", "section", "start", "end", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(Bpe, path, CACHE_WORDS)
        widths = np.array([len(b) for b in bpe.token_bytes], dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                owners, columns = [], [[], [], [], []]
                for i, (whole, ids) in enumerate(zip(texts, bpe.encode(texts))):
                    starts, ends = token_spans(whole, widths[np.frombuffer(ids, "<i4")])
                    if sections:
                        cut = part.column(2)[i].as_py() or []
                        first, last = (np.array([c[n] for c in cut], dtype=np.int64) for n in ("start", "end"))
                    else:
                        first, last = _lines(whole)
                    counts = np.bincount(attribute(starts, ends, first, last) + 1, minlength=len(first) + 1)
                    rows = [np.arange(len(first)), first, last, counts[1:]]
                    if counts[0]:
                        rows = [np.append(r, x) for r, x in zip(rows, (-1, 0, 0, counts[0]))]
                    owners.append(np.full(len(rows[0]), i))
                    for held_rows, new in zip(columns, rows):
                        held_rows.append(new)
                picked = part.column(0).take(pa.array(np.concatenate(owners)))
                yield pa.RecordBatch.from_arrays([picked, *(pa.array(np.concatenate(c).astype(np.int64)) for c in columns)], names=names)

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in names[1:])])
    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)
