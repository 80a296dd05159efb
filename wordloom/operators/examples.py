"""Next-word examples: a context of n tokens and the token after it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.rand import pick
from wordloom.functions.text import CONTEXT_TOKENS, join_tokens, standard_tokens, windows, word_tokens
from wordloom.operators.vocab import encode, encode_word


def tokenizer(compat_tokenizers: bool = False) -> Callable[[Column], Column]:
    """The vocabulary's own tokens, or with ``compat_tokenizers`` case-kept word tokens."""
    return word_tokens if compat_tokenizers else standard_tokens


def random_examples(
    df: DataFrame,
    text: str = "text",
    key: str = "id",
    n: int = CONTEXT_TOKENS,
    salt: str | Column = "example",
    tokens: Callable[[Column], Column] = word_tokens,
    passes: int | None = None,
) -> DataFrame:
    """One example per text of more than ``n`` tokens: ``(.., pos, context, next_word)``.

    Every column but the text is kept. ``passes`` gives each text that many examples, drawn apart
    and numbered in ``pass``, as training epochs draw a new one each time.
    """
    keep = [c for c in df.columns if c != text]
    salt = salt if isinstance(salt, Column) else F.lit(salt)

    def cut(salt: Column, *fields: Column) -> Column:
        start = pick(salt, F.col(key), F.size("_t") - n)
        return F.struct(
            *fields,
            start.cast("int").alias("pos"),
            join_tokens(F.col("_t"), start, n).alias("context"),
            F.get("_t", (start + n).cast("int")).alias("next_word"),
        )

    if passes is None:
        made = F.array(cut(salt))
    else:
        made = F.transform(
            F.sequence(F.lit(0), F.lit(passes - 1)),
            lambda i: cut(F.concat(salt, F.lit("/"), i.cast("string")), i.alias("pass")),
        )
    # An explode of nothing drops short texts without tokenising twice, as a filter would.
    return (
        df.select(*keep, tokens(F.col(text)).alias("_t"))
        .select(*keep, F.explode(F.when(F.size("_t") > n, made)).alias("_e"))
        .select(*keep, "_e.*")
    )


def sliding_examples(
    df: DataFrame,
    text: str = "text",
    key: str = "id",
    n: int = CONTEXT_TOKENS,
    tokens: Callable[[Column], Column] = word_tokens,
) -> DataFrame:
    """All examples of every text: ``(key, pos, context, next_word)``."""
    return (
        df.select(key, tokens(F.col(text)).alias("_t"))
        .select(key, F.posexplode(windows(F.col("_t"), n + 1)).alias("pos", "_w"))
        .select(
            key,
            "pos",
            F.concat_ws(" ", *[F.col("_w")[f"t{i}"] for i in range(n)]).alias("context"),
            F.col("_w")[f"t{n}"].alias("next_word"),
        )
    )


def encoded_examples(examples: DataFrame, vocab: DataFrame, row_key: list[str], n: int = CONTEXT_TOKENS) -> DataFrame:
    """Add ``context_ids`` and ``label``."""
    out = encode(examples, F.col("context"), vocab, row_key, n)
    return encode_word(out, F.col("next_word"), vocab, row_key)
