"""Text and token-list functions as column expressions; NULL text gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.rand import pick

# Token patterns and the punctuation removed by vocabulary normalisation.
WORD = r"[\p{L}\p{N}_]+"
WORDPUNCT = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
NON_SPACE = r"[^ \t\n\x0B\f\r]+"
PUNCT = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
LEFT_PAD = "<s>"
RIGHT_PAD = "</s>"
CONTEXT_TOKENS = 10


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_tokens(text: Column) -> Column:
    """Maximal runs of Unicode letters, digits and underscores, case kept."""
    return _matches(text, WORD)


def lower_tokens(text: Column) -> Column:
    return word_tokens(F.lower(text))


def standardize(text: Column) -> Column:
    """Lower case without ASCII punctuation."""
    return F.translate(F.lower(text), PUNCT, "")


def standard_tokens(text: Column) -> Column:
    """Whitespace-separated pieces of the standardised text."""
    return _matches(standardize(text), NON_SPACE)


def wordpunct_tokens(text: Column) -> Column:
    """Lower-cased words and single punctuation marks, the tokens of the n-gram model."""
    return _matches(F.lower(text), WORDPUNCT)


def pad(tokens: Column, order: int = 3, times: int = 1) -> Column:
    """Boundary markers on both sides, ``order - 1`` for each time the list is padded."""
    k = (order - 1) * times
    return F.concat(
        F.array_repeat(F.lit(LEFT_PAD), k), tokens, F.array_repeat(F.lit(RIGHT_PAD), k)
    )


def without_markers(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: (t != LEFT_PAD) & (t != RIGHT_PAD))


def windows(tokens: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring tokens as an array of structs ``t0..t{size-1}``.

    Built from ``size`` shifted copies of the list, so one row grows by a factor of ``size`` and
    no token list is carried along by every exploded row. ``tokens`` should be a plain column: an
    expression would be evaluated once per use.
    """
    count = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
    shifted = [F.slice(tokens, i + 1, count).alias(f"t{i}") for i in range(size)]
    return F.arrays_zip(*shifted)


def join_tokens(tokens: Column, start: Column | int, length: int | Column) -> Column:
    """``length`` tokens from the 0-based ``start``, joined by one space."""
    start = start if isinstance(start, Column) else F.lit(start)
    return F.concat_ws(" ", F.slice(tokens, (start + 1).cast("int"), length))


def snippet(text: Column, tokens: Column, key: Column, n: int = CONTEXT_TOKENS, salt: str = "snippet") -> Column:
    """A random run of ``n`` tokens, the last run excluded; a text of at most ``n`` tokens as it is."""
    start = pick(salt, key, F.size(tokens) - n)
    return F.when(F.size(tokens) <= n, text).when(tokens.isNotNull(), join_tokens(tokens, start, n))


def snippet_inclusive(tokens: Column, key: Column, n: int = CONTEXT_TOKENS, salt: str = "snippet-inclusive") -> Column:
    """A random run of ``n`` tokens, the last run included; NULL for shorter texts."""
    start = pick(salt, key, F.size(tokens) - n + 1)
    return F.when(F.size(tokens) >= n, join_tokens(tokens, start, n))


def slide(context: Column, word: Column) -> Column:
    """Append a word and drop the first token."""
    longer = F.concat(context, F.array(word))
    return F.slice(longer, 2, F.size(longer))


def add_prompt(text: Column, prompt: str) -> Column:
    return F.concat(F.lit(prompt), text)


def drop_prompt(text: Column, prompt: str) -> Column:
    """Remove the prompt wherever it appears."""
    return F.replace(text, F.lit(prompt), F.lit(""))
