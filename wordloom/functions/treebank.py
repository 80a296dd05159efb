"""Word tokens with split contractions and quotes, by ordered rewrite rules; all built-in expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.text import NON_SPACE

# Published patterns of Penn-Treebank tokenisation, as (pattern, replacement) in their order, written without
# look-around. Texts are padded with a space on both sides before the last group.
RULES = [
    ("([«“‘„]|`+)", " $1 "),
    ('^"', "`` "),
    ("(``)", " $1 "),
    ("([ (\\[{<])(\"|'')", "$1 `` "),
    ("'([A-CE-LO-RU-Za-ce-lo-ru-z0-9_]|[^\\x00-\\x7F])([^\\p{L}\\p{N}_]|\\z)", "' $1$2"),
    ("([^.])(\\.)([\\])}>\"'»”’ ]*)[ \\t\\n\\x0B\\f\\r]*\\z", "$1 $2 $3 "),
    ("([:,])([^0-9])", " $1 $2"),
    ("([:,])\\z", " $1 "),
    ("(\\.{2,})", " $1 "),
    ("([;@#$%&?!*])", " $1 "),
    ("([^'])' ", "$1 ' "),
    ("([\\]\\[(){}<>])", " $1 "),
    ("(--)", " $1 "),
]
ENDING_RULES = [
    ("([»”’])", " $1 "),
    ("('')", " $1 "),
    ('"', " '' "),
    ("[ \\t\\n\\x0B\\f\\r]+", " "),
    ("([^' ])('[sSmMdD]|') ", "$1 $2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
]
# Words that are two, the second pair of lists with an apostrophe in front.
JOINED_WORDS = [("can", "not"), ("d", "'ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("more", "'n"), ("wan", "na"), ("'t", "is"), ("'t", "was")]


def contraction_rules() -> list[tuple[str, str]]:
    """Rules for the joined words; each is there twice, as neighbours share the space between them."""
    rules = [(f"(?i) ({a})({b}) ", " $1 $2 ") for a, b in JOINED_WORDS]
    return [rule for rule in rules for _ in range(2)]


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda out, rule: F.regexp_replace(out, rule[0], rule[1]), rules, text)


# The rules that set single marks apart touch different characters, so neighbours among them are one pass.
_QUOTES = ("``", "''", "«", "“", "‘", "„", "`", '"', "»", "”", "’")
_DOTS_MARKS, _BRACKETS_DASHES = "\\.{2,}|[;@#$%&?!*]", "[\\]\\[(){}<>]|--"
_SPACES = ENDING_RULES[3]


def _apart(*marks: str) -> tuple[str, str]:
    return f"({'|'.join(marks)})", " $1 "


def _holds(text: Column, parts: tuple[str, ...] | list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(part)) for part in parts])


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _split_joined(text: Column) -> Column:
    """``contraction_rules`` in one pass: the space behind a word is only looked at, so a neighbour still has it in front."""
    pattern = "|".join(f"{a}(?={b} )" for a, b in JOINED_WORDS)
    split = F.regexp_replace(F.regexp_replace(text, *_SPACES), f" ({pattern})", " $1 ")
    return F.when(_holds(text, [a + b for a, b in JOINED_WORDS]), split).otherwise(text)


def _set_apart(text: Column) -> Column:
    """``RULES`` and ``ENDING_RULES``; without quotes or apostrophes only those that can match."""

    def padded(rules: list[tuple[str, str]]) -> Column:
        return F.concat(F.lit(" "), rewrite(text, rules), F.lit(" "))

    plain = padded([*RULES[5:8], _apart(_DOTS_MARKS, _BRACKETS_DASHES)])
    with_apostrophe = padded([*RULES[4:8], _apart(_DOTS_MARKS), RULES[10], _apart(_BRACKETS_DASHES)])
    with_quotes = padded([*RULES[:8], _apart(_DOTS_MARKS), RULES[10], _apart(_BRACKETS_DASHES)])
    return (
        F.when(_holds(text, _QUOTES), rewrite(with_quotes, ENDING_RULES))
        .when(F.contains(text, F.lit("'")), rewrite(with_apostrophe, ENDING_RULES[3:]))
        .otherwise(plain)
    )


def treebank_tokens(sentence: Column) -> Column:
    """Lower-cased tokens of a sentence; only a final period is split off. NULL gives NULL.

    As by ``RULES``, ``ENDING_RULES`` and ``contraction_rules`` in their order.
    """
    done = _bound(_bound(F.lower(sentence), _set_apart), _split_joined)
    return F.regexp_extract_all(done, F.lit(NON_SPACE), F.lit(0))
