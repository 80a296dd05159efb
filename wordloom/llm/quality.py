"""Quality of documents by a learned decision list; built-in expressions alone.

Sequential covering: a rule starts empty and takes the threshold with the best gain until it covers no
good document; it is cut back on rows it hasn't grown on, and is taken if it is precise there; the
rows it covers leave, and the next rule starts. Every step is one small aggregation: counts by
statistic, bin and label. The rules are one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.session import durable

LABELLED_ROWS = 16_384  # at most so many labelled documents are learned from
BINS = 32
MAX_RULES = 8
MAX_TERMS = 4
MIN_PRECISION = 0.97
MIN_COVERED = 8
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_GRAM = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share")


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts and shares of ``text``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``n_repeat_words`` counts the words in 5-word windows that occur
    twice or more in the text, compared by 64-bit hashes; every other number is exact. NULL texts
    count as empty: all zero. Texts are measured whole; columns of the same names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(_WORD))
    first = df.withColumns(
        {
            "_words": F.regexp_extract_all(whole, F.lit(_WORD + "+"), F.lit(0)),
            "_lines": lines,
            "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
            "_upper": F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long"),
            "_marks": F.regexp_count(whole, F.lit(r"[!?]")).cast("long"),
        }
    )
    words = F.col("_words")
    last = F.size(words) - _GRAM
    grams = F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(_GRAM)])),
    ).otherwise(F.array().cast("array<bigint>"))
    second = first.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.concat_ws("", words)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_grams": grams,
        }
    ).drop("_words", "_lines")
    # Only texts with a repeated window sort their windows.
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.when(
        repeated, F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    third = second.withColumn("_placed", placed).drop("_grams")
    twice = F.filter(
        "_placed",
        lambda x, k: (F.get(F.col("_placed"), k - 1)["g"] == x["g"]) | (F.get(F.col("_placed"), k + 1)["g"] == x["g"]),
    )
    fourth = third.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_placed")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-_GRAM).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda done, s: F.struct(s.alias("last"), (done["sum"] + F.least(F.lit(_GRAM), s - done["last"])).alias("sum")),
        lambda done: done["sum"],
    )
    fifth = fourth.withColumn("n_repeat_words", covered).drop("_starts")

    def share(part: str, of: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(of)), F.lit(0.0))

    shares = {
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("_upper", "word_chars"),
        "mark_share": share("_marks", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
    }
    counts = [F.col(c) for c in COUNTS]
    made = F.struct(*counts, *[column.alias(name) for name, column in shares.items()])
    names = [*COUNTS, *shares]
    # A generator, because a filter on a plain column would be pushed into the steps above, whose
    # arrays would then be made anew for each of their elements.
    return fifth.select(*[f"`{c}`" for c in df.columns if c not in names], F.inline(F.array(made)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Term:
    """``feature >= threshold``, or below it."""

    feature: str
    threshold: float
    above: bool

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.above else F.col(self.feature) < self.threshold


Rule = tuple[Term, ...]


def _all_of(rule: Rule) -> Column:
    out = F.lit(True)
    for term in rule:
        out = out & term.column()
    return out


def _any_of(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all_of(rule)
    return out


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; NULL if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all_of(rule), F.lit(number)).otherwise(out)
    return out


def _gain(good0: int, bad0: int, good: int, bad: int) -> float:
    """FOIL gain of a term that leaves ``bad`` rows to reject and ``good`` ones by mistake."""
    return bad * (log2(bad / (bad + good)) - log2(bad0 / (bad0 + good0))) if bad else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_TERMS:
        bins = [
            F.struct(F.lit(f).alias("feature"), sum((F.col(f) >= c).cast("int") for c in cuts[f]).alias("bin"))
            for f in FEATURES
            if cuts[f]
        ]
        if not bins:
            return rule
        counts = rows.filter(_all_of(rule)).select("bad", F.inline(F.array(*bins))).groupBy("feature", "bin", "bad").count()
        held: dict[tuple[str, int, bool], int] = {(r["feature"], r["bin"], r["bad"]): r["count"] for r in counts.collect()}
        best, chosen = 0.0, None
        totals = [sum(n for (f, _, b), n in held.items() if f == next(x for x in FEATURES if cuts[x]) and b == bad) for bad in (False, True)]
        if not totals[1] or not totals[0]:
            return rule
        for feature in FEATURES:
            for number, cut in enumerate(cuts[feature], 1):
                over = [sum(held.get((feature, b, bad), 0) for b in range(number, len(cuts[feature]) + 1)) for bad in (False, True)]
                for above in (True, False):
                    good, bad = over if above else (totals[0] - over[0], totals[1] - over[1])
                    gain = _gain(*totals, good, bad)
                    if gain > best and bad >= MIN_COVERED:
                        best, chosen = gain, Term(feature, cut, above)
        if chosen is None:
            return rule
        rule += (chosen,)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest beginning of ``rule`` that is best on ``rows``, with its good and bad rows."""
    tries = [rule[:n] for n in range(1, len(rule) + 1)]
    counts = [
        F.count_if(_all_of(t) & (F.col("bad") == bad)).alias(f"c{i}{int(bad)}") for i, t in enumerate(tries) for bad in (False, True)
    ]
    row = rows.agg(*counts).first()
    scored = [(row[f"c{i}0"], row[f"c{i}1"]) for i in range(len(tries))]
    worth = [(bad - good) / (bad + good) if bad + good else -1.0 for good, bad in scored]
    i = worth.index(max(worth))
    return tries[i], *scored[i]


def learn_rules(rows: DataFrame, key: str = "doc_id") -> list[Rule]:
    """Rules that reject, from ``rows`` with the features and ``bad``; none without rows of both labels.

    A third of the rows, by hash of the key, only prunes and accepts rules. Learning stops at the
    first rule whose precision there is below ``MIN_PRECISION``.
    """
    part = F.pmod(F.xxhash64(F.lit("prune"), F.col(key)), F.lit(3)) == 0
    marked = rows.withColumn("_prune", F.coalesce(part, F.lit(False)))
    shares = [i / BINS for i in range(1, BINS)]
    quantiles = marked.filter("bad").agg(*[F.percentile_approx(f, shares, 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(quantiles[f] or [])) for f in FEATURES}
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        left = marked.filter(~_any_of(rules))
        rule = _grow(left.filter(~F.col("_prune")), cuts)
        if not rule:
            break
        rule, good, bad = _prune(left.filter("_prune"), rule)
        if bad < MIN_COVERED or bad < MIN_PRECISION * (bad + good):
            break
        rules.append(rule)
    return rules


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """Features and ``bad`` of at most ``LABELLED_ROWS`` labelled documents, those with the smallest hashes.

    A key with several labels is bad if one of them is; NULL keys and labels are left out.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(key).agg((F.min(quality) == 0).alias("bad"))
    share = min(1.0, 1.5 * LABELLED_ROWS / max(1, labels.count()))
    hashed = known.withColumn("_h", F.xxhash64(F.lit("label"), F.col(key)))
    bound = min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))
    chosen = hashed.filter(F.col("_h") <= bound).orderBy("_h").limit(LABELLED_ROWS).drop("_h")
    return durable(statistics(docs.select(key, text).join(F.broadcast(chosen), key), text).select(key, "bad", *FEATURES), "labelled")


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Add the statistics, ``base_failed``, ``rule`` (the first that rejects) and ``kept``.

    NULL and empty texts have no words and fail the base rule. Repeated rows get equal verdicts.
    """
    return statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )
