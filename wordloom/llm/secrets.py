"""Secrets in text, and credentials whose parts count only together; built-in expressions alone.

Patterns give matches and the text between them, so positions are running sums of lengths. Weak
parts (account names, bare keys, addresses) are joined by interval with other parts of the same
text: a span and its scope are cut into fixed buckets of code points, equal buckets meet, and the
exact distance decides. Spans of a kind never overlap, so a bucket holds a bounded number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.lookups import fits_broadcast
from wordloom.session import durable

SCOPE = 160  # code points between two parts of one credential
_BUCKET = 512
SENT_BYTES = 16 << 20  # of span lists, the most that is broadcast

# Kinds in their order with pattern, group that is measured, and its least length. A run
# that has its least length in the pattern is the same as one that is measured afterwards.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("account", r"""(?i:user(?:_?name)?|login|client_?id|account|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]+)""", 1, 3),
    ("key", r"[A-Za-z0-9+/]{40,}", 0, 40),
    ("address", r"(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|s3)://([A-Za-z0-9.@:_/-]+)", 1, 4),
)
BASE = ("assign", "access", "hex")
ROLES = {"assign": "secret", "access": "name", "hex": "secret", "account": "name", "key": "secret", "address": "place"}
_NUMBER = {kind: i for i, (kind, *_) in enumerate(KINDS)}


def _pieces(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of every match with the length before it since the last one, itself and its measured part."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.transform(F.split(text, pattern, -1), F.char_length)
    zipped = F.arrays_zip(
        F.transform(found, F.char_length).alias("size"),
        F.transform(measured, F.char_length).alias("measured"),
        F.slice(between, 1, F.size(found)).alias("gap"),
    )
    number = F.lit(_NUMBER[kind])
    shaped = F.transform(
        zipped,
        lambda x, i: F.struct(
            number.alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["size"].alias("size"), x["measured"].alias("measured")
        ),
    )
    none = F.array().cast("array<struct<kind:int,pos:int,gap:int,size:int,measured:int>>")
    return F.when(text.rlike(pattern), shaped).otherwise(none)


def _buckets(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / _BUCKET), F.floor(end / _BUCKET)))


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak spans that have the complementary parts within ``scope``: names need a secret and the
    reverse, a place needs both."""
    weak = spans.filter(~F.col("kind").isin([_NUMBER[k] for k in BASE]))
    wide = weak.select("row", "kind", "start", "end", _buckets(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope).alias("bucket"))
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k, *_ in KINDS]), F.col("kind") + 1)
    parts = spans.select(
        "row", role.alias("role"), F.col("kind").isin([_NUMBER[k] for k in BASE]).alias("is_base"), F.col("start").alias("other_start"), F.col("end").alias("other_end"),
        _buckets(F.col("start"), F.col("end")).alias("bucket"),
    ).filter("role <> 'place'")
    near = (F.col("other_start") <= F.col("end") + scope) & (F.col("other_end") >= F.col("start") - scope)
    apart = (F.col("other_end") <= F.col("start")) | (F.col("other_start") >= F.col("end"))
    met = wide.join(parts, ["row", "bucket"]).filter(near)
    # The same characters are no second part, and a weak span over a base one says nothing new.
    held = (
        met.groupBy("row", "kind", "start", "end")
        .agg(
            F.bool_or((F.col("role") == "name") & apart).alias("named"),
            F.bool_or((F.col("role") == "secret") & apart).alias("secret"),
            F.bool_or(F.col("is_base") & ~apart).alias("known"),
        )
        .filter(~F.col("known"))
    )
    own = F.element_at(F.array(*[F.lit(ROLES[k]) for k, *_ in KINDS]), F.col("kind") + 1)
    enough = (
        F.when(own == "name", F.col("secret")).when(own == "secret", F.col("named")).otherwise(F.col("named") & F.col("secret"))
    )
    return held.filter(enough).select("row", "kind", "start", "end")


def _joined(spans: str | Column) -> Column:
    names = F.array(*[F.lit(kind) for kind, *_ in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
        ),
    )


def find_secrets(df: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Add ``secret_spans``: an array of ``(start, kind, end)`` in the order of the text.

    Base kinds: assignments of passwords and tokens, access identifiers and long hex runs, each
    leftmost and without overlap, those too short dropped. Weak kinds: account names, bare keys of 40 or more
    characters and addresses; they are reported only with their complementary parts within ``scope``
    code points. ``kind`` is the place in ``KINDS``; positions are code points, the end exclusive.

    NULL and empty texts have no spans. Repeated rows are searched each for itself, keys and other
    columns play no part and are returned; a column ``secret_spans`` is replaced. Texts are searched whole.
    """
    others = [c for c in df.columns if c != "secret_spans"]
    whole = F.coalesce(F.col("held_text"), F.lit(""))
    pieces = F.flatten(F.array(*[_pieces(whole, kind, pattern, group) for kind, pattern, group, _ in KINDS]))
    found = durable(
        df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("held"), F.col(f"`{text}`").alias("held_text"))
        .select("held", pieces.alias("pieces"))
        .withColumn("row", F.monotonically_increasing_id()),
        "matches",
    )
    ordered = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*[F.lit(n) for *_, n in KINDS]), F.col("kind") + 1)
    spans = (
        found.select("row", F.inline("pieces"))
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(ordered))
        .filter(F.col("measured") >= least)
        .select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    spans = durable(spans, "spans")
    base = spans.filter(F.col("kind").isin([_NUMBER[k] for k in BASE]))
    listed = (
        base.unionByName(_linked(spans, scope))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("secret_spans"))
    )
    # Few documents hold spans: if they measure little, the texts need not move.
    listed = durable(listed, "listed")
    if fits_broadcast(listed, ["row", "secret_spans"], SENT_BYTES):
        listed = F.broadcast(listed)
    none = F.array().cast(listed.schema["secret_spans"].dataType)
    return found.select("row", "held").join(listed, "row", "left").select(
        *[F.col(f"held.`{c}`") for c in others], F.coalesce("secret_spans", none).alias("secret_spans")
    )


def report(found: DataFrame, key: str = "doc_id", spans: str = "secret_spans") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    base = F.filter(spans, lambda x: x["kind"] < len(BASE))

    def count(number: int) -> Column:
        return F.size(F.filter(spans, lambda x: x["kind"] == number)).cast("long")

    counts = [count(n).alias(f"n_{kind}") for n, kind in enumerate(BASE)]
    return found.select(key, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col(spans)).alias("spans"))


def redact(found: DataFrame, text: str = "text", spans: str = "secret_spans", mask: str = "[SECRET]") -> DataFrame:
    """Put ``mask`` in the place of every span; spans that touch or overlap become one.

    Texts without spans, NULL included, stay as they are. The work for a text is its length times its
    number of spans.
    """
    start = F.struct(F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))
    merged = F.aggregate(
        spans,
        F.array(start),
        lambda done, x: F.when(
            x["start"] <= F.element_at(done, -1)["end"],
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    with_runs = found.withColumn("_runs", merged)
    before = F.transform(
        F.slice("_runs", 2, F.greatest(F.size("_runs") - 1, F.lit(0))),
        lambda x, i: F.substring(
            F.col(text),
            (F.greatest(F.get(F.col("_runs"), i)["end"], F.lit(0)) + 1).cast("int"),
            (x["start"] - F.greatest(F.get(F.col("_runs"), i)["end"], F.lit(0))).cast("int"),
        ),
    )
    rest = F.substring(F.col(text), (F.element_at("_runs", -1)["end"] + 1).cast("int"), F.char_length(text))
    masked = F.concat(F.array_join(before, mask), F.lit(mask), rest)
    return with_runs.withColumn(text, F.when(F.size(spans) > 0, masked).otherwise(F.col(text))).drop("_runs")
