"""The training-data pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import packing, quality, secrets, simhash, substrings
from wordloom.llm.queries import WORD_TOKENIZER, quality_rules
from wordloom.session import drop_paths, durable, recorded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

PACKING_CACHE_BYTES = 24 << 20  # of encoded words a task holds


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rule or a learned rule rejects."""
    return quality.judge(docs, quality_rules(spark, docs, sf_dir)).filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; NULL ids come last.

    Groups are those of the SimHash operator: three-word shingles, fingerprints linked at two or fewer bits. Rows
    that repeat an id are documents of their own, so only one of them stays, too.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    # Row numbers are frozen in a written table, or they could differ when a lost task runs again.
    numbered = durable(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = simhash.near_duplicates(numbered.select(key.alias("key"), "text"), key="key")
    others = groups.filter("key <> component_id").select(F.col("key.row").alias(row))
    return numbered.join(simhash.sent_if_small(others, [row]), row, "left_anti").select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages of 35 words or more that stand in several places."""
    cut = substrings.dedup_substrings(docs)
    return cut.withColumns({"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every secret span replaced by a mark."""
    masked = secrets.redact(secrets.find_secrets(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens of the documents that are left."""
    return packing.pack(docs, WORD_TOKENIZER, with_ids=False, cache_bytes=PACKING_CACHE_BYTES, keep_model=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("passages", cut_passages),
    ("secrets", mask_secrets),
    ("packing", pack_documents),
]
ORACLE_SQL: str | None = None  # learned rules, fingerprints and a tokenizer are not expressible


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage writes for itself goes as soon as its result is written.

    The result reads the last stage's tables, which stay until ``session.drop_tables``.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results: list[str] = []
    for name, apply in STAGES[:-1]:
        with recorded() as own:
            made = apply(spark, docs, sf_dir)
        with recorded() as result:
            docs = durable(made, name)
        drop_paths(spark, [*own, *results])  # the result before this one has been read, too
        results = result
    return STAGES[-1][1](spark, docs, sf_dir)
