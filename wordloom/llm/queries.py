"""Registered queries of the pipeline's operators: each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import ann, bpe, filter_audit, licenses, packing, quality, ranked_search, secrets, simhash, substrings, suffix_dedup, token_counts, warc
from wordloom.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every text encoded to ids and decoded again."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, BYTE_TOKENIZER).drop("text")
    return bpe.decode(encoded, BYTE_TOKENIZER).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_substrings(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 35 words or more that stand in several places, removed."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return substrings.dedup_substrings(docs, single_space=True).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All texts packed into sequences of 2,048 tokens."""
    return packing.pack(_table(spark, sf, "documents"), WORD_TOKENIZER, with_ids=False)


@query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of all texts and the groups of those within two bits."""
    return simhash.near_duplicates(_table(spark, sf, "documents"))


@query
def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of all texts, with the weak parts that stand beside others."""
    return secrets.report(secrets.find_secrets(_table(spark, sf, "documents").select("doc_id", "text")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf: str) -> list[quality.Rule]:
    """Rules learned from a bounded sample of the labelled documents."""
    return quality.learn_rules(quality.labelled(docs, _table(spark, sf, "labels")))


@query
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return quality.judge(docs, quality_rules(spark, docs, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    read = warc.round_trip(_table(spark, sf, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every line of every text, from one encoding of each text."""
    return token_counts.section_tokens(_table(spark, sf, "documents"), BYTE_TOKENIZER)


@query
def op9_licenses(spark: SparkSession, sf: str) -> DataFrame:
    """License statements of all texts."""
    return licenses.scan_licenses(_table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query
def op10_ann(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    return ann.nearest(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Byte strings of 100 or more that stand earlier, removed from all texts."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return ranked_search.rank(docs, _table(spark, sf, "benchmark"))


@query
def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Five filters in all their orders, for each language."""
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    failures = filter_audit.document_failures(docs, F.coalesce("lang", F.lit("")))
    return filter_audit.audit(filter_audit.mask_cells(failures, _table(spark, sf, "labels")))
