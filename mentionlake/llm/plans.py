"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake.llm import (
    bpe, jaccard, language, licenses, mixing, neardup, negatives, neighbours, pii, quotes, toxicity, variants, warc,
)
from mentionlake.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def vocabulary() -> tuple[bytes, str]:
    """Ranks and pattern of the public vocabulary."""
    import public_tokenizers

    return Path(public_tokenizers.path(RANKS)).read_bytes(), public_tokenizers.PATTERN


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded; digests of the ids and of the bytes."""
    ranks, pattern = vocabulary()
    encoded = bpe.encode(table(spark, folder, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def fold(count: int) -> Column:
    """Fold of a row by its key; null for a null key."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


@query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; fold 0 of 5 is not learned from."""
    docs = table(spark, folder, "documents")
    out = language.identify(docs, learn=fold(5) != 0)
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document; counts and digest of the base spans, and all spans."""
    return pii.find(table(spark, folder, "documents")).select(
        "doc_id", *(f"n_{k}" for k in pii.KINDS),
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans",
    )


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; labels of fold 1 of 3 are not learned from."""
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"), learn=fold(3) != 1)
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    predicted = (F.col("score") >= toxicity.DECIDED).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op7_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors linked at cosine 0.95 or more, and their components."""
    return neardup.link(table(spark, folder, "embeddings"), 0.95)


@query
def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th id."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, 20)


@query
def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles overlap by 85 % or more."""
    return jaccard.join(table(spark, folder, "documents"), width=4, percent=85)


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed: sources weigh 3, 1, 2 in turn, 150 % of all words, at most twice a source."""
    out = mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), percent=150, most=2)
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op2_mixing"] = mixing.ORACLE


@query
def op3_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Every message without its quotes, linked to what it answers, in reply order by thread and turn."""
    return quotes.link(table(spark, folder, "conversations"))


ORACLES["op3_quotes"] = quotes.ORACLE


@query
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License of every page, its own or that of the nearest directory above it."""
    return licenses.scan(table(spark, folder, "pages"))


@query
def op11_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants of the words of all documents."""
    return variants.group(variants.words(table(spark, folder, "documents")))


ORACLES["op11_variants"] = variants.ORACLE


@query
def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Five negatives for each of five positives of every 100th id; every 7th label is off by one."""
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("id") % 100 == 0)


ORACLES["op12_negatives"] = negatives.ORACLE


@query
def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page archived as a WARC record and read back."""
    archive = warc.write(table(spark, folder, "pages"))
    return warc.digests(warc.restore(spark, archive)).select(
        F.col("key").cast("long").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLES["op13_warc"] = warc.ORACLE
