"""Documents to tokens: language, near duplicates, personal data, mix, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before kept, and returns the columns
of documents; the last returns token ids. Stages are written to the shared folder and read again, so a
lost executor costs at most its part of one stage. Rows with nulls, empty texts and extra columns pass as
the operators define; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake.llm import bpe, jaccard, language, mixing, pii
from mentionlake.llm.common import ready, table
from mentionlake.llm.plans import vocabulary
from mentionlake.session import materialize


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    ready(spark)
    return language.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at 0.8 stays."""
    ready(spark)
    return jaccard.one_of_each(docs, width=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; lengths follow."""
    ready(spark)
    clean = pii.redact(docs)
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents repeat or go."""
    ready(spark)
    return mixing.mixed(docs, weights=(3, 1, 2), percent=150, most=2)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    ready(spark)
    ranks, pattern = vocabulary()
    # in one stage a task would hold a Python worker for each of the two
    encoded = materialize(bpe.encode(docs, ranks, pattern), "encoded")
    decoded = bpe.decode(encoded, ranks, pattern)
    return decoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", in_a_language),
    ("near_duplicates", near_duplicates),
    ("personal_data", without_personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Models and hashes are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
