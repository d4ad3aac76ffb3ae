"""From classified lines to rows of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake.functions import text as tx
from mentionlake.operators.quality import fullname, text_at
from mentionlake.sources.jsonl import ORDER


def _common(doc: Column) -> dict[str, Column]:
    return {
        "subreddit": F.lower(F.coalesce(text_at(doc, "subreddit"), F.lit(""))),
        "author": tx.archive_author(text_at(doc, "author")),
        "score": F.try_variant_get(doc, "$.score", "int"),
        "created_utc": F.col("created_utc"),
        "raw": doc,
    }


def comment_columns() -> list[Column]:
    doc = F.col("doc")
    columns = {
        "id": fullname(doc, "t1_"),
        "post_id": text_at(doc, "link_id"),
        "body": text_at(doc, "body"),
        **_common(doc),
    }
    return [c.alias(name) for name, c in columns.items()]


def post_columns() -> list[Column]:
    doc = F.col("doc")
    columns = {
        "id": fullname(doc, "t3_"),
        "title": text_at(doc, "title"),
        "selftext": text_at(doc, "selftext"),
        "num_comments": F.try_variant_get(doc, "$.num_comments", "int"),
        **_common(doc),
    }
    return [c.alias(name) for name, c in columns.items()]


COLUMNS = {"posts": post_columns, "comments": comment_columns}


def map_rows(classified: DataFrame, kind: str) -> DataFrame:
    """Matched lines of one kind as rows of its raw table, with their place in the load."""
    matched = classified.filter((F.col("status") == "matched") & (F.col("kind") == kind))
    return matched.select(*COLUMNS[kind](), *ORDER)


def map_comments(classified: DataFrame) -> DataFrame:
    return map_rows(classified, "comments")


def map_posts(classified: DataFrame) -> DataFrame:
    return map_rows(classified, "posts")


def payload_staleness(rows: DataFrame) -> DataFrame:
    """Seconds between creation and retrieval, and the comment's parent, read from the payload."""
    retrieved = F.try_variant_get("raw", "$.retrieved_on", "bigint")
    return rows.select(
        "id",
        F.try_variant_get("raw", "$.parent_id", "string").alias("parent_id"),
        retrieved.alias("retrieved_on"),
        (retrieved - F.unix_seconds("created_utc")).alias("staleness_sec"),
    )
