"""Line status, file kind and load counters."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx, times
from mentionlake.session import small_side


@dataclass(frozen=True)
class LoadFilter:
    """Sub-forums (empty = all) and inclusive UTC creation dates to load."""

    subreddits: Iterable[str] = fixed.DEFAULT_SUBREDDITS
    start_date: str | None = None
    end_date: str | None = None


def text_at(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, f"$.{key}", "string")


def fullname(doc: Column, prefix: str) -> Column:
    """``name`` when it is non-empty text, else ``id`` carrying the kind's prefix."""
    name_is_text = F.schema_of_variant(F.variant_get(doc, "$.name", "variant")) == "STRING"
    name = F.when(name_is_text, F.nullif(text_at(doc, "name"), F.lit("")))
    bare = text_at(doc, "id")
    prefixed = F.when(bare.rlike("^t[13]_"), bare).otherwise(F.concat(F.lit(prefix), bare))
    return F.coalesce(name, prefixed)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds ``doc``: the JSON object as VARIANT without NUL characters, or NULL when there is none.

    The one-element ``inline`` keeps later filters on fields of ``doc`` above the parse; pushed
    below it, they would parse every line once per field.
    """
    text = tx.strip_nul_escapes(F.col("value"))
    doc = F.when(text.rlike(r"^\s*\{"), F.try_parse_json(text))
    return lines.select("*", F.inline(F.array(F.struct(doc.alias("doc")))))


def file_kinds(heads: DataFrame) -> DataFrame:
    """(file, kind): posts when the file's first object has a ``title`` key, else comments."""
    # a key counts even when its value is null, so look at the keys, not at the value
    has_title = F.array_contains(F.json_object_keys(tx.strip_nul_escapes(F.col("value"))), "title")
    return (
        parse_lines(heads)
        .filter(F.col("doc").isNotNull())
        .groupBy("file")
        .agg(F.min_by(has_title, "line").alias("has_title"))
        .select("file", F.when(F.col("has_title"), "posts").otherwise("comments").alias("kind"))
    )


def with_kind(lines: DataFrame, kinds: DataFrame, files: int) -> DataFrame:
    """Adds each file's kind; ``files`` is the number of input files, one row of ``kinds`` each."""
    return lines.join(small_side(kinds, files), "file", "left")


def with_status(parsed: DataFrame, wanted: LoadFilter = LoadFilter()) -> DataFrame:
    """Adds ``status`` (blank, malformed, filtered, matched) and the decoded ``created_utc``."""
    doc = F.col("doc")
    subreddit = F.lower(F.coalesce(text_at(doc, "subreddit"), F.lit("")))
    names = [s.lower() for s in wanted.subreddits]
    other_forum = ~subreddit.isin(*names) if names else F.lit(False)
    day = F.to_date("created_utc")
    outside = F.lit(False)
    if wanted.start_date:
        outside = outside | (day < F.lit(wanted.start_date).cast("date"))
    if wanted.end_date:
        outside = outside | (day > F.lit(wanted.end_date).cast("date"))
    no_id = fullname(doc, "").isNull()  # as the mapping sees it
    no_parent = (F.col("kind") == "comments") & (
        F.coalesce(text_at(doc, "link_id"), F.lit("")) == ""
    )
    status = (
        F.when(tx.is_blank(F.col("value")), "blank")
        .when(doc.isNull(), "malformed")
        .when(other_forum, "filtered")
        .when(F.col("created_utc").isNull(), "malformed")
        .when(outside, "filtered")
        .when(no_parent | no_id, "malformed")
        .otherwise("matched")
    )
    return parsed.withColumn(
        "created_utc", times.epoch_to_utc(text_at(doc, "created_utc"))
    ).withColumn("status", status)


def load_counts(classified: DataFrame) -> DataFrame:
    """Counters per file plus a total row whose ``file`` is NULL."""
    one_row_per_file = classified.groupBy("file").agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("status") == "matched").alias("matched"),
        F.count_if(F.col("status") == "malformed").alias("skipped_malformed"),
        F.count_if(F.col("status") == "filtered").alias("skipped_filter"),
    )
    counters = ["read", "matched", "skipped_malformed", "skipped_filter"]
    return one_row_per_file.rollup("file").agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in counters]
    )
