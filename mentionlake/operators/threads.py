"""Comment trees, bounded fetches, the daily thread and posts that are due for a comment pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.functions import text as tx, times
from mentionlake.operators.layout import created_between


def at_or_after(created: Column, cursor: Column) -> Column:
    """Comments at the cursor second are fetched again; a missing cursor keeps everything."""
    return cursor.isNull() | (created >= cursor)


def collect_since(comments: DataFrame, cursors: DataFrame, max_depth: int = 2) -> DataFrame:
    """Comments at or after their thread's cursor, down to ``max_depth`` replies.

    A reply counts by its own time: it is kept under an older parent as long as its top-level
    comment is no older than the grace period before the cursor. Only the comments since the cursor
    climb towards their top-level comment, one equi-join per level; those that have arrived carry a
    key of their own that matches nothing, so they stay spread out.
    """
    rows = comments.select("id", "parent_id", "post_id", "created_utc")
    is_top = F.col("parent_id") == F.col("post_id")
    climbing = (
        rows.join(cursors.select("post_id", "cursor_utc"), "post_id")
        .filter(at_or_after(F.col("created_utc"), F.col("cursor_utc")))
        .withColumns(
            {
                "depth": F.when(is_top, 0),
                "top_created": F.when(is_top, F.col("created_utc")),
                "up": F.when(~is_top, F.col("parent_id")),
            }
        )
    )
    # a parent before the grace period has a top-level comment before it too, and decides nothing
    floors = cursors.select(F.col("post_id").alias("_thread"), times.reply_grace_floor(F.col("cursor_utc")).alias("_floor"))
    reachable = (F.col("post_id") == F.col("_thread")) & at_or_after(F.col("created_utc"), F.col("_floor"))
    parents = rows.join(floors, reachable, "left_semi").select(
        F.col("id").alias("up"),
        F.col("parent_id").alias("next_up"),
        F.col("created_utc").alias("up_created"),
        is_top.alias("up_is_top"),
    )
    for depth in range(1, max_depth + 1):
        keyed = climbing.withColumn("up", F.coalesce("up", F.concat(F.lit("#"), "id")))
        arrived = F.coalesce("up_is_top", F.lit(False))
        climbing = keyed.join(parents, "up", "left").select(
            "id",
            "post_id",
            "created_utc",
            "cursor_utc",
            F.coalesce("depth", F.when(arrived, depth)).alias("depth"),
            F.coalesce("top_created", F.when(arrived, F.col("up_created"))).alias("top_created"),
            F.when(~arrived, F.col("next_up")).alias("up"),
        )
    in_grace = at_or_after(F.col("top_created"), times.reply_grace_floor(F.col("cursor_utc")))
    return climbing.filter(F.col("depth").isNotNull() & in_grace).select(
        "id", "post_id", "created_utc", "depth"
    )


def bounded_fetch(
    comments: DataFrame, limit: int = fixed.FETCH_LIMIT, *, tie: str = "id", salts: int = 32,
    pending: DataFrame | None = None,
) -> DataFrame:
    """The newest ``limit`` comments of each thread and whether the fetch was cut.

    Cut per (thread, salt) first, so a thread with a third of all comments reaches its final task
    as at most ``salts * limit`` rows. A fetch was cut when it is full, or when ``pending`` (post_id,
    stubs_pending) says that stubs of the thread were left unexpanded.
    """
    newest = [F.desc("created_utc"), F.desc(tie)]
    salted = comments.withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(salts)))
    part = Window.partitionBy("post_id", "_salt").orderBy(*newest)
    whole = Window.partitionBy("post_id").orderBy(*newest)
    kept = (
        salted.withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= limit)
        .withColumn("fetch_rank", F.row_number().over(whole))
        .filter(F.col("fetch_rank") <= limit)
        .drop("_salt", "_rank")
    )
    full = F.max("fetch_rank").over(Window.partitionBy("post_id")) >= limit
    if pending is None:
        return kept.withColumn("truncated", full)
    stubs = pending.groupBy("post_id").agg(F.max("stubs_pending").alias("_stubs"))
    left = F.coalesce("_stubs", F.lit(False))
    return kept.withColumn("truncated", full).join(stubs, "post_id", "left").withColumn(
        "truncated", F.col("truncated") | left).drop("_stubs")


def daily_thread(hot_posts: DataFrame) -> DataFrame:
    """Per sub-forum, the first stickied daily thread among its hottest posts.

    ``hot_posts`` has ``hot_rank`` (smallest = hottest, ties by id), ``stickied``, ``title``,
    ``subreddit``, ``id``.
    """
    w = Window.partitionBy("subreddit").orderBy("hot_rank", "id")
    hottest = hot_posts.withColumn("_rn", F.row_number().over(w)).filter(
        F.col("_rn") <= fixed.HOT_LIMIT
    )
    daily = hottest.filter(F.col("stickied") & tx.is_daily_title(F.col("title")))
    first = daily.groupBy("subreddit").agg(
        F.min_by(F.struct("id", "title", "hot_rank"), "_rn").alias("_first")
    )
    return first.select("subreddit", "_first.*")


def is_daily_post(current_thread: Column) -> Column:
    """Posts the delayed passes leave to the daily-thread poller."""
    return F.coalesce(F.col("id") == current_thread, F.lit(False)) | (
        (F.col("subreddit") == fixed.DAILY_SUBREDDIT) & tx.is_daily_title(F.col("title"))
    )


def posts_due(
    posts: DataFrame,
    done: DataFrame,
    now: Column,
    *,
    current_thread: Column | None = None,
) -> DataFrame:
    """Posts inside a pass's age window that have not had that pass yet, oldest first.

    ``done`` is the pass log (post_id, pass, value). Daily threads are listed with ``skip`` set:
    their pass is marked done without fetching.
    """
    windows = F.array(
        *[
            F.struct(F.lit(name).alias("pass"), F.lit(low).alias("low"), F.lit(high).alias("high"))
            for name, (low, high) in fixed.COMMENT_PASSES.items()
        ]
    )
    oldest = max(high for _, high in fixed.COMMENT_PASSES.values())
    newest = min(low for low, _ in fixed.COMMENT_PASSES.values())

    def before(minutes: Column) -> Column:
        return now - F.make_dt_interval(mins=minutes)

    created = F.col("created_utc")
    in_reach = created_between(posts, before(F.lit(oldest)), before(F.lit(newest)))
    due = in_reach.select("*", F.inline(windows)).filter(
        created.between(before(F.col("high")), before(F.col("low")))
    )
    finished = done.filter("value = 'done'").select(F.col("post_id").alias("id"), "pass")
    thread = F.lit(None).cast("string") if current_thread is None else current_thread
    return (
        due.join(finished, ["id", "pass"], "left_anti")
        .select("id", "pass", "subreddit", "created_utc", is_daily_post(thread).alias("skip"))
        .orderBy("created_utc", "id", "pass")
    )
