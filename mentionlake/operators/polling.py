"""Batch replay of the polling state machines over a log of polls.

The log has thread_id, polled_at, event_id (tie-break), was_truncated, max_seen_utc,
num_comments_reported and fetched_this_cycle. Results equal what the stateful streams produce.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from mentionlake import fixed_values as fixed
from mentionlake.operators.running import SLICE, in_slices, last_seen, previous, run_positions
from mentionlake.session import materialize

_KEY = ["thread_id"]
_ORDER = ["polled_at", "event_id"]


def poll_figures(comments: DataFrame, polls: DataFrame, limit: int = fixed.FETCH_LIMIT) -> DataFrame:
    """What each poll fetched: (event_id, thread_id, polled_at, num_comments_reported, max_seen_utc,
    fetched_this_cycle, was_truncated), from the comments themselves.

    A comment (post_id, id, created_utc) goes to the first poll (thread_id, polled_at, event_id) of its thread
    at or after its creation; a fetch is cut at ``limit``. This is an as-of join without a range join per
    thread: polls and comments are one sequence, newest first, dealt into even slices, along which the poll
    last passed is carried. Comments after the last poll and polls of other threads are left out.
    """
    poll = F.struct("polled_at", "event_id")
    none = F.lit(None)
    asked = polls.select(
        "thread_id", (-F.unix_micros("polled_at")).alias("back"), F.lit(0).alias("kind"),
        (-F.col("event_id").cast("bigint")).alias("tie"), poll.alias("poll"), F.col("num_comments_reported"),
        none.cast("timestamp").alias("created_utc"),
    )
    # at one instant polls pass first, so that a comment of that instant meets the first of them
    written = comments.select(
        F.col("post_id").alias("thread_id"), (-F.unix_micros("created_utc")).alias("back"), F.lit(1).alias("kind"),
        F.xxhash64("id").alias("tie"), none.cast(asked.schema["poll"].dataType).alias("poll"),
        none.cast(polls.schema["num_comments_reported"].dataType).alias("num_comments_reported"), "created_utc",
    )
    order = ["back", "kind", "tie"]
    sequence = in_slices(asked.unionByName(written), _KEY, order, lambda rows, inside: rows)
    met = last_seen(sequence, _KEY, order, "met", F.col("poll")).filter("met IS NOT NULL")
    fetched = F.count("created_utc")
    return met.groupBy("thread_id", "met").agg(
        F.max("num_comments_reported").alias("num_comments_reported"),
        F.max("created_utc").alias("max_seen_utc"),
        F.least(fetched, F.lit(limit)).cast("int").alias("fetched_this_cycle"),
        (fetched >= limit).alias("was_truncated"),
    ).select("met.event_id", "thread_id", "met.polled_at", "num_comments_reported", "max_seen_utc", "fetched_this_cycle", "was_truncated")


def truncation_streak(polls: DataFrame) -> DataFrame:
    """Adds ``streak``: how many polls in a row, up to this one, were truncated."""
    runs = run_positions(polls, _KEY, _ORDER, ~F.col("was_truncated"))
    streak = F.col("pos") - F.coalesce("break_pos", F.lit(0))
    return runs.withColumn("streak", streak).drop("pos", "break_pos", SLICE)


def cursor_replay(polls: DataFrame) -> DataFrame:
    """Cursor and streak after every poll of every thread.

    First poll: cursor set to the poll time, nothing fetched. A complete poll moves the cursor to
    the newest comment seen. Truncated polls hold it until the third in a row, which moves it anyway
    (skipping what was not fetched) and starts the count again.
    """
    runs = run_positions(polls, _KEY, _ORDER, ~F.col("was_truncated"))
    first = F.col("pos") == 1
    # the first poll of a thread starts the count whatever it reports
    run = F.col("pos") - F.coalesce("break_pos", F.lit(1))
    judged = runs.withColumns(
        {"streak": run % fixed.TRUNCATION_STREAK_LIMIT, "cold_start": first}
    ).withColumn(
        "cursor_advanced",
        ~F.col("cold_start") & (F.col("streak") == 0) & F.col("max_seen_utc").isNotNull(),
    )
    moved = F.when(F.col("cold_start"), F.col("polled_at")).when(
        F.col("cursor_advanced"), F.col("max_seen_utc")
    )
    skipped = F.greatest(
        F.lit(0), F.coalesce("num_comments_reported", F.lit(0)) - F.col("fetched_this_cycle")
    )
    forced = F.col("cursor_advanced") & F.col("was_truncated")
    return last_seen(judged, _KEY, _ORDER, "cursor_utc", moved).select(
        "thread_id",
        "polled_at",
        "event_id",
        "cold_start",
        "cursor_advanced",
        "cursor_utc",
        "streak",
        F.when(forced, skipped).alias("estimated_skipped"),
    )


def rollovers(primary_log: DataFrame) -> DataFrame:
    """Every replacement of a primary thread: (subreddit, thread_id, successor, drain_started, returned_at).

    ``primary_log`` has subreddit, polled_at, thread_id. ``returned_at`` is when the thread becomes
    primary again, NULL if it does not.
    """
    known = previous(primary_log, ["subreddit"], ["polled_at"], "before", F.col("thread_id"))
    changes = materialize(known.filter("before IS NULL OR before <> thread_id"), "changes")
    gone = changes.filter("before IS NOT NULL").select(
        "subreddit", F.col("before").alias("thread_id"), F.col("thread_id").alias("successor"),
        F.col("polled_at").alias("drain_started"),
    )
    came = changes.select("subreddit", "thread_id", F.col("polled_at").alias("came_at"))
    later = F.when(F.col("came_at") > F.col("drain_started"), F.col("came_at"))
    return (
        gone.join(came, ["subreddit", "thread_id"], "left")
        .groupBy("subreddit", "thread_id", "successor", "drain_started")
        .agg(F.min(later).alias("returned_at"))
    )


def _first_ends(during: DataFrame) -> DataFrame:
    """(thread_id, retired_at, idle_polls) of drains that end, from their polls with ``drain_started``."""
    runs = run_positions(during, _KEY, _ORDER, F.col("ingested") > 0)
    idle = runs.withColumn("idle_polls", F.col("pos") - F.coalesce("break_pos", F.lit(0)))
    old = F.col("polled_at") >= F.col("drain_started") + F.make_dt_interval(
        hours=F.lit(fixed.DRAIN_MAX_HOURS)
    )
    ends = idle.filter(
        (F.col("ingested") == 0) & ((F.col("idle_polls") >= fixed.DRAIN_IDLE_POLLS) | old)
    )
    first = F.min_by(F.struct("polled_at", "idle_polls"), F.struct(*_ORDER)).alias("_end")
    return ends.groupBy("thread_id").agg(first).select(
        "thread_id", F.col("_end.polled_at").alias("retired_at"), "_end.idle_polls"
    )


def drain_outcomes(drains: DataFrame, polls: DataFrame) -> DataFrame:
    """When each draining thread is retired: its sixth idle poll in a row, or an idle poll after 18 h.

    ``polls`` has thread_id, polled_at, event_id, ingested (net-new rows). A thread that becomes
    primary again goes on draining when it is replaced again, without the polls in between; replaced
    after it was retired, it drains anew. Threads still draining have no ``retired_at``.
    """
    drains = materialize(drains, "drains")
    away = drains.select("thread_id", F.col("drain_started").alias("_from"), F.col("returned_at").alias("_to"))
    outside = polls.join(away, "thread_id").filter("polled_at >= _from AND (_to IS NULL OR polled_at < _to)")
    outside = materialize(outside, "drain-polls")  # read by every round
    columns = [c for c in drains.columns if c != "returned_at"]
    first = F.min_by(F.struct(*columns), "drain_started").alias("_first")
    starts = drains.groupBy("thread_id").agg(first).select("_first.*")
    rounds = []
    while True:
        during = outside.join(starts.select("thread_id", "drain_started"), "thread_id").filter("polled_at >= drain_started")
        ended = starts.join(_first_ends(during.drop("_from", "_to")), "thread_id", "left").select(*columns, "retired_at", "idle_polls")
        rounds.append(materialize(ended, "drain-round"))
        again = (
            drains.join(rounds[-1].select("thread_id", "retired_at"), "thread_id").filter("drain_started > retired_at")
            .groupBy("thread_id").agg(first).select("_first.*")
        )
        # as many rounds as the thread that was retired most often
        starts = materialize(again, "drain-again")
        if not starts.limit(1).count():
            return reduce(DataFrame.unionByName, rounds)


def threads_to_poll(state: DataFrame) -> DataFrame:
    """Primary thread first, then the draining ones in order, each once.

    ``state`` has subreddit, primary, draining (array).
    """
    others = F.array_except("draining", F.array("primary"))
    listed = F.concat(F.array("primary"), others)
    return state.select("subreddit", F.posexplode(listed).alias("poll_order", "thread_id"))
