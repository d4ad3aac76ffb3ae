"""Comment trees as a stream: every comment is tied to its top-level comment as soon as both are known.

One stage per level of replies, keyed by the comment that is answered, so a busy thread is spread over all
its comments. A stage meets the comments whose place is known with the replies to them, in either order; a
reply whose place it finds is a known comment of the next stage in the same micro-batch. What is held
for a comment goes when event time passes its grace period.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mentionlake import fixed_values as fixed
from mentionlake.functions import times
from mentionlake.operators.threads import at_or_after

# times in microseconds; ``at`` is the event time of a row: the comment's own, or the watermark if that has passed it
PLACED = "id string, post_id string, created bigint, top bigint, at timestamp"
_GRACE = fixed.REPLY_GRACE_HOURS * 3_600_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_Placed = Row("id", "post_id", "created", "top", "at")


class AnswerProcessor(StatefulProcessor):
    """Replies to one comment; they wait while nothing is known of it.

    Most groups are one to three rows, so what a group costs counts: plain rows, no frames, and as few calls
    to the state as the case needs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "top bigint")
        self.waiting = handle.getListState("waiting", "id string, post_id string, created bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived, tops = [], []
        for row in rows:
            if row.top is None:
                arrived.append((row.id, row.post_id, row.created))
            else:
                tops.append(row.top)
        state = self.known.get()
        top = state[0] if state else None
        watermark = timerValues.getCurrentWatermarkInMs()
        if top is None and tops:
            top = min(tops)
            self.known.update((top,))
            self._forget(top + _GRACE, watermark)
            waiting = [tuple(r) for r in self.waiting.get()]
            if waiting:
                arrived += waiting
                self.waiting.clear()
        if top is None:
            self.waiting.appendList(arrived)
            self._forget(max(c for _, _, c in arrived) + _GRACE, watermark)
            return
        passed = max(watermark, 0) * 1000
        for i, p, c in arrived:
            if top <= c <= top + _GRACE:
                yield _Placed(i, p, c, top, _EPOCH + timedelta(microseconds=max(c, passed)))

    def _forget(self, moment: int, watermark: int) -> None:
        """At the moment, or as soon as may be if it has passed."""
        self.handle.registerTimer(max(moment // 1000, watermark) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        state = self.known.get()
        if state:
            if (state[0] + _GRACE) // 1000 < now:
                self.known.clear()
        else:
            kept = [r for r in map(tuple, self.waiting.get()) if (r[2] + _GRACE) // 1000 >= now]
            self.waiting.clear()
            if kept:
                self.waiting.appendList(kept)
        return iter(())

    def close(self) -> None:
        pass


def tree_stream(comments: DataFrame, max_depth: int = 2, delay: str = "1 hour") -> DataFrame:
    """Stream of (id, post_id, created_utc, depth, top_created), each comment once its place is known.

    ``comments`` has id, parent_id, post_id, created_utc, and may come up to ``delay`` behind the newest,
    replies before the comments they answer. Replies below ``max_depth`` and those later than the grace
    period after their top-level comment are left out. A row that arrives twice counts twice.
    """
    rows = comments.select("id", "parent_id", "post_id", "created_utc", F.col("created_utc").alias("at"))
    rows = rows.withWatermark("at", delay)
    is_top = F.col("parent_id") == F.col("post_id")
    created = F.unix_micros("created_utc").alias("created")
    level = rows.filter(is_top).select("id", "post_id", created, created.alias("top"), "at")
    replies = rows.filter(~is_top & F.col("created_utc").isNotNull()).select(
        F.col("parent_id").alias("key"), "id", "post_id", created, F.lit(None).cast("bigint").alias("top"), "at"
    )
    levels = [level]
    for _ in range(max_depth):
        known = level.filter("top IS NOT NULL").select(F.col("id").alias("key"), *level.columns)
        level = replies.unionByName(known).groupBy("key").transformWithState(
            AnswerProcessor(), PLACED, "Append", "EventTime", eventTimeColumnName="at"
        )
        levels.append(level)
    moments = [F.timestamp_micros("created").alias("created_utc"), F.timestamp_micros("top").alias("top_created")]
    parts = [x.select("id", "post_id", *moments, F.lit(depth).alias("depth")) for depth, x in enumerate(levels)]
    return reduce(DataFrame.unionByName, parts)


def collect_since(comments: DataFrame, cursors: DataFrame, max_depth: int = 2, delay: str = "1 hour") -> DataFrame:
    """Streaming twin of ``operators.threads.collect_since``; ``cursors`` is a table."""
    placed = tree_stream(comments, max_depth, delay).join(cursors.select("post_id", "cursor_utc"), "post_id")
    floor = times.reply_grace_floor(F.col("cursor_utc"))
    kept = at_or_after(F.col("created_utc"), F.col("cursor_utc")) & at_or_after(F.col("top_created"), floor)
    return placed.filter(kept).select("id", "post_id", "created_utc", "depth")
