"""Delayed comment passes: each post becomes due once about 1 h and once about 24 h after creation."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mentionlake import fixed_values as fixed
from mentionlake.operators.threads import is_daily_post

DUE = "id string, pass string, due_from timestamp, due_until timestamp"
_MINUTE = 60_000
_LAST = max(high for _, high in fixed.COMMENT_PASSES.values())
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_Due = Row("id", "pass", "due_from", "due_until")


def _names(passes: str | None) -> set[str]:
    return set(passes.split(",")) if passes else set()


class PassProcessor(StatefulProcessor):
    """Passes of one post that are still to come; a timer releases each when event time gets there.

    A group is one or two rows, so what a group costs counts: plain rows, and as few calls to the state as
    the case needs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.post = handle.getValueState("post", "created_ms bigint")
        self.done = handle.getValueState("done", "passes string, known_ms bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """Passes the log knows of; forgotten when the post cannot come any more."""
        self.done.update((initialState["passes"], initialState["known_ms"]))
        self.handle.registerTimer(max(initialState["known_ms"], timerValues.getCurrentWatermarkInMs()) + (_LAST + 1) * _MINUTE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        created = min(row.created_ms for row in rows)
        if not self.post.exists():
            self.post.update((created,))
            for low, _ in fixed.COMMENT_PASSES.values():
                self.handle.registerTimer(max(created + low * _MINUTE, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        post, log = self.post.get(), self.done.get()
        names = _names(log[0]) if log else set()
        if post:
            created = post[0]
            due = [n for n, (low, _) in fixed.COMMENT_PASSES.items() if created + low * _MINUTE <= now and n not in names]
            for name in due:
                low, high = (_EPOCH + timedelta(milliseconds=created + m * _MINUTE) for m in fixed.COMMENT_PASSES[name])
                yield _Due(key[0], name, low, high)
            names |= set(due)
        if (not post and log) or names >= set(fixed.COMMENT_PASSES) or (post and post[0] + _LAST * _MINUTE < now):
            self.post.clear()
            self.done.clear()
        elif post and due:
            self.done.update((",".join(sorted(names)), created))

    def close(self) -> None:
        pass


def due_passes(
    posts: DataFrame, done: DataFrame | None = None, *, current_thread: Column | None = None, delay_minutes: int = 10,
) -> DataFrame:
    """Stream of (id, pass, due_from, due_until), each emitted once, when it becomes due.

    ``posts`` has id, subreddit, title, created_utc; daily threads are left to their own poller. ``done`` is
    the pass log (post_id, pass, value, updated_at) as it stands when the stream first starts: passes it
    lists as done are not emitted. What the stream emits it remembers itself.
    """
    thread = F.lit(None).cast("string") if current_thread is None else current_thread
    awaited = posts.filter(~is_daily_post(thread)).select("id", "created_utc").dropna(subset=["created_utc"])
    rows = awaited.withWatermark("created_utc", f"{delay_minutes} minutes").select(
        "id", "created_utc", F.unix_millis("created_utc").alias("created_ms"))
    finished = None
    if done is not None:
        log = done.filter("value = 'done'").groupBy(F.col("post_id").alias("id"))
        finished = log.agg(
            F.array_join(F.array_sort(F.collect_set("pass")), ",").alias("passes"),
            F.unix_millis(F.max("updated_at")).alias("known_ms"),
        ).groupBy("id")
    return rows.groupBy("id").transformWithState(PassProcessor(), DUE, "Append", "EventTime", initialState=finished)
