"""Stateful streams: per-thread cursors and the drain of replaced threads."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mentionlake import fixed_values as fixed

CURSOR_SCHEMA = (
    "thread_id string, polled_at timestamp, event_id bigint, cold_start boolean, "
    "cursor_advanced boolean, cursor_utc timestamp, streak bigint, estimated_skipped int"
)
CHANGE_SCHEMA = "subreddit string, thread_id string, polled_at timestamp, event_id bigint, is_primary boolean"
DRAIN_SCHEMA = (
    "subreddit string, thread_id string, drain_started timestamp, retired_at timestamp, "
    "idle_polls bigint"
)


def _in_order(batches: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(batches)).sort_values(by)


class CursorProcessor(StatefulProcessor):
    """Cursor and truncation streak of one thread; a thread without state starts cold."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("cursor", "cursor_utc timestamp, streak bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.state.get()
        cursor, streak = known if known else (None, 0)
        out = []
        for poll in _in_order(rows, ["polled_at", "event_id"]).itertuples():
            seen = None if pd.isna(poll.max_seen_utc) else poll.max_seen_utc
            cold, advanced, skipped = cursor is None, False, None
            if cold:
                cursor, streak = poll.polled_at, 0
            else:
                streak = (streak + 1) % fixed.TRUNCATION_STREAK_LIMIT if poll.was_truncated else 0
                advanced = streak == 0 and seen is not None
                if advanced:
                    cursor = seen
                    if poll.was_truncated:
                        reported = poll.num_comments_reported
                        reported = 0 if pd.isna(reported) else int(reported)
                        skipped = max(0, reported - poll.fetched_this_cycle)
            out.append((key[0], poll.polled_at, poll.event_id, cold, advanced, cursor, streak, skipped))
        self.state.update((cursor, streak))
        names = [part.split()[0] for part in CURSOR_SCHEMA.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        frame["estimated_skipped"] = frame["estimated_skipped"].astype("Int32")
        yield frame

    def close(self) -> None:
        pass


def cursors(polls: DataFrame) -> DataFrame:
    """Streaming twin of ``operators.polling.cursor_replay``."""
    return polls.groupBy("thread_id").transformWithStateInPandas(
        CursorProcessor(), CURSOR_SCHEMA, "Append", "None"
    )


class RolloverProcessor(StatefulProcessor):
    """Primary thread of one sub-forum: when it changes, the old one is replaced and the new one is back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.primary = handle.getValueState("primary", "thread_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.primary.get()
        current = known[0] if known else None
        out = []
        for poll in _in_order(rows, ["polled_at", "event_id"]).itertuples():
            if current != poll.thread_id:
                if current is not None:
                    out.append((key[0], current, poll.polled_at, poll.event_id, False))
                out.append((key[0], poll.thread_id, poll.polled_at, poll.event_id, True))
                current = poll.thread_id
        if current is not None:
            self.primary.update((current,))
        yield pd.DataFrame(out, columns=[part.split()[0] for part in CHANGE_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


class DrainProcessor(StatefulProcessor):
    """One thread of a sub-forum: from its replacement to its retirement, unless it is primary again."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.drain = handle.getValueState("drain", "is_primary boolean, drain_started timestamp, idle_polls bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        oldest = timedelta(hours=fixed.DRAIN_MAX_HOURS)
        state = self.drain.get()
        primary, started, idle = state if state else (False, None, 0)
        started = None if started is None else pd.Timestamp(started)
        retired = []
        # changes of the primary thread come before the polls of the same time
        for row in _in_order(rows, ["polled_at", "is_poll", "event_id"]).itertuples():
            if not row.is_poll:
                primary = row.is_primary
                if not primary and started is None:
                    started, idle = row.polled_at, 0
            elif started is not None and not primary:
                idle = 0 if row.ingested > 0 else idle + 1
                if idle and (idle >= fixed.DRAIN_IDLE_POLLS or row.polled_at - started >= oldest):
                    retired.append((*key, started, row.polled_at, idle))
                    started, idle = None, 0
        if primary or started is not None:
            self.drain.update((primary, None if started is None else started.to_pydatetime(), idle))
        elif state:
            self.drain.clear()
        yield pd.DataFrame(retired, columns=[part.split()[0] for part in DRAIN_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def retirements(polls: DataFrame) -> DataFrame:
    """Streaming twin of ``operators.polling.drain_outcomes``; emits a thread when it is retired.

    ``polls`` has subreddit, polled_at, event_id, thread_id, is_primary and ingested. Only the polls that
    name a primary thread meet by forum; what changes there goes to the threads, and polls are dealt by thread.
    """
    named = polls.filter("is_primary").select("subreddit", "polled_at", "event_id", "thread_id")
    changes = named.groupBy("subreddit").transformWithStateInPandas(RolloverProcessor(), CHANGE_SCHEMA, "Append", "None")
    none = F.lit(None).cast("int")
    told = changes.withColumns({"is_poll": F.lit(False), "ingested": none})
    polled = polls.filter("NOT is_primary").select(
        "subreddit", "thread_id", "polled_at", "event_id", F.lit(False).alias("is_primary"), F.lit(True).alias("is_poll"), "ingested")
    return told.unionByName(polled).groupBy("subreddit", "thread_id").transformWithStateInPandas(
        DrainProcessor(), DRAIN_SCHEMA, "Append", "None"
    )
