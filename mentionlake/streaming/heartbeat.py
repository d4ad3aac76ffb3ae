"""Hourly heartbeat of an ingest log, silent hours included."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from mentionlake.operators import ingest_rates

COUNTS = "hour timestamp, posts_per_hour bigint, comments_per_hour bigint, api_requests bigint"
_NAMES = ["posts_per_hour", "comments_per_hour", "api_requests"]
_HOUR = 3_600_000


class SilenceProcessor(StatefulProcessor):
    """Adds the hours that have no row. Gets one row an hour at most, so one key for all is enough."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "hour_ms bigint")

    def _silent(self, start: int, end: int) -> list[tuple]:
        return [(pd.Timestamp(h, unit="ms"), 0, 0, 0) for h in range(start, end, _HOUR)]

    def _up_to(self, start: int, now: int) -> tuple[list[tuple], int]:
        """Zero rows of the hours that are over, and the hour to go on with."""
        end = max(start, now // _HOUR * _HOUR)
        self.next.update((end,))
        self.handle.registerTimer(end + _HOUR)
        return self._silent(start, end), end

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("hour")
        known = self.next.get()
        at = known[0] if known else None
        out = []
        for row in hours[["hour", *_NAMES]].itertuples(index=False):
            hour = int(row.hour.timestamp() * 1000)
            out += self._silent(hour if at is None else at, hour)
            out.append(tuple(row))
            at = hour + _HOUR
        silent, _ = self._up_to(at, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(out + silent, columns=["hour", *_NAMES])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.next.get()
        if known and known[0] < expiredTimerInfo.getExpiryTimeInMs():
            silent, _ = self._up_to(known[0], timerValues.getCurrentWatermarkInMs())
            if silent:
                yield pd.DataFrame(silent, columns=["hour", *_NAMES])

    def close(self) -> None:
        pass


def heartbeat(log: DataFrame, delay: str = "10 minutes", clock: DataFrame | None = None) -> DataFrame:
    """Stream of hourly rates with alerts, each hour emitted once it is over, from the first one with a row.

    Hours are summed by an ordinary windowed aggregate; a timer then fills the hours without rows as event
    time passes them. ``clock`` is a stream with ``ts`` (say, of the rate source) that moves event time
    while the log itself is silent; its rows count nothing.
    """
    rows = log.select("ts", "kind", "n")
    if clock is not None:
        rows = rows.unionByName(clock.select("ts", F.lit("tick").alias("kind"), F.lit(0).cast("bigint").alias("n")))
    hours = (
        rows.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(*ingest_rates.counters())
        .select(F.lit("log").alias("key"), F.col("w.start").alias("hour"), *_NAMES, "w")
    )
    filled = hours.groupBy("key").transformWithStateInPandas(SilenceProcessor(), COUNTS, "Append", "EventTime")
    return ingest_rates.with_alerts(filled)
