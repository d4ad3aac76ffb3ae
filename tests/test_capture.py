from datetime import datetime

import pytest

from mentionlake.operators import capture, ingest_rates

CAPTURE = (
    "event_id long, thread_id string, polled_at timestamp, num_comments_reported int, "
    "comments_in_db_for_thread int, was_truncated boolean"
)
HOURS = (
    "hour timestamp, comment_volume long, comments_in_db long, num_comments_reported long, "
    "capture_rate_pct double, truncations long, market_open boolean"
)


def at(hour, minute=0, day=5):
    return datetime(2024, 6, day, hour, minute)


def test_hours_use_the_last_snapshot_of_each_thread(spark):
    polls = spark.createDataFrame(
        [
            (1, "a", at(9, 1), 100, 10, True),
            (2, "a", at(9, 59), 200, 90, False),
            (3, "b", at(9, 5), 100, 60, True),
            (4, "b", at(9, 5), None, 70, False),
            (5, "a", at(11), None, 95, False),
            (6, "c", at(9, 0, day=6), 10, 10, False),
        ],
        CAPTURE,
    )
    comments = spark.createDataFrame(
        [("a", at(9)), ("a", at(10, 30)), ("c", at(9)), ("zz", at(9)), ("a", at(9, 0, day=6))],
        "post_id string, created_utc timestamp",
    )
    got = [tuple(r) for r in capture.hourly_report(polls, comments, "2024-06-05").collect()]
    assert got == [
        (at(9), 1, 160, 200, 80.0, 2, False),
        (at(10), 1, 0, 0, None, 0, False),
        (at(11), 0, 95, 0, None, 0, False),
    ]
    every = capture.hourly_report(polls, comments).collect()
    assert [r.hour for r in every] == [at(9), at(10), at(11), at(9, 0, day=6)]
    assert every[3].comment_volume == 0


def test_day_without_polls_has_no_rows(spark):
    polls = spark.createDataFrame([], CAPTURE)
    comments = spark.createDataFrame([("a", at(9))], "post_id string, created_utc timestamp")
    assert capture.hourly_report(polls, comments, "2024-06-05").count() == 0


@pytest.mark.parametrize(
    "truncated, words",
    [
        ({}, "zero truncations"),
        ({12: 2, 21: 1}, "off-hours truncations only (3 total)"),
        ({13: 1, 20: 1}, "repeated truncations"),
        ({15: 3}, "repeated truncations"),
        ({15: 2, 3: 9}, "isolated truncation(s)"),
    ],
)
def test_verdicts(spark, truncated, words):
    rows = [(at(h), 10, 90, 100, 90.0, truncated.get(h, 0), 13 <= h <= 20) for h in range(24)]
    day = capture.day_summary(spark.createDataFrame(rows, HOURS))
    assert words in day.select(capture.verdict()).first()[0]


def test_day_summary_takes_the_plain_mean_of_hours(spark):
    rows = [
        (at(13), 5, 50, 100, 50.0, 2, True),
        (at(14), 5, 900, 1000, 90.0, 0, True),
        (at(22), 1, 0, 0, None, 1, False),
    ]
    day = capture.day_summary(spark.createDataFrame(rows, HOURS)).first()
    assert (day.total_volume, day.total_truncations, day.market_open_truncations) == (11, 3, 2)
    assert (day.market_open_hours_with_truncations, day.avg_capture_pct, day.min_capture_pct) == (1, 70.0, 50.0)


def test_heartbeat_fills_quiet_hours(spark):
    log = spark.createDataFrame(
        [(at(1, 5), "posts", 3), (at(1, 9), "requests", 4801), (at(3, 59), "comments", 7)],
        "ts timestamp, kind string, n long",
    )
    got = {r.hour.hour: r for r in ingest_rates.heartbeat(log).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].posts_per_hour, got[1].rate_alert, got[1].idle_alert) == (3, True, False)
    assert (got[2].api_requests, got[2].rate_alert, got[2].idle_alert) == (0, False, True)
    assert (got[3].comments_per_hour, got[3].idle_alert) == (7, False)
