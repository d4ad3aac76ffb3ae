import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import polling, running
from mentionlake.streaming import cursor, jobs

START = datetime(2024, 3, 1)
POLLS = (
    "thread_id string, polled_at timestamp, event_id long, was_truncated boolean, "
    "max_seen_utc timestamp, num_comments_reported int, fetched_this_cycle int"
)


def random_polls(seed, threads=4, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one thread holds most of the rows, and times collide
        thread = "hot" if rng.random() < 0.6 else f"t{rng.randrange(threads)}"
        at = START + timedelta(minutes=rng.randrange(n // 2))
        seen = None if rng.random() < 0.3 else at - timedelta(seconds=rng.randrange(60))
        reported = None if rng.random() < 0.2 else rng.randrange(5000)
        rows.append((thread, at, i, rng.random() < 0.6, seen, reported, rng.randrange(3000)))
    return rows


def simulate(rows):
    """The polling rules, poll by poll."""
    state, out = {}, {}
    for thread, at, i, truncated, seen, reported, fetched in sorted(rows, key=lambda r: (r[1], r[2])):
        skipped, advanced, cold = None, False, thread not in state
        if cold:
            cur, streak = at, 0
        else:
            cur, streak = state[thread]
            if not truncated:
                streak, advanced = 0, seen is not None
            else:
                streak += 1
                if streak == 3:
                    streak, advanced = 0, seen is not None
                    if advanced:
                        skipped = max(0, (reported or 0) - fetched)
            if advanced:
                cur = seen
        state[thread] = (cur, streak)
        out[i] = (cold, advanced, cur, streak, skipped)
    return out


def as_dict(df):
    return {
        r.event_id: (r.cold_start, r.cursor_advanced, r.cursor_utc, r.streak, r.estimated_skipped)
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_follows_the_rules(spark, seed):
    rows = random_polls(seed)
    got = polling.cursor_replay(spark.createDataFrame(rows, POLLS).repartition(5))
    assert as_dict(got) == simulate(rows)


def test_stream_over_several_batches_equals_replay(spark, tmp_path):
    rows = sorted(random_polls(9), key=lambda r: (r[1], r[2]))
    folder, run = str(tmp_path / "in"), str(tmp_path / "run")
    for part in (rows[:80], rows[80:81], rows[81:]):
        spark.createDataFrame(part, POLLS).coalesce(1).write.mode("append").parquet(folder)
        arriving = cursor.cursors(spark.readStream.schema(POLLS).parquet(folder))
        out = jobs.run_available(arriving, "cursors", run)
    got = as_dict(jobs.read_output(arriving, out))
    assert got == simulate(rows)


def test_third_truncated_poll_forces_the_cursor(spark):
    def poll(i, truncated, seen, reported=5000, fetched=2048):
        return ("t", START + timedelta(minutes=10 * i), i, truncated, seen, reported, fetched)

    seen = START + timedelta(minutes=5)
    rows = [poll(0, True, seen)] + [poll(i, True, seen) for i in (1, 2, 3)] + [poll(4, True, None)]
    got = as_dict(polling.cursor_replay(spark.createDataFrame(rows, POLLS)))
    assert got[0] == (True, False, START, 0, None)
    assert [got[i][1] for i in (1, 2, 3)] == [False, False, True]
    assert got[3] == (False, True, seen, 0, 2952)
    assert got[4] == (False, False, seen, 1, None)


def test_streak_counts_across_slices(spark):
    rows = random_polls(5)
    want, runs = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        runs[r[0]] = runs.get(r[0], 0) + 1 if r[3] else 0
        want[r[2]] = runs[r[0]]
    got = polling.truncation_streak(spark.createDataFrame(rows, POLLS))
    assert {r.event_id: r.streak for r in got.collect()} == want


def test_hot_key_is_dealt_over_all_slices(spark):
    rows = [("hot", START + timedelta(seconds=i), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, at timestamp, id long")
    dealt = running.in_slices(df, ["k"], ["at", "id"], lambda rows, _: rows, slices=4)
    sizes = [r["count"] for r in dealt.groupBy(running.SLICE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_previous_row_across_slices(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.randrange(5)) for i in range(200)]
    want, last = {}, {}
    for k, i, v in rows:
        want[i], last[k] = last.get(k), v
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    got = running.previous(df, ["k"], ["i"], "before", F.col("v"))
    assert {r.i: r.before for r in got.collect()} == want


def test_drain_ends_by_idle_polls_or_age(spark):
    t = lambda hours: START + timedelta(hours=hours)
    primary = [("f", t(0), "a"), ("f", t(10), "b"), ("f", t(12), "b"), ("f", t(40), "c")]
    # a: idle run broken by news, then six idle polls; b: always news, one idle poll after 18 hours
    a = [("a", t(h), int(10 * h), n) for h, n in
         [(10.1, 0), (10.2, 3), (10.3, 0), (10.4, 0), (10.5, 0), (10.6, 0), (10.7, 0), (10.8, 0), (10.9, 0)]]
    b = [("b", t(h), int(10 * h), n) for h, n in [(11, 0), (41, 5), (50, 1), (57, 1), (58.5, 0), (59, 0)]]
    log = spark.createDataFrame(primary, "subreddit string, polled_at timestamp, thread_id string")
    polls = spark.createDataFrame(a + b, "thread_id string, polled_at timestamp, event_id long, ingested int")
    drains = polling.rollovers(log)
    got = {r.thread_id: r for r in polling.drain_outcomes(drains, polls).collect()}
    assert (got["a"].successor, got["a"].drain_started) == ("b", t(10))
    assert (got["a"].retired_at, got["a"].idle_polls) == (t(10.8), 6)
    assert (got["b"].retired_at, got["b"].idle_polls) == (t(58.5), 1)
    assert set(got) == {"a", "b"}


@pytest.mark.parametrize("returning", [False, True])
def test_drain_stream_equals_batch(spark, tmp_path, returning):
    rng = random.Random(7)
    days, primary, polls = 8, [], []
    for d in range(days):
        primary.append(("f", START + timedelta(days=d), f"d{d}"))
        for hour in (5, 9, 14, 20) if returning else ():  # threads swap places
            primary.append(("f", START + timedelta(days=d, hours=hour), f"d{max(0, d - rng.randrange(3))}"))
    for i in range(1500):
        at = START + timedelta(minutes=rng.randrange(days * 1440))
        thread = max(0, (at - START).days - rng.randrange(3))
        polls.append((f"d{thread}", at, i, 1 if rng.random() < 0.25 else 0))
    log = spark.createDataFrame(primary, "subreddit string, polled_at timestamp, thread_id string")
    rows = spark.createDataFrame(polls, "thread_id string, polled_at timestamp, event_id long, ingested int")
    batch = polling.drain_outcomes(polling.rollovers(log), rows)
    want = {(r.thread_id, r.drain_started, r.retired_at, r.idle_polls) for r in batch.collect() if r.retired_at}
    both = log.selectExpr("subreddit", "polled_at", "-1L AS event_id", "thread_id", "true AS is_primary", "0 AS ingested").unionByName(
        rows.selectExpr("'f' AS subreddit", "polled_at", "event_id", "thread_id", "false AS is_primary", "ingested"))
    folder, run = str(tmp_path / "in"), str(tmp_path / "run")
    middle = START + timedelta(days=4, hours=7)
    for part in (both.filter(F.col("polled_at") < middle), both.filter(F.col("polled_at") >= middle)):
        part.write.mode("append").parquet(folder)
        arriving = cursor.retirements(spark.readStream.schema(both.schema).parquet(folder))
        out = jobs.read_output(arriving, jobs.run_available(arriving, "drain", run))
    got = {(r.thread_id, r.drain_started, r.retired_at, r.idle_polls) for r in out.collect()}
    assert got == want and len(want) >= 5
    assert not returning or len({w[0] for w in want}) < len(want)


def test_poll_order(spark):
    state = spark.createDataFrame([("f", "b", ["a", "b", "c", "a"])], "subreddit string, primary string, draining array<string>")
    rows = polling.threads_to_poll(state).orderBy("poll_order").collect()
    assert [r.thread_id for r in rows] == ["b", "a", "c"]


@pytest.mark.parametrize("limit", [2, 2048])
def test_poll_figures(spark, limit):
    rng = random.Random(limit)
    at = lambda: START + timedelta(seconds=rng.randrange(200))
    thread = lambda: "hot" if rng.random() < 0.6 else f"t{rng.randrange(4)}"
    polls = [(thread(), at(), i, rng.choice([None, 7])) for i in range(40)] + [("idle", at(), 99, 1)]
    comments = [(thread(), f"c{i}", at()) for i in range(300)] + [("elsewhere", "x", at())]
    got = polling.poll_figures(
        spark.createDataFrame(comments, "post_id string, id string, created_utc timestamp"),
        spark.createDataFrame(polls, "thread_id string, polled_at timestamp, event_id long, num_comments_reported int"), limit)
    want, held = {i: [] for _, _, i, _ in polls}, 0
    for post, _, created in comments:
        later = [(p, i) for t, p, i, _ in polls if t == post and p >= created]
        if later:
            want[min(later)[1]].append(created)
            held += 1
    rows = {r.event_id: r for r in got.collect()}
    assert rows.keys() == want.keys() and held > 200
    for t, p, i, reported in polls:
        r = rows[i]
        assert (r.thread_id, r.polled_at, r.num_comments_reported) == (t, p, reported)
        assert (r.max_seen_utc, r.fetched_this_cycle) == (max(want[i], default=None), min(len(want[i]), limit))
        assert r.was_truncated == (len(want[i]) >= limit)
    assert polling.cursor_replay(got).count() == len(polls)
