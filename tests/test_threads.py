import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from mentionlake.operators import threads

NOW = datetime(2024, 6, 5, 12)
TREE = "id string, parent_id string, post_id string, created_utc timestamp"


def ago(**kw):
    return NOW - timedelta(**kw)


def collect(spark, rows, cursor=NOW, **kw):
    comments = spark.createDataFrame([(i, p, "t3_p", at) for i, p, at in rows], TREE)
    cursors = spark.createDataFrame([("t3_p", cursor)], "post_id string, cursor_utc timestamp")
    return {r.id: r.depth for r in threads.collect_since(comments, cursors, **kw).collect()}


def test_replies_count_by_their_own_time_within_grace(spark):
    rows = [
        ("new", "t3_p", NOW),
        ("older", "t3_p", ago(seconds=1)),
        ("old_parent", "t3_p", ago(hours=3)),
        ("new_reply", "old_parent", NOW + timedelta(minutes=1)),
        ("old_reply", "old_parent", ago(hours=2)),
        ("deep_new", "old_reply", NOW + timedelta(minutes=2)),
        ("too_deep", "deep_new", NOW + timedelta(minutes=3)),
        ("at_floor", "t3_p", ago(hours=12)),
        ("floor_reply", "at_floor", NOW),
        ("past_grace", "t3_p", ago(hours=12, seconds=1)),
        ("lost_reply", "past_grace", NOW),
    ]
    assert collect(spark, rows) == {"new": 0, "new_reply": 1, "deep_new": 2, "floor_reply": 1}
    assert collect(spark, rows, max_depth=1) == {"new": 0, "new_reply": 1, "floor_reply": 1}
    assert len(collect(spark, rows, cursor=None)) == 10


def test_bounded_fetch_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(f"c{i}", rng.choice(["hot"] * 5 + ["x", "y"]), NOW + timedelta(seconds=rng.randrange(50))) for i in range(300)]
    got = threads.bounded_fetch(
        spark.createDataFrame(rows, "id string, post_id string, created_utc timestamp").repartition(6), 40, salts=4
    ).collect()
    for post in ("hot", "x", "y"):
        mine = sorted((r for r in rows if r[1] == post), key=lambda r: (r[2], r[0]), reverse=True)
        kept = sorted((r for r in got if r.post_id == post), key=lambda r: r.fetch_rank)
        assert [r.id for r in kept] == [r[0] for r in mine[:40]]
        assert {r.truncated for r in kept} == {len(mine) >= 40}
    df = spark.createDataFrame(rows, "id string, post_id string, created_utc timestamp")
    stubs = spark.createDataFrame([("x", True), ("y", False)], "post_id string, stubs_pending boolean")
    cut = {(r.post_id, r.truncated) for r in threads.bounded_fetch(df, 200, pending=stubs).collect()}
    assert cut == {("hot", sum(r[1] == "hot" for r in rows) >= 200), ("x", True), ("y", False)}


def test_daily_thread_is_the_first_stickied_among_the_hottest(spark):
    rows = [
        ("a", 1, False, "Daily Discussion"),
        ("b", 2, True, "Rules"),
        ("c", 14, True, "What are your moves tomorrow"),
        ("d", 15, True, "Daily discussion"),
    ]
    posts = spark.createDataFrame(
        [(i, "wsb", r, s, t) for i, r, s, t in rows] + [("z", "other", 16, True, "Daily discussion")]
        + [(f"f{n}", "other", n, False, "x") for n in range(1, 16)],
        "id string, subreddit string, hot_rank int, stickied boolean, title string",
    )
    assert [tuple(r) for r in threads.daily_thread(posts).collect()] == [("wsb", "c", "What are your moves tomorrow", 14)]


def test_posts_due(spark):
    minutes = {"a": 54, "b": 55, "c": 70, "d": 71, "e": 1409, "f": 1410, "g": 1470, "h": 1471, "done": 60, "again": 60}
    posts = spark.createDataFrame(
        [(k, "wallstreetbets", "Moves for today" if k == "b" else "t", ago(minutes=m)) for k, m in minutes.items()],
        "id string, subreddit string, title string, created_utc timestamp",
    )
    log = spark.createDataFrame(
        [("done", "1h", "done"), ("again", "24h", "done"), ("again", "1h", "failed")],
        "post_id string, pass string, value string",
    )
    now = F.lit(NOW)
    got = [(r.id, r["pass"], r.skip) for r in threads.posts_due(posts, log, now, current_thread=F.lit("c")).collect()]
    assert got == [("g", "24h", False), ("f", "24h", False), ("c", "1h", True), ("again", "1h", False), ("b", "1h", True)]
