"""Stateful streams against their batch twins, over several micro-batches and restarts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from mentionlake.operators import ingest_rates, threads
from mentionlake.streaming import heartbeat, jobs, passes, trees

START = datetime(2024, 3, 1)
TREE = "id string, parent_id string, post_id string, created_utc timestamp"


def random_tree(seed, n=400, posts=3, hours=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(seconds=i * hours * 3600 // n)
        post = "hot" if rng.random() < 0.6 else f"p{rng.randrange(posts)}"
        near = [r for r in rows if r[2] == post and at - r[3] < timedelta(hours=9)]
        parent = post if not near or rng.random() < 0.4 else rng.choice(near)[0]
        rows.append((f"c{i}", parent, post, at))
    return rows


def arrive(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def within_grace(rows, max_depth=2):
    """Depth and top-level time of each comment, by climbing."""
    by_id = {r[0]: r for r in rows}
    out = {}
    for r in rows:
        depth, at = 0, r
        while at[1] != at[2] and at[1] in by_id:
            depth, at = depth + 1, by_id[at[1]]
        if at[1] == at[2] and depth <= max_depth and r[3] - at[3] <= timedelta(hours=12):
            out[r[0]] = depth
    return out


def test_tree_stream_over_batches_and_restarts(spark, tmp_path):
    depth = 2
    rows = random_tree(depth)
    folder, run = str(tmp_path / "in"), str(tmp_path / "run")
    got = {}
    for batch in range(3):  # each batch upside down: replies before what they answer, some one batch early
        part = [r for i, r in enumerate(rows) if (i + 20 * (i % 3 == 0)) * 3 // (len(rows) + 20) == batch]
        arrive(spark, part[::-1], TREE, folder)
        stream = trees.tree_stream(spark.readStream.schema(TREE).parquet(folder), depth, delay="6 hours")
        found = jobs.read_output(stream, jobs.run_available(stream, "tree", run)).collect()
        assert len(found) == len({r.id for r in found}) >= len(got)
        got = {r.id: r.depth for r in found}
    assert got == within_grace(rows, depth)


def test_tree_stream_equals_collect_since(spark, tmp_path):
    rows = [r for r in random_tree(9, hours=11)]
    folder = str(tmp_path / "in")
    for part in (rows[::2], rows[1::2]):
        arrive(spark, part, TREE, folder)
    cursors = spark.createDataFrame(
        [("hot", START + timedelta(hours=4)), ("p0", None), ("p1", START + timedelta(hours=14))], "post_id string, cursor_utc timestamp")
    comments = spark.createDataFrame(rows, TREE)
    arriving = spark.readStream.schema(TREE).option("maxFilesPerTrigger", 1).parquet(folder)
    stream = trees.collect_since(arriving, cursors, delay="24 hours")
    got = jobs.read_output(stream, jobs.run_available(stream, "tree"))
    want = threads.collect_since(comments, cursors)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_state_of_old_comments_goes(spark, tmp_path):
    """A reply within the grace period counts, one after it does not, and one whose parent never comes is forgotten."""
    folder, run = str(tmp_path / "in"), str(tmp_path / "run")
    h = lambda n: START + timedelta(hours=n)
    batches = [[("r", "p", "p", h(0)), ("lost", "nobody", "p", h(1)), ("in", "r", "p", h(12)), ("x", "p", "p", h(12))],
               [("out", "r", "p", h(12.5)), ("y", "p", "p", h(60))], [("z", "nobody", "p", h(61))]]
    for rows in batches:
        arrive(spark, rows, TREE, folder)
        stream = trees.tree_stream(spark.readStream.schema(TREE).parquet(folder))
        out = jobs.run_available(stream, "tree", run)
    assert sorted(r.id for r in jobs.read_output(stream, out).collect()) == ["in", "r", "x", "y"]
    states = spark.read.format("statestore").option("stateVarName", "known").load(f"{run}/checkpoint").collect()
    assert {r.key.key for r in states} <= {"y"}


def test_due_passes_over_restarts(spark, tmp_path):
    """Each pass once, none that the log lists, none of daily threads; as posts_due swept over time."""
    schema = "id string, subreddit string, title string, created_utc timestamp"
    m = lambda n: START + timedelta(minutes=n)
    post = lambda i, at, title="t": (i, "wallstreetbets", title, m(at))
    log = spark.createDataFrame(
        [("a", "1h", "done", m(60)), ("b", "24h", "failed", m(60)), ("never", "1h", "done", m(60))],
        "post_id string, pass string, value string, updated_at timestamp")
    batches = [[post("a", 0), post("b", 30), post("daily", 3, "Moves for today"), post("now", 5)],
               [post("a", 0), post("c", 66), post("d", 100)], [post("e", 2 * 1440)], [post("f", 4 * 1440)]]
    folder, run, sizes = str(tmp_path / "in"), str(tmp_path / "run"), []
    for rows in batches:
        arrive(spark, rows, schema, folder)
        arriving = spark.readStream.schema(schema).parquet(folder)
        due = passes.due_passes(arriving, log, current_thread=F.lit("now"))
        found = jobs.read_output(due, jobs.run_available(due, "due", run)).collect()
        assert len(found) == len({(r.id, r["pass"]) for r in found})
        sizes.append(len(found))
    posts, horizon = spark.createDataFrame(sum(batches, []), schema).distinct(), m(4 * 1440 - 10)
    want = set()
    for minute in (60, 95, 130, 165, 1440, 1475, 1506, 1545, 2 * 1440 + 60, 3 * 1440):
        due = threads.posts_due(posts, log, F.lit(m(minute)), current_thread=F.lit("now")).filter("NOT skip")
        want |= {(r.id, r["pass"]) for r in due.collect()}
    assert {(r.id, r["pass"]) for r in found} == want and sizes[0] == 0 and sizes[1] == 1
    assert all(r.due_from <= horizon and r.due_until > r.due_from for r in found)
    left = spark.read.format("statestore").option("stateVarName", "done").load(f"{run}/checkpoint").collect()
    assert not {r.key.id for r in left} & {"a", "b", "c", "never"}


def test_heartbeat_stream_has_silent_hours(spark, tmp_path):
    """A gap inside a batch, one between batches and one at the end that only a clock reveals."""
    schema = "ts timestamp, kind string, n long"
    at = lambda h, minute=5: START + timedelta(hours=h, minutes=minute)
    batches = [[(at(0), "posts", 3), (at(4), "comments", 1)], [(at(9), "requests", 9000), (at(9, 50), "comments", 2)], [(at(15), "tick", 0)]]
    folder, run = str(tmp_path / "in"), str(tmp_path / "run")
    for rows in batches:
        arrive(spark, rows, schema, folder)
        arriving = spark.readStream.schema(schema).parquet(folder)
        beat = heartbeat.heartbeat(arriving.filter("kind <> 'tick'"), clock=arriving.filter("kind = 'tick'"))
        out = jobs.run_available(beat, "beat", run)
    got = jobs.read_output(beat, out).collect()
    log = spark.createDataFrame(sum(batches, []), schema)
    want = [r for r in ingest_rates.heartbeat(log).collect() if r.hour < at(14, 0)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 14
    assert sum(r.idle_alert for r in got) == 11


def test_statistics_of_a_repeated_batch_are_replaced(spark, tmp_path):
    schema = "event_id long, thread_id string, polled_at timestamp, fetched_this_cycle int"
    folder, table = str(tmp_path / "in"), str(tmp_path / "stats")
    for part in range(2):
        arrive(spark, [(part, "t", START + timedelta(days=part), 1)], schema, folder)
        for checkpoint in ("one", "two"):  # the second one runs the same batches again
            stats = spark.readStream.schema(schema).parquet(folder)
            jobs.record_stats(stats, table, str(tmp_path / checkpoint))
    rows = spark.read.parquet(table)
    assert sorted((r.event_id, r.run, str(r.polled_date)) for r in rows.collect()) == [
        (0, "batch-0", "2024-03-01"), (1, "batch-1", "2024-03-02")]
