import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from mentionlake.operators import archive, bucketed, keyed_write as kw, layout

ROWS = "id int, at int, author string, score int, seq int"

T0 = datetime(2024, 1, 1)


def test_insert_ignore_is_idempotent(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(30), rng.randrange(2), f"a{i}", i, i) for i in range(200)]
    incoming = spark.createDataFrame(rows, ROWS).repartition(5)
    known = spark.createDataFrame([r for r in rows if r[0] < 5][:8], ROWS)
    fresh = kw.insert_ignore(known, incoming, ["id", "at"], ["seq"])
    keys = {(r.id, r.at) for r in known.collect()}
    want = {}
    for r in rows:
        if (r[0], r[1]) not in keys:
            want.setdefault((r[0], r[1]), r[4])
    assert {(r.id, r.at): r.seq for r in fresh.collect()} == want
    table = known.unionByName(fresh)
    assert kw.insert_ignore(table, incoming, ["id", "at"], ["seq"]).count() == 0


def test_upsert_keeps_fixed_columns_and_takes_nulls(spark):
    known = spark.createDataFrame([(1, 0, "first", 1), (2, 0, None, 2)], "id int, at int, author string, score int")
    polls = spark.createDataFrame(
        [(1, 0, "x", 5, 1), (1, 0, "y", None, 2), (3, 0, "new", 1, 1), (3, 0, "newer", 9, 2), (2, 0, "z", 7, 1)],
        ROWS,
    )
    got = kw.upsert_mutable(known, polls, ["id", "at"], ["score"], ["seq"])
    assert sorted(map(tuple, got.collect())) == [(1, 0, "first", None), (2, 0, None, 7), (3, 0, "new", 9)]


def test_latest_by_key(spark):
    log = spark.createDataFrame([("k", "a", 1, 1), ("k", None, 2, 2), ("k", "c", 2, 1)], "key string, value string, at int, i int")
    assert [tuple(r) for r in kw.latest_by_key(log, ["key"], ["at", "i"]).collect()] == [("k", None, 2, 2)]


def rows_over_days(spark, days):
    start = datetime(2024, 6, 1)
    rows = [(f"r{d}_{i}", "f" if i % 2 else "g", start + timedelta(days=d, minutes=i)) for d in days for i in range(20)]
    return spark.createDataFrame(rows, "id string, subreddit string, created_utc timestamp")


def test_layout_compaction_and_occupancy(spark, tmp_path):
    table, target = str(tmp_path / "t"), str(tmp_path / "t2")
    for _ in range(3):
        layout.append_rows(rows_over_days(spark, [0, 1, 4, 12]), table)
    rows = layout.read_table(spark, table)
    today = F.lit(date(2024, 6, 13))
    due = layout.due_for_compaction(rows, today).collect()
    assert [r.files for r in due] == [3, 3, 3] and sorted(r.created_date.day for r in due) == [1, 2, 5]
    days = layout.compact(rows, today, target)
    parts = layout.compacted_parts(rows, days, target)
    assert parts[0].count() == 60 and parts[1].count() == 180
    assert layout.compact(parts[1], today, str(tmp_path / "t3")) == []  # single files stay where they are
    assert layout.compacted_parts(parts[1], [], "")[0].count() == 180
    assert {r.files for r in layout.files_by_date(parts[1]).collect()} == {1}
    report = layout.occupancy({"t": rows}).first()
    assert (report.rows, report.empty_days, report.nonempty_days) == (240, 9, 4) and report.bytes > 0


def test_files_are_sorted_inside(spark, tmp_path):
    table = str(tmp_path / "t")
    layout.append_rows(rows_over_days(spark, [0]), table)
    got = [(r.subreddit, r.created_utc) for r in spark.read.parquet(table).collect()]
    assert got == sorted(got, key=lambda r: (r[0], -r[1].timestamp()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_cut_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id")
    plan = plan_of(kw.first_wins(df, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_date_filter_prunes_folders(spark, tmp_path):
    from mentionlake.operators.mining import since

    table = str(tmp_path / "t")
    layout.append_rows(rows_over_days(spark, [0, 40]), table)
    plan = plan_of(since(spark.read.parquet(table), "2024-07-01"))
    assert "PartitionFilters: [isnotnull(created_date" in plan and "created_date#" in plan.split("PartitionFilters")[1]


def stored_side(df):
    """The operators from each bucketed scan up to the join it feeds."""
    lines = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if x.strip()]
    depth = lambda x: len(x) - len(x.lstrip(" +-:*"))
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            above, at = [], depth(line)
            for other in reversed(lines[:i]):
                if depth(other) < at:
                    at = depth(other)
                    if "Join" in other:
                        break
                    above.append(other)
            yield above


def test_stored_keys_stay_in_their_buckets(spark, tmp_path):
    """Loads and upserts equal those of a plain table, and the stored side is never shuffled."""
    table, plain = str(tmp_path / "bucketed"), str(tmp_path / "plain")
    rows = rows_over_days(spark, [0, 1, 4]).withColumn("id", F.concat(F.lit("k"), F.monotonically_increasing_id().cast("string")))
    rows = rows.withColumns({"score": F.lit(1), "ingested_at": F.lit(None).cast("timestamp")})
    more = rows.withColumns({"score": F.lit(5), "line": F.lit(0)})
    more = more.unionByName(more.limit(5).withColumn("id", F.concat("id", F.lit("new"))))
    for _ in range(2):  # also over a table another session has written
        bucketed.append_rows(rows, table, 4)
        layout.append_rows(rows, plain)
        spark.sql(f"DROP TABLE {bucketed._name(table, 4)}")
    known = bucketed.read(spark, table, 4)
    assert known.count() == 2 * rows.count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (kw.insert_ignore(known, more, archive.KEYS, ["line"]), kw.upsert_mutable(known, layout.with_date(more), archive.KEYS, ["score"], ["line"])):
            paths = list(stored_side(df))
            assert paths and not any("Exchange" in node for path in paths for node in path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for target, buckets in ((table, 4), (plain, None)):
        archive.upsert_rows(more.drop("ingested_at"), target, ["score"], ["line"], buckets)
    columns = ["id", "created_utc", "score", "created_date"]
    got, want = (sorted(map(tuple, d.select(*columns).collect())) for d in (bucketed.read(spark, table, 4), spark.read.parquet(plain)))
    assert got == want and {r[2] for r in got} == {5}


def test_dates_of_a_bucket_are_written_by_many_tasks(spark, tmp_path):
    """More tasks than buckets write, and still each bucket of a date gets one file from a load."""
    table = str(tmp_path / "bucketed")
    rows = rows_over_days(spark, list(range(12))).withColumn("id", F.concat(F.lit("k"), F.monotonically_increasing_id().cast("string")))
    bucketed.append_rows(rows, table, 2)
    files = [p for p in (tmp_path / "bucketed").rglob("*.parquet")]
    assert len({p.name.split("-")[1] for p in files}) > 2
    assert len({(p.parent, p.name.split("_")[1]) for p in files}) == len(files) <= 24
    assert bucketed.read(spark, table, 2).count() == rows.count()


def test_an_upsert_reads_rows_in_buckets_once(spark, tmp_path):
    """Null keys, repeated keys and several polls as in the upsert of two joins."""
    stored = "id string, created_utc timestamp, a string, score int, created_date date"
    old = spark.createDataFrame(
        [(i, c, a, s, None) for i, c, a, s in [("x", T0, "o", 1), ("x", T0, "p", 2), ("y", T0, None, 3), (None, T0, "q", 4), ("z", T0, "r", 5)]], stored)
    polled = spark.createDataFrame(
        [("x", T0, "n", 9, 2), ("x", T0, "m", None, 3), ("w", T0, "f", 7, 1), ("w", T0, "g", 8, 2), (None, T0, "h", 1, 1), ("z", None, "h", 1, 1)],
        "id string, created_utc timestamp, a string, score int, poll int").withColumn("created_date", F.lit(None).cast("date"))
    got, want = (sorted(f(old, polled, archive.KEYS, ["score"], ["poll"]).collect(), key=str) for f in (kw.upsert_stored, kw.upsert_mutable))
    assert got == want and len(got) == 6 and kw.upsert_stored(old, polled, archive.KEYS, ["score"], ["poll"]).columns == old.columns
    table = str(tmp_path / "bucketed")
    rows = rows_over_days(spark, [0, 1]).withColumns({"id": F.concat(F.lit("k"), F.monotonically_increasing_id().cast("string")), "score": F.lit(1)})
    bucketed.append_rows(rows, table, 4)
    merged = kw.upsert_stored(bucketed.read(spark, table, 4), layout.with_date(rows.withColumn("line", F.lit(0))), archive.KEYS, ["score"], ["line"])
    paths = list(stored_side(merged))
    assert len(paths) == 1 and not any("Exchange" in node for node in paths[0])


def test_filters_on_many_dates_are_short(spark):
    days = [date(2024, 1, 1) + timedelta(i) for i in range(3000) if i != 1000]
    assert str(layout.on_days([*days, *days])._jc).count("DATE") + str(layout.on_days(days)._jc).count("BETWEEN") <= 8
    sparse = days[::7]
    table = spark.createDataFrame([(d,) for d in days] + [(None,)], "created_date date")
    for some in (days[5:40], days[:990] + days[1010:1100], sparse, days[:1], []):
        assert {r[0] for r in table.filter(layout.on_days(some)).collect()} == set(some)
