"""The whole pipeline from files to files."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from mentionlake import jobs
from mentionlake.operators import archive, capture, quality, snapshots

NASDAQ = """Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares
PEAR|Pear Inc. - Common Stock|Q|N|N|100|N|N
File Creation Time: 0101202400:00|||||||
"""
OTHER = """ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol
LIME|Lime Holdings|P|LIME|N|100|N|LIME
File Creation Time: 0101202400:00|||||||
"""
START = datetime(2024, 5, 2, 14, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    start = int(START.timestamp())
    tags = {"PEAR": 9, "OLDY": 8, "BECKY": 7, "DOGE": 6, "RDBX": 5, "SOLD": 4, "MOON": 3, "QQQZ": 2}
    texts = [f"${s}" for s, n in tags.items() for _ in range(n)]
    comments = [
        {"name": f"t1_{i}", "link_id": "t3_day", "parent_id": "t3_day", "subreddit": "stocks", "author": "a",
         "body": t, "score": 1, "created_utc": start + 60 * i}
        for i, t in enumerate(texts)
    ]
    posts = [{"id": "day", "title": "Daily $SOLD", "subreddit": "stocks", "created_utc": start, "score": 1}]
    (root / "comments.jsonl").write_text("\n".join(json.dumps(c) for c in comments))
    (root / "posts.jsonl").write_text("\n".join(json.dumps(p) for p in posts))
    (root / "nasdaqlisted.txt").write_text(NASDAQ)
    (root / "otherlisted.txt").write_text(OTHER)
    (root / "history").mkdir()
    (root / "history" / "wayback_2020_nasdaqlisted.txt").write_text(NASDAQ.replace("PEAR", "SOLD").replace("Pear", "Sold"))
    (root / "history" / "wayback_2020_otherlisted.txt").write_text(OTHER)
    (root / "map.json").write_text('{"0":{"ticker":"LIME","title":"Lime Holdings"}}')
    (root / "table.json").write_text('{"fields":["name","ticker","exchange"],"data":[["Lime","LIME",null]]}')
    (root / "coins.json").write_text('[{"symbol":"doge","name":"Dogecoin"}]')
    (root / "words.txt").write_text("MOON\nBECKY\n")
    (root / "filings.csv").write_text("symbol,hit,label\nQQQZ,true,Q Corp (QQQZ)\n")
    return root


def test_pipeline(spark, folder):
    raw = {"comments": f"{folder}/raw/comments", "posts": f"{folder}/raw/posts"}
    stats = archive.load_archive(
        spark, [f"{folder}/comments.jsonl", f"{folder}/posts.jsonl"], raw,
        wanted=quality.LoadFilter(["stocks"], "2024-05-01"),
    )
    assert (stats.read, stats.inserted, stats.files) == (45, 45, 2)

    tables = jobs.UniverseTables(f"{folder}/tickers", f"{folder}/names")
    assert jobs.load_universe(spark, f"{folder}/nasdaqlisted.txt", f"{folder}/otherlisted.txt", tables) == (2, 2)

    jobs.mine(spark, raw["comments"], raw["posts"], tables, f"{folder}/review", min_count=4)
    lists = {
        "sec_map": f"{folder}/map.json", "sec_exchange": f"{folder}/table.json",
        "historical": f"{folder}/history", "coins": f"{folder}/coins.json",
        "stoplist": f"{folder}/words.txt", "filings": f"{folder}/filings.csv",
    }
    counts = jobs.classify(spark, f"{folder}/review", lists, f"{folder}/buckets", min_cashtag=2)
    assert {r.bucket: r.n for r in counts.collect()} == {
        "confirmed": 3, "review_foreign": 1, "stoplist": 2, "crypto": 1}

    dry = jobs.promote(spark, f"{folder}/buckets", lists["stoplist"], tables, f"{folder}/out", dry_run=True)
    assert snapshots.versions(spark, tables.tickers) == [1]
    done = jobs.promote(spark, f"{folder}/buckets", lists["stoplist"], tables, f"{folder}/out")
    assert sorted(map(tuple, dry.collect())) == sorted(map(tuple, done.collect()))
    tickers = {r.symbol: r for r in snapshots.read(spark, tables.tickers, jobs.TICKERS).collect()}
    assert set(tickers) == {"PEAR", "LIME", "OLDY", "RDBX", "SOLD", "QQQZ"}
    assert (tickers["SOLD"].name, tickers["SOLD"].exchange) == ("Sold Inc. - Common Stock", "CORPUS")
    assert (tickers["QQQZ"].name, tickers["OLDY"].exchange) == ("Q Corp (QQQZ)", "OTC-FOREIGN")
    again = jobs.promote(spark, f"{folder}/buckets", lists["stoplist"], tables, f"{folder}/out2")
    assert {(r.metric, r.item): r.n for r in again.collect()}[("after", "corpus_mined")] == 4
    names = {r.normalized_name: r.symbol for r in snapshots.read(spark, tables.names, jobs.NAMES).collect()}
    assert names["pear"] == "PEAR" and names["sold"] == "SOLD"


def test_report_over_recorded_polls(spark, folder):
    comments = spark.createDataFrame(
        [(f"c{i}", "t3_day", START.replace(tzinfo=None) + timedelta(minutes=i)) for i in range(90)],
        "id string, post_id string, created_utc timestamp",
    )
    polls = spark.createDataFrame(
        [(1, "t3_day", START.replace(tzinfo=None), 100, 10, True), (2, "t3_new", START.replace(tzinfo=None), None, 0, False)],
        "event_id long, thread_id string, polled_at timestamp, num_comments_reported int, "
        "fetched_this_cycle int, was_truncated boolean",
    )
    stats, raw = f"{folder}/stats", f"{folder}/report_comments"
    capture.append_stats(capture.poll_stats(polls, comments), stats, "r1")
    comments.write.parquet(raw)
    hours, day = jobs.capture_report(spark, stats, raw, "2024-05-02")
    assert [(r.comment_volume, r.comments_in_db, r.capture_rate_pct, r.truncations) for r in hours.collect()] == [
        (60, 90, 90.0, 1), (30, 0, None, 0)]
    assert "isolated" in day.first().verdict
