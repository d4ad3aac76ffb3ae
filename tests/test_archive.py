import json

import pytest
import zstandard
from pyspark.sql import functions as F

from mentionlake.operators import archive, mapping, quality
from mentionlake.operators.keyed_write import upsert_mutable
from mentionlake.sources import jsonl

IN_MAY = 1714521600 + 86400  # 2 May 2024
WANTED = quality.LoadFilter(["Rockets"], "2024-05-01", "2024-05-31")


def comment(i, **changes):
    line = {
        "name": f"t1_c{i}",
        "id": f"c{i}",
        "link_id": "t3_p1",
        "parent_id": "t3_p1",
        "subreddit": "Rockets",
        "author": f"user{i}",
        "body": f"text {i}",
        "score": i,
        "created_utc": IN_MAY + i,
        "retrieved_on": IN_MAY + 500,
        "edited": False,
        "awards": [{"n": 1}],
    }
    line.update(changes)
    return {k: v for k, v in line.items() if v != "absent"}


LINES = [json.dumps(comment(i)) for i in range(1, 6)] + [
    json.dumps(comment(6, subreddit="Gardening")),
    json.dumps(comment(7, created_utc=1000000000)),
    json.dumps(comment(8, author="[deleted]")),
    json.dumps(comment(9, body="[removed]")),
    json.dumps(comment(10, name="absent")),
    '{"broken": ',
]


@pytest.fixture
def dump(tmp_path):
    def write(lines, name="dump.jsonl"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


def load(spark, paths, out, **options):
    options.setdefault("wanted", WANTED)
    tables = {"comments": f"{out}/comments", "posts": f"{out}/posts"}
    return archive.load_archive(spark, paths, tables, **options)


def test_counts_and_second_load(spark, dump, tmp_path):
    path = dump(LINES)
    first = load(spark, [path], tmp_path, quarantine=f"{tmp_path}/bad")
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert [(r.file, r.rejected) for r in bad] == [(path, LINES[10])]
    assert (first.read, first.skipped_malformed, first.skipped_filter) == (11, 1, 2)
    assert (first.matched, first.inserted, first.files) == (8, 8, 1)
    again = load(spark, [path], tmp_path)
    assert (again.matched, again.inserted) == (8, 0)
    rows = {r.id: r for r in spark.read.parquet(f"{tmp_path}/comments").collect()}
    assert len(rows) == 8
    assert rows["t1_c8"].author is None
    assert rows["t1_c9"].body == "[removed]"
    assert "t1_c10" in rows
    assert rows["t1_c1"].subreddit == "rockets"
    assert rows["t1_c1"].created_utc.timestamp() == IN_MAY + 1
    assert json.loads(rows["t1_c1"].raw.toJson())["awards"] == [{"n": 1}]


def test_zstd_with_a_long_window(spark, tmp_path):
    setup = zstandard.ZstdCompressionParameters.from_level(3, window_log=28)
    packed = zstandard.ZstdCompressor(compression_params=setup).compress("\n".join(LINES).encode())
    path = tmp_path / "dump.jsonl.zst"
    path.write_bytes(packed)
    stats = load(spark, [str(path)], tmp_path, spread=3)
    assert (stats.read, stats.matched, stats.inserted) == (11, 8, 8)


def test_kind_is_told_by_the_first_object(spark, dump, tmp_path):
    post = {"id": "p1", "title": None, "subreddit": "Rockets", "created_utc": IN_MAY, "score": 1}
    files = [
        dump(["", "not json", json.dumps(post)], "posts.jsonl"),
        dump([json.dumps(comment(1)), json.dumps(post)], "comments.jsonl"),
    ]
    listed = jsonl.list_files(files)
    kinds = dict(quality.file_kinds(jsonl.read_heads(spark, listed)).collect())
    assert kinds == {files[0]: "posts", files[1]: "comments"}
    stats = load(spark, files, tmp_path)
    assert (stats.read, stats.matched, stats.files) == (5, 2, 2)
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/posts").collect()] == ["t3_p1"]


def test_file_without_objects_cannot_be_told(spark, dump, tmp_path):
    with pytest.raises(ValueError):
        load(spark, [dump(["", "nothing"])], tmp_path)


def test_first_copy_wins_across_files(spark, dump, tmp_path):
    first = dump([json.dumps(comment(1, score=5)), json.dumps(comment(1, score=6))], "b.jsonl")
    second = dump([json.dumps(comment(1, score=7))], "a.jsonl")
    stats = load(spark, [first, second], tmp_path)
    assert (stats.matched, stats.inserted) == (3, 1)
    assert [r.score for r in spark.read.parquet(f"{tmp_path}/comments").collect()] == [5]


@pytest.mark.parametrize(
    "line, status",
    [
        ("", "blank"),
        (" \t ", "blank"),
        ("[1]", "malformed"),
        ("3", "malformed"),
        (json.dumps(comment(1, created_utc="soon")), "malformed"),
        (json.dumps(comment(1, created_utc="absent")), "malformed"),
        (json.dumps(comment(1, created_utc="absent", subreddit="x")), "filtered"),
        (json.dumps(comment(1, link_id="absent")), "malformed"),
        (json.dumps(comment(1, link_id="absent", created_utc=0)), "filtered"),
        (json.dumps(comment(1, name="absent", id="absent")), "malformed"),
        (json.dumps(comment(1, name="", id="t1_q")), "matched"),
        (json.dumps(comment(1, created_utc=str(IN_MAY))), "matched"),
        ('{"subreddit":"x",' + json.dumps(comment(1))[1:], "matched"),
    ],
)
def test_line_status(spark, line, status):
    rows = spark.createDataFrame([("f", line)], "file string, value string")
    assert archive.classify_lines(rows, "comments", WANTED).first().status == status


def test_empty_forum_set_keeps_all(spark):
    rows = spark.createDataFrame([("f", json.dumps(comment(1, subreddit="any")))], "file string, value string")
    every = quality.LoadFilter(subreddits=())
    assert archive.classify_lines(rows, "comments", every).first().status == "matched"


def test_nul_characters_are_removed_everywhere(spark, dump, tmp_path):
    bad = comment(1, body="a\x00b", author="u\x00", note={"k\x00": ["\x00z"]})
    load(spark, [dump([json.dumps(bad)])], tmp_path)
    row = spark.read.parquet(f"{tmp_path}/comments").first()
    assert (row.body, row.author) == ("ab", "u")
    assert json.loads(row.raw.toJson())["note"] == {"k": ["z"]}


def test_counters_per_file(spark):
    rows = spark.createDataFrame(
        [("a", LINES[0]), ("a", ""), ("a", "{"), ("b", LINES[5])], "file string, value string"
    )
    counts = quality.load_counts(archive.classify_lines(rows, "comments", WANTED))
    got = {r.file: (r.files, r.read, r.matched, r.skipped_malformed, r.skipped_filter) for r in counts.collect()}
    assert got == {"a": (1, 3, 1, 1, 0), "b": (1, 1, 0, 0, 1), None: (2, 4, 1, 1, 1)}


def test_each_line_is_parsed_once(spark):
    rows = spark.createDataFrame([("f", LINES[0])], "file string, value string")
    rows = rows.withColumns({"source_rank": F.lit(0), "block": F.lit(0), "line": F.lit(0)})
    mapped = mapping.map_comments(archive.classify_lines(rows, "comments", WANTED))
    plan = mapped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.count("parse_json") == 1, plan


def test_polled_rows_change_only_mutable_columns(spark, dump, tmp_path):
    lines = [json.dumps(comment(i)) for i in (1, 2)] + [json.dumps(comment(3, created_utc=IN_MAY + 5 * 86400))]
    load(spark, [dump(lines)], tmp_path)
    table = f"{tmp_path}/comments"
    before = {r.id: r for r in spark.read.parquet(table).collect()}
    polled = [json.dumps(comment(1, score=50, body="edited")), json.dumps(comment(9, score=7))]
    rows = spark.createDataFrame([("f", p, i) for i, p in enumerate(polled)], "file string, value string, line long")
    rows = rows.withColumns({"source_rank": F.lit(0), "block": F.lit(0).cast("long")})
    mapped = mapping.map_comments(archive.classify_lines(rows, "comments", WANTED))
    archive.upsert_rows(mapped, table, ["score"], ["line"])
    after = {r.id: r for r in spark.read.parquet(table).collect()}
    assert {k: r.score for k, r in after.items()} == {"t1_c1": 50, "t1_c2": 2, "t1_c3": 3, "t1_c9": 7}
    assert after["t1_c1"].body == "text 1"
    assert after["t1_c1"].ingested_at == before["t1_c1"].ingested_at
    assert after["t1_c9"].ingested_at > before["t1_c1"].ingested_at


def test_first_poll_makes_the_table(spark, tmp_path):
    rows = spark.createDataFrame([("f", json.dumps(comment(1)), 0)], "file string, value string, line long")
    rows = rows.withColumns({"source_rank": F.lit(0), "block": F.lit(0).cast("long")})
    mapped = mapping.map_comments(archive.classify_lines(rows, "comments", WANTED))
    for score in (4, 5):
        archive.upsert_rows(mapped.withColumn("score", F.lit(score)), f"{tmp_path}/comments", ["score"], ["line"])
    assert [(r.id, r.score) for r in spark.read.parquet(f"{tmp_path}/comments").collect()] == [("t1_c1", 5)]


def test_rows_without_an_id_are_never_added(spark, dump, tmp_path):
    odd = json.dumps(comment(1, name=5, id="absent"))
    for _ in range(2):
        stats = load(spark, [dump([json.dumps(comment(2)), odd])], tmp_path)
    assert (stats.matched, stats.skipped_malformed, stats.inserted) == (1, 1, 0)
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/comments").collect()] == ["t1_c2"]


def test_kind_is_told_by_what_the_parser_takes(spark, dump, tmp_path):
    first = json.dumps(comment(1, score=float("nan")))
    stats = load(spark, [dump([first, json.dumps(comment(2))], "my 100% dump+1.jsonl")], tmp_path)
    assert (stats.matched, stats.skipped_malformed, stats.inserted) == (1, 1, 1)


def test_upsert_does_not_aggregate_payload(spark):
    known = spark.createDataFrame([("a", 1, "body", 5)], "id string, at int, body string, score int")
    merged = upsert_mutable(known, known.withColumn("seq", F.lit(1)), ["id", "at"], ["score"], ["seq"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert all("body" not in line for line in plan.splitlines() if "Aggregate" in line)
