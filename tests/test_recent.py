"""Ingest that remembers recent keys, against the load that looks all of them up."""

import json
import random
from datetime import datetime, timezone

import pytest

from mentionlake.operators import archive
from mentionlake.sources import jsonl
from mentionlake.streaming import jobs, recent

START = int(datetime(2024, 3, 1, tzinfo=timezone.utc).timestamp())


def comment(name, hour, score=1):
    return {"id": name, "created_utc": START + int(hour * 3600), "subreddit": "stocks", "author": "a", "body": "b",
            "link_id": "t3_p", "parent_id": "t3_p", "score": score}


def arrive(folder, number, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{number:03d}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))


def ingest(spark, base, checkpoint="checkpoint", **options):
    options = {"kind": "comments", "recent_hours": 6} | options
    jobs.ingest_lines(spark, str(base / "in"), str(base / "table"), str(base / checkpoint), **options)


def table(spark, base):
    rows = spark.read.parquet(str(base / "table")).collect()
    assert len(rows) == len({(r.id, r.created_utc) for r in rows})
    return {r.id: r.score for r in rows}


@pytest.fixture
def looked_up(monkeypatch):
    """Counts how often the table is read for its keys."""
    calls, stored = [], archive._stored
    monkeypatch.setattr(archive, "_stored", lambda *args: calls.append(args) or stored(*args))
    return calls


def test_fresh_rows_read_no_table(spark, tmp_path, looked_up):
    arrive(tmp_path / "in", 0, [comment("a", 0), comment("b", 10), comment("b", 10, 9)])
    ingest(spark, tmp_path)
    arrive(tmp_path / "in", 1, [comment("b", 10, 5), comment("c", 11), comment("d", 5)])
    ingest(spark, tmp_path)
    assert not looked_up  # d is late in the hour, but younger than the horizon
    assert table(spark, tmp_path) == {"t1_a": 1, "t1_b": 1, "t1_c": 1, "t1_d": 1}
    arrive(tmp_path / "in", 2, [comment("a", 0, 7), comment("old", 1), comment("e", 12)])
    ingest(spark, tmp_path)
    assert looked_up
    assert table(spark, tmp_path) == {f"t1_{x}": 1 for x in ("a", "b", "c", "d", "e", "old")}


def test_equals_the_load_with_look_ups(spark, tmp_path):
    rng = random.Random(4)
    known, parts = [], []
    for part in range(5):
        new = [comment(f"c{part}_{i}", part * 5 + rng.uniform(-20, 5), rng.randrange(9)) for i in range(30)]
        again = [c | {"score": 50 + part} for c in rng.sample(known, min(len(known), 20))]
        rows = new + again + [{"id": "no time"}, comment(None, part)]
        rng.shuffle(rows)
        known += new
        parts.append(rows)
    for part, rows in enumerate(parts):
        arrive(tmp_path / "in", part, rows)
        ingest(spark, tmp_path, max_files=1)
    got = table(spark, tmp_path)
    want = {f"t1_{c['id']}": c["score"] for c in known}
    assert got == want


def test_rows_the_table_held_before(spark, tmp_path):
    """Those of another load are found, by a new checkpoint too."""
    arrive(tmp_path / "in", 0, [comment("a", 0), comment("b", 10)])
    lines = jsonl.read_files(spark, jsonl.list_files([str(tmp_path / "in")]))
    staged = archive.stage(archive.classify_lines(lines, "comments", archive.quality.LoadFilter()), "comments")
    assert archive.add_rows(archive.staged_rows(staged), str(tmp_path / "table")) == 2
    arrive(tmp_path / "in", 1, [comment("b", 10, 3), comment("c", 12)])
    for checkpoint in ("one", "two"):
        ingest(spark, tmp_path, checkpoint)
        assert table(spark, tmp_path) == {"t1_a": 1, "t1_b": 1, "t1_c": 1}


def test_a_batch_that_broke_off_is_looked_up(spark, tmp_path, monkeypatch):
    """The rows are written, then the run fails before the batch is committed."""
    arrive(tmp_path / "in", 0, [comment("a", 0)])
    ingest(spark, tmp_path)
    arrive(tmp_path / "in", 1, [comment("b", 1), comment("a", 0, 4)])
    whole = recent.add_batch

    def broken(*args):
        whole(*args)
        if not args[0].isEmpty():
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(recent, "add_batch", broken)
        with pytest.raises(Exception, match="lost"):
            ingest(spark, tmp_path)
    assert table(spark, tmp_path) == {"t1_a": 1, "t1_b": 1}
    ingest(spark, tmp_path)
    arrive(tmp_path / "in", 2, [comment("c", 2), comment("b", 1, 8)])
    ingest(spark, tmp_path)
    assert table(spark, tmp_path) == {"t1_a": 1, "t1_b": 1, "t1_c": 1}


def test_a_batch_without_rows_adds_nothing(spark, tmp_path, monkeypatch):
    """The stream ends with a batch in which the state forgets; it only leaves its mark."""
    calls, add = [], archive._append_only
    monkeypatch.setattr(archive, "_append_only", lambda *a: calls.append(a) or add(*a))
    arrive(tmp_path / "in", 0, [comment("a", 0), comment("b", 30)])
    ingest(spark, tmp_path)
    assert len(calls) == 1
    arrive(tmp_path / "in", 1, [comment("b", 30, 5), comment("c", 31)])
    ingest(spark, tmp_path)
    assert table(spark, tmp_path) == {"t1_a": 1, "t1_b": 1, "t1_c": 1}
