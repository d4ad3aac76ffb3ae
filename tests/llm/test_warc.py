"""Content-addressed archive: exact records, copies, digests."""

import base64
import glob
import gzip
import hashlib

import pytest

from mentionlake.llm import warc
from mentionlake.session import new_folder

SCHEMA = "page_id long, url string, html string, size int, address string"
ROWS = [
    (3, "http://a/3", "same", 1, "x"), (1, "http://a/1", "same", 1, "x"), (2, "http://a/2", "other \r\n\r\nX-Record-Key: 9\r\n", 1, "x"),
    (4, None, None, 1, "x"), (5, "http://a/\r\nX-Record-Key: 7", "", 1, "x"), (6, "http://a/6", "ü€\U0001f600\x00", 1, "x"),
    (7, "u", "y" * 300_000, 1, "x"), (8, "u", "rep", 1, "x"), (8, "u", "rep", 1, "x"), (None, "u", "same", 1, "x"), (None, "u", "alone", 1, "x"),
]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, frame):
    folder = warc.write(frame(ROWS, SCHEMA).repartition(3))
    rows = warc.restore(spark, folder)
    got = sorted(((r["key"], r["size"], r["sha1"], r["record_type"], r["refers_to"]) for r in warc.digests(rows).collect()), key=repr)
    want = [
        ("1", 4, sha1("same"), "response", None), ("3", 4, sha1("same"), "revisit", "1"), (None, 4, sha1("same"), "revisit", "1"),
        ("2", 27, sha1(ROWS[2][2]), "response", None), ("4", 0, sha1(""), "response", None), ("5", 0, sha1(""), "revisit", "4"),
        ("6", 10, sha1(ROWS[5][2]), "response", None), ("7", 300_000, sha1(ROWS[6][2]), "response", None),
        ("8", 3, sha1("rep"), "response", None), ("8", 3, sha1("rep"), "revisit", "8"), (None, 5, sha1("alone"), "response", None),
    ]
    assert got == sorted(want, key=repr)
    stored = [bytes(r[0]) for r in spark.read.parquet(f"{folder}/payloads").select("payload").collect()]
    assert len(stored) == len(set(stored)) == len({r[2] or "" for r in ROWS})
    assert len({r[0] for r in rows.select(warc.header("WARC-Record-ID")).collect()}) == len(ROWS)


def parsed(data):
    """(header fields, block) of each record of a WARC stream, by lengths alone."""
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        yield fields, rest[:size]
        data = rest[size + 4 :]


def test_files(spark, frame):
    target = new_folder(spark, "warc-files")
    folder = warc.write(frame(ROWS, SCHEMA))
    warc.export(spark, folder, target, 2)
    found = [r for f in glob.glob(f"{target.removeprefix('file:')}/*.gz") for r in parsed(gzip.open(f).read())]
    assert len(found) == len(ROWS)
    ids = {f["WARC-Record-ID"]: f for f, _ in found}
    for fields, block in found:
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "revisit":
            assert not body and ids[fields["WARC-Refers-To"]]["WARC-Type"] == "response"
            assert ids[fields["WARC-Refers-To"]]["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
        else:
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
            assert f"Content-Length: {len(body)}".encode() in http
    whole = sorted(bytes(r[0]) for r in warc.restore(spark, folder).select(warc.record_bytes()).collect())
    assert [x for record in whole for x in parsed(record)] and len(whole) == len(ROWS)


def test_least_bytes(spark, frame):
    rows = warc.restore(spark, warc.write(frame(ROWS, SCHEMA), least_bytes=4))
    revisits = {(r["key"], r["refers_to"]) for r in warc.digests(rows).collect() if r["record_type"] == "revisit"}
    assert revisits == {("3", "1"), (None, "1")}


def test_changed_bytes_are_found(spark, frame):
    folder = warc.write(frame(ROWS[:2], SCHEMA))
    spark.read.parquet(f"{folder}/payloads").selectExpr("address", "concat(payload, x'00') AS payload").write.parquet(f"{folder}2/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}2/headers")
    with pytest.raises(Exception, match="does not fit"):
        warc.digests(warc.restore(spark, f"{folder}2")).collect()


def test_empty(spark, frame):
    assert warc.digests(warc.restore(spark, warc.write(frame([], SCHEMA)))).count() == 0
