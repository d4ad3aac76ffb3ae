"""Content-addressed WARC archive.

An archive is a folder with two tables. ``payloads`` holds the bytes of every distinct payload once, under
their SHA-256; ``headers`` holds one row for each record with its exact header bytes (WARC header, empty
line, HTTP header, empty line) and the address of its payload. ``restore`` joins both, so a record is
again the bytes it was: headers, then the payload (a revisit has none of its own), then two line ends.

Digests are verified twice. When an archive is written, copies under one address have to agree in length,
SHA-1 and a third hash; when it is read, the address has to be the SHA-256 of the bytes found. Either
mismatch ends the job.

``records`` makes such records of web pages: of pages with equal payloads of ``least_bytes`` or more the
one with the smallest (key, url) is the response, the others revisit it; smaller payloads are all
responses. Keys order as their type does, a missing key comes last. Payload bytes move once, dealt by
address after copies were dropped on the map side; everything else works on keys and digests, and the
response of a very common payload meets its revisits in a join that Spark can split.

A missing payload is empty, a missing url is left out of the header, a missing key too (it is read back as
null). Rows that are repeated are records of their own: the first is the response. Line ends inside a url are percent-encoded. Very long
payloads are one value; none is cut. Further columns are ignored, whatever they are called. An empty
table gives an empty archive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mentionlake.session import materialize, new_folder

# fixed values of the format
VERSION = "WARC/1.1"
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DATE = "1970-01-01T00:00:00Z"  # of records whose fetch time is not known
KEY_FIELD = "X-Record-Key"
REFERS_FIELD = "X-Refers-To-Key"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 20 bits at a time, four letters each."""

    def letters(group: int) -> list[Column]:
        bits = F.conv(F.substring(hexadecimal, 5 * group + 1, 5), 16, 10).cast("int")
        five = [F.shiftright(bits, shift).bitwiseAND(F.lit(31)) for shift in (15, 10, 5, 0)]
        return [F.substr(F.lit(BASE32), x + 1, F.lit(1)) for x in five]

    return F.concat(*[x for group in range(8) for x in letters(group)])


def _field(name: str, value: Column) -> Column:
    """One header line; none for a missing value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))


def _urn(seed: Column) -> Column:
    """Record id in the form of a UUID."""
    digits = F.md5(seed.cast("binary"))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _payload(column: str) -> Column:
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def entries(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(seq, key, url, address, sha1, size, mark) of every page, written to the shared folder.

    ``seq`` tells repeated rows apart; it is fixed by being written.
    """
    data = _payload(payload)
    return materialize(
        pages.select(
            F.monotonically_increasing_id().alias("seq"),
            F.col(key).alias("key"),
            F.regexp_replace(F.regexp_replace(F.col(url).cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
            F.sha2(data, 256).alias("address"),
            F.sha1(data).alias("sha1"),
            F.octet_length(data).cast("long").alias("size"),
            F.xxhash64(data).alias("mark"),
        ),
        "warc-entries",
    )


def _order(prefix: str = "") -> Column:
    """A struct whose least value is the response."""
    c = lambda name: F.col(prefix + name)
    return F.struct(c("key").isNull().alias("missing"), c("key").alias("key"), c("url").alias("url"), c("seq").alias("seq"))


def records(found: DataFrame, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """(headers, address) for each of the ``entries``; headers are exact bytes."""
    agree = F.min(F.struct("size", "sha1", "mark")) == F.max(F.struct("size", "sha1", "mark"))
    groups = (
        found.groupBy("address")
        .agg(F.min(_order()).alias("first"), F.count("*").alias("copies"), agree.alias("agree"))
        .where("copies > 1")
        .select("address", "first", F.assert_true("agree", F.lit("different payloads under one digest")).alias("checked"))
        .where("checked IS NULL")
        .drop("checked")
    )
    revisit = F.col("first").isNotNull() & (F.col("size") >= least_bytes) & (F.col("seq") != F.col("first.seq"))
    text = lambda c: c.cast("string")
    own = _urn(F.concat_ws(":", text(F.col("seq")), F.col("address")))
    response = _urn(F.concat_ws(":", text(F.col("first.seq")), F.col("address")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"),
        _field("Content-Length", text(F.col("size"))), F.lit(EOL),
    )
    rows = found.join(groups, "address", "left").withColumns({"revisit": revisit, "http": http})
    when = lambda value: F.when(F.col("revisit"), value)
    headers = F.concat(
        F.lit(f"{VERSION}{EOL}"),
        _field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", own),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _field("WARC-Profile", when(F.lit(PROFILE))),
        _field("WARC-Refers-To", when(response)),
        _field("WARC-Refers-To-Target-URI", when(F.col("first.url"))),
        _field(REFERS_FIELD, when(text(F.col("first.key")))),
        _field(KEY_FIELD, text(F.col("key"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", text(F.length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("size")))),
        F.lit(EOL),
        F.col("http"),
    )
    return rows.select(headers.cast("binary").alias("headers"), "address")


def payloads(pages: DataFrame, payload: str) -> DataFrame:
    """(address, payload): every distinct payload once."""
    data = _payload(payload)
    addressed = pages.select(F.sha2(data, 256).alias("address"), data.alias("payload"))
    return addressed.groupBy("address").agg(F.first("payload").alias("payload"))


def write(
    pages: DataFrame, folder: str | None = None, *, key: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = 0, date: str = DATE,
) -> str:
    """Archive the pages; returns the folder, by default a new one in the shared folder."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    found = entries(pages, key, url, payload)
    records(found, least_bytes, date).write.option("compression", "zstd").parquet(f"{folder}/headers")
    payloads(pages, payload).write.option("compression", "zstd").parquet(f"{folder}/payloads")
    return folder


def header(name: str, headers: Column | str = "headers") -> Column:
    """Value of a field of the WARC header; null if it is not there."""
    column = F.col(headers) if isinstance(headers, str) else headers
    lines = F.concat(F.substring_index(column.cast("string"), f"{EOL}{EOL}", 1), F.lit(EOL))
    value = F.regexp_extract(lines, f"\\r\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(F.contains(lines, F.lit(f"{EOL}{name}: ")), value)


def restore(spark: SparkSession, folder: str) -> DataFrame:
    """(headers, payload, size, sha1) of every record; a revisit has the payload of its response.

    Bytes that do not fit their address end the job. Digest and size come from the stored bytes, once for
    each payload; a reader that asks for no payload moves none.
    """
    stored = spark.read.parquet(f"{folder}/payloads")
    fits = F.assert_true(F.sha2("payload", 256) == F.col("address"), F.lit("a payload does not fit its address"))
    checked = stored.select(
        "address", "payload",
        F.octet_length("payload").cast("long").alias("size"),
        F.when(fits.isNull(), base32(F.sha1("payload"))).alias("sha1"),
    )
    return spark.read.parquet(f"{folder}/headers").join(checked, "address").drop("address")


def is_revisit() -> Column:
    return header("WARC-Type") == "revisit"


def record_bytes() -> Column:
    """The whole record of a restored row, as it stands in a WARC file."""
    return F.concat("headers", F.when(is_revisit(), F.lit(b"")).otherwise(F.col("payload")), F.lit(f"{EOL}{EOL}".encode()))


def export(spark: SparkSession, folder: str, target: str, files: int | None = None) -> None:
    """Write the archive as WARC files, one gzip stream each; ``files`` of them, else one for each task.

    A record ends with two line ends, so Spark's text writer writes records as lines that end so.
    """
    rows = restore(spark, folder).select(
        F.concat("headers", F.when(is_revisit(), F.lit(b"")).otherwise(F.col("payload"))).cast("string").alias("value"))
    rows = rows.repartition(files) if files else rows
    rows.write.option("lineSep", f"{EOL}{EOL}").option("compression", "gzip").text(target)


def digests(rows: DataFrame) -> DataFrame:
    """What a restored row says of itself: (key, size, sha1, record_type, refers_to); keys are texts."""
    return rows.select(
        header(KEY_FIELD).alias("key"),
        "size", "sha1",
        header("WARC-Type").alias("record_type"),
        header(REFERS_FIELD).alias("refers_to"),
    )


def _hex_letters() -> str:
    """DuckDB: base32 of 20 bits at a time."""
    part = lambda g: f"CAST('0x' || substr(h, {5 * g + 1}, 5) AS INT)"
    one = lambda g, shift: f"substr('{BASE32}', (({part(g)} >> {shift}) & 31) + 1, 1)"
    return reduce(lambda a, b: f"{a} || {b}", [one(g, s) for g in range(8) for s in (15, 10, 5, 0)])


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_hex_letters()} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (html)"""
