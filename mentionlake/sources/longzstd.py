"""Data source for zstd JSON lines whose window is larger than the JVM codec accepts.

Forum dumps are compressed with windows up to 2 GiB; the built-in text reader stops at 128 MiB. A zstd
file is a row of frames that decompress on their own. Block headers say how long a frame is, so frames are
found by hopping from header to header, without decompressing. A file of several frames is read by one task
for each run of frames of about ``SPLIT_BYTES``; a line that crosses a border belongs to the run it begins
in, a line that begins right at a border to the run before. A single frame cannot be split: it is one
task, and callers that do heavy work per line should repartition first. Memory is the window plus one batch.

As a stream the source follows a folder. Offsets are the sizes of its files, so planning only lists. A micro-batch
reads the frames that became complete since the last one, and gives the lines that end in them; a frame
that is still being written, and a last line without its line end, wait for more. Lines end with LF or CR LF.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from mentionlake.fixed_values import ZSTD_MAX_WINDOW

FORMAT = "longzstd"
SCHEMA = "file string, block bigint, line bigint, value string"
SPLIT_BYTES = 128 << 20  # compressed, of a task
_BATCH_BYTES = 4 << 20
# names under which Hadoop knows stores that the reader knows by another name
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gs": "gs"}


def open_filesystem(path: str):
    """(file system, path inside it, prefix that turns an inner path back into an address)."""
    from pyarrow import fs

    if "://" in path:
        scheme, rest = path.split("://", 1)
        files, inner = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
        return files, inner, f"{scheme}://"
    return fs.LocalFileSystem(), path.removeprefix("file:"), ""


def sizes(path: str) -> list[tuple[str, int]]:
    """(file, bytes) behind a path: itself, or everything below a folder except hidden and empty files."""
    from pyarrow import fs

    files, inner, prefix = open_filesystem(path)
    info = files.get_file_info(inner)
    if info.is_file:
        return [(prefix + inner, info.size)]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    found = files.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (prefix + f.path, f.size)
        for f in found
        if f.is_file and f.size and not f.base_name.startswith((".", "_"))
    )


def archive_files(path: str) -> list[str]:
    return [name for name, _ in sizes(path)]


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def _is_object(line: str) -> bool:
    """Whether a line is an object to the engine's parser too, which knows no NaN and no infinity."""
    try:
        return isinstance(json.loads(line, parse_constant=_no_constant), dict)
    except ValueError:
        return False


# fixed values of the format
_FRAME, _SKIPPABLE = 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
_DICTIONARY_BYTES, _SIZE_BYTES = (0, 1, 2, 4), (0, 2, 4, 8)
_RLE_BLOCK, _RESERVED_BLOCK = 1, 3


def _frame_end(file, size: int, at: int) -> int | None:
    """Where the frame that begins at ``at`` ends; None if the file ends before it does."""

    def read(where: int, count: int) -> bytes:
        file.seek(where)
        return file.read(count)

    head = read(at, 14)
    if len(head) < 8:
        return None
    (magic,) = struct.unpack_from("<I", head)
    if magic in _SKIPPABLE:
        end = at + 8 + struct.unpack_from("<I", head, 4)[0]
        return end if end <= size else None
    if magic != _FRAME:
        raise ValueError(f"no zstd frame at byte {at}")
    flags = head[4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    content = _SIZE_BYTES[flags >> 6] or single
    at += 5 + (not single) + _DICTIONARY_BYTES[flags & 3] + content
    last = False
    while not last:
        header = read(at, 3)
        if len(header) < 3:
            return None
        value = int.from_bytes(header, "little")
        last, kind, length = value & 1, value >> 1 & 3, value >> 3
        if kind == _RESERVED_BLOCK:
            raise ValueError(f"no zstd block at byte {at}")
        at += 3 + (1 if kind == _RLE_BLOCK else length)
    end = at + 4 * checksum
    return end if end <= size else None


def frames(file, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the complete frames among the first ``size`` bytes of an open file."""
    at = 0
    while at < size and (end := _frame_end(file, size, at)) is not None:
        yield at, end
        at = end


def runs(found: list[tuple[int, int]], size: int, split_bytes: int) -> list[tuple[int, int]]:
    """Consecutive frames as byte ranges of about ``split_bytes``; together they are the whole file."""
    starts = [0]
    for start, _ in found:
        if start - starts[-1] >= split_bytes:
            starts.append(start)
    return list(zip(starts, [*starts[1:], size]))


class _Range:
    """Bytes of an open file between two positions, for the decompressor to read."""

    def __init__(self, file, start: int, end: int):
        self.file, self.at, self.end = file, start, end
        file.seek(start)

    def read(self, count: int = -1) -> bytes:
        left = self.end - self.at
        data = self.file.read(left if count < 0 else min(count, left))
        self.at += len(data)
        return data


def _chunks(file, start: int, end: int, packed: bool = True) -> Iterator[bytes]:
    """Decompressed bytes of a range that begins with a frame."""
    stream = _Range(file, start, end)
    if packed:
        codec = zstandard.ZstdDecompressor(max_window_size=ZSTD_MAX_WINDOW)
        stream = codec.stream_reader(stream, read_across_frames=True)
    while chunk := stream.read(1 << 20):
        yield chunk


def _split(chunks: Iterator[bytes], rest: list[bytes]) -> Iterator[bytes]:
    """Lines that end in the chunks, without their ends; what follows the last one is left in ``rest``."""
    for chunk in chunks:
        *whole, tail = chunk.split(b"\n")
        if whole:
            yield b"".join([*rest, whole[0]])
            yield from whole[1:]
            rest.clear()
        rest.append(tail)


def lines_of_run(file, start: int, end: int, size: int, packed: bool = True) -> Iterator[bytes]:
    """Lines that begin in a run of frames, or at its end; a run from 0 also has the first line."""
    rest: list[bytes] = []
    whole = _split(_chunks(file, start, end, packed), rest)
    if start and next(whole, None) is None:
        return  # no line begins here
    yield from whole
    if end < size:
        further = next(_split(_chunks(file, end, size, packed), rest), None)
        if further is not None:
            yield further
            return
    if any(rest):
        yield b"".join(rest)


def lines_ending_between(file, since: int, size: int) -> Iterator[bytes]:
    """Lines that end in the frames that are complete in the first ``size`` bytes but not in ``since``."""
    found = list(frames(file, size))
    before = [f for f in found if f[1] <= since]
    fresh = found[len(before):]
    if not fresh:
        return
    rest: list[bytes] = []
    for start, end in reversed(before):  # the beginning of a line that has not ended yet
        data = b"".join(_chunks(file, start, end))
        _, newline, tail = data.rpartition(b"\n")
        rest.insert(0, tail)
        if newline:
            break
    yield from _split(_chunks(file, fresh[0][0], fresh[-1][1]), rest)


def _batches(name: str, block: int, lines: Iterator[bytes], head: bool = False) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("value", pa.string())])

    def batch(first: int, values: list[str]) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.string()), pa.array([block] * n, pa.int64()),
             pa.array(range(first, first + n), pa.int64()), pa.array(values, pa.string())], schema=schema)

    first, held, values = 0, 0, []
    for raw in lines:
        line = raw.removesuffix(b"\r").decode()
        values.append(line)
        held += len(line)
        if head and _is_object(line):
            break
        if held >= _BATCH_BYTES:
            yield batch(first, values)
            first, held, values = first + len(values), 0, []
    if values:
        yield batch(first, values)


class _Run(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        self.path, self.start, self.end, self.size = path, start, end, size


class ArchiveReader(DataSourceReader):
    def __init__(self, parts: list[list], head: bool):
        self.parts = parts
        self.head = head

    def partitions(self) -> list[_Run]:
        return [_Run(*part) for part in self.parts]

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        files, inner, _ = open_filesystem(partition.path)
        with files.open_input_file(inner) as file:
            packed = partition.path.endswith(".zst")
            lines = lines_of_run(file, partition.start, partition.end, partition.size, packed)
            yield from _batches(partition.path, partition.start, lines, self.head)


class _Growth(InputPartition):
    def __init__(self, path: str, since: int, size: int):
        self.path, self.since, self.size = path, since, size


class ArchiveStreamReader(DataSourceStreamReader):
    """Follows the ``.zst`` files of a folder; offsets are their sizes."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {name: size for name, size in sizes(self.folder) if name.endswith(".zst")}

    def partitions(self, start: dict, end: dict) -> list[_Growth]:
        return [_Growth(name, start.get(name, 0), size) for name, size in sorted(end.items()) if size > start.get(name, 0)]

    def read(self, partition: _Growth) -> Iterator[pa.RecordBatch]:
        files, inner, _ = open_filesystem(partition.path)
        with files.open_input_file(inner) as file:
            lines = lines_ending_between(file, partition.since, partition.size)
            yield from _batches(partition.path, partition.since, lines)


class ArchiveSource(DataSource):
    """Batch: ``parts``, a JSON list of (file, start, end, size); ``head=true`` stops each file after its
    first JSON object. Stream: ``folder``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(json.loads(self.options["parts"]), self.options.get("head", "false") == "true")

    def streamReader(self, schema) -> ArchiveStreamReader:
        return ArchiveStreamReader(self.options["folder"])


def _parts(split_bytes: int):
    """The runs of each file, found where the task runs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size in zip(*(c.to_pylist() for c in batch.columns)):
                files, inner, _ = open_filesystem(name)
                with files.open_input_file(inner) as file:
                    try:
                        cut = runs(list(frames(file, size)), size, split_bytes)
                    except ValueError:  # reading it will say what is wrong
                        cut = [(0, size)]
                yield pa.RecordBatch.from_pylist([{"file": name, "start": a, "end": b, "size": size} for a, b in cut])

    return find


def parts(spark: SparkSession, paths: list[str], split_bytes: int = SPLIT_BYTES) -> list[list]:
    """(file, start, end, size) of every task that reading the files takes.

    Headers are followed by a job with a task for each file of more than ``split_bytes``; only ranges come back.
    """
    listed = [(name, size) for path in paths for name, size in sizes(path)]
    large = [x for x in listed if x[0].endswith(".zst") and x[1] > split_bytes]
    cut: dict[str, list[list]] = {name: [[name, 0, size, size]] for name, size in listed}
    if large:
        rows = spark.createDataFrame(large, "file string, size bigint").repartitionByRange(len(large), "file")
        found = rows.mapInArrow(_parts(split_bytes), "file string, start bigint, end bigint, size bigint")
        cut |= {name: [] for name, _ in large}
        for row in found.toLocalIterator():
            cut[row.file].append([row.file, row.start, row.end, row.size])
    return [part for name, _ in listed for part in cut[name]]


def scan(spark: SparkSession, paths: list[str], head: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of files or folders; with ``head`` only up to each file's first JSON object."""
    spark.dataSource.register(ArchiveSource)
    if head:
        tasks = [[name, 0, size, size] for path in paths for name, size in sizes(path)]
    else:
        tasks = parts(spark, paths, split_bytes)
    return spark.read.format(FORMAT).option("head", str(head).lower()).option("parts", json.dumps(tasks)).load()


def follow(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the lines of a folder's ``.zst`` files, also of files that grow."""
    spark.dataSource.register(ArchiveSource)
    return spark.readStream.format(FORMAT).option("folder", folder).load()
