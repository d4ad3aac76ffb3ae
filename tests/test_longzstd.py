"""Long-window zstd: frames, splits, files that grow."""

import random

import pytest
import zstandard

from mentionlake.sources import longzstd
from mentionlake.streaming import jobs


def packed(data, size=True, checksum=False):
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=28, write_checksum=checksum, write_content_size=size)
    if size:
        return zstandard.ZstdCompressor(compression_params=params).compress(data)
    codec = zstandard.ZstdCompressor(compression_params=params).compressobj()
    return codec.compress(data) + codec.flush()


def text(seed, n=300):
    rng = random.Random(seed)
    return [("é" * rng.randrange(40) + str(i)) if rng.random() < 0.9 else "" for i in range(n)] + ["x" * 300_000, "last"]


def cut(data, pieces, seed):
    rng = random.Random(seed)
    ends = sorted(rng.sample(range(1, len(data)), pieces - 1))
    return [data[a:b] for a, b in zip([0, *ends], [*ends, len(data)])]


def test_frames_are_found_by_their_headers(tmp_path):
    skippable = (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"index"
    kinds = [packed(b"a" * 1_000_000, False), packed(b"", True), skippable, packed(random.Random(1).randbytes(400_000), True, True), packed(b"tiny")]
    path = tmp_path / "f.zst"
    path.write_bytes(b"".join(kinds))
    with open(path, "rb") as file:
        found = list(longzstd.frames(file, path.stat().st_size))
        assert [b - a for a, b in found] == [len(k) for k in kinds]
        for size in range(found[3][0], found[3][1], 50_000):  # the fourth frame is not complete
            assert list(longzstd.frames(file, size)) == found[:3]
    path.write_bytes(b"{}\n" * 9)
    with open(path, "rb") as file, pytest.raises(ValueError):
        list(longzstd.frames(file, 27))


@pytest.mark.parametrize("ending", ["\n", "", "\r\n"])
def test_split_reads_equal_the_whole(spark, tmp_path, ending):
    """Frames that begin and end anywhere, also inside characters and exactly at line ends."""
    for seed in range(3):
        data = ("\n".join(text(seed, 25)) + ending).encode()
        pieces = cut(data, 12, seed) if seed else data.splitlines(keepends=True)
        path = tmp_path / f"{seed}.zst"
        path.write_bytes(b"".join(packed(p, i % 2) for i, p in enumerate(pieces)))
    want = {}
    for seed in range(3):
        lines = ("\n".join(text(seed, 25)) + ending).split("\n")
        want[seed] = [x.removesuffix("\r") for x in (lines[:-1] if lines[-1] == "" else lines)]
    for split in (1, 1 << 40):
        df = longzstd.scan(spark, [str(tmp_path)], split_bytes=split)
        got = {}
        for r in df.orderBy("file", "block", "line").collect():
            got.setdefault(int(r.file[-5]), []).append(r.value)
        assert got == want
        tasks = df.rdd.getNumPartitions()
        assert tasks == 3 if split > 1 << 30 else tasks > 30


def test_stream_follows_growing_files(spark, tmp_path):
    folder, run = tmp_path / "in", str(tmp_path / "run")
    folder.mkdir()
    lines = {"a": text(1, 50), "b": text(2, 50)}
    frames = {k: [packed(p) for p in cut(("\n".join(v) + "\n").encode(), 6, 4)] for k, v in lines.items()}
    steps = [{"a": b"".join(frames["a"][:2]) + frames["a"][2][:9]},  # a frame is half written
             {"a": b"".join(frames["a"][:4]), "b": b"".join(frames["b"])}, {}, {"a": b"".join(frames["a"])}]
    counts = []
    for step in steps:
        for name, data in step.items():
            (folder / f"{name}.jsonl.zst").write_bytes(data)
        stream = longzstd.follow(spark, str(folder))
        out = jobs.read_output(stream, jobs.run_available(stream, "follow", run)).collect()
        counts.append(len(out))
    got = {k: sorted(r.value for r in out if r.file.endswith(f"{k}.jsonl.zst")) for k in lines}
    assert got == {k: sorted(v) for k, v in lines.items()}
    assert 0 < counts[0] < counts[1] == counts[2] < counts[3] == 104
