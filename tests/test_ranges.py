"""Byte ranges of files against plain hashes."""

import hashlib
import random

import pytest

from stratum.sources import inventory
from stratum.sources.inventory import file_inventory, list_files
from stratum.sources.ranges import FAN_OUT, changed_ranges, range_digests, root_digests


def sha(data):
    return hashlib.sha256(data).hexdigest()


def leaves_of(data, size):
    return [sha(data[k:k + size]) for k in range(0, max(1, len(data)), size)]


def root_of(leaves):
    while True:
        leaves = [sha(("n" + "".join(leaves[k:k + FAN_OUT])).encode()) for k in range(0, len(leaves), FAN_OUT)]
        if len(leaves) == 1:
            return leaves[0]


def files(folder):
    rnd = random.Random(2)
    (folder / "empty.bin").write_bytes(b"")  # not listed by Spark
    found = {"a b%.bin": rnd.randbytes(100_001), "one.bin": b"x" * 64, "two.bin": rnd.randbytes(65)}
    for name, data in found.items():
        (folder / name).write_bytes(data)
    return found


def named(rows):
    return {(r.source_file.rsplit("/", 1)[1].replace("%20", " ").replace("%25", "%"), r.range): r for r in rows}


def test_leaves_and_roots(spark, tmp_path):
    data = files(tmp_path)
    leaves = range_digests(list_files(spark, str(tmp_path)), 64)
    got = {k: (r.start, r.size, r.digest) for k, r in named(leaves.collect()).items()}
    assert got == {(n, k): (64 * k, len(d[64 * k:64 * k + 64]), leaf) for n, d in data.items() for k, leaf in enumerate(leaves_of(d, 64))}
    roots = {r.source_file.rsplit("/", 1)[1].replace("%20", " ").replace("%25", "%"): r.root for r in root_digests(leaves).collect()}
    assert roots == {n: root_of(leaves_of(d, 64)) for n, d in data.items()}


def test_a_changed_range_is_named(spark, tmp_path):
    data = files(tmp_path)
    before = range_digests(list_files(spark, str(tmp_path)), 1000)
    before = spark.createDataFrame(before.collect(), before.schema)
    changed = bytearray(data["a b%.bin"])
    changed[42_424] ^= 1
    (tmp_path / "a b%.bin").write_bytes(bytes(changed))
    (tmp_path / "one.bin").write_bytes(b"x" * 1001)
    (tmp_path / "two.bin").unlink()
    after = range_digests(list_files(spark, str(tmp_path)), 1000)
    got = {k: r.change for k, r in named(changed_ranges(before, after).collect()).items()}
    assert got == {("a b%.bin", 42): "changed", ("one.bin", 0): "changed", ("one.bin", 1): "added", ("two.bin", 0): "removed"}


def test_large_files_have_root_hashes(spark, tmp_path, monkeypatch):
    data = files(tmp_path)
    monkeypatch.setattr(inventory, "WHOLE_BYTES", 64)
    got = {r.file_size: r.content_hash for r in file_inventory(spark, str(tmp_path)).collect()}
    size = 64 << 20
    assert got == {len(d): hashlib.md5(d).hexdigest() if len(d) <= 64 else root_of(leaves_of(d, size)) for d in data.values()}


def test_a_file_above_2_gb(spark, tmp_path):
    path = tmp_path / "sparse.bin"
    with open(path, "wb") as file:
        file.truncate((2 << 30) + 10)  # a hole: no disk is used
    rows = file_inventory(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0].file_size == (2 << 30) + 10 and len(rows[0].content_hash) == 64


def test_an_empty_file_is_one_range(spark, tmp_path):
    (tmp_path / "empty.bin").write_bytes(b"")
    listed = spark.createDataFrame([(f"file:{tmp_path}/empty.bin", 0)], "source_file string, file_size bigint")
    leaves = range_digests(listed)
    assert [(r.range, r.size, r.digest) for r in leaves.collect()] == [(0, 0, sha(b""))]
    assert [r.root for r in root_digests(leaves).collect()] == [root_of([sha(b"")])]
    assert range_digests(listed.limit(0)).count() == 0


def test_a_file_that_shrinks(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 100)
    listed = list_files(spark, str(tmp_path)).cache()
    listed.count()
    (tmp_path / "a.bin").write_bytes(b"x")
    with pytest.raises(Exception, match="shorter"):
        range_digests(listed, 10).collect()
