"""Digests of byte ranges of files, and a tree over them.

A file is cut into ranges of equal size.  Each is read by a task of its own, in chunks, so
neither the size of a file nor that of a range is bounded by memory or by Spark's
limit of 2 GB for a binary value.  The digests of a file's ranges are the leaves of a Merkle
tree, whose levels are aggregates over small rows (``FAN_OUT`` children a node); its root
stands for the file's content.  Two lists of leaves tell which ranges of a file changed.

Defined results: an empty file is one empty range (Spark's listings leave such
files out); a root depends on content and range size
only, not on splits, tasks or the order of rows; a file that shrinks while it is
read is an error, as is one that is gone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.errors import StateError
from stratum.session import scratch_table

RANGE_BYTES = 64 << 20
CHUNK = 4 << 20
FAN_OUT = 64


def _open(uri: str):
    """The file behind ``_metadata.file_path``, a URI with percent signs."""
    from pyarrow import fs

    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parts.path))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(unquote(path))


def _digest(uri: str, start: int, size: int) -> str:
    found, left = hashlib.sha256(), size
    with _open(uri) as file:
        file.seek(start)
        while left:
            chunk = file.read(min(CHUNK, left))
            if not chunk:
                raise StateError(f"{uri} is shorter than it was when it was listed")
            found.update(chunk)
            left -= len(chunk)
    return found.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        file, at, start, size = (c.to_pylist() for c in batch.columns)
        for row in zip(file, at, start, size):
            leaf = _digest(row[0], row[2], row[3])
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip([*row, leaf], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                names=["source_file", "range", "start", "size", "digest"])


def range_digests(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``source_file, range, start, size, digest`` for every byte range of ``files``
    (source_file, file_size), a listing such as that of ``list_files``."""
    last = F.greatest(F.col("file_size") - 1, F.lit(0))
    ranges = files.select("source_file", "file_size", F.explode(F.sequence(F.lit(0), (last / range_bytes).cast("bigint"))).alias("range"))
    start = F.col("range") * F.lit(range_bytes).cast("bigint")
    ranges = ranges.select("source_file", F.col("range").cast("bigint").alias("range"), start.alias("start"),
                           F.least(F.lit(range_bytes).cast("bigint"), F.col("file_size") - start).alias("size"))
    # a listing is a few partitions; its ranges are dealt to all tasks
    return ranges.repartition("source_file", "range").mapInArrow(
        _digests, "source_file string, range bigint, start bigint, size bigint, digest string")


def root_digests(leaves: DataFrame) -> DataFrame:
    """``source_file, root``: the tree over each file's leaves.  A node is the SHA-256 of
    its children's digests in hex after the letter of its level's kind, so it is no leaf."""
    leaves = scratch_table(leaves.select("source_file", "range", "digest"))
    ends = leaves.groupBy("source_file").agg(F.max("range").alias("last"))
    most = ends.agg(F.max("last")).first()[0] or 0
    nodes = leaves.join(ends, "source_file").withColumn("done", F.lit(False))
    while True:
        # trees end at different levels: a finished one is passed on
        children = F.array_sort(F.collect_list(F.struct("range", "digest")))  # at most FAN_OUT
        above = [F.expr(f"{c} DIV {FAN_OUT}").alias(f"{c}_above") for c in ("range", "last")]
        nodes = nodes.groupBy("source_file", *above, "done").agg(children.alias("children"))
        digest = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        digest = F.when(F.col("done"), digest).otherwise(F.sha2(F.concat(F.lit("n"), digest), 256))
        nodes = nodes.select("source_file", F.col("range_above").alias("range"), F.col("last_above").alias("last"),
                             (F.col("last_above") == 0).alias("done"), digest.alias("digest"))
        most //= FAN_OUT
        if not most:
            return nodes.select("source_file", F.col("digest").alias("root"))


def changed_ranges(before: DataFrame, after: DataFrame, key: str = "source_file") -> DataFrame:
    """``key, range, change`` (changed, added, removed) for the ranges that two lists of
    leaves, of the same range size, do not have in common."""
    old = before.select(key, "range", F.col("digest").alias("old"))
    new = after.select(key, "range", F.col("digest").alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    both = old.join(new, [key, "range"], "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return both.select(key, "range", change.alias("change"))
