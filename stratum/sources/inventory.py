"""File inventory: one row per file under a path, computed by executors.

``source_file`` is ``_metadata.file_path`` (percent-encoded URI), the same
value the data readers expose, so inventory, ingestion state and the lineage
column of loaded rows always agree — also for paths with spaces.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.errors import StateError
from stratum.sources.ranges import range_digests, root_digests

#: Files above this size are hashed by ranges (``ranges.py``): Spark's binary files end at 2 GB.
WHOLE_BYTES = 1 << 30
#: At most so many paths become one predicate of a scan.
LISTED_FILES = 4096

INVENTORY_DDL = (
    "source_file string, last_modified_time timestamp, file_size bigint, content_hash string"
)


def only_files(df: DataFrame, files: DataFrame | Iterable[str], file_col: str) -> DataFrame:
    """Rows of ``df``, a file scan whose ``file_col`` is ``_metadata.file_path``,
    that come from the given files.

    ``files`` is a DataFrame with a ``source_file`` column, or an iterable.  Paths become
    ``IN`` predicates, which Spark applies at listing, so that other files are never
    opened: up to ``LISTED_FILES`` of them in one scan, more in a union of scans of as
    many each.  The paths are held by the driver, as the listing they are taken from
    is, in the scan of the same folder.
    """
    if isinstance(files, DataFrame):
        files = (r[0] for r in files.select("source_file").distinct().toLocalIterator())
    wanted = sorted({f for f in files if f is not None})
    scans = [df.filter(F.col(file_col).isin(wanted[at:at + LISTED_FILES]))
             for at in range(0, max(1, len(wanted)), LISTED_FILES)]
    found = scans[0]
    for scan in scans[1:]:
        found = found.unionAll(scan)
    return found


def file_inventory(spark: SparkSession, source_path: str, hash_content: bool = True,
                   glob: str | None = None,
                   files: DataFrame | Iterable[str] | None = None) -> DataFrame:
    """``source_file, last_modified_time, file_size, content_hash`` per file.

    With ``hash_content`` every byte is read (in parallel, one task per file
    split group) and hashed with md5 on the executors; without it the
    ``content`` column is pruned, so only the listing is done and
    ``content_hash`` is NULL.  A hashed file is held in memory by its task; the hash of
    one above ``WHOLE_BYTES`` is the root digest of its byte ranges instead, which are
    read by many tasks.
    ``files`` restricts the inventory to the given ``source_file`` values.
    Names of files and folders below ``source_path`` are taken as they are, so
    glob characters in them are harmless.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        df = r.load(source_path)
    except Exception as exc:  # noqa: BLE001 - missing or unreadable source folder
        raise StateError(f"Failed to read source file metadata from '{source_path}': {exc}") from exc
    df = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    if files is not None:
        df = only_files(df, files, "source_file")
    large = None
    if hash_content and (df.agg(F.max("length")).first()[0] or 0) > WHOLE_BYTES:
        large = df.filter(F.col("length") > WHOLE_BYTES).select(
            "source_file", F.col("modificationTime").alias("last_modified_time"), F.col("length").alias("file_size"))
        df = df.filter(F.col("length") <= WHOLE_BYTES)
    found = df.select(
        "source_file",
        F.col("modificationTime").alias("last_modified_time"),
        F.col("length").alias("file_size"),
        (F.md5(F.col("content")) if hash_content else F.lit(None).cast("string")).alias("content_hash"),
    )
    if large is None:
        return found
    roots = root_digests(range_digests(large)).withColumnRenamed("root", "content_hash")
    return found.unionByName(large.join(roots, "source_file").select(*found.columns))


def list_files(spark: SparkSession, source_path: str) -> DataFrame:
    """Directory listing without reading contents."""
    return file_inventory(spark, source_path, hash_content=False).drop("content_hash")
