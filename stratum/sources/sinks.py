"""Sinks: path-based table writes, catalog registration, append-only logs."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratum.errors import ConfigurationError, StateError

WRITE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: str | Sequence[str] | None = None,
                fmt: str = "parquet", rebalance: bool = False) -> str:
    """Write ``df`` to ``path`` (full load = overwrite, incremental = append),
    Hive-style partitioned by ``partition_by``.  Returns the path.

    ``rebalance`` shuffles rows by the partition columns first (the
    ``REBALANCE`` hint): AQE sizes the output files to the advisory partition
    size and splits a hot partition value over several tasks, instead of every
    input task writing a small file into every partition folder.
    """
    if mode not in WRITE_MODES:
        raise ConfigurationError(f"Unsupported write mode: {mode}")
    cols = []
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        if rebalance:
            df = df.hint("rebalance", *cols)
    w = df.write.mode(mode).format(fmt)
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)
    return path


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> str:
    """Register an external table over ``path``, or bring a registered one up to
    date.

    The partitions of a Hive-style layout are taken from the folder names on
    every call, so partitions appended after an earlier registration are seen.
    Returns the table name.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def write_managed(df: DataFrame, name: str, mode: str = "overwrite",
                  partition_by: str | None = None) -> str:
    """Managed catalog table with a metadata-chosen write mode."""
    if mode not in WRITE_MODES:
        raise ConfigurationError(f"Unsupported write mode: {mode}")
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    w = df.write.mode(mode)
    (w.partitionBy(partition_by) if partition_by else w).saveAsTable(name)
    return name


BATCH_NAME = re.compile(r"^\d{13}-[0-9a-f]{32}$")
MANIFEST = "_replaces"


def append_log(df: DataFrame, path: str, one_file: bool = False,
               replaces: Sequence[str] = ()) -> str:
    """Append rows to an append-only log folder; returns the batch folder.

    Every call writes its own sub-folder ``<epoch-ms>-<uuid>``: concurrent
    writers (parallel entity runs, a stream and a batch job) never share a
    commit directory.  The batch is written under a hidden name and renamed when
    it is complete, so it becomes visible all at once.  Read the log with
    :func:`read_log`.  ``one_file`` writes the rows from one task (a few literal
    rows only).  ``replaces`` names batches of the same folder that this one
    stands for; readers leave them out from the moment this one is visible.
    """
    spark = df.sparkSession
    name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex}"
    root = path.rstrip("/")
    hidden, batch = f"{root}/_new-{name}", f"{root}/{name}"
    (df.coalesce(1) if one_file else df).write.mode("errorifexists").parquet(hidden)
    fs, source = _fs(spark, hidden)
    if replaces:
        out = fs.create(_fs(spark, f"{hidden}/{MANIFEST}")[1], False)
        out.write(bytearray("\n".join(replaces).encode()))
        out.close()
    if not fs.rename(source, _fs(spark, batch)[1]):
        raise StateError(f"Failed to publish the log batch '{batch}'")
    return batch


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def log_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the visible batches of a log and of its sub-folders, without
    those that a compacted batch replaces (metadata calls only)."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found: dict[str, str] = {}
    replaced: set[str] = set()
    below: list[str] = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isDirectory() or name.startswith(("_", ".")):
            continue
        folder = f"{path.rstrip('/')}/{name}"
        if not BATCH_NAME.match(name):
            below += log_batches(spark, folder)
            continue
        found[name] = folder
        manifest = _fs(spark, f"{folder}/{MANIFEST}")[1]
        if fs.exists(manifest):
            stream = fs.open(manifest)
            replaced.update(bytes(stream.readAllBytes()).decode().split("\n"))
            stream.close()
    return [f for n, f in sorted(found.items()) if n not in replaced] + below


def read_log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """All batches of an append-only log (empty frame when nothing was written)."""
    batches = log_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(*batches)


def compact_log(spark: SparkSession, path: str, ddl: str) -> int:
    """Rewrite the batches of a log folder present now into one, then drop them.

    The new batch lists those it replaces and readers leave them out, so no row
    is seen twice, neither during the swap nor after a crash before the old
    batches are gone; a later compaction removes what a crash left.  Returns the
    number of batches compacted.
    """
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return 0
    here = [s.getPath().getName() for s in fs.listStatus(root)
            if s.isDirectory() and BATCH_NAME.match(s.getPath().getName())]
    live = [b for b in log_batches(spark, path) if b.rsplit("/", 1)[1] in here]
    if len(live) >= 2:
        append_log(spark.read.schema(ddl).parquet(*live).hint("rebalance"), path, replaces=here)
    elif len(here) == len(live):
        return 0
    for name in here:
        if len(live) >= 2 or f"{path.rstrip('/')}/{name}" not in live:
            remove_path(spark, f"{path.rstrip('/')}/{name}")
    return len(live) if len(live) >= 2 else 0


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it doesn't exist."""
    fs, root = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder within its file system."""
    fs, new = _fs(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(_fs(spark, source)[1], new):
        raise StateError(f"Failed to move '{source}' to '{target}'")


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """A marker file, written under a hidden name and renamed, so that it is whole."""
    hidden = f"{path}.{uuid.uuid4().hex}"
    out = _fs(spark, path)[0].create(_fs(spark, hidden)[1], False)
    out.write(bytearray(text.encode()))
    out.close()
    rename_path(spark, hidden, path)


def read_small_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (any Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (e.g. the folder of a run that failed)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).delete(p, True)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Catalog table or path-based table existence."""
    if "/" in name_or_path or ":" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def write_json_arrays(df: DataFrame, path: str, files: int | None = None, file_rows: int = 0,
                      compression: str = "none") -> str:
    """Write ``df`` as JSON-array files (one array document per file, one record a
    line): at most ``files`` of them, or as many as it takes with at most ``file_rows``
    rows in each, for which rows are not shuffled.  Rows are streamed: the brackets and
    commas are put around them as they pass, and no array is ever built in memory."""
    from pyspark.sql import functions as F

    def array_lines(batches):
        import pyarrow as pa

        held, at = None, 0
        for batch in batches:
            lines = []
            for value in batch.column(0).to_pylist():
                first = at == 0 or file_rows and at % file_rows == 0
                if held is not None:
                    lines.append(held + ("]" if first else ","))
                held, at = "[" + value if first else value, at + 1
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + "]"])], names=["value"])

    dealt = df if files is None else df.repartition(files)
    rows = dealt.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(array_lines, "value string")
    # a task's files have file_rows lines each: one array in each
    rows.write.mode("overwrite").option("maxRecordsPerFile", file_rows).option("compression", compression).text(path)
    return path


def write_text_files(df: DataFrame, path: str, file_key: str, order: str, value: str) -> str:
    """Text files of whole values, one file per distinct ``file_key`` (folder
    ``<file_key>=<k>``), its values in the order of ``order``."""
    rows = df.select(file_key, order, value).repartition(file_key).sortWithinPartitions(file_key, order)
    rows.drop(order).write.mode("overwrite").partitionBy(file_key).text(path)
    return path


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small DataFrame of literal rows built on the JVM side (no Python data
    serialisation): ``range(1)`` + ``inline(array(struct(lit ...)))``."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
