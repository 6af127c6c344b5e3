"""Session helpers: building a local session for tests/bench and locating the
shared folder used for checkpoints, scratch tables and control logs.

On a cluster the session is built by the platform; library code only reads
settings from it.  ``spark.checkpoint.dir`` must then name a folder every
executor can reach (HDFS, S3, ABFS, ...).  A local folder is only created when
the setting is missing *and* the master is local, i.e. in tests.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "stratum",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the settings the library is tuned for.

    AQE stays on (runtime coalescing, skew-join splitting, join re-planning);
    the UI is off because no port may be opened in tests.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    When the setting is absent on a local master (tests, bench) a fresh temp
    folder is created and installed as the checkpoint dir; on a real cluster an
    absent setting is an error, because a machine-local folder would break as
    soon as a task runs on another host.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(_CKPT_KEY, None) or spark.conf.get(_CKPT_KEY, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            f"{_CKPT_KEY} is not set; point it at a folder shared by all executors"
        )
    local = tempfile.mkdtemp(prefix="stratum-ckpt-")
    spark.conf.set(_CKPT_KEY, local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique sub-folder of the shared root (never reused)."""
    base = shared_root(spark)
    return "/".join([base, "stratum-scratch", uuid.uuid4().hex, *parts])


def drop_shuffles(spark: SparkSession) -> None:
    """Ask for a garbage collection, in which Spark finds that queries are gone and
    deletes their shuffle files; by itself the driver may wait half an hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_table(df):
    """``df`` written to the shared folder and read back: lineage ends there (it
    survives executor loss), and the folder goes when the driver's JVM ends.

    The shuffle files of the query that made it are of no more use.  Spark deletes
    them when the driver's garbage collector finds the query gone, by itself only
    every half hour; the collection asked for here lets it do so now."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)
