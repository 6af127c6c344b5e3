"""Advisory per-entity lock, so two runs of one entity never overlap.

The lock is a file created with ``overwrite=false`` under the lakehouse
control folder (an atomic create on HDFS; create-if-absent on other file
systems).  Its holder renews it; one that was not renewed for ``ttl_seconds`` was
left behind by a crashed driver and is taken over.  Driver-side metadata
operations only.
"""

from __future__ import annotations

import threading
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from stratum.errors import StratumError


class EntityLockedError(StratumError):
    """Another run of the same entity holds the lock."""


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _owner(fs, p) -> str | None:
    """What the lock file says, or None when there is none."""
    try:
        stream = fs.open(p)
        text = bytes(stream.readAllBytes()).decode("utf-8")
        stream.close()
        return text
    except Exception:  # noqa: BLE001 - FileNotFoundException via Py4J
        return None


def _write(fs, p, owner: str, overwrite: bool) -> None:
    out = fs.create(p, overwrite)
    out.write(bytearray(owner.encode("utf-8")))
    out.close()


@contextmanager
def entity_lock(spark: SparkSession, lock_path: str, owner: str, ttl_seconds: float = 600,
                beat_seconds: float | None = None):
    """Hold the lock while the block runs.

    A heartbeat thread rewrites the file every ``beat_seconds`` (a fifth of the
    time to live by default), so only a lock whose driver died grows older than
    ``ttl_seconds`` and is taken over, however long a run takes.  The file names its owner:
    a run that lost its lock neither renews nor removes another one's.
    """
    fs, p = _fs_path(spark, lock_path)
    token = f"{owner} {uuid.uuid4().hex}"
    for attempt in range(2):
        try:
            _write(fs, p, token, False)
            break
        except Exception as exc:  # noqa: BLE001 - FileAlreadyExistsException via Py4J
            if attempt == 0 and fs.exists(p):
                age = time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0
                if age > ttl_seconds:
                    fs.delete(p, False)  # stale: its run died without releasing it
                    continue
            raise EntityLockedError(f"another run holds {lock_path}") from exc
    done = threading.Event()

    def beat():
        while not done.wait(beat_seconds or ttl_seconds / 5):
            if _owner(fs, p) != token:
                return
            _write(fs, p, token, True)

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
        if _owner(fs, p) == token:
            fs.delete(p, False)
