"""Keys across the runs of a stream, kept in a state store.

:class:`KeyedStream` adds to a file stream what a table-wide key rule needs without
reading the table again.  Rows are judged, never dropped:

* ``bad``: a row rule fails, a key column is NULL or the event time is NULL;
* ``late``: the event time is before the watermark, i.e. more than ``delay`` behind the
  greatest event time of all earlier micro-batches;
* ``duplicate``: the key was seen before and the event time is at most ``ttl`` behind its
  last sighting, or before it; sightings are rows that are neither bad nor late, in
  the order of micro-batches, event times and ``tie_break`` columns;
* ``ok``: all others.  Only these are loaded; the others go to a quarantine table with
  their verdict and the names of the rules they fail.

The rows themselves stay in the JVM.  A second branch of the same stream sends keys and
event times alone through ``transformWithState``: per key one number in the state store
(RocksDB), the last sighting, and one row out for each micro-batch.  Keys are dealt by
hash over ``BLOCKS`` blocks, and the state of a block is read and written at once: calls
to the store are bounded by the blocks, not the keys.  A key is forgotten once the
watermark has passed its last sighting by ``ttl``, when its block is next met or at
the block's event-time timer: from then on no row that is not late could be its
duplicate, so the store is bounded by the keys of that time span and results are those
of an unbounded memory.

Within a micro-batch, duplicates are found by aggregation, not by sorting a key's rows:
event times are cut into buckets of ``ttl``, and in a bucket only the first row of a key
can be new.  A hot key is a row per task and bucket in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stratum.operators.rules import Rule, row_failures, row_fingerprint

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SIGHTINGS = "_key string, _known boolean, _prior bigint, _watermark bigint"
#: Keys are dealt by hash over so many blocks; a stream's checkpoint is bound to the number.
BLOCKS = 2048
#: Columns that the judged rows have beside the payload.
MARKS = ["_kind", "_key", "_ms", "_failed", "_known", "_prior", "_watermark"]


class LastSightings(StatefulProcessor):
    """A block of keys: what was known of each before this micro-batch; then its greatest
    event time that is not late is remembered, until ``ttl`` after it.

    The state of a block is its keys and their times, as bytes, and when its timer wakes it."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "keys binary, ms binary, wakes bigint")

    def held(self) -> tuple:
        import numpy as np

        found = self.last.get() or (b"", b"", None)
        return np.frombuffer(bytes(found[0]), "S32"), np.frombuffer(bytes(found[1]), "int64"), found[2]

    def hold(self, keys, ms, wakes: int | None, watermark: int) -> None:
        """Keep the keys that are not to be forgotten yet, with a timer for the first of them."""
        kept = ms + self.ttl + 1 > watermark
        keys, ms = keys[kept], ms[kept]
        if wakes is None and len(ms):
            wakes = int(ms.min()) + self.ttl + 1
            self.handle.registerTimer(wakes)
        if wakes is None:
            self.last.clear()
        else:
            self.last.update((keys.tobytes(), ms.tobytes(), wakes))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        watermark = timerValues.getCurrentWatermarkInMs()
        never = np.iinfo("int64").min
        tops = []
        for frame in rows:
            ms = frame["ms"].astype("int64")
            tops.append(ms.where(ms >= watermark, never).groupby(frame["k"]).max())
        top = pd.concat(tops).groupby(level=0).max()
        keys, before, wakes = self.held()
        met, newest = top.index.to_numpy().astype("S32"), top.to_numpy()
        at = pd.Index(keys).get_indexer(met)
        known = at >= 0
        prior = np.full(len(met), never)
        prior[known] = before[at[known]]
        newest = np.maximum(prior, newest)
        after = before.copy()
        after[at[known]] = newest[known]
        added = ~known & (newest > never)
        self.hold(np.concatenate([keys, met[added]]), np.concatenate([after, newest[added]]), wakes, watermark)
        yield pd.DataFrame({
            "_key": top.index, "_known": known, "_prior": np.where(known, prior, 0), "_watermark": watermark,
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        keys, ms, _ = self.held()
        self.hold(keys, ms, None, timerValues.getCurrentWatermarkInMs())
        yield from ()

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class KeyedStream:
    """The keys of a stream and how long they are remembered (see the module docstring).
    ``delay`` is an interval such as ``10 minutes``, ``ttl`` a number of milliseconds."""

    keys: tuple[str, ...]
    event_time: str
    delay: str
    ttl: int
    tie_break: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    def required(self) -> list[Rule]:
        needed = [Rule("NOT_NULL", c) for c in dict.fromkeys([*self.keys, self.event_time])]
        return needed + [r for r in self.rules if r not in needed]

    def attach(self, stream: DataFrame) -> DataFrame:
        """The stream's rows (kind ``row``) with key digest, event time and failed rules, and
        one row (kind ``key``) for each key in a micro-batch, with what was known of it."""
        marks = [
            F.hex(row_fingerprint(stream, list(self.keys))).alias("_key"),
            F.unix_millis(F.col(self.event_time).cast("timestamp")).alias("_ms"),
            row_failures(stream, self.required()).alias("_failed"),
        ]
        rows = stream.select(F.lit("row").alias("_kind"), "*", *marks)
        seen = stream.withWatermark(self.event_time, self.delay).select(*marks)
        block = F.pmod(F.xxhash64("_key"), F.lit(BLOCKS)).alias("block")
        seen = seen.filter(F.size("_failed") == 0).select(block, F.col("_key").alias("k"), F.col("_ms").alias("ms"))
        known = seen.groupBy("block").transformWithStateInPandas(
            LastSightings(self.ttl), SIGHTINGS, "append", "EventTime")
        return rows.unionByName(known.withColumn("_kind", F.lit("key")), allowMissingColumns=True)

    def judge(self, staged: DataFrame) -> DataFrame:
        """The staged rows of kind ``row`` with ``_verdict``.  ``staged`` has ``batch_id``,
        the micro-batch, and ``_row``, unique within it."""
        rows = staged.filter(F.col("_kind") == "row")
        known = staged.filter(F.col("_kind") == "key").select(
            "batch_id", "_key", *[F.col(c).alias(f"k{c}") for c in ("_known", "_prior", "_watermark")])
        slim = rows.filter(F.size("_failed") == 0).select(
            "batch_id", "_row", "_key", "_ms",
            F.struct("_ms", *self.tie_break, row_fingerprint(rows, self.payload(rows)).alias("__f"), "_row").alias("__at"))
        slim = slim.join(known, ["batch_id", "_key"])
        late = (F.col("k_watermark") > 0) & (F.col("_ms") < F.col("k_watermark"))
        bucket = F.floor(F.col("_ms") / F.lit(max(1, self.ttl))).alias("__bucket")
        first = (
            slim.filter(~late).groupBy("batch_id", "_key", bucket)
            .agg(F.min("__at").alias("__first"), F.max("_ms").alias("__top"),
                 F.min(F.when(F.col("k_known"), F.col("k_prior"))).alias("__prior"))
        )
        before = F.lag("__top").over(Window.partitionBy("batch_id", "_key").orderBy("__bucket"))
        reference = F.greatest("__prior", before)
        new = first.withColumn("__ref", reference).filter(
            F.col("__ref").isNull() | (F.col("__first._ms") > F.col("__ref") + F.lit(self.ttl)))
        marks = new.select("batch_id", F.col("__first._row").alias("_row"), F.lit("ok").alias("__v")).unionByName(
            slim.filter(late).select("batch_id", "_row", F.lit("late").alias("__v")))
        verdict = F.when(F.size("_failed") > 0, F.lit("bad")).otherwise(F.coalesce("__v", F.lit("duplicate")))
        return rows.join(marks, ["batch_id", "_row"], "left").withColumn("_verdict", verdict).drop("__v")

    @staticmethod
    def payload(rows: DataFrame) -> list[str]:
        return [c for c in rows.columns if c not in (*MARKS, "batch_id", "_row")]


class rocksdb_state:
    """Within the block, streams that start keep their state in RocksDB."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *exc):
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)
