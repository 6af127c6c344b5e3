"""Balanced sharding of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group, and groups go to shards so that the shards'
bytes are near equal (law ``bytes``).  Differencing starts with one partial
partition for each item (the item in one part, the other parts empty) and
repeatedly replaces the two with the largest spread by their combination, the
largest part of one on the smallest of the other, until one is left.

No task sees all groups.  While there are more than ``top_rows`` items, those of
at least ``total / (shards * pieces)`` bytes, of which there are at most
``shards * pieces``, go up as they are; the others are dealt by hash into blocks
of about ``block_rows``, and differencing cuts each block into bundles of about
that many bytes, which are the items of the next level.  The last level holds at
most ``top_rows`` items and is differenced into the shards.

Defined results: a null text has size 1, CRC 0 and is a group of its own, apart
from empty texts; repeated rows are rows like others; null doc_ids are kept; an
empty table gives an empty result.  Input columns named like result columns are
replaced.  Slots number a shard's rows from 0 without gaps, in no set order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from stratum.llm.common import fresh_name, read_table, small_side, spool, without


def differencing(sizes: list[int], parts: int) -> list[int]:
    """The part of each item, by Karmarkar-Karp differencing."""
    if parts == 1 or not sizes:
        return [0] * len(sizes)
    empty = (0,) * (parts - 1)
    heap = [(-s, i, (s, *empty), (i, *(None,) * (parts - 1))) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        both = sorted(
            ((x + y, p if q is None else q if p is None else (p, q)) for x, y, p, q in zip(a, reversed(b), held_a, reversed(held_b))),
            key=lambda z: -z[0],
        )
        sums = tuple(x for x, _ in both)
        heapq.heappush(heap, (sums[-1] - sums[0], tie, sums, tuple(h for _, h in both)))
        tie += 1
    part = [0] * len(sizes)
    for k, held in enumerate(heap[0][3]):
        stack = [held]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack.extend(x)
            elif x is not None:
                part[x] = k
    return part


def _bundle_blocks(items: DataFrame, blocks: int, unit: float, level: int) -> DataFrame:
    """(key, bundle, bytes) of the small items: each block cut into bundles of about ``unit`` bytes."""

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        parts = max(1, int(frame["bytes"].sum() // unit))
        block = int(frame["block"].iloc[0])
        part = differencing(frame["bytes"].tolist(), parts)
        return pd.DataFrame({"key": frame["key"], "bundle": [b"%d.%d.%d" % (level, block, p) for p in part], "bytes": frame["bytes"]})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(cut, "key binary, bundle binary, bytes bigint")


def assign_groups(
    groups: DataFrame, shards: int, pieces: int = 128, block_rows: int = 2048, top_rows: int = 16_384
) -> DataFrame:
    """(key, shard) for groups given as (key binary, bytes bigint)."""
    spark = groups.sparkSession
    items, maps = spool(groups), []
    n, total = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    while n > top_rows:
        unit = max(1, total / (shards * pieces))
        big = items.where(F.col("bytes") >= unit).select("key", F.col("key").alias("bundle"), "bytes")
        small = _bundle_blocks(items.where(F.col("bytes") < unit), -(-n // block_rows), unit, len(maps))
        mapping = spool(small.union(big))
        maps.append(mapping.select("key", "bundle"))
        items = spool(mapping.groupBy(F.col("bundle").alias("key")).agg(F.sum("bytes").alias("bytes")))
        n = items.count()
    top = sorted((bytes(r["key"]), r["bytes"]) for r in items.collect())  # at most top_rows
    part = differencing([s for _, s in top], shards)
    placed = spark.createDataFrame([(k, p) for (k, _), p in zip(top, part)], "key binary, shard int")
    placed = F.broadcast(placed)
    for mapping in reversed(maps):
        placed = mapping.join(placed.withColumnRenamed("key", "bundle"), "bundle").select("key", "shard")
    return placed


def text_key(text: str) -> F.Column:
    """128-bit digest of the text; a null text has a shorter key of its own."""
    return F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b"null"))


def row_bytes(text: str) -> F.Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("bigint")


def number_slots(placed: DataFrame, shard: str, slot: str) -> DataFrame:
    """``placed`` with ``slot``: rows count up within each task and shard, the
    result is written, and each task's counts give the others their offsets."""
    part, place, offset = (fresh_name(x, placed.columns) for x in ("part", "place", "offset"))
    schema = StructType(list(placed.schema.fields)).add(part, IntegerType()).add(place, LongType())
    names = schema.names
    at = placed.columns.index(shard)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            shards = batch.column(at).to_numpy(zero_copy_only=False)
            places = np.zeros(len(shards), np.int64)
            for s in np.unique(shards):
                here = np.flatnonzero(shards == s)
                places[here] = seen.get(s, 0) + np.arange(len(here))
                seen[s] = seen.get(s, 0) + len(here)
            more = [pa.array(np.full(len(shards), task, np.int32)), pa.array(places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)

    numbered = spool(placed.mapInArrow(number, schema))
    counts = numbered.groupBy(shard, part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offset_rows = counts.select(shard, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    joined = numbered.join(small_side(spool(offset_rows)), [shard, part])
    return joined.select(*[F.col(f"`{c}`") for c in placed.columns], (F.col(place) + F.col(offset)).alias(slot))


def shard_rows(docs: DataFrame, shards: int = 8, **params) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``."""
    docs = without(docs, "shard", "slot")
    key = fresh_name("key", docs.columns)
    groups = docs.select(text_key("text").alias("key"), row_bytes("text").alias("n")).groupBy("key").agg(F.sum("n").alias("bytes"))
    placed = assign_groups(groups, shards, **params).withColumnRenamed("key", key)
    joined = docs.withColumn(key, text_key("text")).join(placed, key).drop(key)
    return number_slots(joined.select(*[F.col(f"`{c}`") for c in docs.columns], "shard"), "shard", "slot")


def op1_shard_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of ``shard_rows``: texts are read once and only their keys move."""
    docs = read_table(spark, sf_dir, "documents")
    rows = spool(docs.select(
        "doc_id", row_bytes("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), text_key("text").alias("key"),
    ))
    placed = assign_groups(rows.groupBy("key").agg(F.sum("size").alias("bytes")), shards=8)
    numbered = number_slots(rows.join(placed, "key").drop("key"), "shard", "slot")
    return numbered.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
