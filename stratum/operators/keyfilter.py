"""Keys that repeat between loads, without reading the table again.

Each load leaves a split-block Bloom filter of its keys: 256-bit blocks of eight words, in
which a key sets one bit a word in one block.  A filter is a table (block, w0..w7), made by
one hash aggregate (``bit_or``) and tested by one join, so it is built, kept and probed
as any other data, at any size.  About ``KEYS_PER_BLOCK`` keys a block cost 1.6 bytes a
key, and let about one foreign key in two hundred pass.

The filters say which new keys may be in which earlier loads; only those pairs are looked
up in the rows of these loads, so the answer is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
KEYS_PER_BLOCK = 20


def filter_blocks(rows: int) -> int:
    """The number of blocks for at most ``rows`` keys, a power of two: filters of
    different sizes fold onto each other, and there are few different sizes."""
    wanted = -(-rows // KEYS_PER_BLOCK)
    return 1 << max(0, wanted - 1).bit_length()


def _hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys without NULLs, and two hashes of them: for the block, for the bits."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return df.filter(complete).select(
        *keys, F.xxhash64(F.lit(0), *keys).alias("__h"), F.xxhash64(F.lit(1), *keys).alias("__bits"))


def _mask(word: int) -> Column:
    return F.expr(f"shiftleft(1, cast(shiftrightunsigned(__bits, {5 * word}) & 31 as int))")


def key_filter(rows: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """(blocks, block, w0..w7): the filter of the keys of ``rows``; no key, no rows."""
    words = [F.bit_or(_mask(i)).alias(f"w{i}") for i in range(WORDS)]
    placed = _hashed(rows, keys).withColumn("block", F.pmod("__h", F.lit(blocks)))
    return placed.groupBy("block").agg(*words).select(
        F.lit(blocks).alias("blocks"), "block", *[f"w{i}" for i in range(WORDS)])


def merge_filters(filters: DataFrame, blocks: int) -> DataFrame:
    """The filter of the union, folded to ``blocks``, at most the smallest size there is."""
    folded = filters.withColumn("block", F.pmod("block", F.lit(blocks)))
    return folded.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]).select(
        F.lit(blocks).alias("blocks"), "block", *[f"w{i}" for i in range(WORDS)])


def possible_keys(rows: DataFrame, keys: Sequence[str], filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``keys`` of ``rows`` with the ``run_id`` of each load whose filter lets them pass.
    ``filters`` has run_id beside the columns of a filter, ``sizes`` their block numbers."""
    wanted = _hashed(rows, keys).distinct()
    placed = wanted.withColumn("blocks", F.explode(F.array(*[F.lit(s) for s in sorted(set(sizes))])))
    placed = placed.withColumn("block", F.pmod("__h", "blocks"))
    joined = placed.join(filters, ["blocks", "block"])
    for i in range(WORDS):
        joined = joined.filter(F.col(f"w{i}").bitwiseAND(_mask(i)) != 0)
    return joined.select(*keys, "run_id")


def repeated_keys(candidates: DataFrame, earlier: DataFrame, keys: Sequence[str],
                  run_col: str = "_pipeline_run_id") -> DataFrame:
    """The candidates that are really in ``earlier``: ``keys``, number of earlier rows and
    the first run that has them (by run id)."""
    named = candidates.withColumnRenamed("run_id", run_col)
    found = earlier.select(*keys, run_col).join(named, [*keys, run_col], "left_semi")
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_earlier"), F.min(run_col).alias("first_run"))
