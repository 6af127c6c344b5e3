"""From documents to balanced training shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns
of ``documents`` (the last adds ``shard`` and ``slot``); it is written as Parquet and
read again before the next one, so a lost executor costs one stage at most.
``docs`` must be a table, i.e. give the same rows each time it is read.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns
are treated as the operators say (``stratum/llm``); extra columns pass through all
stages, but input columns named ``shard`` or ``slot`` are replaced in the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm.common import read_table, spool
from stratum.llm.decontaminate import decontaminate
from stratum.llm.mixing import MixingParams, mix
from stratum.llm.neardup import drop_near_duplicates
from stratum.llm.quality import quality_filter
from stratum.llm.sharding import shard_rows

#: Every good document stays once; junk and toxic tokens are thinned to these shares.
MIX = MixingParams(weights={"good": 0.97, "junk": 0.02, "toxic": 0.01}, budget_ratio=1.1, max_rate=1.0)
SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents outside the fences of their language and source."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component (five-word shingles, 0.8)."""
    return drop_near_duplicates(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth lies in benchmark windows."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def target_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins junk and toxic domains to their target shares."""
    return mix(docs, read_table(spark, sf_dir, "labels"), MIX)


def balanced_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals equal texts to one of the shards, with near equal bytes."""
    return shard_rows(docs, SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("target mixing", target_mixing),
    ("balanced shards", balanced_shards),
]

#: Signatures, fitted rates and differencing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = spool(docs)
    return docs
