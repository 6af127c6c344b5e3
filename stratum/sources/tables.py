"""Access to the parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``<data_dir>/<name>.parquet`` as a DataFrame (lazy; pruning and filter
    pushdown reach the parquet scan)."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Register the tables as temp views for ``spark.sql``."""
    for name in names:
        table(spark, data_dir, name).createOrReplaceTempView(name)
