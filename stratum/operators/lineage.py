"""Lineage stamps and derived partition columns (pure projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import safe_year


def with_source_file(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Materialise ``_metadata.file_path`` as a column.

    Must be applied directly on a file scan, before any projection, join or
    cache hides the hidden metadata column.
    """
    return df.withColumn(name, F.col("_metadata.file_path"))


def add_lineage(df: DataFrame, run_id: str, source_file: bool = True) -> DataFrame:
    """``_ingestion_ts`` (current timestamp), ``_source_file``, ``_pipeline_run_id``."""
    cols = {"_ingestion_ts": F.current_timestamp()}
    if source_file and "_source_file" not in df.columns:
        cols["_source_file"] = F.col("_metadata.file_path")
    cols["_pipeline_run_id"] = F.lit(run_id)
    return df.withColumns(cols)


def add_refined_stamp(df: DataFrame, run_id: str) -> DataFrame:
    """``_processed_ts`` and ``_pipeline_run_id`` on refined output."""
    return df.withColumns({"_processed_ts": F.current_timestamp(),
                           "_pipeline_run_id": F.lit(run_id)})


def add_year_partition(df: DataFrame, partition_column: str, source_column: str = "date") -> DataFrame:
    """``partition_column = year(source_column)``; malformed dates give NULL
    (Hive writes those rows under ``__HIVE_DEFAULT_PARTITION__``)."""
    return df.withColumn(partition_column, safe_year(source_column))


LINEAGE_COLUMNS = ("_ingestion_ts", "_source_file", "_pipeline_run_id")


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE_COLUMNS, "_processed_ts")
