"""Schema-on-read scans of raw files.

* CSV: header on, columns bound by position to the given schema;
* NDJSON: one object per line, PERMISSIVE (bad lines / badly typed fields
  give NULLs, unknown fields are dropped);
* JSON array / multi-line JSON: one document per file (``multiLine``); a file
  is not splittable, so one file is one task.

A subset of the files under a path (the changed files of an incremental load)
is selected on ``_metadata.file_path``: a short list prunes the file listing, a
long one is semi-joined.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.errors import ReadError
from stratum.sources.inventory import only_files

SUPPORTED_FORMATS = ("csv", "json")


def reader(spark: SparkSession, source_format: str, schema: StructType | str | None,
           multiline: bool = False, options: dict | None = None, strict_header: bool = False):
    fmt = (source_format or "").lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ReadError(f"Unsupported source format: {source_format}")
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
        if strict_header:
            # the header must name the schema's columns in order
            r = r.option("enforceSchema", False)
    else:
        r = r.option("multiLine", bool(multiline))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_source(
    spark: SparkSession,
    source_path: str,
    source_format: str,
    schema: StructType | str | None,
    files_to_include: Iterable[str] | DataFrame | None = None,
    multiline: bool = False,
    options: dict | None = None,
    strict_header: bool = False,
    source_file_column: str | None = None,
    file_details: bool = False,
) -> DataFrame:
    """Scan ``source_path`` with a fixed schema, optionally only some files.

    ``files_to_include`` holds ``_metadata.file_path`` values (as produced by
    :func:`stratum.sources.inventory.file_inventory`), either as an iterable or
    as a DataFrame with a ``source_file`` column; see
    :func:`stratum.sources.inventory.only_files`.  ``source_file_column`` names
    a column to add that holds each row's file path; ``file_details`` adds
    ``_file_mtime`` and ``_file_size``.
    CSV columns bind by position; ``strict_header`` makes a header that does
    not match the schema an error instead.
    """
    r = reader(spark, source_format, schema, multiline, options, strict_header)
    try:
        df = r.load(source_path)
    except Exception as exc:  # noqa: BLE001 - missing path, unreadable folder, ...
        raise ReadError(f"Failed to read source '{source_path}': {exc}") from exc
    if files_to_include is None and source_file_column is None:
        return df
    file_col = source_file_column or "__file"
    details = [F.col("_metadata.file_modification_time").alias("_file_mtime"),
               F.col("_metadata.file_size").alias("_file_size")] if file_details else []
    tagged = df.select("*", F.col("_metadata.file_path").alias(file_col), *details)
    if files_to_include is not None:
        tagged = only_files(tagged, files_to_include, file_col)
    return tagged if source_file_column else tagged.drop(file_col)


def discover_schema(spark: SparkSession, path: str, source_format: str = "csv",
                    multiline: bool = False, header: bool = True) -> StructType:
    """Inferred schema of a path (exploration only: inference scans the data).
    A headerless CSV gets Spark's positional names ``_c0, _c1, ...``."""
    r = spark.read.format(source_format)
    if source_format == "csv":
        r = r.option("header", header).option("inferSchema", True)
    else:
        r = r.option("multiLine", multiline)
    return r.load(path).schema


def schema_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """A schema as rows ``(ordinal, column_name, data_type, nullable)``."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for a look at a raw source (the limit is the feature)."""
    return df.limit(n)
