"""Raw -> bronze ingestion of one entity, driven by its configuration row.

Steps (each a Spark job unless noted):

1. run event RUNNING;
2. config + named schema lookup (driver, metadata);
3. file tracking: target missing -> RESET event; inventory (binaryFile, md5 on
   executors) LEFT JOIN current state -> changed files, staged as a parquet
   table in the shared folder (removed when the run ends); none changed ->
   SKIPPED;
4. one parse of only the changed files (lineage column taken at the scan),
   written to ``<target>/_pipeline_run_id=<run>/``, partitioned as configured; tracked
   files are taken in rounds of about ``ROUND_BYTES`` a core, so the shuffle files on
   disk are those of a round, however much is loaded;
5. validation **and** data-quality rules **and** the row count in one
   aggregate pass over the written, column-pruned parquet; results appended to
   their log; keys are compared with those of earlier runs if a rule asks for it
   (:mod:`stratum.plans.runkeys`); a failing ERROR rule -> FAILED, the run folder
   is removed, nothing is committed;
6. zero rows -> SKIPPED, the run folder is removed, state untouched;
7. commit: state rows of the loaded files (written last; the batch appears by
   one rename, the single commit point), then the run event SUCCESS.  Audit rows and the high-water
   mark are views over these two logs (``Lakehouse.audit`` / ``.watermarks``).

Until step 7 the run's rows are invisible to :func:`bronze_current`, so a crash
anywhere before it leaves the table as it was.

Readers use :func:`bronze_current`, which only shows rows of committed loads.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from stratum.errors import ConfigurationError, ValidationError
from stratum.operators.changes import (
    changed_files,
    committed_run_rows,
    current_rows,
    current_state,
    latest_run_rows,
    loaded_events,
)
from stratum.operators.lineage import add_year_partition, drop_lineage
from stratum.operators.rules import RESULT_COLUMNS, load_rules, quality_report
from stratum.plans.control import Lakehouse, config_for
from stratum.plans.locks import entity_lock
from stratum.plans.runkeys import check_across_runs, drop_run_filters
from stratum.plans.runlog import new_run_id, run_event
from stratum.session import drop_shuffles
from stratum.sources.inventory import file_inventory
from stratum.sources.readers import read_source
from stratum.sources.schemas import get_schema
from stratum.sources.sinks import literal_rows, path_exists, remove_path, write_table

LOAD_TYPES = ("full", "incremental")
#: Bytes of text for each core that are loaded at once.
ROUND_BYTES = 256 << 20
#: Compressed files count as so many times their size.
PACKED = re.compile(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
PACKED_RATIO = 10


@dataclass
class IngestResult:
    status: str
    run_id: str
    records: int = 0
    files: int = 0
    target: str | None = None


_STAGES = {"V": "validation", "D": "dq"}


def persist_results(spark: SparkSession, lake: Lakehouse, rows, run_id: str, entity: str) -> None:
    """Append collected result rows (one per rule: small) to the results log;
    the label prefix tells the stage (V| validation, D| data quality)."""
    rows = [(_STAGES.get((r["rule_label"] or "?")[0], "validation"),)
            + tuple(r[c] for c in RESULT_COLUMNS) + ((r["rule_label"] or "")[2:] or None,)
            for r in rows if r["rule_type"] != "ROW_COUNT"]
    if not rows:
        return
    df = literal_rows(
        spark, rows, "stage string, rule_name string, rule_type string, severity string, "
                     "passed boolean, failed_records bigint, details string, rule_label string")
    lake.append(df.select(F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity_name"),
                          "stage", *RESULT_COLUMNS, "rule_label",
                          F.current_timestamp().alias("execution_time")), "rule_results",
                one_file=True)


def _failed_errors(rows) -> list[str]:
    return [r["details"] or r["rule_name"] for r in rows
            if r["rule_type"] != "ROW_COUNT" and not r["passed"] and r["severity"] == "ERROR"]


def reset_state(spark: SparkSession, lake: Lakehouse, entity: str) -> None:
    """Forget every tracked file of ``entity`` (a RESET event)."""
    ev = literal_rows(spark, [(entity,)], "entity_name string").select(
        "entity_name", F.lit(None).cast("string").alias("source_file"),
        F.lit(None).cast("bigint").alias("file_size"),
        F.lit(None).cast("timestamp").alias("last_modified_time"),
        F.lit(None).cast("string").alias("content_hash"), F.lit("RESET").alias("status"),
        F.lit(None).cast("string").alias("run_id"), F.current_timestamp().alias("processed_at"),
        F.lit(None).cast("bigint").alias("processing_duration_ms"), F.lit("RESET").alias("event"))
    lake.append(ev, "ingestion_state", one_file=True, sub=entity)


def load_rounds(spark: SparkSession, changed: DataFrame) -> list[list[str]]:
    """The changed files in rounds of about ``ROUND_BYTES`` of text a core, or of one
    larger file.  Their paths reach the driver, as for the scan that reads them."""
    most = ROUND_BYTES * spark.sparkContext.defaultParallelism
    rounds, held = [[]], 0
    for file, size in changed.select("source_file", "file_size").orderBy("source_file").toLocalIterator():
        size = (size or 0) * (PACKED_RATIO if PACKED.search(file) else 1)
        if rounds[-1] and held + size > most:
            rounds.append([])
            held = 0
        rounds[-1].append(file)
        held += size
    return rounds


def bronze_schema(cfg: dict) -> StructType:
    """Raw schema + ``_source_file`` [+ partition column] + ``_ingestion_ts`` +
    ``_pipeline_run_id`` (the run folder), as written by :func:`ingest`."""
    fields = list(get_schema(cfg["schema_file"]).fields)
    fields.append(StructField("_source_file", StringType()))
    if cfg.get("partition_column"):
        fields.append(StructField(cfg["partition_column"], IntegerType()))
    fields.append(StructField("_ingestion_ts", TimestampType()))
    fields.append(StructField("_pipeline_run_id", StringType()))
    return StructType(fields)


def bronze_current(spark: SparkSession, lake: Lakehouse, cfg: dict) -> DataFrame:
    """Committed bronze rows of an entity.

    File-tracked entities: per file, the rows of its latest committed load.
    Incremental entities without file tracking: the rows of every committed run
    (append).  Full loads: the rows of the latest committed run (a full load
    replaces everything; a failed or empty one leaves the previous visible).
    """
    target = lake.table_path(cfg["target_schema"], cfg["target_table"])
    schema = bronze_schema(cfg)
    if path_exists(spark, target):
        bronze = spark.read.schema(schema).parquet(target)
    else:
        bronze = spark.createDataFrame([], schema)
    log = lake.read_log(spark, "ingestion_state", sub=cfg["entity_name"])
    state = current_state(log, cfg["entity_name"])
    if cfg.get("incremental_strategy") == "file_tracking":
        return current_rows(bronze, state)
    if (cfg.get("load_type") or "").lower() == "incremental":
        return committed_run_rows(bronze, log, cfg["entity_name"])
    return latest_run_rows(bronze, state)


def ingest(spark: SparkSession, lake: Lakehouse, entity_name: str, config_df: DataFrame | dict,
           validation_rules: DataFrame | None = None, dq_rules: DataFrame | None = None,
           pipeline_name: str = "bronze_ingestion", hash_content: bool = True,
           trust_metadata: bool = False, lock: bool = True,
           references: dict | None = None) -> IngestResult:
    """Ingest one entity (see the module docstring for the steps).

    Change detection is exact by default: every file is hashed each run, so a
    rewrite that keeps size and mtime is still found.  ``trust_metadata``
    hashes only files whose mtime or size changed (or that are new) — hashing
    cost proportional to the changed bytes, at the price of missing such
    rewrites.  With ``lock`` a second run of the same entity fails fast instead of
    overlapping (see :mod:`stratum.plans.locks`).  ``references`` maps table
    names of REFERENTIAL rules to DataFrames (else the catalog is used).
    """
    run_id = new_run_id()
    t0 = time.monotonic()
    lake.append(run_event(spark, run_id, pipeline_name, entity_name, "RUNNING"), "pipeline_runs",
                one_file=True)

    def finish(status: str, records: int = 0, files: int = 0, target: str | None = None):
        lake.append(run_event(spark, run_id, pipeline_name, entity_name, status, records, files),
                    "pipeline_runs", one_file=True)
        return IngestResult(status, run_id, records, files, target)

    try:
        if lock:
            with entity_lock(spark, lake.log_path(f"_locks/{entity_name}"), run_id):
                return _ingest_steps(spark, lake, entity_name, config_df, validation_rules,
                                     dq_rules, run_id, t0, finish, hash_content,
                                     trust_metadata, references)
        return _ingest_steps(spark, lake, entity_name, config_df, validation_rules, dq_rules,
                             run_id, t0, finish, hash_content, trust_metadata, references)
    except Exception as exc:
        lake.append(run_event(spark, run_id, pipeline_name, entity_name, "FAILED",
                              error=str(exc)), "pipeline_runs", one_file=True)
        raise


def _ingest_steps(spark, lake, entity_name, config_df, validation_rules, dq_rules, run_id, t0,
                  finish, hash_content, trust_metadata, references=None) -> IngestResult:
    """The steps of :func:`ingest` (see the module docstring)."""
    try:
        return _staged_steps(spark, lake, entity_name, config_df, validation_rules, dq_rules,
                             run_id, t0, finish, hash_content, trust_metadata, references)
    finally:
        remove_path(spark, lake.log_path(f"_staging/{run_id}"))


def _staged_steps(spark, lake, entity_name, config_df, validation_rules, dq_rules, run_id, t0,
                  finish, hash_content, trust_metadata, references) -> IngestResult:
    cfg = config_for(config_df, entity_name)
    if cfg.get("active") is False:
        return finish("SKIPPED")
    schema = get_schema(cfg["schema_file"])
    load_type = (cfg.get("load_type") or "").lower()
    if load_type not in LOAD_TYPES:
        raise ConfigurationError(f"Unsupported load type: {cfg.get('load_type')}")
    target = lake.table_path(cfg["target_schema"], cfg["target_table"])
    tracking = cfg.get("incremental_strategy") == "file_tracking"

    changed = None
    files = 0
    if tracking:
        if not path_exists(spark, target):
            reset_state(spark, lake, entity_name)
        state = current_state(lake.read_log(spark, "ingestion_state", sub=entity_name),
                              entity_name)
        staging = lake.log_path(f"_staging/{run_id}/changed_files")
        if trust_metadata and hash_content:
            listing = file_inventory(spark, cfg["source_path"], hash_content=False)
            candidates = changed_files(listing, state, compare_hash=False)
            inv = file_inventory(spark, cfg["source_path"], files=candidates)
            changed_files(inv, state, compare_hash=False).write.parquet(staging)
        else:
            inv = file_inventory(spark, cfg["source_path"], hash_content=hash_content)
            changed_files(inv, state).write.parquet(staging)
        changed = spark.read.parquet(staging)  # one row per changed file
        files = changed.count()
        if not files:
            return finish("SKIPPED")

    # The raw files are parsed once: straight into this run's own folder,
    # which stays invisible until the state commit below.
    part = cfg.get("partition_column")
    run_dir = f"{target}/_pipeline_run_id={run_id}"
    now = F.timestamp_micros(F.lit(int(time.time() * 1e6)))  # one for all rounds
    for k, some in enumerate(load_rounds(spark, changed) if tracking else [None]):
        if k:
            drop_shuffles(spark)
        df = read_source(spark, cfg["source_path"], cfg["source_format"], schema,
                         files_to_include=some, multiline=bool(cfg.get("multiline")),
                         options={"recursiveFileLookup": "true"}, source_file_column="_source_file")
        if part:
            df = add_year_partition(df, part, cfg.get("partition_source") or "date")
        df = df.withColumn("_ingestion_ts", now)
        write_table(df, run_dir, "append" if k else "overwrite", part, rebalance=bool(part))
    write_schema = df.schema
    del df
    drop_shuffles(spark)

    # Validation and data-quality rules, and the row count, in ONE pass
    # over the written, column-pruned parquet of this run.  The count is
    # an aggregate result, so task retries cannot inflate it.
    written = spark.read.schema(write_schema).parquet(run_dir)
    checked = written.select(*[c for c in drop_lineage(written).columns if c != part])
    vrules = [replace(r, label=f"V|{r.label or ''}") for r in
              (load_rules(validation_rules, entity_name, expected_columns=schema.fieldNames())
               if validation_rules is not None else [])]
    drules = [replace(r, label=f"D|{r.label or ''}") for r in
              (load_rules(dq_rules, entity_name, expected_columns=schema.fieldNames())
               if dq_rules is not None else [])]
    across = [r for r in drules if r.kind == "DUPLICATE_KEY_RUNS"]
    drules = [r for r in drules if r.kind != "DUPLICATE_KEY_RUNS"]
    report = quality_report(checked, vrules + drules, count_rows=True, with_label=True,
                            references=references).collect()
    records = next(r["failed_records"] for r in report if r["rule_type"] == "ROW_COUNT")
    if across and records:
        earlier = bronze_current(spark, lake, cfg)
        if changed is not None:  # rows of files that this run replaces are none of the others'
            earlier = earlier.join(changed.select(F.col("source_file").alias("_source_file")),
                                   "_source_file", "left_anti")
        report += check_across_runs(spark, lake, entity_name, across, run_id, checked, earlier, records,
                                    lake.log_path(f"_staging/{run_id}"))
    v_rows = [r for r in report if (r["rule_label"] or "").startswith("V|")]
    d_rows = [r for r in report if (r["rule_label"] or "").startswith("D|")]
    persist_results(spark, lake, report, run_id, entity_name)
    for rows, what in ((v_rows, "Validation"), (d_rows, "Data quality")):
        failed = _failed_errors(rows)
        if failed:
            remove_path(spark, run_dir)
            drop_run_filters(spark, lake, entity_name, run_id)
            raise ValidationError(f"{what} failed for entity '{entity_name}': {'; '.join(failed)}")
    if records == 0:
        remove_path(spark, run_dir)
        return finish("SKIPPED")

    elapsed_ms = int((time.monotonic() - t0) * 1000)
    if tracking:
        loaded = changed.select(
            F.lit(entity_name).alias("entity_name"), "source_file", "file_size",
            "last_modified_time", "content_hash")
    else:
        loaded = written.select("_source_file").distinct().select(
            F.lit(entity_name).alias("entity_name"), F.col("_source_file").alias("source_file"),
            F.lit(None).cast("bigint").alias("file_size"),
            F.lit(None).cast("timestamp").alias("last_modified_time"),
            F.lit(None).cast("string").alias("content_hash"))
    state_rows = loaded.select(
        "*", F.lit("SUCCESS").alias("status"), F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("processed_at"),
        F.lit(elapsed_ms).cast("bigint").alias("processing_duration_ms"),
        F.lit("LOADED").alias("event"))
    lake.append(state_rows, "ingestion_state", sub=entity_name)  # commit point
    return finish("SUCCESS", records, files, target)


def vacuum_bronze(spark: SparkSession, lake: Lakehouse, cfg: dict,
                  retain_hours: float = 168.0) -> list[str]:
    """Delete bronze run folders that no current state row points to and that
    are older than ``retain_hours`` (the window protects runs still in
    flight).  Returns the removed run ids.

    Referenced runs come from the current state (one row per file, a small
    distinct set); the folder listing is one metadata call.
    """
    target = lake.table_path(cfg["target_schema"], cfg["target_table"])
    if not path_exists(spark, target):
        return []
    log = lake.read_log(spark, "ingestion_state", sub=cfg["entity_name"])
    state = current_state(log, cfg["entity_name"])
    if cfg.get("incremental_strategy") == "file_tracking":
        keep = {r[0] for r in state.select("run_id").distinct().collect()}
    elif (cfg.get("load_type") or "").lower() == "incremental":
        keep = {r[0] for r in loaded_events(log, cfg["entity_name"])
                .select("run_id").distinct().collect()}
    else:
        last = state.agg(F.max_by("run_id", F.struct("processed_at", "run_id"))).first()[0]
        keep = {last} if last else set()
    return remove_old_runs(spark, target, keep, retain_hours)


def remove_old_runs(spark: SparkSession, target: str, keep: set[str], retain_hours: float) -> list[str]:
    """Delete the run folders under ``target`` that are not in ``keep`` and are older than
    ``retain_hours`` (one listing)."""
    import time as _time

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    cutoff_ms = (_time.time() - retain_hours * 3600) * 1000
    removed = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not name.startswith("_pipeline_run_id="):
            continue
        run = name.split("=", 1)[1]
        if run in keep or st.getModificationTime() > cutoff_ms:
            continue
        fs.delete(st.getPath(), True)
        removed.append(run)
    return removed
