"""Incremental file ingestion with Structured Streaming.

The file source tracks which files it has seen in its checkpoint (in the
shared folder), so each trigger reads only new arrivals; with
``trigger(availableNow=True)`` a run processes everything pending in bounded
micro-batches and stops.  A micro-batch only stages its rows, under its batch id
(a re-executed batch overwrites its own folder).  When the stream has stopped, all
staged rows are one run: the checks see them together, in one pass, they are
written to one run folder, and the state is committed once.  How the files were cut into
micro-batches cannot change a result.

Rows are staged under the generation of the checkpoint, a token written into it.
A stream whose checkpoint was lost starts a new generation and reads all files
again; what older generations left staged is removed, not loaded beside it.

Batches of a run that fails its checks go to a quarantine.  Later runs leave them
out, so one bad file does not hold up the files that follow; the file source does
not read them again either.  :func:`readmit` checks and loads a quarantined run: its
files as they are now (repaired ones, by default) or its rows as they were staged
(after a change of rules).

Run ids are made of the stream's query id and its last batch id: a run that is
repeated after a crash writes the same folder and the same state, and a stream whose
checkpoint was lost gets ids of its own.

With ``keyed`` (:class:`stratum.streaming.keyed.KeyedStream`) keys are remembered across
runs in a state store, and rows that are bad, late or duplicates go to a quarantine
table one by one (:func:`quarantined_rows`) while the others are loaded.  The order of
micro-batches then matters: the watermark moves between them.

The file source does not pick up a file rewritten under the same name; for
sources that modify files in place use :func:`stratum.plans.ingest.ingest`,
whose change detection compares mtime, size and content hash.
"""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.errors import StateError, ValidationError
from stratum.operators.lineage import add_year_partition
from stratum.operators.rules import DETAILS, TITLES, Rule, load_rules, quality_report
from stratum.plans.control import Lakehouse
from stratum.plans.ingest import persist_results
from stratum.plans.locks import entity_lock
from stratum.plans.runlog import run_event
from stratum.sources.readers import read_source
from stratum.sources.schemas import get_schema
from stratum.sources.sinks import (
    folder_names,
    path_exists,
    read_small_text,
    remove_path,
    rename_path,
    write_small_text,
    write_table,
)
from stratum.streaming.keyed import KeyedStream, rocksdb_state

FILE_COLUMNS = ["_source_file", "_file_mtime", "_file_size"]


def _stage_batches(staged: str, numbered: bool):
    """A ``foreachBatch`` function that writes each micro-batch to its own folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if numbered:
            batch = batch.withColumn("_row", F.monotonically_increasing_id())
        batch.write.mode("overwrite").parquet(f"{staged}/batch_id={batch_id}")

    return run


def _batch_ids(spark: SparkSession, staged: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in folder_names(spark, staged) if n.startswith("batch_id="))


def _generation(spark: SparkSession, checkpoint: str) -> str:
    """The token of a checkpoint, written into it before its first use."""
    path = f"{checkpoint}/_generation"
    if not path_exists(spark, path):
        write_small_text(spark, path, uuid.uuid4().hex)
    return read_small_text(spark, path)


def _read_batches(spark: SparkSession, folder: str, ids: list[int], schema) -> DataFrame:
    read = spark.read if schema is None else spark.read.schema(schema)
    return read.option("basePath", folder).parquet(*[f"{folder}/batch_id={i}" for i in ids])


def _rules(cfg: dict, validation_rules: DataFrame | None, dq_rules: DataFrame | None, schema) -> list[Rule]:
    """Validation and data-quality rules, to share one pass over a run."""
    rules = []
    for table, stage in ((validation_rules, "V"), (dq_rules, "D")):
        if table is not None:
            rules += [replace(r, label=f"{stage}|{r.label or ''}")
                      for r in load_rules(table, cfg["entity_name"], expected_columns=schema.fieldNames())]
    return rules


def _commit(spark: SparkSession, lake: Lakehouse, cfg: dict, rules: list[Rule], rows: DataFrame,
            run_id: str, files: DataFrame | None = None) -> int:
    """Check all rows (payload and ``FILE_COLUMNS``) in one pass, write them as one run,
    commit its state.  ``files`` has the same file columns, if files without rows count."""
    entity = cfg["entity_name"]
    part = cfg.get("partition_column")
    report = quality_report(rows.drop(*FILE_COLUMNS), rules, count_rows=True, with_label=True).collect()
    records = next(r["failed_records"] for r in report if r["rule_type"] == "ROW_COUNT")
    persist_results(spark, lake, report, run_id, entity)
    failed = [r["details"] for r in report
              if r["rule_type"] != "ROW_COUNT" and not r["passed"] and r["severity"] == "ERROR"]
    if failed:
        raise ValidationError(f"Validation failed for entity '{entity}': {'; '.join(failed)}")
    if records == 0 and files is None:
        return 0
    out = rows.drop("_file_mtime", "_file_size")
    if part:
        out = add_year_partition(out, part, cfg.get("partition_source") or "date")
    out = out.withColumn("_ingestion_ts", F.current_timestamp())
    target = lake.table_path(cfg["target_schema"], cfg["target_table"])
    write_table(out, f"{target}/_pipeline_run_id={run_id}", "overwrite", part, rebalance=bool(part))
    loaded = (rows if files is None else files).groupBy(F.col("_source_file").alias("source_file")).agg(
        F.max("_file_size").alias("file_size"), F.max("_file_mtime").alias("last_modified_time"))
    state = loaded.select(
        F.lit(entity).alias("entity_name"), "source_file", "file_size",
        "last_modified_time", F.lit(None).cast("string").alias("content_hash"),
        F.lit("SUCCESS").alias("status"), F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("processed_at"),
        F.lit(None).cast("bigint").alias("processing_duration_ms"),
        F.lit("LOADED").alias("event"))
    lake.append(state, "ingestion_state", sub=entity)  # commit point
    return records


def _quarantine_table(lake: Lakehouse, cfg: dict) -> str:
    return lake.table_path("quarantine", f"{cfg['target_schema']}.{cfg['target_table']}")


def _commit_keyed(spark: SparkSession, lake: Lakehouse, cfg: dict, rules: list[Rule], keyed: KeyedStream,
                  staged: DataFrame, run_id: str) -> int:
    """Judge the staged rows, set aside those that are not ``ok``, load the others."""
    folder = f"{_quarantine_table(lake, cfg)}/_pipeline_run_id={run_id}"
    judged = keyed.judge(staged).select(*KeyedStream.payload(staged), "_failed", "_verdict")
    # one write of the judged rows by verdict: the loads below read their part of it
    write_table(judged, folder, "overwrite", "_verdict")
    judged = spark.read.schema(judged.schema).parquet(folder)
    counts = {r[0]: r[1] for r in judged.groupBy("_verdict").count().collect()}
    if not counts:
        remove_path(spark, folder)
        return 0
    by_rule = judged.filter(F.col("_verdict") == "bad").select(F.explode("_failed").alias("rule"))
    failing = {r[0]: r[1] for r in by_rule.groupBy("rule").count().collect()}
    label = ", ".join(keyed.keys)
    found = [(f"{label} {TITLES['DUPLICATE_KEY']}", "DUPLICATE_KEY", counts.get("duplicate", 0),
              DETAILS["DUPLICATE_KEY"].format(n=counts.get("duplicate", 0), c=label)),
             (f"{keyed.event_time} Late Row Validation", "LATE_ROW", counts.get("late", 0),
              f"{counts.get('late', 0)} record(s) arrived behind the watermark.")]
    for r in keyed.required():
        name = r.name or f"{r.column} {TITLES[r.kind]}"
        found.append((name, r.kind, failing.get(name, 0), f"{failing.get(name, 0)} record(s) set aside."))
    persist_results(spark, lake, [
        {"rule_name": n, "rule_type": k, "severity": "WARNING", "passed": not x, "failed_records": x,
         "details": d if x else "", "rule_label": "D|"} for n, k, x, d in found], run_id, cfg["entity_name"])
    good = judged.filter(F.col("_verdict") == "ok").drop("_failed", "_verdict")
    records = _commit(spark, lake, cfg, rules, good, run_id, files=judged)
    remove_path(spark, f"{folder}/_verdict=ok")
    return records


def quarantined_rows(spark: SparkSession, lake: Lakehouse, cfg: dict) -> DataFrame | None:
    """Rows that committed runs of a keyed stream set aside, with ``_verdict`` and
    ``_failed``; None before the first."""
    folder = _quarantine_table(lake, cfg)
    if not path_exists(spark, folder):
        return None
    runs = lake.read_log(spark, "ingestion_state", sub=cfg["entity_name"]).select(
        F.col("run_id").alias("_pipeline_run_id")).distinct()
    schema = get_schema(cfg["schema_file"])
    ddl = f"{schema.toDDL()}, _source_file string, _file_mtime timestamp, _file_size bigint, _failed array<string>"
    rows = spark.read.schema(f"{ddl}, _pipeline_run_id string, _verdict string").parquet(folder)
    return rows.filter(F.col("_verdict") != "ok").join(runs, "_pipeline_run_id", "left_semi")


def _source(spark: SparkSession, cfg: dict, schema, max_files: int | None) -> DataFrame:
    reader = (spark.readStream.format(cfg["source_format"]).schema(schema)
              .option("recursiveFileLookup", "true"))
    if cfg["source_format"] == "csv":
        reader = reader.option("header", True)
    else:
        reader = reader.option("multiLine", bool(cfg.get("multiline")))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(cfg["source_path"]).select(
        "*", F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_mtime"),
        F.col("_metadata.file_size").alias("_file_size"))


def stream_ingest(spark: SparkSession, lake: Lakehouse, cfg: dict,
                  validation_rules: DataFrame | None = None, stream_name: str | None = None,
                  max_files_per_trigger: int | None = 1000,
                  dq_rules: DataFrame | None = None, keyed: KeyedStream | None = None) -> None:
    """Process every pending file of ``cfg['source_path']`` and stop.

    A backlog is drained in micro-batches of at most ``max_files_per_trigger``
    files; together they are one run (see the module docstring).
    """
    entity = cfg["entity_name"]
    name = stream_name or entity
    schema = get_schema(cfg["schema_file"])
    stream = _source(spark, cfg, schema, max_files_per_trigger)
    if keyed is not None:
        stream = keyed.attach(stream)
    rules = _rules(cfg, validation_rules, dq_rules, schema)
    checkpoint = lake.log_path(f"_streams/{name}")
    # the same lock as batch ingest: a stream and a batch run of one entity
    # never write its state at the same time
    with entity_lock(spark, lake.log_path(f"_locks/{entity}"), f"stream-{name}"):
        generation = _generation(spark, checkpoint)
        staged = lake.log_path(f"_staged/{name}/{generation}")
        for old in folder_names(spark, lake.log_path(f"_staged/{name}")):
            if old != generation:
                remove_path(spark, lake.log_path(f"_staged/{name}/{old}"))
        with rocksdb_state(spark) if keyed is not None else contextlib.nullcontext():
            query = (stream.writeStream
                     .foreachBatch(_stage_batches(staged, keyed is not None))
                     .option("checkpointLocation", checkpoint)
                     .trigger(availableNow=True)
                     .start())
            query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        prefix = f"run-{name}-{str(query.id)[:8]}"

        def event(run_id, status, records=None, error=None):
            lake.append(run_event(spark, run_id, "bronze_stream", entity, status, records, error=error),
                        "pipeline_runs", one_file=True)

        done = lake.read_log(spark, "ingestion_state", sub=entity).filter(
            F.col("run_id").startswith(prefix)).agg(F.max("run_id")).first()[0]
        last = int(done.rsplit("-", 1)[1]) if done else -1
        ids = _batch_ids(spark, staged)
        for i in [i for i in ids if i <= last]:  # committed, but a crash left them staged
            remove_path(spark, f"{staged}/batch_id={i}")
        ids = [i for i in ids if i > last]
        if not ids:
            return
        run_id = f"{prefix}-{ids[-1]:08d}"
        event(run_id, "RUNNING")
        try:
            if keyed is not None:
                rows = _read_batches(spark, staged, ids, None)
                records = _commit_keyed(spark, lake, cfg, rules, keyed, rows, run_id)
            else:
                rows = _read_batches(spark, staged, ids, stream.schema).drop("batch_id")
                records = _commit(spark, lake, cfg, rules, rows, run_id)
        except Exception as exc:
            event(run_id, "FAILED", error=str(exc))
            if isinstance(exc, ValidationError) and keyed is None:
                aside = lake.log_path(f"_quarantined/{name}/{run_id}")
                for i in ids:
                    rename_path(spark, f"{staged}/batch_id={i}", f"{aside}/batch_id={i}")
            raise
        for i in ids:
            remove_path(spark, f"{staged}/batch_id={i}")
        event(run_id, "SUCCESS" if records else "SKIPPED", records)


def quarantined_runs(spark: SparkSession, lake: Lakehouse, stream_name: str) -> list[str]:
    """Ids of the failed runs of a stream whose batches are set aside."""
    return sorted(folder_names(spark, lake.log_path(f"_quarantined/{stream_name}")))


def readmit(spark: SparkSession, lake: Lakehouse, cfg: dict, run_id: str,
            validation_rules: DataFrame | None = None, stream_name: str | None = None,
            dq_rules: DataFrame | None = None, reread: bool = True) -> int:
    """Check and load a quarantined run; returns the number of rows loaded.

    ``reread`` reads the run's files again, as they are now; without it the rows are
    taken as they were staged.  A run that fails again stays in quarantine."""
    entity = cfg["entity_name"]
    name = stream_name or entity
    schema = get_schema(cfg["schema_file"])
    aside = lake.log_path(f"_quarantined/{name}/{run_id}")
    ids = _batch_ids(spark, aside)
    if not ids:
        raise StateError(f"No quarantined batches of run '{run_id}' of stream '{name}'")
    new_run = f"readmit-{run_id}"

    def event(status, records=None, error=None):
        lake.append(run_event(spark, new_run, "bronze_stream", entity, status, records, error=error),
                    "pipeline_runs", one_file=True)

    with entity_lock(spark, lake.log_path(f"_locks/{entity}"), f"readmit-{name}"):
        event("RUNNING")
        try:
            rows = _read_batches(spark, aside, ids, None).drop("batch_id")
            if reread:
                files = rows.select(F.col("_source_file").alias("source_file")).distinct()
                rows = read_source(
                    spark, cfg["source_path"], cfg["source_format"], schema, files_to_include=files,
                    multiline=bool(cfg.get("multiline")), options={"recursiveFileLookup": "true"},
                    source_file_column="_source_file", file_details=True)
            rules = _rules(cfg, validation_rules, dq_rules, schema)
            records = _commit(spark, lake, cfg, rules, rows.select(*schema.fieldNames(), *FILE_COLUMNS), new_run)
        except Exception as exc:
            event("FAILED", error=str(exc))
            raise
        remove_path(spark, aside)
        event("SUCCESS" if records else "SKIPPED", records)
    return records
