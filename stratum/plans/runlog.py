"""Run log: append-only run events plus the run-record and audit views.

Nothing is updated in place.  A run appends a RUNNING event at start and a
SUCCESS / SKIPPED / FAILED event at the end; the run record is the view
:func:`runs_view` (latest status per run via ``max_by``, times from the event
timestamps).  This replaces keyed UPDATEs, which plain parquet tables refuse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_EVENT_DDL = (
    "run_id string, pipeline_name string, entity_name string, status string, "
    "event_time timestamp, records_processed bigint, files_processed bigint, "
    "error_message string, created_by string"
)

TERMINAL = ("SUCCESS", "SKIPPED", "FAILED")


def new_run_id() -> str:
    return "run-" + uuid.uuid4().hex


def run_event(spark: SparkSession, run_id: str, pipeline_name: str, entity_name: str,
              status: str, records: int | None = None, files: int | None = None,
              error: str | None = None, created_by: str = "stratum") -> DataFrame:
    """One run event row (timestamp taken by Spark at write time)."""
    from stratum.sources.sinks import literal_rows

    row = literal_rows(
        spark, [(run_id, pipeline_name, entity_name, status, records, files, error, created_by)],
        "run_id string, pipeline_name string, entity_name string, status string, "
        "records_processed bigint, files_processed bigint, error_message string, created_by string",
    )
    return row.select(
        "run_id", "pipeline_name", "entity_name", "status",
        F.current_timestamp().alias("event_time"), "records_processed", "files_processed",
        "error_message", "created_by",
    )


def runs_view(events: DataFrame, time_col: str = "event_time", tiebreak: str | None = None) -> DataFrame:
    """One row per run: latest status, start/end time, duration in ms, counts.

    ``end_time`` and ``duration_ms`` are NULL while the run is still RUNNING.
    """
    order = F.struct(F.col(time_col), F.col(tiebreak)) if tiebreak else F.struct(F.col(time_col))
    latest = F.max_by(F.struct("status", "records_processed", "files_processed", "error_message"),
                      order)
    g = events.groupBy("run_id").agg(
        F.first("pipeline_name", ignorenulls=True).alias("pipeline_name"),
        F.first("entity_name", ignorenulls=True).alias("entity_name"),
        F.first("created_by", ignorenulls=True).alias("created_by") if "created_by" in events.columns
        else F.lit(None).cast("string").alias("created_by"),
        F.min(time_col).alias("start_time"),
        F.max(time_col).alias("last_event_time"),
        latest.alias("__l"),
        F.count(F.lit(1)).alias("n_events"),
    )
    done = F.col("__l.status").isin(*TERMINAL)
    return g.select(
        "run_id", "pipeline_name", "entity_name",
        F.col("__l.status").alias("status"),
        "start_time",
        F.when(done, F.col("last_event_time")).alias("end_time"),
        F.when(done, F.expr("timestampdiff(MICROSECOND, start_time, last_event_time)") / 1000)
        .cast("bigint").alias("duration_ms"),
        F.col("__l.records_processed").alias("records_processed"),
        F.col("__l.files_processed").alias("files_processed"),
        F.col("__l.error_message").alias("error_message"),
        "created_by",
        "n_events",
    )


def audit_view(events: DataFrame) -> DataFrame:
    """Audit rows (run, entity, record count, status, time) of successful runs,
    derived from the run events."""
    return events.filter(F.col("status") == "SUCCESS").select(
        "run_id", "entity_name", F.col("records_processed").alias("record_count"), "status",
        F.col("event_time").alias("created_ts"))
