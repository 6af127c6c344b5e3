"""Control plane: entity configuration, rule tables and the append-only logs
of one lakehouse root (a folder in the shared file system).

Layout under ``root``::

    control/<log>/            append-only parquet logs (state, runs, rule results)
    <layer>/<table>/_pipeline_run_id=<run>/[<partition>=<v>/]part-*.parquet

No table is ever updated in place: every change is an appended event and the
current picture is a view (latest per key, high-water = max).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError
from stratum.operators.rules import RESULT_DDL, RULES_DDL
from stratum.plans.runlog import RUN_EVENT_DDL, audit_view, runs_view
from stratum.sources.sinks import append_log, compact_log, read_log

ENTITY_CONFIG_DDL = (
    "entity_name string, source_format string, source_path string, target_schema string, "
    "target_table string, load_type string, partition_column string, schema_file string, "
    "active boolean, multiline boolean, incremental_strategy string, partition_source string"
)
REFINE_CONFIG_DDL = (
    "entity_name string, source_schema string, source_table string, target_schema string, "
    "target_table string, transformation_name string, write_mode string, active boolean"
)
STATE_DDL = (
    "entity_name string, source_file string, file_size bigint, last_modified_time timestamp, "
    "content_hash string, status string, run_id string, processed_at timestamp, "
    "processing_duration_ms bigint, event string"
)
PERSISTED_RESULT_DDL = (
    "run_id string, entity_name string, stage string, " + RESULT_DDL + ", rule_label string, "
    "execution_time timestamp"
)

# Three physical logs.  Audit rows and high-water marks are views over them
# (see ``Lakehouse.audit`` / ``Lakehouse.watermarks``), so a run writes fewer
# small files and the views can never disagree with the logs they summarise.
LOG_SCHEMAS = {
    "ingestion_state": STATE_DDL,
    "pipeline_runs": RUN_EVENT_DDL,
    "rule_results": PERSISTED_RESULT_DDL,
}


@dataclass(frozen=True)
class Lakehouse:
    """Paths of one lakehouse root."""

    root: str

    def log_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/control/{name}"

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read_log(self, spark: SparkSession, name: str, sub: str | None = None) -> DataFrame:
        """A log, or only its ``sub`` folder (e.g. one entity's state)."""
        path = self.log_path(name) if sub is None else f"{self.log_path(name)}/{safe_name(sub)}"
        return read_log(spark, path, LOG_SCHEMAS[name])

    def compact(self, spark: SparkSession, name: str, sub: str | None = None) -> int:
        """Merge the small batches of one log (or of one sub folder)."""
        path = self.log_path(name) if sub is None else f"{self.log_path(name)}/{safe_name(sub)}"
        return compact_log(spark, path, LOG_SCHEMAS[name])

    def results(self, spark: SparkSession, stage: str | None = None) -> DataFrame:
        """Persisted rule results; ``stage`` = 'validation' or 'dq'."""
        log = self.read_log(spark, "rule_results")
        return log if stage is None else log.filter(F.col("stage") == F.lit(stage))

    def runs(self, spark: SparkSession) -> DataFrame:
        return runs_view(self.read_log(spark, "pipeline_runs"))

    def audit(self, spark: SparkSession) -> DataFrame:
        """Audit rows: one per finished successful run, with its record count."""
        return audit_view(self.read_log(spark, "pipeline_runs"))

    def watermarks(self, spark: SparkSession) -> DataFrame:
        """High-water mark per entity: greatest mtime over committed files."""
        from stratum.operators.changes import high_water

        loaded = self.read_log(spark, "ingestion_state").filter(
            (F.col("event") == "LOADED") & F.col("last_modified_time").isNotNull())
        return high_water(loaded, "entity_name", "last_modified_time")

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Temp views under the control-table names SQL users know:
        ``pipeline_runs`` (run records), ``ingestion_state`` (current state),
        ``validation_results``, ``dq_results``, ``audit_log``, ``watermarks``."""
        from stratum.operators.changes import current_state

        views = {
            "pipeline_runs": self.runs(spark),
            "ingestion_state": current_state(self.read_log(spark, "ingestion_state")),
            "validation_results": self.results(spark, "validation"),
            "dq_results": self.results(spark, "dq"),
            "audit_log": self.audit(spark),
            "watermarks": self.watermarks(spark),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in views]

    def append(self, df: DataFrame, name: str, one_file: bool = False,
               sub: str | None = None) -> None:
        """Append a batch to a log; ``sub`` files it under a sub folder (the
        state log keeps one per entity, so a run reads only its entity's
        history, while readers of the whole log still see every batch)."""
        path = self.log_path(name) if sub is None else f"{self.log_path(name)}/{safe_name(sub)}"
        append_log(df.select(*[f.name for f in spark_schema(df.sparkSession, name).fields]),
                   path, one_file=one_file)


def safe_name(name: str) -> str:
    """A folder name for an entity (no separators, no hidden prefix)."""
    import re

    cleaned = re.sub(r"[^A-Za-z0-9_.-]", "_", name)
    return "e-" + cleaned if cleaned.startswith(("_", ".")) else cleaned


def spark_schema(spark: SparkSession, name: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(LOG_SCHEMAS[name])


# ------------------------------------------------------------- configuration

def entity_config(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ENTITY_CONFIG_DDL)


def refine_config(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REFINE_CONFIG_DDL)


def rules_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULES_DDL)


def config_for(config_df: DataFrame | dict, entity_name: str) -> dict:
    """The config row of one entity as a dict (a keyed lookup, first match).
    ``config_df`` may also be an already collected ``{entity: config}`` dict."""
    if isinstance(config_df, dict):
        if entity_name not in config_df:
            raise ConfigurationError(f"No configuration found for entity '{entity_name}'")
        return dict(config_df[entity_name])
    row = config_df.filter(F.col("entity_name") == F.lit(entity_name)).limit(1).collect()
    if not row:
        raise ConfigurationError(f"No configuration found for entity '{entity_name}'")
    return row[0].asDict()


def configs_by_entity(config_df: DataFrame) -> dict[str, dict]:
    """All config rows as ``{entity: config}`` (one collect; config is small)."""
    out: dict[str, dict] = {}
    for row in config_df.collect():
        out.setdefault(row["entity_name"], row.asDict())
    return out


# The seeded configuration of the six raw entities.  Source
# paths are relative to a landing root given at seeding time.
SEED_ENTITIES = [
    # entity, format, target table, load type, partition column, schema, multiline, strategy
    ("circuits", "csv", "circuits", "full", None, "circuits_schema", None, None),
    ("constructors", "json", "constructors", "full", None, "constructors_schema", False, None),
    ("drivers", "json", "drivers", "full", None, "drivers_schema", False, None),
    ("races", "csv", "races", "full", None, "races_schema", None, None),
    ("results", "json", "results", "incremental", "race_year", "results_schema", True, "file_tracking"),
    ("sprints", "json", "sprints", "incremental", "race_year", "sprints_schema", True, "file_tracking"),
]

# Seeded validation rules (all NOT_NULL / ERROR).
SEED_VALIDATION_RULES = [
    ("drivers", "Driver ID Required", "NOT_NULL", "driverId"),
    ("drivers", "Driver Name Required", "NOT_NULL", "name"),
    ("drivers", "Nationality Required", "NOT_NULL", "nationality"),
    ("constructors", "Constructor ID Required", "NOT_NULL", "constructorId"),
    ("constructors", "Constructor Name Required", "NOT_NULL", "name"),
    ("constructors", "Nationality Required", "NOT_NULL", "nationality"),
    ("circuits", "Circuit ID Required", "NOT_NULL", "circuitId"),
    ("circuits", "Circuit Name Required", "NOT_NULL", "circuitName"),
    ("circuits", "Locality Required", "NOT_NULL", "locality"),
    ("circuits", "Country Required", "NOT_NULL", "country"),
    ("races", "Season Required", "NOT_NULL", "season"),
    ("races", "Round Required", "NOT_NULL", "round"),
    ("races", "Circuit ID Required", "NOT_NULL", "circuitId"),
    ("races", "Race Name Required", "NOT_NULL", "raceName"),
    ("races", "Race Date Required", "NOT_NULL", "date"),
    ("results", "Driver ID Required", "NOT_NULL", "driverId"),
    ("results", "Constructor ID Required", "NOT_NULL", "constructorId"),
    ("results", "Grid Required", "NOT_NULL", "grid"),
    ("results", "Position Required", "NOT_NULL", "position"),
    ("results", "Points Required", "NOT_NULL", "points"),
]

# Seeded data-quality rules, one key rule (ERROR) and one
# duplicate-row rule (WARNING) per entity; keys are columns that exist in the
# raw schemas.
SEED_DQ_RULES = [
    ("drivers", "Duplicate Driver ID", "DUPLICATE_KEY", "driverId", "ERROR"),
    ("drivers", "Duplicate Driver Records", "DUPLICATE_ROW", None, "WARNING"),
    ("constructors", "Duplicate Constructor ID", "DUPLICATE_KEY", "constructorId", "ERROR"),
    ("constructors", "Duplicate Constructor Records", "DUPLICATE_ROW", None, "WARNING"),
    ("circuits", "Duplicate Circuit ID", "DUPLICATE_KEY", "circuitId", "ERROR"),
    ("circuits", "Duplicate Circuit Records", "DUPLICATE_ROW", None, "WARNING"),
    ("races", "Duplicate Race ID", "DUPLICATE_KEY", "season, round", "ERROR"),
    ("races", "Duplicate Race Records", "DUPLICATE_ROW", None, "WARNING"),
    ("results", "Duplicate Result ID", "DUPLICATE_KEY", "season, round, driverId", "ERROR"),
    ("results", "Duplicate Result Records", "DUPLICATE_ROW", None, "WARNING"),
]

# Seeded refine configuration (bronze -> silver, overwrite).
SEED_REFINE = [(e, "bronze", e, "silver", e, f"transform_{e}", "overwrite", True)
               for e in ("drivers", "constructors", "circuits", "races", "results", "sprints")]


def seed_entity_config(spark: SparkSession, landing_root: str) -> DataFrame:
    rows = [
        (e, fmt, f"{landing_root.rstrip('/')}/{e}/", "bronze", tbl, load, part, schema, True,
         multi, strategy, "date" if part else None)
        for e, fmt, tbl, load, part, schema, multi, strategy in SEED_ENTITIES
    ]
    return entity_config(spark, rows)


def seed_validation_rules(spark: SparkSession) -> DataFrame:
    return rules_table(spark, [(e, n, t, c, None, None, "ERROR", True)
                               for e, n, t, c in SEED_VALIDATION_RULES])


def seed_dq_rules(spark: SparkSession) -> DataFrame:
    return rules_table(spark, [(e, n, t, c, None, 0.0, severity, True)
                               for e, n, t, c, severity in SEED_DQ_RULES])


def seed_refine_config(spark: SparkSession) -> DataFrame:
    return refine_config(spark, SEED_REFINE)


def set_rule_enabled(rules_df: DataFrame, entity_name: str, rule_name: str,
                     enabled: bool) -> DataFrame:
    """Turn one rule on or off: an upsert of that row keyed on (entity, rule name)."""
    from stratum.operators.changes import upsert

    key = (F.col("entity_name") == F.lit(entity_name)) & (F.col("rule_name") == F.lit(rule_name))
    changed = rules_df.filter(key).withColumn("enabled", F.lit(enabled))
    return upsert(rules_df, changed, ["entity_name", "rule_name"])
