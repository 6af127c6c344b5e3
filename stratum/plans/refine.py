"""Bronze -> refined (silver) pipeline: committed bronze rows, a registered
transformation, the output checks in one aggregate pass, stamps, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError
from stratum.operators.lineage import add_refined_stamp
from stratum.operators.projection import (
    ENTITY_SPECS,
    SILVER_NON_NEGATIVE,
    SILVER_NOT_NULL,
    get_transform,
    output_columns,
)
from stratum.operators.rules import TITLES, Rule, quality_report, raise_on_failure
from stratum.plans.control import Lakehouse, config_for, configs_by_entity
from stratum.plans.ingest import bronze_current, remove_old_runs
from stratum.plans.locks import entity_lock
from stratum.plans.runlog import new_run_id, run_event
from stratum.sources.sinks import write_managed, write_table

_EXTRA_CHECKS: dict[str, tuple[tuple[str, ...], list[str], list[str]]] = {}


def register_output_checks(entity: str, expected: Sequence[str], not_null: Sequence[str] = (),
                           non_negative: Sequence[str] = ()) -> None:
    _EXTRA_CHECKS[entity] = (tuple(expected), list(not_null), list(non_negative))


def output_rules(entity: str) -> list[Rule]:
    """Refined-output checks: exact column set, not-null keys, non-negative
    measures.  An unregistered entity has no checks (and passes)."""
    if entity in _EXTRA_CHECKS:
        expected, not_null, non_neg = _EXTRA_CHECKS[entity]
    elif entity in ENTITY_SPECS:
        expected = tuple(output_columns(ENTITY_SPECS[entity]))
        not_null = SILVER_NOT_NULL.get(entity, [])
        non_neg = SILVER_NON_NEGATIVE.get(entity, [])
    else:
        return []
    rules = [Rule("SCHEMA", expected=expected, name=TITLES["SILVER_SCHEMA"])]
    rules += [Rule("NOT_NULL", c) for c in not_null]
    rules += [Rule("NON_NEGATIVE", c) for c in non_neg]
    return rules


def check_output(entity: str, df: DataFrame) -> None:
    """Raise ValidationError listing every failing output check."""
    rules = output_rules(entity)
    if rules:
        raise_on_failure(quality_report(df, rules),
                         f"Silver validation failed for entity '{entity}'")


def source_config(bronze_config_df: DataFrame | dict, schema: str, table: str) -> dict:
    """Configuration of the entity that is loaded into ``schema.table``."""
    configs = bronze_config_df if isinstance(bronze_config_df, dict) else configs_by_entity(bronze_config_df)
    for cfg in configs.values():
        if (cfg["target_schema"], cfg["target_table"]) == (schema, table):
            return cfg
    raise ConfigurationError(f"No entity is configured to load '{schema}.{table}'")


def refined_current(spark: SparkSession, lake: Lakehouse, cfg: dict,
                    pipeline_name: str = "silver_refine") -> DataFrame | None:
    """The committed rows of a refined table: those of the latest successful run,
    or of all successful runs where the entity appends.  None before the first.

    A run writes its own folder and is committed by its SUCCESS event, so a run
    that dies while writing leaves the table as it was."""
    runs = committed_runs(spark, lake, cfg, pipeline_name)
    return _run_rows(spark, lake, cfg, runs) if runs else None


def _appends(cfg: dict) -> bool:
    return (cfg.get("write_mode") or "overwrite").lower() == "append"


def _target(lake: Lakehouse, cfg: dict) -> str:
    return lake.table_path(cfg["target_schema"], cfg["target_table"])


def _run_rows(spark: SparkSession, lake: Lakehouse, cfg: dict, runs: Sequence[str]) -> DataFrame:
    target = _target(lake, cfg)
    return spark.read.option("basePath", target).parquet(*[f"{target}/_pipeline_run_id={r}" for r in runs])


def committed_runs(spark: SparkSession, lake: Lakehouse, cfg: dict,
                   pipeline_name: str = "silver_refine") -> list[str]:
    """Ids of the runs whose rows are current, in the order of their commits."""
    done = lake.read_log(spark, "pipeline_runs").filter(
        (F.col("pipeline_name") == pipeline_name) & (F.col("entity_name") == cfg["entity_name"])
        & (F.col("status") == "SUCCESS"))
    order = F.struct("event_time", "run_id")
    if _appends(cfg):
        return [r[0] for r in done.groupBy("run_id").agg(F.min(order).alias("at")).orderBy("at").collect()]
    last = done.agg(F.max_by("run_id", order)).first()[0]
    return [last] if last else []


def publish(spark: SparkSession, lake: Lakehouse, cfg: dict, pipeline_name: str = "silver_refine") -> str | None:
    """Bring the catalog table of a refined entity up to its committed runs; returns its name.

    The table is partitioned by run.  An overwriting entity's is replaced by its latest
    run; for an appending one the latest run and those that the table lacks are written,
    each replacing its own partition.  So publishing again changes nothing, and what a
    crash between commit and publication left out is made up for by the next one."""
    runs = committed_runs(spark, lake, cfg, pipeline_name)
    if not runs:
        return None
    name = f"{cfg['target_schema']}.{cfg['target_table']}"
    if not _appends(cfg) or not spark.catalog.tableExists(name):
        return write_managed(_run_rows(spark, lake, cfg, runs), name, "overwrite", "_pipeline_run_id")
    table = spark.table(name)
    have = {r[0] for r in table.select("_pipeline_run_id").distinct().collect()}  # from folder names
    late = [r for r in runs if r not in have or r == runs[-1]]
    own = spark.newSession()  # the setting below is nobody else's
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    _run_rows(own, lake, cfg, late).select(*table.columns).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
    return name


def vacuum_refined(spark: SparkSession, lake: Lakehouse, cfg: dict, retain_hours: float = 168.0,
                   pipeline_name: str = "silver_refine") -> list[str]:
    """Delete run folders of a refined table that no committed, current run stands for and
    that are older than ``retain_hours`` (which protects runs in flight, and readers of a
    run that has just been replaced).  Returns the removed run ids."""
    keep = set(committed_runs(spark, lake, cfg, pipeline_name))
    return remove_old_runs(spark, _target(lake, cfg), keep, retain_hours)


def refine(spark: SparkSession, lake: Lakehouse, entity_name: str, refine_config_df: DataFrame,
           bronze_config_df: DataFrame, run_id: str | None = None,
           pipeline_name: str = "silver_refine", catalog: bool = False) -> DataFrame | None:
    """Run the refine step of one entity; returns the refined table (lazy
    read of what was written) or None when the entity is inactive.

    The source is the entity whose bronze table has the configured source schema
    and name.  With ``catalog`` the committed result is also published as the catalog
    table ``target_schema.target_table`` (see :func:`publish`)."""
    run_id = run_id or new_run_id()

    def event(status: str, error: str | None = None) -> None:
        lake.append(run_event(spark, run_id, pipeline_name, entity_name, status, error=error),
                    "pipeline_runs", one_file=True)

    event("RUNNING")
    committed = False
    try:
        cfg = config_for(refine_config_df, entity_name)
        if cfg.get("active") is False:
            event("SKIPPED")
            return None
        bronze_cfg = source_config(bronze_config_df, cfg["source_schema"], cfg["source_table"])
        with entity_lock(spark, lake.log_path(f"_locks/refine-{entity_name}"), run_id):
            source = bronze_current(spark, lake, bronze_cfg)
            out = get_transform(cfg["transformation_name"])(source)
            check_output(entity_name, out)
            target = _target(lake, cfg)
            stamped = add_refined_stamp(out, run_id)
            write_table(stamped.drop("_pipeline_run_id"), f"{target}/_pipeline_run_id={run_id}")
            event("SUCCESS")  # commit point
            committed = True
            if catalog:
                publish(spark, lake, cfg, pipeline_name)
        return refined_current(spark, lake, cfg, pipeline_name)
    except Exception as exc:
        if not committed:  # a run that is committed stays so if its publication fails
            event("FAILED", str(exc))
        raise
