"""The rule type DUPLICATE_KEY_RUNS: keys of a load that earlier loads hold already.

Each run of an entity with such a rule writes the filter of its keys
(:mod:`stratum.operators.keyfilter`) under ``control/_key_filters/<entity>/<keys>/run_id=<run>``,
before its commit; only filters of committed runs are read.  Runs that were committed
before the rule existed get theirs when it is first evaluated.

A failed record is a row of the new run whose key is in a current row of an earlier one.
Rows of files that the new run replaces don't count.  Rows with a NULL in the key never fail.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.keyfilter import filter_blocks, key_filter, possible_keys, repeated_keys
from stratum.operators.rules import DETAILS, Rule
from stratum.plans.control import Lakehouse, safe_name
from stratum.sources.sinks import folder_names, remove_path

TITLE = "Duplicate Key Across Runs Validation"


def _folder(lake: Lakehouse, entity: str, keys: tuple[str, ...]) -> str:
    digest = hashlib.md5(",".join(keys).encode()).hexdigest()[:12]
    return lake.log_path(f"_key_filters/{safe_name(entity)}/{digest}")


def write_run_filter(spark: SparkSession, lake: Lakehouse, entity: str, keys: tuple[str, ...],
                     run_id: str, rows: DataFrame, records: int) -> None:
    made = key_filter(rows, keys, filter_blocks(records))
    made.write.mode("overwrite").parquet(f"{_folder(lake, entity, keys)}/run_id={run_id}")


def drop_run_filters(spark: SparkSession, lake: Lakehouse, entity: str, run_id: str) -> None:
    """Remove the filters of a run that is not committed."""
    root = lake.log_path(f"_key_filters/{safe_name(entity)}")
    for digest in folder_names(spark, root):
        remove_path(spark, f"{root}/{digest}/run_id={run_id}")


def earlier_keys(spark: SparkSession, lake: Lakehouse, entity: str, keys: tuple[str, ...],
                 new: DataFrame, earlier: DataFrame, staging: str) -> DataFrame | None:
    """Keys of ``new`` that rows of ``earlier`` (committed rows, with their run) have; None
    if there is no earlier run.  Run ids reach the driver, one a committed run."""
    folder = _folder(lake, entity, keys)
    runs = {r[0] for r in earlier.select("_pipeline_run_id").distinct().collect()}
    have = {n.split("=", 1)[1] for n in folder_names(spark, folder) if n.startswith("run_id=")}
    for run in sorted(runs - have):  # committed before the rule existed
        rows = earlier.filter(F.col("_pipeline_run_id") == run)
        write_run_filter(spark, lake, entity, keys, run, rows, rows.count())
    if not runs:
        return None
    filters = spark.read.option("basePath", folder).parquet(*[f"{folder}/run_id={r}" for r in sorted(runs)])
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]
    if not sizes:
        return None
    possible_keys(new, keys, filters.withColumn("run_id", F.col("run_id").cast("string")), sizes).write.parquet(staging)
    candidates = spark.read.parquet(staging)
    holders = [r[0] for r in candidates.select("run_id").distinct().collect()]
    if not holders:
        return None
    return repeated_keys(candidates, earlier.filter(F.col("_pipeline_run_id").isin(holders)), keys)


def across_runs_result(rule: Rule, failed: int) -> dict:
    """The result row of one rule, as collected reports have them."""
    label = ", ".join(rule.key_columns)
    return {
        "rule_name": rule.name or f"{label} {TITLE}", "rule_type": "DUPLICATE_KEY_RUNS",
        "severity": rule.effective_severity, "passed": failed == 0, "failed_records": failed,
        "details": "" if not failed else DETAILS["DUPLICATE_KEY_RUNS"].format(n=failed, c=label),
        "rule_label": rule.label,
    }


def check_across_runs(spark: SparkSession, lake: Lakehouse, entity: str, rules: list[Rule], run_id: str,
                      new: DataFrame, earlier: DataFrame, records: int, staging: str) -> list[dict]:
    """Results of the rules for the rows of a new run; leaves the run's filters."""
    found = []
    for n, rule in enumerate(rules):
        keys = rule.key_columns
        write_run_filter(spark, lake, entity, keys, run_id, new, records)
        repeated = earlier_keys(spark, lake, entity, keys, new, earlier, f"{staging}/keys-{n}")
        failed = 0 if repeated is None else new.select(*keys).join(repeated, list(keys), "left_semi").count()
        found.append(across_runs_result(rule, failed))
    return found
