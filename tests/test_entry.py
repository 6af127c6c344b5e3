import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from stratum.operators.rules import rules_for  # noqa: E402
from stratum.plans.catalog import QUERIES  # noqa: E402
from stratum.plans import control as ctl  # noqa: E402


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"rule_name", "rule_type", "severity", "passed", "failed_records",
                               "details", "entity_name"}


def test_every_query_has_oracle_or_is_declared():
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(QUERIES) <= set(oracle)  # those of the library; the others say in llm/oracle.py why not


def test_toggle_rule(spark):
    rules = ctl.seed_validation_rules(spark)
    off = ctl.set_rule_enabled(rules, "races", "Season Required", False)
    assert off.count() == rules.count()
    assert rules_for(off, "races").count() == rules_for(rules, "races").count() - 1
    on = ctl.set_rule_enabled(off, "races", "Season Required", True)
    assert rules_for(on, "races").filter(F.col("rule_name") == "Season Required").count() == 1


def test_seed_tables(spark, tmp_path):
    cfg = ctl.seed_entity_config(spark, str(tmp_path))
    assert cfg.count() == 6
    r = ctl.config_for(cfg, "results")
    assert (r["load_type"], r["partition_column"], r["multiline"], r["incremental_strategy"]) == (
        "incremental", "race_year", True, "file_tracking")
    assert ctl.seed_dq_rules(spark).filter(F.col("rule_type") == "DUPLICATE_KEY").count() == 5
    assert ctl.seed_refine_config(spark).count() == 6


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_flagship_scans(spark):
    plan = _final_plan(entry.entry(spark))
    # orders: whole rows once, and the columns of each key; customer once
    assert plan.count("FileScan parquet") == 4
    assert plan.count("ReadSchema: struct<o_orderkey:bigint>") == 1


def test_no_python_in_tasks(spark):
    """The library's queries stay in the JVM."""
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")
    for name in ("check_not_null", "check_duplicate_key", "check_duplicate_row_fingerprint",
                 "quality_report", "refine_results", "fn_snake_case", "fn_safe_strip",
                 "changed_files", "upsert_state", "run_latest", "current_rows",
                 "check_referential", "standings_nation", "gold_driver_standings"):
        plan = _final_plan(entry.queries()[name](spark, entry.SMOKE_DIR))
        assert not any(n in plan for n in python_nodes), name
        assert "MapInPandas" not in plan and "MapInArrow" not in plan, name
