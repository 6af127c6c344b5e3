"""Name -> query callable, in the order of the operator inventory."""

from __future__ import annotations

from stratum.plans import queries as q

QUERIES = {
    "check_not_null": q.check_not_null,
    "check_non_negative": q.check_non_negative,
    "check_allowed_values": q.check_allowed_values,
    "check_regex": q.check_regex,
    "check_numeric_range": q.check_numeric_range,
    "check_date_range": q.check_date_range,
    "check_null_percentage": q.check_null_percentage,
    "check_duplicate_key": q.check_duplicate_key,
    "check_duplicate_key_null": q.check_duplicate_key_null,
    "check_duplicate_row": q.check_duplicate_row,
    "check_duplicate_nested": q.check_duplicate_nested,
    "check_duplicate_row_fingerprint": q.check_duplicate_row_fingerprint,
    "check_schema": q.check_schema,
    "check_required_columns": q.check_required_columns,
    "check_referential": q.check_referential,
    "quality_report": q.quality_report_query,
    "gate": q.gate_query,
    "scan_csv": q.scan_csv,
    "scan_ndjson": q.scan_ndjson,
    "scan_json_array": q.scan_json_array,
    "scan_json_array_split": q.scan_json_array_split,
    "scan_file_subset": q.scan_file_subset,
    "discover_schema": q.discover_schema,
    "file_inventory": q.file_inventory_query,
    "file_ranges_changed": q.file_ranges_changed,
    "write_partitioned": q.write_partitioned,
    "stamp_lineage": q.stamp_lineage,
    "refine_rename_cast": q.refine_rename_cast,
    "refine_constructors": q.refine_constructors,
    "refine_flatten": q.refine_flatten,
    "refine_dates": q.refine_dates,
    "refine_results": q.refine_results,
    "refine_sprints": q.refine_sprints,
    "fn_snake_case": q.fn_snake_case,
    "fn_safe_strip": q.fn_safe_strip,
    "fn_null_marker": q.fn_null_marker,
    "fn_truncate": q.fn_truncate,
    "fn_duration": q.fn_duration,
    "changed_files": q.changed_files_query,
    "upsert_state": q.upsert_state,
    "run_latest": q.run_latest,
    "high_water": q.high_water_query,
    "current_rows": q.current_rows_query,
    "standings_supplier": q.standings_supplier,
    "standings_customer": q.standings_customer,
    "standings_nation": q.standings_nation,
    "standings_rounds": q.standings_rounds,
    "standings_rounds_late": q.standings_rounds_late,
    "gold_driver_standings": q.gold_driver_standings,
    "gold_constructor_standings": q.gold_constructor_standings,
    "ingest_incremental": q.ingest_incremental,
    "refine_orders": q.refine_orders,
    "refine_managed": q.refine_managed,
    "ingest_recovery": q.ingest_recovery,
    "rule_toggle": q.rule_toggle,
    "check_duplicate_event": q.check_duplicate_event,
    "stream_ingest": q.stream_ingest_query,
    "stream_keys": q.stream_keys,
    "seeded_layers": q.seeded_layers,
    "check_keys_across_runs": q.check_keys_across_runs,
    "history_intervals": q.history_intervals,
    "history_columns": q.history_columns,
}
