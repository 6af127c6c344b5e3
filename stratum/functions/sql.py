"""The column functions as SQL functions, for ``spark.sql`` users.

They are SQL-bodied functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``):
the optimizer inlines the expression, so a call costs the same as writing the
expression by hand — no Python, whole-stage codegen intact.  Each body
mirrors the Column function of the same name in :mod:`stratum.functions.columns`
(tests check they agree).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratum.functions.columns import (
    DURATION_MINUTES,
    DURATION_SECONDS,
    STRIP_EDGES,
    TRUNCATE_SUFFIX,
    WORD_BREAK,
)


def _lit(value: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_WHOLE = "cast(CASE WHEN s < 0 THEN ceil(s) ELSE floor(s) END AS BIGINT)"
_SECONDS = f"pmod({_WHOLE}, 60)"
_MINUTES = f"(({_WHOLE} - {_SECONDS}) DIV 60)"

SQL_FUNCTIONS = {
    "snake_case": (
        "x STRING", "STRING",
        f"lower(regexp_replace(x, {_lit(WORD_BREAK)}, '_'))",
    ),
    "safe_strip": (
        "x STRING", "STRING",
        f"nullif(regexp_replace(x, {_lit(STRIP_EDGES)}, ''), '')",
    ),
    "replace_null_marker": (
        "x STRING, marker STRING", "STRING",
        "nullif(x, marker)",
    ),
    "truncate_text": (
        "x STRING, n INT", "STRING",
        f"CASE WHEN length(x) <= n THEN x ELSE concat(substring(x, 1, n - {len(TRUNCATE_SUFFIX)}), "
        f"{_lit(TRUNCATE_SUFFIX)}) END",
    ),
    "format_duration": (
        "s DOUBLE", "STRING",
        f"CASE WHEN s IS NULL OR isnan(s) THEN NULL WHEN {_MINUTES} != 0 THEN format_string({_lit(DURATION_MINUTES)}, {_MINUTES}, {_SECONDS}) "
        f"ELSE format_string({_lit(DURATION_SECONDS)}, {_SECONDS}) END",
    ),
    "safe_year": (
        "x STRING", "INT",
        "year(try_cast(x AS DATE))",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
