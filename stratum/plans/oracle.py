"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are assumed registered.
"""

from __future__ import annotations


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def result_row(name: str, rtype: str, severity: str, n_sql: str, detail_tail: str,
               source: str) -> str:
    """One rule result row whose failing count is ``n_sql`` over ``source``."""
    return (
        f"SELECT {_q(name)} AS rule_name, {_q(rtype)} AS rule_type, {_q(severity)} AS severity, "
        f"(n = 0) AS passed, n AS failed_records, "
        f"CASE WHEN n = 0 THEN '' ELSE CAST(n AS VARCHAR) || {_q(detail_tail)} END AS details "
        f"FROM (SELECT CAST(COALESCE({n_sql}, 0) AS BIGINT) AS n FROM {source}) s"
    )


def dup_key_row(keys: list[str], source: str, severity: str = "ERROR") -> str:
    label = ", ".join(keys)
    cols = ", ".join(keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    sub = (f"(SELECT count(*) AS c FROM {source} WHERE {nn} GROUP BY {cols} "
           f"HAVING count(*) > 1) d")
    return result_row(f"{label} Duplicate Key Validation", "DUPLICATE_KEY", severity,
                      "sum(c)", f" record(s) belong to duplicate business keys in '{label}'.", sub)


def dup_row_row(cols: list[str], source: str, severity: str = "WARNING") -> str:
    c = ", ".join(cols)
    sub = f"(SELECT count(*) - 1 AS c FROM {source} GROUP BY {c}) d"
    return (
        f"SELECT 'Duplicate Row Validation' AS rule_name, 'DUPLICATE_ROW' AS rule_type, "
        f"{_q(severity)} AS severity, (n = 0) AS passed, n AS failed_records, "
        f"CASE WHEN n = 0 THEN '' ELSE 'Found ' || CAST(n AS VARCHAR) || ' duplicate row(s).' END "
        f"AS details FROM (SELECT CAST(COALESCE(sum(c), 0) AS BIGINT) AS n FROM {sub}) s"
    )


def null_pct_row(column: str, threshold: float, source: str, severity: str = "WARNING") -> str:
    return (
        f"SELECT {_q(column + ' Null Percentage Validation')} AS rule_name, "
        f"'NULL_PERCENTAGE' AS rule_type, {_q(severity)} AS severity, (pct <= {threshold}) AS passed, "
        f"nulls AS failed_records, CASE WHEN pct <= {threshold} THEN '' ELSE "
        f"'NULL percentage ' || printf('%.2f', pct) || '% exceeds threshold {threshold:.2f}%.' END "
        f"AS details FROM (SELECT nulls, CASE WHEN total = 0 THEN 0.0 ELSE nulls / total * 100 END "
        f"AS pct FROM (SELECT CAST(count(*) - count({column}) AS BIGINT) AS nulls, "
        f"CAST(count(*) AS BIGINT) AS total FROM {source}) a) b"
    )


DOCS_LABELS = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) dl"


def _report_sql() -> str:
    o = "orders"
    c = "customer"
    rows = [
        result_row("o_orderkey Not Null Validation", "NOT_NULL", "ERROR",
                   "count(*) - count(o_orderkey)", " NULL values found in 'o_orderkey'.", o),
        dup_key_row(["o_orderkey"], o),
        result_row("o_orderstatus Allowed Values Validation", "ALLOWED_VALUES", "ERROR",
                   "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))",
                   " record(s) contain invalid values for 'o_orderstatus'.", o),
        result_row("o_totalprice Numeric Range Validation", "NUMERIC_RANGE", "ERROR",
                   "count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 450000)",
                   " record(s) are outside [0.0, 450000.0].", o),
        result_row("o_orderdate Date Range Validation", "DATE_RANGE", "ERROR",
                   "count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1995-01-01' "
                   "OR CAST(o_orderdate AS DATE) > DATE '2000-12-31')",
                   " record(s) are outside 1995-01-01 - 2000-12-31.", o),
        dup_key_row(["o_custkey", "o_orderdate"], o, "WARNING"),
        dup_row_row(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                     "o_orderpriority"], o),
        null_pct_row("o_orderpriority", 5.0, o),
    ]
    crow = [
        result_row("c_acctbal Non-Negative Validation", "NON_NEGATIVE", "WARNING",
                   "count(*) FILTER (WHERE c_acctbal < 0)",
                   " record(s) have a negative value in 'c_acctbal'.", c),
        result_row("c_name Regex Validation", "REGEX", "ERROR",
                   "count(*) FILTER (WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{9}$'))",
                   " record(s) failed regex validation.", c),
        result_row("c_mktsegment Allowed Values Validation", "ALLOWED_VALUES", "ERROR",
                   "count(*) FILTER (WHERE c_mktsegment NOT IN "
                   "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'))",
                   " record(s) contain invalid values for 'c_mktsegment'.", c),
    ]
    parts = [f"SELECT *, 'orders' AS entity_name FROM ({r}) x" for r in rows]
    parts += [f"SELECT *, 'customer' AS entity_name FROM ({r}) x" for r in crow]
    return "\nUNION ALL\n".join(parts)


ORACLE = {
    "check_not_null": result_row(
        "quality Not Null Validation", "NOT_NULL", "ERROR", "count(*) - count(quality)",
        " NULL values found in 'quality'.", DOCS_LABELS),
    "check_non_negative": "\nUNION ALL\n".join([
        result_row("c_acctbal Non-Negative Validation", "NON_NEGATIVE", "ERROR",
                   "count(*) FILTER (WHERE c_acctbal < 0)",
                   " record(s) have a negative value in 'c_acctbal'.", "customer"),
        result_row("s_acctbal Non-Negative Validation", "NON_NEGATIVE", "ERROR",
                   "count(*) FILTER (WHERE s_acctbal < 0)",
                   " record(s) have a negative value in 's_acctbal'.", "supplier"),
    ]),
    "check_allowed_values": result_row(
        "event_type Allowed Values Validation", "ALLOWED_VALUES", "ERROR",
        "count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase'))",
        " record(s) contain invalid values for 'event_type'.", "events"),
    "check_regex": result_row(
        "p_brand Regex Validation", "REGEX", "ERROR",
        "count(*) FILTER (WHERE NOT regexp_matches(p_brand, '^Brand#1[0-9]$'))",
        " record(s) failed regex validation.", "part"),
    "check_numeric_range": result_row(
        "value Numeric Range Validation", "NUMERIC_RANGE", "ERROR",
        "count(*) FILTER (WHERE value < 0 OR value > 100)",
        " record(s) are outside [0.0, 100.0].", "events"),
    "check_date_range": result_row(
        "o_orderdate Date Range Validation", "DATE_RANGE", "ERROR",
        "count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01' "
        "OR CAST(o_orderdate AS DATE) > DATE '2000-12-31')",
        " record(s) are outside 1996-01-01 - 2000-12-31.", "orders"),
    "check_null_percentage": null_pct_row("quality", 10.0, DOCS_LABELS),
    "check_duplicate_key": dup_key_row(["l_orderkey", "l_linenumber"], "lineitem")
    + "\nUNION ALL\n" + dup_key_row(["l_orderkey"], "lineitem"),
    "check_duplicate_key_null": dup_key_row(["lang", "quality"], DOCS_LABELS)
    + "\nUNION ALL\n" + dup_key_row(["toxic"], DOCS_LABELS),
    "check_duplicate_row": dup_row_row(["text", "lang", "source", "n_chars"], "documents"),
    "check_schema": (
        "SELECT 'Schema Validation' AS rule_name, 'SCHEMA' AS rule_type, 'ERROR' AS severity, "
        "false AS passed, CAST(1 AS BIGINT) AS failed_records, "
        "'Missing columns: [''n_name'']; Unexpected columns: [''name'']' AS details "
        "FROM (SELECT count(*) FROM nation) t\nUNION ALL\n"
        "SELECT 'Required Columns Validation', 'REQUIRED_COLUMN', 'ERROR', false, CAST(1 AS BIGINT), "
        "'Missing columns: [''n_name'']'\nUNION ALL\n"
        "SELECT 'Required Columns Validation', 'REQUIRED_COLUMN', 'ERROR', true, CAST(0 AS BIGINT), ''"
        "\nUNION ALL\n"
        + result_row("n_nationkey Not Null Validation", "NOT_NULL", "ERROR",
                     "count(*) - count(n_nationkey)", " NULL values found in 'n_nationkey'.", "nation")
    ),
    "quality_report": _report_sql(),
    "gate": (
        "SELECT COALESCE(bool_and(passed OR severity <> 'ERROR'), true) AS passed, "
        "CAST(count(*) AS BIGINT) AS n_rules, "
        "CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS n_failed, "
        "CAST(count(*) FILTER (WHERE NOT passed AND severity = 'ERROR') AS BIGINT) AS n_failed_error "
        f"FROM ({_report_sql()}) r"
    ),
}


def _date_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def _snake(x: str) -> str:
    return (r"lower(regexp_replace(regexp_replace(" + x + r", '([a-z0-9])([A-Z])', '\1_\2', 'g'), "
            r"'[\s\-]+', '_', 'g'))")


_PADDED = ("CASE WHEN lang = 'es' THEN ' ' || chr(9) || ' ' || chr(10) "
           "ELSE ' ' || chr(9) || text || chr(10) || '  ' END")
_STRIPPED = r"NULLIF(regexp_replace(" + _PADDED + r", '^\s+|\s+$', '', 'g'), '')"
_TRUNC = "CASE WHEN length(text) <= 500 THEN text ELSE left(text, 497) || '...' END"

ORACLE.update({
    "scan_csv": "SELECT * FROM customer",
    "scan_ndjson": "SELECT * FROM supplier",
    "scan_json_array": "SELECT * FROM nation",
    "scan_file_subset": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority "
        "FROM orders WHERE year(o_orderdate) IN (1996, 1998)"),
    "discover_schema": (
        "SELECT CAST(ordinal_position AS INTEGER) AS ordinal, column_name, "
        "CASE WHEN data_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN 'integral' "
        "WHEN data_type IN ('FLOAT', 'DOUBLE') OR data_type LIKE 'DECIMAL%' THEN 'fractional' "
        "WHEN data_type = 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS type_family "
        "FROM information_schema.columns WHERE table_name = 'supplier'"),
    "file_inventory": (
        "SELECT CAST(page_id // 20 AS BIGINT) AS batch, CAST(sum(strlen(html) + 1) AS BIGINT) AS file_size, "
        "md5(string_agg(html || chr(10), '' ORDER BY page_id)) AS content_hash FROM pages GROUP BY 1"),
    "write_partitioned": (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, "
        "CAST(count(*) AS BIGINT) AS n_orders, max(o_totalprice) AS max_price, "
        "min(o_totalprice) AS min_price FROM orders GROUP BY 1"),
    "stamp_lineage": (
        "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier.parquet' AS source_name, "
        "'run-lineage' AS _pipeline_run_id, true AS stamped FROM supplier"),
    "refine_rename_cast": (
        "SELECT CAST(c_custkey AS VARCHAR) AS circuit_id, c_name AS circuit_name, "
        "TRY_CAST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '\\N' "
        "ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS latitude, "
        "TRY_CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' "
        "ELSE CAST(c_nationkey AS VARCHAR) END AS DOUBLE) AS longitude, "
        "c_mktsegment AS locality, 'nation-' || c_nationkey AS country, "
        "'http://example.org/c/' || c_custkey AS url FROM customer"),
    "refine_constructors": (
        "SELECT CAST(s_suppkey AS VARCHAR) AS constructor_id, s_name AS name, "
        "'nation-' || s_nationkey AS nationality, 'http://example.org/s/' || s_suppkey AS url "
        "FROM supplier"),
    "refine_flatten": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS driver_id, o_orderstatus AS firstname, "
        "o_orderpriority AS surname, CAST(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '\\N' "
        f"ELSE {_date_text('o_orderdate')} END AS DATE) AS VARCHAR) AS date_of_birth, "
        "o_orderpriority AS nationality, 'http://example.org/d/' || o_orderkey AS url FROM orders"),
    "refine_dates": (
        "SELECT TRY_CAST(CAST(year(o_orderdate) AS VARCHAR) AS INTEGER) AS season, "
        "TRY_CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' "
        "ELSE CAST(month(o_orderdate) AS VARCHAR) END AS INTEGER) AS round, "
        "CAST(o_custkey AS VARCHAR) AS circuit_id, o_orderpriority AS race_name, "
        "CAST(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '\\N' "
        f"ELSE {_date_text('o_orderdate')} END AS DATE) AS VARCHAR) AS race_date, "
        "'http://example.org/r/' || o_orderkey AS url FROM orders"),
    "refine_results": (
        "SELECT CAST(l_suppkey AS VARCHAR) AS driver_id, CAST(l_partkey AS VARCHAR) AS constructor_id, "
        "CAST(year(l_shipdate) AS BIGINT) AS season, CAST(month(l_shipdate) AS BIGINT) AS round, "
        "l_linestatus AS race_name, CAST(TRY_CAST(CASE WHEN l_returnflag = 'R' THEN '\\N' "
        f"ELSE {_date_text('l_shipdate')} END AS DATE) AS VARCHAR) AS race_date, "
        "CAST(l_linenumber AS BIGINT) AS grid, CAST(trunc(l_quantity) AS BIGINT) AS laps, "
        "l_orderkey AS number, l_extendedprice AS points, CAST(l_linenumber AS BIGINT) AS position, "
        "l_returnflag AS position_text, l_linestatus AS status, "
        "'http://example.org/x/' || l_orderkey AS url FROM lineitem"),
    "fn_snake_case": (
        f"SELECT p_partkey, {_snake('p_name')} AS name_snake, "
        f"{_snake(chr(40) + 'p_name || ' + chr(39) + 'Id' + chr(39) + chr(41))} AS name_id_snake, "
        f"{_snake(chr(40) + 'p_type || ' + chr(39) + '-' + chr(39) + ' || p_brand' + chr(41))} "
        "AS type_snake FROM part"),
    "fn_safe_strip": (
        f"SELECT doc_id, md5({_STRIPPED}) AS stripped_md5, "
        f"CAST(length({_STRIPPED}) AS BIGINT) AS stripped_len FROM documents"),
    "fn_null_marker": (
        "SELECT event_id, NULLIF(CASE WHEN event_type = 'error' THEN '\\N' ELSE event_type END, "
        "'\\N') AS event_type_clean FROM events"),
    "fn_truncate": (
        f"SELECT doc_id, md5({_TRUNC}) AS truncated_md5, "
        f"CAST(length({_TRUNC}) AS BIGINT) AS truncated_len FROM documents"),
    "fn_duration": (
        "SELECT event_id, CASE WHEN m <> 0 THEN CAST(m AS VARCHAR) || 'm ' || CAST(s AS VARCHAR) || 's' "
        "ELSE CAST(s AS VARCHAR) || 's' END AS duration FROM (SELECT event_id, t // 60 AS m, "
        "t % 60 AS s FROM (SELECT event_id, CAST(floor(value * 10) AS BIGINT) AS t FROM events) a) b"),
})


_DOC_PATH = "'file:/landing/doc-' || doc_id || '.txt'"
_ORDERS_PLAIN = (
    "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders)")
_TS = "'%Y-%m-%d %H:%M:%S.%f'"

ORACLE.update({
    "changed_files": (
        f"WITH st AS (SELECT {_DOC_PATH} AS source_file, doc_id AS mt, n_chars AS file_size, "
        "md5(text) AS h FROM documents WHERE lang <> 'fr'), "
        f"inv AS (SELECT {_DOC_PATH} AS source_file, "
        "CASE WHEN source = 'src5' THEN doc_id + 1 ELSE doc_id END AS mt, "
        "CASE WHEN lang = 'de' THEN n_chars + 1 ELSE n_chars END AS file_size, "
        "md5(CASE WHEN source = 'src3' THEN text || 'x' ELSE text END) AS h FROM documents) "
        "SELECT inv.source_file, inv.file_size, "
        "CASE WHEN st.source_file IS NULL THEN 'NEW' ELSE 'MODIFIED' END AS change_kind "
        "FROM inv LEFT JOIN st ON inv.source_file = st.source_file "
        "WHERE st.source_file IS NULL OR inv.mt IS DISTINCT FROM st.mt "
        "OR inv.file_size IS DISTINCT FROM st.file_size OR inv.h IS DISTINCT FROM st.h"),
    "upsert_state": (
        f"WITH o AS {_ORDERS_PLAIN}, ch AS ("
        "SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, "
        "o_orderdate, o_orderpriority, 1 AS version, false AS deleted FROM o WHERE o_orderstatus = 'P' "
        "UNION ALL SELECT o_orderkey, o_custkey, 'F', o_totalprice + 2, o_orderdate, o_orderpriority, "
        "2, false FROM o WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' "
        "UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority, 1, false FROM o WHERE o_orderpriority = '2-HIGH' "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority, 3, true FROM o WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'), "
        "latest AS (SELECT * FROM ch QUALIFY row_number() OVER "
        "(PARTITION BY o_orderkey ORDER BY version DESC) = 1) "
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
        "FROM latest WHERE NOT deleted "
        "UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ch)"),
    "run_latest": (
        "WITH e AS (SELECT 'run-' || user_id AS run_id, event_id, ts, "
        "CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' "
        "ELSE 'RUNNING' END AS status, CAST(floor(value) AS BIGINT) AS records_processed "
        "FROM events), "
        "l AS (SELECT * FROM e QUALIFY row_number() OVER "
        "(PARTITION BY run_id ORDER BY ts DESC, event_id DESC) = 1), "
        "a AS (SELECT run_id, min(ts) AS t0, max(ts) AS t1, CAST(count(*) AS BIGINT) AS n_events "
        "FROM e GROUP BY run_id) "
        f"SELECT a.run_id, l.status, strftime(t0, {_TS}) AS start_time, "
        f"CASE WHEN l.status <> 'RUNNING' THEN strftime(t1, {_TS}) END AS end_time, "
        "CASE WHEN l.status <> 'RUNNING' THEN CAST((epoch_us(t1) - epoch_us(t0)) // 1000 AS BIGINT) "
        "END AS duration_ms, l.records_processed, a.n_events FROM a JOIN l ON a.run_id = l.run_id"),
    "high_water": (
        f"SELECT event_type AS entity_name, strftime(max(ts), {_TS}) AS watermark_value "
        "FROM events GROUP BY event_type"),
    "current_rows": (
        "SELECT l_orderkey, l_linenumber, "
        "CASE WHEN l_returnflag = 'R' THEN l_quantity + 100 ELSE l_quantity END AS l_quantity, "
        "l_returnflag, l_linestatus, "
        "CASE WHEN l_returnflag = 'R' THEN 'r2' ELSE 'r1' END AS _pipeline_run_id FROM lineitem"),
})


_NET = ("CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))")

ORACLE.update({
    "standings_supplier": (
        "SELECT season, supplier_key, points, wins, "
        "CAST(rank() OVER (PARTITION BY season ORDER BY points DESC) AS BIGINT) AS position FROM ("
        "SELECT CAST(year(l_shipdate) AS INTEGER) AS season, l_suppkey AS supplier_key, "
        f"CAST(sum({_NET}) AS DOUBLE) / 10000.0 AS points, "
        "CAST(count(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS wins "
        "FROM lineitem GROUP BY 1, 2) t"),
    "standings_customer": (
        "SELECT season, customer_key, points, wins, "
        "CAST(rank() OVER (PARTITION BY season ORDER BY points DESC) AS BIGINT) AS position FROM ("
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey AS customer_key, "
        "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS points, "
        "CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS wins "
        "FROM orders GROUP BY 1, 2) t"),
    "standings_nation": (
        "SELECT season, nation_key, points, wins, "
        "CAST(rank() OVER (PARTITION BY season ORDER BY points DESC) AS BIGINT) AS position FROM ("
        "SELECT CAST(year(l_shipdate) AS INTEGER) AS season, s_nationkey AS nation_key, "
        f"CAST(sum({_NET}) AS DOUBLE) / 10000.0 AS points, "
        "CAST(count(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS wins "
        "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) t"),
})


_ORDERS_BRONZE = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, "
    "CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")

ORACLE.update({
    "ingest_incremental": _ORDERS_BRONZE.format(
        price="CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice + 1 ELSE o_totalprice END"),
    "stream_ingest": _ORDERS_BRONZE.format(price="o_totalprice"),
    "refine_orders": (
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, "
        "o_totalprice AS total_price, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
        "o_orderpriority AS priority FROM orders"),
})


def _ref_row(col, src, ref_col, ref_src, severity="ERROR"):
    return result_row(
        f"{col} Referential Integrity Validation", "REFERENTIAL", severity,
        "count(*)", f" record(s) reference keys missing from '{ref_col}'.",
        f"(SELECT 1 FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN "
        f"(SELECT {ref_col} FROM {ref_src} WHERE {ref_col} IS NOT NULL)) m")


ORACLE.update({
    "check_required_columns": (
        "SELECT 'Required Columns Validation' AS rule_name, 'REQUIRED_COLUMN' AS rule_type, "
        "'ERROR' AS severity, true AS passed, CAST(0 AS BIGINT) AS failed_records, '' AS details "
        "FROM (SELECT 1) t UNION ALL "
        "SELECT 'Required Columns Validation', 'REQUIRED_COLUMN', 'ERROR', false, CAST(1 AS BIGINT), "
        "'Missing columns: [''l_tax'']' UNION ALL "
        + result_row("l_quantity Non-Negative Validation", "NON_NEGATIVE", "ERROR",
                     "count(*) FILTER (WHERE l_quantity < 0)",
                     " record(s) have a negative value in 'l_quantity'.", "lineitem")),
    "check_referential": " UNION ALL ".join([
        _ref_row("o_custkey", "orders", "c_custkey", "customer"),
        _ref_row("l_orderkey", "lineitem", "o_orderkey", "orders"),
        _ref_row("doc_id", "documents", "doc_id", "labels", "WARNING"),
    ]),
})

ORACLE["check_duplicate_row_fingerprint"] = " UNION ALL ".join([
    dup_row_row(["doc_id", "text", "lang", "source", "n_chars"], "documents"),
    dup_key_row(["text"], "documents", "WARNING"),
    dup_key_row(["source", "lang"], "documents", "WARNING"),
])

ORACLE["seeded_layers"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity_name, 'SUCCESS' AS bronze_status, CAST(count(*) AS BIGINT) AS "
    f"bronze_records, CAST(count(*) AS BIGINT) AS refined_rows FROM {src}"
    for e, src in [
        ("circuits", "customer"), ("constructors", "supplier"), ("drivers", "part"),
        ("races", "(SELECT DISTINCT year(o_orderdate), month(o_orderdate) FROM orders) r"),
        ("results", "orders"), ("sprints", "lineitem")])


def _gold(member_sql: str, member: str) -> str:
    return (
        f"SELECT season, {member}, points, wins, "
        "CAST(rank() OVER (PARTITION BY season ORDER BY points DESC) AS BIGINT) AS position FROM ("
        f"SELECT CAST(year(l_shipdate) AS BIGINT) AS season, {member_sql} AS {member}, "
        "sum(CAST(CAST(trunc(l_quantity) AS BIGINT) AS DOUBLE)) AS points, "
        "CAST(count(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS wins "
        "FROM lineitem GROUP BY 1, 2) t")


ORACLE["gold_driver_standings"] = _gold("CAST(l_suppkey AS VARCHAR)", "driver_id")
ORACLE["gold_constructor_standings"] = _gold("CAST(l_partkey AS VARCHAR)", "constructor_id")


ORACLE["refine_sprints"] = ORACLE["refine_results"]
ORACLE["refine_managed"] = (
    "SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(2 * count(*) AS BIGINT) AS n_rows, "
    "CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders, CAST(2 AS BIGINT) AS n_runs "
    "FROM orders GROUP BY 1, 2")
ORACLE["ingest_recovery"] = " UNION ALL ".join(
    f"SELECT {_q(step)} AS step, {_q(status)} AS status, {records} AS records, {error} AS error, "
    f"CAST(count(*) AS BIGINT) AS visible FROM orders"
    for step, status, records, error in [
        ("first load", "SUCCESS", "CAST(count(*) AS BIGINT)", "CAST(NULL AS VARCHAR)"),
        ("target dropped", "SUCCESS", "CAST(count(*) AS BIGINT)", "NULL"),
        ("state reset", "SUCCESS", "CAST(count(*) AS BIGINT)", "NULL"),
        ("empty file", "SKIPPED", "CAST(0 AS BIGINT)", "NULL"),
        ("bad file", "FAILED", "CAST(NULL AS BIGINT)",
         "'Validation failed for entity ''orders'': ' || CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS VARCHAR) "
         "|| ' NULL values found in ''o_orderkey''.'")])
_RETURNS = result_row("l_returnflag Allowed Values Validation", "ALLOWED_VALUES", "ERROR",
                      "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))",
                      " record(s) contain invalid values for 'l_returnflag'.", "lineitem")
_DISCOUNT = result_row("l_discount Numeric Range Validation", "NUMERIC_RANGE", "WARNING",
                       "count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05)",
                       " record(s) are outside [0.0, 0.05].", "lineitem")
ORACLE["rule_toggle"] = " UNION ALL ".join(
    f"SELECT *, {_q(state)} AS state FROM ({sql}) x"
    for state, sql in [("on", _RETURNS), ("on", _DISCOUNT), ("off", _DISCOUNT),
                       ("on again", _RETURNS), ("on again", _DISCOUNT)])
_EVENTS_TWICE = (
    "(SELECT * FROM events UNION ALL SELECT * REPLACE (ts + INTERVAL 1 MICROSECOND AS ts) FROM events "
    "WHERE event_type = 'purchase' UNION ALL SELECT * FROM events WHERE event_type = 'purchase')")
ORACLE["check_duplicate_event"] = " UNION ALL ".join(
    f"SELECT 'Duplicate Row Validation' AS rule_name, 'DUPLICATE_ROW' AS rule_type, {_q(severity)} AS severity, "
    "(n = 0) AS passed, n AS failed_records, CASE WHEN n = 0 THEN '' ELSE 'Found ' || CAST(n AS VARCHAR) "
    "|| ' duplicate row(s).' END AS details FROM (SELECT CAST(count(*) - (SELECT count(*) FROM "
    f"(SELECT DISTINCT * FROM {_EVENTS_TWICE} a) b) AS BIGINT) AS n FROM {_EVENTS_TWICE} c) d"
    for severity in ("WARNING", "ERROR"))


ORACLE["stream_keys"] = """
WITH e AS (
  SELECT event_id, user_id, event_type, value, epoch_ms(ts) AS ms, CASE WHEN event_id % 10 = 9 THEN 2
    WHEN event_id % 10 = 8 OR day(ts) > 10 THEN CASE WHEN day(ts) > 20 THEN 2 ELSE 1 END ELSE 0 END AS run
  FROM events),
w AS (
  SELECT r.run, (SELECT max(ms) FROM e WHERE e.run < r.run) - 12 * 86400000 AS watermark FROM (SELECT DISTINCT run FROM e) r),
j AS (
  SELECT e.*, CASE WHEN value < 1 OR value > 1000 THEN 'bad' WHEN ms < coalesce(watermark, 0) THEN 'late' END AS out
  FROM e JOIN w ON e.run = w.run),
s AS (
  SELECT event_id, ms, max(ms) OVER (PARTITION BY user_id, event_type ORDER BY run, ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM j WHERE out IS NULL)
SELECT event_id, out AS verdict FROM j WHERE out IS NOT NULL
UNION ALL SELECT event_id, CASE WHEN ms <= last + 6 * 3600000 THEN 'duplicate' ELSE 'ok' END FROM s
"""

ORACLE["check_keys_across_runs"] = """
WITH k AS (SELECT l_orderkey, 'year-' || year(l_shipdate) AS run, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (
  SELECT run, n, min(run) OVER (PARTITION BY l_orderkey) AS first_run, sum(n) OVER (
    PARTITION BY l_orderkey ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM k)
SELECT run AS run_id, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_records, CAST(sum(earlier) AS BIGINT) AS n_earlier,
  min(first_run) AS first_run FROM r WHERE earlier > 0 GROUP BY run
"""

_CHANGES = """
WITH e AS (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS t, o_orderkey AS seq, o_orderstatus AS a, o_orderpriority AS b,
    o_orderkey % 3 AS part, o_orderpriority = '5-LOW' AND o_orderkey % 4 = 0 AS gone FROM orders),
l AS (
  SELECT *, lead(t) OVER (PARTITION BY o_custkey ORDER BY t, seq) AS upto, coalesce(sum(CAST(gone AS INTEGER)) OVER (
    PARTITION BY o_custkey ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM e)
"""

ORACLE["history_intervals"] = _CHANGES + """,
s AS (SELECT * FROM l WHERE NOT gone AND (upto IS NULL OR t < upto)),
m AS (
  SELECT *, CASE WHEN lag(upto) OVER w IS NOT DISTINCT FROM t AND lag(a) OVER w = a AND lag(b) OVER w = b THEN 0 ELSE 1 END AS fresh
  FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY t)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY o_custkey ORDER BY t ROWS UNBOUNDED PRECEDING) AS grp FROM m)
SELECT o_custkey, min(a) AS o_orderstatus, min(b) AS o_orderpriority, min(t) AS valid_from, arg_max(ifnull(upto, ''), t) AS valid_to
FROM g GROUP BY o_custkey, grp
"""
ORACLE["history_intervals"] = "SELECT * REPLACE (nullif(valid_to, '') AS valid_to) FROM (" + ORACLE["history_intervals"] + ") x"

ORACLE["history_columns"] = _CHANGES + """
SELECT o_custkey, CASE WHEN NOT gone THEN last_value(CASE WHEN NOT gone AND part IN (0, 2) THEN a END IGNORE NULLS) OVER w END AS o_orderstatus,
  CASE WHEN NOT gone THEN last_value(CASE WHEN NOT gone AND part IN (1, 2) THEN b END IGNORE NULLS) OVER w END AS o_orderpriority,
  t AS valid_from, seq, upto AS valid_to, gone AS deleted
FROM l WINDOW w AS (PARTITION BY o_custkey, life ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_NESTED = "(SELECT l_returnflag, nullif(l_discount, 0) AS discount, l_tax AS tax FROM lineitem)"
ORACLE["check_duplicate_nested"] = "\nUNION ALL\n".join([
    dup_row_row(["l_returnflag", "discount", "tax"], f"{_NESTED} x"),
    result_row("m.discount Not Null Validation", "NOT_NULL", "ERROR", "count(*) FILTER (WHERE discount IS NULL)",
               " NULL values found in 'm.discount'.", f"{_NESTED} x"),
    result_row("m.tax Numeric Range Validation", "NUMERIC_RANGE", "ERROR", "count(*) FILTER (WHERE tax < 0.01 OR tax > 1)",
               " record(s) are outside [0.01, 1.0].", f"{_NESTED} x"),
    result_row("l_returnflag, m Duplicate Key Validation", "DUPLICATE_KEY", "ERROR", "sum(c)",
               " record(s) belong to duplicate business keys in 'l_returnflag, m'.",
               f"(SELECT count(*) AS c FROM {_NESTED} x GROUP BY ALL HAVING count(*) > 1) d"),
])

_PLACES = range(1, 8)
ORACLE["standings_rounds"] = (
    "WITH won AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS round, "
    "l_suppkey AS supplier_key, sum(CAST(trunc(l_quantity) AS BIGINT)) AS points, "
    + ", ".join(f"count(*) FILTER (WHERE l_linenumber = {k}) AS p{k}" for k in _PLACES)
    + " FROM lineitem GROUP BY 1, 2, 3), "
    "grid AS (SELECT m.season, r.round, m.supplier_key FROM "
    "(SELECT season, supplier_key, min(round) AS since FROM won GROUP BY 1, 2) m "
    "JOIN (SELECT DISTINCT season, round FROM won) r ON m.season = r.season AND r.round >= m.since), "
    "states AS (SELECT season, round, supplier_key, CAST(sum(coalesce(points, 0)) OVER w AS BIGINT) AS points, "
    + ", ".join(f"CAST(sum(coalesce(p{k}, 0)) OVER w AS BIGINT) AS p{k}" for k in _PLACES)
    + " FROM grid LEFT JOIN won USING (season, round, supplier_key) "
    "WINDOW w AS (PARTITION BY season, supplier_key ORDER BY round)) "
    "SELECT *, CAST(rank() OVER (PARTITION BY season, round ORDER BY points DESC, "
    + ", ".join(f"p{k} DESC" for k in _PLACES)
    + ") AS BIGINT) AS position FROM states")
ORACLE["standings_rounds_late"] = ORACLE["standings_rounds"]

ORACLE["scan_json_array_split"] = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")


def _leaves(rows: str) -> str:
    return (f"SELECT batch, r AS range, sha256(content[r * 512 + 1 : r * 512 + 512]) AS digest FROM (SELECT batch, content, "
            "unnest(range(CAST(0 AS BIGINT), CAST((octet_length(content) + 511) // 512 AS BIGINT))) AS r FROM (SELECT batch, "
            f"encode(string_agg(html || chr(10), '' ORDER BY page_id)) AS content FROM ({rows}) p GROUP BY 1) c) x")


_PAGES = "SELECT page_id, CAST(page_id // 20 AS BIGINT) AS batch, html FROM pages"
_NEW_PAGES = ("SELECT page_id, CAST(page_id // 20 AS BIGINT) AS batch, CASE WHEN page_id % 50 = 0 THEN upper(html) "
              "WHEN page_id % 70 = 3 THEN html || '<!-- -->' ELSE html END AS html FROM pages WHERE page_id // 20 <> 1")
ORACLE["file_ranges_changed"] = (
    "SELECT batch, range, CASE WHEN o.digest IS NULL THEN 'added' WHEN n.digest IS NULL THEN 'removed' ELSE 'changed' END AS change "
    f"FROM ({_leaves(_PAGES)}) o FULL JOIN ({_leaves(_NEW_PAGES)}) n USING (batch, range) WHERE o.digest IS DISTINCT FROM n.digest")
