"""Registered queries: each takes ``(spark, data_dir)`` and returns a DataFrame
computed over the whole input tables.  They exercise the operators of the
library on the shared test tables; ``oracle.py`` holds the equivalent SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import columns as fn
from stratum.functions.columns import NULL_MARKER
from stratum.operators import changes as chg
from stratum.operators import history, keyfilter
from stratum.operators import lineage as lin
from stratum.operators.projection import Field, get_transform, register_transform
from stratum.operators.ranking import rank_desc
from stratum.operators.rules import (
    RULES_DDL,
    Rule,
    gate,
    load_rules,
    load_rules_by_entity,
    quality_report,
    referential_report,
)
from stratum.operators.rounds import first_changes, round_results, round_standings, update_round_standings
from stratum.operators.standings import constructor_standings, driver_standings, standings
from stratum.plans import control as ctl
from stratum.plans import runlog
from stratum.plans.engine import Engine
from stratum.plans.ingest import bronze_current, ingest, reset_state
from stratum.plans.refine import refine, register_output_checks
from stratum.session import scratch_path, scratch_table
from stratum.sources import readers, sinks
from stratum.sources.inventory import file_inventory, list_files
from stratum.sources.jsonarrays import read_json_arrays
from stratum.sources.ranges import changed_ranges, range_digests
from stratum.sources.schemas import register_schema
from stratum.sources.tables import table
from stratum.streaming.ingest import quarantined_rows, stream_ingest
from stratum.streaming.keyed import KeyedStream

# ----------------------------------------------------------------- inputs


def documents_with_labels(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents left-joined to their (partial) labels: the NULL-bearing input."""
    docs = table(spark, data_dir, "documents")
    labels = table(spark, data_dir, "labels")
    return docs.join(labels, "doc_id", "left")


# ----------------------------------------------------------- single rules


def check_not_null(spark, data_dir):
    df = documents_with_labels(spark, data_dir)
    return quality_report(df, [Rule("NOT_NULL", "quality")])


def check_non_negative(spark, data_dir):
    cust = quality_report(table(spark, data_dir, "customer"), [Rule("NON_NEGATIVE", "c_acctbal")])
    supp = quality_report(table(spark, data_dir, "supplier"), [Rule("NON_NEGATIVE", "s_acctbal")])
    return cust.unionByName(supp)


def check_allowed_values(spark, data_dir):
    return quality_report(table(spark, data_dir, "events"),
                          [Rule("ALLOWED_VALUES", "event_type", value="view, click, purchase")])


def check_regex(spark, data_dir):
    return quality_report(table(spark, data_dir, "part"),
                          [Rule("REGEX", "p_brand", value="^Brand#1[0-9]$")])


def check_numeric_range(spark, data_dir):
    return quality_report(table(spark, data_dir, "events"),
                          [Rule("NUMERIC_RANGE", "value", value="0,100")])


def check_date_range(spark, data_dir):
    return quality_report(table(spark, data_dir, "orders"),
                          [Rule("DATE_RANGE", "o_orderdate", value="1996-01-01,2000-12-31")])


def check_null_percentage(spark, data_dir):
    df = documents_with_labels(spark, data_dir)
    return quality_report(df, [Rule("NULL_PERCENTAGE", "quality", threshold=10.0)])


def check_duplicate_key(spark, data_dir):
    return quality_report(table(spark, data_dir, "lineitem"), [
        Rule("DUPLICATE_KEY", "l_orderkey, l_linenumber"),
        Rule("DUPLICATE_KEY", "l_orderkey"),
    ])


def check_duplicate_key_null(spark, data_dir):
    df = documents_with_labels(spark, data_dir)
    return quality_report(df, [
        Rule("DUPLICATE_KEY", "lang, quality"),
        Rule("DUPLICATE_KEY", "toxic"),
    ])


def check_duplicate_row(spark, data_dir):
    docs = table(spark, data_dir, "documents").drop("doc_id")  # all that is not the key
    return quality_report(docs, [Rule("DUPLICATE_ROW")])


def check_duplicate_nested(spark, data_dir):
    """Rows and keys with NULL and zero floats inside a map, beside row rules on it."""
    rows = table(spark, data_dir, "lineitem").select(
        "l_returnflag", F.create_map(F.lit("discount"), F.nullif("l_discount", F.lit(0.0)), F.lit("tax"), F.col("l_tax")).alias("m"))
    return quality_report(rows, [
        Rule("DUPLICATE_ROW"), Rule("NOT_NULL", "m.discount"), Rule("NUMERIC_RANGE", "m.tax", "0.01,1"),
        Rule("DUPLICATE_KEY", "l_returnflag, m")])


def check_schema(spark, data_dir):
    nation = table(spark, data_dir, "nation").withColumnRenamed("n_name", "name")
    expected = ("n_nationkey", "n_name", "n_regionkey")
    return quality_report(nation, [
        Rule("SCHEMA", expected=expected),
        Rule("REQUIRED_COLUMN", expected=("n_nationkey", "n_name")),
        Rule("REQUIRED_COLUMN", expected=("n_nationkey", "n_regionkey")),
        Rule("NOT_NULL", "n_nationkey"),
    ])


# ------------------------------------------------------------ flagship report

# Rule metadata of the flagship report (a control table; small by nature).
REPORT_RULES = [
    ("orders", "Order key present", "NOT_NULL", "o_orderkey", None, None, None, True),
    ("orders", "Order key unique", "DUPLICATE_KEY", "o_orderkey", None, None, None, True),
    ("orders", "Known status", "ALLOWED_VALUES", "o_orderstatus", "F,O", None, None, True),
    ("orders", "Price range", "NUMERIC_RANGE", "o_totalprice", "0,450000", None, None, True),
    ("orders", "Order date range", "DATE_RANGE", "o_orderdate", "1995-01-01,2000-12-31", None, None, True),
    ("orders", "Customer and date", "DUPLICATE_KEY", "o_custkey, o_orderdate", None, None, "WARNING", True),
    ("orders", "Exact copies", "DUPLICATE_ROW", None, None, None, None, True),
    ("orders", "Priority mostly set", "NULL_PERCENTAGE", "o_orderpriority", None, 5.0, None, True),
    ("orders", "Disabled rule", "NOT_NULL", "o_custkey", None, None, None, False),
    ("customer", "Balance not negative", "NON_NEGATIVE", "c_acctbal", None, None, "WARNING", True),
    ("customer", "Name pattern", "REGEX", "c_name", "^Customer#[0-9]{9}$", None, None, True),
    ("customer", "Segment list", "ALLOWED_VALUES", "c_mktsegment",
     "AUTOMOBILE, BUILDING, FURNITURE, MACHINERY", None, None, True),
]


def report_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REPORT_RULES, RULES_DDL)


def quality_report_query(spark, data_dir):
    """Ten enabled rules on orders and customer, one scan per table."""
    entities = ("orders", "customer")
    rules = load_rules_by_entity(report_rules(spark), entities)  # one collect
    parts = []
    for entity in entities:
        df = table(spark, data_dir, entity)
        parts.append(quality_report(df, rules[entity]).withColumn("entity_name", F.lit(entity)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate_query(spark, data_dir):
    return gate(quality_report_query(spark, data_dir))


# ------------------------------------------------------------ scans and sinks


CUSTOMER_DDL = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string")
SUPPLIER_DDL = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
NATION_DDL = "n_nationkey int, n_name string, n_regionkey int"
ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


def scan_csv(spark, data_dir):
    path = scratch_path(spark, "customer_csv")
    table(spark, data_dir, "customer").write.option("header", True).csv(path)
    return readers.read_source(spark, path, "csv", CUSTOMER_DDL)


def scan_ndjson(spark, data_dir):
    path = scratch_path(spark, "supplier_json")
    table(spark, data_dir, "supplier").write.json(path)
    return readers.read_source(spark, path, "json", SUPPLIER_DDL)


def scan_json_array(spark, data_dir):
    path = scratch_path(spark, "nation_array")
    sinks.write_json_arrays(table(spark, data_dir, "nation"), path, files=3)
    return readers.read_source(spark, path, "json", NATION_DDL, multiline=True,
                               options={"recursiveFileLookup": "true"})


def scan_json_array_split(spark, data_dir):
    """Orders landed as two arrays, each read in byte ranges by many tasks."""
    path = sinks.write_json_arrays(table(spark, data_dir, "orders"), scratch_path(spark, "orders_array"), files=2)
    df = read_json_arrays(spark, path, ORDERS_DDL)
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
                     "o_orderpriority")


def _orders_by_year_json(spark, data_dir) -> str:
    path = scratch_path(spark, "orders_by_year")
    orders = lin.add_year_partition(table(spark, data_dir, "orders"), "order_year", "o_orderdate")
    orders.write.partitionBy("order_year").json(path)
    return path


def scan_file_subset(spark, data_dir):
    """Only the files of two years are read; the rest are pruned at listing."""
    path = _orders_by_year_json(spark, data_dir)
    inv = file_inventory(spark, path, hash_content=False)
    wanted = inv.filter(F.col("source_file").rlike("order_year=(1996|1998)/"))
    df = readers.read_source(spark, path, "json", ORDERS_DDL, files_to_include=wanted)
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
                     "o_orderpriority")


def discover_schema(spark, data_dir):
    path = scratch_path(spark, "supplier_csv")
    table(spark, data_dir, "supplier").write.option("header", True).csv(path)
    schema = readers.discover_schema(spark, path, "csv")
    fields = readers.schema_table(spark, schema)
    family = (F.when(F.col("data_type").isin("tinyint", "smallint", "int", "bigint"), "integral")
              .when(F.col("data_type").isin("float", "double") | F.col("data_type").startswith("decimal"),
                    "fractional")
              .otherwise(F.col("data_type")))
    return fields.select("ordinal", "column_name", family.alias("type_family"))


def file_inventory_query(spark, data_dir):
    path = scratch_path(spark, "pages_raw")
    pages = table(spark, data_dir, "pages").withColumn("batch", F.expr("page_id DIV 20"))
    sinks.write_text_files(pages, path, "batch", "page_id", "html")
    inv = file_inventory(spark, path)
    return inv.select(
        F.regexp_extract("source_file", r"batch=([0-9]+)/", 1).cast("bigint").alias("batch"),
        "file_size", "content_hash")


#: Small, so that the files of the test tables have several ranges.
COMPARED_BYTES = 512


def file_ranges_changed(spark, data_dir):
    """The byte ranges in which two landings of the pages differ: some texts in capitals,
    some longer, one batch of files gone."""
    pages = table(spark, data_dir, "pages").withColumn("batch", F.expr("page_id DIV 20"))
    html = F.when(F.col("page_id") % 50 == 0, F.upper("html")).when(
        F.col("page_id") % 70 == 3, F.concat("html", F.lit("<!-- -->"))).otherwise(F.col("html"))
    leaves = []
    for name, rows in (("old", pages), ("new", pages.where("batch <> 1").withColumn("html", html))):
        path = sinks.write_text_files(rows, scratch_path(spark, f"pages_{name}"), "batch", "page_id", "html")
        batch = F.regexp_extract("source_file", r"batch=([0-9]+)/", 1).cast("bigint").alias("batch")
        leaves.append(range_digests(list_files(spark, path), COMPARED_BYTES).select(batch, "range", "digest"))
    return changed_ranges(*leaves, key="batch")


def write_partitioned(spark, data_dir):
    """Full load of the older orders, registered; incremental append of the rest,
    registered again; read back through the table's name; partitions by derived order year."""
    import uuid

    path = scratch_path(spark, "orders_bronze")
    orders = lin.add_year_partition(table(spark, data_dir, "orders"), "order_year", "o_orderdate")
    name = f"bronze_orders_{uuid.uuid4().hex[:8]}"
    sinks.write_table(orders.filter(F.col("order_year") < 1998), path, "overwrite", "order_year")
    sinks.register_table(spark, name, path)
    sinks.write_table(orders.filter(~(F.col("order_year") < 1998)), path, "append", "order_year")
    sinks.register_table(spark, name, path)  # the appended partitions become visible
    return (spark.table(name).groupBy("order_year")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.max("o_totalprice").alias("max_price"),
                 F.min("o_totalprice").alias("min_price")))


def stamp_lineage(spark, data_dir):
    df = lin.add_lineage(table(spark, data_dir, "supplier"), "run-lineage")
    df = lin.add_refined_stamp(df, "run-lineage")
    return df.select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal",
        F.regexp_extract("_source_file", r"([^/]+)$", 1).alias("source_name"),
        "_pipeline_run_id",
        (F.col("_ingestion_ts").isNotNull() & F.col("_processed_ts").isNotNull()).alias("stamped"),
    )


# ------------------------------------------------------------ projections



def _date_text(c):
    return F.date_format(c, "yyyy-MM-dd")


def raw_circuits(spark, data_dir):
    c = table(spark, data_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("circuitId"),
        F.concat(F.lit("http://example.org/c/"), F.col("c_custkey")).alias("url"),
        F.col("c_name").alias("circuitName"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(NULL_MARKER))
        .otherwise(F.col("c_acctbal").cast("string")).alias("lat"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a"))
        .otherwise(F.col("c_nationkey").cast("string")).alias("long"),
        F.col("c_mktsegment").alias("locality"),
        F.concat(F.lit("nation-"), F.col("c_nationkey")).alias("country"),
    )


def refine_rename_cast(spark, data_dir):
    return get_transform("transform_circuits")(raw_circuits(spark, data_dir))


def raw_drivers(spark, data_dir):
    o = table(spark, data_dir, "orders")
    return o.select(
        F.when(F.col("o_orderstatus") == "P", F.lit(NULL_MARKER))
        .otherwise(_date_text("o_orderdate")).alias("dateOfBirth"),
        F.col("o_orderkey").cast("string").alias("driverId"),
        F.struct(F.col("o_orderpriority").alias("familyName"),
                 F.col("o_orderstatus").alias("givenName")).alias("name"),
        F.col("o_orderpriority").alias("nationality"),
        F.concat(F.lit("http://example.org/d/"), F.col("o_orderkey")).alias("url"),
    )


def refine_flatten(spark, data_dir):
    out = get_transform("transform_drivers")(raw_drivers(spark, data_dir))
    return out.withColumn("date_of_birth", F.col("date_of_birth").cast("string"))


def raw_races(spark, data_dir):
    o = table(spark, data_dir, "orders")
    return o.select(
        F.year("o_orderdate").cast("string").alias("season"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
        .otherwise(F.month("o_orderdate").cast("string")).alias("round"),
        F.concat(F.lit("http://example.org/r/"), F.col("o_orderkey")).alias("url"),
        F.col("o_orderpriority").alias("raceName"),
        F.when(F.col("o_orderstatus") == "P", F.lit(NULL_MARKER))
        .otherwise(_date_text("o_orderdate")).alias("date"),
        F.col("o_custkey").cast("string").alias("circuitId"),
    )


def refine_dates(spark, data_dir):
    out = get_transform("transform_races")(raw_races(spark, data_dir))
    return out.withColumn("race_date", F.col("race_date").cast("string"))


def raw_results(spark, data_dir):
    li = table(spark, data_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("constructorId"),
        F.when(F.col("l_returnflag") == "R", F.lit(NULL_MARKER))
        .otherwise(_date_text("l_shipdate")).alias("date"),
        F.col("l_suppkey").cast("string").alias("driverId"),
        F.col("l_linenumber").cast("bigint").alias("grid"),
        F.col("l_quantity").cast("bigint").alias("laps"),
        F.col("l_orderkey").alias("number"),
        F.col("l_extendedprice").alias("points"),
        F.col("l_linenumber").cast("bigint").alias("position"),
        F.col("l_returnflag").alias("positionText"),
        F.col("l_linestatus").alias("raceName"),
        F.month("l_shipdate").cast("bigint").alias("round"),
        F.year("l_shipdate").cast("bigint").alias("season"),
        F.col("l_linestatus").alias("status"),
        F.concat(F.lit("http://example.org/x/"), F.col("l_orderkey")).alias("url"),
    )


def refine_results(spark, data_dir):
    out = get_transform("transform_results")(raw_results(spark, data_dir))
    return out.withColumn("race_date", F.col("race_date").cast("string"))


def refine_sprints(spark, data_dir):
    out = get_transform("transform_sprints")(raw_results(spark, data_dir))
    return out.withColumn("race_date", F.col("race_date").cast("string"))


def refine_constructors(spark, data_dir):
    s = table(spark, data_dir, "supplier")
    raw = s.select(
        F.col("s_suppkey").cast("string").alias("constructorId"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("nation-"), F.col("s_nationkey")).alias("nationality"),
        F.concat(F.lit("http://example.org/s/"), F.col("s_suppkey")).alias("url"),
    )
    return get_transform("transform_constructors")(raw)


# ------------------------------------------------------------ column functions


def fn_snake_case(spark, data_dir):
    p = table(spark, data_dir, "part")
    return p.select(
        "p_partkey",
        fn.snake_case("p_name").alias("name_snake"),
        fn.snake_case(F.concat(F.col("p_name"), F.lit("Id"))).alias("name_id_snake"),
        fn.snake_case(F.concat(F.col("p_type"), F.lit("-"), F.col("p_brand"))).alias("type_snake"),
    )


def fn_safe_strip(spark, data_dir):
    d = table(spark, data_dir, "documents")
    padded = (F.when(F.col("lang") == "es", F.lit(" \t \n"))
              .otherwise(F.concat(F.lit(" \t"), F.col("text"), F.lit("\n  "))))
    s = fn.safe_strip(padded)
    return d.select("doc_id", F.md5(s).alias("stripped_md5"),
                    F.length(s).cast("bigint").alias("stripped_len"))


def fn_null_marker(spark, data_dir):
    e = table(spark, data_dir, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit(NULL_MARKER))
           .otherwise(F.col("event_type")))
    return e.select("event_id", fn.replace_null_marker(raw).alias("event_type_clean"))


def fn_truncate(spark, data_dir):
    d = table(spark, data_dir, "documents")
    t = fn.truncate_text("text", 500)
    return d.select("doc_id", F.md5(t).alias("truncated_md5"),
                    F.length(t).cast("bigint").alias("truncated_len"))


def fn_duration(spark, data_dir):
    e = table(spark, data_dir, "events")
    return e.select("event_id", fn.format_duration(F.col("value") * 10).alias("duration"))


# ------------------------------------------------------------ change detection and state


_EPOCH_2024 = 1704067200


def changed_files_query(spark, data_dir):
    d = table(spark, data_dir, "documents")
    path = F.concat(F.lit("file:/landing/doc-"), F.col("doc_id"), F.lit(".txt"))
    mtime = F.timestamp_seconds(F.lit(_EPOCH_2024) + F.col("doc_id"))
    state = d.filter(F.col("lang") != "fr").select(
        path.alias("source_file"), mtime.alias("last_modified_time"),
        F.col("n_chars").alias("file_size"), F.md5("text").alias("content_hash"))
    inventory = d.select(
        path.alias("source_file"),
        F.when(F.col("source") == "src5", mtime + F.expr("INTERVAL 1 SECOND"))
        .otherwise(mtime).alias("last_modified_time"),
        F.when(F.col("lang") == "de", F.col("n_chars") + 1).otherwise(F.col("n_chars"))
        .alias("file_size"),
        F.md5(F.when(F.col("source") == "src3", F.concat("text", F.lit("x"))).otherwise(F.col("text")))
        .alias("content_hash"))
    return chg.changed_files(inventory, state).select("source_file", "file_size", "change_kind")


def _orders_plain(spark, data_dir):
    o = table(spark, data_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
                    "o_orderpriority")


def upsert_state(spark, data_dir):
    """Versioned change batch (updates, second versions, inserts, deletes)
    merged into orders on the order key."""
    o = _orders_plain(spark, data_dir)
    p = F.col("o_orderstatus") == "P"
    v1 = (o.filter(p).withColumn("o_totalprice", F.col("o_totalprice") + 1)
          .withColumn("o_orderstatus", F.lit("F")).withColumn("version", F.lit(1))
          .withColumn("deleted", F.lit(False)))
    v2 = (o.filter(p & (F.col("o_orderpriority") == "1-URGENT"))
          .withColumn("o_totalprice", F.col("o_totalprice") + 2)
          .withColumn("o_orderstatus", F.lit("F")).withColumn("version", F.lit(2))
          .withColumn("deleted", F.lit(False)))
    ins = (o.filter(F.col("o_orderpriority") == "2-HIGH")
           .withColumn("o_orderkey", -F.col("o_orderkey") - 1)
           .withColumn("version", F.lit(1)).withColumn("deleted", F.lit(False)))
    dels = (o.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW"))
            .withColumn("version", F.lit(3)).withColumn("deleted", F.lit(True)))
    changes = v1.unionByName(v2).unionByName(ins).unionByName(dels)
    return chg.upsert(o, changes, "o_orderkey", order_by="version", delete_flag="deleted")


_TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def run_latest(spark, data_dir):
    """Run records as the latest-per-run view over status events."""
    e = table(spark, data_dir, "events")
    status = (F.when(F.col("event_type") == "purchase", "SUCCESS")
              .when(F.col("event_type") == "error", "FAILED").otherwise("RUNNING"))
    events = e.select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.lit("bronze_ingestion").alias("pipeline_name"),
        F.col("event_type").alias("entity_name"),
        status.alias("status"),
        F.col("ts").alias("event_time"),
        F.floor("value").cast("bigint").alias("records_processed"),
        F.lit(None).cast("bigint").alias("files_processed"),
        F.lit(None).cast("string").alias("error_message"),
        "event_id",
    )
    v = runlog.runs_view(events, tiebreak="event_id")
    return v.select(
        "run_id", "status",
        F.date_format("start_time", _TS_FMT).alias("start_time"),
        F.date_format("end_time", _TS_FMT).alias("end_time"),
        "duration_ms", "records_processed", "n_events")


def high_water_query(spark, data_dir):
    """High-water log appended in two batches; the view keeps the maximum."""
    e = table(spark, data_dir, "events").select(
        F.col("event_type").alias("entity_name"), F.col("ts").alias("watermark_value"))
    early = e.filter(F.col("watermark_value") < F.lit("2024-01-04").cast("timestamp_ntz"))
    late = e.filter(~(F.col("watermark_value") < F.lit("2024-01-04").cast("timestamp_ntz")))
    log = late.unionByName(early)  # arrival order must not matter
    hw = chg.high_water(log, "entity_name", "watermark_value")
    return hw.select("entity_name", F.date_format("watermark_value", _TS_FMT).alias("watermark_value"))


def current_rows_query(spark, data_dir):
    """Bronze holding three runs: r1 loads every file, r2 reloads the modified
    files, r3 wrote rows but crashed before committing state."""
    li = table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        F.concat(F.lit("file:/landing/lineitem-"), F.col("l_returnflag"), F.col("l_linestatus"),
                 F.lit(".json")).alias("_source_file"))
    r1 = li.withColumn("_pipeline_run_id", F.lit("r1"))
    r2 = (li.filter(F.col("l_returnflag") == "R")
          .withColumn("l_quantity", F.col("l_quantity") + 100)
          .withColumn("_pipeline_run_id", F.lit("r2")))
    r3 = li.filter(F.col("l_linestatus") == "O").withColumn("_pipeline_run_id", F.lit("r3"))
    bronze = r1.unionByName(r2).unionByName(r3)

    def state_rows(df, run, ts):
        return (df.select("_source_file").distinct().select(
            F.lit("lineitem").alias("entity_name"), F.col("_source_file").alias("source_file"),
            F.lit(run).alias("run_id"), F.lit("LOADED").alias("event"),
            F.lit(ts).cast("timestamp").alias("processed_at")))

    log = state_rows(r1, "r1", "2024-01-01 00:00:00").unionByName(
        state_rows(r2, "r2", "2024-01-02 00:00:00"))
    cur = chg.current_rows(bronze, chg.current_state(log, "lineitem"))
    return cur.drop("_source_file")


# ------------------------------------------------------------ standings


def _cents(c):
    return F.round(F.col(c) * 100).cast("bigint")


def standings_supplier(spark, data_dir):
    """Driver-style standings: suppliers per ship year by net revenue; a
    'win' is a first line of an order."""
    li = table(spark, data_dir, "lineitem")
    net = _cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))
    s = standings(li, F.year("l_shipdate"), "l_suppkey",
                  (F.sum(net) / 10000.0), F.col("l_linenumber") == 1)
    return s.select("season", F.col("member").alias("supplier_key"), "points", "wins", "position")


def standings_customer(spark, data_dir):
    """Customers per order year by order value; a 'win' is an urgent order."""
    o = table(spark, data_dir, "orders")
    s = standings(o, F.year("o_orderdate"), "o_custkey",
                  F.sum(_cents("o_totalprice")) / 100.0, F.col("o_orderpriority") == "1-URGENT")
    return s.select("season", F.col("member").alias("customer_key"), "points", "wins", "position")


def standings_nation(spark, data_dir):
    """Team-style standings: supplier nations per ship year.  Line items are
    pre-aggregated per (year, supplier) before the join, so only that reduced
    table meets the supplier dimension."""
    li = table(spark, data_dir, "lineitem")
    net = _cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))
    per_supp = (li.groupBy(F.year("l_shipdate").alias("season"), "l_suppkey")
                .agg(F.sum(net).alias("net"), F.count_if(F.col("l_linenumber") == 1).alias("w")))
    supp = table(spark, data_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = per_supp.join(supp, "l_suppkey")
    s = (joined.groupBy("season", F.col("s_nationkey").alias("member"))
         .agg((F.sum("net") / 10000.0).alias("points"), F.sum("w").alias("wins")))
    s = rank_desc(s, "season", "points", rank_col="position", method="auto")
    return s.select("season", F.col("member").alias("nation_key"), "points", "wins", "position")


#: Lines of an order are numbered from 1 to 7.
LINE_PLACES = 7


def _supplier_rounds(lines):
    """Suppliers' results: ship years are seasons, months rounds, line numbers positions."""
    return round_results(lines, F.year("l_shipdate"), F.month("l_shipdate"), F.col("l_suppkey"),
                         F.col("l_quantity").cast("bigint"), F.col("l_linenumber"), LINE_PLACES)


def _round_rows(s):
    return s.select("season", "round", F.col("member").alias("supplier_key"), "points",
                    *[F.col("places")[k].alias(f"p{k + 1}") for k in range(LINE_PLACES)], "position")


def standings_rounds(spark, data_dir):
    """Suppliers after every month of a ship year; ties are told apart by the number of
    first lines, then second ones, and so on."""
    return _round_rows(round_standings(_supplier_rounds(table(spark, data_dir, "lineitem")), LINE_PLACES))


def standings_rounds_late(spark, data_dir):
    """The same standings when returned lines of each year's second half come in late:
    made without them first, then computed anew from the first round that they change."""
    lines = table(spark, data_dir, "lineitem")
    late = F.coalesce((F.month("l_shipdate") >= 7) & (F.col("l_returnflag") == "R"), F.lit(False))
    before = scratch_table(round_standings(_supplier_rounds(lines.where(~late)), LINE_PLACES))
    changed = lines.where(late).select(F.year("l_shipdate").alias("season"), F.month("l_shipdate").alias("round"))
    return _round_rows(update_round_standings(before, _supplier_rounds(lines), scratch_table(first_changes(changed)), LINE_PLACES))


# ------------------------------------------------------------ pipelines


ORDERS_RAW_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                  "o_totalprice double, o_orderdate string, o_orderpriority string")
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]
register_schema("orders_raw_schema", ORDERS_RAW_DDL)
register_transform("transform_orders", [
    Field("o_orderkey", "order_id"),
    Field("o_custkey", "customer_id"),
    Field("o_orderstatus", "status"),
    Field("o_totalprice", "total_price"),
    Field("o_orderdate", "order_date", "date"),
    Field("o_orderpriority", "priority"),
])
register_output_checks("orders", ["order_id", "customer_id", "status", "total_price",
                                  "order_date", "priority"],
                       not_null=["order_id"], non_negative=["total_price"])


def _raw_orders(spark, data_dir):
    o = table(spark, data_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                    "o_orderpriority", F.year("o_orderdate").alias("landing_year"))


def land_orders(spark, data_dir, landing, years=None):
    """Raw orders as NDJSON, a folder per order year under ``landing``, its rows in
    files of the advisory partition size (a hot year is split)."""
    raw = _raw_orders(spark, data_dir)
    if years is not None:
        raw = raw.filter(years)
    raw.hint("rebalance", "landing_year").write.mode("append").partitionBy("landing_year").json(landing)


def replace_file(spark, file_uri: str, new_content: DataFrame) -> None:
    """Rewrite one landing file in place (same name, new content): Spark
    writes the new content as a single file, which is renamed over the old one
    (file-system metadata operations only)."""
    tmp = scratch_path(spark, "rewrite")
    new_content.coalesce(1).write.json(tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dst = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file_uri))
    fs = dst.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmp))
             if s.getPath().getName().startswith("part-")]
    fs.delete(dst, False)
    if not fs.rename(parts[0], dst):
        raise RuntimeError(f"could not replace {file_uri}")


def _orders_entity(spark, landing):
    return ctl.entity_config(spark, [(
        "orders", "json", landing, "bronze", "orders", "incremental", "order_year",
        "orders_raw_schema", True, False, "file_tracking", "o_orderdate")])


def _orders_rules(spark):
    v = ctl.rules_table(spark, [
        ("orders", "Order key present", "NOT_NULL", "o_orderkey", None, None, "ERROR", True),
        ("orders", "Raw schema", "SCHEMA", None, None, None, "ERROR", True),
        ("orders", "Known status", "ALLOWED_VALUES", "o_orderstatus", "F,O,P", None, "ERROR", True),
    ])
    dq = ctl.rules_table(spark, [
        ("orders", "Order key unique", "DUPLICATE_KEY", "o_orderkey", None, 0.0, "ERROR", True),
        ("orders", "Exact copies", "DUPLICATE_ROW", None, None, 0.0, "WARNING", True),
        ("orders", "Order date range", "DATE_RANGE", "o_orderdate", "1990-01-01,2030-12-31", None,
         "ERROR", True),
    ])
    return v, dq


def _expect(result, status):
    if result.status != status:
        raise RuntimeError(f"expected {status}, got {result.status} ({result})")
    return result


def ingest_incremental(spark, data_dir):
    """Load, rewrite the files of one year, load again (only those), load a
    third time (nothing changed); the committed rows are the table with the
    rewrite applied."""
    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_orders")
    land_orders(spark, data_dir, landing)
    cfg_df = _orders_entity(spark, landing)
    v, dq = _orders_rules(spark)
    _expect(ingest(spark, lake, "orders", cfg_df, v, dq), "SUCCESS")
    inv = file_inventory(spark, landing, hash_content=False)
    targets = [r[0] for r in inv.filter(F.col("source_file").rlike("landing_year=1997/"))
               .select("source_file").collect()]
    for target in targets:  # one file each, as it was written
        old = readers.read_source(spark, landing, "json", ORDERS_RAW_DDL, files_to_include=[target],
                                  options={"recursiveFileLookup": "true"})
        replace_file(spark, target, old.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    r2 = _expect(ingest(spark, lake, "orders", cfg_df, v, dq), "SUCCESS")
    if r2.files != len(targets):
        raise RuntimeError(f"expected {len(targets)} changed files, got {r2.files}")
    _expect(ingest(spark, lake, "orders", cfg_df, v, dq), "SKIPPED")
    cur = bronze_current(spark, lake, ctl.config_for(cfg_df, "orders"))
    return cur.select(*ORDER_COLS, "order_year")


def refine_orders(spark, data_dir):
    """Ingest, then refine the committed bronze rows with a registered
    projection spec and the output checks."""
    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_orders")
    land_orders(spark, data_dir, landing)
    cfg_df = _orders_entity(spark, landing)
    v, dq = _orders_rules(spark)
    _expect(ingest(spark, lake, "orders", cfg_df, v, dq), "SUCCESS")
    refine_cfg = ctl.refine_config(spark, [
        ("orders", "bronze", "orders", "silver", "orders", "transform_orders", "overwrite", True)])
    out = refine(spark, lake, "orders", refine_cfg, cfg_df)
    return out.drop("_processed_ts", "_pipeline_run_id").withColumn(
        "order_date", F.col("order_date").cast("string"))


def refine_managed(spark, data_dir):
    """An entity whose bronze table has another name, refined twice into a catalog
    table in append mode; read back through the table's name."""
    import uuid

    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_orders")
    land_orders(spark, data_dir, landing)
    cfg_df = _orders_entity(spark, landing).withColumn("target_table", F.lit("orders_raw"))
    _expect(ingest(spark, lake, "orders", cfg_df), "SUCCESS")
    name = f"orders_{uuid.uuid4().hex[:8]}"
    refine_cfg = ctl.refine_config(spark, [
        ("orders", "bronze", "orders_raw", "silver", name, "transform_orders", "append", True)])
    for _ in range(2):
        refine(spark, lake, "orders", refine_cfg, cfg_df, catalog=True)
    return (spark.table(f"silver.{name}").groupBy("status", "priority")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("order_id").alias("n_orders"),
                 F.countDistinct("_pipeline_run_id").alias("n_runs")))


def ingest_recovery(spark, data_dir):
    """What each run of a troubled entity recorded: first load, reload after the
    target was dropped, reload after a state reset, an empty new file, a file that
    fails a rule; and the rows that are visible after it."""
    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_orders")
    land_orders(spark, data_dir, landing)
    cfg_df = _orders_entity(spark, landing)
    cfg = ctl.config_for(cfg_df, "orders")
    v, _ = _orders_rules(spark)

    def seen():
        return bronze_current(spark, lake, cfg).count()

    rows = []

    def run(step):
        try:
            ingest(spark, lake, "orders", cfg_df, v)
        except Exception:  # noqa: BLE001 - recorded by the run itself
            pass
        last = lake.runs(spark).orderBy(F.desc("start_time")).first()
        rows.append((step, last["status"], last["records_processed"], last["error_message"], seen()))

    run("first load")
    sinks.remove_path(spark, lake.table_path(cfg["target_schema"], cfg["target_table"]))
    run("target dropped")
    reset_state(spark, lake, "orders")
    run("state reset")
    sinks.write_table(spark.range(1).selectExpr("'' AS value").repartition(1), f"{landing}/landing_year=1", fmt="text")
    run("empty file")
    bad = _raw_orders(spark, data_dir).filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.lit(None).cast("bigint"))
    bad.drop("landing_year").write.json(f"{landing}/landing_year=2")
    run("bad file")
    return sinks.literal_rows(spark, rows, "step string, status string, records bigint, error string, visible bigint")


def rule_toggle(spark, data_dir):
    """The enabled rules' results before and after one rule is switched off."""
    li = table(spark, data_dir, "lineitem")
    rules = ctl.rules_table(spark, [
        ("li", "Returns", "ALLOWED_VALUES", "l_returnflag", "A,N", None, "ERROR", True),
        ("li", "Discount", "NUMERIC_RANGE", "l_discount", "0,0.05", None, "WARNING", True)])
    off = ctl.set_rule_enabled(rules, "li", "Returns", False)
    on = ctl.set_rule_enabled(off, "li", "Returns", True)
    states = [(name, load_rules(table_, "li")) for name, table_ in (("on", rules), ("off", off), ("on again", on))]
    out = None
    for name, enabled in states:
        part = quality_report(li, enabled).withColumn("state", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def check_duplicate_event(spark, data_dir):
    """Events and a copy of those of one type a microsecond later: fingerprints tell them apart."""
    events = table(spark, data_dir, "events")
    purchases = events.filter("event_type = 'purchase'")
    later = purchases.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MICROSECOND"))
    rows = events.unionByName(later).unionByName(purchases)
    return quality_report(rows, [Rule("DUPLICATE_ROW", value="fingerprint")]).unionByName(
        quality_report(rows, [Rule("DUPLICATE_ROW", severity="ERROR")]))


def stream_ingest_query(spark, data_dir):
    """Two arrival waves through the streaming ingest; the second run reads
    only the files that arrived after the first."""
    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_orders")
    early = F.col("landing_year") < 1998
    land_orders(spark, data_dir, landing, early)
    cfg = ctl.config_for(_orders_entity(spark, landing), "orders")
    v, _ = _orders_rules(spark)
    stream_ingest(spark, lake, cfg, v, stream_name="orders")
    land_orders(spark, data_dir, landing, ~early)
    stream_ingest(spark, lake, cfg, v, stream_name="orders")
    cur = bronze_current(spark, lake, cfg)
    return cur.select(*ORDER_COLS, "order_year")


register_schema("events_raw_schema", "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")


def stream_keys(spark, data_dir):
    """Events arriving in three runs, some of them late, through a stream that
    remembers (user, type) for six hours of event time: what became of each event."""
    lake = ctl.Lakehouse(scratch_path(spark, "lake"))
    landing = scratch_path(spark, "landing_events")
    events = table(spark, data_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    held, day = F.col("event_id") % 10, F.dayofmonth("ts")
    run = (F.when(held == 9, 2).when((held == 8) | (day > 10), F.when(day > 20, 2).otherwise(1)).otherwise(0))
    cfg = ctl.config_for(ctl.entity_config(spark, [(
        "events", "json", landing, "bronze", "events", "incremental", None,
        "events_raw_schema", True, False, "file_tracking", None)]), "events")
    keyed = KeyedStream(("user_id", "event_type"), "ts", "12 days", 6 * 3_600_000, ("event_id",),
                        (Rule("NUMERIC_RANGE", "value", "1,1000"),))
    for r in range(3):
        events.filter(run == r).write.json(f"{landing}/run={r}")
        stream_ingest(spark, lake, cfg, stream_name="events", keyed=keyed)
    loaded = bronze_current(spark, lake, cfg).select("event_id", F.lit("ok").alias("verdict"))
    return loaded.unionByName(quarantined_rows(spark, lake, cfg).select("event_id", F.col("_verdict").alias("verdict")))


def check_required_columns(spark, data_dir):
    li = table(spark, data_dir, "lineitem").drop("l_tax")
    return quality_report(li, [
        Rule("REQUIRED_COLUMN", expected=("l_orderkey", "l_linenumber", "l_quantity")),
        Rule("REQUIRED_COLUMN", expected=("l_orderkey", "l_tax", "l_discount")),
        Rule("NON_NEGATIVE", "l_quantity"),
    ])


def check_referential(spark, data_dir):
    orders = table(spark, data_dir, "orders")
    customer = table(spark, data_dir, "customer")
    li = table(spark, data_dir, "lineitem")
    labels = table(spark, data_dir, "labels")
    docs = table(spark, data_dir, "documents")
    return (referential_report(orders, "o_custkey", customer, "c_custkey")
            .unionByName(referential_report(li, "l_orderkey", orders, "o_orderkey"))
            .unionByName(referential_report(docs, "doc_id", labels, "doc_id", severity="WARNING")))


def check_duplicate_row_fingerprint(spark, data_dir):
    """Whole documents table: copies of a text (key rule on the text itself)
    and exact duplicate rows grouped by a 16-byte row fingerprint instead of
    shuffling up to 20,000-word texts."""
    docs = table(spark, data_dir, "documents")
    return quality_report(docs, [
        Rule("DUPLICATE_ROW", value="fingerprint"),
        Rule("DUPLICATE_KEY", "text", severity="WARNING"),
        Rule("DUPLICATE_KEY", "source, lang", severity="WARNING"),
    ])


# ------------------------------------------------------------ the seeded layers end to end


#: Text is many times as large as the tables it is made of.  A compressed file, and a JSON
#: array, is read by one task; so files hold a bounded number of rows.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 250_000}


def land_seeded_entities(spark, data_dir, landing: str) -> None:
    """The six raw entities, in their configured formats, derived from the
    test tables (keys unique where the seeded key rules demand it)."""
    cust = table(spark, data_dir, "customer")
    supp = table(spark, data_dir, "supplier")
    part = table(spark, data_dir, "part")
    orders = table(spark, data_dir, "orders")
    li = table(spark, data_dir, "lineitem")

    def url(kind, c):
        return F.concat(F.lit(f"http://example.org/{kind}/"), F.col(c))

    cust.select(
        F.col("c_custkey").cast("string").alias("circuitId"), url("c", "c_custkey").alias("url"),
        F.col("c_name").alias("circuitName"), F.col("c_acctbal").cast("string").alias("lat"),
        F.col("c_nationkey").cast("string").alias("long"), F.col("c_mktsegment").alias("locality"),
        F.concat(F.lit("nation-"), F.col("c_nationkey")).alias("country"),
    ).write.options(header=True, **LANDED).csv(f"{landing}/circuits")
    supp.select(
        F.col("s_suppkey").cast("string").alias("constructorId"), F.col("s_name").alias("name"),
        F.concat(F.lit("nation-"), F.col("s_nationkey")).alias("nationality"),
        url("s", "s_suppkey").alias("url"),
    ).write.options(**LANDED).json(f"{landing}/constructors")
    part.select(
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("p_size") * 200),
                      "yyyy-MM-dd").alias("dateOfBirth"),
        F.col("p_partkey").cast("string").alias("driverId"),
        F.struct(F.col("p_brand").alias("familyName"), F.col("p_name").alias("givenName")).alias("name"),
        F.col("p_type").alias("nationality"), url("p", "p_partkey").alias("url"),
    ).write.options(**LANDED).json(f"{landing}/drivers")
    (orders.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
     .agg(F.min("o_orderdate").alias("d"), F.min("o_custkey").alias("c"))
     .select(F.col("y").cast("string").alias("season"), F.col("m").cast("string").alias("round"),
             F.concat(F.lit("http://example.org/r/"), F.col("y"), F.lit("-"), F.col("m")).alias("url"),
             F.concat(F.lit("Race "), F.col("y"), F.lit("-"), F.col("m")).alias("raceName"),
             F.date_format("d", "yyyy-MM-dd").alias("date"), F.col("c").cast("string").alias("circuitId"))
     .write.option("header", True).csv(f"{landing}/races"))
    results = orders.select(
        F.col("o_custkey").cast("string").alias("constructorId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").cast("string").alias("driverId"),
        (F.col("o_orderkey") % 20).alias("grid"), F.lit(50).cast("bigint").alias("laps"),
        F.col("o_orderkey").alias("number"), (F.col("o_totalprice") / 1000).alias("points"),
        ((F.col("o_orderkey") % 20) + 1).alias("position"),
        F.col("o_orderstatus").alias("positionText"), F.col("o_orderpriority").alias("raceName"),
        F.month("o_orderdate").cast("bigint").alias("round"),
        F.year("o_orderdate").cast("bigint").alias("season"),
        F.col("o_orderstatus").alias("status"), url("o", "o_orderkey").alias("url"))
    arrays = {"file_rows": LANDED["maxRecordsPerFile"], "compression": LANDED["compression"]}
    sinks.write_json_arrays(results, f"{landing}/results", **arrays)
    sprints = li.select(
        F.col("l_partkey").cast("string").alias("constructorId"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_suppkey").cast("string").alias("driverId"),
        F.col("l_linenumber").cast("bigint").alias("grid"),
        F.col("l_quantity").cast("bigint").alias("laps"), F.col("l_orderkey").alias("number"),
        F.col("l_extendedprice").alias("points"), F.col("l_linenumber").cast("bigint").alias("position"),
        F.col("l_returnflag").alias("positionText"), F.col("l_linestatus").alias("raceName"),
        F.month("l_shipdate").cast("bigint").alias("round"),
        F.year("l_shipdate").cast("bigint").alias("season"),
        F.col("l_linestatus").alias("status"), url("l", "l_orderkey").alias("url"))
    sinks.write_json_arrays(sprints, f"{landing}/sprints", **arrays)


def seeded_layers(spark, data_dir):
    """All six seeded entities through ingest (parallel) and refine with the
    seeded configuration, rules and transforms; one summary row per entity."""
    landing = scratch_path(spark, "landing_seeded")
    land_seeded_entities(spark, data_dir, landing)
    eng = Engine.seeded(spark, scratch_path(spark, "lake_seeded"), landing)
    bronze = {r.entity_name: r for r in eng.ingest_all(parallelism=3).collect()}
    sinks.remove_path(spark, landing)  # a scratch copy; the refined layer is made from bronze
    refined = {r.entity_name: r.status for r in eng.refine_all(parallelism=3).collect()}
    rows = []
    for entity in sorted(bronze):
        n = eng.refined(entity).count() if refined.get(entity) == "SUCCESS" else 0
        rows.append((entity, bronze[entity].status, bronze[entity].records, n))
    return sinks.literal_rows(spark, rows, "entity_name string, bronze_status string, "
                                           "bronze_records bigint, refined_rows bigint")



def gold_driver_standings(spark, data_dir):
    """Driver standings over refined results (points = whole laps, so sums
    are exact); a win is a first position."""
    raw = raw_results(spark, data_dir)
    refined = get_transform("transform_results")(
        raw.withColumn("points", F.col("laps").cast("double")))
    return driver_standings(refined)


def gold_constructor_standings(spark, data_dir):
    """Constructor standings over the same refined results."""
    raw = raw_results(spark, data_dir)
    refined = get_transform("transform_results")(
        raw.withColumn("points", F.col("laps").cast("double")))
    return constructor_standings(refined)


# ------------------------------------------------------------ keys across runs, histories


def check_keys_across_runs(spark, data_dir):
    """Lineitems loaded year by year: per load, the order keys that earlier loads hold
    already, found through the loads' key filters and looked up in these loads only."""
    rows = table(spark, data_dir, "lineitem").select("l_orderkey", F.concat(F.lit("year-"), F.year("l_shipdate")).alias("_pipeline_run_id"))
    keys = ["l_orderkey"]
    sizes = {r[0]: keyfilter.filter_blocks(r[1]) for r in rows.groupBy("_pipeline_run_id").count().collect()}  # one a load
    filters, found = None, None
    for run in sorted(sizes):
        load = rows.filter(F.col("_pipeline_run_id") == run)
        if filters is not None:
            earlier = rows.filter(F.col("_pipeline_run_id") < run)
            candidates = keyfilter.possible_keys(load, keys, filters, [b for r, b in sizes.items() if r < run])
            repeated = keyfilter.repeated_keys(candidates, earlier, keys)
            mine = load.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            part = mine.join(repeated, keys).agg(
                F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_records"), F.sum("n_earlier").alias("n_earlier"),
                F.min("first_run").alias("first_run")).filter("n_keys > 0").withColumn("run_id", F.lit(run))
            found = part if found is None else found.unionByName(part)
        made = scratch_table(keyfilter.key_filter(load, keys, sizes[run]).withColumn("run_id", F.lit(run)))
        filters = made if filters is None else filters.unionByName(made)
    if found is None:
        return spark.createDataFrame([], "run_id string, n_keys bigint, n_records bigint, n_earlier bigint, first_run string")
    return found.select("run_id", "n_keys", "n_records", "n_earlier", "first_run")


def _order_changes(spark, data_dir):
    """Orders as changes of their customer: status and priority, some of them deletions."""
    sets = {0: ["o_orderstatus"], 1: ["o_orderpriority"], 2: ["o_orderstatus", "o_orderpriority"]}
    chosen = F.coalesce(*[F.when(F.col("o_orderkey") % 3 == k, F.array(*map(F.lit, v))) for k, v in sets.items()])
    return table(spark, data_dir, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_orderstatus", "o_orderpriority",
        chosen.alias("sets"), ((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 4 == 0)).alias("gone"))


def _order_history(spark, data_dir, set_column):
    """Three batches that overlap in time and come out of order."""
    changes, found = _order_changes(spark, data_dir), None
    for batch in (2, 0, 1):
        part = changes.filter(F.floor(F.col("o_orderkey") / 7) % 3 == batch)
        found = scratch_table(history.apply_changes(
            found, part, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "day", "o_orderkey", set_column, "gone"))
    return found


def history_intervals(spark, data_dir):
    """What held of each customer, and when (whole-row changes)."""
    return history.intervals(_order_history(spark, data_dir, None), ["o_custkey"], ["o_orderstatus", "o_orderpriority"])


def history_columns(spark, data_dir):
    """Each change of a customer with the values that hold after it (column-wise changes)."""
    return _order_history(spark, data_dir, "sets").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", "valid_from", "seq", "valid_to", "deleted")
