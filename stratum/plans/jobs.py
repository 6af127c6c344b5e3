"""Layer runners: ingest (or refine) every active entity of a configuration.

Entities are independent, so with ``parallelism > 1`` their pipelines are
submitted from a small thread pool and their Spark jobs share the cluster
(use the FAIR scheduler to interleave them).  A failing entity is recorded and
does not stop the others; the summary comes back as a DataFrame.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans.control import Lakehouse
from stratum.plans.ingest import ingest
from stratum.plans.refine import refine
from stratum.sources.sinks import literal_rows

SUMMARY_DDL = ("entity_name string, status string, run_id string, records bigint, files bigint, "
               "error string")


def active_entities(config_df: DataFrame) -> list[str]:
    """Names of the active entities (configuration rows: small)."""
    rows = (config_df.filter(F.coalesce(F.col("active"), F.lit(True)))
            .select("entity_name").orderBy("entity_name").collect())
    return [r[0] for r in rows]


def _run_all(spark: SparkSession, names: list[str], fn, parallelism: int) -> DataFrame:
    def one(name):
        try:
            return fn(name)
        except Exception as exc:  # noqa: BLE001 - reported per entity
            return (name, "FAILED", None, 0, 0, str(exc))

    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(one, names))
    else:
        rows = [one(n) for n in names]
    return literal_rows(spark, rows, SUMMARY_DDL)


def run_bronze_layer(spark: SparkSession, lake: Lakehouse, config_df: DataFrame,
                     validation_rules: DataFrame | None = None,
                     dq_rules: DataFrame | None = None,
                     entities: list[str] | None = None, parallelism: int = 1,
                     **ingest_options) -> DataFrame:
    """Ingest each entity; ``ingest_options`` go to :func:`ingest`
    (``trust_metadata``, ``references``, ...)."""
    names = entities or active_entities(config_df)

    def fn(name):
        r = ingest(spark, lake, name, config_df, validation_rules, dq_rules, **ingest_options)
        return (name, r.status, r.run_id, r.records, r.files, None)

    return _run_all(spark, names, fn, parallelism)


def run_refine_layer(spark: SparkSession, lake: Lakehouse, refine_config_df: DataFrame,
                     bronze_config_df: DataFrame, entities: list[str] | None = None,
                     parallelism: int = 1) -> DataFrame:
    names = entities or active_entities(refine_config_df)

    def fn(name):
        out = refine(spark, lake, name, refine_config_df, bronze_config_df)
        return (name, "SKIPPED" if out is None else "SUCCESS", None, 0, 0, None)

    return _run_all(spark, names, fn, parallelism)
