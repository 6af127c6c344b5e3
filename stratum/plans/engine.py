"""One object bundling a lakehouse root with its configuration and rule
tables, so a pipeline step is a one-line call::

    eng = Engine.seeded(spark, root="<lake root>", landing="s3://raw/landing")
    eng.ingest("results")          # raw -> bronze, checks, state commit
    eng.refine("results")          # bronze -> refined, output checks
    eng.runs().show()              # run records
    eng.bronze("results")          # committed bronze rows

The configuration and rule tables are ordinary DataFrames (seeded, read
from a catalog table, or built by the caller).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratum.plans import control as ctl
from stratum.plans.ingest import IngestResult, bronze_current, ingest
from stratum.plans.jobs import run_bronze_layer, run_refine_layer
from stratum.plans.refine import refine, refined_current


@dataclass
class Engine:
    spark: SparkSession
    lake: ctl.Lakehouse
    entities: DataFrame
    refine_entities: DataFrame | None = None
    validation_rules: DataFrame | None = None
    dq_rules: DataFrame | None = None

    @classmethod
    def seeded(cls, spark: SparkSession, root: str, landing: str) -> Engine:
        """Engine over the seeded entity, rule and refine configuration."""
        return cls(spark, ctl.Lakehouse(root), ctl.seed_entity_config(spark, landing),
                   ctl.seed_refine_config(spark), ctl.seed_validation_rules(spark),
                   ctl.seed_dq_rules(spark))

    def _configs(self) -> dict:
        if getattr(self, "_config_cache", None) is None:
            self._config_cache = ctl.configs_by_entity(self.entities)  # one collect
        return self._config_cache

    def ingest(self, entity: str, **options) -> IngestResult:
        """``options``: ``trust_metadata``, ``hash_content``,
        ``references`` (tables of REFERENTIAL rules)."""
        return ingest(self.spark, self.lake, entity, self._configs(), self.validation_rules,
                      self.dq_rules, **options)

    def refine(self, entity: str) -> DataFrame | None:
        if self.refine_entities is None:
            raise ValueError("no refine configuration")
        return refine(self.spark, self.lake, entity, self.refine_entities, self.entities)

    def refined(self, entity: str) -> DataFrame | None:
        """Committed rows of a refined entity, None before its first run."""
        return refined_current(self.spark, self.lake, ctl.config_for(self.refine_entities, entity))

    def ingest_all(self, parallelism: int = 1, **options) -> DataFrame:
        return run_bronze_layer(self.spark, self.lake, self.entities, self.validation_rules,
                                self.dq_rules, parallelism=parallelism, **options)

    def refine_all(self, parallelism: int = 1) -> DataFrame:
        return run_refine_layer(self.spark, self.lake, self.refine_entities, self.entities,
                                parallelism=parallelism)

    def bronze(self, entity: str) -> DataFrame:
        return bronze_current(self.spark, self.lake, ctl.config_for(self._configs(), entity))

    def runs(self) -> DataFrame:
        return self.lake.runs(self.spark)

    def results(self, stage: str | None = None) -> DataFrame:
        return self.lake.results(self.spark, stage)

    def audit(self) -> DataFrame:
        return self.lake.audit(self.spark)

    def watermarks(self) -> DataFrame:
        return self.lake.watermarks(self.spark)

    def vacuum(self, entity: str, retain_hours: float = 168.0) -> list[str]:
        """Drop bronze run folders no longer referenced by the current state."""
        from stratum.plans.ingest import vacuum_bronze

        return vacuum_bronze(self.spark, self.lake, ctl.config_for(self._configs(), entity),
                             retain_hours)

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp views for SQL: control logs, configuration and rule tables,
        and ``bronze_<entity>`` (committed rows) for every configured entity;
        also registers the SQL column functions (``snake_case``, ...)."""
        from stratum.functions.sql import register_sql_functions

        register_sql_functions(self.spark)
        names = self.lake.register_views(self.spark, prefix)
        tables = {"entity_config": self.entities, "silver_entity_config": self.refine_entities,
                  "validation_rules": self.validation_rules, "dq_rules": self.dq_rules}
        for name, df in tables.items():
            if df is not None:
                df.createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        from stratum.sources.sinks import path_exists

        for entity, cfg in self._configs().items():
            if path_exists(self.spark, self.lake.table_path(cfg["target_schema"], cfg["target_table"])):
                self.bronze(entity).createOrReplaceTempView(f"{prefix}bronze_{entity}")
                names.append(f"{prefix}bronze_{entity}")
        return names

    def reset(self, entity: str) -> None:
        from stratum.plans.ingest import reset_state

        reset_state(self.spark, self.lake, entity)
