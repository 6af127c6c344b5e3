"""stratum: metadata-driven layered tables on Spark.

Sub-packages:

* ``sources``   — scans (CSV / NDJSON / JSON array / binary file inventory),
  sinks and the named-schema registry;
* ``operators`` — rule compiler, projections, change detection, upsert,
  latest-per-key views, standings;
* ``functions`` — JVM-side column functions;
* ``plans``     — control tables, run/audit/high-water logs, ingest and refine
  pipelines;
* ``streaming`` — incremental file ingestion with Structured Streaming.
"""

__version__ = "0.1.0"
