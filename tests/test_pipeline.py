"""End-to-end runs of the ingest / refine pipelines on real files in a fresh
temp folder (first load, no change, touched file, same-size rewrite, dropped
target, failing check, zero rows, bad config, crash before commit)."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError, ValidationError
from stratum.plans import control as ctl
from stratum.plans.ingest import bronze_current, ingest
from stratum.plans.refine import refine
from stratum.plans.runlog import runs_view


def result_rows(season, rnd, n, points=1.0):
    return [{"constructorId": f"c{i % 3}", "date": f"{season}-03-0{rnd}", "driverId": f"d{i}",
             "grid": i, "laps": 50, "number": i, "points": points, "position": i + 1,
             "positionText": str(i + 1), "raceName": "GP", "round": rnd, "season": season,
             "status": "Finished", "url": "http://x"} for i in range(n)]


def write_array(path, rows):
    with open(path, "w") as f:
        json.dump(rows, f, indent=1)


@pytest.fixture()
def setup(spark, tmp_path):
    landing = tmp_path / "landing" / "results"
    landing.mkdir(parents=True)
    write_array(landing / "r2023_1.json", result_rows(2023, 1, 5))
    write_array(landing / "r2024_1.json", result_rows(2024, 1, 4))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.seed_entity_config(spark, str(tmp_path / "landing"))
    return lake, cfg, landing


def statuses(spark, lake):
    return {r.run_id: r.status for r in runs_view(lake.read_log(spark, "pipeline_runs")).collect()}


def test_incremental_lifecycle(spark, setup):
    lake, cfg, landing = setup
    v, dq = ctl.seed_validation_rules(spark), ctl.seed_dq_rules(spark)
    r1 = ingest(spark, lake, "results", cfg, v, dq)
    assert (r1.status, r1.records, r1.files) == ("SUCCESS", 9, 2)
    r2 = ingest(spark, lake, "results", cfg, v, dq)
    assert r2.status == "SKIPPED"
    # same-size rewrite of one file (content changes, size does not)
    time.sleep(1.1)
    write_array(landing / "r2024_1.json", result_rows(2024, 1, 4, points=2.0))
    r3 = ingest(spark, lake, "results", cfg, v, dq)
    assert (r3.status, r3.files, r3.records) == ("SUCCESS", 1, 4)
    cur = bronze_current(spark, lake, ctl.config_for(cfg, "results"))
    got = {(r.season, r.points) for r in cur.select("season", "points").distinct().collect()}
    assert got == {(2023, 1.0), (2024, 2.0)}
    assert cur.count() == 9
    assert {r.race_year for r in cur.select("race_year").distinct().collect()} == {2023, 2024}
    runs = statuses(spark, lake)
    assert sorted(runs.values()) == ["SKIPPED", "SUCCESS", "SUCCESS"]
    view = runs_view(lake.read_log(spark, "pipeline_runs")).filter(F.col("status") == "SUCCESS")
    assert all(r.duration_ms is not None and r.duration_ms >= 0 for r in view.collect())
    wm = lake.watermarks(spark).first()
    assert wm.entity_name == "results" and wm.watermark_value is not None
    assert lake.results(spark, "dq").count() > 0
    audit = lake.audit(spark).collect()
    assert sorted(r.record_count for r in audit) == [4, 9]


def test_load_in_rounds(spark, setup, monkeypatch):
    """Files are loaded a few at a time; what is committed is the same."""
    import gzip

    from stratum.plans import ingest as steps

    lake, cfg, landing = setup
    for k in range(3):
        (landing / f"z{k}.json.gz").write_bytes(gzip.compress(json.dumps(result_rows(2020 + k, 2, 3 + k)).encode()))
    written, write = [], steps.write_table
    monkeypatch.setattr(steps, "ROUND_BYTES", 1)
    monkeypatch.setattr(steps, "write_table", lambda df, path, mode, *a, **b: written.append(mode) or write(df, path, mode, *a, **b))
    r = ingest(spark, lake, "results", cfg, ctl.seed_validation_rules(spark), ctl.seed_dq_rules(spark))
    assert (r.status, r.records, r.files) == ("SUCCESS", 21, 5)
    assert written == ["overwrite"] + ["append"] * 4
    cur = bronze_current(spark, lake, ctl.config_for(cfg, "results"))
    got = {(x.race_year, x.n) for x in cur.groupBy("race_year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(2020, 3), (2021, 4), (2022, 5), (2023, 5), (2024, 4)}
    assert cur.select("_ingestion_ts", "_pipeline_run_id").distinct().count() == 1
    assert ingest(spark, lake, "results", cfg).status == "SKIPPED"


def test_seeded_landing_is_small(spark, tmp_path):
    """The landed text is many times as large as its tables, unless it is compressed."""
    from stratum.plans.queries import land_seeded_entities

    data, n = tmp_path / "data", 4000
    day = "timestamp'1995-01-01' + make_interval(0, 0, 0, id % 900)"
    made = {
        "customer": "id as c_custkey, concat('c', id) as c_name, 1.5 as c_acctbal, id % 5 as c_nationkey, 'X' as c_mktsegment",
        "supplier": "id as s_suppkey, concat('s', id) as s_name, id % 5 as s_nationkey",
        "part": "id as p_partkey, 'B' as p_brand, 'N' as p_name, 'T' as p_type, cast(id % 50 as int) as p_size",
        "orders": f"id as o_orderkey, id % 99 as o_custkey, {day} as o_orderdate, id / 7 as o_totalprice, 'O' as o_orderstatus, '1-URGENT' as o_orderpriority",
        "lineitem": f"id as l_orderkey, id % 77 as l_partkey, id % 55 as l_suppkey, cast(id % 7 as int) as l_linenumber, {day} as l_shipdate, "
                    "cast(id % 50 as double) as l_quantity, id / 3 as l_extendedprice, 'N' as l_returnflag, 'O' as l_linestatus",
    }
    for name, columns in made.items():
        spark.sql(f"select {columns} from range({n})").write.parquet(str(data / f"{name}.parquet"))
    landing = tmp_path / "landing"
    land_seeded_entities(spark, str(data), str(landing))
    files = [f for f in landing.rglob("part-*") if "races" not in str(f)]
    assert {f.suffix for f in files} == {".gz"}
    assert sum(f.stat().st_size for f in (landing / "sprints").glob("part-*")) < 60 * n  # 230 bytes a row of text
    text = spark.read.schema("number bigint").json(str(landing / "sprints"), multiLine=True)
    assert text.select("number").distinct().count() == n


def test_new_file_only(spark, setup):
    lake, cfg, landing = setup
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    write_array(landing / "r2024_2.json", result_rows(2024, 2, 3))
    r = ingest(spark, lake, "results", cfg)
    assert (r.files, r.records) == (1, 3)
    assert bronze_current(spark, lake, ctl.config_for(cfg, "results")).count() == 12


def test_dropped_target_resets_state(spark, setup):
    import shutil

    lake, cfg, landing = setup
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    shutil.rmtree(lake.table_path("bronze", "results"))
    r = ingest(spark, lake, "results", cfg)
    assert (r.status, r.files) == ("SUCCESS", 2)
    assert bronze_current(spark, lake, ctl.config_for(cfg, "results")).count() == 9


def test_failed_validation_writes_nothing(spark, setup):
    lake, cfg, landing = setup
    write_array(landing / "bad.json", [{**result_rows(2024, 3, 1)[0], "driverId": None}])
    with pytest.raises(ValidationError):
        ingest(spark, lake, "results", cfg, ctl.seed_validation_rules(spark))
    target = lake.table_path("bronze", "results")
    assert not os.path.exists(target) or not [
        d for d in os.listdir(target) if d.startswith("_pipeline_run_id=")]
    assert "FAILED" in statuses(spark, lake).values()
    assert lake.read_log(spark, "ingestion_state").filter(F.col("event") == "LOADED").count() == 0
    res = lake.results(spark, "validation").filter(~F.col("passed")).collect()
    assert [(r.rule_name, r.rule_label) for r in res] == [
        ("driverId Not Null Validation", "Driver ID Required")]


def test_failed_dq_does_not_commit(spark, setup):
    lake, cfg, landing = setup
    write_array(landing / "dup.json", result_rows(2023, 1, 1))  # same (season, round, driverId)
    with pytest.raises(ValidationError):
        ingest(spark, lake, "results", cfg, None, ctl.seed_dq_rules(spark))
    assert bronze_current(spark, lake, ctl.config_for(cfg, "results")).count() == 0


def test_zero_rows_skipped(spark, setup):
    lake, cfg, landing = setup
    for f in os.listdir(landing):
        write_array(landing / f, [])
    r = ingest(spark, lake, "results", cfg)
    assert r.status == "SKIPPED"
    assert lake.read_log(spark, "ingestion_state").filter(F.col("event") == "LOADED").count() == 0


def test_bad_config(spark, setup, tmp_path):
    lake, cfg, landing = setup
    with pytest.raises(ConfigurationError):
        ingest(spark, lake, "unknown_entity", cfg)
    stream_cfg = cfg.withColumn("load_type", F.lit("streaming"))
    with pytest.raises(ConfigurationError):
        ingest(spark, lake, "results", stream_cfg)
    inactive = cfg.withColumn("active", F.lit(False))
    assert ingest(spark, lake, "results", inactive).status == "SKIPPED"


def test_crash_between_write_and_commit_hides_rows(spark, setup):
    lake, cfg, landing = setup
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    # a run that wrote its folder but died before the state commit
    target = lake.table_path("bronze", "results")
    ghost = spark.read.parquet(target).drop("_pipeline_run_id").limit(3)
    ghost.write.partitionBy("race_year").parquet(f"{target}/_pipeline_run_id=run-ghost")
    assert spark.read.parquet(target).count() == 12
    assert bronze_current(spark, lake, ctl.config_for(cfg, "results")).count() == 9


def test_full_load_and_refine(spark, tmp_path):
    landing = tmp_path / "landing" / "circuits"
    landing.mkdir(parents=True)
    (landing / "c.csv").write_text(
        "circuitId,url,circuitName,lat,long,locality,country\n"
        "monza,http://m,Monza,45.6,9.28,Monza,Italy\nspa,http://s,Spa,\\N,5.97,Spa,Belgium\n")
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.seed_entity_config(spark, str(tmp_path / "landing"))
    v = ctl.seed_validation_rules(spark)
    assert ingest(spark, lake, "circuits", cfg, v).status == "SUCCESS"
    (landing / "c.csv").write_text(
        "circuitId,url,circuitName,lat,long,locality,country\nmonza,http://m,Monza,45.6,9.28,Monza,Italy\n")
    assert ingest(spark, lake, "circuits", cfg, v).status == "SUCCESS"
    cur = bronze_current(spark, lake, ctl.config_for(cfg, "circuits"))
    assert cur.count() == 1  # a full load replaces the previous one
    out = refine(spark, lake, "circuits", ctl.seed_refine_config(spark), cfg)
    row = out.first()
    assert (row.circuit_id, row.latitude, row.longitude) == ("monza", 45.6, 9.28)
    assert out.columns[:7] == ["circuit_id", "circuit_name", "latitude", "longitude", "locality",
                               "country", "url"]


def test_layer_runner(spark, tmp_path):
    from stratum.plans.jobs import run_bronze_layer, run_refine_layer

    root = tmp_path / "landing"
    (root / "circuits").mkdir(parents=True)
    (root / "circuits" / "c.csv").write_text(
        "circuitId,url,circuitName,lat,long,locality,country\nmonza,http://m,Monza,45.6,9.28,Monza,Italy\n")
    (root / "constructors").mkdir()
    (root / "constructors" / "c.json").write_text(
        '{"constructorId": "ferrari", "name": "Ferrari", "nationality": "Italian", "url": "u"}\n')
    (root / "results").mkdir()
    write_array(root / "results" / "r.json", result_rows(2024, 1, 3))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.seed_entity_config(spark, str(root))
    summary = {r.entity_name: r for r in run_bronze_layer(
        spark, lake, cfg, ctl.seed_validation_rules(spark), ctl.seed_dq_rules(spark),
        entities=["circuits", "constructors", "results", "drivers"], parallelism=2).collect()}
    assert summary["circuits"].status == "SUCCESS" and summary["results"].records == 3
    assert summary["drivers"].status == "FAILED"  # no landing folder for drivers
    ref = {r.entity_name: r.status for r in run_refine_layer(
        spark, lake, ctl.seed_refine_config(spark), cfg,
        entities=["circuits", "constructors", "results"]).collect()}
    assert ref == {"circuits": "SUCCESS", "constructors": "SUCCESS", "results": "SUCCESS"}


def test_log_compaction(spark, setup):
    lake, cfg, landing = setup
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    assert ingest(spark, lake, "results", cfg).status == "SKIPPED"
    before = {r.run_id: r.status for r in lake.runs(spark).collect()}
    n = lake.compact(spark, "pipeline_runs")
    assert n >= 4
    assert {r.run_id: r.status for r in lake.runs(spark).collect()} == before
    assert lake.read_log(spark, "pipeline_runs").count() == 4
    # a crash between publishing the merged batch and dropping the old ones
    from stratum.sources import sinks

    path = lake.log_path("pipeline_runs")
    merged = os.path.basename(sinks.log_batches(spark, path)[0])
    sinks.append_log(spark.read.parquet(f"{path}/{merged}"), path, replaces=[merged])
    assert len([d for d in os.listdir(path) if not d.startswith(("_", "."))]) == 2
    assert lake.read_log(spark, "pipeline_runs").count() == 4
    assert lake.audit(spark).count() == 1
    assert lake.compact(spark, "pipeline_runs") == 0  # removes what the crash left
    assert len([d for d in os.listdir(path) if not d.startswith(("_", "."))]) == 1
    assert lake.read_log(spark, "pipeline_runs").count() == 4
    # the state log keeps one folder per entity: only batches inside are merged
    state_before = lake.read_log(spark, "ingestion_state").count()
    assert lake.compact(spark, "ingestion_state") == 0
    lake.compact(spark, "ingestion_state", sub="results")
    assert lake.read_log(spark, "ingestion_state", sub="results").count() == state_before


def test_engine_facade(spark, tmp_path):
    from stratum.plans.engine import Engine

    landing = tmp_path / "landing"
    (landing / "races").mkdir(parents=True)
    (landing / "races" / "r.csv").write_text(
        "season,round,url,raceName,date,circuitId\n2024,1,u,Bahrain GP,2024-03-02,bahrain\n"
        "2024,2,u,Saudi GP,\\N,jeddah\n")
    eng = Engine.seeded(spark, str(tmp_path / "lake"), str(landing))
    assert eng.ingest("races").status == "SUCCESS"
    out = eng.refine("races")
    got = sorted((r.season, r.round, r.race_date) for r in out.collect())
    import datetime as dt
    assert got == [(2024, 1, dt.date(2024, 3, 2)), (2024, 2, None)]
    assert eng.bronze("races").count() == 2
    assert {r.status for r in eng.runs().collect()} == {"SUCCESS"}
    assert eng.results("dq").filter(F.col("rule_type") == "DUPLICATE_KEY").first().passed
    views = eng.register_views(prefix="t_")
    assert "t_bronze_races" in views and "t_pipeline_runs" in views
    assert spark.sql("SELECT count(*) FROM t_bronze_races").first()[0] == 2
    assert spark.sql("SELECT status FROM t_pipeline_runs").first()[0] == "SUCCESS"
    assert spark.sql("SELECT count(*) FROM t_validation_rules WHERE entity_name = 'races'").first()[0] == 5
    assert spark.sql("SELECT entity_name FROM t_watermarks").count() == 0  # races is a full load


def test_touched_file_replaces_rows_and_space_in_path(spark, tmp_path):
    landing = tmp_path / "raw zone" / "results"
    landing.mkdir(parents=True)
    write_array(landing / "a file.json", result_rows(2023, 1, 4))
    write_array(landing / "b.json", result_rows(2024, 1, 2))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.seed_entity_config(spark, str(tmp_path / "raw zone"))
    assert ingest(spark, lake, "results", cfg).files == 2
    # touch: new mtime, same bytes -> reloaded, its old rows replaced
    st = os.stat(landing / "a file.json")
    os.utime(landing / "a file.json", (st.st_atime, st.st_mtime + 60))
    r = ingest(spark, lake, "results", cfg)
    assert (r.status, r.files, r.records) == ("SUCCESS", 1, 4)
    cur = bronze_current(spark, lake, ctl.config_for(cfg, "results"))
    assert cur.count() == 6
    files = {row._source_file for row in cur.select("_source_file").distinct().collect()}
    assert any("raw%20zone" in f and "a%20file.json" in f for f in files)
    assert ingest(spark, lake, "results", cfg).status == "SKIPPED"


def test_stream_ingest_waves_and_failed_check(spark, tmp_path):
    from stratum.streaming.ingest import stream_ingest

    landing = tmp_path / "landing" / "results"
    landing.mkdir(parents=True)
    write_array(landing / "w1.json", result_rows(2023, 1, 3))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.config_for(ctl.seed_entity_config(spark, str(tmp_path / "landing")), "results")
    v = ctl.seed_validation_rules(spark)
    stream_ingest(spark, lake, cfg, v)
    stream_ingest(spark, lake, cfg, v)  # nothing new: no new run
    assert lake.runs(spark).count() == 1
    write_array(landing / "w2.json", result_rows(2024, 1, 2))
    stream_ingest(spark, lake, cfg, v)
    assert bronze_current(spark, lake, cfg).count() == 5
    write_array(landing / "bad.json", [{**result_rows(2024, 2, 1)[0], "points": None}])
    with pytest.raises(Exception, match="Validation failed"):
        stream_ingest(spark, lake, cfg, v, dq_rules=ctl.seed_dq_rules(spark))
    assert bronze_current(spark, lake, cfg).count() == 5
    assert "FAILED" in {r.status for r in lake.runs(spark).collect()}
    stages = {r.stage for r in lake.results(spark).select("stage").distinct().collect()}
    assert stages == {"validation", "dq"}


def test_vacuum_keeps_committed_runs(spark, setup):
    from stratum.plans.ingest import vacuum_bronze

    lake, cfg, landing = setup
    r1 = ingest(spark, lake, "results", cfg)
    time.sleep(1.1)
    write_array(landing / "r2024_1.json", result_rows(2024, 1, 4, points=3.0))
    r2 = ingest(spark, lake, "results", cfg)
    c = ctl.config_for(cfg, "results")
    target = lake.table_path("bronze", "results")
    ghost = f"{target}/_pipeline_run_id=run-ghost"
    spark.read.parquet(target).drop("_pipeline_run_id").limit(2).write.partitionBy(
        "race_year").parquet(ghost)
    before = bronze_current(spark, lake, c).count()
    assert vacuum_bronze(spark, lake, c, retain_hours=1.0) == []  # all too young
    removed = vacuum_bronze(spark, lake, c, retain_hours=0.0)
    assert removed == ["run-ghost"]  # r1 still holds the 2023 file's rows
    assert {r1.run_id, r2.run_id} <= {d.split("=", 1)[1] for d in os.listdir(target)}
    assert bronze_current(spark, lake, c).count() == before


def test_quick_check(spark, setup):
    lake, cfg, landing = setup
    # quick check: only new / touched files are hashed and loaded
    assert ingest(spark, lake, "results", cfg, trust_metadata=True).files == 2
    assert ingest(spark, lake, "results", cfg, trust_metadata=True).status == "SKIPPED"
    time.sleep(1.1)
    write_array(landing / "r2024_1.json", result_rows(2024, 1, 4, points=5.0))
    r = ingest(spark, lake, "results", cfg, trust_metadata=True)
    assert (r.status, r.files) == ("SUCCESS", 1)
    state = lake.read_log(spark, "ingestion_state").filter(F.col("event") == "LOADED")
    assert state.filter(F.col("content_hash").isNull()).count() == 0


def test_stream_backlog_in_bounded_batches(spark, tmp_path):
    from stratum.streaming.ingest import stream_ingest

    landing = tmp_path / "landing" / "results"
    landing.mkdir(parents=True)
    for i in range(5):
        write_array(landing / f"b{i}.json", result_rows(2020 + i, 1, 2))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.config_for(ctl.seed_entity_config(spark, str(tmp_path / "landing")), "results")
    stream_ingest(spark, lake, cfg, max_files_per_trigger=2)
    runs = lake.runs(spark).collect()  # three micro-batches, one run
    assert [r.status for r in runs] == ["SUCCESS"] and runs[0].n_events == 2 and runs[0].duration_ms > 0
    assert bronze_current(spark, lake, cfg).count() == 10


@pytest.mark.parametrize("files", [1, 10])
def test_stream_rules_see_the_whole_run(spark, tmp_path, files):
    """A key repeated across files fails its rule however the stream is cut; the
    staged rows are set aside, and committed on demand once the rule allows them."""
    from stratum.streaming.ingest import quarantined_runs, readmit, stream_ingest

    landing = tmp_path / "landing" / "results"
    landing.mkdir(parents=True)
    for i in range(3):
        write_array(landing / f"same{i}.json", result_rows(2020, 1, 2))
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.config_for(ctl.seed_entity_config(spark, str(tmp_path / "landing")), "results")
    strict, soft = (ctl.rules_table(spark, [("results", "Known once", "DUPLICATE_KEY", "url, driverId, season, round",
                                             None, None, severity, True)]) for severity in ("ERROR", "WARNING"))
    with pytest.raises(Exception, match="6 record"):
        stream_ingest(spark, lake, cfg, dq_rules=strict, max_files_per_trigger=files)
    assert bronze_current(spark, lake, cfg).count() == 0
    stream_ingest(spark, lake, cfg, dq_rules=soft, max_files_per_trigger=files)
    assert bronze_current(spark, lake, cfg).count() == 0
    (failed,) = quarantined_runs(spark, lake, "results")
    assert readmit(spark, lake, cfg, failed, dq_rules=soft, reread=False) == 6
    assert bronze_current(spark, lake, cfg).count() == 6 and quarantined_runs(spark, lake, "results") == []
    counts = [r.failed_records for r in lake.results(spark, "dq").orderBy("execution_time").collect()]
    assert counts == [6, 6]
    stream_ingest(spark, lake, cfg, dq_rules=soft, max_files_per_trigger=files)
    assert bronze_current(spark, lake, cfg).count() == 6


def test_incremental_without_tracking_appends(spark, setup):
    lake, cfg, landing = setup
    plain = cfg.withColumn("incremental_strategy", F.lit(None).cast("string"))
    assert ingest(spark, lake, "results", plain).files == 0
    assert ingest(spark, lake, "results", plain).status == "SUCCESS"
    # every run appends all files again (no change detection configured)
    assert bronze_current(spark, lake, ctl.config_for(plain, "results")).count() == 18
    from stratum.plans.ingest import vacuum_bronze

    assert vacuum_bronze(spark, lake, ctl.config_for(plain, "results"), retain_hours=0) == []
    assert bronze_current(spark, lake, ctl.config_for(plain, "results")).count() == 18


def test_entity_lock(spark, setup):
    from stratum.plans.locks import EntityLockedError

    lake, cfg, landing = setup
    lock = lake.log_path("_locks/results")
    os.makedirs(os.path.dirname(lock), exist_ok=True)
    with open(lock, "w") as f:
        f.write("run-elsewhere")
    with pytest.raises(EntityLockedError):
        ingest(spark, lake, "results", cfg)
    assert "FAILED" in {r.status for r in lake.runs(spark).collect()}
    old = time.time() - 7 * 3600  # a lock left behind by a dead driver expires
    os.utime(lock, (old, old))
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    assert not os.path.exists(lock)  # released after the run


def test_lock_is_renewed_and_kept_by_its_owner(spark, tmp_path):
    from stratum.plans.locks import EntityLockedError, entity_lock

    path = str(tmp_path / "lock")
    with entity_lock(spark, path, "first", ttl_seconds=2, beat_seconds=0.3):
        time.sleep(3)  # longer than the time to live
        with pytest.raises(EntityLockedError):
            with entity_lock(spark, path, "second", ttl_seconds=2):
                pass
        with open(path, "w") as f:  # somebody took it over
            f.write("third")
        time.sleep(0.7)
    assert open(path).read() == "third"  # neither renewed nor removed


def test_refine_resolves_its_source_and_publishes_atomically(spark, tmp_path, monkeypatch):
    from stratum.operators.projection import register_transform
    from stratum.plans import refine as refining
    from stratum.plans.refine import refined_current

    landing = tmp_path / "landing" / "races"
    landing.mkdir(parents=True)
    (landing / "r.csv").write_text("season,round,url,raceName,date,circuitId\n1999,4,u,Rain Race,1999-05-05,c9\n")
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.seed_entity_config(spark, str(tmp_path / "landing")).where("entity_name = 'races'")
    cfg = cfg.withColumn("target_table", F.lit("races_raw"))  # not the entity's name
    assert ingest(spark, lake, "races", cfg).status == "SUCCESS"
    rows = [("races", "bronze", "races_raw", "silver_refine_test", f"races_{time.time_ns()}", "transform_races", "overwrite", True)]
    rc = ctl.refine_config(spark, rows)
    first = refine(spark, lake, "races", rc, cfg, catalog=True)
    assert first.count() == 1
    name = f"{rows[0][3]}.{rows[0][4]}"
    assert spark.table(name).count() == 1 and "_pipeline_run_id" in spark.table(name).columns
    # a run that dies while writing changes nothing
    one = ctl.config_for(rc, "races")
    target = lake.table_path(one["target_schema"], one["target_table"])
    first.drop("_pipeline_run_id").union(first.drop("_pipeline_run_id")).write.parquet(f"{target}/_pipeline_run_id=run-ghost")
    assert refined_current(spark, lake, one).count() == 1
    register_transform("broken_races", lambda df: df.select("season"))
    with pytest.raises(Exception, match="Silver validation failed"):
        refine(spark, lake, "races", ctl.refine_config(spark, [(*rows[0][:5], "broken_races", "overwrite", True)]), cfg)
    assert refined_current(spark, lake, one).count() == 1
    appended = ctl.refine_config(spark, [(*rows[0][:6], "append", True)])
    assert refine(spark, lake, "races", appended, cfg, catalog=True).count() == 2
    assert spark.table(name).count() == 2
    # a crash after the commit: the next run publishes both, publishing again nothing new
    with monkeypatch.context() as m:
        m.setattr(refining, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            refine(spark, lake, "races", appended, cfg, catalog=True)
    assert spark.table(name).count() == 2
    assert refine(spark, lake, "races", appended, cfg, catalog=True).count() == 4
    assert spark.table(name).count() == 4 and refining.publish(spark, lake, ctl.config_for(appended, "races")) == name
    assert spark.table(name).count() == 4 and spark.table(name).select("_pipeline_run_id").distinct().count() == 4
    # the vacuum keeps what is current: all four runs of an appending entity, the last of an overwriting one
    assert refining.vacuum_refined(spark, lake, ctl.config_for(appended, "races"), retain_hours=1.0) == []
    assert refining.vacuum_refined(spark, lake, ctl.config_for(appended, "races"), retain_hours=0.0) == ["run-ghost"]
    assert len(refining.vacuum_refined(spark, lake, one, retain_hours=0.0)) == 3
    assert refined_current(spark, lake, one).count() == 1
    with pytest.raises(Exception, match="races_lost"):
        refine(spark, lake, "races", ctl.refine_config(spark, [("races", "bronze", "races_lost", *rows[0][3:])]), cfg)


def test_long_error_messages_are_kept(spark, setup):
    lake, cfg, landing = setup
    long = "x" * 3000
    rules = ctl.rules_table(spark, [("results", "Odd", "ALLOWED_VALUES", "driverId", long, None, "ERROR", True),
                                    ("results", "Pattern", "NOT_NULL", "no_" + long, None, None, "ERROR", True)])
    with pytest.raises(Exception, match="x{3000}"):
        ingest(spark, lake, "results", cfg, rules)
    assert long in lake.runs(spark).first().error_message
    assert not os.path.exists(lake.log_path("_staging")) or not os.listdir(lake.log_path("_staging"))


def test_current_view_prunes_run_folders(spark, setup):
    lake, cfg, landing = setup
    assert ingest(spark, lake, "results", cfg).status == "SUCCESS"
    cur = bronze_current(spark, lake, ctl.config_for(cfg, "results"))
    cur.collect()
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()  # run folders not referenced are skipped


def test_referential_rule_in_ingest(spark, setup):
    lake, cfg, landing = setup
    known = spark.createDataFrame([("c0",), ("c1",)], "constructor_id string")
    dq = ctl.rules_table(spark, [("results", "Known constructor", "REFERENTIAL", "constructorId",
                                  "constructors.constructor_id", None, "WARNING", True)])
    r = ingest(spark, lake, "results", cfg, None, dq, references={"constructors": known})
    assert r.status == "SUCCESS"  # a WARNING does not block
    row = lake.results(spark, "dq").first()
    assert (row.rule_type, row.rule_label, row.passed) == ("REFERENTIAL", "Known constructor", False)
    assert row.failed_records == 2  # the one c2 row of each file
