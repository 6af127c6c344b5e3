import datetime as dt

import pytest

from pyspark.sql import functions as F

from stratum.operators.changes import (
    changed_files,
    current_rows,
    current_state,
    latest_per_key,
    upsert,
)

INV = "source_file string, last_modified_time timestamp, file_size bigint, content_hash string"
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def test_changed_file_cases(spark):
    state = spark.createDataFrame([
        ("same", T0, 10, "h"), ("mtime", T0, 10, "h"), ("size", T0, 10, "h"),
        ("hash", T0, 10, "h"), ("nullhash", T0, 10, None)], INV)
    inv = spark.createDataFrame([
        ("new", T0, 1, "h"), ("same", T0, 10, "h"), ("mtime", T1, 10, "h"),
        ("size", T0, 11, "h"), ("hash", T0, 10, "h2"), ("nullhash", T0, 10, None)], INV)
    got = {r.source_file: r.change_kind for r in changed_files(inv, state).collect()}
    assert got == {"new": "NEW", "mtime": "MODIFIED", "size": "MODIFIED", "hash": "MODIFIED"}


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, v int, p string")
    got = sorted(map(tuple, latest_per_key(df, "k", "v").collect()))
    assert got == [("a", 2, "y"), ("b", 1, "z")]


def test_upsert_update_insert_delete(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    ch = spark.createDataFrame(
        [(2, "b1", 1, False), (2, "b2", 2, False), (4, "d", 1, False), (3, None, 5, True)],
        "id int, v string, ver int, del boolean")
    out = upsert(cur, ch, "id", order_by="ver", delete_flag="del")
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b2"), (4, "d")]
    assert out.columns == ["id", "v"]


def test_upsert_without_order_needs_single_changes(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    ch = spark.createDataFrame([(2, "x"), (3, None)], "id int, v string")
    assert sorted(upsert(cur, ch, "id").collect()) == [(1, "a"), (2, "x"), (3, None)]
    with pytest.raises(Exception, match="several changes"):
        upsert(cur, ch.union(ch), "id").collect()


def _state_log(spark, rows):
    return spark.createDataFrame(rows, "entity_name string, source_file string, run_id string, "
                                       "event string, processed_at timestamp")


def test_current_state_respects_reset(spark):
    log = _state_log(spark, [
        ("e", "f1", "r1", "LOADED", T0),
        ("e", None, None, "RESET", dt.datetime(2024, 1, 1, 12)),
        ("e", "f2", "r2", "LOADED", T1),
        ("x", "f9", "r0", "LOADED", T0)])
    got = [(r.source_file, r.run_id) for r in current_state(log, "e").collect()]
    assert got == [("f2", "r2")]


def test_current_rows_hides_uncommitted_and_superseded(spark):
    bronze = spark.createDataFrame([
        (1, "f1", "r1"), (2, "f1", "r1"), (3, "f2", "r1"),
        (10, "f1", "r2"),            # f1 modified, reloaded by r2
        (99, "f2", "r3")],           # r3 crashed before commit
        "x int, _source_file string, _pipeline_run_id string")
    log = _state_log(spark, [("e", "f1", "r1", "LOADED", T0), ("e", "f2", "r1", "LOADED", T0),
                             ("e", "f1", "r2", "LOADED", T1)])
    got = sorted(r.x for r in current_rows(bronze, current_state(log, "e")).collect())
    assert got == [3, 10]


def test_space_in_path_consistent(spark, tmp_path):
    from stratum.sources.inventory import file_inventory
    from stratum.sources.readers import read_source

    src = tmp_path / "src a"
    src.mkdir()
    (src / "one.csv").write_text("a,b\n1,2\n")
    (src / "two.csv").write_text("a,b\n3,4\n")
    inv = file_inventory(spark, str(src))
    wanted = inv.filter(F.col("source_file").endswith("one.csv"))
    df = read_source(spark, str(src), "csv", "a string, b string", files_to_include=wanted)
    rows = df.select("a", F.col("_metadata.file_path").alias("p")).collect()
    assert [r.a for r in rows] == ["1"]
    assert rows[0].p == wanted.first().source_file
