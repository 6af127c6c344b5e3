"""Keys across runs, and histories against row-by-row models."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.history import apply_changes, as_of, intervals
from stratum.operators.keyfilter import filter_blocks, key_filter, merge_filters, possible_keys, repeated_keys
from stratum.plans import control as ctl
from stratum.plans.ingest import ingest
from stratum.sources.schemas import register_schema

register_schema("keyed_raw_schema", "k string, v bigint")


def test_filter_finds_all_and_little_else(spark):
    rows = spark.range(0, 40_000).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b"))
    blocks = filter_blocks(40_000)
    assert blocks == 2048 and filter_blocks(0) == filter_blocks(20) == 1
    made = key_filter(rows, ["a", "b"], blocks).withColumn("run_id", F.lit("r1"))
    inside = possible_keys(rows, ["a", "b"], made, [blocks])
    assert inside.count() == 40_000
    others = spark.range(50_000, 90_000).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b"))
    wrong = possible_keys(others, ["a", "b"], made, [blocks]).count()
    assert wrong < 800  # 2 %
    nulls = rows.select(F.lit(None).cast("bigint").alias("a"), "b")
    assert key_filter(nulls, ["a", "b"], 4).count() == 0 == possible_keys(nulls, ["a", "b"], made, [blocks]).count()


def test_merged_filter_is_the_filter_of_the_union(spark):
    a, b = spark.range(500).toDF("a"), spark.range(300, 2_000).toDF("a")
    small, large = key_filter(a, ["a"], 16), key_filter(b, ["a"], 64)
    merged = merge_filters(small.unionAll(large), 16)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, key_filter(a.union(b), ["a"], 16).collect()))


def test_repeated_keys_are_exact(spark):
    runs = {f"r{r}": [(k,) for k in range(r * 100, r * 100 + 130)] for r in range(4)}
    earlier = None
    for run, rows in runs.items():
        part = spark.createDataFrame(rows, "a bigint").withColumn("_pipeline_run_id", F.lit(run))
        earlier = part if earlier is None else earlier.union(part)
    filters = None
    for run in runs:
        f = key_filter(earlier.filter(F.col("_pipeline_run_id") == run), ["a"], 8).withColumn("run_id", F.lit(run))
        filters = f if filters is None else filters.union(f)
    new = spark.range(50, 1000, 10).toDF("a")
    found = {r.a: (r.n_earlier, r.first_run) for r in
             repeated_keys(possible_keys(new, ["a"], filters, [8]), earlier, ["a"]).collect()}
    expected = {}
    for k in range(50, 1000, 10):
        having = sorted(r for r, rows in runs.items() if (k,) in rows)
        if having:
            expected[k] = (len(having), having[0])
    assert found == expected


def test_rule_between_loads(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    lake = ctl.Lakehouse(str(tmp_path / "lake"))
    cfg = ctl.entity_config(spark, [(
        "keyed", "json", str(landing), "bronze", "keyed", "incremental", None, "keyed_raw_schema", True, False, "file_tracking", None)])

    def rules(severity):
        return ctl.rules_table(spark, [("keyed", "New keys", "DUPLICATE_KEY_RUNS", "k", None, None, severity, True)])

    def land(name, keys):
        (landing / name).write_text("".join('{"k": %s, "v": 1}\n' % ("null" if k is None else f'"{k}"') for k in keys))

    def last():
        rows = lake.results(spark, "dq").orderBy(F.col("execution_time").desc()).limit(1).collect()
        return (rows[0].failed_records, rows[0].passed, rows[0].severity) if rows else None

    land("a.json", ["x", "y", None])
    assert ingest(spark, lake, "keyed", cfg).status == "SUCCESS"  # before the rule existed
    land("b.json", ["y", "y", "z", None])
    assert ingest(spark, lake, "keyed", cfg, dq_rules=rules(None)).records == 4
    assert last() == (2, False, "WARNING")
    land("c.json", ["z", "new"])
    with pytest.raises(Exception, match="1 record.* earlier loads in 'k'"):
        ingest(spark, lake, "keyed", cfg, dq_rules=rules("ERROR"))
    land("c.json", ["newer"])
    land("b.json", ["z", "q", "q"])  # its own rows are replaced, they are no earlier load
    assert ingest(spark, lake, "keyed", cfg, dq_rules=rules("ERROR")).records == 4
    assert last() == (0, True, "ERROR")


DDL = "k string, t int, n int, a int, b string, s array<string>, d boolean"
change_st = st.tuples(
    st.sampled_from(["x", "y", None]), st.one_of(st.integers(0, 5), st.none()), st.integers(0, 3), st.one_of(st.integers(0, 1), st.none()),
    st.sampled_from(["p", "q", None]), st.sampled_from([None, ["a"], ["b"], ["a", "b"], []]), st.sampled_from([True, False, False, None]),
)


def model(rows):
    """(history states, intervals) by walking each key's changes in order."""
    out, spans = [], []
    for key in sorted({r[0] for r in rows if r[0] is not None}):
        mine = sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: r[1:3])
        state, walked = {"a": None, "b": None}, []
        for _, t, n, a, b, s, d in mine:
            if d:
                state = {"a": None, "b": None}
            else:
                state = state | {c: v for c, v in (("a", a), ("b", b)) if s is None or c in s}
            walked.append((t, n, bool(d), dict(state)))
        for k, (t, n, d, held) in enumerate(walked):
            end = walked[k + 1][0] if k + 1 < len(walked) else None
            out.append((key, held["a"], held["b"], t, n, end, d))
            if not d and (end is None or t < end):
                if spans and spans[-1][0] == key and spans[-1][1:3] == (held["a"], held["b"]) and spans[-1][4] == t:
                    spans[-1] = (*spans[-1][:4], end)
                else:
                    spans.append((key, held["a"], held["b"], t, end))
    return sorted(out, key=str), sorted(spans, key=str)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ARGS = (["k"], ["a", "b"], "t", "n", "s", "d")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(change_st, max_size=14, unique_by=lambda r: r[:3]), seed=st.integers(0, 99))
def test_history_in_any_order(spark, rows, seed):
    expected, spans = model(rows)
    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    cut = len(shuffled) // 2
    history = None
    for batch in (shuffled[:cut], shuffled[cut:], shuffled[: cut // 2]):  # the last is redelivered
        history = apply_changes(history, spark.createDataFrame(batch, DDL), *ARGS)
    history = history.cache()
    assert rows_of(history, "k", "a", "b", "valid_from", "seq", "valid_to", "deleted") == expected
    assert rows_of(intervals(history, ["k"], ["a", "b"]), "k", "a", "b", "valid_from", "valid_to") == spans
    now = [(k, a, b) for k, a, b, f, t in spans if f <= 3 and (t is None or 3 < t)]
    assert rows_of(as_of(history, F.lit(3)), "k", "a", "b") == sorted(now, key=str)


def test_ambiguous_changes_fail(spark):
    rows = [("x", 1, 1, 1, "p", None, False), ("x", 1, 1, 2, "p", None, False)]
    with pytest.raises(Exception, match="several changes"):
        apply_changes(None, spark.createDataFrame(rows, DDL), *ARGS).collect()
    assert apply_changes(None, spark.createDataFrame([rows[0]] * 2, DDL), *ARGS).count() == 1


def rows_of_fullest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def many_changes(spark, keys):
    return keys.select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("t"), F.lit(1).alias("n"), F.col("id").cast("int").alias("a"), F.lit("p").alias("b"),
        F.lit(None).cast("array<string>").alias("s"), F.lit(False).alias("d"))


def test_interval_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr("stratum.operators.history.TASK_ROWS", 50, raising=False)
    made = apply_changes(None, many_changes(spark, spark.range(4_000)), *ARGS)
    found = intervals(made, ["k"], ["a", "b"])
    assert rows_of_fullest_task(found) <= 100 and found.count() == 4_000


def test_history_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr("stratum.operators.history.TASK_ROWS", 50, raising=False)
    first = apply_changes(None, many_changes(spark, spark.range(3_000)), *ARGS).cache()
    assert rows_of_fullest_task(first) <= 100
    later = many_changes(spark, spark.range(2_000, 4_000)).withColumn("a", F.lit(7))  # a third are redelivered
    found = apply_changes(first, later, *ARGS)
    assert rows_of_fullest_task(found) <= 100
    assert rows_of(found.filter("a = 7"), "k") == sorted([(str(k),) for k in {7, *range(2_000, 4_000)}], key=str)
    assert found.count() == 4_000
