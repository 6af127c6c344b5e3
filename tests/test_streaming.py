"""Streams: lost checkpoints, bad files, and keys remembered across runs."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stratum.operators.rules import Rule
from stratum.plans import control as ctl
from stratum.plans.ingest import bronze_current
from stratum.sources.schemas import register_schema
from stratum.sources.sinks import remove_path
from stratum.streaming import ingest as streaming
from stratum.streaming.ingest import quarantined_rows, quarantined_runs, readmit, stream_ingest
from stratum.streaming.keyed import KeyedStream

register_schema("sightings_schema", "id bigint, k string, ts timestamp, v double")


@pytest.fixture
def setup(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    cfg = ctl.config_for(ctl.entity_config(spark, [(
        "sightings", "json", str(landing), "bronze", "sightings", "incremental", None,
        "sightings_schema", True, False, "file_tracking", None)]), "sightings")
    rules = ctl.rules_table(spark, [("sightings", "Key", "NOT_NULL", "k", None, None, "ERROR", True)])

    def land(name, rows):
        (landing / name).write_text("".join(json.dumps(dict(zip(("id", "k", "ts", "v"), r))) + "\n" for r in rows))

    return ctl.Lakehouse(str(tmp_path / "lake")), cfg, rules, land


def loaded(spark, lake, cfg):
    return sorted(r.id for r in bronze_current(spark, lake, cfg).collect())


def test_lost_checkpoint_loads_once(spark, setup):
    lake, cfg, rules, land = setup
    for i, k in enumerate(["a", "b", None]):
        land(f"f{i}.json", [(i, k, None, 1.0)])
    with pytest.raises(Exception, match="Validation failed"):
        stream_ingest(spark, lake, cfg, rules, max_files_per_trigger=1)
    # what a crash would leave: rows staged by a checkpoint that is gone
    generation = streaming.read_small_text(spark, lake.log_path("_streams/sightings/_generation"))
    spark.createDataFrame([(9, "k2")], "id bigint, k string").write.parquet(
        lake.log_path(f"_staged/sightings/{generation}/batch_id=99"))
    remove_path(spark, lake.log_path("_streams/sightings"))
    stream_ingest(spark, lake, cfg)
    assert loaded(spark, lake, cfg) == [0, 1, 2]
    stream_ingest(spark, lake, cfg)
    assert loaded(spark, lake, cfg) == [0, 1, 2]


def test_bad_file_does_not_block(spark, setup):
    lake, cfg, rules, land = setup
    land("bad.json", [(1, None, None, 1.0), (2, "b", None, 1.0)])
    with pytest.raises(Exception, match="Validation failed"):
        stream_ingest(spark, lake, cfg, rules)
    land("good.json", [(3, "c", None, 1.0)])
    stream_ingest(spark, lake, cfg, rules)
    assert loaded(spark, lake, cfg) == [3]
    (run,) = quarantined_runs(spark, lake, "sightings")
    with pytest.raises(Exception, match="Validation failed"):
        readmit(spark, lake, cfg, run, rules)
    assert quarantined_runs(spark, lake, "sightings") == [run]
    land("bad.json", [(1, "a", None, 1.0), (2, "b", None, 1.0)])  # repaired
    assert readmit(spark, lake, cfg, run, rules) == 2
    assert loaded(spark, lake, cfg) == [1, 2, 3] and quarantined_runs(spark, lake, "sightings") == []
    with pytest.raises(Exception, match="No quarantined"):
        readmit(spark, lake, cfg, run, rules)


START = datetime(2024, 3, 1, tzinfo=timezone.utc)
TTL, DELAY = 60_000, 300_000
KEYED = KeyedStream(("k",), "ts", "300 seconds", TTL, ("id",), (Rule("NON_NEGATIVE", "v"),))


def batch_model(runs):
    """id -> verdict, row by row."""
    last, newest, out = {}, None, {}
    for rows in runs:
        watermark = max(0, newest - DELAY) if newest is not None else 0
        seconds = [(None if t is None else int((START + timedelta(seconds=t)).timestamp() * 1000), i, k, v) for i, k, t, v in rows]
        for ms, i, k, v in sorted(seconds, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            if k is None or ms is None or (v is not None and v < 0):
                out[i] = "bad"
            elif watermark and ms < watermark:
                out[i] = "late"
            else:
                out[i] = "duplicate" if k in last and ms <= last[k] + TTL else "ok"
                last[k] = max(ms, last.get(k, ms))
        newest = max([ms for ms, *_ in seconds if ms is not None] + ([newest] if newest is not None else []), default=newest)
    return out


def test_keys_across_runs_and_a_restart(spark, setup, monkeypatch):
    lake, cfg, _, land = setup
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rng = random.Random(4)
    runs, n = [], 0
    for r in range(4):
        rows = []
        for _ in range(60):
            at = r * 250 + rng.choice([rng.uniform(-400, 300), rng.uniform(0, 250)])
            rows.append((n, rng.choice("abcdefgh" if n % 9 else [None]), round(at, 1) if n % 17 else None, rng.choice([1.0, None, 2.0, 3.0, -1.0])))
            n += 1
        runs.append(rows)
    expected = batch_model(runs)
    assert set(expected.values()) == {"bad", "late", "duplicate", "ok"}
    for r, rows in enumerate(runs):
        stamp = lambda t: None if t is None else (START + timedelta(seconds=t)).isoformat()
        for part in range(2):
            land(f"r{r}_{part}.json", [(i, k, stamp(t), v) for i, k, t, v in rows[part::2]])
        if r == 2:  # the run dies between the state store's commit and ours
            with monkeypatch.context() as m:
                m.setattr(streaming, "_commit_keyed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(RuntimeError, match="lost"):
                    stream_ingest(spark, lake, cfg, keyed=KEYED)
        stream_ingest(spark, lake, cfg, keyed=KEYED)
    found = {r.id: r._verdict for r in quarantined_rows(spark, lake, cfg).collect()}
    found |= dict.fromkeys(loaded(spark, lake, cfg), "ok")
    assert found == expected
    failed = quarantined_rows(spark, lake, cfg).filter("_verdict = 'bad'").select(F.explode("_failed")).distinct().collect()
    assert {r[0] for r in failed} == {"k Not Null Validation", "ts Not Null Validation", "v Non-Negative Validation"}
    duplicates = lake.results(spark, "dq").filter("rule_type = 'DUPLICATE_KEY'").agg(F.sum("failed_records")).first()[0]
    assert duplicates == sum(v == "duplicate" for v in expected.values())
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_keyed_rules_are_row_rules(spark, setup):
    lake, cfg, _, land = setup
    land("a.json", [(1, "a", None, 1.0)])
    with pytest.raises(Exception, match="single rows"):
        stream_ingest(spark, lake, cfg, keyed=KeyedStream(("k",), "ts", "1 second", 1, rules=(Rule("DUPLICATE_ROW"),)))


def test_a_block_of_keys_is_one_read_and_one_write():
    import pandas as pd

    from stratum.streaming.keyed import LastSightings

    class Store:
        value, calls, timers = None, 0, []

        def getValueState(self, *_):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def clear(self):
            self.calls += 1
            self.value = None

        def registerTimer(self, at):
            self.timers.append(at)

    class Times:
        now = 0

        def getCurrentWatermarkInMs(self):
            return self.now

    store, times, rng, last = Store(), Times(), random.Random(5), {}
    work = LastSightings(100)
    work.init(store)
    for times.now in (0, 0, 500, 650, 2_000):
        rows = [(f"{rng.randrange(700):032X}", rng.randrange(times.now - 200, times.now + 400)) for _ in range(1_000)]
        expected = {k: last.get(k) for k, _ in rows}
        for k, ms in rows:
            if ms >= times.now:
                last[k] = max(ms, last.get(k, ms))
        last = {k: ms for k, ms in last.items() if ms + 101 > times.now}
        store.calls = 0
        frames = [pd.DataFrame(part, columns=["k", "ms"]) for part in (rows[:400], rows[400:])]
        (found,) = work.handleInputRows((0,), iter(frames), times)
        assert {r[0]: r[2] if r[1] else None for r in found.itertuples(index=False)} == expected
        assert store.calls == 2
    assert len(store.timers) == 1
    times.now = 10_000
    assert list(work.handleExpiredTimer((0,), times, None)) == [] and store.value is None
