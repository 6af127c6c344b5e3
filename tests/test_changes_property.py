"""Property tests: upsert and latest-per-key against a dict-based model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.changes import latest_per_key, upsert

keys = st.integers(0, 12)
current_st = st.dictionaries(keys, st.text("abc", max_size=2), max_size=12)
changes_st = st.lists(
    st.tuples(keys, st.text("xyz", max_size=2), st.integers(0, 1000), st.booleans()),
    max_size=25, unique_by=lambda t: (t[0], t[2]))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=current_st, changes=changes_st)
def test_upsert_matches_model(spark, current, changes):
    cur_df = spark.createDataFrame(sorted(current.items()), "id int, v string")
    ch_df = spark.createDataFrame(changes, "id int, v string, ver int, del boolean")
    got = sorted(map(tuple, upsert(cur_df, ch_df, "id", order_by="ver", delete_flag="del").collect()))
    model = dict(current)
    latest = {}
    for k, v, ver, d in changes:
        if k not in latest or ver > latest[k][1]:
            latest[k] = (v, ver, d)
    for k, (v, _, d) in latest.items():
        if d:
            model.pop(k, None)
        else:
            model[k] = v
    assert got == sorted(model.items())


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(keys, st.integers(0, 50), st.text("pq", max_size=3)), max_size=30,
                     unique_by=lambda t: (t[0], t[1])))
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, p string")
    got = sorted(map(tuple, latest_per_key(df, "k", "t").collect()))
    best = {}
    for k, t, p in rows:
        if k not in best or t > best[k][0]:
            best[k] = (t, p)
    assert got == sorted((k, t, p) for k, (t, p) in best.items())


files = st.sampled_from([f"f{i}" for i in range(8)])
meta = st.tuples(st.integers(0, 2), st.integers(0, 2), st.one_of(st.none(), st.sampled_from("ab")))


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(state=st.dictionaries(files, meta, max_size=8), inv=st.dictionaries(files, meta, max_size=8),
       compare_hash=st.booleans())
def test_changed_files_matches_model(spark, state, inv, compare_hash):
    import datetime as dt

    from stratum.operators.changes import changed_files

    def rows(d):
        return [(k, dt.datetime(2024, 1, 1 + m), s, h) for k, (m, s, h) in sorted(d.items())]

    ddl = "source_file string, last_modified_time timestamp, file_size bigint, content_hash string"
    got = {r.source_file: r.change_kind for r in changed_files(
        spark.createDataFrame(rows(inv), ddl), spark.createDataFrame(rows(state), ddl),
        compare_hash=compare_hash).collect()}
    expected = {}
    for k, (m, s, h) in inv.items():
        if k not in state:
            expected[k] = "NEW"
        else:
            pm, ps, ph = state[k]
            same = m == pm and s == ps and (not compare_hash or h == ph)
            if not same:
                expected[k] = "MODIFIED"
    assert got == expected
