"""Every registered query against its DuckDB oracle (sf0.001, fast)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import SPARK_TO_DUCK, duck, rows_of  # noqa: E402

ORACLE_DIR = os.environ.get("STRATUM_ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, ORACLE_DIR)
    got_cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    exp_cols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in df.schema.fields}
    assert {c: types[c] for c in got_cols} == {d[0]: str(d[1]) for d in res.description}
    assert rows_of(got_cols, got) == rows_of(exp_cols, exp)
