"""Property test: the fused one-pass report equals a brute-force evaluation
of each rule on the driver (small random tables with NULLs and NaN)."""

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.rules import Rule, quality_report

DDL = "k1 int, k2 string, x double, d string"

rows_st = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)),
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        st.one_of(st.none(), st.just(float("nan")), st.floats(-5, 15, allow_nan=False)),
        st.one_of(st.none(), st.sampled_from(["2020-01-01", "2021-06-30", "1999-12-31", "bad"])),
    ),
    max_size=40,
)

RULES = [
    Rule("NOT_NULL", "x"),
    Rule("NON_NEGATIVE", "x"),
    Rule("NUMERIC_RANGE", "x", value="0,10"),
    Rule("ALLOWED_VALUES", "k2", value="a, b"),
    Rule("REGEX", "k2", value="^[ab]$"),
    Rule("DATE_RANGE", "d", value="2000-01-01,2020-12-31"),
    Rule("NULL_PERCENTAGE", "d", threshold=25.0),
    Rule("DUPLICATE_KEY", "k1"),
    Rule("DUPLICATE_KEY", "k1, k2"),
    Rule("DUPLICATE_KEY", "k2"),
    Rule("DUPLICATE_ROW"),
]


def _isnull(v):
    return v is None


def _nan_eq_key(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def brute(rows):
    out = {}
    xs = [r[2] for r in rows]
    out["x Not Null Validation"] = sum(v is None for v in xs)
    out["x Non-Negative Validation"] = sum(v is not None and not math.isnan(v) and v < 0 for v in xs)
    out["x Numeric Range Validation"] = sum(
        v is not None and (math.isnan(v) or v < 0 or v > 10) for v in xs)
    out["k2 Allowed Values Validation"] = sum(r[1] is not None and r[1] not in ("a", "b") for r in rows)
    out["k2 Regex Validation"] = sum(r[1] is not None and r[1] not in ("a", "b") for r in rows)

    def date(s):
        try:
            return dt.date.fromisoformat(s)
        except (TypeError, ValueError):
            return None

    lo, hi = dt.date(2000, 1, 1), dt.date(2020, 12, 31)
    out["d Date Range Validation"] = sum(
        date(r[3]) is not None and (date(r[3]) < lo or date(r[3]) > hi) for r in rows)
    out["d Null Percentage Validation"] = sum(r[3] is None for r in rows)

    def dup(keyf):
        c = Counter(keyf(r) for r in rows if all(v is not None for v in keyf(r)))
        return sum(n for n in c.values() if n > 1)

    out["k1 Duplicate Key Validation"] = dup(lambda r: (r[0],))
    out["k1, k2 Duplicate Key Validation"] = dup(lambda r: (r[0], r[1]))
    out["k2 Duplicate Key Validation"] = dup(lambda r: (r[1],))
    full = Counter(tuple(_nan_eq_key(v) for v in r) for r in rows)
    out["Duplicate Row Validation"] = sum(n - 1 for n in full.values())
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_fused_report_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    got = {r.rule_name: r.failed_records for r in quality_report(df, RULES).collect()}
    assert got == brute(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_fingerprint_mode_matches_exact(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    fp_rules = [r if r.kind != "DUPLICATE_ROW" else Rule("DUPLICATE_ROW", value="fingerprint")
                for r in RULES]
    got = {r.rule_name: r.failed_records for r in quality_report(df, fp_rules).collect()}
    assert got == brute(rows)


WIDE_DDL = ("t timestamp, n timestamp_ntz, m map<string,double>, a array<double>, "
            "s struct<x:double, y:string>, b binary, d decimal(20,6)")
_float = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")]))
_micros = st.one_of(st.none(), st.integers(0, 2).map(
    lambda k: dt.datetime(2024, 10, 27, 1, 30, 0, 999_998) + dt.timedelta(microseconds=k)))
wide_st = st.lists(st.tuples(
    _micros, _micros,
    st.one_of(st.none(), st.permutations(["p", "q"]).flatmap(
        lambda ks: st.tuples(_float, _float).map(lambda vs: dict(zip(ks, vs))))),
    st.one_of(st.none(), st.lists(_float, max_size=2)),
    st.one_of(st.none(), st.tuples(_float, st.sampled_from(["", "null", None]))),
    st.one_of(st.none(), st.sampled_from([b"", b"\x00", b"0"])),
    st.one_of(st.none(), st.integers(0, 1).map(lambda k: Decimal(k) / 1_000_000)),
), min_size=4, max_size=30).map(lambda rows: rows + rows[::3])


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=wide_st)
def test_fingerprint_tells_apart_what_grouping_does(spark, rows):
    df = spark.createDataFrame(rows, WIDE_DDL)
    for columns in (df.columns, ["t"], ["m"], ["s", "a"]):
        part = df.select(*columns)
        exact, prints = (quality_report(part, [Rule("DUPLICATE_ROW", value=v)]).first().failed_records
                         for v in (None, "fingerprint"))
        assert exact == prints, columns
