import pytest

from stratum.errors import ConfigurationError
from stratum.operators.rules import Rule, gate, gate_passed, load_rules, quality_report, rules_for


def one(report):
    rows = report.collect()
    assert len(rows) == 1
    return rows[0]


def by_type(report):
    return {r["rule_type"]: r for r in report.collect()}


# ---- one table, every rule: the failing rows are known by construction

ORDERS = [  # id, status, code, amount, placed, note
    (1, "open", "AX-10", 12.5, "2015-03-01", None),
    (2, "open", "AX-11", -3.0, "2031-01-01", None),
    (2, "shut", "ax-11", 0.0, "not a date", "late"),
    (4, None, None, 480.25, None, None),
    (5, "lost", "AX-1", None, "1989-12-31", None),
    (5, "lost", "AX-1", None, "1989-12-31", None),
    (5, "lost", "AX-1", None, "1989-12-31", None),
]
ORDERS_DDL = "id int, status string, code string, amount double, placed string, note string"

CASES = [
    (Rule("DUPLICATE_KEY", "id"), 5, "ERROR", "id Duplicate Key Validation",
     "5 record(s) belong to duplicate business keys in 'id'."),
    (Rule("DUPLICATE_KEY", "id, status"), 3, "ERROR", "id, status Duplicate Key Validation",
     "3 record(s) belong to duplicate business keys in 'id, status'."),
    (Rule("DUPLICATE_ROW"), 2, "WARNING", "Duplicate Row Validation", "Found 2 duplicate row(s)."),
    (Rule("ALLOWED_VALUES", "status", value=" open ,shut"), 3, "ERROR", "status Allowed Values Validation",
     "3 record(s) contain invalid values for 'status'."),
    (Rule("REGEX", "code", value=r"^AX-\d\d$"), 4, "ERROR", "code Regex Validation",
     "4 record(s) failed regex validation."),
    (Rule("NUMERIC_RANGE", "amount", value="-1,300"), 2, "ERROR", "amount Numeric Range Validation",
     "2 record(s) are outside [-1.0, 300.0]."),
    (Rule("DATE_RANGE", "placed", value="1990-01-01,2030-12-31"), 4, "ERROR", "placed Date Range Validation",
     "4 record(s) are outside 1990-01-01 - 2030-12-31."),
    (Rule("NULL_PERCENTAGE", "note", threshold=50.0), 6, "WARNING", "note Null Percentage Validation",
     "NULL percentage 85.71% exceeds threshold 50.00%."),
    (Rule("NOT_NULL", "amount"), 3, "ERROR", "amount Not Null Validation", "3 NULL values found in 'amount'."),
    (Rule("NON_NEGATIVE", "amount"), 1, "ERROR", "amount Non-Negative Validation",
     "1 record(s) have a negative value in 'amount'."),
    (Rule("SCHEMA", expected=("id", "status", "code", "amount", "when")), 1, "ERROR", "Schema Validation",
     "Missing columns: ['when']; Unexpected columns: ['placed', 'note']"),
    (Rule("REQUIRED_COLUMN", expected=("id", "buyer")), 1, "ERROR", "Required Columns Validation",
     "Missing columns: ['buyer']"),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: c[3])
def test_each_rule_alone(spark, case):
    rule, failed, severity, name, details = case
    r = one(quality_report(spark.createDataFrame(ORDERS, ORDERS_DDL), [rule]))
    assert (r.passed, r.failed_records, r.severity, r.rule_name, r.details) == (
        False, failed, severity, name, details)


@pytest.mark.parametrize("duplicate_rows", [True, False])
def test_all_rules_together(spark, duplicate_rows):
    cases = [c for c in CASES if duplicate_rows or c[0].kind != "DUPLICATE_ROW"]
    rep = quality_report(spark.createDataFrame(ORDERS, ORDERS_DDL), [c[0] for c in cases])
    assert {r.rule_name: (r.failed_records, r.details) for r in rep.collect()} == {
        c[3]: (c[1], c[4]) for c in cases}


def test_null_share_at_and_below_the_threshold(spark):
    few = spark.createDataFrame([(k if k % 8 else None,) for k in range(40)], "k int")
    r = one(quality_report(few, [Rule("NULL_PERCENTAGE", "k", threshold=12.5)]))
    assert (r.passed, r.failed_records, r.details) == (True, 5, "")
    r = one(quality_report(few.limit(0), [Rule("NULL_PERCENTAGE", "k", threshold=0.0)]))
    assert (r.passed, r.failed_records, r.details) == (True, 0, "")


def test_only_errors_close_the_gate(spark):
    df = spark.createDataFrame(ORDERS, ORDERS_DDL)
    soft = quality_report(df, [Rule("NOT_NULL", "id"), Rule("DUPLICATE_ROW")])
    hard = quality_report(df, [Rule("NOT_NULL", "id"), Rule("DUPLICATE_ROW", severity="ERROR")])
    assert gate_passed(soft) and not gate_passed(hard)
    assert tuple(gate(hard).first()) == (False, 2, 1, 1)
    assert tuple(gate(quality_report(df, [])).first()) == (True, 0, 0, 0)


# ---- NULLs, NaN, nested columns, parameters


def test_null_keys_not_counted(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",)], "k string")
    r = one(quality_report(df, [Rule("DUPLICATE_KEY", "k")]))
    assert r.failed_records == 2


def test_composite_key_with_nulls(spark):
    rows = [(1, "x"), (1, "x"), (1, None), (1, None), (2, "y")]
    df = spark.createDataFrame(rows, "a int, b string")
    r = by_type(quality_report(df, [Rule("DUPLICATE_KEY", "a, b")]))["DUPLICATE_KEY"]
    assert r.failed_records == 2
    assert r.rule_name == "a, b Duplicate Key Validation"


def test_subset_and_full_keys(spark):
    rows = [(1, 1, "p"), (1, 1, "p"), (1, 2, "q"), (2, 1, None)]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    rep = quality_report(df, [Rule("DUPLICATE_KEY", "a, b"), Rule("DUPLICATE_KEY", "a"),
                              Rule("DUPLICATE_KEY", "b"), Rule("DUPLICATE_ROW"),
                              Rule("NOT_NULL", "c")])
    got = {r.rule_name: r.failed_records for r in rep.collect()}
    assert got == {
        "a, b Duplicate Key Validation": 2,
        "a Duplicate Key Validation": 3,
        "b Duplicate Key Validation": 3,
        "Duplicate Row Validation": 1,
        "c Not Null Validation": 1,
    }


def test_duplicate_rows_null_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "k string, v string")
    assert one(quality_report(df, [Rule("DUPLICATE_ROW")])).failed_records == 1


def test_nan_semantics(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,)], "x double")
    rep = by_type(quality_report(df, [Rule("NUMERIC_RANGE", "x", value="0,10"),
                                      Rule("NON_NEGATIVE", "x")]))
    assert rep["NUMERIC_RANGE"].failed_records == 1  # NaN > max
    assert rep["NON_NEGATIVE"].failed_records == 0   # NaN < 0 is false


def test_malformed_values_are_null_and_pass(spark):
    df = spark.createDataFrame([("\\N",), ("12",), ("not a number",)], "x string")
    rep = by_type(quality_report(df, [Rule("NUMERIC_RANGE", "x", value="0,10"),
                                      Rule("DATE_RANGE", "x", value="2000-01-01,2001-01-01")]))
    assert rep["NUMERIC_RANGE"].failed_records == 1
    assert rep["DATE_RANGE"].failed_records == 0


def test_allowed_values_on_numeric_column(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    r = one(quality_report(df, [Rule("ALLOWED_VALUES", "x", value="1, 2")]))
    assert r.failed_records == 1


def test_missing_column_is_failed_result(spark):
    df = spark.createDataFrame([(1,)], "id int")
    rep = by_type(quality_report(df, [Rule("NOT_NULL", "nope"), Rule("DUPLICATE_KEY", "nope")]))
    assert not rep["NOT_NULL"].passed and "not found" in rep["NOT_NULL"].details
    assert not rep["DUPLICATE_KEY"].passed


def test_metadata_severity_wins(spark):
    df = spark.createDataFrame([(None,)], "c string")
    r = one(quality_report(df, [Rule("NOT_NULL", "c", severity="WARNING")]))
    assert r.severity == "WARNING"
    assert gate_passed(quality_report(df, [Rule("NOT_NULL", "c", severity="WARNING")]))


def test_row_count_in_same_pass(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    rep = by_type(quality_report(df, [Rule("NOT_NULL", "c")], count_rows=True))
    assert rep["ROW_COUNT"].failed_records == 3 and rep["ROW_COUNT"].passed


def test_bad_parameters_raise(spark):
    df = spark.createDataFrame([(1,)], "c int")
    with pytest.raises(ConfigurationError):
        quality_report(df, [Rule("NUMERIC_RANGE", "c", value="0")])
    with pytest.raises(ConfigurationError):
        quality_report(df, [Rule("DATE_RANGE", "c", value="2020-13-01,2021-01-01")])
    with pytest.raises(ConfigurationError):
        quality_report(df, [Rule("NO_SUCH_RULE", "c")])


def test_rules_from_table(spark):
    from stratum.operators.rules import RULES_DDL

    rows = [("e", "A", "NOT_NULL", "c", None, None, "ERROR", True),
            ("e", "B", "NOT_NULL", "d", None, None, None, False),
            ("f", "C", "SCHEMA", None, None, None, None, True),
            ("e", "D", "SCHEMA", None, None, None, None, True),
            ("e", "E", "NOT_A_RULE", "c", None, None, "ERROR", True)]
    rules_df = spark.createDataFrame(rows, RULES_DDL)
    assert rules_for(rules_df, "e").count() == 3
    rules = load_rules(rules_df, "e", expected_columns=["c"])
    kinds = sorted(r.kind for r in rules)
    assert kinds == ["NOT_NULL", "SCHEMA"]
    schema_rule = next(r for r in rules if r.kind == "SCHEMA")
    assert schema_rule.expected == ("c",)
    with pytest.raises(ConfigurationError):
        quality_report(spark.createDataFrame([(1,)], "c int"),
                       load_rules(rules_df, "e", skip_unknown=False))


def test_duplicate_rows_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (2, {"b": 2})],
                               "id int, m map<string,int>")
    for value in (None, "fingerprint"):
        rep = {x.rule_type: x.failed_records for x in quality_report(
            df, [Rule("DUPLICATE_ROW", value=value), Rule("DUPLICATE_KEY", "id")]).collect()}
        assert rep == {"DUPLICATE_ROW": 1, "DUPLICATE_KEY": 2}


def test_nested_column_paths(spark):
    df = spark.createDataFrame(
        [("1", ("Hamilton", "Lewis")), ("2", ("Hamilton", "Lewis")), ("3", ("Verstappen", None))],
        "driverId string, name struct<familyName:string, givenName:string>")
    rep = {r.rule_name: (r.failed_records, r.details) for r in quality_report(df, [
        Rule("NOT_NULL", "name.givenName"),
        Rule("DUPLICATE_KEY", "name.familyName, name.givenName"),
        Rule("DUPLICATE_KEY", "name.familyName"),
        Rule("DUPLICATE_ROW"),
    ]).collect()}
    assert rep["name.givenName Not Null Validation"][0] == 1
    assert rep["name.familyName, name.givenName Duplicate Key Validation"] == (
        2, "2 record(s) belong to duplicate business keys in 'name.familyName, name.givenName'.")
    assert rep["name.familyName Duplicate Key Validation"][0] == 2
    assert rep["Duplicate Row Validation"][0] == 0


def test_referential_rule_from_metadata(spark):
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99), (5, 99)],
                                  "id int, cust int")
    dims = spark.createDataFrame([(10,), (11,)], "c_id int")
    dims.createOrReplaceTempView("dims_for_ref_test")
    rules = [Rule("REFERENTIAL", "cust", value="dims.c_id", label="Known customer"),
             Rule("NOT_NULL", "cust")]
    rep = {r.rule_type: r for r in
           quality_report(facts, rules, references={"dims": dims}, with_label=True).collect()}
    assert (rep["REFERENTIAL"].failed_records, rep["REFERENTIAL"].passed) == (2, False)
    assert rep["REFERENTIAL"].rule_label == "Known customer"
    assert rep["NOT_NULL"].failed_records == 1
    via_catalog = quality_report(facts, [Rule("REFERENTIAL", "cust", value="dims_for_ref_test.c_id")])
    assert via_catalog.first().failed_records == 2
    with pytest.raises(ConfigurationError):
        quality_report(facts, [Rule("REFERENTIAL", "cust", value="no_column_given")])


def test_schema_rule_needs_registered_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ConfigurationError):
        quality_report(df, [Rule("SCHEMA")])
