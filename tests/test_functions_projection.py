import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError, ValidationError
from stratum.functions import columns as fn
from stratum.operators.projection import get_transform
from stratum.plans.refine import check_output


def col_values(spark, values, expr, ddl="x string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


NAMES = {
    "unitPrice2Go": "unit_price2_go", "Lap Time-ms": "lap_time_ms", "ABCdef": "abcdef", "x": "x", "": "",
    "a  - b": "a_b", " lead": "_lead", "tail\u00a0": "tail_", "thin\u2009space": "thin_space", "naïveÉtat": "naïveétat",
    "kept_asIs": "kept_as_is", "tab\tNew\nline": "tab_new_line", "sep\x1funit": "sep_unit", "9Lives": "9_lives",
    "ΑΣ": "ας", "ΟΔΟΣ Name": "οδος_name",
}


def test_snake_case(spark):
    got = col_values(spark, [*NAMES, None], fn.snake_case)
    assert got == [*NAMES.values(), None]
    assert [fn.snake_case_name(x) for x in NAMES] == list(NAMES.values())  # the name form agrees


def test_safe_strip_equals_python(spark):
    texts = ["plain", " \u2003both\u00a0 ", "\x1c\x1d in\x1e side \x1f", "\r\n", "\x0b\x0c", "", "\u200bkept\u200b", None]
    assert col_values(spark, texts, fn.safe_strip) == [t.strip() or None if t is not None else None for t in texts]


def test_null_marker(spark):
    assert col_values(spark, ["\\N", "\\n", " \\N", "N", "", None], fn.replace_null_marker) == [
        None, "\\n", " \\N", "N", "", None]
    assert col_values(spark, ["--", "-"], lambda c: fn.replace_null_marker(c, "--")) == [None, "-"]


def test_truncate(spark):
    texts = ["é" * 21, "é" * 20, "🙂" * 25, "", None]
    got = col_values(spark, texts, lambda c: fn.truncate_text(c, 20))
    assert got == ["é" * 17 + "...", "é" * 20, "🙂" * 17 + "...", "", None]


def test_format_duration(spark):
    values = [7.99, 59.999, 60.0, 7384.2, 0.4, -0.4, -83.4, -60.0, None, float("nan")]
    got = col_values(spark, values, fn.format_duration, "x double")
    assert got == ["7s", "59s", "1m 0s", "123m 4s", "0s", "0s", "-2m 37s", "-1m 0s", None, None]


def test_flatten_drivers(spark):
    rows = [("2001-02-29", "d-7", ("Okafor", None), "NG", None), ("1985-12-31", "d-8", None, None, "u8")]
    df = spark.createDataFrame(
        rows, "dateOfBirth string, driverId string, name struct<familyName:string, givenName:string>, "
        "nationality string, url string")
    got = sorted(map(tuple, get_transform("transform_drivers")(df).select(
        "driver_id", "firstname", "surname", "date_of_birth", "nationality", "url").collect()))
    assert got == [("d-7", None, "Okafor", None, "NG", None), ("d-8", None, None, dt.date(1985, 12, 31), None, "u8")]


def test_races_string_to_int_and_date(spark):
    rows = [("1998", "07", None, "Night Race", "1998-7-4", "c1"), ("x", "", "u", None, "", None)]
    df = spark.createDataFrame(rows, "season string, round string, url string, raceName string, "
                                     "date string, circuitId string")
    got = [r.asDict() for r in get_transform("transform_races")(df).collect()]
    assert [(r["season"], r["round"], r["race_date"]) for r in got] == [
        (1998, 7, dt.date(1998, 7, 4)), (None, None, None)]
    assert (got[0]["circuit_id"], got[1]["url"]) == ("c1", "u")


def test_malformed_cast_gives_null(spark):
    df = spark.createDataFrame([("1", "u", "C", "\\N", "n/a", "L", "X")],
                               "circuitId string, url string, circuitName string, lat string, "
                               "long string, locality string, country string")
    r = get_transform("transform_circuits")(df).first()
    assert r.latitude is None and r.longitude is None
    assert list(get_transform("transform_circuits")(df).columns) == [
        "circuit_id", "circuit_name", "latitude", "longitude", "locality", "country", "url"]


def test_unknown_transform(spark):
    with pytest.raises(ConfigurationError):
        get_transform("transform_nothing")


def test_output_checks(spark):
    df = spark.createDataFrame([("a", "b", 1, -1.0)], "x string, y string, grid long, points double")
    check_output("unregistered_entity", df)  # no checks, no error
    bad = spark.createDataFrame([(None, "c", -1, 1.0)],
                                "driver_id string, constructor_id string, grid long, points double")
    with pytest.raises(ValidationError) as e:
        check_output("results", bad)
    msg = str(e.value)
    assert msg.startswith("Silver validation failed for entity 'results': ")
    assert "NULL values found in 'driver_id'" in msg and "negative value in 'grid'" in msg


def test_sql_functions_agree_with_column_functions(spark):
    from stratum.functions.sql import register_sql_functions

    register_sql_functions(spark)
    marker = "\\N"  # the two characters backslash, N
    texts = [*NAMES, None, marker, " \u2009 ", "y" * 501, "2031-02-29", "1987-06-05"]
    df = spark.createDataFrame([(t, float(i) * 37.3) for i, t in enumerate(texts)], "x string, s double")
    df.createOrReplaceTempView("fn_input")
    got = spark.sql(
        "SELECT snake_case(x) a, safe_strip(x) b, replace_null_marker(x, m) c, "
        "truncate_text(x, 500) d, format_duration(s) e, safe_year(x) f "
        "FROM fn_input CROSS JOIN (SELECT '\\\\N' AS m)").collect()
    exp = df.select(fn.snake_case("x").alias("a"), fn.safe_strip("x").alias("b"),
                    fn.replace_null_marker("x").alias("c"), fn.truncate_text("x", 500).alias("d"),
                    fn.format_duration("s").alias("e"), fn.safe_year("x").alias("f")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in exp]
    by_text = dict(zip(texts, exp))
    assert by_text[marker]["c"] is None and by_text["tail\u00a0"]["b"] == "tail" and by_text[" \u2009 "]["b"] is None
    assert by_text["1987-06-05"]["f"] == 1987 and by_text["2031-02-29"]["f"] is None
