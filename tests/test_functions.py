import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright import functions as fn


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def results(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_days_crossed_counts_midnights(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-01 23:59:00' AS a, TIMESTAMP_NTZ'2020-01-02 00:01:00' AS b")
    assert df.select(fn.days_crossed("a", "b"), fn.days_crossed("b", "a")).first() == (1, -1)


def test_months_crossed_counts_boundaries(spark):
    df = spark.sql("SELECT DATE'2020-01-31' AS a, DATE'2020-02-01' AS b, DATE'2021-01-01' AS c")
    assert df.select(fn.months_crossed("a", "b"), fn.months_crossed("a", "c"), fn.months_crossed("b", "a")).first() == (
        1,
        12,
        -1,
    )


def test_day_and_year_ranges_include_both_ends(spark):
    times = ["2019-12-31 23:59:59", "2020-01-01 00:00:00", "2020-12-31 23:59:59.999999", "2021-01-01 00:00:00", None]
    df = column(spark, times).withColumn("c", F.col("c").cast("timestamp_ntz"))
    assert results(df, fn.in_years("c", "2020")) == [False, True, True, False, None]
    assert results(df, fn.on_days("c", "2020-01-01", dt.date(2020, 12, 31))) == [False, True, True, False, None]
    assert results(df, fn.on_days("c", "2020-12-31")) == [False, False, True, False, None]


def test_day_range_reaches_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = lines.filter(fn.on_days("l_shipdate", "1998-07-01")).select("l_orderkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_visible_length_ignores_trailing_blanks(spark):
    assert results(column(spark, ["abc   ", "  abc", "", None]), fn.visible_length("c")) == [3, 5, 0, None]


def test_contains_ignoring_case(spark):
    assert results(column(spark, ["Red MUG", "mugs", "cup"]), fn.contains_ignoring_case("c", "mug")) == [True, True, False]


def test_json_value_is_scalar_only(spark):
    document = '{"a": {"b": 1}, "Events": [{"x": 1}, {"Comment": "again"}], "s": "t", "n": 5, "o": "{\\"x\\": 1}", "e": ""}'
    df = column(spark, [document])
    paths = ["$.a", "$.Events", "$.Events[1].Comment", "$.s", "$.n", "$.none", "$.Events[5].Comment", "$.o", "$['s']", "$.e", '$."n"', '$.Events[1]."Comment"']
    assert [results(df, fn.json_value("c", p))[0] for p in paths] == [None, None, "again", "t", "5", None, None] + ['{"x": 1}', "t", "", "5", "again"]


def test_dashed_phone(spark):
    values = ["2025550123", "202-555-0123", "123", "", None]
    assert results(column(spark, values), fn.dashed_phone("c")) == ["202-555-0123", "202-555-0123", "123", "", None]


NAMES = ["  aNNA  ", "o'neil", "jean-luc", "x1y2", "élan vital", "MÜLLER", "", " \t ", "a", "mc donald iii", "d’arc"]


def test_title_case_equals_python(spark):
    assert results(column(spark, NAMES), fn.title_case("c")) == [n.strip().title() for n in NAMES]
    assert results(column(spark, [None]), fn.title_case("c")) == [None]


# Latin, Greek and Cyrillic letters without one-to-many case mappings.
LETTERS = st.text(alphabet="abzAZéÉñçÖäωΩжЖ '-.,0179\t", max_size=25)


@settings(max_examples=20, deadline=None)
@given(st.lists(LETTERS, min_size=1, max_size=30))
def test_title_case_property(spark, names):
    assert results(column(spark, names), fn.title_case("c")) == [n.strip().title() for n in names]


def test_whole_average_truncates_toward_zero(spark):
    df = spark.sql("SELECT CAST(-7 AS BIGINT) AS s, CAST(2 AS BIGINT) AS n")
    assert df.select(F.expr("s div n")).first()[0] == -3


def test_a_bad_date_is_an_error_with_cast_and_null_with_try_cast(spark):
    df = column(spark, ["2018-01-025"])
    assert results(df, F.col("c").try_cast("date")) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(F.col("c").cast("date")).collect()
