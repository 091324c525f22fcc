import datetime

import pytest
from pyspark.sql import functions as F

from marquee.functions import (
    bucket_floor,
    decade_of,
    parse_date,
    rating_gap,
    split_tags,
    strip_unit,
    to_double,
    to_int,
)


def values(spark, column, inputs, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def test_strip_unit(spark, ansi):
    texts = ["142 min", "142", "min", "", None, " min7 min", "142.5 min", "9 hours"]
    assert values(spark, strip_unit("v"), texts, "string") == [142, 142, None, None, None, 7, 142, None]


def test_strip_other_unit_is_taken_literally(spark):
    assert values(spark, strip_unit("v", ".km"), ["3.km", "3xkm"], "string") == [3, None]


def test_to_int(spark, ansi):
    assert values(spark, to_int("v"), ["12", "-3.9", " 4 ", "PG", "1e3", None], "string") == [
        12,
        -3,
        4,
        None,
        None,
        None,
    ]
    assert values(spark, to_int("v"), [1994, 1 << 40, None], "bigint") == [1994, None, None]


def test_to_int_forms(spark):
    texts = ["+7", "-0", "\t8\n", ".5", "1,5", "99999999999", "9" * 30, "1 2", "0x1"]
    assert values(spark, to_int("v"), texts, "string") == [7, 0, 8, None, None, None, None, None, None]
    assert values(spark, to_int("v"), [1.9, -1.9, None], "double") == [1, -1, None]


def test_conversions_are_settled_by_type_before_execution(spark):
    df = spark.createDataFrame([(1, 2.0)], "n int, x double").select(to_int("n").alias("a"), to_double("x").alias("b"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper() and "CASE" not in plan


def test_to_double_accepts_what_a_cast_accepts(spark):
    texts = ["1", "+1.", ".5", "-.5e-3", "1E5", "NaN", "inf", "-Infinity", " 2 ", "1d", "0x1p3"]
    texts += ["", ".", "-", "e5", "1,0", "1 2", "n/a", "abc", "infin", "1..2", "12abc", "$1"]
    got = values(spark, to_double("v"), texts, "string")
    plain = values(spark, F.col("v").try_cast("double"), texts, "string")
    assert list(map(str, got)) == list(map(str, plain))
    assert got[0] == 1.0 and got[11] is None


def test_to_double(spark, ansi):
    assert values(spark, to_double("v"), ["28,341", "1.5", "", None], "string") == [None, 1.5, None, None]
    assert values(spark, to_double("v"), [3, None], "bigint") == [3.0, None]


def test_decade_of(spark, ansi):
    assert values(spark, decade_of("v"), [1994, 1990, 1989, -5, 0, None], "bigint") == [
        1990,
        1990,
        1980,
        -10,
        0,
        None,
    ]
    assert values(spark, decade_of("v"), ["1994", "PG", None], "string") == [1990, None, None]


def test_bucket_floor_width(spark):
    assert values(spark, bucket_floor("v", 25), [99, 100, -1], "int") == [75, 100, -25]


def test_parse_date(spark, ansi):
    june = datetime.date(2024, 6, 1)
    texts = ["6/1/2024", "06/01/2024", "2024-06-01", "13/1/2024", "", None]
    assert values(spark, parse_date("v"), texts, "string") == [june, june, None, None, None, None]


def test_split_tags(spark):
    texts = [" Drama,Crime, War ", "", "A", None]
    assert values(spark, split_tags("v"), texts, "string") == [["Drama,Crime", "War"], [""], ["A"], None]
    assert values(spark, split_tags("v", "|"), ["a|b"], "string") == [["a", "b"]]


def test_rating_gap(spark):
    df = spark.createDataFrame([(6.1, 3.1), (None, 3.0), (5.0, None)], "o double, d double")
    plain = [r[0] for r in df.select(rating_gap("o", "d")).collect()]
    assert plain == [2.9999999999999996, None, None]
    assert df.select(rating_gap(F.col("o"), F.col("d"), 9)).first()[0] == 3.0


def test_leading_zeros_are_no_digits(spark):
    df = spark.createDataFrame([("0000000000000000000142 min",), ("-00007",), ("0" * 40,)], "t string")
    assert [r[0] for r in df.select(strip_unit("t")).collect()] == [142, -7, 0]
