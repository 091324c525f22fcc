import math

from marquee.functions import strip_unit, to_double
from marquee.operators import cleaning_report, drop_missing, fill_missing


def test_fill_missing_covers_null_and_nan(spark):
    df = spark.createDataFrame([(None, None, None), (math.nan, 3, "x")], "a double, b int, c string")
    filled = fill_missing(df, {"a": 0, "b": 0, "c": "unknown", "absent": 1}).collect()
    assert [tuple(r) for r in filled] == [(0.0, 0, "unknown"), (0.0, 3, "x")]


def test_number_filled_into_text_is_text(spark):
    df = spark.createDataFrame([(None,)], "a string")
    assert fill_missing(df, {"a": "0"}).first()[0] == "0"


def test_drop_missing_matches_dropna(spark):
    rows = [(1.0, "a", 1), (math.nan, "b", 2), (None, "c", 3), (2.0, None, 4), (3.0, "", None)]
    df = spark.createDataFrame(rows, "x double, y string, z int")
    kept = sorted(r.z or 0 for r in drop_missing(df, ["x", "y"]).collect())
    assert kept == sorted(r.z or 0 for r in df.dropna(subset=["x", "y"]).collect()) == [0, 1]


def test_drop_missing_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(str(tmp_path / "t"))
    df = drop_missing(spark.read.parquet(str(tmp_path / "t")), ["x", "y"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(x)" in plan and "IsNotNull(y)" in plan


def test_cleaning_report_counts_both_drops(spark):
    rows = [("90 min", "1.5"), ("n/a", "1.5"), (None, "2"), ("80 min", "28,341")]
    df = spark.createDataFrame(rows, "Runtime string, Gross string")
    conversions = {"Runtime": strip_unit("Runtime"), "Gross": to_double("Gross")}
    assert tuple(cleaning_report(df, ["Runtime", "Gross"], conversions).first()) == (4, 3, 1)
    assert tuple(cleaning_report(df, ["Runtime"]).first()) == (4, 3, 3)


def test_cleaning_report_of_nothing(spark):
    df = spark.createDataFrame([], "Runtime string")
    assert tuple(cleaning_report(df, ["Runtime"]).first()) == (0, 0, 0)
