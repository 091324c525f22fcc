import datetime
import fractions
import itertools

import pytest

from marquee import workload
from marquee.operators import (
    agg_distinct,
    agg_first,
    agg_mean,
    agg_stddev,
    daily_average,
    low_rated_absolute,
    low_rated_relative,
)
from marquee.schemas import ReviewColumns

DAY = datetime.date(2024, 6, 1)


def test_measures(spark):
    rows = [("a", 1.0, "x"), ("a", 3.0, "x"), ("a", None, None), ("b", 5.0, "y"), ("c", None, None), (None, 2.0, "z")]
    df = spark.createDataFrame(rows, "g string, v double, t string")
    result = {
        r.g: tuple(r)[1:]
        for r in df.groupBy("g").agg(agg_mean("v"), agg_stddev("v"), agg_distinct("t", "n")).collect()
    }
    assert result["a"] == (2.0, pytest.approx(2**0.5), 1)
    assert result["b"] == (5.0, None, 1)
    assert result["c"] == (None, None, 0)
    assert result[None] == (2.0, None, 1)


def test_measure_names(spark):
    df = spark.createDataFrame([(1, 1.0)], "g int, v double")
    names = df.groupBy("g").agg(agg_mean("v"), agg_stddev("v"), agg_distinct("v"), agg_first("v")).columns
    assert names == ["g", "Avg_v", "StdDev_v", "Distinct_v", "v"]


def test_agg_first_by(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, None)], "g int, o int, v string")
    for parts in (1, 5):
        got = df.repartition(parts).groupBy("g").agg(agg_first("v", "o", "first"))
        assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]


def reviews(spark, rows):
    return spark.createDataFrame(
        rows,
        "Review_ID string, Movie_ID string, Review_Date date, Review_Rating double, Overall_Rating double",
    )


def test_low_rated_absolute_is_strict_and_ignores_missing(spark):
    df = reviews(
        spark,
        [
            ("1", "exact", DAY, 5.0, None),
            ("2", "exact", DAY, 7.0, None),
            ("3", "low", DAY, 5.9, None),
            ("4", "none", DAY, None, None),
            ("5", None, None, 1.0, None),
        ],
    )
    got = {(r.Movie_ID, r.Daily_Average_Rating) for r in low_rated_absolute(daily_average(df)).collect()}
    assert got == {("low", 5.9), (None, 1.0)}


def test_low_rated_relative_is_inclusive(spark):
    df = reviews(
        spark,
        [
            ("1", "exact", DAY, 5.0, 8.0),
            ("2", "near", DAY, 5.5, 8.0),
            ("3", "no overall", DAY, 1.0, None),
            ("4", "days", DAY, 1.0, 8.0),
            ("5", "days", DAY + datetime.timedelta(1), 9.0, 8.0),
        ],
    )
    got = low_rated_relative(daily_average(df, with_overall=True, first_by="Review_ID"))
    assert got.columns == [
        "Movie_ID",
        "Review_Date",
        "Daily_Average_Rating",
        "Overall_Rating",
        "Rating_Difference",
    ]
    assert sorted((r.Movie_ID, r.Rating_Difference) for r in got.collect()) == [("days", 7.0), ("exact", 3.0)]


def test_low_rated_relative_rounding(spark):
    rows = [(str(i), "m", DAY, 4.0 if i == 0 else 3.0, 6.1) for i in range(10)]
    daily = daily_average(reviews(spark, rows), with_overall=True)
    assert low_rated_relative(daily).count() == 0
    assert low_rated_relative(daily, digits=9).count() == 1


def test_daily_average_has_no_order(spark):
    """Plain sums of these give 0.6000000000000001 or 0.6, and 1e13 takes the decimals of what comes after it."""
    for values in ([0.1, 0.2, 0.3], [1e13, 0.1, 0.2, -1e13], [1 / 3, 1e-11, 7.0], [float("nan"), 1.0], [1e300, 1e300]):
        means = set()
        for order in itertools.permutations(values):
            df = reviews(spark, [(str(i), "m", DAY, v, None) for i, v in enumerate(order)]).coalesce(1)
            means.add(str(daily_average(df).first().Daily_Average_Rating))
        exact = fractions.Fraction(0) if values[0] != values[0] else sum(fractions.Fraction(str(v)) for v in values) / len(values)
        assert means == {"nan" if values[0] != values[0] else str(float(exact))}


@pytest.mark.parametrize("query", ["low_rated_relative", "low_rated_stream_relative", "low_rated_stream_repeats"])
def test_gap_of_exactly_the_threshold_counts(spark, tmp_path, query):
    """Means of 48.8 and 18.8 lie exactly 30 apart, as doubles 29.999999999999996; those of user 2 a cent less in sum."""
    values = {1: [18.8, 53.6, *[53.0] * 6], 2: [18.8, 53.59, *[53.0] * 6]}
    rows = [
        (8 * u + i, datetime.datetime(2024, 1, 1 + i), u, "view", v, "{}") for u, of in values.items() for i, v in enumerate(of)
    ]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = workload.QUERIES[query](spark, str(tmp_path)).collect()
    assert [(r.user_id, r.day, r.Rating_Difference) for r in found] == [(1, datetime.date(2024, 1, 1), 30.0)]


def test_column_roles(spark):
    columns = ReviewColumns("id", "item", "day", "stars", "mean")
    df = spark.createDataFrame([(1, "m", DAY, 1, 5.0)], "id int, item string, day date, stars bigint, mean double")
    got = low_rated_relative(daily_average(df, columns, with_overall=True), 4.0, columns).first()
    assert tuple(got) == ("m", DAY, 1.0, 5.0, 4.0)
