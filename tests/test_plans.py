import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee.plans import (
    clean_catalogue,
    decade_trends,
    prepare_revenue_rows,
    revenue_model,
    revenue_report,
    tag_ratings,
)
from marquee.schemas import CatalogueColumns, SupplementColumns

COLUMNS = CatalogueColumns(rating="Stars")
SCHEMA = (
    "Series_Title string, Released_Year string, Runtime string, Genre string, Stars double, "
    "Overview string, Director string, No_of_Votes bigint, Gross string, Certificate string"
)
ITEMS = [
    ("A", "1994", "100 min", "Drama, War", 8.0, "sea ship", "X", 10, "5", "U"),
    ("B", "1999", None, "Drama", 6.0, "star moon", "Y", None, "28,341", "U"),
    ("B", "1990", "50 min", "Drama", None, None, None, 5, None, "U"),
    ("C", "PG", "n/a", None, math.nan, "text", "Z", 1, "7", "U"),
    (None, None, "10 min", " War ", 4.0, "text", "Z", 1, "1", "U"),
]


@pytest.fixture
def catalogue(spark):
    return spark.createDataFrame(ITEMS, SCHEMA)


def test_clean_catalogue_fills(catalogue):
    got = {(r.Series_Title, r.Released_Year): r for r in clean_catalogue(catalogue, COLUMNS).collect()}
    filled = got["B", "1990"]
    assert (filled.Stars, filled.Gross, filled.Director, filled.Overview) == (0.0, 0.0, "unknown", "unknown")
    assert (got["B", "1999"].Runtime, got["B", "1999"].No_of_Votes, got["B", "1999"].Gross) == (0, 0, 0.0)
    c = got["C", "PG"]
    assert (c.Decade, c.Runtime, c.Genre, c.Stars) == (None, 0, "unknown", 0.0)


def test_decade_trends(catalogue):
    got = decade_trends(catalogue, COLUMNS)
    assert got.columns == ["Decade", "Avg_Stars", "StdDev_Stars", "Movies_Count", "Avg_Runtime", "StdDev_Runtime"]
    assert [t for _, t in got.dtypes] == ["int", "double", "double", "bigint", "double", "double"]
    unknown, nineties = got.collect()
    # All rows enter the means, different titles are counted; a missing title is not a title.
    assert (unknown.Decade, unknown.Avg_Stars, unknown.Movies_Count, unknown.Avg_Runtime) == (None, 2.0, 1, 5.0)
    assert (nineties.Decade, nineties.Movies_Count, nineties.Avg_Runtime) == (1990, 2, 50.0)
    assert nineties.Avg_Stars == pytest.approx(14 / 3)
    assert nineties.StdDev_Stars == pytest.approx(4.163331998932266)


def test_decade_trends_of_nothing(catalogue):
    assert decade_trends(catalogue.limit(0), COLUMNS).collect() == []


def test_decade_trends_reads_only_its_columns(spark, catalogue, tmp_path):
    catalogue.write.parquet(str(tmp_path / "c"))
    plan = decade_trends(spark.read.parquet(str(tmp_path / "c")), COLUMNS)._jdf.queryExecution()
    schema = "ReadSchema: struct<Series_Title:string,Released_Year:string,Runtime:string,Stars:double>"
    assert schema in plan.executedPlan().toString()


def test_tag_ratings(catalogue):
    got = tag_ratings(catalogue, COLUMNS, ["Released_Year"])
    assert got.columns == [
        "Individual_Genre",
        "Avg_Stars",
        "StdDev_Stars",
        "Movies_Count",
        "Avg_Runtime",
        "Avg_Box_Office",
    ]
    table = {r.Individual_Genre: tuple(r)[1:] for r in got.collect()}
    # Of title B the row of 1990 counts: no stars, 50 minutes, no revenue.
    assert table["Drama"] == (4.0, pytest.approx(32**0.5), 2, 75.0, 2.5)
    assert table["War"] == (6.0, pytest.approx(8**0.5), 1, 55.0, 3.0)
    assert table["unknown"] == (0.0, None, 1, 0.0, 7.0)


def test_tag_ratings_do_not_depend_on_partitioning(catalogue):
    results = [
        sorted(map(tuple, tag_ratings(catalogue.repartition(n), COLUMNS).collect()), key=repr) for n in (1, 4)
    ]
    assert results[0] == results[1]


SUPPLEMENT = SupplementColumns("Place", ("Awards", "Budget"))


def revenue_inputs(spark, titles=120):
    """Revenue follows the budget; every tenth title is unmatched, some rows are duplicates."""
    n = F.col("id")
    catalogue = spark.range(titles).select(
        F.concat(F.lit("T"), n).alias("Series_Title"),
        (F.lit(1950) + n % 70).cast("string").alias("Released_Year"),
        F.concat(F.lit(80) + n % 50, F.lit(" min")).alias("Runtime"),
        F.when(n % 2 == 0, "Drama, War").otherwise("Comedy").alias("Genre"),
        (F.lit(5.0) + n % 5).alias("Stars"),
        F.when(n % 2 == 0, "the sea and ships at war").otherwise("a funny moon and stars").alias("Overview"),
        F.concat(F.lit("D"), n % 7).alias("Director"),
        F.when(n == 3, "28,341").otherwise((n * 1000).cast("string")).alias("Gross"),
    )
    supplement = spark.range(titles).where(n % 10 != 0).select(
        F.concat(F.lit("T"), n).alias("Series_Title"),
        F.when(n % 3 != 0, F.concat(F.lit("P"), n % 4)).alias("Place"),
        (n % 6).cast("int").alias("Awards"),
        (n * 10).alias("Budget"),
    )
    return catalogue.union(catalogue.limit(20)), supplement.union(supplement.limit(5))


def test_prepare_revenue_rows(spark):
    catalogue, supplement = revenue_inputs(spark)
    rows = prepare_revenue_rows(catalogue, supplement, COLUMNS, SUPPLEMENT)
    # Duplicates are gone, the unreadable revenue too; unmatched titles stay.
    assert rows.count() == 119
    assert rows.where("Budget IS NULL").count() == 12
    report = revenue_report(catalogue, COLUMNS).first()
    assert tuple(report) == (120, 120, 119)
    assert dict(rows.dtypes)["Decade"] == "int" and rows.where("Decade IS NULL").count() == 0


def test_rows_that_differ_in_an_unused_column_both_stay(spark):
    catalogue, supplement = revenue_inputs(spark, 10)
    catalogue = catalogue.distinct()
    doubled = catalogue.withColumn("Certificate", F.lit("U")).union(catalogue.withColumn("Certificate", F.lit("A")))
    assert prepare_revenue_rows(doubled, supplement, COLUMNS, SUPPLEMENT).count() == 18


@pytest.mark.parametrize("text_fit_on, encode", [("all", "one_hot"), ("train", "one_hot"), ("all", "label_means")])
def test_revenue_model(spark, text_fit_on, encode):
    catalogue, supplement = revenue_inputs(spark)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    result = revenue_model(
        catalogue,
        supplement,
        COLUMNS,
        SUPPLEMENT,
        topics=2,
        iterations=3,
        trees=10,
        text_fit_on=text_fit_on,
        encode=encode,
    )
    # What the result reads is left: vocabulary, topics, report, joined rows, and the categories' means.
    assert len(set(shared.iterdir()) - before) == (4 if encode == "one_hot" else 7)
    importances = {r.Feature: r.Importance for r in result.importances.collect()}
    assert set(importances) == {
        "Stars",
        "Runtime",
        "Awards",
        "Budget",
        "Genre_Encoded",
        "Director_Encoded",
        "Place_Encoded",
        "topicDistribution",
    }
    assert sum(importances.values()) == pytest.approx(1.0)
    assert max(importances, key=importances.get) == "Budget"
    assert result.r2.first().r2 > 0.7
    # Held-out rows without a supplement cannot be predicted, all others are.
    assert result.predictions.where("Budget IS NULL OR prediction IS NULL").count() == 0
    assert tuple(result.report.first()) == (120, 119)
    assert result.joined.count() == 119 and result.train_rows.count() < 119
    terms = {r.term for r in result.vocabulary.collect()}
    assert "sea" in terms and "the" not in terms


def test_revenue_model_refuses_unknown_scope(spark):
    catalogue, supplement = revenue_inputs(spark, 5)
    with pytest.raises(ValueError, match="text_fit_on"):
        revenue_model(catalogue, supplement, COLUMNS, SUPPLEMENT, text_fit_on="test")
