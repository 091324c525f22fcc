import hashlib
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marquee.operators import (
    feature_importance,
    fit_regressor,
    predict,
    r2_score,
    slot_widths,
    split_train_test,
)
from marquee.session import materialise


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        kind, x, noise = rng.choice("abcdefghijklmn"), rng.random(), rng.random()
        topic = Vectors.dense([x, 1 - x])
        rows.append((i, x, noise, kind, "p" + kind, topic, 10 * x + ord(kind)))
    df = spark.createDataFrame(rows, ["i", "x", "noise", "kind", "kind_2", "topic", "y"])
    return df.repartition(2, "i").sortWithinPartitions("i").cache()


CATEGORIES = {"kind": "kind_vec", "kind_2": "kind_vec_2"}


def test_split_is_disjoint_and_complete(sample):
    for by in (None, ["i"]):
        train, test = (
            {r.i for r in part.collect()} for part in split_train_test(sample, by=by)
        )
        assert not train & test and len(train | test) == 400
        assert 280 < len(train) < 360


def test_hash_split_ignores_partitioning(sample):
    one = {r.i for r in split_train_test(sample, by=["i"])[0].collect()}
    two = {r.i for r in split_train_test(sample.repartition(13), by=["i"])[0].collect()}
    other_seed = {r.i for r in split_train_test(sample, seed=7, by=["i"])[0].collect()}
    assert one == two != other_seed


@pytest.fixture(scope="module")
def model(sample):
    return fit_regressor(sample, "y", ["x", "noise"], CATEGORIES, ["topic"], trees=10, depth=5)


def test_importance_has_one_row_per_input(model, sample):
    got = {r.Feature: r.Importance for r in feature_importance(model, sample).collect()}
    assert set(got) == {"x", "noise", "kind_vec", "kind_vec_2", "topic"}
    assert sum(got.values()) == pytest.approx(1.0)
    # One vector slot per letter: the slots must be summed, not cut off after the fifth.
    assert got["kind_vec"] + got["kind_vec_2"] > 0.3
    ordered = [r.Importance for r in feature_importance(model, sample).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_importance_sums_slots_by_position(model, sample):
    slots = model.stages[-1].featureImportances.toArray()
    got = {r.Feature: r.Importance for r in feature_importance(model, sample).collect()}
    assert len(slots) == 1 + 1 + 14 + 14 + 2
    assert got["kind_vec"] == pytest.approx(slots[2:16].sum())
    assert got["topic"] == pytest.approx(slots[30:].sum())


def test_slot_widths(sample):
    # This vector column has no metadata, so one row is looked at.
    assert slot_widths(sample, ["x", "topic"]) == {"x": 1, "topic": 2}


def test_predict_and_score(model, sample):
    predictions = predict(model, sample)
    expected = RegressionEvaluator(labelCol="y", metricName="r2").evaluate(predictions)
    assert r2_score(predictions, "y").first().r2 == pytest.approx(expected)
    assert expected > 0.5


def test_r2_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (None, 2.0), (2.0, None)], "y double, prediction double")
    assert r2_score(df, "y").first().r2 == 1.0
    constant = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, prediction double")
    assert r2_score(constant, "y").first().r2 is None


def test_rows_with_missing_inputs_or_label_take_no_part(spark, model, sample):
    from pyspark.sql import functions as F

    holes = sample.withColumn("x", F.when(F.col("i") >= 100, F.col("x")))
    assert predict(model, holes).count() == 300
    no_label = sample.withColumn("y", F.when(F.col("i") >= 100, F.col("y")))
    assert fit_regressor(no_label, "y", ["x"], trees=2, depth=2).stages[-1].getNumTrees == 2


def test_unseen_category_is_predicted(spark, model, sample):
    from pyspark.sql import functions as F

    new = sample.limit(5).withColumn("kind", F.lit("new"))
    assert predict(model, new).where("prediction IS NOT NULL").count() == 5


def test_hashed_categories_take_any_number_of_values(spark):
    rows = [(i, f"c{i}", float(i % 7)) for i in range(2000)] + [(-1, None, 1.0)]
    df = spark.createDataFrame(rows, "x int, c string, y double")
    model = fit_regressor(df, "y", ["x"], {"c": "c_vec"}, trees=3, depth=3, max_categories=10, category_slots=32)
    assert model.stages[-1].numFeatures == 33 and predict(model, df).count() == 2001
    table = {r.Feature: r.Importance for r in feature_importance(model, df).collect()}
    assert set(table) == {"x", "c_vec"} and sum(table.values()) == pytest.approx(1)


def test_a_million_categories_are_one_column(spark):
    n = 1_000_000
    df = materialise(spark.range(n + 100_000).select("id", F.concat(F.lit("c"), F.col("id") % n).alias("c"), (F.col("id") % n / n).alias("y"), F.lit(1.0).alias("x")))
    model = fit_regressor(df, "y", ["x"], {"c": "m"}, trees=2, depth=3, encode="label_means", fold_by=["id"])
    assert model.stages[-1].numFeatures == 2
    predicted = predict(model, df)
    assert predicted.count() == n + 100_000
    table = {r.Feature: r.Importance for r in feature_importance(model, df).collect()}
    assert table == {"x": 0.0, "m": pytest.approx(1.0)}
    with pytest.raises(ValueError, match="label means"):
        fit_regressor(df, "y", ["x"], {"c": "m"})
    with pytest.raises(ValueError, match="encode"):
        fit_regressor(df, "y", ["x"], {"c": "m"}, encode="by hand")


def test_label_means_learn_from_categories(sample):
    model = fit_regressor(sample, "y", ["x", "noise"], CATEGORIES, ["topic"], trees=10, depth=5, encode="label_means", fold_by=["i"])
    assert predict(model, sample).count() == 400
    assert r2_score(predict(model, sample), "y").first().r2 > 0.5
    table = {r.Feature: r.Importance for r in feature_importance(model, sample).collect()}
    assert table["kind_vec"] + table["kind_vec_2"] > 0.5 > table["noise"]


def test_hash_split_follows_its_rule(spark):
    df = spark.createDataFrame([(i, "a") for i in range(2000)] + [(None, "b")], "i int, s string")
    train, test = split_train_test(df, 0.8, 42, ["i", "s"])
    expected = {
        (r.i, r.s)
        for r in df.collect()
        if int(hashlib.md5(f"42|{'' if r.i is None else r.i}|{r.s}".encode()).hexdigest()[:8], 16) % 1_000_000 < 800_000
    }
    assert {(r.i, r.s) for r in train.collect()} == expected and train.count() + test.count() == 2001
    assert 0.77 < len(expected) / 2001 < 0.83
