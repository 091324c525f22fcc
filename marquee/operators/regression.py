"""Split, fit, predict, score, explain."""

from __future__ import annotations

from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.features import assembler, category_stages, check_category_bound, encode_by_label, hashed_categories
from marquee.session import materialise

_SPLIT_STEPS = 1_000_000


def split_train_test(
    df: DataFrame, train: float = 0.8, seed: int = 42, by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``.

    With ``by`` a row's part follows from the MD5 of ``seed`` and these columns as text, joined by
    ``|`` (NULL is empty), so it does not change when a task is rerun or the data are partitioned
    differently; give columns that identify the row. Without
    it Spark's seeded random split is used, which repeats only for the same partitioning.
    """
    if by is None:
        first, second = df.randomSplit([train, 1 - train], seed=seed)
        return first, second
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])
    place = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(_SPLIT_STEPS))
    in_train = place < round(train * _SPLIT_STEPS)
    return df.where(in_train), df.where(~in_train)


def fit_regressor(
    df: DataFrame,
    label: str,
    numeric: list[str],
    categories: dict[str, str] | None = None,
    vectors: list[str] | None = None,
    trees: int = 50,
    depth: int = 10,
    seed: int = 42,
    max_categories: int = 100_000,
    category_slots: int | None = None,
    encode: str = "one_hot",
    fold_by: list[str] | None = None,
    **params: Any,
) -> PipelineModel:
    """Fit category encoding, assembly and a random forest as one pipeline.

    ``categories`` maps category columns to the vector columns made from them. Inputs are assembled
    in the order numeric, categories, vectors. Rows with a missing input or label take no part.

    Categories are one-hot by default. A column with more than ``max_categories`` values is refused, as the
    forest holds a bin for every slot and row; with ``category_slots`` every column is encoded by hash in so
    many slots. ``encode="label_means"`` makes any number of categories one column, see
    :func:`encode_by_label` (``fold_by`` names the columns that set a row's fold), and drops no row for them.
    """
    if encode not in ("one_hot", "label_means"):
        raise ValueError("encode must be 'one_hot' or 'label_means'")
    categories = categories or {}
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **params
    )
    inputs = [*numeric, *categories.values(), *(vectors or [])]
    stages = []
    if categories and category_slots is not None:
        stages = hashed_categories(categories, category_slots)
    elif categories and encode == "one_hot":
        check_category_bound(df, list(categories), max_categories)
        stages = category_stages(categories)
    if categories and encode == "label_means":
        known, means = encode_by_label(df.dropna(subset=[label]), categories, label, fold_by=fold_by)
        joined = materialise(known.select(*inputs, label), "encoded")
        fitted = Pipeline(stages=[assembler(inputs), forest]).fit(joined)
        return PipelineModel([means, *fitted.stages])
    return Pipeline(stages=[*stages, assembler(inputs), forest]).fit(df.dropna(subset=[label]))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``; rows with a missing numeric or vector input are skipped."""
    return model.transform(df)


def r2_score(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Coefficient of determination as a one-row frame ``r2``, in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    known = df.where(y.isNotNull() & p.isNotNull()).select(y.alias("y"), p.alias("p"))
    residual = F.sum((F.col("y") - F.col("p")) * (F.col("y") - F.col("p")))
    total = F.var_pop("y") * F.count("y")
    return known.agg((F.lit(1.0) - residual / F.nullif(total, F.lit(0.0))).alias("r2"))


def slot_widths(df: DataFrame, inputs: list[str]) -> dict[str, int]:
    """Number of vector slots each assembler input takes: from column metadata, or from one row for
    a vector column that carries none."""
    widths = {}
    for name in inputs:
        attributes = df.schema[name].metadata.get("ml_attr", {})
        if "num_attrs" in attributes:
            widths[name] = int(attributes["num_attrs"])
        elif "attrs" in attributes:
            widths[name] = sum(len(group) for group in attributes["attrs"].values())
        elif isinstance(df.schema[name].dataType, T.NumericType | T.BooleanType):
            widths[name] = 1
        else:
            sample = df.where(F.col(name).isNotNull()).select(F.size(vector_to_array(name)).alias("n"))
            widths[name] = sample.first()["n"]
    return widths


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``Feature`` and ``Importance`` per assembler input, most important first.

    A category or topic vector has one importance per slot; they are summed into their input, so
    the table adds up to 1. ``df`` is the frame the model was fitted on, of which at most one row is
    read.
    """
    forest, assemble = model.stages[-1], model.stages[-2]
    encoded = PipelineModel(model.stages[:-2]).transform(df)
    inputs = assemble.getInputCols()
    widths = slot_widths(encoded, inputs)
    slots = forest.featureImportances.toArray()
    rows, start = [], 0
    for name in inputs:
        rows.append((name, float(slots[start : start + widths[name]].sum())))
        start += widths[name]
    if start != len(slots):
        raise ValueError(f"inputs take {start} slots, the model has {len(slots)}")
    table = df.sparkSession.createDataFrame(rows, "Feature string, Importance double")
    return table.orderBy(F.desc("Importance"), "Feature")
