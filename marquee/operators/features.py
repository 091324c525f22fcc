"""Categories and feature vectors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Transformer
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.ranks import ranks
from marquee.operators.reshape import enrich_left
from marquee.session import Stages, materialise, scratch_dir, stages


def category_ranks(df: DataFrame, column: str, index: str) -> DataFrame:
    """Every value of ``column`` with its rank: most frequent first, ties in text order, from 0.

    Runs a job: the sorted values are saved.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = ranks(counts, index, F.desc("_n"), F.asc(column))
    return ranked.select(column, F.col(index).cast("double").alias(index))


def index_category(
    df: DataFrame, column: str, output: str, fit_on: DataFrame | None = None
) -> DataFrame:
    """Replace a category by its frequency rank, for any number of categories.

    NULL, and values that ``fit_on`` (default ``df``) does not have, get one extra index after all
    others. Runs jobs while the frame is built, so a streaming frame is refused. Gives what the ``StringIndexer`` of :func:`category_stages` gives, without holding the
    categories in the driver.
    """
    found = category_ranks(df if fit_on is None else fit_on, column, output)
    extra = found.agg(F.count(F.lit(1)).cast("double").alias("_n")).scalar()
    ranked = enrich_left(df, found, column, unique=True)
    return ranked.withColumn(output, F.coalesce(F.col(output), extra))


def check_category_bound(df: DataFrame, columns: list[str], most: int) -> None:
    """Refuse columns with more than ``most`` categories: an encoder's labels are held by the
    driver and every task. One pass over all columns; a column whose estimate lies within a tenth of
    the limit or above is counted exactly."""
    found = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first().asDict()
    near = [c for c, n in found.items() if n > most * 0.9]
    over = {c: n for c in near if (n := df.select(c).where(F.col(c).isNotNull()).distinct().count()) > most}
    if over:
        raise ValueError(f"too many categories for a slot each (limit {most}), encode them by label means or hash: {over}")


def category_stages(columns: dict[str, str]) -> list:
    """Pipeline stages that index and one-hot encode ``{category column: vector column}``.

    One indexer and one encoder serve all columns, so fitting reads the data once. Unseen and NULL
    categories share an extra index, which is encoded as the zero vector.
    """
    indexed = [f"{c}_Indexed" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=list(columns.values())),
    ]


def hashed_categories(columns: dict[str, str], slots: int) -> list:
    """Pipeline stages that encode ``{category column: vector column}`` in ``slots`` places each.

    A value's place follows from its hash, so nothing is fitted and any number of categories takes the
    same width; values that meet in a place share it. NULL is the zero vector. No row is dropped.
    """
    return [
        FeatureHasher(inputCols=[c], outputCol=v, numFeatures=slots, categoricalCols=[c]) for c, v in columns.items()
    ]


def one_hot(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Index and encode ``{category column: vector column}``, fitted on ``df`` itself, for any number of categories.

    Adds ``<column>_Indexed`` and the vectors that :func:`category_stages` would give, but from ranks by a
    distributed sort, so no task and not the driver holds the categories. NULL is the zero vector. Runs
    jobs; the result is saved in the form in which Spark stores vectors.
    """
    spark = df.sparkSession
    with stages(spark) as run:
        widths, fields = {}, list(df.schema.fields)
        for column, vector in columns.items():
            found = category_ranks(df, column, f"{column}_Indexed")
            widths[column] = found.count()
            df = enrich_left(df, found, column, unique=True)
            place = F.coalesce(F.col(f"{column}_Indexed"), F.lit(float(widths[column])))
            inside = F.when(place < widths[column], F.array(place.cast("int"))).otherwise(F.array().cast("array<int>"))
            encoded = F.struct(
                F.lit(0).cast("tinyint").alias("type"),
                F.lit(widths[column]).alias("size"),
                inside.alias("indices"),
                F.transform(inside, lambda _: F.lit(1.0)).alias("values"),
            )
            df = df.withColumns({f"{column}_Indexed": place, vector: encoded})
            fields += [T.StructField(f"{column}_Indexed", T.DoubleType()), T.StructField(vector, VectorUDT())]
        path = scratch_dir(spark, "one-hot")
        df.select(*[f.name for f in fields]).write.parquet(path)
        saved = run.keep_path(path, T.StructType(fields))
    for column, vector in columns.items():
        saved = saved.withMetadata(vector, {"ml_attr": {"num_attrs": widths[column]}})
    return saved


def category_statistics(df: DataFrame, column: str, label: str, fold: Column, prior: float, weight: float) -> tuple[DataFrame, DataFrame]:
    """Smoothed means of ``label`` by category: over all rows (``column``, ``_mean``), and over the rows of other
    folds (``column``, ``_fold``, ``_mean``).

    One grouping by category and fold, partial within tasks, so a category with most rows is a few rows a task.
    """
    each = df.where(F.col(label).isNotNull() & F.col(column).isNotNull()).groupBy(column, fold.alias("_fold"))
    each = materialise(each.agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_c")), "statistics")
    whole = each.groupBy(column).agg(F.sum("_s").alias("_all_s"), F.sum("_c").alias("_all_c"))
    smooth = lambda s, c: ((s + prior * weight) / (c + weight)).alias("_mean")
    means = materialise(whole.select(column, smooth(F.col("_all_s"), F.col("_all_c"))), "means")
    others = each.join(whole, column)
    out = others.select(column, "_fold", smooth(F.col("_all_s") - F.col("_s"), F.col("_all_c") - F.col("_c")))
    return means, materialise(out, "means")


class CategoryMeans(Transformer):
    """Adds, for every category column, the smoothed mean label of the row's category; NULL and unseen ones get the
    mean of all rows. The means are tables and come by a join."""

    def __init__(self, columns: dict[str, str], means: dict[str, DataFrame], prior: float):
        super().__init__()
        self.columns, self.means, self.prior = columns, means, prior

    def keep(self, run: Stages) -> None:
        """Hand the tables over by a run, see :func:`marquee.session.stages`."""
        self.means = {column: run.keep(means) for column, means in self.means.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, output in self.columns.items():
            dataset = enrich_left(dataset.drop(output), self.means[column], column, unique=True)
            dataset = dataset.withColumn(output, F.coalesce("_mean", F.lit(self.prior))).drop("_mean")
        return dataset


def encode_by_label(
    df: DataFrame, columns: dict[str, str], label: str, folds: int = 10, weight: float = 10.0, fold_by: list[str] | None = None
) -> tuple[DataFrame, CategoryMeans]:
    """``df`` with ``{category column: number column}``, and the transformer that encodes other rows.

    A category becomes the mean label of its rows in other folds, drawn towards the mean of all by ``weight``
    rows of it, so a row's own label never enters its number, and any number of categories takes one column. A
    row's fold follows from the MD5 of ``fold_by`` (default: all columns of simple types) as text, joined by
    ``|``, so it does not change when a task is rerun. No row is dropped; NULL and categories of one fold only
    get the mean of all.
    """
    if folds < 2:
        raise ValueError("a row's number comes from other folds: give two or more")
    simple = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fold_by or simple])
    fold = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")
    prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    encoded, means = df.withColumn("_fold", fold), {}
    for column, output in columns.items():
        means[column], others = category_statistics(df, column, label, fold, prior, weight)
        encoded = enrich_left(encoded.drop(output), others, [column, "_fold"], unique=True)
        encoded = encoded.withColumn(output, F.coalesce("_mean", F.lit(prior))).drop("_mean")
    return encoded.drop("_fold"), CategoryMeans(columns, means, prior)


def assembler(inputs: Iterable[str], output: str = "features") -> VectorAssembler:
    """Pipeline stage that joins numeric and vector columns into one vector and skips rows with a
    NULL or NaN among them."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="skip")


def assemble_features(df: DataFrame, inputs: Iterable[str], output: str = "features") -> DataFrame:
    return assembler(inputs, output).transform(df)
