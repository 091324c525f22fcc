"""Revenue model: text topics and catalogue features to a random forest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import decade_of, strip_unit, to_double
from marquee.operators.cleaning import cleaning_report, drop_missing
from marquee.operators.features import CategoryMeans
from marquee.operators.regression import (
    feature_importance,
    fit_regressor,
    predict,
    r2_score,
    split_train_test,
)
from marquee.operators.reshape import dedup_rows, enrich_left
from marquee.operators.text import counted_terms, fit_vocabulary, remove_stopwords, term_vectors, tokenize
from marquee.operators.topics import TopicTable, fit_topic_table, topic_shares
from marquee.schemas import CatalogueColumns, SupplementColumns
from marquee.session import materialise, stages


@dataclass(frozen=True)
class RevenueModel:
    vocabulary: DataFrame
    topics: TopicTable
    regressor: PipelineModel
    report: DataFrame
    #: All rows with their topics and supplement, and those of them that the forest was given.
    joined: DataFrame
    train_rows: DataFrame
    predictions: DataFrame
    r2: DataFrame
    importances: DataFrame


def _needed(c: CatalogueColumns) -> list[str]:
    return [c.rating, c.gross, c.runtime, c.creator, c.tags, c.overview]


def distinct_catalogue(
    catalogue: DataFrame, columns: CatalogueColumns = CatalogueColumns()
) -> DataFrame:
    """Different catalogue rows without missing values, in the columns the model uses.

    Rows that differ only in another column are different rows and both stay.
    """
    needed = _needed(columns)
    return dedup_rows(drop_missing(catalogue, needed)).select(
        *dict.fromkeys([columns.title, columns.year, *needed])
    )


def convert_catalogue(rows: DataFrame, columns: CatalogueColumns = CatalogueColumns()) -> DataFrame:
    """Convert running time and revenue, drop what cannot be converted, add the decade."""
    c = columns
    converted = rows.withColumns({c.runtime: strip_unit(c.runtime), c.gross: to_double(c.gross)})
    return drop_missing(converted, _needed(c)).withColumn("Decade", decade_of(c.year))


def add_supplement(
    rows: DataFrame,
    supplement: DataFrame,
    columns: CatalogueColumns = CatalogueColumns(),
    supplement_columns: SupplementColumns = SupplementColumns(),
    order_by: list[str] | None = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Join one supplement row per title, the first by ``order_by``."""
    s = supplement_columns
    wanted = [s.location, *s.numeric]
    extra = supplement.select(*dict.fromkeys([columns.title, *wanted, *(order_by or [])]))
    joined = enrich_left(rows, extra, columns.title, order_by, broadcast_bytes=broadcast_bytes)
    return joined.select(*rows.columns, *wanted)


def prepare_revenue_rows(
    catalogue: DataFrame,
    supplement: DataFrame,
    columns: CatalogueColumns = CatalogueColumns(),
    supplement_columns: SupplementColumns = SupplementColumns(),
    order_by: list[str] | None = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Distinct, complete catalogue rows with the supplement joined on the title.

    Duplicates and incomplete rows go before the join: as every title has one supplement row, the
    result is the same and less is shuffled. The distinct rows are saved, as the join may read them
    twice.
    """
    rows = convert_catalogue(materialise(distinct_catalogue(catalogue, columns), "distinct"), columns)
    return add_supplement(rows, supplement, columns, supplement_columns, order_by, broadcast_bytes)


def revenue_report(catalogue: DataFrame, columns: CatalogueColumns = CatalogueColumns()) -> DataFrame:
    """Row counts after the two drops of :func:`prepare_revenue_rows`."""
    c = columns
    return cleaning_report(
        dedup_rows(catalogue),
        _needed(c),
        {c.runtime: strip_unit(c.runtime), c.gross: to_double(c.gross)},
    )


def revenue_model(
    catalogue: DataFrame,
    supplement: DataFrame,
    columns: CatalogueColumns = CatalogueColumns(),
    supplement_columns: SupplementColumns = SupplementColumns(),
    order_by: list[str] | None = None,
    topics: int = 5,
    iterations: int = 10,
    vocab_size: int | None = None,
    min_df: float = 1.0,
    trees: int = 50,
    depth: int = 10,
    train: float = 0.8,
    seed: int = 42,
    text_fit_on: str = "all",
    broadcast_bytes: int = 64 << 20,
    max_categories: int = 100_000,
    category_slots: int | None = None,
    encode: str = "one_hot",
    split_by: list[str] | None = None,
) -> RevenueModel:
    """Fit topics on the overviews, then revenue on ratings, running time, supplement values,
    encoded categories and topic shares; score on the held-out part.

    Rows without supplement values keep their topics but are skipped by the assembler, so the
    forest sees matched titles only. A row's part of the split follows from ``split_by``, columns of the
    catalogue that the model uses, by default from all of them. ``text_fit_on="train"`` keeps held-out texts out of the
    vocabulary and the topics. All terms are counted unless ``vocab_size`` or ``min_df`` say otherwise, and
    all texts take part in every iteration of the topic fit; the topics are a table of terms.

    Categories are one-hot: a column with more than ``max_categories`` is refused, as the forest's binned
    rows take about 4 bytes per slot. ``category_slots`` encodes any number of them by hash in so many
    slots a column instead, ``encode="label_means"`` any number in one column each.

    What several passes read is written to the scratch folder: distinct rows, counted words, count vectors,
    topic shares, joined rows. Each is deleted once the next is complete; what the result reads stays.
    Topics come before the join, so no text is shuffled for it.
    """
    if text_fit_on not in ("all", "train"):
        raise ValueError("text_fit_on must be 'all' or 'train'")
    c, s = columns, supplement_columns
    conversions = {c.runtime: strip_unit(c.runtime), c.gross: to_double(c.gross)}

    def train_and_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return split_train_test(df, train, seed, split_by or ["_row"])

    def fit_rows(df: DataFrame) -> DataFrame:
        return df if text_fit_on == "all" else train_and_test(df)[0]

    with stages(catalogue.sparkSession) as run:
        distinct = materialise(distinct_catalogue(catalogue, c), "distinct")
        report = run.keep(cleaning_report(distinct, _needed(c), conversions).drop("rows_read"), "report")
        rows = convert_catalogue(distinct, c).withColumn("_row", F.xxhash64(*distinct.columns))
        words = remove_stopwords(tokenize(rows, c.overview, "_words"), "_words", "_words").drop(c.overview)
        # Texts are left behind here: what goes on are the counts of their words.
        counted = words.withColumn("_words", counted_terms("_words")).withColumn("_at", F.monotonically_increasing_id())
        counted = materialise(counted, "counted")
        run.release(distinct)
        vocabulary = run.keep(fit_vocabulary(fit_rows(counted), "_words", vocab_size, min_df), "vocabulary")
        vectors = term_vectors(counted, "_words", "_counts", vocabulary, "_at", keep_words=False)
        run.release(counted)
        terms = vocabulary.agg(F.coalesce(F.max("slot") + 1, F.lit(0))).first()[0]
        topic_model = fit_topic_table(fit_rows(vectors), "_counts", terms, "_at", topics, iterations, seed).keep(run)
        mixed = materialise(topic_shares(vectors, topic_model, "_counts", "_at").drop("_counts", "_at"), "topics")
        run.release(vectors)
        joined = run.keep(add_supplement(mixed, supplement, c, s, order_by, broadcast_bytes), "joined")

        train_rows, test_rows = train_and_test(joined)
        regressor = fit_regressor(
            train_rows,
            c.gross,
            [c.rating, c.runtime, *s.numeric],
            {
                c.tags: f"{c.tags}_Encoded",
                c.creator: f"{c.creator}_Encoded",
                s.location: f"{s.location}_Encoded",
            },
            ["topicDistribution"],
            trees=trees,
            depth=depth,
            seed=seed,
            max_categories=max_categories,
            category_slots=category_slots,
            encode=encode,
            fold_by=split_by or ["_row"],
        )
        if isinstance(regressor.stages[0], CategoryMeans):
            regressor.stages[0].keep(run)
        importances = feature_importance(regressor, train_rows)
    predictions = predict(regressor, test_rows).drop("_row")
    return RevenueModel(
        vocabulary,
        topic_model,
        regressor,
        report,
        joined.drop("_row"),
        train_rows.drop("_row"),
        predictions,
        r2_score(predictions, c.gross),
        importances,
    )
