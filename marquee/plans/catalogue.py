"""Descriptive reports over a catalogue of titled items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import decade_of, strip_unit, to_double
from marquee.operators.cleaning import fill_missing
from marquee.operators.reshape import dedup_by_key, explode_tags
from marquee.operators.stats import agg_distinct, agg_mean, agg_stddev
from marquee.schemas import CatalogueColumns


def clean_catalogue(df: DataFrame, columns: CatalogueColumns = CatalogueColumns()) -> DataFrame:
    """Convert running time, revenue and decade, and fill what is missing: numbers with 0, texts
    with ``unknown``. Works on any subset of the columns."""
    c = columns
    conversions = {
        c.runtime: strip_unit(c.runtime),
        c.gross: to_double(c.gross),
        "Decade": decade_of(c.year),
    }
    sources = {c.runtime: c.runtime, c.gross: c.gross, "Decade": c.year}
    df = df.withColumns({k: v for k, v in conversions.items() if sources[k] in df.columns})
    return fill_missing(
        df,
        {
            c.runtime: 0,
            c.rating: 0,
            c.votes: 0,
            c.gross: 0,
            c.creator: "unknown",
            c.tags: "unknown",
            c.overview: "unknown",
        },
    )


def decade_trends(
    catalogue: DataFrame, columns: CatalogueColumns = CatalogueColumns(), ordered: bool = True
) -> DataFrame:
    """Rating and running time per decade, filled values included, with the number of different
    titles. Items without a year form the NULL decade."""
    c = columns
    used = catalogue.select(*dict.fromkeys([c.title, c.year, c.rating, c.runtime]))
    trends = (
        clean_catalogue(used, c)
        .groupBy("Decade")
        .agg(
            agg_mean(c.rating),
            agg_stddev(c.rating),
            agg_distinct(c.title, "Movies_Count"),
            agg_mean(c.runtime),
            agg_stddev(c.runtime),
        )
    )
    return trends.orderBy(F.asc_nulls_first("Decade")) if ordered else trends


def tag_ratings(
    catalogue: DataFrame,
    columns: CatalogueColumns = CatalogueColumns(),
    order_by: list[str] | None = None,
    tag: str = "Individual_Genre",
) -> DataFrame:
    """Rating, running time and revenue per tag, each title counted once per tag.

    ``order_by`` says which of several rows of a title counts; see ``dedup_by_key``.
    """
    c = columns
    used = catalogue.select(
        *dict.fromkeys([c.title, c.tags, c.rating, c.runtime, c.gross, *(order_by or [])])
    )
    tagged = explode_tags(clean_catalogue(used, c), c.tags, tag).drop(c.tags)
    return (
        dedup_by_key(tagged, [tag, c.title], order_by)
        .groupBy(tag)
        .agg(
            agg_mean(c.rating),
            agg_stddev(c.rating),
            # Titles are unique within the tag by now, so a plain count is the distinct count.
            F.count(c.title).alias("Movies_Count"),
            agg_mean(c.runtime),
            agg_mean(c.gross, "Avg_Box_Office"),
        )
    )
