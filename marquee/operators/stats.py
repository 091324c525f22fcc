"""Measures for ``groupBy(...).agg(...)``. All of them reduce within each task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.schemas import ReviewColumns


def agg_mean(column: str, name: str | None = None) -> Column:
    """Mean of the values present; NULL if there is none."""
    return F.avg(column).alias(name or f"Avg_{column}")


def agg_exact_mean(column: str, name: str | None = None) -> Column:
    """Mean of the values present, as a double that does not depend on their order; NULL if there is none.

    Each value is added as a decimal of ten places and what these leave of it as one of 28, so values of up to ten
    places have the double nearest to their mean. With values of 1e14 and more, or that are no numbers, it is
    :func:`agg_mean`.
    """
    value = F.col(column).cast("double")
    high = value.try_cast("decimal(24,10)")
    low = (value - high.cast("double")).try_cast("decimal(28,28)")
    n, total = F.count(value), F.try_sum(high)
    mean = F.coalesce((total.try_cast("decimal(24,10)") / n.try_cast("decimal(10,0)")).cast("double"), total.cast("double") / n)
    whole = (F.count(high) == n) & (F.count(low) == n)
    exact = F.when(whole & (n > 0), mean + F.try_sum(low).cast("double") / n)
    return F.coalesce(exact, F.avg(value)).alias(name or f"Avg_{column}")


def agg_stddev(column: str, name: str | None = None) -> Column:
    """Sample standard deviation; NULL for a single value."""
    return F.stddev(column).alias(name or f"StdDev_{column}")


def agg_distinct(column: str, name: str | None = None) -> Column:
    """Exact number of distinct values; NULL is not counted."""
    return F.countDistinct(column).alias(name or f"Distinct_{column}")


def agg_first(column: str, by: str | list[str] | None = None, name: str | None = None) -> Column:
    """First value of the group: the one with the smallest ``by``, a column or several in order.

    On a stream the smallest ``by`` stands in the state beside its value, so columns that come from the source
    (its time, partition and offset of a message) give the first message's value whatever order batches and
    their tasks run in, and a batch that is run again gives it once more. Without ``by`` it is whichever row
    arrives first, which repeats only if the value is constant within the group.
    """
    value = F.first(column) if by is None else F.min_by(column, by if isinstance(by, str) else F.struct(*by))
    return value.alias(name or column)


def daily_average(
    reviews: DataFrame,
    columns: ReviewColumns = ReviewColumns(),
    with_overall: bool = False,
    first_by: str | list[str] | None = None,
) -> DataFrame:
    """Mean rating per item and day, bounded or streaming, the same in whatever order the reviews come.

    ``with_overall`` carries the overall rating of the first review of the group along, the first
    by ``first_by`` if given.
    """
    measures = [agg_exact_mean(columns.rating, "Daily_Average_Rating")]
    if with_overall:
        measures.append(agg_first(columns.overall, first_by))
    return reviews.groupBy(columns.entity, columns.day).agg(*measures)
