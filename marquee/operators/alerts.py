"""Filters on daily averages, bounded or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import rating_gap
from marquee.schemas import ReviewColumns


def low_rated_absolute(daily: DataFrame, below: float = 6.0) -> DataFrame:
    """Items and days whose mean lies strictly under ``below``."""
    return daily.where(F.col("Daily_Average_Rating") < below)


def low_rated_relative(
    daily: DataFrame,
    gap: float = 3.0,
    columns: ReviewColumns = ReviewColumns(),
    digits: int | None = None,
) -> DataFrame:
    """Items and days whose mean lies at least ``gap`` under the overall rating.

    ``digits`` rounds the gap before the test, see ``rating_gap``.
    """
    difference = rating_gap(columns.overall, "Daily_Average_Rating", digits)
    return daily.withColumn("Rating_Difference", difference).where(F.col("Rating_Difference") >= gap)
