"""Low-rating alerts over review messages, bounded or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.operators.alerts import low_rated_absolute, low_rated_relative
from marquee.operators.reshape import drop_repeats
from marquee.operators.stats import daily_average
from marquee.schemas import (
    REVIEW_DATE_FORMAT,
    REVIEW_MESSAGE,
    REVIEW_MESSAGE_WITH_OVERALL,
    ReviewColumns,
)
from marquee.sources.messages import parse_json_messages


def daily_ratings(
    messages: DataFrame,
    schema: T.StructType | str = REVIEW_MESSAGE,
    columns: ReviewColumns = ReviewColumns(),
    date_format: str = REVIEW_DATE_FORMAT,
    with_overall: bool = False,
    first_by: str | list[str] | None = None,
    distinct_by: str | None = None,
    late: str = "1 day",
) -> DataFrame:
    """Mean rating of every item and day, from JSON messages.

    ``first_by`` says which overall rating of a day counts: columns of the messages or of their log
    (``timestamp``, ``partition``, ``offset``). With ``distinct_by``, the column of a message's id, a message that
    comes twice counts once, see :func:`drop_repeats` for ``late``.
    """
    names = schema.names if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema).names
    wanted = [first_by] if isinstance(first_by, str) else first_by or []
    of_log = [c for c in wanted if c not in names]
    reviews = parse_json_messages(messages, schema, columns.day, date_format, keep=of_log)
    if distinct_by is not None:
        reviews = drop_repeats(reviews, distinct_by, columns.day, late)
    return daily_average(reviews, columns, with_overall, first_by)


def absolute_alerts(
    messages: DataFrame,
    below: float = 6.0,
    schema: T.StructType | str = REVIEW_MESSAGE,
    columns: ReviewColumns = ReviewColumns(),
    date_format: str = REVIEW_DATE_FORMAT,
    distinct_by: str | None = None,
    late: str = "1 day",
) -> DataFrame:
    """Items and days rated under ``below`` on average, from JSON messages."""
    daily = daily_ratings(messages, schema, columns, date_format, distinct_by=distinct_by, late=late)
    return low_rated_absolute(daily, below)


def relative_alerts(
    messages: DataFrame,
    gap: float = 3.0,
    schema: T.StructType | str = REVIEW_MESSAGE_WITH_OVERALL,
    columns: ReviewColumns = ReviewColumns(),
    date_format: str = REVIEW_DATE_FORMAT,
    digits: int | None = None,
    first_by: str | list[str] | None = None,
    distinct_by: str | None = None,
    late: str = "1 day",
) -> DataFrame:
    """Items and days rated at least ``gap`` under their overall rating, from JSON messages."""
    daily = daily_ratings(messages, schema, columns, date_format, True, first_by, distinct_by, late)
    return low_rated_relative(daily, gap, columns, digits)
