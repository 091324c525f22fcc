"""Column roles and message schemas."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CatalogueColumns:
    """Which catalogue column plays which role.

    Result columns are named after these, e.g. ``Avg_<rating>``.
    """

    title: str = "Series_Title"
    year: str = "Released_Year"
    runtime: str = "Runtime"
    tags: str = "Genre"
    rating: str = "Rating"
    overview: str = "Overview"
    creator: str = "Director"
    votes: str = "No_of_Votes"
    gross: str = "Gross"


@dataclass(frozen=True)
class SupplementColumns:
    """Columns the revenue model takes from the supplement."""

    location: str = "Filming_Locations"
    numeric: tuple[str, ...] = (
        "Awards_Won",
        "Oscars_Nominated",
        "Production_Budget",
        "Audience_Score",
    )


@dataclass(frozen=True)
class ReviewColumns:
    """Which review column plays which role."""

    review: str = "Review_ID"
    entity: str = "Movie_ID"
    day: str = "Review_Date"
    rating: str = "Review_Rating"
    overall: str = "Overall_Rating"


def catalogue_schema(columns: CatalogueColumns = CatalogueColumns()) -> str:
    """Declared catalogue types (DDL), for a CSV load that must not infer them."""
    # Column names and types of the catalogue, in file order.
    return (
        f"Poster_Link string, {columns.title} string, {columns.year} bigint, Certificate string, "
        f"{columns.runtime} string, {columns.tags} string, {columns.rating} double, "
        f"{columns.overview} string, Meta_score double, {columns.creator} string, "
        "Star1 string, Star2 string, Star3 string, Star4 string, "
        f"{columns.votes} bigint, {columns.gross} bigint"
    )


# Fields of a review message, in wire order (DDL).
REVIEW_MESSAGE = (
    "Review_ID string, Movie_ID string, Reviewer_Name string, Review_Rating bigint, "
    "Reviewer_Nationality string, Reviewer_Age bigint, Review_Date string, Sex string"
)

# As above with a fractional rating and the item's overall rating.
REVIEW_MESSAGE_WITH_OVERALL = (
    "Review_ID string, Movie_ID string, Reviewer_Name string, Review_Rating double, "
    "Reviewer_Nationality string, Reviewer_Age bigint, Review_Date string, Sex string, "
    "Overall_Rating double"
)

# Fixed value: day format used in review messages.
REVIEW_DATE_FORMAT = "M/d/yyyy"
