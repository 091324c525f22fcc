from marquee.plans.catalogue import clean_catalogue, decade_trends, tag_ratings
from marquee.plans.revenue import (
    RevenueModel,
    add_supplement,
    convert_catalogue,
    distinct_catalogue,
    prepare_revenue_rows,
    revenue_model,
    revenue_report,
)
from marquee.plans.reviews import absolute_alerts, daily_ratings, relative_alerts

__all__ = [
    "RevenueModel",
    "absolute_alerts",
    "add_supplement",
    "clean_catalogue",
    "convert_catalogue",
    "daily_ratings",
    "decade_trends",
    "distinct_catalogue",
    "prepare_revenue_rows",
    "relative_alerts",
    "revenue_model",
    "revenue_report",
    "tag_ratings",
]
