from marquee.functions.scalars import (
    bucket_floor,
    decade_of,
    parse_date,
    rating_gap,
    split_tags,
    strip_unit,
    to_double,
    to_int,
)

__all__ = [
    "bucket_floor",
    "decade_of",
    "parse_date",
    "rating_gap",
    "split_tags",
    "strip_unit",
    "to_double",
    "to_int",
]
