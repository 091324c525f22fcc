"""Column expressions. Everything here is a built-in Spark expression: no UDF, and a value that
cannot be converted becomes NULL whether or not ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


# A failing cast costs an exception inside Spark, some fifty times the price of a good one, so text
# that cannot be a number is told apart by its form first. Blanks are what a cast trims.
_BLANK = r"[\x00-\x20]*"
_WHOLE_NUMBER = rf"^{_BLANK}[+-]?0*\d{{1,18}}(?:\.\d*)?{_BLANK}$"
_REAL_NUMBER = rf"(?i)^{_BLANK}[+-]?(?:\.?\d[\da-z+\-.]*|nan|inf|infinity){_BLANK}$"


def _by_type(c: Column, text: Column, other: Column) -> Column:
    """``text`` for a text column, else ``other``; decided while the plan is optimised."""
    return F.when(F.typeof(c).startswith("string"), text).otherwise(other)


def to_int(column: str | Column) -> Column:
    """Integer value of a number or of text; the fraction of ``"142.5"`` is cut off."""
    c = _col(column)
    text = c.cast("string")
    digits = F.when(text.rlike(_WHOLE_NUMBER), F.substring_index(text, ".", 1))
    return _by_type(c, digits.try_cast("int"), c.try_cast("int"))


def to_double(column: str | Column) -> Column:
    """Double value; text with thousands separators is NULL."""
    c = _col(column)
    number = F.when(c.cast("string").rlike(_REAL_NUMBER), c)
    return _by_type(c, number.try_cast("double"), c.try_cast("double"))


def strip_unit(column: str | Column, unit: str = " min") -> Column:
    """``"142 min"`` to ``142``: every occurrence of ``unit`` is removed before the cast."""
    return to_int(F.replace(_col(column), F.lit(unit), F.lit("")))


def bucket_floor(column: str | Column, width: int) -> Column:
    """Lower bound of the bucket of ``width`` that holds the integer value."""
    return (F.floor(to_int(column) / width) * width).try_cast("int")


def decade_of(column: str | Column) -> Column:
    return bucket_floor(column, 10)


def parse_date(column: str | Column, fmt: str = "M/d/yyyy") -> Column:
    """Date written as ``fmt``; any other text is NULL."""
    return F.try_to_date(_col(column), fmt)


def split_tags(column: str | Column, separator: str = ", ") -> Column:
    """Array of tags. Outer blanks of the whole text are trimmed, those of single tags are not."""
    return F.split(F.trim(_col(column)), rf"\Q{separator}\E")


def rating_gap(overall: str | Column, daily: str | Column, digits: int | None = None) -> Column:
    """How far ``daily`` lies below ``overall``. ``digits`` rounds away binary noise, so that a
    gap of exactly 3.0 is not seen as 2.9999999999999996."""
    gap = _col(overall) - _col(daily)
    return gap if digits is None else F.round(gap, digits)
