"""Null policies. Filling and dropping give different averages, so they stay separate operators."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_missing(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Replace NULL (and NaN in floating columns) per column; absent columns are ignored.

    The value takes the type of the column.
    """
    return df.fillna({name: value for name, value in values.items() if name in df.columns})


def _present(df: DataFrame, columns: dict[str, Column]) -> Column:
    """True where no column is NULL or, for floating types, NaN. Unlike ``dropna`` this is made of
    ``IS NOT NULL`` tests, which reach the scan."""
    types = dict(df.select([c.alias(name) for name, c in columns.items()]).dtypes)
    tests = [
        c.isNotNull() & ~F.isnan(c) if types[name] in ("double", "float") else c.isNotNull()
        for name, c in columns.items()
    ]
    return reduce(lambda a, b: a & b, tests)


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns``."""
    return df.where(_present(df, {c: F.col(c) for c in columns}))


def cleaning_report(
    df: DataFrame, columns: list[str], conversions: dict[str, Column] | None = None
) -> DataFrame:
    """One row: all rows, rows left after dropping missing raw values, and rows left after dropping
    again once ``conversions`` (column name to expression) have been applied. One pass."""
    raw = _present(df, {c: F.col(c) for c in columns})
    converted = _present(df, {c: (conversions or {}).get(c, F.col(c)) for c in columns})
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(raw, 1)).alias("rows_after_first_drop"),
        F.count(F.when(raw & converted, 1)).alias("rows_after_second_drop"),
    )
