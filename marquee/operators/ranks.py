"""Ranks over a whole table by a distributed sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise


def ranks(df: DataFrame, index: str, *order_by: Column) -> DataFrame:
    """``df`` with its rows' positions in the order, from 0, as a whole number ``index``.

    Each task numbers its own range of the sorted rows; the ranges' first positions come from a running
    sum with one row per task. Runs a job: the sorted rows are saved.
    """
    # The id is (task << 33) + position in the task's sorted range.
    ranges = materialise(df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()), "ranks").withColumns(
        {"_range": F.shiftright("_id", 33), "_position": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return ranges.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + F.col("_position")).alias(index)
    )
