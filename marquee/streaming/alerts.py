"""Start an alert as a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from marquee.session import scratch_dir
from marquee.streaming.sinks import BatchWriter


def low_rated_stream(
    alerts: DataFrame,
    write_batch: BatchWriter,
    checkpoint: str | None = None,
    mode: str = "complete",
    every: str | None = "2 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Run a streaming ``absolute_alerts`` / ``relative_alerts`` frame into ``write_batch``.

    In complete mode every batch holds the whole result, so an item leaves it once its mean has
    risen again; the state keeps one row per item and day for good. ``every=None`` processes what is
    available and stops. Give a ``checkpoint`` folder to continue after a restart; by default each
    start has its own and reads the source from its beginning. The caller decides whether to wait
    for the returned query.

    Other modes hand over changed rows only and never take one back, so a sink that replaces the
    result would lose rows: they are refused unless ``write_batch`` has an attribute ``merges`` that
    is true. :func:`merge_each_batch` has: in update mode give it the daily ratings themselves, as it has to
    see the means that have risen too, and the threshold as its condition.
    """
    if mode != "complete" and not getattr(write_batch, "merges", False):
        raise ValueError(f"mode {mode!r} gives changed rows only; this sink replaces the whole result")
    writer = (
        alerts.writeStream.outputMode(mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint or scratch_dir(alerts.sparkSession, "checkpoint"))
    )
    if name is not None:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
