"""Message logs: topic sources, decoding, JSON parsing, publishing.

All functions except the sources take any DataFrame with the standard topic columns (``key``,
``value``, ``topic``, ``partition``, ``offset``, ``timestamp``), bounded or streaming.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import parse_date


def topic_options(
    servers: str,
    topic: str,
    partitions: list[int] | None = None,
    start: str | dict[int, int] = "earliest",
    end: str | dict[int, int] | None = None,
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source, for :func:`stream_source` or ``scan_table(fmt="kafka")``.

    ``partitions`` assigns single partitions instead of subscribing. ``start`` / ``end`` are a
    keyword or offsets per partition (``end`` is exclusive and only for bounded reads).
    ``min_partitions`` lets more tasks than topic partitions read, so one big partition does not
    end up in one task; ``max_per_trigger`` bounds a micro-batch.
    """
    options = {"kafka.bootstrap.servers": servers}
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: partitions})

    def offsets(value: str | dict[int, int]) -> str:
        if isinstance(value, str):
            return value
        return json.dumps({topic: {str(p): o for p, o in value.items()}})

    options["startingOffsets"] = offsets(start)
    if end is not None:
        options["endingOffsets"] = offsets(end)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_source(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Unbounded source: a topic, or a folder that files are added to."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def decode_messages(log: DataFrame) -> DataFrame:
    """Key and value as text, and ``display``: key, three blanks, value (value alone without key)."""
    key, value = F.col("key").cast("string"), F.col("value").cast("string")
    return log.withColumns(
        {
            "key": key,
            "value": value,
            "display": F.when(F.length(key) > 0, F.concat(key, F.lit("   "), value)).otherwise(value),
        }
    )


def read_partition(log: DataFrame, partition: int) -> DataFrame:
    """Messages of one partition."""
    return log.where(F.col("partition") == partition)


def read_offset_range(
    log: DataFrame, partition: int = 0, start: int = 0, end: int | None = None
) -> DataFrame:
    """Messages of one partition from offset ``start`` up to, not including, ``end``.

    ``end=None`` is the present end of the log. An empty partition gives no rows.
    """
    rows = read_partition(log, partition).where(F.col("offset") >= start)
    return rows if end is None else rows.where(F.col("offset") < end)


def parse_json_messages(
    log: DataFrame,
    schema: T.StructType | str,
    date_column: str | None = "Review_Date",
    date_format: str = "M/d/yyyy",
    rejects: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Typed rows from JSON in ``value``.

    ``keep`` names columns of the log, such as ``partition`` and ``offset``, that come along.

    Malformed text gives a row of NULLs, a field of the wrong type gives NULL in that field.
    ``rejects`` names an extra column that keeps the raw text of such messages, and of those with a
    date that is not in the format.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {}
    if rejects is not None:
        struct = T.StructType([*struct.fields, T.StructField(rejects, T.StringType())])
        options["columnNameOfCorruptRecord"] = rejects
    text = F.col("value").cast("string")
    keep = keep or []
    if shared := [c for c in keep if c in struct.names]:
        raise ValueError(f"messages and their log both have {shared}")
    parsed = log.select(F.from_json(text, struct, options).alias("r"), text.alias("_text"), *keep)
    if date_column is None:
        return parsed.select("r.*", *keep)
    day = parse_date(F.col("r").getField(date_column), date_format)
    columns = [day.alias(n) if n == date_column else F.col("r").getField(n).alias(n) for n in struct.names]
    if rejects is not None:
        wrong = F.col("r").getField(date_column).isNotNull() & day.isNull()
        raw = F.coalesce(F.col("r").getField(rejects), F.when(wrong, F.col("_text")))
        columns = [raw.alias(rejects) if n == rejects else c for n, c in zip(struct.names, columns)]
    return parsed.select(*columns, *keep)


def read_json_objects(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    array: bool = False,
) -> DataFrame:
    """Objects of JSON files: one object per line, or (``array=True``) one array per file.

    An array file cannot be split between tasks, so large arrays should come as many files.
    """
    reader = spark.read.option("multiLine", array)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def publish_json(
    df: DataFrame,
    target: str | None = None,
    fmt: str = "text",
    mode: str = "append",
    key: str | None = None,
    **options: Any,
) -> None:
    """Send every row as one JSON message to a topic (``fmt="kafka"``) or a text folder."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    columns = [value] if key is None else [F.col(key).cast("string").alias("key"), value]
    writer = df.select(*columns).write.format(fmt).mode(mode).options(**options)
    writer.save(target) if target is not None else writer.save()
