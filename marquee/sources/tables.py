"""Bounded tables: scan, load, preview, write."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_table(
    spark: SparkSession,
    name: str | None = None,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Read a table.

    Without ``fmt``, ``name`` is a catalog table. With ``fmt`` (``parquet``, ``csv``, any connector
    on the classpath) ``name`` is the path, or ``None`` when the options alone say what to read.
    """
    if fmt is None:
        return spark.table(name)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(name) if name is not None else reader.load()


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Read CSV with a header line. Types are inferred, at the price of one more pass over the
    files, unless ``schema`` is given."""
    reader = spark.read.options(header=True, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_table(
    df: DataFrame,
    target: str | None,
    fmt: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **options: Any,
) -> None:
    """Write a table; by default the old content is replaced.

    ``fmt=None`` writes the catalog table ``target``; otherwise ``target`` is the path for ``fmt``,
    or ``None`` when the options name it (``table=...`` for warehouse connectors).
    """
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt is None:
        writer.saveAsTable(target)
    elif target is None:
        writer.format(fmt).save()
    else:
        writer.format(fmt).save(target)


def ingest_csv(
    spark: SparkSession,
    path: str | list[str],
    target: str,
    fmt: str | None = None,
    mode: str = "append",
    schema: T.StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Load CSV files into a table, wait for the load, and return the loaded table."""
    write_table(scan_csv(spark, path, schema, **options), target, fmt, mode)
    return scan_table(spark, target, fmt)


def preview_table(
    spark: SparkSession,
    table: str | DataFrame,
    n: int = 100,
    order_by: str | None = None,
) -> DataFrame:
    """First ``n`` rows through SQL; ``order_by`` (a SQL ordering) makes them repeatable."""
    df = spark.table(table) if isinstance(table, str) else table
    order = f"ORDER BY {order_by} " if order_by else ""
    return spark.sql(f"SELECT * FROM {{source}} {order}LIMIT :n", args={"n": n}, source=df)
