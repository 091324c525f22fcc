"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import materialise, scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The six ASCII white space characters that separate words and end lines.
WHITE = " \t\n\x0b\x0c\r"

#: What the operators of this worker process remember from task to task, and how to let it go.
_HELD: dict[str, Callable[[], None]] = {}

__all__ = ["UPPER", "WHITE", "ascii_lower", "byte_rows", "id_and_text", "materialise", "scratch_dir", "table", "unused_name", "words"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text``; a null text is empty. Other columns are not read."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x20\\x09-\\x0D]``: what ``bytes.split`` cuts at is just this white space."""
    return text.split()


def byte_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 of every value; a null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def hold(name: str, release: Callable[[], None]) -> None:
    """State that a task of ``name`` begins and remembers things: a worker keeps those of one operator only."""
    for other in [key for key in _HELD if key != name]:
        _HELD.pop(other)()
    _HELD[name] = release


def schema_of(spec: str) -> pa.Schema:
    """An Arrow schema from ``name type`` pairs as written in a Spark DDL string."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in spec.split(","))])
