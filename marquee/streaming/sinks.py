"""Micro-batch sinks: whole results with every batch, or changed rows merged by key."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from marquee.session import create_file, remove_path
from marquee.sources.tables import write_table

BatchWriter = Callable[[DataFrame, int], None]

_MARKER = "version bigint, folder string, published_at double"


def overwrite_each_batch(target: str | None, fmt: str | None = None, **options: Any) -> BatchWriter:
    """Batch function that overwrites one table, as :func:`write_table` does.

    Rewriting a batch after a failure gives the same table. Whether readers can see the table
    between two states depends on the format; see :func:`publish_each_batch`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, target, fmt, "overwrite", **options)

    return write


def publish_each_batch(path: str, keep: int = 3, keep_seconds: float = 600.0) -> BatchWriter:
    """Batch function that writes complete versions for :func:`read_published`.

    Every batch is evaluated and written to a folder of its own, then a marker with the next version number
    makes it the newest; a batch that is run again is a new version with the same rows. Numbers go on from
    what is published under ``path``, not from the query's batches, so a start without the old checkpoint
    works on an existing target.

    One writer at a time: a marker is created exclusively, so two writers cannot publish one number, and a
    writer that finds a version it did not write since its last one stops with :class:`FencedError`, its rows
    unpublished. Versions are removed once they are older than ``keep_seconds`` and not among the newest
    ``keep``: a reader may use a version for that long after it was replaced.
    """
    if keep < 2:
        raise ValueError("keep at least two versions")
    log = _Log(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{path}/data/{uuid.uuid4().hex}"
        versions = log.check(spark)
        batch.write.parquet(folder)
        version, now = log.commit(spark, folder, versions)
        # What was replaced more than keep_seconds ago: the version after it is that old.
        for old, after in zip(versions[: max(0, len(versions) + 1 - keep)], versions[1:]):
            if after.published_at < now - keep_seconds:
                remove_path(spark, old.folder)
                remove_path(spark, _marker(path, old.version))

    return write


class FencedError(RuntimeError):
    """Another writer has published under the same path."""


def _marker(path: str, version: int) -> str:
    return f"{path}/marker/{version:020d}.json"


class _Log:
    """Markers of one writer under a path."""

    def __init__(self, path: str):
        self.path = path
        self.last: int | None = None

    def check(self, spark: SparkSession) -> list[Row]:
        """What is published, oldest first; refuses if another writer has come in between."""
        versions = sorted(_published(spark, self.path), key=lambda v: v.version)
        newest = versions[-1].version if versions else -1
        if self.last is not None and newest != self.last:
            raise FencedError(f"another writer has published version {newest} of {self.path}")
        return versions

    def commit(self, spark: SparkSession, folder: str, versions: list[Row]) -> tuple[int, float]:
        """Publish ``folder`` as the version after those seen by :meth:`check`."""
        version, now = (versions[-1].version + 1 if versions else 0), time.time()
        row = json.dumps({"version": version, "folder": folder, "published_at": now})
        if not create_file(spark, _marker(self.path, version), row.encode()):
            remove_path(spark, folder)
            raise FencedError(f"another writer has published version {version} of {self.path}")
        self.last = version
        return version, now


def _published(spark: SparkSession, path: str) -> list[Row]:
    """Markers under ``path``: one row per version that is kept."""
    try:
        return spark.read.schema(_MARKER).json(f"{path}/marker").where("version IS NOT NULL").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete version written by :func:`publish_each_batch`."""
    versions = _published(spark, path)
    if not versions:
        raise ValueError(f"nothing has been published under {path}")
    return spark.read.parquet(max(versions, key=lambda v: v.version).folder)


_ALIVE = "_alive"


def merge_each_batch(
    path: str, keys: list[str], condition: Column, compact_every: int = 50, keep_seconds: float = 600.0
) -> BatchWriter:
    """Batch function for update mode: rows of a batch replace those with the same ``keys``, and a row leaves the
    table when ``condition`` no longer holds for it. Read with :func:`read_merged`.

    The stream must hand over all changed rows, not only those that fulfil the condition. A batch writes its
    own rows and nothing else, marked with whether they stay, so its cost follows what has changed. Every
    ``compact_every`` batches the rows that stay are written anew and older changes removed, once they have been
    replaced for ``keep_seconds``.

    A batch that is run again, also after a restart, gives the same table: replacing rows by the same rows
    changes nothing. One writer at a time, as in :func:`publish_each_batch`.
    """
    log = _Log(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = log.check(spark)
        folder = f"{path}/data/change-{uuid.uuid4().hex}"
        batch.withColumn(_ALIVE, F.coalesce(condition, F.lit(False))).write.parquet(folder)
        _, now = log.commit(spark, folder, versions)
        since = _since_whole(versions)
        if len(since) + 1 >= compact_every:
            versions = log.check(spark)
            whole = f"{path}/data/whole-{uuid.uuid4().hex}"
            _merged(spark, versions, keys).withColumn(_ALIVE, F.lit(True)).write.parquet(whole)
            log.commit(spark, whole, versions)
        for old in versions[: len(versions) - len(_since_whole(versions))]:
            if old.published_at < now - keep_seconds:
                remove_path(spark, old.folder)
                remove_path(spark, _marker(path, old.version))

    write.merges = True
    return write


def _since_whole(versions: list[Row]) -> list[Row]:
    """The versions that a reader needs: from the newest whole one on."""
    whole = [i for i, v in enumerate(versions) if "/whole-" in v.folder]
    return versions[whole[-1] :] if whole else versions


def _merged(spark: SparkSession, versions: list[Row], keys: list[str]) -> DataFrame:
    """The newest row of every key, if it stays. A grouping, partial within tasks; the versions are few."""
    parts = [spark.read.parquet(v.folder).withColumn("_version", F.lit(v.version)) for v in _since_whole(versions)]
    rows = reduce(DataFrame.unionByName, parts)
    rest = [c for c in rows.columns if c not in (*keys, "_version")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_version").alias("_row"))
    return newest.where(F.col("_row").getField(_ALIVE)).select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest if c != _ALIVE])


def read_merged(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The table that :func:`merge_each_batch` keeps, as of now; later batches do not change the frame."""
    versions = sorted(_published(spark, path), key=lambda v: v.version)
    if not versions:
        raise ValueError(f"nothing has been published under {path}")
    return _merged(spark, versions, keys)
