"""Exact de-duplication through an index of cuckoo filters.

A document's key is the SHA-256 of its text with A-Z in lower case. Keys are dealt to buckets by
their first bits. A bucket of the index is a cuckoo filter over its live keys plus the keys
themselves: a key that the filter does not know is new without a look at the keys, a hit is
verified against them, and a filter that overflows is built anew, twice as large, from them.
Filters take deletions, so documents can be withdrawn: a key leaves its filter when its last
document goes.

An index is one table with a row per live key (bucket, key, keep_id, live) and a row per bucket
with the filter (key null). Updates return a new table and never change the old one, so a lost
executor repeats its buckets from unchanged input. A bucket holds about ``BUCKET_KEYS`` keys,
whatever the size of the corpus; copies are summed up by task before they are dealt out, so a
group with a third of all rows comes to its bucket as a few rows per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, id_and_text, materialise, schema_of, unused_name
from marquee.session import stages

SLOTS = 4
MOST_KICKS = 200
BUCKET_KEYS = 20_000
#: A task sums up so many different keys before it hands them on.
HELD_KEYS = 100_000

KEYS = "doc_id long, key binary"
PARTIAL = "bucket int, key binary, keep_id long, live long"
INDEX = "bucket int, key binary, keep_id long, live long, filter binary"


class CuckooFilter:
    """Partial-key cuckoo filter of 16-bit fingerprints, four to a slot group."""

    def __init__(self, groups: int = 64):
        self.groups = 1 << max(0, (groups - 1).bit_length())
        self.cells = np.zeros((self.groups, SLOTS), np.uint16)

    @staticmethod
    def _parts(key: bytes) -> tuple[int, int]:
        """Fingerprint (never zero) and place, from bytes that do not choose the bucket."""
        return int.from_bytes(key[8:10], "little") or 1, int.from_bytes(key[10:18], "little")

    def _other(self, place: int, mark: int) -> int:
        return (place ^ (mark * 0x5BD1E995)) & (self.groups - 1)

    def __contains__(self, key: bytes) -> bool:
        mark, place = self._parts(key)
        place &= self.groups - 1
        return mark in self.cells[place].tolist() or mark in self.cells[self._other(place, mark)].tolist()

    def insert(self, key: bytes) -> bool:
        """False if the filter is too full; it must then be built anew, as a mark may have no place."""
        mark, place = self._parts(key)
        place &= self.groups - 1
        for at in (place, self._other(place, mark)):
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = mark
                return True
        for kick in range(MOST_KICKS):
            slot = (mark + kick) % SLOTS
            self.cells[place, slot], mark = mark, int(self.cells[place, slot])
            place = self._other(place, mark)
            free = np.flatnonzero(self.cells[place] == 0)
            if len(free):
                self.cells[place, free[0]] = mark
                return True
        return False

    def delete(self, key: bytes) -> bool:
        """Only for keys that were inserted; takes out one copy of the mark."""
        mark, place = self._parts(key)
        place &= self.groups - 1
        for at in (place, self._other(place, mark)):
            slot = np.flatnonzero(self.cells[at] == mark)
            if len(slot):
                self.cells[at, slot[0]] = 0
                return True
        return False

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        found = cls(len(data) // (2 * SLOTS))
        found.cells = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return found


class Bucket:
    """A filter with the keys that it stands for."""

    def __init__(self, filter_bytes: bytes | None = None, groups: int = 64):
        self.filter = CuckooFilter.from_bytes(filter_bytes) if filter_bytes else CuckooFilter(groups)
        self.kept: dict[bytes, tuple[int | None, int]] = {}
        self.resized = self.false_hits = 0

    def add(self, key: bytes, keep_id: int | None, live: int) -> None:
        if key in self.filter:
            if (old := self.kept.get(key)) is not None:
                self.kept[key] = (_larger(old[0], keep_id), old[1] + live)
                return
            self.false_hits += 1
        self.kept[key] = (keep_id, live)
        if not self.filter.insert(key):
            self._resize()

    def _resize(self) -> None:
        groups = self.filter.groups
        while True:
            groups *= 2
            self.resized += 1
            self.filter = CuckooFilter(groups)
            if all(self.filter.insert(key) for key in self.kept):
                return

    def replace(self, key: bytes, keep_id: int | None, live: int) -> None:
        """What is left of a key after a withdrawal."""
        if key not in self.filter or key not in self.kept:
            return
        if live:
            self.kept[key] = (keep_id, live)
        else:
            del self.kept[key]
            self.filter.delete(key)

    def rows(self, number: int) -> pa.Table:
        keys = [*self.kept, None]
        values = [*self.kept.values(), (None, None)]
        return pa.table(
            [
                [number] * len(keys),
                keys,
                [keep for keep, _ in values],
                [live for _, live in values],
                [None] * len(self.kept) + [self.filter.to_bytes()],
            ],
            schema=schema_of(INDEX),
        )


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def text_key(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower() changes A-Z only


def text_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id`` and ``key``. Null text counts as empty."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [text_key(text) for text in byte_rows(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array(keys, pa.binary())], schema=schema_of(KEYS))

    return id_and_text(docs, id_col, text_col).mapInArrow(digest, KEYS)


def bucket_count(rows: int) -> int:
    """A power of two that leaves a bucket about ``BUCKET_KEYS`` keys."""
    return 1 << max(4, (max(1, rows) // BUCKET_KEYS).bit_length())


def _partial(keys: DataFrame, buckets: int) -> DataFrame:
    """Copies summed up within each task."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def rows() -> pa.RecordBatch:
            number = [int.from_bytes(key[:4], "big") & (buckets - 1) for key in held]
            return pa.record_batch(
                [number, list(held), [x[0] for x in held.values()], [x[1] for x in held.values()]], schema=schema_of(PARTIAL)
            )

        for batch in batches:
            for doc_id, key in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()):
                if (old := held.get(key)) is None:
                    held[key] = [doc_id, 1]
                else:
                    old[0] = _larger(old[0], doc_id)
                    old[1] += 1
            if len(held) >= HELD_KEYS:
                yield rows()
                held = {}
        if held:
            yield rows()

    return keys.mapInArrow(combine, PARTIAL)


def _load(table: pa.Table) -> Bucket:
    filters = [x for x in table.column("filter").to_pylist() if x is not None]
    bucket = Bucket(filters[0] if filters else None)
    for key, keep_id, live in zip(*(table.column(c).to_pylist() for c in ("key", "keep_id", "live"))):
        if key is not None:
            bucket.kept[key] = (keep_id, live)
    return bucket


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INDEX)


def _update(index: DataFrame, rows: DataFrame, withdraw: bool) -> DataFrame:
    def apply(new: pa.Table, old: pa.Table) -> pa.Table:
        number = (new if new.num_rows else old).column("bucket")[0].as_py()
        bucket = _load(old)
        step = bucket.replace if withdraw else bucket.add
        for key, keep_id, live in zip(*(new.column(c).to_pylist() for c in ("key", "keep_id", "live"))):
            step(key, keep_id, live)
        return bucket.rows(number)

    return rows.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(apply, INDEX)


def insert(index: DataFrame, keys: DataFrame, buckets: int) -> DataFrame:
    """The index with the documents of ``keys`` (``doc_id``, ``key``) added.

    ``buckets`` is a power of two (``bucket_count``) and stays the same for the life of an index.
    """
    return _update(index, _partial(keys, buckets), withdraw=False)


def delete(index: DataFrame, members: DataFrame, withdrawn: DataFrame, buckets: int) -> DataFrame:
    """The index without the documents of ``withdrawn``.

    ``members`` holds all (``doc_id``, ``key``) that were inserted so far. Of a key with documents left, the
    largest ``doc_id`` left stays. Rows of ``withdrawn`` that are not members change nothing.
    """
    gone = withdrawn.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    rest = members.select("doc_id", "key").join(gone, same, "left_anti")
    touched = members.join(gone, same, "left_semi").select("key").distinct()
    left = (
        touched.join(rest.withColumnRenamed("key", "rest_key"), F.col("key") == F.col("rest_key"), "left")
        .groupBy("key")
        .agg(F.max("doc_id").alias("keep_id"), F.count("rest_key").alias("live"))
        .select(bucket_of(F.col("key"), buckets).alias("bucket"), "key", "keep_id", "live")
    )
    return _update(index, left, withdraw=True)


def bucket_of(key: Column, buckets: int) -> Column:
    first = F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long")
    return first.bitwiseAND(F.lit(buckets - 1)).cast("int")


def live_keys(index: DataFrame) -> DataFrame:
    """A row per live key: ``key``, ``keep_id`` (largest ``doc_id``), ``live`` (number of documents)."""
    return index.where(F.col("key").isNotNull()).select("key", "keep_id", "live")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``key``, ``keep_id``, ``live`` and ``kept``.

    Of equal texts the row with the largest ``doc_id`` stays; rows that repeat that ``doc_id`` and text are all
    marked kept. A null ``doc_id`` is smaller than any other. An empty table gives an empty result.
    """
    keys = materialise(text_keys(docs, id_col, text_col), "keys")
    buckets = bucket_count(keys.count())
    index = materialise(insert(empty_index(docs.sparkSession), keys, buckets), "cuckoo")
    return keys.join(live_keys(index), "key").select(
        "doc_id", "key", "keep_id", "live", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, but one row of each group of equal texts.

    The row with the largest id stays (nulls are the smallest); of rows that repeat it the first by an internal
    number. Null texts equal empty ones. Working columns get names that ``docs`` does not have.
    """
    key, row, stays = (unused_name(docs, name) for name in ("_exact_key", "_exact_row", "_exact_stays"))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([text_key(text) for text in byte_rows(batch.column(text_col))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], schema=batch.schema.append(pa.field(key, pa.binary())))

    with stages(docs.sparkSession) as run:
        schema = docs.select("*", F.lit(None).cast("binary").alias(key)).schema
        rows = docs.mapInArrow(tag, schema).withColumn(row, F.monotonically_increasing_id())
        rows = materialise(rows, "tagged", compression="zstd")
        keys = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(key).alias("key"), F.col(row).alias("row"))
        index = materialise(insert(empty_index(docs.sparkSession), keys.select("doc_id", "key"), bucket_count(keys.count())), "cuckoo")
        # One row per key on both sides, summed up within tasks first, so a text that a third of all rows have is no burden.
        last = keys.groupBy("key").agg(F.max(F.struct("doc_id", (-F.col("row")).alias("back"))).alias("last"))
        best = last.join(live_keys(index), "key").where(F.col("last.doc_id").eqNullSafe(F.col("keep_id")))
        stay = run.keep(best.select((-F.col("last.back")).alias(stays)), "stay")
        # Small corpora run the plan of large ones.
        return run.keep(rows).join(stay.hint("merge"), F.col(row) == F.col(stays), "left_semi").drop(key, row)
