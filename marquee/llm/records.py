"""Token ids as length-delimited binary records with masked checksums, and an offset index.

A shard is a run of frames: length (unsigned 64-bit), masked CRC-32C of the length, payload,
masked CRC-32C of the payload - the framing that training frameworks know as TFRecord, all
little-endian. A payload is the document's id (signed 64-bit), a flag for a null id, the width of
a token id (2 or 4 bytes), two zero bytes, then the ids.

Documents are range-partitioned by id, so shards follow each other in ascending order and none
depends on another. A task writes its shard under a name of its own and returns one index row per
record; Spark commits the index. A shard of a task that was lost or repeated is in no committed
row and so is never read. The index holds file, offset and length of every record: shuffled
reads sort it by a seeded hash and fetch records by position.
"""

from __future__ import annotations

import struct
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text, schema_of
from marquee.llm.files import read_stream, write_stream
from marquee.llm.tokens import encoder, vocabulary

INDEX = "shard int, position long, doc_id long, file string, offset long, frame_bytes long, n_tokens long"
RECORDS = "shard int, position long, doc_id long, shard_start long, n_tokens long, ids binary, intact boolean"
HEAD = struct.Struct("<qBBH")
READ_BYTES = 4 << 20
MOST_OPEN = 32

#: CRC-32C (Castagnoli, reflected) and the constant of its mask: fixed values of the format.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 512


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Steps of two bytes at once, and for each byte of a state what ``BLOCK`` zero bytes make of it."""
    step = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    shifted = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).reshape(-1)
    for _ in range(BLOCK // 2):
        shifted = step[shifted & 0xFFFF] ^ (shifted >> 16)
    return step, shifted.reshape(4, 256)


_STEP, _SHIFT = _tables()


def crc32c(values: list[bytes]) -> np.ndarray:
    """CRC-32C of each value (at least four bytes long), all blocks of all values side by side.

    Leading zeros leave an all-zero state alone, so values are filled up on the left; the usual start state is
    the same as inverting the first four bytes.
    """
    if not values:
        return np.empty(0, np.uint32)
    blocks = np.array([-(-len(v) // BLOCK) for v in values])
    ends = np.cumsum(blocks) * BLOCK
    data = np.zeros(int(ends[-1]), np.uint8)
    for value, end in zip(values, ends.tolist()):
        data[end - len(value) : end] = np.frombuffer(value, np.uint8)
    first = ends - np.array([len(v) for v in values])
    for k in range(4):
        data[first + k] ^= 0xFF
    columns = np.ascontiguousarray(data.view("<u2").reshape(-1, BLOCK // 2).T)
    state = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        state = _STEP[(state ^ column) & 0xFFFF] ^ (state >> 16)
    start, total = ends // BLOCK - blocks, np.zeros(len(values), np.uint32)
    for k in range(int(blocks.max())):
        more = np.flatnonzero(blocks > k)
        s = total[more]
        s = _SHIFT[0][s & 255] ^ _SHIFT[1][(s >> 8) & 255] ^ _SHIFT[2][(s >> 16) & 255] ^ _SHIFT[3][s >> 24]
        total[more] = s ^ state[start[more] + k]
    return total ^ np.uint32(0xFFFFFFFF)


def masked(values: list[bytes]) -> list[int]:
    crc = crc32c(values).astype(np.uint64)
    return ((((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF).tolist()


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    return [
        b"".join((n, struct.pack("<I", a), p, struct.pack("<I", b)))
        for n, a, p, b in zip(lengths, masked(lengths), payloads, masked(payloads))
    ]


def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """``ids`` are 32-bit integers; ``width`` 2 stores them in half the space."""
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return HEAD.pack(doc_id or 0, doc_id is None, width, 0) + body


def parse(data: bytes) -> tuple[int | None, bytes]:
    doc_id, null, width, _ = HEAD.unpack_from(data)
    ids = data[HEAD.size :]
    return None if null else doc_id, ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def write_records(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0,
    escape_special: bool = False,
) -> None:
    """Encode every text, append ``end_id`` and write ``path/shards`` and ``path/index`` in ascending id order.

    The string of a special token in a text is that token, unless ``escape_special`` makes it ordinary text.
    A null text is empty; a null id comes first; equal ids stand in an order that depends on their texts only.
    Of an empty table the index is empty and there is no shard. ``path`` must be a URI that executors can write.
    """
    vocabulary_file = tokenizer or vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary_file, escape_special)
        width = 2 if max(words.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        shard, position, offset, out = TaskContext.get().partitionId(), 0, 0, None
        file = f"{path}/shards/shard-{shard:07d}-{uuid.uuid4().hex}.rec"
        end = struct.pack("<I", end_id)
        try:
            for batch in batches:
                doc_ids = batch.column("doc_id").to_pylist()
                ids = [x + end for x in words.encode(batch.column("text").to_pylist())]
                made = frames([payload(d, x, width) for d, x in zip(doc_ids, ids)])
                if not made:
                    continue
                out = out or write_stream(file)
                out.write(b"".join(made))
                sizes = np.array([len(x) for x in made])
                offsets = offset + np.cumsum(sizes) - sizes
                n = len(made)
                yield pa.record_batch(
                    [[shard] * n, range(position, position + n), doc_ids, [file] * n, offsets, sizes, [len(x) // 4 for x in ids]],
                    schema=schema_of(INDEX),
                )
                position, offset = position + n, offset + int(sizes.sum())
        finally:
            if out:
                out.close()

    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _record_rows(found: list[tuple], crcs: bool = True) -> pa.RecordBatch:
    """(shard, position, start in shard or None, length field, its checksum, payload, its checksum) to rows."""
    good = [a == b and c == d for a, b, c, d in zip(masked([x[3] for x in found]), (x[4] for x in found), masked([x[5] for x in found]), (x[6] for x in found))]
    parsed = [parse(x[5]) for x in found]
    return pa.record_batch(
        [
            [x[0] for x in found],
            [x[1] for x in found],
            [doc_id for doc_id, _ in parsed],
            [x[2] for x in found],
            [len(ids) // 4 for _, ids in parsed],
            [ids for _, ids in parsed],
            good,
        ],
        schema=schema_of(RECORDS),
    )


def _with_starts(found: list[tuple], start: int) -> tuple[list[tuple], int]:
    out = []
    for shard, position, n, a, data, b in found:
        out.append((shard, position, start, n, a, data, b))
        start += (len(data) - HEAD.size) // data[9]
    return out, start


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records in file order within their shards; shards are read side by side.

    ``shard_start`` is the number of ids before the record in its shard, ``intact`` is false where a checksum
    does not fit. A shard that ends early raises an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file in zip(batch.column("shard").to_pylist(), batch.column("file").to_pylist()):
                with read_stream(file) as source:
                    held, position, start = b"", 0, 0
                    while True:
                        chunk = source.read(READ_BYTES)
                        held += chunk
                        found, at = [], 0
                        while at + 12 <= len(held):
                            (n,) = struct.unpack_from("<Q", held, at)
                            if at + 16 + n > len(held):
                                break
                            (a,), (b,) = struct.unpack_from("<I", held, at + 8), struct.unpack_from("<I", held, at + 12 + n)
                            found.append((shard, position, held[at : at + 8], a, held[at + 12 : at + 12 + n], b))
                            at, position = at + 16 + n, position + 1
                        held = held[at:]
                        if found:
                            rows, start = _with_starts(found, start)
                            yield _record_rows(rows)
                        if not chunk:
                            break
                    if held:
                        raise ValueError(f"{file} ends within a record")

    shards = read_index(spark, path).groupBy("shard").agg(F.min("file").alias("file"))
    last = shards.agg(F.max("shard")).first()[0]
    tasks = 1 if last is None else last + 1
    return shards.repartitionById(tasks, F.col("shard")).mapInArrow(read, RECORDS)


def shuffled_records(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records in an order that depends on ``seed`` only, fetched one by one through the index."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_files: OrderedDict[str, object] = OrderedDict()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = []
                for row in batch.slice(at, 256).to_pylist():
                    if row["file"] not in open_files:
                        open_files[row["file"]] = read_stream(row["file"])
                        if len(open_files) > MOST_OPEN:
                            open_files.popitem(last=False)[1].close()
                    open_files.move_to_end(row["file"])
                    source = open_files[row["file"]]
                    source.seek(row["offset"])
                    data = source.read(row["frame_bytes"])
                    (a,), (b,) = struct.unpack_from("<I", data, 8), struct.unpack_from("<I", data, len(data) - 4)
                    found.append((row["shard"], row["position"], None, data[:8], a, data[12:-4], b))
                yield _record_rows(found)
        for source in open_files.values():
            source.close()

    order = F.xxhash64(F.lit(seed), "shard", "position")
    index = read_index(spark, path).withColumn("place", order)
    return index.repartitionByRange("place", "shard", "position").sortWithinPartitions("place", "shard", "position").drop("place").mapInArrow(fetch, RECORDS)


def with_global_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``start``: the number of ids of all records before this one, over all shards.

    Shards' totals are one row each, so the running sum over them and its broadcast are as small as the list of
    files.
    """
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    firsts = totals.select(F.col("shard").alias("of_shard"), F.coalesce(before, F.lit(0)).alias("before"))
    return (
        records.join(F.broadcast(firsts), F.col("shard") == F.col("of_shard"))
        .withColumn("start", F.col("shard_start") + F.col("before"))
        .drop("of_shard", "before")
    )
