"""Best-fit packing of token sequences in rounds over a tree.

Documents are cut into pieces that fit a sequence. Every partition packs its pieces best-fit
decreasing and emits the bins that are full or nearly so. Underfull bins become items of the next
round, dealt to fewer groups by the fan-in of the tree until one group is left. A group never has
more than ``group_items`` items: where underfull bins do not get fewer (say all pieces are longer
than half a sequence), the tree stops as soon as a round merges under one in a hundred of them, and
they are sequences as they are. What moves between rounds is an id and a length per bin.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text, materialise, schema_of
from marquee.llm.tokens import encoder, vocabulary

PIECES = "piece_key long, doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"
PACKED = "item long, size long, bin long, offset long, bin_size long"
FAN_IN = 8
GROUP_ITEMS = 200_000
#: A bin with no more than this share of a sequence left is nearly full.
SLACK_SHARE = 256


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens; only the first may be shorter than ``capacity``."""
    full, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * full


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, tokenizer: str | None = None,
    escape_special: bool = False,
) -> DataFrame:
    """A row per piece, written to the shared folder: its key, place in its document, ids and their CRC-32.

    ``ids`` and the checksum are of little-endian unsigned 32-bit integers. The string of a special token in a
    text is that token, unless ``escape_special`` makes it ordinary text. A null text is empty and gives one
    piece with the end id.
    """
    vocabulary_file = tokenizer or vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, key, end = encoder(vocabulary_file, escape_special), TaskContext.get().partitionId() << 40, struct.pack("<I", end_id)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(batch.column("text").to_pylist())):
                ids, start = ids + end, 0
                for piece, length in enumerate(cut(len(ids) // 4, capacity)):
                    data = ids[4 * start : 4 * (start + length)]
                    rows.append((key, doc_id, piece, start, length, data, zlib.crc32(data)))
                    key, start = key + 1, start + length
            if rows:
                yield pa.record_batch(list(map(list, zip(*rows))), schema=schema_of(PIECES))

    return materialise(id_and_text(docs, id_col, text_col).mapInArrow(encode, PIECES), "pieces", compression="zstd")


def best_fit(items: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: for every item its bin (the first item in it), its offset, and the bin's size.

    Open bins stand in lists by the room they have; one integer has a bit for each list that is not empty, so
    the tightest bin is found by looking at bits.
    """
    n = len(items)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    first: list[int] = []
    bits = 0
    order = np.lexsort((items, -sizes)).tolist()
    size_of = sizes.tolist()
    for i in order:
        size = size_of[i]
        if above := bits >> size:
            room = size + (above & -above).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                bits ^= 1 << room
        else:
            room, b = capacity, len(first)
            first.append(i)
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            rooms[room - size].append(b)
            bits |= 1 << (room - size)
    if not n:
        return bins, offsets, bins
    filled = np.bincount(bins, weights=sizes, minlength=len(first)).astype(np.int64)
    return items[np.array(first)][bins], offsets, filled[bins]


def _pack(items: np.ndarray, sizes: np.ndarray, capacity: int) -> pa.Table:
    bins, offsets, filled = best_fit(items, sizes, capacity)
    return pa.table([items, sizes, bins, offsets, filled], schema=schema_of(PACKED))


def pack(pieces: DataFrame, capacity: int = 1024, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``piece_key``, ``sequence_id`` and ``offset`` for rows of ``piece_key`` and ``length``.

    Lengths lie between 1 and ``capacity``; keys are unique. Ties of length are broken by key. An empty table
    gives an empty result.
    """
    enough = capacity - capacity // SLACK_SHARE

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> list[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            return _pack(rows.column(0).to_numpy(), rows.column(1).to_numpy(), capacity).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= group_items:
                yield from packed()
                held = []
        if held:
            yield from packed()

    def merge(table: pa.Table) -> pa.Table:
        return _pack(table.column("item").to_numpy(), table.column("size").to_numpy(), capacity)

    levels = [materialise(pieces.select("piece_key", "length").mapInArrow(local, PACKED), "bins")]
    groups = len(levels[0].inputFiles())  # one for each task of the first round
    underfull = _underfull(levels[-1], enough)
    count = underfull.count()
    while count > 1:
        groups = max(1, -(-count // group_items), -(-groups // FAN_IN))
        dealt = underfull.withColumn("group", F.pmod(F.xxhash64(F.lit(len(levels)), "item"), F.lit(groups)))
        levels.append(materialise(dealt.groupBy("group").applyInArrow(merge, PACKED), "bins"))
        underfull = _underfull(levels[-1], enough)
        before, count = count, underfull.count()
        if groups == 1 or count > before * 0.99:
            break
    placed = levels[0].select(F.col("item").alias("piece_key"), F.col("bin").alias("sequence_id"), "offset")
    for level in levels[1:]:
        up = level.select("item", "bin", F.col("offset").alias("more"))
        placed = placed.join(up, F.col("sequence_id") == F.col("item"), "left").select(
            "piece_key",
            F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
        )
    return placed


def _underfull(level: DataFrame, enough: int) -> DataFrame:
    """The bins that a level leaves for the next: one row each, from the item that opened the bin."""
    opened = (F.col("item") == F.col("bin")) & (F.col("bin_size") < enough)
    return level.where(opened).select(F.col("bin").alias("item"), F.col("bin_size").alias("size"))


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, tokenizer: str | None = None,
    escape_special: bool = False,
) -> DataFrame:
    """A row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    Rows that repeat an id or a text are documents of their own.
    """
    pieces = token_pieces(docs, id_col, text_col, capacity, end_id, tokenizer, escape_special)
    placed = materialise(pack(pieces, capacity), "placed").withColumnRenamed("piece_key", "placed_key")
    return pieces.join(placed, F.col("piece_key") == F.col("placed_key")).drop("piece_key", "placed_key")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` (all tokens of the sequence, 32-bit integers) and ``docs`` (its pieces in order).

    A group has at most as many rows as a sequence has tokens.
    """
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(rows.alias("pieces")).select(
        "sequence_id",
        F.expr("aggregate(pieces, X'', (acc, p) -> acc || p.ids)").alias("ids"),
        F.transform("pieces", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("docs"),
    )
