"""Removal of lines that many documents share, as keep bitmaps; DataFrame functions only.

Hashes of long lines are range-partitioned together with a slice of the documents and sorted by
document and position. A running window streams over each run: its first row is the first
occurrence, its dense rank counts documents. The few rows of the slices are summed up per line,
and what remains of a document comes back as a run-length bitmap, not as text. Slicing spreads a
line that a third of all documents hold over ``SLICES`` runs of many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import WHITE, ascii_lower, id_and_text, materialise

SLICES = 64


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a key of their content, so that equal rows share a bitmap and others never do."""
    return id_and_text(docs, id_col, text_col).withColumn("row_key", F.xxhash64("text", "doc_id"))


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40) -> DataFrame:
    """``doc_id``, ``row_key``, ``pos`` and a 128-bit hash (``h1``, ``h2``) of every line that is long enough.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in lower case.
    """
    lines = _rows(docs, id_col, text_col).select(
        "doc_id", "row_key", F.posexplode(F.split(ascii_lower(F.col("text")), "\n")).alias("pos", "line")
    )
    key = F.btrim("line", F.lit(WHITE))
    return (
        lines.where(F.length("line") >= min_chars)
        .withColumn("key", key)
        .where(F.length("key") >= min_chars)
        .select("doc_id", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def common_lines(keys: DataFrame, min_docs: int = 5) -> DataFrame:
    """``h1``, ``h2`` and ``keep_id`` (largest document) of keys found in at least ``min_docs`` documents.

    Rows with one ``doc_id`` are one document; a null ``doc_id`` is a document smaller than all others.
    """
    sliced = keys.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    ranged = sliced.repartitionByRange("h1", "h2", "slice").sortWithinPartitions(
        "h1", "h2", "slice", F.desc_nulls_last("doc_id"), "pos"
    )
    run = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc_nulls_last("doc_id"))
    streamed = ranged.withColumns({"rank": F.dense_rank().over(run), "first_id": F.first("doc_id").over(run)})
    of_slices = streamed.groupBy("h1", "h2", "slice").agg(
        F.max("rank").alias("documents"), F.max("first_id").alias("first_id")
    )
    return (
        of_slices.groupBy("h1", "h2")
        .agg(F.sum("documents").alias("documents"), F.max("first_id").alias("keep_id"))
        .where(F.col("documents") >= min_docs)
    )


def keep_bitmaps(keys: DataFrame, common: DataFrame) -> DataFrame:
    """``doc_id``, ``row_key`` and ``dropped`` for documents that lose lines.

    ``dropped`` holds the runs of cleared bits as (``start``, ``len``) in order of their start: the run-length
    form of the keep bitmap, all of whose other bits are set.
    """
    lost = keys.join(common, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    lost = lost.groupBy("doc_id", "row_key", "pos").agg(F.lit(1))  # rows that repeat lose the same lines
    in_order = Window.partitionBy("doc_id", "row_key").orderBy("pos")
    islands = lost.withColumn("island", F.col("pos") - F.row_number().over(in_order))
    bits = islands.groupBy("doc_id", "row_key", "island").agg(
        F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("len")
    )
    return bits.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("dropped"))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The complement of ``dropped``: runs of lines that stay."""
    start = F.lit(0).cast("int")
    end = lambda r: r["start"] + r["len"]
    before = lambda i: F.when(i == 0, start).otherwise(end(F.get(dropped, i - 1)))
    inner = F.transform(dropped, lambda r, i: F.struct(before(i).alias("start"), (r["start"] - before(i)).alias("len")))
    last = end(F.element_at(dropped, -1))
    return F.concat(inner, F.array(F.struct(last.alias("start"), (n_lines - last).alias("len"))))


def bitmap_string(dropped: Column) -> Column:
    """``start+len`` of the cleared runs, comma-joined; empty if every line stays."""
    runs = F.transform(dropped, lambda r: F.concat_ws("+", r["start"].cast("string"), r["len"].cast("string")))
    return F.coalesce(F.array_join(runs, ","), F.lit(""))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """A row per document: ``doc_id``, ``text``, ``n_lines``, ``n_dropped``, ``bitmap`` and ``kept_text``.

    Lines end at ``\\n`` (a null or empty text is one empty line). Keys of ``min_chars`` characters or more that
    ``min_docs`` documents hold lose all their lines but those in the largest of these documents. A document
    that loses every line has an empty ``kept_text``. An empty table gives an empty result.
    """
    keys = materialise(line_keys(docs, id_col, text_col, min_chars), "lines")
    bitmaps = keep_bitmaps(keys, materialise(common_lines(keys, min_docs), "common")).select(
        F.col("doc_id").alias("bitmap_id"), F.col("row_key").alias("bitmap_key"), "dropped"
    )
    same = F.col("doc_id").eqNullSafe(F.col("bitmap_id")) & (F.col("row_key") == F.col("bitmap_key"))
    lines = F.split("text", "\n")
    rows = _rows(docs, id_col, text_col).join(bitmaps, same, "left").withColumn("n_lines", F.size(lines))
    kept = F.flatten(F.transform(keep_runs(F.col("dropped"), F.col("n_lines")), lambda r: F.slice(lines, r["start"] + 1, r["len"])))
    n_dropped = F.aggregate("dropped", F.lit(0), lambda n, r: n + r["len"])
    return rows.select(
        "doc_id",
        "text",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
        bitmap_string(F.col("dropped")).alias("bitmap"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
