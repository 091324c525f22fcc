"""Text to tokens, counts and topics."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.ranks import ranks
from marquee.operators.reshape import measured_bytes
from marquee.session import materialise, scratch_dir, shuffles_dropped, stages


def tokenize(df: DataFrame, column: str, output: str) -> DataFrame:
    """Lower-case words between single white space characters. Punctuation stays, two blanks in a
    row give an empty word, and blanks at the end give none. Same words as Spark ML's ``Tokenizer``,
    but as built-in expressions, and NULL text gives NULL."""
    text = F.rtrim(F.col(column), F.lit(" \t\n\x0b\f\r"))
    only_blanks = (text == "") & (F.col(column) != "")
    words = F.when(only_blanks, F.array().cast("array<string>")).otherwise(
        F.split(F.lower(text), r"\s")
    )
    return df.withColumn(output, words)


def remove_stopwords(df: DataFrame, column: str, output: str, words: list[str] | None = None) -> DataFrame:
    """Drop stop words (Spark ML's English list by default), whatever their case."""
    stop = words if words is not None else StopWordsRemover.loadDefaultStopWords("english")
    lowered = sorted({w.lower() for w in stop})
    return df.withColumn(output, F.filter(column, lambda word: ~F.lower(word).isin(lowered)))


def term_counts(df: DataFrame, column: str) -> DataFrame:
    """``term`` and its number of occurrences ``n`` over all rows, without a vocabulary limit."""
    return (
        df.select(F.explode(column).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )


def counted_terms(words: str | Column) -> Column:
    """The different words of an array in text order with their counts: an array of ``term`` and ``n``.

    Counting stays within the row: the words are sorted, and a run's count is the distance to the next run's
    start, in time linear in the number of words but for the sort. NULL words are not counted, and NULL has none.
    """

    def counted(of_row: Column) -> Column:
        first = F.when(F.size(of_row) > 0, F.sequence(F.lit(0), F.size(of_row) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(first, lambda i: (i == 0) | (F.get(of_row, i) != F.get(of_row, i - 1)))
        ends = lambda at: F.concat(F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), F.array(F.size(of_row)))
        run = lambda start, end: F.struct(F.get(of_row, start).alias("term"), (end - start).cast("bigint").alias("n"))
        # An array of one element binds a value to a name, so that it is computed once a row.
        pairs = F.transform(F.array(starts), lambda at: F.zip_with(at, ends(at), run))
        return F.filter(F.get(pairs, F.lit(0)), lambda pair: pair["term"].isNotNull())

    column = F.col(words) if isinstance(words, str) else words
    return F.get(F.transform(F.array(F.sort_array(F.array_compact(column))), counted), F.lit(0))


def _counted(df: DataFrame, column: str) -> Column:
    """Counted terms of a column of words, or the column itself if it holds them already."""
    element = df.schema[column].dataType.elementType
    return F.col(column) if isinstance(element, T.StructType) else counted_terms(column)


def fit_vocabulary(
    df: DataFrame, column: str, vocab_size: int | None = None, min_df: float = 1.0
) -> DataFrame:
    """``term``, its occurrences ``n``, the rows ``df`` that have it, and its ``slot``: most frequent
    first, ties in text order, from 0. All terms, unless the caller sets one of the limits.

    ``column`` holds words, or what :func:`counted_terms` makes of them. ``min_df`` is the number of rows a
    term must occur in, or, under 1, their share; ``vocab_size`` keeps the first so many. One grouping by
    term; the vocabulary never leaves the cluster. Runs jobs, as the ranked terms are saved.
    """
    counts = (
        df.select(F.explode(_counted(df, column)).alias("t"))
        .groupBy("t.term")
        .agg(F.sum("t.n").alias("n"), F.count(F.lit(1)).alias("df"))
    )
    if min_df > 1:
        counts = counts.where(F.col("df") >= min_df)
    elif min_df < 1:
        counts = counts.where(F.col("df") >= min_df * df.count())
    ranked = ranks(counts, "slot", F.desc("n"), F.asc("term"))
    return ranked if vocab_size is None else ranked.where(F.col("slot") < vocab_size)


def _head(vocabulary: DataFrame, size: int, most_bytes: int) -> int:
    """How many of the first slots may be broadcast: a quarter less and less until they are small enough."""
    head = min(size, max(1, most_bytes // 64))
    while head and measured_bytes(vocabulary.where(F.col("slot") < head).select("term", "slot")) > most_bytes:
        head //= 4
    return head


def _head_entries(first: Broadcast[pa.Array]) -> Callable[[Column], Column]:
    """From counted terms, those among the first ones as ``indices`` (their places there, rising) and ``values``, and
    the ``rest``. Arrow batches; a row's terms stay together."""

    @F.arrow_udf("struct<indices:array<int>,values:array<double>,rest:array<struct<term:string,n:bigint>>>")
    def split(lists: pa.Array) -> pa.Array:
        pairs = lists.flatten()
        term, n = pairs.field("term"), pairs.field("n")
        found = pc.index_in(term, value_set=first.value.cast(term.type))
        row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        known = found.is_valid().to_numpy(zero_copy_only=False)
        ends = lambda rows: pa.array(np.searchsorted(rows, np.arange(len(lists) + 1)), pa.int32())
        slot, here, size = found.drop_null().to_numpy(), row[known], max(1, len(first.value))
        order = np.argsort(here * size + slot)
        indices = pa.ListArray.from_arrays(ends(here), pa.array(slot[order], pa.int32()))
        values = pa.ListArray.from_arrays(ends(here), pa.array(n.filter(pa.array(known)).to_numpy()[order].astype(np.float64)))
        rest = pa.StructArray.from_arrays([c.filter(pa.array(~known)) for c in (term, n)], ["term", "n"])
        return pa.StructArray.from_arrays([indices, values, pa.ListArray.from_arrays(ends(row[~known]), rest)], ["indices", "values", "rest"])

    return split


def term_vectors(
    df: DataFrame,
    column: str,
    output: str,
    vocabulary: DataFrame,
    row_id: str | None = None,
    keep_words: bool = True,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Add sparse count vectors over a :func:`fit_vocabulary`; other terms are not counted.

    ``column`` holds words, or what :func:`counted_terms` makes of them. Terms are counted within their row.
    The first slots, which most words fall on, are measured and broadcast, as many as ``broadcast_bytes``
    hold, and found without leaving the row; only rarer terms are shuffled to their slots, so no frequent term is a
    hot key. Their entries then go to their row, without the words if these are not kept. A row without a term of the vocabulary, or with NULL
    for words, has a vector without entries.

    Rows are numbered and saved first, unless ``row_id`` names a column that tells them apart in a frame that
    reads the same every time. The vectors are saved in the form in which Spark stores them; slots left at 0
    broadcast bytes are all shuffled.
    """
    spark = df.sparkSession
    with stages(spark) as run:
        row, terms = row_id or "_row", "_counted"
        numbered = df if row_id else df.withColumn(row, F.monotonically_increasing_id())
        numbered = numbered.withColumn(terms, _counted(df, column))
        rows = numbered if row_id else materialise(numbered if keep_words else numbered.drop(column), "counted")
        size = vocabulary.agg(F.coalesce(F.max("slot") + 1, F.lit(0)).cast("int").alias("n")).first()["n"]
        head = _head(vocabulary, size, broadcast_bytes)
        slots = vocabulary.select(F.col("term").alias("_term"), F.col("slot").cast("int").alias("_slot"))
        first = slots.where(F.col("_slot") < head).orderBy("_slot").select("_term").toArrow().column(0).combine_chunks()
        split = _head_entries(spark.sparkContext.broadcast(first))
        wanted = [c for c in df.columns if c != output and (keep_words or c != column)]
        joined = rows.select(*{row: 0, **dict.fromkeys(wanted)}, split(F.col(terms)).alias("_first"))
        indices, values = F.col("_first.indices"), F.col("_first.values")
        if head < size:
            joined = materialise(joined, "split")
            each = joined.select(F.col(row).alias("_of"), F.inline("_first.rest").alias("_term", "_n"))
            found = each.join(slots.where(F.col("_slot") >= head), "_term")
            entries = found.groupBy("_of").agg(F.sort_array(F.collect_list(F.struct("_slot", "_n"))).alias("_e"))
            joined = joined.join(entries, F.col(row) == F.col("_of"), "left")
            indices = F.concat(indices, F.coalesce(F.col("_e._slot"), F.array().cast("array<int>")))
            values = F.concat(values, F.coalesce(F.col("_e._n").cast("array<double>"), F.array().cast("array<double>")))
        vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
        path = scratch_dir(spark, "vectors")
        with shuffles_dropped(spark):
            joined.select(*wanted, vector.alias(output)).write.parquet(path)
        kept = [field for field in df.schema.fields if field.name in wanted]
        return run.keep_path(path, T.StructType([*kept, T.StructField(output, VectorUDT())]))


def vector_entries(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Non-zero entries of a sparse vector column as rows: ``keep`` columns, ``slot``, ``entry``."""
    inner = F.unwrap_udt(F.col(column))
    pairs = F.arrays_zip(inner.getField("indices").alias("slot"), inner.getField("values").alias("entry"))
    return df.select(*keep, F.inline(pairs).alias("slot", "entry"))


def fit_topics(
    df: DataFrame,
    column: str,
    k: int = 5,
    iterations: int = 10,
    seed: int = 42,
    sampling: float = 0.05,
    **params: Any,
) -> LDAModel:
    """Topic model over count vectors. Every iteration reads ``df`` again: materialise it first.

    ``sampling`` is the share of rows an iteration learns from, by default Spark's; with 1.0 every text
    takes part in every iteration. The model is a matrix of 8 bytes per topic and term, which the driver
    and every task hold: ten million terms and five topics make 400 MB.
    """
    return LDA(k=k, maxIter=iterations, featuresCol=column, seed=seed, subsamplingRate=sampling, **params).fit(df)


def topic_mixture(df: DataFrame, model: LDAModel, output: str = "topicDistribution") -> DataFrame:
    """Add each row's share of every topic."""
    return model.setTopicDistributionCol(output).transform(df)
