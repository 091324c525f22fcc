"""Importance resampling towards a target: hashed n-gram weights plus Gumbel noise, highest scores drawn.

A 256-byte table lower-cases A-Z and blanks separators in UTF-8, ``bytes.split`` yields the words, and
``zlib.crc32`` chained from one word to the next gives the checksum of every run of words without
joining them. Counters over buckets are summed up by task and over all tasks; the driver holds one
number per bucket. With Gumbel noise on the weights, the highest scores are a draw without
replacement in proportion to the likelihood ratio of target and corpus.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, hold, id_and_text, materialise, schema_of
from marquee.operators.ranks import ranks

BUCKETS = 10_000
#: Runs of up to so many words are features.
ORDERS = 3
SEED = 42
#: Texts are split into words so many bytes at a time.
BLOCK_BYTES = 1 << 20

#: Digits, letters in lower case and all bytes of other characters; everything else separates words.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WEIGHED = "doc_id long, n_words long, n_features long, weight long, score long"


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, those of some bytes at a time."""
    clean, at = text.translate(TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + BLOCK_BYTES)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def feature_sums(text: bytes) -> Iterator[tuple[int, list[int]]]:
    """For each block of a text its number of words and the CRC-32 of the runs of words that end in it."""
    before: list[bytes] = []
    for block in word_blocks(text):
        every = before + block
        sums = list(map(crc32, every))
        found = sums[len(before) :]
        spaced = [b" " + word for word in every]
        for order in range(1, ORDERS):
            # From runs of one length to those one word longer: the next word goes on from the run's checksum.
            sums = list(map(crc32, spaced[order:], sums))
            found += sums[max(0, len(before) - order) :]
        yield len(block), found
        before = every[max(0, len(every) - ORDERS + 1) :]


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all texts in each bucket; a null text has none. The driver gets ``buckets`` rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("importance", int)  # nothing of its own, but others must let go
        total: Counter[int] = Counter()
        for batch in batches:
            for text in byte_rows(batch.column("text")):
                for _, sums in feature_sums(text):
                    total.update((np.array(sums, np.uint32) % buckets).tolist())
        yield pa.record_batch([list(total), list(total.values())], schema=schema_of("bucket int, n long"))

    found = np.zeros(buckets, np.int64)
    summed = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(rows, "bucket int, n long")
    for bucket, n in summed.groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the log-ratio of smoothed shares, rounded down."""
    size = len(corpus)
    s_all, t_all = float(int(corpus.sum()) + size), float(int(target.sum()) + size)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document, 1000 times and rounded down; a null id counts as empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, by_bucket: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("importance", int)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_rows(batch.column("text"))):
                n_words = n_features = weight = 0
                for n, sums in feature_sums(text):
                    n_words, n_features = n_words + n, n_features + len(sums)
                    weight += int(by_bucket[np.array(sums, np.uint32) % len(by_bucket)].sum())
                out.append((doc_id, n_words, n_features, weight, weight + noise(doc_id, seed)))
            if out:
                yield pa.record_batch(list(map(list, zip(*out))), schema=schema_of(WEIGHED))

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, WEIGHED)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn, the
    highest scores first and of equal scores the smaller id (null ids last); ``rank`` counts them from 1 and is
    null for the others. A null or empty text has no features, weight 0 and is never drawn while ``least_words``
    is above 0. Rows that repeat an id or a text are documents of their own; rows with one id have equal noise.
    Empty tables give an empty result, an empty target equal smoothed shares.
    """
    by_bucket = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    weighed = materialise(weigh(docs, by_bucket, id_col, text_col, seed), "weighed")
    able = F.col("n_words") >= least_words
    drawn = weighed.where(able).count() * percent // 100
    placed = ranks(weighed.withColumn("_able", able), "_place", F.desc("_able"), F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.when(F.col("_able") & (F.col("_place") < drawn), F.col("_place") + 1)
    return placed.select(*weighed.columns, rank.cast("long").alias("rank"))
