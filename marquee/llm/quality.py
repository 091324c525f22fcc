"""Quality rules: plain measures of a text, then a hashed n-gram likelihood ratio.

Two multinomials over hashed word one- and two-grams are counted: one from trusted documents, one
from the whole corpus. A document's score is the mean log ratio of its n-grams, so length does
not matter. Every bucket starts from ``PRIOR`` n-grams that are trusted as often as all are, so
rare ones say little. The number of buckets grows with the corpus, as its vocabulary does. The
threshold is the same for every document. It is set on labelled documents outside the trusted
half, all of them, which score as documents without a label do. Both multinomials are counted over
all their documents. What a task hands on
is the counts of 1024 neighbouring buckets in a row of packed bytes, about one for each bucket once
compressed. The sums are a saved table that workers read, so they never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, hold, id_and_text, materialise, schema_of, scratch_dir, words
from marquee.llm.files import read_columns

#: Buckets of a corpus: this factor times its bytes to this power, rounded up to a power of two. A worker holds eight
#: bytes a bucket while it counts and four while it scores: 2 ** 22 buckets for 30 GB, 2 ** 26 for 100 TB.
BUCKET_FACTOR, BUCKET_POWER, LEAST_BITS = 160, 0.4, 8
PRIOR = 10.0
#: Labels up to this number (16 bytes each) are broadcast; more meet the documents in a shuffled join.
MOST_BROADCAST = 2_000_000
#: A trusted document lost weighs as much as this many poor ones kept.
LOSS_WEIGHT = 5.0
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
HELD_WORDS = 200_000
STEPS, FARTHEST = 1000, 30
#: Buckets whose counts travel as one row, and rows that a task hands on at once.
PIECE, OUT_ROWS = 1 << 10, 4096

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
VERDICTS = f"doc_id long, {MEASURES}, base_failed boolean, score double, kept boolean"
COUNTS = "bucket int, corpus long, trusted long"
PIECES = "piece int, corpus binary, trusted binary"
STEP_ROWS = "step int, trusted int"

_HASHES: dict[bytes, int] = {}
#: The weights of the model that this worker used last, by the folder of its counts.
_WEIGHTS: dict[str, np.ndarray] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes; a worker remembers those of frequent words."""
    if len(_HASHES) > HELD_WORDS:
        _HASHES.clear()
    hashes = list(map(_HASHES.get, found))
    if None in hashes:
        for at, value in enumerate(hashes):
            if value is None:
                hashes[at] = _HASHES[found[at]] = xxhash.xxh64_intdigest(found[at])
    return np.array(hashes, np.uint64)


def bucket_bits(n_bytes: int) -> int:
    """Binary logarithm of the number of buckets for texts of so many bytes."""
    return max(LEAST_BITS, ceil(log2(BUCKET_FACTOR * max(n_bytes, 1) ** BUCKET_POWER)))


def gram_buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of all words and all pairs of neighbours."""
    grams = np.concatenate([hashes, hashes[:-1] * np.uint64(31) + hashes[1:]])
    return ((grams * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def packed(counts: np.ndarray) -> bytes:
    """Counts under 2^32, all lowest bytes first: the others are mostly zero, so they compress to little; none if all are zero."""
    return np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() if counts.any() else b""


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows that come in order of their piece, a row per bucket seen."""
    held, sums = None, None

    def done() -> pa.RecordBatch:
        seen = np.flatnonzero(sums[0])
        return pa.record_batch([(held * PIECE + seen).astype(np.int32), sums[0][seen], sums[1][seen]], schema=schema_of(COUNTS))

    for batch in batches:
        for piece, *parts in zip(*(batch.column(c).to_pylist() for c in ("piece", "corpus", "trusted"))):
            if piece != held:
                if held is not None:
                    yield done()
                held, sums = piece, np.zeros((2, PIECE), np.int64)
            for of, data in zip(sums, parts):
                if data:
                    found = unpacked(data)
                    of[: len(found)] += found
    if held is not None:
        yield done()


def _forget() -> None:
    _HASHES.clear()
    _WEIGHTS.clear()


def repeated_words(hashes: np.ndarray) -> int:
    """Words in a window of five that the text holds twice or more, its first place included."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    code = hashes[:n].copy()
    for k in range(1, WINDOW):
        code = (code ^ (code >> np.uint64(29))) * _MIX + hashes[k : n + k]
    _, group, sizes = np.unique(code, return_inverse=True, return_counts=True)
    if len(sizes) == n:
        return 0
    edges = np.zeros(n + WINDOW, np.int64)
    starts = np.flatnonzero(sizes[group] > 1)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measures(text: bytes, found: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(found),
        len(b"".join(found).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
    )


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass(frozen=True)
class QualityModel:
    """Where the counts of both multinomials are saved, and the score from which documents are kept.

    Without trusted documents there are no counts and every score is zero.
    """

    counts: str | None
    bits: int
    usual: float
    threshold: float

    @property
    def weights(self) -> np.ndarray:
        """Log ratio of each bucket; read once by a worker."""
        if self.counts not in _WEIGHTS:
            _WEIGHTS.clear()
            corpus, good = np.zeros(1 << self.bits, np.float32), np.zeros(1 << self.bits, np.float32)
            for bucket, all_of, trusted in read_columns(self.counts, ["bucket", "corpus", "trusted"]):
                corpus[bucket], good[bucket] = all_of, trusted
            good += np.float32(PRIOR * self.usual)
            corpus += np.float32(PRIOR)
            good /= corpus
            good /= np.float32(self.usual)
            _WEIGHTS[self.counts] = np.log(good, out=good)
        return _WEIGHTS[self.counts]

    def score(self, hashes: np.ndarray) -> float:
        """Zero for a text without words."""
        if not len(hashes) or self.counts is None:
            return 0.0
        return float(self.weights[gram_buckets(hashes, self.bits)].mean(dtype=np.float64))


def labelled(labels: DataFrame) -> DataFrame:
    """``label_id``, ``trusted`` (1: quality 1 and not toxic; 0: quality 0) and ``half``.

    A document with several labels is trusted if all of them say so. Toxic ones of good quality and those
    without a quality are neither.
    """
    trusted = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when(F.col("quality") == 0, 0)
    rows = labels.select(F.col("doc_id").cast("long").alias("label_id"), trusted.alias("trusted"))
    rows = rows.where(F.col("label_id").isNotNull() & F.col("trusted").isNotNull())
    rows = rows.groupBy("label_id").agg(F.min("trusted").alias("trusted"))
    rows = rows.withColumn("half", F.pmod(F.xxhash64(F.lit(2), "label_id"), F.lit(2)).cast("int"))
    return materialise(rows, "labels")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = MOST_BROADCAST) -> QualityModel:
    """Count both multinomials over all documents and set the threshold on the labelled ones.

    Without trusted or without poor labels there is nothing to tell apart and every document passes. All labels
    outside the trusted half set the threshold: their scores are counted by step, so few rows leave the tasks.
    """
    spark = docs.sparkSession
    known = labelled(labels)
    texts = id_and_text(docs, id_col, text_col)
    bits = bucket_bits(texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    source = known.where((F.col("trusted") == 1) & (F.col("half") == 0)).select("label_id", F.lit(1).alias("trusted"))
    sent = lambda rows: F.broadcast(rows) if rows.count() <= most_broadcast else rows.hint("merge")
    rows = texts.join(sent(source), F.col("doc_id") == F.col("label_id"), "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", _forget)
        corpus, good = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        for batch in batches:
            for text, trusted in zip(byte_rows(batch.column("text")), batch.column("trusted").to_pylist()):
                grams = gram_buckets(word_hashes(words(text)), bits)
                np.add.at(corpus, grams, 1)
                if trusted:
                    np.add.at(good, grams, 1)
        out = []
        for at in range(0, 1 << bits, PIECE):
            if corpus[at : at + PIECE].any():
                out.append((at // PIECE, packed(corpus[at : at + PIECE]), packed(good[at : at + PIECE])))
            if len(out) == OUT_ROWS or (out and at + PIECE >= 1 << bits):
                yield pa.record_batch(list(map(list, zip(*out))), schema=schema_of(PIECES))
                out = []

    counted = rows.select("text", "trusted").mapInArrow(count, PIECES).repartition("piece").sortWithinPartitions("piece")
    path = scratch_dir(spark, "counts")
    counted.mapInArrow(add_pieces, COUNTS).write.parquet(path)
    n_corpus, n_good = spark.read.schema(COUNTS).parquet(path).agg(F.sum("corpus"), F.sum("trusted")).first()
    if not n_good:
        return QualityModel(None, bits, 0.0, float("-inf"))
    draft = QualityModel(path, bits, n_good / n_corpus, float("-inf"))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", _forget)
        for batch in batches:
            found = [round(draft.score(word_hashes(words(t))) * STEPS) for t in byte_rows(batch.column("text"))]
            yield pa.record_batch([np.clip(found, -FARTHEST * STEPS, FARTHEST * STEPS), batch.column("trusted")], schema=schema_of(STEP_ROWS))

    held_out = known.where((F.col("trusted") == 0) | (F.col("half") == 1))
    only = texts.join(sent(held_out), F.col("doc_id") == F.col("label_id"))
    steps = only.select("text", F.col("trusted").cast("int").alias("trusted")).mapInArrow(scores, STEP_ROWS)
    found = steps.groupBy("step", "trusted").count().collect()  # two rows a step at most
    return QualityModel(path, bits, draft.usual, threshold([tuple(x) for x in found]))


def threshold(found: list[tuple[int, int, int]]) -> float:
    """The lowest score step at which few trusted documents fall under it and few poor ones do not."""
    good, poor = ({s: n for s, t, n in found if t == kind} for kind in (1, 0))
    if not good or not poor:
        return float("-inf")
    lost, caught, best, least = 0, 0, float("-inf"), 1.0
    for step in sorted({*good, *poor}):
        cost = LOSS_WEIGHT * lost / sum(good.values()) + 1 - caught / sum(poor.values())
        if cost < least:
            least, best = cost, (step - 0.5) / STEPS
        lost, caught = lost + good.get(step, 0), caught + poor.get(step, 0)
    return best


def judge(text: bytes, model: QualityModel) -> tuple:
    found = words(text)
    hashes = word_hashes(found)
    base = measures(text, found, hashes)
    failed = base_fails(base[0], base[4])
    score = model.score(hashes)
    return (*base, failed, score, not failed and score >= model.threshold)


def verdicts(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its measures, ``base_failed``, ``score`` and ``kept``.

    A null text has no words and fails. Ties with the threshold are kept. Equal texts get equal verdicts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", _forget)
        for batch in batches:
            if batch.num_rows:
                found = [judge(text, model) for text in byte_rows(batch.column("text"))]
                yield pa.record_batch([batch.column("doc_id"), *map(list, zip(*found))], schema=schema_of(VERDICTS))

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, VERDICTS)


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", _forget)
        for batch in batches:
            kept = [judge(text, model)[-1] for text in byte_rows(batch.column(text_col))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
