"""Topic model whose statistics are tables, for any number of terms and texts.

Texts and terms are dealt to blocks. The entries of a block of texts that fall on a block of terms are
one row of packed arrays, a slab, saved once with the list of its different terms. The slabs are dealt once and stay on
the executors' disks; an iteration brings to those of a block of texts the counts of just their terms, splits every
entry over the topics in proportion to the counts of its text and its term, and sends the sums for these terms to their
blocks, which add them up and answer. Terms of one block of texts only, most of a vocabulary, stay with it. So
what an iteration moves grows with the different terms of the blocks, not with blocks of texts times blocks of terms;
neither driver nor task ever holds more than one block of each. This is expectation maximisation for the topic
mixture with Dirichlet smoothing, so the penalised likelihood never falls.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import materialise, stages

#: Least terms of a block, number of blocks beyond which they hold more terms instead, and most terms of one.
TERM_BLOCK, TERM_BLOCKS, MOST_TERMS = 1 << 16, 512, 1 << 21
#: Most texts of a block, and most entries for five topics; few texts are dealt to up to so many blocks of a few. The larger
#: a block, the fewer terms it shares with others for each of its entries.
TEXT_BLOCK, ENTRY_BLOCK, LEAST_BLOCKS, FEW_TEXTS = 1 << 16, 6 << 20, 24, 256
#: Up to so many blocks have a partition each, unless the session's shuffles have more.
MOST_PARTITIONS = 2000
#: Rows of packed arrays that go to Python at once: more where a block has many slabs, as these are smaller then.
BATCH_ROWS, MOST_BATCH_ROWS = 4, 32
#: Entries that are split at a time, so that their numbers stay in a core's cache.
CHUNK = 1 << 15

_SLAB = "block int, part int, size int, d binary, u binary, w binary, n binary"
_SHARED_SLAB = _SLAB + ", shared int"
_ROW = "turn int, kind int, block int, part int, w binary, m binary, stats array<double>"
#: Rows with the counts of a block's texts, of its shared terms in a block of terms, of its own terms there. ``_STATS`` has
#: sums for the driver, ``_COUNTS`` all counts of a block of terms.
_TEXTS, _SHARED, _OWN, _STATS, _COUNTS = range(5)
#: Packed doubles do not get smaller, and no two rows are alike.
_NUMBERS = {"compression": "none", "parquet.enable.dictionary": "false"}
#: The order in which a block of terms needs its rows: sums, what it only hands on, and the terms that are asked for.
_SUM, _PASS, _ASK = range(3)


@dataclass(frozen=True)
class TopicTable:
    """A fitted model: ``counts`` has a row per block of terms with the packed counts of term and topic."""

    counts: DataFrame
    totals: tuple[float, ...]
    terms: int
    parts: int
    alpha: float
    eta: float
    #: Log-likelihood of the entries, and with the smoothing's part, before each iteration.
    likelihoods: tuple[float, ...]
    penalised: tuple[float, ...]

    @property
    def k(self) -> int:
        return len(self.totals)

    def keep(self, run) -> TopicTable:
        """The model with its counts handed over by a run, see :func:`marquee.session.stages`."""
        return TopicTable(run.keep(self.counts), self.totals, self.terms, self.parts, self.alpha, self.eta, self.likelihoods, self.penalised)


@contextmanager
def _small_batches(spark: SparkSession, parts: int) -> Iterator[None]:
    """Rows are up to megabytes here: only a few may stand in a batch between the JVM and Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(MOST_BATCH_ROWS, max(BATCH_ROWS, parts))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _parts(terms: int, term_block: int | None) -> int:
    return max(1, -(-terms // (term_block or min(MOST_TERMS, max(TERM_BLOCK, -(-terms // TERM_BLOCKS))))))


def _whole(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as all of them fit."""
    top = int(numbers.max(initial=0))
    return numbers.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int32).tobytes()


def _numbers(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.int32}[len(data) // size])


def _term_type(per_part: int) -> type:
    return np.uint16 if per_part <= 1 << 16 else np.int32


def _counts(numbers: np.ndarray) -> bytes:
    """Counts of words in a byte or two each; others, or larger ones, as single floats."""
    small = len(numbers) and 0 <= numbers.min() and numbers.max() < 1 << 16 and (numbers == np.floor(numbers)).all()
    return _whole(numbers) if small else numbers.astype(np.float32).tobytes()


def _read_counts(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.float32}[len(data) // size]).astype(np.float64)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=names)


def _slabs(vectors: DataFrame, column: str, row_id: str, k: int, parts: int, kind: type) -> tuple[DataFrame, int]:
    """Packed entries by block of texts and of terms, saved, and the number of blocks: steps from text to text, places in the
    list of terms, terms, and counts, by text. Under part -1 the ids of the block's ``size`` texts, in order."""
    inner = F.unwrap_udt(F.col(column))
    values = inner.getField("values")
    places = F.coalesce(inner.getField("indices"), F.sequence(F.lit(0), F.size(values) - 1))
    rows = vectors.where(F.col(column).isNotNull()).select(F.col(row_id).cast("long").alias("row"), places.alias("places"), values.alias("values"))
    rows = rows.where(F.size("values") > 0)
    sizes = rows.agg(F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum(F.size("values")), F.lit(0)).alias("entries")).first()
    blocks = max(1, -(-sizes.texts // TEXT_BLOCK), -(-sizes.entries * k // (5 * ENTRY_BLOCK)), min(LEAST_BLOCKS, sizes.texts // FEW_TEXTS))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    if blocks <= MOST_PARTITIONS:
        # Numbered so that each has a partition of its own; more blocks are dealt evenly enough by their hashes.
        numbers = vectors.sparkSession.range(32 * blocks).select(F.col("id").cast("int").alias("block"))
        numbers = numbers.groupBy(F.pmod(F.hash("block"), F.lit(blocks)).alias("lane")).agg(F.min("block").alias("block"))
        lanes = {r.lane: r.block for r in numbers.collect()}
        block = F.get(F.array(*[F.lit(lanes.get(lane, 32 * blocks + lane)) for lane in range(blocks)]), block)
    rows = rows.withColumn("block", block)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        block, lists = table.column("block")[0].as_py(), table.column("places").combine_chunks()
        places = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        counts = table.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
        d = np.repeat(np.arange(table.num_rows, dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
        part = (places % parts).astype(np.uint16 if parts < 1 << 16 else np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        out = [(block, -1, table.num_rows, table.column("row").to_numpy().astype("<i8").tobytes(), b"", b"", b"")]
        for at in range(parts):
            mine = order[cuts[at] : cuts[at + 1]]
            if len(mine):
                terms, place = np.unique(places[mine] // parts, return_inverse=True)
                out.append((block, at, len(mine), _whole(np.diff(d[mine], prepend=0)), _whole(place), terms.astype(kind).tobytes(), _counts(counts[mine])))
        return _table(out, _SLAB)

    return materialise(_by_block(rows, blocks).groupBy("block").applyInArrow(pack, _SLAB), "slabs"), blocks


def _matrix(data: bytes, k: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, k)


def _in_order(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _partitions(rows: DataFrame, blocks: int) -> int:
    return min(blocks, max(MOST_PARTITIONS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _by_block(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.repartition(_partitions(rows, blocks), "block")


def _dealt(rows: DataFrame, parts: int, *then: str) -> DataFrame:
    return rows.repartition(_partitions(rows, parts), "part").sortWithinPartitions("part", *then)


def _mark_shared(slabs: DataFrame, parts: int, per_part: int, blocks: int) -> DataFrame:
    """The slabs with their terms in a new order: first the ``shared`` ones, which other blocks of texts have too. Saved."""
    kind = _term_type(per_part)
    lists = slabs.where("part >= 0").select("block", "part", "w")
    twice = lists.withColumn("again", F.lit(0)).unionByName(lists.withColumn("again", F.lit(1)))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = None, None
        for block, part, w, again in _in_order(batches, "block", "part", "w", "again"):
            if part != held:
                held, found = part, np.zeros(per_part, np.int32)
            terms = np.frombuffer(w, kind)
            if again:
                yield from _table([(block, part, np.packbits(found[terms] > 1).tobytes())], "block int, part int, others binary").to_batches()
            else:
                found[terms] += 1

    def sort(mine: pa.Table, marks: pa.Table) -> pa.Table:
        bits, out = dict(zip(marks.column("part").to_pylist(), marks.column("others").to_pylist())), []
        for block, part, size, d, u, w, n in zip(*(mine.column(c).to_pylist() for c in mine.column_names)):
            if part < 0:
                out.append((block, part, size, d, u, w, n, 0))
                continue
            terms = np.frombuffer(w, kind)
            others = np.unpackbits(np.frombuffer(bits[part], np.uint8), count=len(terms)).astype(bool)
            order = np.argsort(~others, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            out.append((block, part, size, d, _whole(rank[_numbers(u, size)]), terms[order].tobytes(), n, int(others.sum())))
        return _table(out, _SHARED_SLAB)

    marked = _dealt(twice, parts, "again", "block").mapInArrow(mark, "block int, part int, others binary")
    found = _by_block(slabs, blocks).groupBy("block").cogroup(_by_block(marked, blocks).groupBy("block")).applyInArrow(sort, _SHARED_SLAB)
    return materialise(found, "slabs")


def _stats(*frames: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the blocks' rows of a few numbers each, whatever their order; rows of blocks of texts have more numbers."""
    rows = [r.stats for frame in frames for r in frame.where(F.col("kind") == _STATS).select("stats").collect()]
    return tuple(np.array([fsum(column) for column in zip([0.0] * size, *(r for r in rows if len(r) == size))]) for size in (3 + k, 1 + k))


def _split(steps: np.ndarray, u: np.ndarray, n: np.ndarray, theta: np.ndarray, chances: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums by topic and term of entries that are split over the topics, and their log-likelihood. ``steps`` lead from text to
    text. ``theta`` and ``chances`` have a row per text and term; the sums by text are added to ``new``."""
    k, last, sums, likelihood = theta.shape[1], 0, np.zeros(chances.shape[::-1]), 0.0
    for at in range(0, len(steps), CHUNK):
        moves, terms, counts = steps[at : at + CHUNK], u[at : at + CHUNK].astype(np.intp), n[at : at + CHUNK]
        moved = moves != 0
        moved[0] = True
        which = np.cumsum(moves[moved], dtype=np.int64) + last
        last, local = which[-1], np.cumsum(moved) - 1
        of_text = theta[which]
        by_text, by_term = of_text.take(local, axis=0), chances.take(terms, axis=0)
        whole = np.einsum("ij,ij->i", by_text, by_term)
        likelihood += float(counts @ np.log(whole))
        part = counts / whole
        for j in range(k):
            new[which, j] += of_text[:, j] * np.bincount(local, by_term[:, j] * part)
            sums[j] += np.bincount(terms, by_text[:, j] * part, minlength=len(chances))
    return sums.T * chances, likelihood


def fit_topic_table(
    vectors: DataFrame,
    column: str,
    terms: int,
    row_id: str,
    k: int = 5,
    iterations: int = 10,
    seed: int = 42,
    alpha: float | None = None,
    eta: float | None = None,
    term_block: int | None = None,
) -> TopicTable:
    """Fit ``k`` topics to count vectors over ``terms`` slots; every text takes part in every iteration.

    ``row_id`` is a whole number that tells the rows apart. ``alpha`` and ``eta`` smooth the topics of a text and
    the terms of a topic, both 1/k by default. Texts start with random shares that follow from ``seed`` and their
    id, and sums are taken in a fixed order, so a fit repeats for the same saved vectors. Rows without entries
    take no part. The counts are saved; earlier iterations are deleted.
    """
    spark = vectors.sparkSession
    alpha, eta = alpha or 1 / k, eta or 1 / k
    parts = _parts(terms, term_block)
    per_part = -(-terms // parts)
    term_type, none = _term_type(per_part), np.zeros((0, k))

    def log_counts(m: np.ndarray) -> float:
        """The logarithms of smoothed counts, less what a count of zero has."""
        return float(np.log(m / eta + 1).sum())

    def split(first: bool, last: bool, totals: np.ndarray):
        """Entries over topics. Statistics: likelihood, the texts' prior, the own terms' logarithms and totals."""

        def rows(slabs: pa.Table, counts: pa.Table) -> pa.Table:
            given = {}
            for kind, part, m in zip(*(counts.column(c).to_pylist() for c in ("kind", "part", "m"))):
                given[kind, -1 if kind == _TEXTS else part] = _matrix(m, k)
            mine = {r[1]: r for r in zip(*(slabs.column(c).to_pylist() for c in ("block", "part", "size", "d", "u", "w", "n", "shared")))}
            block, _, size, *_ = mine.pop(-1)
            stats, new, out, width = np.zeros(3 + k), np.zeros((size, k)), [], np.dtype(term_type).itemsize
            if first:
                theta = np.random.default_rng([seed, block]).dirichlet(np.ones(k), size)
            else:
                texts = given[_TEXTS, -1]
                theta = (texts + alpha) / (texts.sum(1, keepdims=True) + k * alpha)
                stats[1] = alpha * np.log(theta).sum()
            for _, part, size, d, u, w, n, shared in (mine[at] for at in sorted(mine)):
                if first:
                    chances = np.ones((len(w) // width, k))
                else:
                    known = np.vstack([given.pop((_SHARED, part), none), given.pop((_OWN, part), none)])
                    chances = (known + eta) / (totals + terms * eta)
                sums, likelihood = _split(_numbers(d, size), _numbers(u, size), _read_counts(n, size), theta, chances, new)
                stats[0] += 0 if first else likelihood
                stats[2] += log_counts(sums[shared:])
                stats[3:] += sums[shared:].sum(0)
                if shared:
                    out.append((_SUM, _SHARED, block, part, w[: width * shared], sums[:shared].tobytes(), None))
                if shared and not last:
                    out.append((_ASK, _SHARED, block, part, w[: width * shared], None, None))
                if shared < len(sums):
                    out.append((_PASS, _OWN, block, part, w[width * shared :] if last else None, sums[shared:].tobytes(), None))
            if not last:
                out.append((_PASS, _TEXTS, block, block % parts, None, new.tobytes(), None))
            out.append((_PASS, _STATS, block, block % parts, None, None, stats.tolist()))
            return _table(out, _ROW)

        return rows

    def add(last: bool):
        """Sums of a block of terms, then the answers to all who asked, or at last all counts. Statistics: the shared terms'
        logarithms and totals."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, matrix, told = None, none, False

            def done() -> list[tuple]:
                return [(None, _COUNTS, -1, held, None, matrix.tobytes(), None)] if last and held is not None else []

            def row(*values) -> Iterator[pa.RecordBatch]:
                return _table([values], _ROW).to_batches()

            for turn, kind, block, part, w, m, stats in _in_order(batches, "turn", "kind", "block", "part", "w", "m", "stats"):
                if part != held:
                    for values in done():
                        yield from row(*values)
                    held, matrix, told = part, np.zeros((per_part, k)), False
                if turn == _SUM:
                    matrix[np.frombuffer(w, term_type)] += _matrix(m, k)
                    continue
                if not told:
                    told = True
                    yield from row(None, _STATS, -1, part, None, None, [log_counts(matrix), *matrix.sum(0).tolist()])
                if turn == _ASK:
                    yield from row(None, _SHARED, block, part, None, matrix[np.frombuffer(w, term_type)].tobytes(), None)
                elif last and kind == _OWN:
                    matrix[np.frombuffer(w, term_type)] += _matrix(m, k)
                else:
                    yield from row(None, kind, block, part, None, m, stats)
            for values in done():
                yield from row(*values)

        return rows

    with stages(spark) as run:
        slabs, blocks = _slabs(vectors, column, row_id, k, parts, term_type)
        with _small_batches(spark, parts):
            marked = _mark_shared(slabs, parts, per_part, blocks)
            run.release(slabs)
            entries = _by_block(marked, blocks).sortWithinPartitions("block").persist(StorageLevel.DISK_ONLY)
            try:
                state = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in _ROW.split(", "))])
                totals, log_sum, likelihoods, penalised = np.zeros(k), 0.0, [], []
                for number in range(iterations + 1):
                    last = number == iterations
                    given = state.where(F.col("kind") != _STATS).select("kind", "block", "part", "m")
                    moved = entries.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(split(not number, last, totals), _ROW)
                    after = materialise(_dealt(moved, parts, "turn", "kind", "block").mapInArrow(add(last), _ROW), "last" if last else "state", **_NUMBERS)
                    run.release(state)
                    state = after
                    of_texts, of_terms = _stats(state, k=k)
                    if number:
                        prior = of_texts[1] + eta * (log_sum - terms * float(np.log(totals / eta + terms).sum()))
                        likelihoods.append(float(of_texts[0]))
                        penalised.append(float(likelihoods[-1] + prior))
                    totals, log_sum = of_texts[3:] + of_terms[1:], of_texts[2] + of_terms[0]
                counts = state.where(F.col("kind") == _COUNTS).select("part", F.col("m").alias("counts"))
                counts = run.keep(materialise(counts, "topics"))
            finally:
                entries.unpersist(True)
        return TopicTable(counts, tuple(totals.tolist()), terms, parts, alpha, eta, tuple(likelihoods), tuple(penalised))


def topic_shares(
    df: DataFrame, model: TopicTable, column: str, row_id: str, output: str = "topicDistribution", iterations: int = 30
) -> DataFrame:
    """``df`` with each row's share of every topic as a vector, the terms of the topics held fixed.

    The terms of a block of texts ask their blocks for their chances, one shuffle brings these and the entries
    of a block of texts together, and its shares are iterated there. A row without entries has zeros. The
    shares are saved.
    """
    spark, k, eta, alpha = df.sparkSession, model.k, model.eta, model.alpha
    totals = np.array(model.totals)
    terms, parts = model.terms, model.parts
    per_part = -(-terms // parts)
    term_type = _term_type(per_part)
    answer = "block int, part int, m binary"

    def chances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, matrix = None, None
        for block, part, w, m in _in_order(batches, "block", "part", "w", "m"):
            if part != held:
                held, matrix = part, np.zeros((per_part, k))
            if w is None:
                matrix = _matrix(m, k)
            else:
                found = (matrix[np.frombuffer(w, term_type)] + eta) / (totals + terms * eta)
                yield from _table([(block, part, found.tobytes())], answer).to_batches()

    def shares(mine: pa.Table, known: pa.Table) -> pa.Table:
        found = dict(zip(known.column("part").to_pylist(), known.column("m").to_pylist()))
        slabs = {r[0]: r for r in zip(*(mine.column(c).to_pylist() for c in ("part", "size", "d", "u", "n")))}
        ids = np.frombuffer(slabs.pop(-1)[2], "<i8")
        d, u, n, tables, size = [], [], [], [], 0
        for part in sorted(slabs):
            _, entries, steps, places, counts = slabs[part]
            d.append(np.cumsum(_numbers(steps, entries), dtype=np.int32))
            u.append(_numbers(places, entries).astype(np.int32) + size)
            n.append(_read_counts(counts, entries).astype(np.float32))
            tables.append(_matrix(found.pop(part), k))
            size += len(tables[-1])
        d = np.concatenate(d)
        order, starts = np.argsort(d, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(ids)))])
        theta = _fold_in(starts, np.concatenate(u)[order], np.concatenate(n)[order], np.ascontiguousarray(np.vstack(tables).T), alpha, iterations)
        lists = pa.ListArray.from_arrays(np.arange(0, k * len(ids) + 1, k, dtype=np.int32), theta.reshape(-1))
        return pa.table([pa.array(ids), lists], names=["of_row", "share"])

    with stages(spark) as run:
        slabs, blocks = _slabs(df, column, row_id, k, parts, term_type)
        with _small_batches(spark, parts):
            asked = slabs.where("part >= 0").select("block", "part", "w", F.lit(None).cast("binary").alias("m"))
            fixed = model.counts.select(F.lit(-1).alias("block"), "part", F.lit(None).cast("binary").alias("w"), F.col("counts").alias("m"))
            known = _dealt(fixed.unionByName(asked), parts, "block").mapInArrow(chances, answer)
            mine = _by_block(slabs.select("block", "part", "size", "d", "u", "n"), blocks)
            found = mine.groupBy("block").cogroup(_by_block(known, blocks).groupBy("block"))
            found = run.keep(found.applyInArrow(shares, "of_row long, share array<double>"), "shares")
    none = F.array(*[F.lit(0.0)] * k)
    joined = df.join(found, F.col(row_id) == F.col("of_row"), "left")
    return joined.select(*[c for c in df.columns if c != output], array_to_vector(F.coalesce("share", none)).alias(output))


def _fold_in(starts: np.ndarray, u: np.ndarray, n: np.ndarray, chances: np.ndarray, alpha: float, iterations: int) -> np.ndarray:
    """The shares of texts, a row each; their entries begin at ``starts``, and a few texts at a time are iterated."""
    k, texts = len(chances), len(starts) - 1
    out, first = np.empty((texts, k)), 0
    while first < texts:
        after = max(first + 1, int(np.searchsorted(starts, starts[first] + CHUNK, "right")) - 1)
        low, high = starts[first], starts[after]
        found, counts = chances.take(u[low:high], axis=1), n[low:high].astype(np.float64)
        at, lengths = starts[first:after] - low, np.diff(starts[first : after + 1])
        theta = np.full((k, after - first), 1 / k)
        weights = np.add.reduceat(counts, at) + k * alpha
        for _ in range(iterations):
            whole = np.repeat(theta[0], lengths) * found[0]
            for j in range(1, k):
                whole += np.repeat(theta[j], lengths) * found[j]
            part = counts / whole
            theta = (theta * np.stack([np.add.reduceat(found[j] * part, at) for j in range(k)]) + alpha) / weights
        out[first:after] = theta.T
        first = after
    return out


def topic_terms(model: TopicTable, vocabulary: DataFrame) -> DataFrame:
    """``topic``, ``term`` and ``chance``: the share of every term in every topic."""
    totals, k, eta, terms, parts = np.array(model.totals), model.k, model.eta, model.terms, model.parts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                slots = np.arange(part, terms, parts)
                chance = ((_matrix(counts, k) + eta) / (totals + terms * eta))[: len(slots)]
                columns = np.repeat(slots, k), np.tile(np.arange(k, dtype=np.int32), len(slots)), chance.reshape(-1)
                yield pa.record_batch([pa.array(c) for c in columns], names=["slot", "topic", "chance"])

    found = model.counts.mapInArrow(rows, "slot long, topic int, chance double")
    return found.join(vocabulary.select("slot", "term"), "slot").select("topic", "term", "chance")
