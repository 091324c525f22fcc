"""Near duplicates by SimHash and generalised pigeonhole search.

Fingerprints are cut into partitions of bits that go together (correlated bits share one, so that
chance agreement is not paid for in several). For every fingerprint a dynamic program allots each
partition a threshold of its own, -1 to skip it: with m partitions the thresholds add up to
radius - m + 1, so two fingerprints within the radius agree up to the threshold in at least one.
What a threshold costs is estimated from counts of partition values over all fingerprints, held
as tables of at most 2**12 entries; frequent values get low thresholds and rare ones make up for
them. All values within the threshold are probed, and what meets in one is verified.

Only different fingerprints are searched, so copies cost nothing. Values that many share are cut
into chunks of ``CHUNK`` members. Links of small groups come out one by one; in large groups each
row keeps the links that hold the group together, so a dense group of k gives about k links and
not k squared. Components are the same either way.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, hold, id_and_text, materialise, schema_of, unused_name, words
from marquee.llm.components import components
from marquee.session import stages

SEED = 42
CHUNK = 4096
#: Groups up to this size give all their links.
SMALL = 48
BLOCK_BITS = 12
#: Cost of a probe in units of a comparison.
PROBE_COST = 100.0
MOST_THRESHOLD = 4

MEMBER, PROBER = 1, 2
PROBES = "key long, fp binary, role int"
LINKS = "u binary, v binary"
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, joined by spaces, repeats included; fewer words: of all of them."""
    found = words(text.lower())
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(found) - size + 1)
    parts = [joined[a:b] for a, b in zip(starts, ends[size - 1 :] or ends[-1:])]
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)


def fingerprints(hashes: list[np.ndarray], blocks: int = 1) -> np.ndarray:
    """A row of ``blocks`` 64-bit words per document; a bit is set if it is in over half of the hashes.

    The first word is of the hashes as they are, the others of hashes mixed anew. No hashes: zero.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros((len(hashes), blocks), np.uint64)
    all_hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    place = np.repeat(np.arange(len(hashes)) << 8, sizes)
    for block in range(blocks):
        h = all_hashes
        if block:
            h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD + 2 * block)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53 + 2 * block)
            h ^= h >> np.uint64(32)
        octets = h.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts = np.bincount(place + octets[:, k], minlength=len(hashes) << 8).reshape(-1, 256) @ _BYTE_BITS
            bits = np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little")[:, 0]
            out[:, block] |= bits.astype(np.uint64) << np.uint64(8 * k)
    return out


def to_bytes(fps: np.ndarray) -> list[bytes]:
    """Big-endian, so that the hexadecimal form reads as a number."""
    data, width = fps.astype(">u8").tobytes(), 8 * fps.shape[1]
    return [data[i : i + width] for i in range(0, len(data), width)]


def from_column(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), ">u8").astype(np.uint64).reshape(len(values), -1)


def text_fingerprints(texts: list[bytes], size: int, blocks: int) -> list[bytes]:
    """Fingerprints of a batch, some texts at a time so that memory stays small."""
    out: list[bytes] = []
    held: list[np.ndarray] = []
    total = 0

    for text in texts:
        held.append(shingle_hashes(text, size))
        total += len(held[-1])
        if total > 200_000 or len(held) >= 500:
            out += to_bytes(fingerprints(held, blocks))
            held, total = [], 0
    return out + (to_bytes(fingerprints(held, blocks)) if held else [])


def with_fingerprints(
    docs: DataFrame, text_col: str = "text", name: str = "fp", size: int = 4, blocks: int = 1
) -> DataFrame:
    """``docs`` with a binary column ``name``; a null text has the fingerprint zero."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", int)  # nothing of its own, but others must let go
        for batch in batches:
            fps = text_fingerprints(byte_rows(batch.column(text_col)), size, blocks)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(fps, pa.binary())], schema=batch.schema.append(pa.field(name, pa.binary()))
            )

    return docs.mapInArrow(rows, docs.select("*", F.lit(None).cast("binary").alias(name)).schema)


# --- the plan of a search ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SearchPlan:
    """Bits of each partition, estimates, and the radius that is searched without loss."""

    bits: int
    radius: int
    parts: tuple[tuple[int, ...], ...]
    #: For each partition, sub-blocks of its bits (positions within the partition) and their tables:
    #: share of fingerprints at distance 0, 1, ... of a value.
    tables: tuple[tuple[tuple[tuple[int, ...], np.ndarray], ...], ...]
    nodes: int


def part_count(nodes: int, bits: int, radius: int) -> int:
    """The number of partitions that costs least if bits were independent."""

    def cost(m: int) -> float:
        width, total = bits / m, radius - m + 1
        base, more = divmod(total, m)
        probes = [sum(comb(round(width), e) for e in range(t + 1)) for t in [base + 1] * more + [base] * (m - more)]
        return sum(p * (PROBE_COST + nodes / 2**width) for p in probes)

    most = min(bits // 4, radius + 1)
    return min(range(max(1, -(-bits // 40)), max(most, -(-bits // 40)) + 1), key=cost)


def group_bits(together: np.ndarray, nodes: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """Partitions of nearly equal size; each starts from the bit that goes most with others left and takes its kin.

    ``together`` counts fingerprints that have both bits, on its diagonal those that have one.
    """
    share = together / max(1, nodes)
    ones = np.diag(share)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    kin = np.abs((share - np.outer(ones, ones)) / np.outer(spread, spread))
    np.fill_diagonal(kin, 0)
    left, out = list(range(len(kin))), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (kin[b, left].max(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (kin[b, group].mean(), -b))
            group.append(best)
            left.remove(best)
        out.append(tuple(sorted(group)))
    return tuple(out)


def _values(fps: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    """The bits of fingerprints at some positions as numbers."""
    out = np.zeros(len(fps), np.int64)
    for at, bit in enumerate(positions):
        out |= ((fps[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64) << at
    return out


@lru_cache(maxsize=None)
def masks(width: int, distance: int) -> np.ndarray:
    """All numbers of ``width`` bits with ``distance`` of them set."""
    chosen = itertools.combinations(range(width), distance)
    return np.array([sum(1 << b for b in bits) for bits in chosen], np.int64)


def _at_distance(counts: np.ndarray, width: int, radius: int) -> np.ndarray:
    """Counts of values at each distance up to ``radius`` from every value."""
    own = np.arange(1 << width)
    return np.stack([sum(counts[own ^ mask] for mask in masks(width, e)) if e <= width else 0 * counts for e in range(radius + 1)], 1)


def _sum_rows(nodes: DataFrame, measure, size: int) -> np.ndarray:
    """Sum over tasks of an integer vector, as one row per entry and task; the driver gets ``size`` rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += measure(from_column(batch.column("fp")))
        at = np.flatnonzero(total)
        yield pa.record_batch([at, total[at]], schema=schema_of("at int, n long"))

    found = np.zeros(size, np.int64)
    for at, n in nodes.select("fp").mapInArrow(rows, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        found[at] = n
    return found


def plan_search(nodes: DataFrame, bits: int, radius: int, parts: int | None = None) -> SearchPlan:
    """Count how bits go together, then how often values of their groups occur, over all fingerprints."""

    def together(fps: np.ndarray) -> np.ndarray:
        on = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little").astype(np.float32)
        return np.rint(on.T @ on).astype(np.int64).reshape(-1)

    count = nodes.count()
    pairs = _sum_rows(nodes, together, bits * bits).reshape(bits, bits)
    groups = group_bits(pairs, count, parts or part_count(count, bits, radius))
    blocks = []
    for group in groups:
        pieces = -(-len(group) // BLOCK_BITS)
        cuts = [len(group) * i // pieces for i in range(pieces + 1)]
        blocks.append([tuple(range(a, b)) for a, b in zip(cuts, cuts[1:])])
    flat = [tuple(group[i] for i in block) for group, of_group in zip(groups, blocks) for block in of_group]
    firsts = np.cumsum([0, *(1 << len(b) for b in flat)]).tolist()

    def histograms(fps: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_values(fps, b), minlength=1 << len(b)) for b in flat])

    counts = _sum_rows(nodes, histograms, firsts[-1])
    shares = iter(
        _at_distance(counts[a:b] / max(1, count), len(block), MOST_THRESHOLD) for block, a, b in zip(flat, firsts, firsts[1:])
    )
    tables = tuple(tuple((block, next(shares)) for block in of_group) for of_group in blocks)
    return SearchPlan(bits, radius, groups, tables, count)


def estimates(values: np.ndarray, blocks: tuple[tuple[tuple[int, ...], np.ndarray], ...], nodes: int) -> np.ndarray:
    """Expected number of fingerprints within distance 0, 1, ... of each value of a partition."""
    total = None
    for block, table in blocks:
        part = table[(values >> block[0]) & ((1 << len(block)) - 1)]
        if total is None:
            total = part
        else:
            total = np.stack([sum(total[:, i] * part[:, e - i] for i in range(e + 1)) for e in range(part.shape[1])], 1)
    return nodes * np.cumsum(total, 1)


def thresholds(values: list[np.ndarray], plan: SearchPlan) -> np.ndarray:
    """The cheapest thresholds for each fingerprint: a row each, a column per partition."""
    n, m = len(values[0]), len(plan.parts)
    goal = plan.radius - m + 1 + m  # thresholds counted from -1
    top = min(MOST_THRESHOLD, plan.radius) + 1
    best = np.full((n, goal + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, n, goal + 1), np.int8)
    for i, group in enumerate(plan.parts):
        found = estimates(values[i], plan.tables[i], plan.nodes)
        probes = np.cumsum([comb(len(group), e) for e in range(MOST_THRESHOLD + 1)])
        cost = np.concatenate([np.zeros((n, 1)), found + PROBE_COST * probes], 1)
        now = np.full((n, goal + 1), np.inf)
        for step in range(min(top, goal) + 1):
            tried = best[:, : goal + 1 - step] + cost[:, step : step + 1]
            better = tried < now[:, step:]
            now[:, step:][better] = tried[better]
            choice[i][:, step:][better] = step
        best = now
    out, at = np.zeros((n, m), np.int64), np.full(n, goal)
    for i in reversed(range(m)):
        out[:, i] = choice[i][np.arange(n), at]
        at -= out[:, i]
    return out - 1


def probe_rows(fps: np.ndarray, plan: SearchPlan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, index of the fingerprint, role) of all places where a fingerprint is stored or looked for."""
    values = [_values(fps, group) for group in plan.parts]
    allotted = thresholds(values, plan)
    keys, owners, roles = [], [], []
    own = np.arange(len(fps))
    for i, group in enumerate(plan.parts):
        key, limit = (i << 48) | values[i], allotted[:, i]
        keys.append(key)
        owners.append(own)
        roles.append(np.where(limit >= 0, MEMBER | PROBER, MEMBER))
        for distance in range(1, MOST_THRESHOLD + 1):
            far = np.flatnonzero(limit >= distance)
            if len(far) and distance <= len(group):
                around = masks(len(group), distance)
                keys.append((key[far, None] ^ around[None, :]).reshape(-1))
                owners.append(np.repeat(far, len(around)))
                roles.append(np.full(len(far) * len(around), PROBER))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(roles)


# --- verification --------------------------------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def small_groups(keys: np.ndarray, fps: np.ndarray, roles: np.ndarray, accept: int) -> tuple[np.ndarray, np.ndarray]:
    """All links among rows of equal key; rows are sorted by key and no group is large."""
    left, right = [], []
    alive = np.arange(len(keys))
    for step in range(1, SMALL + 1):
        alive = alive[alive + step < len(keys)]
        alive = alive[keys[alive] == keys[alive + step]]
        if not len(alive):
            break
        crossed = roles[alive] & ((roles[alive + step] >> 1) | ((roles[alive + step] & 1) << 1))
        met = alive[crossed > 0]
        met = met[_distance(fps[met], fps[met + step]) <= accept]
        left.append(met)
        right.append(met + step)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


class LargeGroup:
    """Members are held, probers come in blocks; the links that come out keep the group's components."""

    def __init__(self, accept: int):
        self.accept, self.parts, self.members = accept, [], None

    def add(self, fps: np.ndarray, roles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows in order of falling membership: once pure probers come, the members are complete."""
        if len(rows := fps[(roles & MEMBER) > 0]):
            self.parts.append((rows, roles[(roles & MEMBER) > 0]))
        if len(probers := fps[roles == PROBER]):
            yield from self._start()
            yield from self._match(probers)

    def end(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._start()

    def _start(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.members is None and self.parts:
            self.members = np.concatenate([p for p, _ in self.parts])
            roles = np.concatenate([r for _, r in self.parts])
            self.label = np.arange(len(self.members))
            yield from self._match(self.members[(roles & PROBER) > 0])

    def _match(self, probers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.members is None:
            return
        for at in range(0, len(probers), 256):
            block = probers[at : at + 256]
            far = np.zeros((len(block), len(self.members)), np.int64)
            for k in range(block.shape[1]):
                far += np.bitwise_count(block[:, k, None] ^ self.members[None, :, k])
            hit = far <= self.accept
            far[~hit | (far == 0)] = 1 << 20
            nearest = far.argmin(1)
            some = np.flatnonzero(far[np.arange(len(block)), nearest] <= self.accept)
            yield block[some], self.members[nearest[some]]
            for row in np.flatnonzero(hit.sum(1) > 1):
                met = np.flatnonzero(hit[row])
                labels, first = np.unique(self.label[met], return_index=True)
                if len(labels) > 1:
                    others = self.members[met[first]]
                    yield np.repeat(block[row : row + 1], len(others), 0), others
                    self.label[np.isin(self.label, labels[1:])] = labels[0]


def verify(batches: Iterator[pa.RecordBatch], accept: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by (key, chunk, falling role)."""

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([to_bytes(a), to_bytes(b)], schema=schema_of(LINKS))

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    large: LargeGroup | None = None
    last = None

    def groups(keys: np.ndarray, fps: np.ndarray, roles: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups."""
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        sizes = np.diff(starts)
        few = np.repeat(sizes <= SMALL, sizes) & np.repeat(sizes > 1, sizes)
        a, b = small_groups(keys[few], fps[few], roles[few], accept)
        if len(a):
            yield links(fps[few][a], fps[few][b])
        for i in np.flatnonzero(sizes > SMALL):
            rows, group = slice(starts[i], starts[i + 1]), LargeGroup(accept)
            for x, y in itertools.chain(group.add(fps[rows], roles[rows]), group.end()):
                if len(x):
                    yield links(x, y)

    for batch in batches:
        if not batch.num_rows:
            continue
        # Chunks of one key are groups of their own.
        keys = batch.column("key").to_numpy() ^ (batch.column("chunk").to_numpy().astype(np.int64) << 32 << 22)
        fps, roles = from_column(batch.column("fp")), batch.column("role").to_numpy()
        if large is not None:
            more = int(np.searchsorted(keys != last, True)) if (keys != last).any() else len(keys)
            for x, y in large.add(fps[:more], roles[:more]):
                if len(x):
                    yield links(x, y)
            if more == len(keys):
                continue
            for x, y in large.end():
                if len(x):
                    yield links(x, y)
            large, keys, fps, roles = None, keys[more:], fps[more:], roles[more:]
        if held:
            keys, fps, roles = (np.concatenate([h[i] for h in held] + [x]) for i, x in enumerate((keys, fps, roles)))
            held = []
        cut = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if (keys != keys[-1]).any() else 0
        if cut:
            yield from groups(keys[:cut], fps[:cut], roles[:cut])
        keys, fps, roles, last = keys[cut:], fps[cut:], roles[cut:], keys[-1]
        if len(keys) > 2 * CHUNK:
            large = LargeGroup(accept)
            for x, y in large.add(fps, roles):
                if len(x):
                    yield links(x, y)
        else:
            held = [(keys, fps, roles)]
    if held:
        yield from groups(*held[0])
    if large is not None:
        for x, y in large.end():
            if len(x):
                yield links(x, y)


def fingerprint_links(nodes: DataFrame, bits: int, radius: int, accept: int | None = None, parts: int | None = None) -> DataFrame:
    """Pairs ``u``, ``v`` of different fingerprints that connect all that lie within ``radius``.

    ``nodes`` holds each fingerprint once in ``fp`` (``bits`` / 8 bytes). No two fingerprints within the radius
    are left in different components. Pairs up to ``accept`` bits apart (default: the radius) are links as well
    where a probe finds them. ``parts`` sets the number of partitions, else their cost decides. A pair can come
    more than once.
    """
    plan = plan_search(nodes, bits, radius, parts)
    most = radius if accept is None else accept

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", int)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                column = batch.column("fp").slice(at, 500)
                keys, owners, roles = probe_rows(from_column(column), plan)
                yield pa.record_batch([keys, column.take(pa.array(owners)), roles.astype(np.int32)], schema=schema_of(PROBES))

    rows = materialise(nodes.select("fp").mapInArrow(probe, PROBES), "probes")
    sizes = rows.where(F.col("role") != PROBER).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    heavy = materialise(sizes.where(F.col("n") > CHUNK), "heavy").withColumnRenamed("key", "heavy_key")
    chunks = F.coalesce(F.ceil(F.col("n") / CHUNK), F.lit(1)).cast("int")
    own = F.when(F.col("role") == PROBER, -1).otherwise(F.pmod(F.xxhash64("fp"), chunks)).cast("int")
    cut = rows.join(heavy, F.col("key") == F.col("heavy_key"), "left").select(
        "key", "fp", "role", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
    )
    role = F.when(F.col("own") == F.col("chunk"), F.col("role")).otherwise(F.lit(PROBER))
    placed = cut.where((F.col("role") != MEMBER) | (F.col("own") == F.col("chunk"))).select(
        "key", "chunk", "fp", role.cast("int").alias("role")
    )
    order = F.when(F.col("role") == PROBER, 1).otherwise(0)
    dealt = placed.repartition("key", "chunk").sortWithinPartitions("key", "chunk", order)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("fingerprints", int)
        yield from verify(batches, most)

    return dealt.mapInArrow(links, LINKS)


def roots(nodes: DataFrame, radius: int, parts: int | None = None) -> DataFrame:
    """``fp`` and ``root``, the smallest fingerprint that links of up to ``radius`` bits reach, saved.

    ``nodes`` holds each fingerprint once in ``fp`` (64 bits).
    """
    with stages(nodes.sparkSession) as run:
        found = components(fingerprint_links(nodes, 64, radius, parts=parts))
        rooted = nodes.select("fp").join(found, F.col("fp") == F.col("node"), "left")
        return run.keep(rooted.select("fp", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4, parts: int | None = None
) -> DataFrame:
    """A row per document: ``doc_id``, ``fp`` (64 bits, big-endian) and ``component_id``.

    Fingerprints of ``size``-word shingles are linked at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest ``doc_id`` that links reach, the document's own included (null ids come last). Texts without
    words share the fingerprint zero, which links like any other. An empty table gives an empty result.
    """
    tagged = materialise(with_fingerprints(id_and_text(docs, id_col, text_col), "text", "fp", size).drop("text"), "fingerprints")
    nodes = materialise(tagged.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    rooted = materialise(roots(nodes, radius, parts).join(nodes, "fp"), "leasts")
    # Saved, so that the join meets no grouping on its way and Spark can split a root with very many fingerprints.
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    of_fp = materialise(rooted.join(least, "root").select(F.col("fp").alias("of_fp"), "component_id"), "of-fp")
    return tagged.join(of_fp, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but one row of each component of :func:`near_duplicates`.

    The row with the smallest id stays; null ids come last, and of several rows with one id the first by an
    internal number. Null and empty texts, and texts without words, have the fingerprint zero and are one
    group. An empty table gives an empty result. Working columns get names that ``docs`` does not have.
    """
    with stages(docs.sparkSession) as run:
        fp, row, stays = (unused_name(docs, name) for name in ("_near_fp", "_near_row", "_near_stays"))
        rows = with_fingerprints(docs, text_col, fp, size).withColumn(row, F.monotonically_increasing_id())
        rows = materialise(rows, "tagged", compression="zstd")
        first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
        nodes = materialise(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), "nodes")
        best = roots(nodes, radius).join(nodes, "fp").groupBy("root").agg(F.min("first").alias("first"))
        stay = run.keep(best.select(F.col("first.row").alias(stays)), "stay")
        # Small corpora run the plan of large ones.
        return run.keep(rows).join(stay.hint("merge"), F.col(row) == F.col(stays), "left_semi").drop(fp, row)
