"""Similarity join of shingle sets through parity sketches.

A sketch has a bit for every place that a shingle can hash to, and each shingle of a set flips its own.
Shingles that two sets share cancel, so the Hamming distance of two sketches is at most the size of the
sets' symmetric difference, which in turn is bounded where they are similar. Sets are put into bands
of sizes such that every similar pair shares one. A band's sketch is cut into more blocks than two
similar sets can differ in, so they agree in a whole block (pigeonhole), and blocks that are not empty
are joined by their hash. A set whose filled blocks are too few for that argument is sketched again
with another seed, and again, until they are enough.

Candidates are bounded once more by the distance of short sketches, and what is left is verified on
whole sets. Of large groups only as many pairs are looked at as components need: in some rounds every
set meets one leader, and verified links contract. Then the sketches of each group are compared within
a task, and of the pairs that these allow, those of a spanning forest are verified, the closest first.
Where all of them are links, the group is done; of the others all pairs are verified that sketches
allow between the components that remain.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import expm1

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, hold, id_and_text, materialise, schema_of
from marquee.llm.components import components
from marquee.llm.simhash import shingle_hashes
from marquee.session import stages

#: Rows of one key that a task compares at once; more are cut into slices.
CHUNK = 4096
#: A key is heavy that so many documents of the sample have; this decides only where its rows go.
HEAVY, SAMPLE = 64, 64
#: Rounds in which every set meets one leader.
STAR_ROUNDS = 3
#: Bits of a short sketch for each shingle, and the fewest.
SKETCH_SHARE, LEAST_BITS = 4, 1024
SEEN = 1_000_000
#: Bits that a wanted value takes in a broadcast table, those of one of its rows, and the most of all: 64 MB.
VALUE_BITS, ROW_BITS, MOST_BITS = 16, 32768, 1 << 29

TAGGED = "doc_id long, node long, n int, sketch binary, keys array<long>"
KEYS = "key long, node long, n int"
PAIRS = "u long, v long, n int, m int"


# --- sizes ---------------------------------------------------------------------------------------------------


def most_apart(total: int, percent: int) -> int:
    """The largest symmetric difference of similar sets whose sizes add up to ``total``."""
    return (100 - percent) * total // (100 + percent)


def partner(n: int, percent: int) -> int:
    """The size of the largest set that can be similar to one of ``n``."""
    return 100 * n // percent


@lru_cache(maxsize=None)
def band(index: int, percent: int) -> tuple[int, int]:
    """Smallest and largest size of a band. A set that fits no earlier start of a band has its partners in this one."""
    if index == 0:
        return 1, 2
    high, low = band(index - 1, percent)[1], band(index - 1, percent)[0]
    while partner(low, percent) <= high:
        low += 1
    return low, 2 * low


def bands(n: int, percent: int) -> list[tuple[int, int]]:
    """Index and largest size of the bands that hold sets of ``n``."""
    out, index = [], max(0, n.bit_length() - 2)
    while index and band(index, percent)[1] >= n:
        index -= 1
    while band(index, percent)[0] <= n:
        if band(index, percent)[1] >= n:
            out.append((index, band(index, percent)[1]))
        index += 1
    return out


@lru_cache(maxsize=None)
def block_count(high: int, percent: int) -> int:
    """More blocks than the largest sets of a band can differ in, and so many that enough of them are filled."""
    least = most_apart(2 * high, percent) + 1
    blocks = least + least // 16
    while blocks * -expm1(-high / blocks) < 1.04 * least - 1:
        blocks += blocks // 8 + 1
    return blocks


# --- sketches within a task ----------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_words(hashes: np.ndarray, blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, hash of its set bits) for the blocks of a set's sketch that are not empty.

    The high half of a shingle's hash says the block, the low half the bit. The hash of a block is the
    exclusive or of those of its bits, so two shingles on one bit cancel as they do in the sketch.
    """
    found = hashes if not seed else np.sort(_mix(hashes + np.uint64(0x9E3779B97F4A7C15 * seed % (1 << 64))))
    at = (found >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    words = np.bitwise_xor.reduceat(_mix((found & np.uint64(0xFFFFFFFF)) + np.uint64(1)), starts)
    return at[starts][words != 0], words[words != 0]


def block_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set meets all that are similar; ``hashes`` are sorted and different.

    Two similar sets of a band differ in at most ``apart`` blocks. One with more filled blocks than that has a
    filled block in common with the other, so it needs no further seed; both use all seeds up to their last.
    """
    n, out = len(hashes), []
    for index, high in bands(n, percent):
        blocks, apart = block_count(high, percent), most_apart(n + min(high, partner(n, percent)), percent)
        seed, filled = 0, 0
        while filled <= apart:
            at, words = block_words(hashes, blocks, seed)
            place = np.uint64(xxhash.xxh64_intdigest(f"{index}:{seed}"))
            out.append(_mix(words ^ _mix(at + place)))
            seed, filled = seed + 1, len(at)
    return np.concatenate(out)


def sketch(hashes: np.ndarray) -> bytes:
    """The short sketch: its bits are a power of two, so a longer one folds into a shorter one."""
    bits = max(LEAST_BITS, 1 << (SKETCH_SHARE * len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(data: bytes, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(data, "<u8").reshape(-1, words), axis=0)


def text_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _may_link(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def live_pairs(ns: np.ndarray, labels: np.ndarray, sides: np.ndarray, sketches: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs with different labels that sizes and sketches do not rule out.

    Sides 0 and 1 meet; where all are 0, all rows meet. Rows of the most frequent label are not compared with
    each other.
    """
    width = min(map(len, sketches)) // 8
    data = np.stack([folded(s, width) for s in sketches])
    values, inverse, counts = np.unique(labels, return_inverse=True, return_counts=True)
    main = inverse == counts.argmax()
    step = max(1, (1 << 24) // max(1, len(ns) * width))
    order = np.arange(len(ns))
    rest = np.flatnonzero(~main)
    for at in range(0, len(rest), step):
        rows = rest[at : at + step]
        meets = (labels[rows, None] != labels[None, :]) & (main[None, :] | (rows[:, None] < order[None, :]))
        if sides.any():
            meets &= sides[rows, None] != sides[None, :]
        meets &= _may_link(ns[rows, None], ns[None, :], percent)
        x, y = np.nonzero(meets)
        for part in range(0, len(x), 1 << 18):
            i, j = rows[x[part : part + (1 << 18)]], y[part : part + (1 << 18)]
            far = np.bitwise_count(data[i] ^ data[j]).sum(1, dtype=np.int64)
            close = np.flatnonzero(far <= (100 - percent) * (ns[i] + ns[j]) // (100 + percent))
            close = close[np.argsort(far[close], kind="stable")]
            yield i[close], j[close]


def forest(labels: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those of the pairs of places that join two parts; at first each label is a part."""
    _, part = np.unique(labels, return_inverse=True)
    above = list(range(part.max() + 1))

    def top(at: int) -> int:
        while above[at] != at:
            above[at] = at = above[above[at]]
        return at

    for x, y in pairs:
        joined = []
        for place, (i, j) in enumerate(zip(part[x].tolist(), part[y].tolist())):
            if (a := top(i)) != (b := top(j)):
                above[a] = b
                joined.append(place)
        yield x[joined], y[joined]


# --- the join ------------------------------------------------------------------------------------------------


def tag(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``node`` (a hash of the document's set), ``n`` (its size), ``sketch`` and ``keys``; neither of these
    for empty sets and for sets that the task has had before."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(("doc_id", "node", "n", "sketch", "keys"), kinds)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("parity", int)  # nothing of its own, but others must let go
        seen: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                out: list[list] = [[], [], [], [], []]
                part = batch.slice(start, 1000)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), byte_rows(part.column("text"))):
                    found = text_set(text, size)
                    node = int(np.int64(np.uint64(xxhash.xxh64_intdigest(found.tobytes()))))
                    first = len(found) and node not in seen
                    row = doc_id, node, len(found), sketch(found) if first else None, block_keys(found, percent).view(np.int64) if first else None
                    for column, value in zip(out, row):
                        column.append(value)
                    seen.add(node)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], schema=schema)
            seen = seen if len(seen) < SEEN else set()

    return docs.mapInArrow(rows, TAGGED)


def meeting(rows: DataFrame, sampled: DataFrame) -> DataFrame:
    """``key``, ``node`` and ``n`` of the groups in which two sets or more meet, each group once.

    Keys that many of the sampled documents have are dealt over all tasks and taken as they are; the others
    are grouped, and groups of the same sets become one.
    """
    heavy = sampled.groupBy("key").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") >= HEAVY)
    heavy = materialise(heavy.select(F.col("key").alias("heavy")), "heavy")
    flagged = rows.join(heavy, F.col("key") == F.col("heavy"), "left").select("key", "node", "n", F.col("heavy").isNotNull().alias("hot"))
    dealt = flagged.repartition("key", F.when(F.col("hot"), F.col("node"))).sortWithinPartitions("key", "node")

    def groups(keys: np.ndarray, nodes: np.ndarray, ns: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes, ns, hot = keys[first], nodes[first], ns[first], hot[first]
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        sizes = np.diff(np.append(starts, len(keys)))
        marks = np.add.reduceat(_mix(nodes.view(np.uint64) + np.uint64(1)), starts).view(np.int64)
        kept = np.repeat(sizes > 1, sizes) | hot
        marks = np.where(hot, keys, np.repeat(marks, sizes))
        return pa.record_batch([marks[kept], nodes[kept], ns[kept]], schema=schema_of(KEYS))

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "node", "n", "hot")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            keys, hot = columns[0], columns[3]
            # The last group may go on in the next batch, unless its rows come as they are.
            cut = len(keys) if hot[-1] else int(np.searchsorted(keys, keys[-1]))
            held = [c[cut:] for c in columns] if cut < len(keys) else None
            if cut:
                yield groups(*(c[:cut] for c in columns))
        if held is not None:
            yield groups(*held)

    return materialise(dealt.mapInArrow(several, KEYS).distinct(), "meeting")


def value_bits(wanted: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, int] | None:
    """A table in which a bit is set for the hash of each value of ``wanted`` (one column), and the number of its bits;
    None where that would be more than ``most_bits``."""
    bits = -(-max(1, wanted.count()) * VALUE_BITS // ROW_BITS) * ROW_BITS
    if bits > most_bits:
        return None
    value = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(bits))
    return wanted.groupBy(F.floor(value / ROW_BITS).alias("_part")).agg(F.bitmap_construct_agg(value % ROW_BITS).alias("_bits")), bits


def having_bits(rows: DataFrame, column: str, table: tuple[DataFrame, int] | None) -> DataFrame:
    """``rows`` whose ``column`` has its bit set in a table of :func:`value_bits`; all of them without a table."""
    if table is None:
        return rows
    parts, bits = table
    value = F.pmod(F.xxhash64(column), F.lit(bits))
    placed = rows.withColumns({"_part": F.floor(value / ROW_BITS), "_bit": value % ROW_BITS})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1
    return placed.join(F.broadcast(parts), "_part").where(met).select(*rows.columns)


def among(rows: DataFrame, column: str, wanted: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` with every one whose ``column`` is among the values of ``wanted`` (one column) and few others.

    Goes before a join, which then shuffles few rows that meet nothing. A bit for the hash of each value is set in a
    table that is broadcast; where this would take more than ``most_bits``, all rows come back.
    """
    return having_bits(rows, column, value_bits(wanted, most_bits))


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose ``doc_id`` (null too) is in ``ids``, one column ``of_id`` without repeats.

    An inner join: Spark moves a left semi join below the join with the broadcast bits, so that every text is shuffled.
    """
    found = among(docs, "doc_id", ids).join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of_id")))
    return found.select(*docs.columns)


class _Join:
    """The frames that the rounds share: groups, short sketches and texts of the sets that meet."""

    def __init__(self, docs: DataFrame, tagged: DataFrame, groups: DataFrame, size: int, percent: int):
        self.size, self.percent, self.groups = size, percent, groups
        meet = materialise(groups.select("node").distinct(), "meet")
        # Sketches stay where they are; tasks may have the same, so pairs name the ``mark`` of the one they take.
        known = having_bits(tagged.where(F.col("sketch").isNotNull()).select("node", "sketch"), "node", value_bits(meet))
        known = materialise(known.withColumn("mark", F.monotonically_increasing_id()), "sketches")
        marks = known.groupBy("node").agg(F.min("mark").alias("mark"))
        self.sketches = known.select("mark", "sketch")
        # One document of each set is read again, found by its id; rows that share the id are told apart by their sets.
        least = tagged.join(meet, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("of_id"))
        ids = materialise(least.select("of_id").distinct(), "ids")
        texts = with_ids(docs, ids).mapInArrow(self._named(), "node long, text binary")
        texts = materialise(texts.withColumn("at", F.monotonically_increasing_id()), "texts", compression="zstd")
        places = texts.groupBy("node").agg(F.min("at").alias("at")).join(meet, "node", "left_semi")
        self.texts, self.places = texts.select("at", "text"), materialise(places.join(marks, "node"), "places")
        self.links: list[DataFrame] = []
        self.tested: list[DataFrame] = []

    def _named(self):
        size = self.size

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold("parity", int)
            seen: set[int] = set()
            for batch in batches:
                out = []
                for text in byte_rows(batch.column("text")):
                    node = xxhash.xxh64_intdigest(text_set(text, size).tobytes())
                    if node not in seen:
                        out.append((int(np.int64(np.uint64(node))), text))
                        seen.add(node)
                seen = seen if len(seen) < SEEN else set()
                if out:
                    yield pa.record_batch(list(map(list, zip(*out))), schema=schema_of("node long, text binary"))

        return rows

    def _with(self, pairs: DataFrame, rows: DataFrame, place: str, value: str) -> DataFrame:
        """Saved ``pairs`` with the ``value`` of both ends from ``rows``; of these, few are shuffled that no pair wants.

        Always by sorting: few pairs would be broadcast to all rows, so that small tables moved no values and large
        ones all, and what is measured on the former said nothing about the latter.
        """
        out = pairs
        for end in "vu":
            found = among(rows, place, pairs.select(f"{place}_{end}").distinct())
            found = found.select(F.col(place).alias(f"{place}_{end}"), F.col(value).alias(f"{value}_{end}"))
            out = out.join(found.hint("merge"), f"{place}_{end}")
        return out

    def verify(self, pairs: DataFrame, bounded: bool) -> None:
        """Add the pairs ``u``, ``v`` that are similar to the links; ``u`` is the one that many pairs may have."""
        percent, size = self.percent, self.size

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for n, m, a, b in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "sketch_u", "sketch_v"))):
                    width = min(len(a), len(b)) // 8
                    keep.append(int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum()) <= most_apart(n + m, percent))
                kept = ["u", "v", "n", "m", "at_u", "at_v"]
                yield pa.record_batch([batch.column(c) for c in kept], names=kept).filter(pa.array(keep, pa.bool_()))

        for end in "uv":
            named = self.places.select(F.col("node").alias(end), F.col("at").alias(f"at_{end}"), F.col("mark").alias(f"mark_{end}"))
            pairs = pairs.join(named, end)
        pairs = materialise(pairs.select("u", "v", "n", "m", "at_u", "at_v", "mark_u", "mark_v"), "at")
        if not bounded:
            near = self._with(pairs, self.sketches, "mark", "sketch").mapInArrow(close, f"{PAIRS}, at_u long, at_v long")
            pairs = materialise(near, "close")
        pairs = self._with(pairs, self.texts, "at", "text")

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hold("parity", int)
            held, held_set = None, None
            for batch in batches:
                out = []
                for u, v, a, b in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "text_u", "text_v"))):
                    if u != held:
                        held, held_set = u, text_set(a, size)
                    out.append((u, v, similar(held_set, text_set(b, size), percent)))
                if out:
                    yield pa.record_batch(list(map(list, zip(*out))), schema=schema_of("u long, v long, link boolean"))

        found = pairs.select("u", "v", "text_u", "text_v").mapInArrow(exact, "u long, v long, link boolean")
        found = materialise(found, "verified")
        self.links.append(found.where("link").select("u", "v"))
        self.tested.append(found.where("not link").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))

    def labels(self) -> DataFrame | None:
        if not self.links:
            return None
        every = self.links[0]
        for more in self.links[1:]:
            every = every.unionByName(more)
        return components(every)

    def labelled(self) -> DataFrame:
        """Groups with the ``label`` of each row."""
        labels = self.labels()
        if labels is None:
            return self.groups.withColumn("label", F.col("node"))
        roots = labels.select(F.col("node").alias("of_node"), "root")
        rows = self.groups.join(roots, F.col("node") == F.col("of_node"), "left")
        return rows.select("key", "node", "n", F.coalesce("root", "node").alias("label"))

    def star(self, number: int) -> None:
        """Each set meets, of the leaders of its groups, one; a group with one label has none."""
        placed = self.labelled()
        rank = F.xxhash64(F.lit(number), "node")
        leader = F.min(F.struct(rank.alias("rank"), F.col("node"), F.col("n"), F.col("label"))).alias("leader")
        # Saved, so that the join meets no grouping on its way and Spark can split a group with very many rows.
        leaders = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), leader).where("lo <> hi")
        leaders = materialise(leaders.select(F.col("key").alias("of_key"), "leader"), "leaders")
        met = placed.join(leaders, F.col("key") == F.col("of_key")).where(F.col("label") != F.col("leader.label"))
        low, high = F.least("n", F.col("leader.n")), F.greatest("n", F.col("leader.n"))
        met = met.where(low * 100 >= high * self.percent).groupBy("node", "n").agg(F.min("leader").alias("leader"))
        pairs = met.select(F.col("leader.node").alias("u"), F.col("node").alias("v"), F.col("leader.n").alias("n"), F.col("n").alias("m"))
        self.verify(materialise(pairs, "pairs"), False)

    def left(self, keys: DataFrame | None = None) -> DataFrame | None:
        """Verify pairs of sets that meet and are in different components, as far as sizes and sketches allow a link.

        Of each group a spanning forest is verified, and the keys of groups return in which an edge is no link. Of
        groups with these ``keys`` every such pair is.
        """
        placed = self.labelled()
        placed = materialise(placed if keys is None else placed.join(keys, "key", "left_semi"), "placed")
        sizes = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo <> hi")
        sizes = materialise(sizes.select(F.col("key").alias("of_key"), F.ceil(F.col("rows") / CHUNK).cast("int").alias("slices")), "sizes")
        rows = placed.join(sizes, F.col("key") == F.col("of_key"))
        own = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("own")
        rows = rows.select("key", "node", "n", "label", own, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other"))
        low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        rows = rows.select("key", "node", "n", "label", low, high, (F.col("own") > F.col("other")).cast("int").alias("side"))
        # A pair may meet in many groups; the smallest key of those it shares looks at it.
        own_keys = F.lit(None).cast("array<long>") if keys is None else F.collect_set("key")
        known = placed.join(sizes.select("of_key"), F.col("key") == F.col("of_key"), "left_semi").groupBy("node").agg(own_keys.alias("keys"))
        known = materialise(known.join(self.places.select("node", "mark"), "node"), "own-keys")
        known = known.join(among(self.sketches, "mark", known.select("mark")).hint("merge"), "mark").drop("mark")
        rows = rows.join(known, "node").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "node")
        rows = rows.select(F.xxhash64("key", "low", "high").alias("group"), "key", "node", "n", "label", "side", "sketch", "keys")
        percent, every = self.percent, keys is not None

        def owned(group: pa.Table, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            key, held = group.column("key")[0].as_py(), group.column("keys").combine_chunks()

            @lru_cache(maxsize=None)
            def smaller(at: int) -> set[int]:
                found = held[at].values.to_numpy()
                return set(found[found < key].tolist())

            for x, y in pairs:
                here = np.fromiter((smaller(i).isdisjoint(smaller(j)) for i, j in zip(x.tolist(), y.tolist())), bool, len(x))
                yield x[here], y[here]

        def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _runs(batches, "group"):
                key, nodes, ns, labels, sides = (group.column(c).to_numpy().astype(np.int64) for c in ("key", "node", "n", "label", "side"))
                if (labels == labels[0]).all():
                    continue
                pairs = live_pairs(ns, labels, sides, group.column("sketch").to_pylist(), percent)
                for x, y in owned(group, pairs) if every else forest(labels, pairs):
                    if not len(x):
                        continue
                    flip = nodes[x] > nodes[y]
                    x, y = np.where(flip, y, x), np.where(flip, x, y)
                    columns = key[x], nodes[x], nodes[y], ns[x].astype(np.int32), ns[y].astype(np.int32)
                    yield pa.record_batch(list(columns), schema=schema_of(f"key long, {PAIRS}"))

        found = materialise(rows.mapInArrow(live, f"key long, {PAIRS}"), "live")
        new = found.select("u", "v", "n", "m").distinct()
        for tested in self.tested:
            new = new.join(tested, ["u", "v"], "left_anti")
        self.verify(materialise(new, "new"), True)
        if every:
            return None
        no_link = reduce(DataFrame.unionByName, self.tested)
        return materialise(found.join(no_link, ["u", "v"], "left_semi").select("key").distinct(), "unsettled")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one value of ``key``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                if held and values[a] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                last = values[a]
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """A row per document: ``doc_id``, ``n_shingles`` and ``component_id``.

    Two documents are linked if their sets of different ``size``-word shingles (all words, if there are fewer)
    have a Jaccard similarity of at least ``percent`` hundredths; ``component_id`` is the smallest ``doc_id`` that
    links reach, the document's own included (null ids come last). A text that is null, empty or without words
    has an empty set and is linked with nothing. Rows that repeat an id or a text are documents of their own. An
    empty table gives an empty result. Sets are told apart by 64-bit hashes of them. The result is saved.
    """
    if not 60 <= percent <= 100:
        raise ValueError("percent must lie between 60 and 100: sets that differ in more than they share fill too few blocks")
    with stages(docs.sparkSession) as run:
        texts = id_and_text(docs, id_col, text_col)
        tagged = materialise(tag(texts, size, percent), "tagged")
        rows = tagged.select(F.explode("keys").alias("key"), "node", "n")
        sampled = tagged.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select(F.explode("keys").alias("key"))
        groups = meeting(rows, sampled)
        join = _Join(texts, tagged, groups, size, percent)
        for number in range(STAR_ROUNDS):
            join.star(number)
        unsettled = join.left()
        if not unsettled.isEmpty():
            join.left(unsettled)
        roots = join.labels().select(F.col("node").alias("of_node"), "root")
        nodes = tagged.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
        rooted = nodes.join(roots, F.col("node") == F.col("of_node"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        rooted = materialise(rooted, "rooted")
        least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
        of_node = materialise(rooted.join(least, "root").select(F.col("node").alias("of_node"), "component_id"), "of-node")
        found = tagged.join(of_node, (F.col("node") == F.col("of_node")) & (F.col("n") > 0), "left")
        own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return run.keep(found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id")), "similar")
