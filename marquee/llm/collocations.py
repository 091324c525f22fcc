"""Phrase collocations by best-first branch and bound over growing prefixes.

A phrase scores its count over the sum of the counts of its two parts, at the cut where that is
lowest. With a first word of count f and a prefix of count p, no phrase that goes on from the prefix
can score above p / (f + p): its own count is at most p, and its rest counts at least as often as it
does. So all pairs of frequent words are counted first; then, per language, the frontier of prefixes
is opened from the best bound down to a threshold, and only what goes on from an open prefix is
counted. Every phrase that scores at least the threshold is then known. Phrases that one word more
covers are dropped; where fewer than the wanted number survive, the threshold falls and the frontier
is opened further, until the last wanted score and its ties are settled in every language.

Words and phrases are 64-bit hashes while they are counted; a phrase is the pair of the hashes of its
prefix and suffix, so counts of all parts come from joins. Open prefixes reach the tasks as bitmaps of
a fixed size: a chance hit counts a phrase too many, which the joins drop, and none is lost. Texts
of the phrases that are reported are read again at the end.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import byte_rows, hold, materialise, schema_of
from marquee.operators.ranks import ranks
from marquee.session import stages

#: Bits of a bitmap of hashes: 4 MB, whatever the corpus.
BITMAP_BITS = 25
#: A task counts the phrases of so many words at once.
GROUP_WORDS = 4_000_000
#: The same where the words themselves are held.
NAMED_WORDS = 300_000
#: Words whose hash a worker remembers.
HELD_WORDS = 500_000
SCALE = 2_000_000
#: The frontier is first opened for so many times the wanted phrases, and for so many times more in each round.
AHEAD, WIDEN = 3, 4

#: Ends of pieces become a byte that UTF-8 never has; A-Z become lower case.
END = b"\xff"
TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
COUNTED = "prefix long, suffix long, n long"
NAMED = "key long, phrase string"


# --- words and hashes within a task --------------------------------------------------------------------------


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, and ``END`` where a piece ends."""
    return text.translate(TABLE).replace(END, b" \xff ").split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word) or 1
        return found


_WORDS = _Hashes()


def hashes(found: list[bytes]) -> np.ndarray:
    """Hashes of words; zero for ``END``, and one zero after the last word."""
    if len(_WORDS) > HELD_WORDS:
        _WORDS.clear()
    _WORDS[END] = 0
    out = np.zeros(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31)) | np.uint64(1)


def word_keys(words: np.ndarray, lang: str) -> np.ndarray:
    """Keys of the words of a language; zero where there is none."""
    return np.where(words != 0, _mix(words ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))), np.uint64(0))


def longer(keys: np.ndarray) -> np.ndarray:
    """Keys of the phrases one word longer than those at each place: of a prefix and the suffix beside it."""
    return phrase_keys(keys[:-1], keys[1:])


def phrase_keys(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    found = _mix(prefix * np.uint64(0x9E3779B97F4A7C15) ^ (suffix >> np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return np.where((prefix != 0) & (suffix != 0), found, np.uint64(0))


class Bitmap:
    """A set of hashes as bits. It travels to the tasks compressed, so one with few bits is small."""

    def __init__(self, words: np.ndarray):
        self.data = zlib.compress(words.tobytes(), 1)
        self._words: np.ndarray | None = words

    def __getstate__(self) -> dict:
        return {"data": self.data, "_words": None}

    @property
    def words(self) -> np.ndarray:
        if self._words is None:
            self._words = np.frombuffer(zlib.decompress(self.data), np.uint64)
        return self._words


def marked(keys: np.ndarray, bitmap: Bitmap) -> np.ndarray:
    """Which of the keys a bitmap may hold; never false for one that it does."""
    words = bitmap.words
    at = keys >> np.uint64(65 - (64 * len(words)).bit_length())
    return (keys != 0) & ((words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) != 0)


def _grouped(batches: Iterator[pa.RecordBatch], most: int = GROUP_WORDS) -> Iterator[tuple[str, np.ndarray]]:
    """Word hashes by language, of many documents at a time."""
    hold("collocations", _WORDS.clear)
    held: dict[str, list[np.ndarray]] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), byte_rows(batch.column("text"))):
            held.setdefault(lang, []).append(hashes(tokens(text)))
            total += len(held[lang][-1])
            if total >= most:
                yield from ((lang, np.concatenate(parts)) for lang, parts in held.items())
                held, total = {}, 0
    yield from ((lang, np.concatenate(parts)) for lang, parts in held.items())


# --- counting --------------------------------------------------------------------------------------------------


def count_words(texts: DataFrame, least: int) -> DataFrame:
    """``lang``, ``key`` and ``n`` of words that occur ``least`` times; under the key 0 all words of the language."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _grouped(batches):
            keys, counts = np.unique(word_keys(words[words != 0], lang), return_counts=True)
            keys, counts = np.append(keys, np.uint64(0)), np.append(counts, counts.sum())
            yield pa.record_batch([[lang] * len(keys), keys.view(np.int64), counts], schema=schema_of("lang string, key long, n long"))

    found = texts.mapInArrow(rows, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    return found.where((F.col("n") >= least) | (F.col("key") == 0))


def count_phrases(texts: DataFrame, size: int, least: int, wanted: Callable[[list[np.ndarray]], np.ndarray]) -> DataFrame:
    """``prefix``, ``suffix`` and ``n`` of phrases of ``size`` words that occur ``least`` times.

    ``wanted`` gets the keys at each place for 1, 2, ... ``size`` - 1 words and says which prefixes go on;
    a phrase's every occurrence must get one answer.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _grouped(batches):
            keys = [word_keys(words, lang)]
            while len(keys) < size - 1:
                keys.append(longer(keys[-1]))
            parts = keys[-1]
            go = np.flatnonzero(wanted(keys) & (parts[:-1] != 0) & (parts[1:] != 0))
            _, first, counts = np.unique(phrase_keys(parts[go], parts[go + 1]), return_index=True, return_counts=True)
            at = go[first]
            yield pa.record_batch([parts[at].view(np.int64), parts[at + 1].view(np.int64), counts], schema=schema_of(COUNTED))

    found = texts.mapInArrow(rows, COUNTED).groupBy("prefix", "suffix").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= least)


def bitmap_of(df: DataFrame) -> Bitmap:
    """The keys of ``df`` as a bitmap; the driver gets at most a number per 64 bits of it."""
    at = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    words = df.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {64 - BITMAP_BITS}) & 63))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bitmap(out)


def _keyed(df: DataFrame) -> DataFrame:
    """``df`` with the ``key`` of its phrases."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, suffix = (batch.column(c).to_numpy().view(np.uint64) for c in ("prefix", "suffix"))
            keys = pa.array(phrase_keys(prefix, suffix).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], schema=batch.schema.append(pa.field("key", pa.int64())))

    return df.mapInArrow(rows, df.select("*", F.lit(0).cast("long").alias("key")).schema)


def scored(counted: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases with ``lang``, ``lefts`` and ``rights`` (counts of their first 1, 2, ... words and of the rest), the
    best ``cut``, ``score``, and the ``bound`` of all that go on from them. ``parts`` are those one word shorter;
    a phrase with a part that is not among them is left out."""
    heads = parts.select(F.col("key").alias("prefix"), "lang", "lefts", F.col("n").alias("head"))
    tails = parts.select(F.col("key").alias("suffix"), "rights", F.col("n").alias("tail"))
    rows = counted.join(heads, "prefix").join(tails, "suffix").select(
        "lang",
        "key",
        "prefix",
        "suffix",
        "n",
        F.concat("lefts", F.array("head")).alias("lefts"),
        F.concat(F.array("tail"), "rights").alias("rights"),
    )
    return rows.withColumn("cut", best_cut()).withColumn("score", F.col("cut.score")).withColumn("bound", ratio(F.col("n"), F.col("lefts")[0] + F.col("n")))


def ratio(count: Column, others: Column) -> Column:
    """``floor(SCALE * count / others)``; the product has up to 38 digits."""
    return F.call_function("div", count.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)"), others.cast("decimal(20,0)"))


def best_cut() -> Column:
    """The lowest score over all cuts, the shortest first part of equal ones."""
    cuts = F.zip_with("lefts", "rights", lambda left, right: F.struct(ratio(F.col("n"), left + right).alias("score"), left.alias("l"), right.alias("r")))
    placed = F.transform(cuts, lambda cut, at: F.struct(cut["score"].alias("score"), at.alias("at"), cut["l"].alias("l"), cut["r"].alias("r")))
    return F.array_min(placed)


# --- the search ------------------------------------------------------------------------------------------------


def thresholds(pairs: DataFrame, want: int) -> DataFrame:
    """``lang`` and the score ``least_score`` that ``want`` pairs of words reach; 0 if there are fewer.

    The running sum is over a row per different score, of which a language has at most ``SCALE`` / 2 + 1.
    """
    by_score = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("some"))
    down = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    reached = by_score.withColumn("above", F.sum("some").over(down))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("above") >= want, F.col("score"))), F.lit(0)).alias("least_score"))


def settle(texts: DataFrame, pairs: DataFrame, frequent: Bitmap, floor: DataFrame, least: int, longest: int, covered: int) -> DataFrame:
    """All surviving phrases of the languages of ``floor`` that score at least its ``least_score``.

    Level by level: phrases that go on from an open prefix (its bound reaches the threshold), and phrases that
    end in one that reaches it, as they may cover it, are counted.
    """

    def reach(level: DataFrame, what: str) -> DataFrame:
        return level.join(floor, "lang").where(F.col(what) >= F.col("least_score"))

    level, found = pairs, [reach(pairs, "score").drop("least_score")]
    covers: list[DataFrame] = []
    for size in range(3, longest + 1):
        opened, ended = bitmap_of(reach(level, "bound")), bitmap_of(reach(level, "score"))

        def wanted(keys: list[np.ndarray], opened=opened, ended=ended) -> np.ndarray:
            known = _frequent_pairs(keys, frequent)
            return known & (marked(keys[-1][:-1], opened) | marked(keys[-1][1:], ended))

        counted = materialise(_keyed(count_phrases(texts, size, least, wanted)), "counted")
        covers += [counted.select(F.col(end).alias("key"), F.col("n").alias("most")) for end in ("prefix", "suffix")]
        if size > 3:
            # Ends of these phrases that no open prefix led to are needed for their scores.
            on = counted.join(level.select(F.col("key").alias("prefix")), "prefix", "left_semi")
            ends = on.select(F.col("suffix").alias("key")).distinct().join(level.select("key"), "key", "left_anti")
            lacking = bitmap_of(materialise(ends, "ends"))

            def asked(keys: list[np.ndarray], lacking=lacking) -> np.ndarray:
                return marked(longer(keys[-1]), lacking)

            more = _keyed(count_phrases(texts, size - 1, least, asked)) if lacking.words.any() else counted.limit(0)
            more = more.join(ends, "key", "left_semi")
            level = level.unionByName(materialise(scored(more, before), "ends"))
        before, level = level, materialise(scored(counted, level), "level")
        found.append(reach(level, "score").drop("least_score"))
    reached = reduce(DataFrame.unionByName, found)
    if not covers:
        return reached
    most = reduce(DataFrame.unionByName, covers).groupBy("key").agg(F.max("most").alias("most"))
    most = most.withColumnRenamed("key", "covered")
    whole = reached.join(most, F.col("key") == F.col("covered"), "left")
    return whole.where(F.coalesce(F.col("most") * 100 < F.col("n") * covered, F.lit(True))).drop("most", "covered")


def _frequent_pairs(keys: list[np.ndarray], frequent: Bitmap) -> np.ndarray:
    """Where all pairs of neighbouring words of the phrases one word longer than the last keys are frequent."""
    pairs = marked(keys[1], frequent)
    n = len(keys[-1]) - 1
    return reduce(np.logical_and, (pairs[shift : shift + n] for shift in range(len(keys))))


def phrase_texts(texts: DataFrame, chosen: DataFrame, longest: int) -> DataFrame:
    """``key`` and ``phrase`` of the chosen phrases."""
    bitmap = bitmap_of(chosen)

    def names(lang: str, words: list[bytes]) -> pa.RecordBatch:
        """Every chosen phrase among the words, once."""
        keys, found = word_keys(hashes(words), lang), {}
        for size in range(2, longest + 1):
            keys = longer(keys)
            at = np.flatnonzero(marked(keys, bitmap))
            different, first = np.unique(keys[at], return_index=True)
            found |= {key: b" ".join(words[i : i + size]) for key, i in zip(different.tolist(), at[first].tolist())}
        named = pa.array(list(found.values()), pa.binary()).cast(pa.string())
        return pa.record_batch([np.array(list(found), np.uint64).view(np.int64), named], schema=schema_of(NAMED))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("collocations", _WORDS.clear)
        held: dict[str, list[bytes]] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), byte_rows(batch.column("text"))):
                words = held.setdefault(lang, [])
                before = len(words)
                words += tokens(text)
                words.append(END)
                total += len(words) - before
                if total >= NAMED_WORDS:
                    yield from (names(*one) for one in held.items())
                    held, total = {}, 0
        yield from (names(*one) for one in held.items())

    named = texts.mapInArrow(rows, NAMED).join(chosen.select("key"), "key", "left_semi").groupBy("key")
    one = F.min("phrase").alias("phrase"), (F.min("phrase") != F.max("phrase")).alias("several")
    several = F.raise_error(F.concat(F.lit("two phrases have one hash: "), F.col("phrase")))
    return named.agg(*one).select("key", F.when(F.col("several"), several.cast("string")).otherwise(F.col("phrase")).alias("phrase"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = 2000,
    least: int = 30,
    longest: int = 4,
    covered: int = 80,
    unknown: str = "und",
) -> DataFrame:
    """The first ``most`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Candidates are phrases of 2 to ``longest`` words within a piece that occur ``least`` times; one that lies
    in a candidate one word longer with ``covered`` hundredths of its count or more is dropped. They come by
    score, count (both falling) and text (by UTF-8 bytes). A null language counts as ``unknown``, a null text
    as empty; repeated rows count as often as they occur. A language without candidates has no rows, and an
    empty table gives an empty result. The result is saved.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(unknown)).alias("lang")
    texts = docs.select(lang, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    with stages(docs.sparkSession) as run:
        words = materialise(count_words(texts, least), "words")
        every = words.where("key = 0").select("lang", F.col("n").alias("all"))
        none = F.array().cast("array<long>")
        singles = words.where("key <> 0").select("lang", "key", "n", none.alias("lefts"), none.alias("rights"))
        common = bitmap_of(singles)

        def both(keys: list[np.ndarray]) -> np.ndarray:
            known = marked(keys[0], common)
            return known[:-1] & known[1:]

        counted = materialise(_keyed(count_phrases(texts, 2, least, both)), "pairs")
        pairs = materialise(scored(counted, singles), "pairs")
        frequent = bitmap_of(pairs)
        results: list[DataFrame] = []
        pending, want = pairs.select("lang").distinct(), AHEAD * most
        while True:
            floor = materialise(thresholds(pairs.join(pending, "lang", "left_semi"), want), "floor")
            reached = materialise(settle(texts, pairs, frequent, floor, least, longest, covered), "survivors")
            sizes = reached.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
            state = floor.join(sizes, "lang", "left").select(
                "lang", ((F.coalesce("n", F.lit(0)) >= most) | (F.col("least_score") <= 0)).alias("settled")
            )
            state = materialise(state, "state")
            results.append(reached.join(state.where("settled"), "lang", "left_semi"))
            pending, want = state.where("not settled").select("lang"), want * WIDEN
            if not pending.limit(1).count():
                break
        survivors = materialise(reduce(DataFrame.unionByName, results), "survivors")
        last = thresholds(survivors, most).withColumnRenamed("least_score", "last_score")
        chosen = materialise(survivors.join(last, "lang").where("score >= last_score"), "chosen")
        named = chosen.join(phrase_texts(texts, chosen, longest), "key").join(every, "lang")
        placed = materialise(ranks(named, "place", F.asc("lang"), F.desc("score"), F.desc("n"), F.asc("phrase")), "placed")
        first = placed.groupBy("lang").agg(F.min("place").alias("first"))
        rank = (F.col("place") - F.col("first") + 1).alias("rank")
        counts = F.col("n").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("all").alias("n"), "score"
        return run.keep(placed.join(first, "lang").select("lang", rank, "phrase", *counts).where(F.col("rank") <= most), "collocations")
