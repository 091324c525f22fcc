"""Phrase collocations and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from marquee.llm import collocations, importance
from marquee.llm.queries import QUERIES
from tests.llm import brute

# --- importance resampling ---------------------------------------------------------------------------------------


def features(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text or ""))
    runs = [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]
    return len(found), [zlib.crc32(run.encode()) % 10000 for run in runs]


def resampled(docs, target, percent=5, least=20):
    every = [features(text) for _, text in docs]
    s, t = Counter(b for _, f in every for b in f), Counter(b for text in target for b in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    rows = []
    for (doc_id, _), (n_words, found) in zip(docs, every):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) for b in found)
        rows.append((doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(*r, i + 1) for i, r in enumerate(able[: len(able) * percent // 100])]
    left = Counter(rows) - Counter(r[:5] for r in drawn)
    return Counter(drawn) + Counter((*r, None) for r in left.elements())


def test_resampling_query_equals_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{brute.SF_DIR}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{brute.SF_DIR}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, brute.SF_DIR)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = resampled(docs, target)
    assert Counter(map(tuple, got.collect())) == Counter({(r[0], *r[2:]): n for r, n in expected.items()})
    assert sum(r[5] is not None for r in expected) > 5


@pytest.mark.parametrize("block", [1 << 20, 7, 1])
def test_resampling_of_hard_rows(spark, monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK_BYTES", block)
    rows = [r for r in brute.hard_rows() if len(r[1] or "") < 10_000 or block > 7]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, bucket string, _place int").repartition(3)
    target = spark.createDataFrame([("one two three",), (None,), ("",)], "text string")
    # Blocks are set in the tasks' own process, so the features are compared here.
    for _, text in rows:
        found = list(importance.feature_sums((text or "").encode()))
        n_words, buckets = features(text)
        assert sum(n for n, _ in found) == n_words
        assert Counter(c % 10000 for _, sums in found for c in sums) == Counter(buckets)
    if block > 7:
        got = importance.resample(docs, target, percent=50, least_words=2)
        assert Counter(map(tuple, got.collect())) == resampled(rows, ["one two three"], 50, 2)
        assert importance.resample(docs.limit(0), target).count() == 0
        assert importance.resample(docs, target.limit(0)).count() == len(rows)


# --- phrase collocations -----------------------------------------------------------------------------------------


def phrases(docs, most=2000, least=30, longest=4, covered=80):
    """(lang, rank, phrase, a, l, r, n, score) by the definition, from every count."""
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    named = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    gone = set()
    for (lang, words), n in named.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if 100 * n >= covered * named[part]:
                    gone.add(part)
    out = []
    for lang in total:
        rows = []
        for (of, words), a in named.items():
            if of == lang and (of, words) not in gone:
                cuts = [(counts[of, words[:k]], counts[of, words[k:]]) for k in range(1, len(words))]
                score, _, l, r = min((2000000 * a // (l + r), i, l, r) for i, (l, r) in enumerate(cuts))
                rows.append((-score, -a, " ".join(words).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def made_up(seed, n, vocabulary=40, idioms=12):
    """Texts in which some runs of words come back far more often than chance."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    fixed = [[rng.choice(words) for _ in range(rng.randint(2, 6))] for _ in range(idioms)]
    docs = []
    for _ in range(n):
        out = []
        for _ in range(rng.randint(3, 30)):
            out += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(words)]
            if rng.random() < 0.1:
                out[-1] += rng.choice(".,;:!?\n\r")
        docs.append((" ".join(out).upper() if rng.random() < 0.2 else " ".join(out), rng.choice(["en", "de", None, ""])))
    return docs


@pytest.mark.parametrize("most, longest", [(5, 4), (40, 4), (2000, 4), (10, 3), (10, 2), (25, 5)])
def test_collocations_equal_all_counts(spark, most, longest):
    docs = made_up(most + longest, 800)
    expected = phrases(docs, most, 10, longest)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(6)
    got = collocations.collocations(df, most=most, least=10, longest=longest)
    assert sorted(map(tuple, got.collect())) == expected
    assert len({r[0] for r in expected}) == 4


def test_frontier_widens_until_enough_survive(spark, monkeypatch):
    """The best pairs of words lie in longer phrases, so the first frontier does not settle the language."""
    rng = random.Random(8)
    fixed = [" ".join(f"p{i}x{k}" for k in range(4)) for i in range(40)]
    loose = lambda: " ".join(rng.choice("abcdefghij") for _ in range(60))
    docs = [(". ".join(rng.choices(fixed, k=20)) + ". " + loose(), "en") for _ in range(400)]
    rounds = []
    monkeypatch.setattr(collocations, "AHEAD", 1)
    plain = collocations.settle
    monkeypatch.setattr(collocations, "settle", lambda *args: rounds.append(1) or plain(*args))
    df = spark.createDataFrame(docs, "text string, lang string").repartition(4)
    got = collocations.collocations(df, most=100, least=30)
    assert sorted(map(tuple, got.collect())) == phrases(docs, 100, 30)
    assert len(rounds) > 1


def test_collocations_of_small_bitmaps(spark, monkeypatch):
    """Chance hits of a crowded bitmap cost work and change nothing."""
    monkeypatch.setattr(collocations, "BITMAP_BITS", 7)
    docs = made_up(3, 300)
    keys = collocations.word_keys(collocations.hashes([b"a", b"b"]), "en")
    assert not collocations.marked(keys[2:], collocations.Bitmap(~collocations.np.zeros(2, "u8"))).any()
    df = spark.createDataFrame(docs, "text string, lang string").repartition(2)
    got = collocations.collocations(df, most=20, least=10)
    assert sorted(map(tuple, got.collect())) == phrases(docs, 20, 10)


def test_collocations_of_hard_rows(spark):
    rows = [(text, None if i % 3 else "x", "k", 5) for i, (_, text) in enumerate(brute.hard_rows())]
    rows += [("Ünder the Hill, \tthe HILL\x0bthe hill é é", "x", "k", 5)] * 40
    docs = spark.createDataFrame(rows, "text string, lang string, key string, n int").repartition(3)
    got = collocations.collocations(docs)
    assert sorted(map(tuple, got.collect())) == phrases([r[:2] for r in rows])
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    rows = spark.createDataFrame([(10**15, [3 * 10**15, 10**15], [10**15, 5 * 10**15])], "n long, lefts array<long>, rights array<long>")
    cut = rows.select(collocations.best_cut().alias("cut")).first().cut
    assert (cut.score, cut.at, cut.l, cut.r) == (2000000 * 10**15 // (6 * 10**15), 1, 10**15, 5 * 10**15)
