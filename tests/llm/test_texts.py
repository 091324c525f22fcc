"""Tokens, records, packing, quality, secrets, segmentation."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import nbest, packing, quality, records, secrets
from marquee.llm.queries import QUERIES
from marquee.llm.tokens import WordEncoder, vocabulary
from tests.llm import brute


@pytest.fixture(scope="module")
def hard(spark):
    return brute.hard_docs(spark).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{brute.SF_DIR}/documents.parquet").collect()}


def test_word_encoder_equals_the_library():
    random.seed(1)
    parts = ["a", "B", "é", " ", " ", "\n", "\t", "\r", "'s", "\u00a0", "9", "!", "_", "中", "\x1c", "\u2028", "don't", "\x00", "word", "  "]
    texts = ["".join(random.choices(parts, k=random.randrange(30))) for _ in range(3000)] + [t or "" for t in brute.HARD_TEXTS]
    special = "<|endoftext|>"
    texts += ["".join(random.choices([*parts, special, special[:5], special[5:]], k=random.randrange(1, 20))) for _ in range(2000)]
    for escape in (False, True):
        encoder, expected = WordEncoder(vocabulary(), escape), [np.array(x, "<u4").tobytes() for x in brute.tokens(texts, escape)]
        for _ in range(2):  # the second time from memory
            assert encoder.encode(texts) == expected
    assert brute.tokens(["a <|endoftext|> b"])[0] != brute.tokens(["a <|endoftext|> b"], True)[0]


# --- records ---


def slow_crc32c(data: bytes) -> int:
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    return state ^ 0xFFFFFFFF


def test_checksums():
    assert records.crc32c([b"123456789"])[0] == 0xE3069283
    values = [bytes(range(256)) * 5, b"abcd", b"x" * 512, b"y" * 513]
    assert records.crc32c(values).tolist() == [slow_crc32c(v) for v in values]


def test_records_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op1_token_records"](spark, brute.SF_DIR).collect()}
    start = 0
    for doc_id, ids in zip(sorted(documents), brute.tokens([documents[i] for i in sorted(documents)])):
        ids = [*ids, 0]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32, r.intact) == (start, len(ids), brute.crc(ids), True)
        start += len(ids)
    assert len(got) == len(documents)


def test_records_of_hard_rows(spark, hard, tmp_path):
    path = f"file://{tmp_path}/out"
    records.write_records(hard, path, end_id=7)
    read = records.read_records(spark, path)
    rows = records.with_global_starts(read, records.read_index(spark, path)).orderBy("start").collect()
    texts = brute.hard_rows()
    assert len(rows) == len(texts) and all(r.intact for r in rows)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    expected = Counter((d, np.array([*x, 7], "<u4").tobytes()) for (d, _), x in zip(texts, brute.tokens([t or "" for _, t in texts])))
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == expected
    shuffled = records.shuffled_records(spark, path, 3)
    assert Counter((r.doc_id, bytes(r.ids)) for r in shuffled.collect()) == expected
    order = [r.position for r in shuffled.collect()]
    assert order == [r.position for r in records.shuffled_records(spark, path, 3).collect()] != sorted(order)
    # A changed byte is seen.
    file = next((tmp_path / "out" / "shards").iterdir())
    data = bytearray(file.read_bytes())
    data[-5] ^= 1
    file.write_bytes(bytes(data))
    assert records.read_records(spark, path).where("not intact").count() == 1


def test_no_records(spark, hard, tmp_path):
    path = f"file://{tmp_path}/none"
    records.write_records(hard.limit(0), path)
    assert records.read_records(spark, path).count() == 0


# --- packing ---


def check_packing(rows, texts: list[tuple], end: int, capacity: int):
    by_doc = Counter()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    expected, total = Counter(), 0
    for (doc_id, _), ids in zip(texts, brute.tokens([t or "" for _, t in texts])):
        ids, start = [*ids, end], 0
        total += len(ids)
        count = -(-len(ids) // capacity)
        for piece in range(count):
            length = len(ids) - capacity * (count - 1) if piece == 0 else capacity
            expected[doc_id, piece, start, length, brute.crc(ids[start : start + length])] += 1
            start += length
    assert by_doc == expected
    return len(places), -(-total // capacity)


def test_packing_query(spark, documents):
    rows = QUERIES["op4_residual_packing"](spark, brute.SF_DIR).collect()
    used, least = check_packing(rows, list(documents.items()), 2, 1024)
    assert used <= least * 1.02 + 1


def test_packing_of_hard_rows(spark, hard):
    packed = packing.pack_documents(hard, capacity=16, end_id=2)
    used, least = check_packing(packed.collect(), brute.hard_rows(), 2, 16)
    assert used <= least * 1.05 + 1
    whole = packing.sequences(packed).collect()
    assert len(whole) == used and all(len(r.ids) == 4 * sum(d.length for d in r.docs) for r in whole)
    assert packing.pack_documents(hard.limit(0)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    sizes = np.array([6, 5, 4, 3, 2])
    bins, offsets, filled = packing.best_fit(np.arange(5), sizes, 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and filled.tolist() == [10] * 5


def test_rounds_merge_what_partitions_leave(spark):
    # Each partition alone leaves half-empty sequences; groups are smaller than the number of items.
    pieces = spark.range(4000, numPartitions=40).select(F.col("id").alias("piece_key"), (300 + F.col("id") % 41 * 5).alias("length"))
    placed = packing.pack(pieces, 1000, group_items=150).collect()
    total = sum(300 + i % 41 * 5 for i in range(4000))
    assert len(placed) == 4000 and len({r.sequence_id for r in placed}) <= total / 1000 * 1.35
    halves = spark.range(1000, numPartitions=4).select(F.col("id").alias("piece_key"), F.lit(501).cast("long").alias("length"))
    assert len({r.sequence_id for r in packing.pack(halves, 1000, group_items=50).collect()}) == 1000


# --- quality ---


def base_of(text: str) -> tuple:
    words = brute.WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if brute.WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_quality_query(spark, documents):
    rows = QUERIES["op6_likelihood_quality"](spark, brute.SF_DIR).collect()
    assert len(rows) == len(documents)
    for r in rows:
        base = base_of(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.base_failed and r.kept)


def test_held_out_labels_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(3)) == 0
    model = quality.fit(docs, labels.where(~held_out))
    judged = quality.verdicts(docs, model).join(labels.where(held_out), "doc_id").where("not base_failed")
    shares = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] >= 0.98 and shares[0] <= 0.1


def scored(docs: dict, labels: list, bits: int) -> tuple[dict, float]:
    """Score of every document and the threshold, from plain counts."""

    def grams(text):
        hashes = [xxhash.xxh64_intdigest(w.encode()) for w in brute.WORD.findall(text or "")]
        pairs = [(a * 31 + b) % 2**64 for a, b in zip(hashes, hashes[1:])]
        return [h * 0x9E3779B97F4A7C15 % 2**64 >> (64 - bits) for h in hashes + pairs]

    kinds, halves = {}, {}
    for doc_id, kind, half in labels:
        kinds[doc_id], halves[doc_id] = kind, half
    corpus, good = Counter(), Counter()
    for doc_id, text in docs.items():
        corpus.update(grams(text))
        if kinds.get(doc_id) == 1 and halves[doc_id] == 0:
            good.update(grams(text))
    usual = sum(good.values()) / sum(corpus.values())
    weight = {b: math.log((good[b] + 10 * usual) / (n + 10) / usual) for b, n in corpus.items()}
    scores = {i: sum(weight[b] for b in g) / len(g) if (g := grams(t)) else 0.0 for i, t in docs.items()}
    judged = [(round(scores[i] * 1000), k) for i, k in kinds.items() if i in docs and (k == 0 or halves[i] == 1)]
    trusted, poor = [s for s, k in judged if k], [s for s, k in judged if not k]
    costs = [(5 * sum(s < t for s in trusted) / len(trusted) + sum(s >= t for s in poor) / len(poor), t) for t in sorted({s for s, _ in judged})]
    least, at = min(costs)
    return scores, (at - 0.5) / 1000 if least < 1 else -math.inf


def test_every_score_and_verdict_equals_plain_python(spark, documents):
    labels = spark.read.parquet(f"{brute.SF_DIR}/labels.parquet")
    known = [tuple(r) for r in quality.labelled(labels).collect()]
    bits = quality.bucket_bits(sum(len((t or "").encode()) for t in documents.values()))
    scores, least = scored(documents, known, bits)
    rows = QUERIES["op6_likelihood_quality"](spark, brute.SF_DIR).collect()
    assert least > -math.inf and 0 < sum(r.kept for r in rows) < len(rows)
    for r in rows:
        assert r.score == pytest.approx(scores[r.doc_id], abs=1e-5)
        assert abs(r.score - least) < 1e-5 or r.kept == (not r.base_failed and scores[r.doc_id] >= least)


def test_labels_over_the_broadcast_limit_give_the_same_model(spark):
    docs, labels = (spark.read.parquet(f"{brute.SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    one, two = quality.fit(docs, labels), quality.fit(docs, labels, most_broadcast=0)
    assert (one.bits, one.usual, one.threshold) == (two.bits, two.usual, two.threshold)
    weights = one.weights.copy()
    assert (weights == two.weights).all() and weights.any()


def test_all_labels_set_the_threshold(spark, monkeypatch):
    """Far more labels than the 100,000 of a bounded sample; the poor ones score alike, so each must be counted."""
    n = 160_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "good words here").otherwise("poor words there").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    counted, threshold = [], quality.threshold
    monkeypatch.setattr(quality, "threshold", lambda found: counted.append(sum(n for _, _, n in found)) or threshold(found))
    quality.fit(docs, labels, most_broadcast=1000)
    assert counted == [quality.labelled(labels).where("trusted = 0 OR half = 1").count()] and counted[0] > n * 0.7


def test_counts_travel_packed():
    """Counts of a task take about a byte a bucket once compressed, and large ones come back whole."""
    rng = np.random.default_rng(3)
    counts = rng.geometric(0.1, quality.PIECE).astype(np.int32)
    counts[5] = 2**31 - 1
    data = quality.packed(counts)
    assert (quality.unpacked(data) == counts).all() and quality.packed(counts * 0) == b""
    assert len(pa.compress(data, "lz4", asbytes=True)) < 1.3 * quality.PIECE
    batch = pa.record_batch([[3, 3, 4], [data, data, data], [b"", data, b""]], schema=quality.schema_of(quality.PIECES))
    sums = pa.Table.from_batches(quality.add_pieces([batch])).to_pydict()
    assert sums["bucket"] == [*range(3 * quality.PIECE, 5 * quality.PIECE)]
    assert sums["corpus"] == [*(2 * counts.astype(int)).tolist(), *counts.tolist()] and sums["trusted"] == [*counts.tolist(), *[0] * quality.PIECE]


def test_buckets_grow_with_the_corpus():
    bits = [quality.bucket_bits(n) for n in (0, 10**8, 10**9, 3 * 10**10, 10**14)]
    assert bits == [8, 18, 20, 22, 26]


def test_quality_of_hard_rows(spark, hard):
    labels = spark.createDataFrame([(11, 1, None), (10, 0, 0), (None, 1, 0), (11, 1, 0), (5, None, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(hard, labels)
    rows = quality.verdicts(hard, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in brute.hard_rows())
    texts = dict(brute.hard_rows())
    assert all(base_of(texts[r.doc_id] or "")[:1] == (r.n_words,) for r in rows if r.doc_id not in (None, 7))
    assert quality.verdicts(hard.limit(0), quality.fit(hard.limit(0), labels.limit(0))).count() == 0
    kept = quality.keep_good(hard, model)
    assert kept.schema == hard.schema and kept.count() == sum(r.kept for r in rows)


# --- secrets ---

SECRET = 'password="hunter2hunter2hunter2"'


def url(text):
    return urllib.parse.quote(text, safe="")


def escaped(text):
    return "".join(f"\\u{ord(c):04x}" for c in text)


def b64(text):
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


@pytest.mark.parametrize(
    "coded",
    [
        url(SECRET),
        escaped(SECRET),
        b64(SECRET),
        b64(gzip.compress(SECRET.encode())),
        b64(zlib.compress(SECRET.encode())),
        url(url(SECRET)),
        url(b64(gzip.compress(b64(SECRET).encode()))),
        escaped(b64(zlib.compress(escaped(SECRET).encode()))),
    ],
)
def test_nested_secrets_are_found_where_they_stand(coded):
    text = f"é🙂 before {coded} after"
    spans = [s for s in secrets.find(text) if s[0] == "assign" and s[3]]
    assert len(spans) == 1
    _, start, end, _ = spans[0]
    at = text.index(coded)
    assert at <= start < end <= at + len(coded) and end - start >= len(coded) - 8
    masked = secrets.mask(text)
    assert "[SECRET]" in masked and masked.startswith("é🙂 before ") and masked.endswith(" after")


def test_clean_texts_and_loops():
    for text in ("Thereforetheinternationalization of everything", "100%25 sure", "C:\\users\\x41", b64("just words, no more")):
        assert secrets.find(text) == []
    # A layer that decodes to itself ends its chain.
    assert secrets.find("%25" * 50) == []
    assert secrets.find("a" * 40) == [("hex", 0, 40, "")]
    bomb = b64(gzip.compress(b" " * 30_000_000 + SECRET.encode()))
    assert [s[0] for s in secrets.find(f"x {bomb} y")] == ["assign"]


def base_spans(text: str) -> str:
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def test_secret_query(spark, documents):
    for r in QUERIES["op10_secret_worklist"](spark, brute.SF_DIR).collect():
        base = base_spans(documents[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(f"{k}:") for k in secrets.KINDS)
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_secrets_of_hard_rows(spark, hard):
    found = secrets.find_secrets(hard, with_text=True).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in brute.hard_rows())
    for r in found:
        base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if not s.layers)
        assert base == base_spans(r.text)
    masked = secrets.mask_secrets(hard)
    assert masked.schema == hard.schema and masked.where("text is null").count() == 1
    assert masked.where("text like '%deadbeef%' or text like '%AKIA%'").count() == 0
    assert secrets.find_secrets(hard.limit(0)).count() == 0


# --- n-best ---


def small_lattice() -> nbest.Lattice:
    pieces = {"a": -3, "b": -4, "ab": -6, "ba": -5, "aba": -7, "▁": -2, "▁a": -4, "▁ab": -8, "▁▁": -9}
    return nbest.Lattice({p: (i, s) for i, (p, s) in enumerate(pieces.items(), 1)}, list(range(100, 356)))


def every_path(lattice: nbest.Lattice, text: str) -> list[tuple[int, bytes]]:
    out = []

    def go(at: int, score: int, ids: bytes) -> None:
        if at == len(text):
            out.append((score, ids))
        else:
            for end, more in lattice.edges(text, at):
                go(end, score + more, ids + lattice.piece_ids(text[at:end]))

    go(0, 0, b"")
    return sorted(out, key=lambda x: -x[0])


def test_picks_are_those_of_the_whole_product_and_few():
    for sizes, n in [([2, 3, 1], 4), ([4, 4, 4], 5), ([1], 3), ([], 2), ([5, 2, 5, 5], 6)]:
        whole = [p for p in itertools.product(*(range(min(s, n)) for s in sizes)) if np.prod([k + 1 for k in p]) <= n]
        assert sorted(nbest._picks(sizes, n)) == whole
    assert len(list(nbest._picks([12] * 11, 12))) < 5_000


def test_nbest_equals_every_path_in_order():
    lattice = small_lattice()
    random.seed(2)
    for _ in range(1500):
        text = "".join(random.choices("ab c", weights=(5, 5, 2, 1), k=random.randrange(1, 9)))
        n = random.randrange(1, 7)
        expected, got = every_path(lattice, "▁" + text.replace(" ", "▁")), lattice.nbest([text], n)[0]
        assert [s for s, _ in got] == [s for s, _ in expected[:n]]
        assert len(set(got)) == len(got) and set(got) <= set(expected)
        assert all(lattice.decode(ids) == text for _, ids in got)


def test_nbest_of_fractional_scores_equals_every_path():
    pieces = {"a": -3.25, "b": -3.375, "ab": -6.5, "ba": -6.75, "aba": -9.8125, "▁": -2.4, "▁a": -5.5, "▁ab": -8.9, "▁▁": -4.9}
    lattice = nbest.Lattice({p: (i, s) for i, (p, s) in enumerate(pieces.items(), 1)}, list(range(100, 356)))
    assert lattice.unit == nbest.FRACTION and small_lattice().unit == 1
    random.seed(3)
    for _ in range(500):
        text = "".join(random.choices("ab c", weights=(5, 5, 2, 1), k=random.randrange(1, 9)))
        expected, got = every_path(lattice, "▁" + text.replace(" ", "▁")), lattice.nbest([text], 5)[0]
        assert [s for s, _ in got] == [s for s, _ in expected[:5]]
        assert len(set(got)) == len(got) and set(got) <= set(expected)
    score = lattice.nbest(["aba"], 1)[0][0][0] / nbest.FRACTION
    assert score == pytest.approx(max(-2.4 - 9.8125, -5.5 - 6.75, -8.9 - 3.25, -5.5 - 3.375 - 3.25), abs=1e-5)


def test_nbest_of_the_query_equals_every_path_on_short_texts(spark, documents):
    lattice = nbest.lattice(nbest.model_file())
    words = sorted({w[:7] for t in documents.values() for w in t.split()[:40]})[::40]
    assert len(words) > 20
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    rows = nbest.nbest_segments(docs, n=4).collect()
    for i, word in enumerate(words):
        expected = every_path(lattice, "▁" + word)
        got = [(r.score, bytes(r.ids)) for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r["rank"])]
        assert [s for s, _ in got] == [s for s, _ in expected[:4]] and set(got) <= set(expected)


def test_nbest_query_and_hard_rows(spark, hard, documents):
    rows = QUERIES["op8_nbest_segments"](spark, brute.SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(documents) and all(r.round_trip for r in rows)
    got = nbest.nbest_segments(hard, 3).collect()
    assert {r.doc_id for r in got} == {i for i, _ in brute.hard_rows()} and all(r.round_trip for r in got)
    for _, group in itertools.groupby(sorted((r for r in rows), key=lambda r: (r.doc_id, r.rank)), key=lambda r: r.doc_id):
        scores = [r.score for r in group]
        assert scores == sorted(scores, reverse=True)
    assert nbest.nbest_segments(hard.limit(0)).count() == 0
