import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import counted_terms, fit_vocabulary, term_vectors
from marquee.operators import topics as topics_module
from marquee.operators.topics import fit_topic_table, topic_shares, topic_terms
from marquee.session import materialise

THEMES = [[f"{theme}{i}" for i in range(30)] for theme in ("sea", "star", "war")]


def planted(spark, n=240, seed=1):
    """Texts of mostly one theme each, and one without words."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = i % 3
        rows.append((i, [rng.choice(THEMES[own if rng.random() < 0.9 else rng.randrange(3)]) for _ in range(rng.randint(20, 60))]))
    df = spark.createDataFrame([*rows, (n, []), (n + 1, None)], "i long, w array<string>")
    counted = materialise(df.repartition(4).withColumn("w", counted_terms("w")))
    vocabulary = fit_vocabulary(counted, "w")
    return term_vectors(counted, "w", "v", vocabulary, "i", keep_words=False), vocabulary, rows


def test_planted_topics_come_back(spark):
    vectors, vocabulary, rows = planted(spark)
    model = fit_topic_table(vectors, "v", vocabulary.count(), "i", k=3, iterations=40)
    chances = topic_terms(model, vocabulary).collect()
    best = {}
    for topic in range(3):
        top = sorted((r for r in chances if r.topic == topic), key=lambda r: -r.chance)[:25]
        best[topic] = {r.term.rstrip("0123456789") for r in top}
        assert sum(r.chance for r in chances if r.topic == topic) == pytest.approx(1)
    assert sorted(map(sorted, best.values())) == [["sea"], ["star"], ["war"]]
    shares = {r.i: r.s for r in topic_shares(vectors, model, "v", "i").select("i", vector_to_array("topicDistribution").alias("s")).collect()}
    theme_of = {next(iter(v)): t for t, v in best.items()}
    for i, _ in rows:
        assert sum(shares[i]) == pytest.approx(1)
        assert int(np.argmax(shares[i])) == theme_of[("sea", "star", "war")[i % 3]]
    assert shares[240] == shares[241] == [0.0, 0.0, 0.0]


def test_likelihood_rises(spark):
    vectors, vocabulary, _ = planted(spark, 60)
    model = fit_topic_table(vectors, "v", vocabulary.count(), "i", k=3, iterations=25)
    assert len(model.penalised) == 25
    assert all(b >= a - 1e-6 for a, b in zip(model.penalised, model.penalised[1:]))
    assert model.likelihoods[-1] > model.likelihoods[0] + 100


def test_blocks_do_not_change_the_fit(spark, monkeypatch):
    """Many small blocks of texts and terms give the sums that one of each gives."""
    vectors, vocabulary, _ = planted(spark, 90)
    start = lambda data, k: np.frombuffer(data, np.float64).reshape(-1, k)
    found = []
    for term_block in (1 << 16, 7):
        model = fit_topic_table(vectors, "v", vocabulary.count(), "i", k=3, iterations=4, term_block=term_block)
        chances = {(r.topic, r.term): r.chance for r in topic_terms(model, vocabulary).collect()}
        shares = topic_shares(vectors, model, "v", "i").select("i", vector_to_array("topicDistribution").alias("s"))
        found.append((model.parts, chances, {r.i: r.s for r in shares.collect()}, model.likelihoods))
    (one, chances, shares, rising), (many, *others) = found
    assert one == 1 and many == 13 and start(b"", 3).size == 0
    assert others[0] == pytest.approx(chances) and others[2] == pytest.approx(rising)
    for i, share in shares.items():
        assert others[1][i] == pytest.approx(share)


def test_what_an_iteration_moves_grows_with_the_entries(spark, monkeypatch):
    """Blocks exchange the counts of terms they have, not whole blocks of terms for every block of texts."""
    vectors, _, rows = planted(spark, 90)
    entries, moved = sum(len(set(words)) for _, words in rows), []

    def saved(df, purpose="stage", **options):
        frame = materialise(df, purpose, **options)
        if purpose == "state":
            moved.append(frame.agg(F.coalesce(F.sum(F.length("m")), F.lit(0))).first()[0])
        return frame

    monkeypatch.setattr(topics_module, "materialise", saved)
    monkeypatch.setattr(topics_module, "TEXT_BLOCK", 8)
    fit_topic_table(vectors, "v", 50_000, "i", k=3, iterations=1, term_block=5_000)
    assert max(moved) <= 3 * 8 * (entries + len(rows))


def test_entries_are_dealt_once(spark, monkeypatch):
    """An iteration shuffles counts only: the entries stay in the partitions they were dealt to, in a few bytes each."""
    vectors, vocabulary, rows = planted(spark, 90)
    plans, packed = [], []

    def saved(df, purpose="stage", **options):
        frame = materialise(df, purpose, **options)
        if purpose == "state":
            plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        if purpose == "slabs":
            packed.append(frame.where("part >= 0").agg(F.sum(F.length("d") + F.length("u") + F.length("n"))).first()[0])
        return frame

    monkeypatch.setattr(topics_module, "materialise", saved)
    monkeypatch.setattr(topics_module, "TEXT_BLOCK", 8)
    fit_topic_table(vectors, "v", vocabulary.count(), "i", k=3, iterations=2, term_block=20)
    assert len(plans) == 2
    for plan in plans:
        at = [i for i, line in enumerate(plan) if "InMemoryTableScan" in line]
        assert at and not any("Exchange" in plan[i - 1] or "Sort" in plan[i - 1] for i in at)
    assert max(packed) <= 4 * sum(len(set(words)) for _, words in rows)


def brute_force(entries, theta, terms, k, iterations, alpha, eta):
    """Expectation maximisation by plain loops: counts of terms and totals."""
    for number in range(iterations + 1):
        new, counts = np.zeros_like(theta), np.zeros((terms, k))
        for text, term, n in entries:
            share = theta[text] if not number else smooth[text] * (known[term] + eta) / (totals + terms * eta)  # noqa: F821
            share = n * share / share.sum()
            new[text] += share
            counts[term] += share
        known, totals, theta = counts, counts.sum(0), new
        smooth = (theta + alpha) / (theta.sum(1, keepdims=True) + k * alpha)
    return known, totals


@pytest.mark.parametrize("weights", [(1, 2, 300), (0.25, 1, 2.5), (1, 70_000, 0)])
def test_fit_and_shares_are_those_of_plain_loops(spark, monkeypatch, weights):
    """Counts of any size, fractions and zeros, in slabs that are split a few entries at a time."""
    rng, terms, k = random.Random(5), 23, 3
    texts = [{w: float(rng.choice(weights)) for w in rng.sample(range(terms), rng.randint(1, 9))} for _ in range(40)]
    rows = [(7 * i, sorted(words), [words[w] for w in sorted(words)]) for i, words in enumerate(texts)]
    plain = spark.createDataFrame(rows, "i long, places array<int>, counts array<double>")
    vectors = to_vectors(spark, plain, terms)
    monkeypatch.setattr(topics_module, "CHUNK", 5)
    model = fit_topic_table(vectors, "v", terms, "i", k=k, iterations=3, term_block=8)
    theta = np.random.default_rng([42, 0]).dirichlet(np.ones(k), len(rows))
    entries = [(i, w, n) for i, (_, places, counts) in enumerate(rows) for w, n in zip(places, counts)]
    known, totals = brute_force(entries, theta, terms, k, 3, 1 / k, 1 / k)
    found = np.zeros((terms, k))
    for r in model.counts.collect():
        slots = np.arange(r.part, terms, model.parts)
        found[slots] = np.frombuffer(r.counts, np.float64).reshape(-1, k)[: len(slots)]
    assert found == pytest.approx(known) and model.totals == pytest.approx(totals)
    shares = {r.i: r.s for r in topic_shares(vectors, model, "v", "i").select("i", vector_to_array("topicDistribution").alias("s")).collect()}
    chances = (known + 1 / k) / (totals + terms / k)
    for i, places, counts in rows:
        theta = np.full(k, 1 / k)
        for _ in range(30):
            split = theta * chances[places]
            theta = (split * (np.array(counts) / split.sum(1))[:, None]).sum(0) + 1 / k
            theta /= theta.sum()
        assert shares[i] == pytest.approx(theta)


def to_vectors(spark, plain, terms):
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(terms).alias("size"), F.col("places").alias("indices"), F.col("counts").alias("values"))
    path = materialise(plain.select("i", vector.alias("v"))).inputFiles()[0].rsplit("/", 1)[0]
    return spark.read.schema(T.StructType([T.StructField("i", T.LongType()), T.StructField("v", VectorUDT())])).parquet(path)


def test_same_vectors_give_the_same_fit(spark):
    vectors, vocabulary, _ = planted(spark, 60)
    monkey = [fit_topic_table(vectors, "v", vocabulary.count(), "i", k=3, iterations=3, term_block=20).likelihoods for _ in range(2)]
    assert monkey[0] == monkey[1]


def test_more_terms_than_a_driver_matrix_should_hold(spark):
    """Three million terms in 46 blocks: the driver sees a few numbers a block, a task one block at a time."""
    n = 3_000_000
    size = F.lit(n)
    places = F.sort_array(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(49)), lambda j: F.pmod(F.xxhash64("id", j), size).cast("int"))))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n).alias("size"), places.alias("indices"), F.transform(places, lambda _: F.lit(1.0)).alias("values"))
    path = str(Path(spark.conf.get("spark.checkpoint.dir")) / "wide")
    spark.range(2000).select("id", vector.alias("v")).write.mode("overwrite").parquet(path)
    vectors = spark.read.schema(T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])).parquet(path)
    before = spark.conf.get("spark.driver.maxResultSize", "1g")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = fit_topic_table(vectors, "v", n, "id", k=5, iterations=2)
        assert model.parts == 46 and model.counts.count() == 46 and before
        assert model.likelihoods[1] > model.likelihoods[0]
        assert topic_shares(vectors, model, "v", "id").where(F.abs(F.aggregate(vector_to_array("topicDistribution"), F.lit(0.0), lambda a, b: a + b) - 1) < 1e-9).count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_the_model_is_left(spark):
    vectors, vocabulary, _ = planted(spark, 30)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    fit_topic_table(vectors, "v", vocabulary.count(), "i", k=2, iterations=3)
    assert len(set(shared.iterdir()) - before) == 1


def test_fit_of_nothing(spark):
    vectors, vocabulary, _ = planted(spark, 30)
    model = fit_topic_table(vectors.limit(0), "v", vocabulary.count(), "i", k=2, iterations=1)
    shares = topic_shares(vectors, model, "v", "i").select(vector_to_array("topicDistribution").alias("s")).collect()
    assert len(shares) == 32 and topics_module.TERM_BLOCK == 1 << 16
