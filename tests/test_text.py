import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from marquee.operators import (
    counted_terms,
    fit_vocabulary,
    fit_topics,
    remove_stopwords,
    term_counts,
    term_vectors,
    tokenize,
    topic_mixture,
    vector_entries,
)
from marquee.session import materialise
from marquee.workload import ENGLISH_STOP_WORDS


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def test_tokenize(spark):
    df = texts(spark, "The Cat, sat.", "two  blanks", "", "end ")
    got = {r.i: r.w for r in tokenize(df, "t", "w").collect()}
    assert got == {0: ["the", "cat,", "sat."], 1: ["two", "", "blanks"], 2: [""], 3: ["end"]}


def test_remove_stopwords(spark):
    df = spark.createDataFrame([(["The", "cat", "ISN'T", "here", "the,"],)], "w array<string>")
    assert remove_stopwords(df, "w", "k").first().k == ["cat", "the,"]
    assert remove_stopwords(df, "w", "k", ["cat"]).first().k == ["The", "ISN'T", "here", "the,"]


AWKWARD = ["", " ", "\t\n ", " a", "a ", "a  b", "a\tb\nc\x0bd\fe\r", "É Ü", "a\u00a0b", "\n\nx\n\n", "The THE the"]


def test_words_are_those_of_spark_ml(spark):
    from pyspark.ml.feature import StopWordsRemover, Tokenizer

    df = texts(spark, *AWKWARD)
    ml = Tokenizer(inputCol="t", outputCol="w").transform(df)
    ml = StopWordsRemover(inputCol="w", outputCol="k").transform(ml)
    own = remove_stopwords(tokenize(df, "t", "w"), "w", "k")
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, ml.collect()))


def test_null_text(spark):
    df = remove_stopwords(tokenize(texts(spark, None), "t", "w"), "w", "k")
    assert tuple(df.first()) == (0, None, None, None)


def test_stop_word_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


WORDS = [["a", "b", "a"], ["b", "c"], [], ["a"]]


def words(spark):
    return spark.createDataFrame(list(enumerate(WORDS)), "i int, w array<string>")


def test_term_counts(spark):
    got = {r.term: r.n for r in term_counts(words(spark), "w").collect()}
    assert got == Counter(w for row in WORDS for w in row)


def test_fit_and_apply_term_vectors(spark):
    df = words(spark)
    vocabulary = fit_vocabulary(df, "w")
    found = {r.term: (r.n, r.df, r.slot) for r in vocabulary.collect()}
    assert found == {"a": (3, 2, 0), "b": (2, 2, 1), "c": (1, 1, 2)}
    vectors = term_vectors(df, "w", "v", vocabulary)
    got = {r.i: r.v for r in vectors.collect()}
    assert got[0] == SparseVector(3, {0: 2.0, 1: 1.0}) and got[2] == SparseVector(3, {})
    entries = {(r.i, r.slot): r.entry for r in vector_entries(vectors, "v", ["i"]).collect()}
    assert entries == {(0, 0): 2.0, (0, 1): 1.0, (1, 1): 1.0, (1, 2): 1.0, (3, 0): 1.0}


def test_vectors_of_null_words_and_other_terms(spark):
    df = spark.createDataFrame([(1, None), (2, ["x", "a"])], "i int, w array<string>")
    got = {r.i: r.v for r in term_vectors(df, "w", "v", fit_vocabulary(words(spark), "w")).collect()}
    assert got == {1: SparseVector(3, {}), 2: SparseVector(3, {0: 1.0})}


def test_counted_terms(spark):
    rows = [["b", "a", "b", "", "c", "b"], [], None, [None, "x", None, "x"], ["é", "e", "É", "é"], ["z"]]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, w array<string>")
    got = {r.i: [tuple(x) for x in r.t] for r in df.select("i", counted_terms("w").alias("t")).collect()}
    expected = {i: sorted(Counter(x for x in w or [] if x is not None).items(), key=lambda p: p[0].encode()) for i, w in enumerate(rows)}
    assert got == expected


def test_counting_is_linear_in_the_length_of_a_text(spark):
    df = spark.range(2).select(F.transform(F.sequence(F.lit(0), F.lit(400_000)), lambda k: F.concat(F.lit("w"), k % 50_000)).alias("w"))
    one = df.select(F.explode(counted_terms("w")).alias("t")).agg(F.count("t"), F.sum("t.n"), F.max("t.n")).first()
    assert tuple(one) == (100_000, 800_002, 9)


@pytest.mark.parametrize("most", [0, 64 * 3, 1 << 20])
@pytest.mark.parametrize("counted", [False, True])
def test_head_and_tail_of_the_vocabulary_give_one_vector(spark, most, counted):
    rng = random.Random(9)
    rows = [[f"t{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randint(0, 50))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "i long, w array<string>").repartition(5)
    vocabulary = fit_vocabulary(df, "w")
    slots = {r.term: r.slot for r in vocabulary.collect()}
    df = materialise(df.withColumn("w", counted_terms("w"))) if counted else df
    vectors = term_vectors(df, "w", "v", vocabulary, "i" if counted else None, keep_words=not counted, broadcast_bytes=most)
    assert vectors.columns == (["i", "v"] if counted else ["i", "w", "v"])
    got = {r.i: r.v for r in vectors.collect()}
    assert got == {i: SparseVector(len(slots), {slots[t]: float(n) for t, n in Counter(w).items()}) for i, w in enumerate(rows)}


def test_vectors_shuffle_entries_by_row_only_if_the_head_is_everything(spark):
    df = materialise(words(spark).withColumn("w", counted_terms("w")))
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir())
    vectors = term_vectors(df, "w", "v", fit_vocabulary(df, "w"), "i", keep_words=False)
    # What is left is the vectors and the ranked vocabulary.
    assert len(set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) - before) == 2
    assert vectors.count() == 4


def test_vocabulary_has_every_term(spark):
    # More terms than a default CountVectorizer would keep.
    n = 270_000
    df = spark.range(n // 10).select(
        "id", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: (F.col("id") * 10 + k).cast("string")).alias("w")
    )
    vocabulary = fit_vocabulary(df, "w")
    assert vocabulary.count() == n and vocabulary.agg(F.max("slot")).first()[0] == n - 1
    vectors = term_vectors(df, "w", "v", vocabulary)
    assert vector_entries(vectors, "v", ["id"]).agg(F.countDistinct("slot")).first()[0] == n


def test_vocabulary_limits(spark):
    terms = lambda **limits: sorted(r.term for r in fit_vocabulary(words(spark), "w", **limits).collect())
    assert terms(vocab_size=1) == ["a"]
    for min_df in (2, 0.5):
        assert terms(min_df=min_df) == ["a", "b"]
    assert len(terms(min_df=0.1)) == 3


def test_topic_mixture(spark):
    df = spark.createDataFrame(
        [(i, (["sea", "ship"] if i % 2 else ["star", "moon"]) * 5) for i in range(40)], "i int, w array<string>"
    ).coalesce(1)
    vectors = term_vectors(df, "w", "v", fit_vocabulary(df, "w")).coalesce(1)
    mixtures = []
    for _ in range(2):
        model = fit_topics(vectors, "v", k=2, iterations=10)
        shares = topic_mixture(vectors, model).select("i", vector_to_array("topicDistribution").alias("s"))
        mixtures.append({r.i: list(r.s) for r in shares.collect()})
    assert mixtures[0] == mixtures[1]
    assert all(sum(s) == pytest.approx(1) and len(s) == 2 for s in mixtures[0].values())
    assert mixtures[0][0] == pytest.approx(mixtures[0][2]) != mixtures[0][1]


def test_empty_text_has_no_topics(spark):
    df = words(spark)
    vectors = term_vectors(df, "w", "v", fit_vocabulary(df, "w"))
    got = topic_mixture(vectors, fit_topics(vectors, "v", iterations=2), "m")
    assert got.where("i = 2").select(F.array_max(vector_to_array("m"))).first()[0] == 0.0


def test_head_entries_are_found_within_their_row(spark):
    """Places in rising order, the rest apart, and rows without words or with NULL; repeated over slices of a table."""
    from marquee.operators.text import _head_entries

    rows = [[("a", 2), ("b", 1), ("x", 3)], [], None, [("x", 1)], [("b", 5)]] * 50
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t array<struct<term:string,n:bigint>>").coalesce(1)
    for head in (["c", "b", "a"], []):
        split = _head_entries(spark.sparkContext.broadcast(pa.array(head, pa.string())))
        got = {r.i: (r.s.indices, r.s["values"], [tuple(x) for x in r.s.rest]) for r in df.select("i", split(F.col("t")).alias("s")).collect()}
        for i, terms in enumerate(rows):
            here = sorted((head.index(t), float(n)) for t, n in terms or [] if t in head)
            assert got[i] == ([s for s, _ in here], [n for _, n in here], [p for p in terms or [] if p[0] not in head])
