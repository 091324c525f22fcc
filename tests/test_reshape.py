import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marquee.operators import (
    dedup_by_key,
    dedup_rows,
    enrich_left,
    explode_tags,
    heavy_buckets,
    measured_bytes,
    top_n,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_explode_tags(spark):
    df = spark.createDataFrame([(1, "A, B"), (2, " A,B, C "), (3, ""), (4, None)], "i int, tags string")
    assert rows(explode_tags(df, "tags", "tag").select("i", "tag")) == [
        (1, "A"),
        (1, "B"),
        (2, "A,B"),
        (2, "C"),
        (3, ""),
    ]


def test_dedup_by_key_ties_nulls_and_order(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "q"), (None, 4, "r"), ("b", None, "n"), ("b", 0, "m")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    assert rows(dedup_by_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", None, "n"), (None, 4, "r")]
    assert rows(dedup_by_key(df, ["k"], ["o"], keep="last")) == [("a", 2, "x"), ("b", 0, "m"), (None, 5, "q")]
    assert dedup_by_key(df, ["k"], ["o"]).columns == df.columns
    with pytest.raises(ValueError):
        dedup_by_key(df, ["k"], keep="any")


def test_dedup_by_key_does_not_depend_on_partitioning(spark):
    rng = random.Random(1)
    data = [(rng.randrange(5), rng.randrange(3), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "k int, o int, v double")
    results = [rows(dedup_by_key(df.repartition(n), ["k"], ["o"])) for n in (1, 3, 11)]
    assert results[0] == results[1] == results[2]
    expected = {}
    for row in sorted(data):
        expected.setdefault(row[0], row)
    assert results[0] == sorted(expected.values(), key=repr)


def test_dedup_by_key_with_map_column(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2})], "k int, o int, m map<string,int>")
    assert [tuple(r) for r in dedup_by_key(df, ["k"], ["o"]).collect()] == [(1, 1, {"b": 2})]


def test_dedup_by_key_only_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(dedup_by_key(df, ["k"])) == [(1,), (None,)]


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") + plan.count("HashAggregate") == 2
    assert "partial_min" in plan.split("Exchange")[-1]


def test_dedup_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    assert rows(dedup_rows(df)) == [(1, "a"), (1, None)]


LEFT = [(1, "a"), (2, "b"), (2, "c"), (None, "n"), (9, "z")]
RIGHT = [(1, 10.0), (2, 21.0), (2, 20.0), (None, 5.0), (7, 70.0)]
EXPECTED = [(1, "a", 10.0), (2, "b", 20.0), (2, "c", 20.0), (9, "z", None), (None, "n", None)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_enrich_left(spark, broadcast_bytes):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "k int, r double")
    joined = enrich_left(left, right, "k", broadcast_bytes=broadcast_bytes)
    assert joined.columns == ["k", "l", "r"]
    assert rows(joined) == EXPECTED


def test_enrich_left_shared_columns(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="v"):
        enrich_left(left, right, "k")
    joined = enrich_left(left, right, "k", suffix="_right")
    assert joined.columns == ["k", "v", "v_right"] and rows(joined) == [(1, "a", "b")]


def skewed(spark):
    """A third of the rows has one key, a third has none, equal copies included."""
    third = 4000
    data = [(1, i % 7) for i in range(third)] + [(None, 0)] * third + [(10 + i, i) for i in range(third)]
    return spark.createDataFrame(data, "k int, v int").repartition(8), data


def test_enrich_left_with_heavy_keys_is_exact(spark):
    left, data = skewed(spark)
    lookup = {k: k * 2 for k in range(0, 3000)}
    right = spark.createDataFrame([*lookup.items(), (None, -1)], "k int, r int")
    joined = enrich_left(left, right, "k", broadcast_bytes=0)
    assert rows(joined) == sorted(((k, v, lookup.get(k)) for k, v in data), key=repr)


def test_enrich_left_cuts_heavy_keys(spark):
    left, _ = skewed(spark)
    right = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = enrich_left(left, right, "k", broadcast_bytes=0, slices=64)
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Uncut, the two heavy keys alone would fill a partition with 4000 of 12000 rows each.
    assert sum(sizes) == 12000 and max(sizes) < 3000


def test_heavy_buckets_are_few_and_find_every_heavy_key(spark):
    left, _ = skewed(spark)
    found = heavy_buckets(left, ["k"], 4096, 30).collect()
    # A third of the rows fills ten of thirty slices; light keys may share the bucket.
    assert [r["_fill"] for r in found] in ([10, 10], [10, 11], [11, 10], [11, 11])
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    wanted = {r[0] for r in keys.select(F.pmod(F.xxhash64("k"), F.lit(4096)).cast("int")).collect()}
    assert {r["_bucket"] for r in found} == wanted
    assert heavy_buckets(left.limit(0), ["k"], 4096, 30).count() == 0


def test_even_keys_are_joined_plainly(spark):
    left = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    right = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("r"))
    joined = enrich_left(left, right, "k", broadcast_bytes=0)
    assert "_slice" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.where("k = r").count() == 5000


def test_enrich_left_on_two_keys(spark):
    left = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (1, None, 3)], "a int, b string, v int")
    right = spark.createDataFrame([(1, "x", "r"), (1, None, "s")], "a int, b string, w string")
    for size in (0, 1 << 20):
        joined = enrich_left(left, right, ["a", "b"], broadcast_bytes=size)
        assert rows(joined) == [(1, "x", 1, "r"), (1, "y", 2, None), (1, None, 3, None)]


def test_measured_bytes_grows_with_content(spark):
    small = spark.createDataFrame([(1, "a")], "k int, v string")
    large = spark.createDataFrame([(1, "a" * 1000), (2, None)], "k int, v string")
    assert measured_bytes(small) == 33 and measured_bytes(large) == 1064
    assert measured_bytes(small.limit(0)) == 0


def test_measure_sees_vectors_and_variants(spark):
    vectors = spark.createDataFrame([(k, Vectors.dense([1.0] * 100_000)) for k in range(3)], ["k", "v"])
    assert measured_bytes(vectors) > 3 * 8 * 100_000
    sparse = spark.createDataFrame([(1, Vectors.sparse(10**9, {5: 1.0}))], ["k", "v"])
    assert measured_bytes(sparse) < 1000
    text = spark.range(1).select("id", F.parse_json(F.concat(F.lit('"'), F.repeat(F.lit("x"), 1 << 20), F.lit('"'))).alias("v"))
    assert measured_bytes(text) > 1 << 20
    nested = spark.createDataFrame([(1, {"a": ["x" * 5000]})], "k int, m map<string, array<string>>")
    assert measured_bytes(nested) > 5000


def test_large_vectors_are_not_broadcast(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.createDataFrame([(k, Vectors.dense([float(k)] * 20_000)) for k in range(20)], ["k", "v"])
    joined = enrich_left(left, right, "k", unique=True, broadcast_bytes=1 << 20)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.where(F.col("v").isNotNull()).count() == 20


def test_heavy_path_reads_no_unused_text(spark, tmp_path):
    left = spark.range(20_000).select((F.col("id") % 3 * 0).alias("k"), "id", F.repeat(F.lit("text"), 20).alias("t"))
    left.write.parquet(str(tmp_path / "left"))
    right = spark.createDataFrame([(0, "a")], "k bigint, v string")
    joined = enrich_left(spark.read.parquet(str(tmp_path / "left")), right, "k", broadcast_bytes=0, slices=4)
    plan = joined.select("id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "t:string" not in plan and joined.select("id", "v").count() == 20_000


def test_streaming_side_is_refused(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("value", "k")
    with pytest.raises(ValueError, match="bounded"):
        enrich_left(stream, spark.range(3).withColumnRenamed("id", "k"), "k")


def test_top_n(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (None, "n"), (2, "b")], "k int, v string")
    assert [r.k for r in top_n(df, 2, F.asc_nulls_first("k")).collect()] == [None, 1]
    assert [r.k for r in top_n(df, 2, F.desc("k")).collect()] == [3, 2]
    plan = top_n(df, 2, "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
