from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marquee.schemas import CatalogueColumns, catalogue_schema
from marquee.session import get_session, materialise, scratch_dir
from marquee.sources import ingest_csv, preview_table, scan_csv, scan_table, write_table


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "Ann, B", 1.5), (2, None, None)], "id int, name string, x double")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_round_trip_infers_types(spark, people, tmp_path):
    write_table(people, str(tmp_path / "c"), "csv", header=True)
    back = scan_csv(spark, str(tmp_path / "c"))
    assert back.dtypes == people.dtypes and rows(back) == rows(people)


def test_csv_with_schema_keeps_declared_types(spark, people, tmp_path):
    write_table(people, str(tmp_path / "c"), "csv", header=True)
    back = scan_csv(spark, str(tmp_path / "c"), "id bigint, name string, x string")
    assert rows(back) == [(1, "Ann, B", "1.5"), (2, None, None)]


def test_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a|b\n1|x\n")
    assert rows(scan_csv(spark, str(tmp_path / "a.csv"), sep="|")) == [(1, "x")]


def test_ingest_appends_by_default(spark, people, tmp_path):
    source, target = str(tmp_path / "c"), str(tmp_path / "t")
    write_table(people, source, "csv", header=True)
    assert ingest_csv(spark, source, target, "parquet").count() == 2
    assert ingest_csv(spark, source, target, "parquet").count() == 4
    assert ingest_csv(spark, source, target, "parquet", mode="overwrite").count() == 2


def test_catalog_table_and_preview(spark, people, tmp_path):
    write_table(people, "people_t", path=str(tmp_path / "w"))
    try:
        assert rows(scan_table(spark, "people_t")) == rows(people)
        assert [r.id for r in preview_table(spark, "people_t", 1, "id DESC").collect()] == [2]
        assert preview_table(spark, "people_t").count() == 2
        write_table(people.limit(0), "people_t", path=str(tmp_path / "w"))
        assert spark.table("people_t").count() == 0
    finally:
        spark.sql("DROP TABLE people_t")


def test_options_only_source_and_sink(spark, people, tmp_path):
    path = str(tmp_path / "t")
    write_table(people, None, "parquet", path=path)
    assert rows(scan_table(spark, None, "parquet", path=path)) == rows(people)


def test_partitioned_write_prunes(spark, people, tmp_path):
    write_table(people, str(tmp_path / "t"), "parquet", partition_by=["id"])
    got = scan_table(spark, str(tmp_path / "t"), "parquet").where("id = 1")
    assert "PartitionFilters: [isnotnull(id" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 1


def test_column_pruning_and_pushdown(spark, people, tmp_path):
    write_table(people, str(tmp_path / "t"), "parquet")
    df = scan_table(spark, str(tmp_path / "t"), "parquet").where("id > 1").select("name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int,name:string>" in plan and "GreaterThan(id,1)" in plan


def test_catalogue_schema(spark):
    df = spark.createDataFrame([], catalogue_schema(CatalogueColumns(rating="Stars")))
    types = dict(df.dtypes)
    assert len(types) == 16 and types["Stars"] == "double" and types["Runtime"] == "string"
    assert types["Gross"] == types["No_of_Votes"] == types["Released_Year"] == "bigint"


def session_with(**conf):
    """Stands in for a session of which only the settings are asked."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: conf.get(name, default)))


def test_scratch_follows_the_shared_folder():
    shared = session_with(**{"spark.checkpoint.dir": "hdfs://n/ckpt/", "spark.master": "yarn"})
    one, two = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert one.startswith("hdfs://n/ckpt/marquee-x-") and one != two


def test_scratch_refuses_a_machine_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session_with(**{"spark.master": "yarn"}))


def test_materialise_keeps_rows_schema_and_metadata(spark):
    df = spark.range(3).withColumn("v", F.col("id").alias("v", metadata={"ml_attr": {"x": 1}}))
    kept = materialise(df)
    assert rows(kept) == rows(df) and kept.schema["v"].metadata == {"ml_attr": {"x": 1}}
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_session_is_reused(spark):
    again = get_session("other", spark_sql_session_timeZone="UTC")
    assert again.sparkContext is spark.sparkContext
    assert again.conf.get("spark.sql.session.timeZone") == "UTC"
