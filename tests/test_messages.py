import datetime
import json

import pytest

from marquee.schemas import REVIEW_MESSAGE, REVIEW_MESSAGE_WITH_OVERALL
from marquee.sources import (
    decode_messages,
    parse_json_messages,
    publish_json,
    read_json_objects,
    read_offset_range,
    read_partition,
    scan_table,
    topic_options,
)

REVIEW = {
    "Review_ID": 710_001,
    "Movie_ID": "Østavind",
    "Reviewer_Name": "Tester Seven",
    "Review_Rating": 3,
    "Reviewer_Nationality": "Nowhere",
    "Reviewer_Age": 101,
    "Review_Date": "12/30/2031",
    "Sex": "Unknown",
}
DAY = datetime.date(2031, 12, 30)


def log(spark, rows):
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")


@pytest.fixture
def small_log(spark):
    return log(
        spark,
        [
            (b"k", b"a", "t", 0, 0),
            (None, b"b", "t", 0, 1),
            (b"", "é".encode(), "t", 0, 2),
            (b"k", None, "t", 1, 0),
        ],
    )


def test_decode_messages(small_log):
    got = [tuple(r) for r in decode_messages(small_log).select("key", "value", "display").collect()]
    assert got == [("k", "a", "k   a"), (None, "b", "b"), ("", "é", "é"), ("k", None, None)]


def test_partition_and_offset_range(small_log):
    assert read_partition(small_log, 1).count() == 1
    assert [r.offset for r in read_offset_range(small_log).collect()] == [0, 1, 2]
    assert [r.offset for r in read_offset_range(small_log, 0, 1, 2).collect()] == [1]
    assert read_offset_range(small_log, 7).count() == 0


def messages(spark, *values):
    texts = [v if isinstance(v, (str, type(None))) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_review(spark):
    got = parse_json_messages(messages(spark, REVIEW), REVIEW_MESSAGE)
    assert dict(got.dtypes)["Review_Date"] == "date" and dict(got.dtypes)["Review_Rating"] == "bigint"
    assert tuple(got.first()) == ("710001", "Østavind", "Tester Seven", 3, "Nowhere", 101, DAY, "Unknown")


def test_parse_review_with_overall(spark):
    got = parse_json_messages(messages(spark, {**REVIEW, "Overall_Rating": 8}), REVIEW_MESSAGE_WITH_OVERALL)
    assert (got.first().Review_Rating, got.first().Overall_Rating) == (3.0, 8.0)


def test_bad_messages_become_null(spark):
    bad = messages(
        spark,
        "not json",
        None,
        {**REVIEW, "Review_Rating": 7.5},
        {**REVIEW, "Review_Date": "2024-06-01"},
        {"Movie_ID": "M"},
    )
    got = parse_json_messages(bad, REVIEW_MESSAGE).collect()
    assert got[0].asDict() == dict.fromkeys(got[0].asDict()) == got[1].asDict()
    assert got[2].Review_Rating is None and got[2].Movie_ID == "Østavind"
    assert got[3].Review_Date is None and got[3].Review_Rating == 3
    assert got[4].Movie_ID == "M" and got[4].Sex is None


def test_rejects_keep_the_raw_text(spark):
    got = parse_json_messages(messages(spark, "not json", REVIEW), REVIEW_MESSAGE, rejects="Rejected")
    assert [r.Rejected for r in got.collect()] == ["not json", None]


def test_publish_round_trip_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = spark.createDataFrame([(1, "a\n\"b\"", None), (2, None, 1.5)], "i int, s string, d double")
    publish_json(df, path)
    raw = sorted(r.value for r in scan_table(spark, path, "text").collect())
    assert json.loads(raw[0]) == {"i": 1, "s": 'a\n"b"', "d": None}
    back = parse_json_messages(scan_table(spark, path, "text"), df.schema, None)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_publish_with_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    publish_json(df, str(tmp_path / "t"), "parquet", key="i")
    got = spark.read.parquet(str(tmp_path / "t")).first()
    assert (got.key, json.loads(got.value)) == ("1", {"i": 1, "s": "a"})


def test_read_json_objects(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([REVIEW, REVIEW], indent=2))
    (tmp_path / "lines.json").write_text(json.dumps(REVIEW) + "\n" + json.dumps(REVIEW))
    as_array = read_json_objects(spark, str(tmp_path / "array.json"), REVIEW_MESSAGE, array=True)
    as_lines = read_json_objects(spark, str(tmp_path / "lines.json"), REVIEW_MESSAGE)
    assert as_array.collect() == as_lines.collect() and as_array.count() == 2
    assert dict(read_json_objects(spark, str(tmp_path / "array.json"), array=True).dtypes)["Review_ID"] == "bigint"


def test_topic_options():
    assert topic_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    bounded = topic_options("h:9092", "t", [1], {1: 5}, {1: 9}, min_partitions=64, max_per_trigger=1000)
    assert json.loads(bounded["assign"]) == {"t": [1]} and "subscribe" not in bounded
    assert json.loads(bounded["startingOffsets"]) == {"t": {"1": 5}}
    assert json.loads(bounded["endingOffsets"]) == {"t": {"1": 9}}
    assert (bounded["minPartitions"], bounded["maxOffsetsPerTrigger"]) == ("64", "1000")


def test_rejects_keep_wrong_dates(spark):
    wrong = {**REVIEW, "Review_Date": "2031-12-30"}
    got = parse_json_messages(messages(spark, REVIEW, wrong, "not json"), REVIEW_MESSAGE, rejects="raw").collect()
    assert [r.raw for r in got] == [None, json.dumps(wrong), "not json"]
    assert got[0].Review_Date == DAY and got[1].Review_Date is None and got[1].Movie_ID == "Østavind"
