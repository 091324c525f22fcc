import json
import random
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marquee.operators import drop_repeats
from marquee.plans import absolute_alerts, daily_ratings, relative_alerts
from marquee.schemas import REVIEW_MESSAGE
from marquee.session import create_file
from marquee.sources import parse_json_messages, scan_table, stream_source
from marquee.streaming import (
    FencedError,
    low_rated_stream,
    merge_each_batch,
    overwrite_each_batch,
    publish_each_batch,
    read_merged,
    read_published,
    sinks,
)


def review(i, movie, rating, day="6/1/2024", overall=8.0):
    return {
        "Review_ID": i,
        "Movie_ID": movie,
        "Review_Rating": rating,
        "Review_Date": day,
        "Overall_Rating": overall,
    }


def add_file(folder, name, reviews):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in reviews) + "\n")


def topic(spark, folder, **options):
    return stream_source(spark, "text", str(folder), "value string", **options)


def run(alerts, writer, checkpoint=None):
    query = low_rated_stream(alerts, writer, checkpoint=checkpoint, every=None)
    query.awaitTermination()
    return query


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def many(tmp_path):
    rng = random.Random(2)
    for f in range(4):
        reviews = [
            review(100 * f + i, f"m{rng.randrange(8)}", rng.randint(1, 10), f"6/{rng.randint(1, 3)}/2024")
            for i in range(60)
        ]
        add_file(tmp_path / "topic", f"{f}.json", reviews)
    (tmp_path / "topic" / "bad.json").write_text("not json\n\n")
    return tmp_path / "topic"


@pytest.mark.parametrize("alert", [absolute_alerts, relative_alerts])
def test_stream_ends_with_the_batch_answer(spark, tmp_path, many, alert):
    batch = alert(scan_table(spark, str(many), "text"))
    run(alert(topic(spark, many, maxFilesPerTrigger=1)), publish_each_batch(str(tmp_path / "out")))
    assert rows(read_published(spark, str(tmp_path / "out"))) == rows(batch) != []


def test_rows_leave_the_result_when_the_mean_rises(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "topic", str(tmp_path / "out"), str(tmp_path / "ckpt")
    add_file(folder, "0.json", [review(1, "low", 5), review(2, "mixed", 5)])
    stream, writer = absolute_alerts(topic(spark, folder)), overwrite_each_batch(out, "parquet")
    run(stream, writer, checkpoint)
    assert [r.Movie_ID for r in spark.read.parquet(out).orderBy("Movie_ID").collect()] == ["low", "mixed"]
    add_file(folder, "1.json", [review(3, "mixed", 9)])
    run(stream, writer, checkpoint)
    assert [r.Movie_ID for r in spark.read.parquet(out).collect()] == ["low"]
    add_file(folder, "2.json", [review(4, "low", 10)])
    run(stream, writer, checkpoint)
    assert spark.read.parquet(out).count() == 0


def test_new_start_without_checkpoint_reads_from_the_beginning(spark, tmp_path):
    folder, out = tmp_path / "topic", str(tmp_path / "out")
    add_file(folder, "0.json", [review(1, "low", 5)])
    for _ in range(2):
        run(absolute_alerts(topic(spark, folder)), overwrite_each_batch(out, "parquet"))
        assert [r.Daily_Average_Rating for r in spark.read.parquet(out).collect()] == [5.0]


def test_relative_stream_columns(spark, tmp_path):
    add_file(tmp_path / "topic", "0.json", [review(1, "m", 5, overall=8), review(2, "n", 5.5, overall=8)])
    out = str(tmp_path / "out")
    run(relative_alerts(topic(spark, tmp_path / "topic"), first_by="Review_ID"), publish_each_batch(out))
    got = read_published(spark, out)
    assert got.columns[2:] == ["Daily_Average_Rating", "Overall_Rating", "Rating_Difference"]
    assert [(r.Movie_ID, r.Rating_Difference) for r in got.collect()] == [("m", 3.0)]


def test_continuous_trigger_and_stop(spark, tmp_path):
    add_file(tmp_path / "topic", "0.json", [review(1, "low", 5)])
    out = str(tmp_path / "out")
    query = low_rated_stream(
        absolute_alerts(topic(spark, tmp_path / "topic")), publish_each_batch(out), every="1 seconds", name="alerts"
    )
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "alerts"
    finally:
        query.stop()
    assert not query.isActive and read_published(spark, out).count() == 1


def test_published_versions(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="nothing"):
        read_published(spark, out)
    write = publish_each_batch(out, keep=2, keep_seconds=0)
    for batch in range(5):
        write(spark.range(batch), batch)
        assert read_published(spark, out).count() == batch
    assert len(list((tmp_path / "out" / "data").iterdir())) == 2
    # Batch numbers that start anew do not hide the newest version; an empty result replaces the old.
    write(spark.range(7), 0)
    assert read_published(spark, out).count() == 7
    write(spark.range(0), 1)
    assert read_published(spark, out).count() == 0
    with pytest.raises(ValueError, match="two"):
        publish_each_batch(out, keep=1)


def test_unfinished_version_is_not_read(spark, tmp_path):
    out = str(tmp_path / "out")
    write = publish_each_batch(out)
    write(spark.range(3), 0)
    # Data of a batch without its marker: the writer died in between.
    spark.range(7).write.parquet(f"{out}/data/unfinished")
    assert read_published(spark, out).count() == 3
    write(spark.range(5), 1)
    assert read_published(spark, out).count() == 5


def test_slow_reader_keeps_its_version(spark, tmp_path):
    out = str(tmp_path / "out")
    write = publish_each_batch(out, keep=2)
    write(spark.range(3), 0)
    reader = read_published(spark, out)
    for batch in range(1, 6):
        write(spark.range(10 + batch), batch)
    assert reader.count() == 3 and read_published(spark, out).count() == 15


def lost_commit(checkpoint, batch):
    """As after a crash between the sink and the commit of a batch."""
    for name in (str(batch), f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)


@pytest.mark.parametrize("sink", ["publish", "overwrite"])
def test_replay_after_a_lost_commit(spark, tmp_path, sink):
    folder, out, checkpoint = tmp_path / "topic", str(tmp_path / "out"), tmp_path / "checkpoint"
    writer = publish_each_batch(out) if sink == "publish" else overwrite_each_batch(out, "parquet")
    read = (lambda: read_published(spark, out)) if sink == "publish" else (lambda: spark.read.parquet(out))
    add_file(folder, "0.json", [review(1, "A", 2)])
    run(absolute_alerts(topic(spark, folder)), writer, str(checkpoint))
    lost_commit(checkpoint, 0)
    add_file(folder, "1.json", [review(2, "B", 3)])
    run(absolute_alerts(topic(spark, folder)), writer, str(checkpoint))
    assert sorted(r.Movie_ID for r in read().collect()) == ["A", "B"]


def test_start_without_checkpoint_over_a_target(spark, tmp_path):
    folder, out = tmp_path / "topic", str(tmp_path / "out")
    for k in range(3):
        add_file(folder, f"{k}.json", [review(k, f"m{k}", 2)])
    run(absolute_alerts(topic(spark, folder, maxFilesPerTrigger=1)), publish_each_batch(out))
    assert read_published(spark, out).count() == 3
    # Fewer batches than before, and a mean that has risen.
    add_file(folder, "3.json", [review(9, "m0", 10)])
    run(absolute_alerts(topic(spark, folder)), publish_each_batch(out))
    assert sorted(r.Movie_ID for r in read_published(spark, out).collect()) == ["m1", "m2"]


def test_modes_that_lose_rows_are_refused(spark, tmp_path):
    add_file(tmp_path / "topic", "0.json", [review(1, "A", 2)])
    alerts = absolute_alerts(topic(spark, tmp_path / "topic"))
    for mode in ("update", "append"):
        with pytest.raises(ValueError, match="changed rows"):
            low_rated_stream(alerts, overwrite_each_batch(str(tmp_path / "o"), "parquet"), mode=mode)


# --- changed rows merged by key --------------------------------------------------------------------

KEYS = ["Movie_ID", "Review_Date"]


def test_merged_table_is_that_of_complete_mode(spark, tmp_path, many):
    """After every batch, means that rise included; a batch writes its changed rows only."""
    out, whole = str(tmp_path / "merged"), str(tmp_path / "whole")
    merge = merge_each_batch(out, KEYS, F.col("Daily_Average_Rating") < 6.0, compact_every=3, keep_seconds=0)
    seen, tables = [], []

    def write(batch, batch_id):
        merge(batch, batch_id)
        seen.append(batch.count())
        tables.append(rows(read_merged(spark, out, KEYS)))

    write.merges = True
    daily = daily_ratings(topic(spark, many, maxFilesPerTrigger=1))
    low_rated_stream(daily, write, mode="update", every=None).awaitTermination()
    complete, versions = [], publish_each_batch(whole)

    def keep(batch, batch_id):
        versions(batch, batch_id)
        complete.append(rows(read_published(spark, whole)))

    run(absolute_alerts(topic(spark, many, maxFilesPerTrigger=1)), keep)
    assert tables[-1] == complete[-1] == rows(absolute_alerts(scan_table(spark, str(many), "text"))) != []
    assert len(tables) == len(complete) == 5
    assert any(set(a) - set(b) for a, b in zip(tables, tables[1:]))  # rows are taken back
    # Few folders are left, as whole versions replace the changes before them.
    assert len(list((tmp_path / "merged" / "data").iterdir())) <= 4


def test_a_merged_batch_costs_its_changed_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    write = merge_each_batch(out, ["k"], F.col("v") < 5)
    write(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    write(spark.createDataFrame([(3, 9), (4, None), (5000, 2), (5, 4)], "k long, v int"), 1)
    got = {r.k: r.v for r in read_merged(spark, out, ["k"]).collect()}
    assert got == {k: 1 for k in range(1000) if k not in (3, 4, 5)} | {5: 4, 5000: 2}
    sizes = sorted(spark.read.parquet(str(f)).count() for f in (tmp_path / "out" / "data").iterdir())
    assert sizes == [4, 1000]


def test_merged_batch_that_runs_again(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "topic", str(tmp_path / "out"), tmp_path / "checkpoint"
    write = lambda: merge_each_batch(out, KEYS, F.col("Daily_Average_Rating") < 6.0)

    def go():
        low_rated_stream(daily_ratings(topic(spark, folder)), write(), str(checkpoint), "update", None).awaitTermination()
        return sorted((r.Movie_ID, r.Daily_Average_Rating) for r in read_merged(spark, out, KEYS).collect())

    add_file(folder, "0.json", [review(1, "A", 2), review(2, "B", 5)])
    assert go() == [("A", 2.0), ("B", 5.0)]
    lost_commit(checkpoint, 0)
    add_file(folder, "1.json", [review(3, "B", 9)])
    assert go() == [("A", 2.0)]


def test_empty_batches_and_null_keys_merge(spark, tmp_path):
    out = str(tmp_path / "out")
    write = merge_each_batch(out, ["k"], F.col("v") < 5, compact_every=2, keep_seconds=0)
    with pytest.raises(ValueError, match="nothing"):
        read_merged(spark, out, ["k"])
    frame = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    for batch, made in enumerate([frame(), frame((None, 1), ("a", 1)), frame(), frame((None, 7)), frame()]):
        write(made, batch)
    assert rows(read_merged(spark, out, ["k"])) == [("a", 1)]


# --- one writer at a time ---------------------------------------------------------------------------


def test_a_second_writer_is_fenced(spark, tmp_path):
    out = str(tmp_path / "out")
    one, two = publish_each_batch(out, keep=10), publish_each_batch(out, keep=10)
    one(spark.range(1), 0)
    two(spark.range(2), 0)  # takes over
    with pytest.raises(FencedError, match="version 1"):
        one(spark.range(3), 1)
    two(spark.range(4), 1)
    assert read_published(spark, out).count() == 4
    assert sorted(r.version for r in sinks._published(spark, out)) == [0, 1, 2]


@pytest.mark.parametrize("make", [publish_each_batch, lambda out: merge_each_batch(out, ["id"], F.col("id") >= 0)])
def test_writers_that_meet_lose_no_version(spark, tmp_path, make):
    """Both see the same versions and then publish: one marker is made, the other writer stops."""
    out, lost = str(tmp_path / "out"), []
    barrier = threading.Barrier(2)
    plain = sinks._Log.check

    def check(log, session):
        found = plain(log, session)
        barrier.wait(60)
        return found

    def go(n):
        try:
            make(out)(spark.range(n), 0)
        except FencedError:
            lost.append(n)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sinks._Log, "check", check)
        both = [threading.Thread(target=go, args=(n,)) for n in (5, 6)]
        for thread in both:
            thread.start()
        for thread in both:
            thread.join()
    published = sinks._published(spark, out)
    assert len(lost) == 1 and [v.version for v in published] == [0]
    assert spark.read.parquet(published[0].folder).count() == 11 - lost[0]
    assert len(list((tmp_path / "out" / "data").iterdir())) == 1


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "deep" / "marker")
    assert create_file(spark, path, b"first") and not create_file(spark, path, b"second")
    assert (tmp_path / "deep" / "marker").read_bytes() == b"first"


# --- repeated messages and arrival order -------------------------------------------------------------


@pytest.mark.parametrize("alert", [absolute_alerts, relative_alerts])
def test_messages_that_come_twice_count_once(spark, tmp_path, many, alert):
    expected = rows(alert(scan_table(spark, str(many), "text")))
    for f in list(many.iterdir()):
        (many / f"again-{f.name}").write_text(f.read_text())
    assert rows(alert(scan_table(spark, str(many), "text"))) == expected or alert is relative_alerts
    distinct = alert(scan_table(spark, str(many), "text"), distinct_by="Review_ID")
    assert rows(distinct) == expected
    stream = alert(topic(spark, many, maxFilesPerTrigger=2), distinct_by="Review_ID", late="30 days")
    run(stream, publish_each_batch(str(tmp_path / "out")))
    assert rows(read_published(spark, str(tmp_path / "out"))) == expected


def test_a_repeat_changes_the_mean_unless_dropped(spark, tmp_path):
    folder, out = tmp_path / "topic", str(tmp_path / "out")
    add_file(folder, "0.json", [review(1, "m", 1), review(2, "m", 9), review(None, "m", 5), review(None, "m", 5)])
    add_file(folder, "1.json", [review(1, "m", 1), review(1, "m", 1)])
    run(daily_ratings(topic(spark, folder, maxFilesPerTrigger=1), distinct_by="Review_ID"), publish_each_batch(out))
    # Reviews 1, 2 and one of the equal ones without an id.
    assert [r.Daily_Average_Rating for r in read_published(spark, out).collect()] == [5.0]


def test_remembered_ids_do_not_grow_with_the_stream(spark, tmp_path):
    folder, checkpoint = tmp_path / "topic", str(tmp_path / "ckpt")
    held = []
    for day in range(1, 9):
        add_file(folder, f"{day}.json", [review(100 * day + i, f"m{i}", 5, f"6/{day}/2024") for i in range(40)])
        distinct = drop_repeats(parse_json_messages(topic(spark, folder), REVIEW_MESSAGE), "Review_ID", "Review_Date", "2 days")
        query = distinct.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        held.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1])
    assert max(held) <= 4 * 40 and held[-1] <= 4 * 40 < 8 * 40


def test_first_value_follows_the_source_not_the_batches(spark, tmp_path):
    """The log's time and offset go into the state, so a later batch may hold the earlier message."""
    folder, out = tmp_path / "log", str(tmp_path / "out")
    schema = "value string, timestamp timestamp, partition int, offset long"
    one = lambda overall, rating, partition, offset: (json.dumps(review(offset, "m", rating, overall=overall)), datetime(2024, 6, 1, 12), partition, offset)
    spark.createDataFrame([one(9.5, 1, 1, 5), one(9.0, 1, 0, 7)], schema).coalesce(1).write.parquet(str(folder / "a"))
    stream = lambda: relative_alerts(
        spark.readStream.schema(schema).parquet(str(folder / "*")), first_by=["timestamp", "partition", "offset"]
    )
    checkpoint = tmp_path / "ckpt"
    run(stream(), publish_each_batch(out), str(checkpoint))
    assert [r.Overall_Rating for r in read_published(spark, out).collect()] == [9.0]
    spark.createDataFrame([one(8.0, 1, 0, 6)], schema).write.parquet(str(folder / "b"))
    lost_commit(checkpoint, 0)
    run(stream(), publish_each_batch(out), str(checkpoint))
    assert [r.Overall_Rating for r in read_published(spark, out).collect()] == [8.0]
    with pytest.raises(ValueError, match="both have"):
        parse_json_messages(spark.read.parquet(str(folder / "a")).withColumn("Movie_ID", F.lit(1)), REVIEW_MESSAGE, keep=["Movie_ID"])
