import gc
import time
from pathlib import Path

import pytest

from marquee.session import materialise, scratch_dir, stages


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})


def test_shared_folder_is_used_where_it_is_set():
    assert scratch_dir(FakeSession(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")).startswith("hdfs://x/y/marquee-")


@pytest.mark.parametrize("conf", [{}, {"spark_master": "yarn"}, {"spark_master": "local-cluster[2,1,1024]"}])
def test_machine_folder_needs_a_local_master(conf):
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_dir(FakeSession(**conf))


def test_local_master_may_use_it():
    assert "marquee-" in scratch_dir(FakeSession(spark_master="local[2]"))


def folders(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir())


def test_a_run_deletes_its_stages_but_what_is_kept(spark):
    before = folders(spark)
    with stages(spark) as run:
        first = materialise(spark.range(10), "first")
        second = materialise(first.where("id > 4"), "second")
        run.release(first)
        assert len(folders(spark) - before) == 1
        kept, lazy = run.keep(second), run.keep(second.selectExpr("id * 2 AS twice"))
        assert kept is second
    assert kept.count() == 5 and lazy.agg({"twice": "sum"}).first()[0] == 70
    assert len(folders(spark) - before) == 2


def test_runs_nest_and_hand_over(spark):
    before = folders(spark)
    with stages(spark) as outer:
        with stages(spark) as inner:
            result = inner.keep(materialise(spark.range(3)))
        other = materialise(spark.range(4))
        inner.release(other)  # not its own
        assert result.count() == 3 and other.count() == 4
        last = outer.keep(result.join(other, "id"))
    assert last.count() == 3 and len(folders(spark) - before) == 1


def test_a_failed_run_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError):
        with stages(spark):
            materialise(spark.range(3))
            raise RuntimeError
    assert folders(spark) == before
    saved = materialise(spark.range(2))  # outside a run it stays
    assert saved.count() == 2 and len(folders(spark) - before) == 1


def test_a_saved_stage_leaves_no_shuffle(spark):
    """What it shuffled is deleted once it is written, not when the driver's heap is collected."""
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    gc.collect()
    before, setting = held(), spark.conf.get(name, None)
    saved = [materialise(spark.range(1000).repartition(3, "id").groupBy("id").count()) for _ in range(3)]
    until = time.monotonic() + 20
    while held() > before and time.monotonic() < until:
        time.sleep(0.1)
    assert held() <= before and all(s.count() == 1000 for s in saved)
    assert spark.conf.get(name, None) == setting
