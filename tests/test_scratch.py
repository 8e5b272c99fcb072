"""Jobs that run beside each other."""

import os
import threading
import time
from functools import partial

import pytest

from tallystar.plans import jobs
from tallystar.sources.scratch import at_once, kept, pin, pin_in_turn, scratch_of_job, scratch_path
from tests.data import wide


def test_results_come_in_order_and_all_jobs_end_before_one_fails(spark):
    assert at_once(lambda: 1, lambda: 2) == [1, 2]
    ended = threading.Event()

    def slow():
        assert not ended.wait(0.5)
        ended.set()

    def fails():
        raise KeyError("first")

    with pytest.raises(KeyError, match="first"):
        at_once(fails, slow)
    assert ended.is_set()


def test_what_they_pin_lies_in_the_scratch_of_the_job(spark):
    with scratch_of_job(spark) as folder:
        pinned = at_once(*[partial(pin, spark.range(n)) for n in (2, 3)])
        assert [df.count() for df in pinned] == [2, 3]
        assert all(folder in df.inputFiles()[0] for df in pinned)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f"{d}/{f}" for top in manager.localDirs() for d, _, files in os.walk(top.getPath()) for f in files if f.startswith("shuffle_")}


def soon_gone(spark, before):
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not shuffle_files(spark) - before


def test_pinning_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    frames = [spark.range(1000).repartition(3 + n, "id") for n in range(3)]
    pinned = at_once(*[partial(pin, df) for df in frames])
    assert soon_gone(spark, before) and spark.conf.get(setting) == was
    with scratch_of_job(spark):
        assert [df.count() for df in pinned] == [1000] * 3
        assert frames[0].count() == 1000
        assert spark.range(9).repartition(3, "id").groupBy("id").count().count() == 9
    assert soon_gone(spark, before)


def test_frames_in_turn_are_one_table_and_leave_no_shuffle(spark):
    before, seen = shuffle_files(spark), []

    def frames():
        for n in range(3):
            seen.append(soon_gone(spark, before))
            yield spark.range(10 * n, 10 * n + 10).repartition(2, "id")

    df = pin_in_turn(frames(), scratch_path(spark), "zstd")
    assert sorted(r.id for r in df.collect()) == list(range(30)) and all(seen)


def test_what_is_kept_outlives_what_it_took(spark):
    inner = []

    def make():
        inner.append(pin(spark.range(5)))
        return inner[0].where("id > 1")

    with scratch_of_job(spark) as folder:
        df = kept(spark, make)
        assert df.count() == 3 and folder in df.inputFiles()[0]
        assert not any(os.path.exists(f.removeprefix("file://")) for f in inner[0].inputFiles())


def test_dimensions_of_a_star_are_written_beside_each_other(spark, monkeypatch):
    meet = threading.Barrier(4)  # the dimensions
    written = jobs.write_table

    def write(df, path, fmt):
        if not any(name in path for name in ("time_dim", "inventory_fact", jobs.CHECKS)):
            meet.wait(60)
        written(df, path, fmt)

    monkeypatch.setattr(jobs, "write_table", write)
    assert set(jobs.build_star(wide(spark), scratch_path(spark), fmt="parquet")) == set(jobs.IDS)
