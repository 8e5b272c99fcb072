"""Dense ids: the same for every partitioning, whatever the keys look like."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallystar.operators.surrogate import dense_surrogate_key
from tallystar.sources.scratch import pin, scratch_path
from tests.data import table


def by_window(df, id_column, order):
    keys = [*order, *(c for c in df.columns if c not in order)]
    return df.withColumn(id_column, F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(7)
    values = {(rng.choice([None, *range(300)]), rng.choice([None, "", "x", "y", "é", " x"])) for _ in range(3000)}
    return spark.createDataFrame(sorted(values, key=repr), "k INT, s STRING")


@pytest.mark.parametrize("partitions", [1, 4, 16])
@pytest.mark.parametrize("shuffled_to", [1, 8, 31])
def test_ids_are_those_of_a_global_row_number(spark, pairs, partitions, shuffled_to):
    spark.conf.set("spark.sql.shuffle.partitions", shuffled_to)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ours = dense_surrogate_key(pairs.repartition(partitions), "id", ["k", "s"])
        assert table(ours) == table(by_window(pairs, "id", ["k", "s"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_other_columns_break_ties_of_the_key(spark, pairs):
    ours = dense_surrogate_key(pairs, "id", ["s"])
    assert table(ours) == table(by_window(pairs, "id", ["s"]))


def skewed(spark):
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


@pytest.mark.parametrize("rows", [None, 10 << 20])
def test_a_hot_key_is_cut_into_several_ranges(spark, rows):
    ours = dense_surrogate_key(skewed(spark), "id", ["k"], rows)
    pinned = pin(ours.withColumn("part", F.spark_partition_id()))
    per_task = pinned.groupBy("part").agg(F.count("id").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).orderBy("part").collect()
    if rows is None:
        assert len(per_task) == 8 and max(r.n for r in per_task) < 2 * 60_000 / 8
    # Files in the order of the ids.
    assert all(r.last - r.first + 1 == r.n for r in per_task) and [r.first for r in per_task] == sorted(r.first for r in per_task)
    got = pinned.agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
    assert tuple(got) == (60_000, 60_000, 1, 60_000)


@pytest.mark.parametrize("rows", [1, 1000, 5 << 20, 1 << 40])
def test_the_number_told_does_not_change_the_ids(spark, pairs, rows):
    assert table(dense_surrogate_key(pairs, "id", ["s"], rows)) == table(by_window(pairs, "id", ["s"]))


def test_bounds_counts_and_rows_read_one_shuffle(spark):
    """The input of a distinct is scanned once, and nothing is written on the way."""
    folder = scratch_path(spark)
    skewed(spark).write.parquet(folder)
    ours = dense_surrogate_key(spark.read.parquet(folder).dropDuplicates(), "id", ["k"])
    assert ours.agg(F.max("id")).first()[0] == 60_000
    rows = ours.collect()
    plan = ours._jdf.queryExecution().executedPlan().toString()
    # The distinct is shuffled for one of four readers: number of rows, sample, counts and rows.
    assert len(rows) == 60_000 and len(re.findall(r"ReusedExchange \[k#\d+L, v#\d+L\], Exchange hashpartitioning\(k", plan)) >= 3
    assert "rangepartitioning" not in plan and "shufflepartitionidpassthrough" in plan


def test_equal_rows_get_different_ids(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "s STRING")
    assert table(dense_surrogate_key(rows, "id", ["s"])) == [("a", 1), ("a", 2), ("b", 3)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "k INT, `a name` STRING")
    ours = dense_surrogate_key(none, "id", ["k"])
    assert ours.columns == ["k", "a name", "id"]
    assert ours.count() == 0


def test_ids_do_not_change_between_actions(spark, pairs):
    ours = dense_surrogate_key(pairs, "id", ["k", "s"])
    assert table(ours) == table(ours)
    assert dict(ours.dtypes)["id"] == "bigint"


def test_rows_are_sorted_by_the_order_alone(spark, pairs):
    plan = dense_surrogate_key(pairs.repartition(4), "id", ["k", "s"])._jdf.queryExecution().optimizedPlan().toString()
    # The number of the range is the same in all rows of a task: it is no key of the sort, and no window buffers the rows.
    assert "row_number" not in plan and len(re.findall(r"Sort \[k#\d+ ASC NULLS FIRST, s#\d+ ASC NULLS FIRST\], false", plan)) == 1


def test_a_sample_of_rows_that_are_not_yet_distinct(spark, pairs):
    twice = pairs.unionByName(pairs)
    ours = dense_surrogate_key(twice.dropDuplicates(), "id", ["k", "s"], repeated=twice)
    assert table(ours) == table(by_window(pairs, "id", ["k", "s"]))


def test_rows_of_a_range_are_counted_in_the_shuffle_that_deals_them(spark, pairs):
    """The distinct is made once for counts and rows, and only rows that are sampled are aggregated."""
    ours = dense_surrogate_key(pairs.repartition(4).dropDuplicates(), "id", ["k", "s"], rows=10 << 20)
    assert len(ours.collect()) == pairs.count()
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReusedExchange [^\n]*shufflepartitionidpassthrough", plan)
    assert re.search(r"Filter \(cast\(pmod\(xxhash64\(", plan)
