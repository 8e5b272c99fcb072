"""CSV sources: fields with line breaks over many splits, rejected rows, types from the text columns."""

import csv
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystar.plans.jobs import main, read_star
from tallystar.sources.records import csv_records
from tallystar.sources.scratch import scratch_path
from tallystar.sources.tables import read_csv, read_records, read_source, write_csv
from tallystar.sources.types_of_text import types_of
from tests.data import ROWS, SCHEMA, table, wide

COLUMNS = "a INT, `B c` STRING, d DOUBLE"


@pytest.fixture
def small_splits(spark):
    """A function that sets how many bytes a split has."""

    def cut(size):
        spark.conf.set("spark.sql.files.openCostInBytes", str(size))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield cut
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def file_of(path, name, rows, end="\n"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerows(rows)
    return path


def some_rows(seed, n):
    rng = random.Random(seed)
    texts = ["x", 'a"b', "one\ntwo", 'one\n"two",\n\nthree', "", "\n", '"', "ä\n" * 30]
    return [(seed * 1000 + i, rng.choice(texts), rng.choice(["1.5", "", "2"])) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [150, 1 << 20])
def test_records_over_splits_are_those_of_whole_files(spark, tmp_path, small_splits, end, size):
    path = str(tmp_path / "many")
    for seed in range(2):
        file_of(path, f"{seed}.csv", [("a", "B c", "d"), *some_rows(seed, 40)], end)
    whole = spark.read.csv(path, schema=COLUMNS, header=True, escape='"', multiLine=True, lineSep=end)
    want = table(whole)
    small_splits(size)
    rows, rejected = read_records(spark, path, COLUMNS)
    assert rejected is None and table(rows) == want and len(want) == 80
    assert (spark.read.text(path).rdd.getNumPartitions() > 10) == (size == 150)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 99), st.text(alphabet='a,"\n\r é', max_size=40)), max_size=12), st.integers(30, 200))
def test_any_text(spark, tmp_path_factory, small_splits, rows, size):
    path = file_of(str(tmp_path_factory.mktemp("any")), "f.csv", [("k", "v"), *rows])
    small_splits(size)
    got, _ = read_records(spark, path, "k INT, v STRING")
    want = [(k, v or None) for k, v in rows]
    assert table(got) == sorted(want, key=repr)


def test_line_numbers_and_blank_lines(spark, tmp_path, small_splits):
    path = str(tmp_path / "f.csv")
    with open(path, "w", newline="") as out:
        out.write('﻿k,v\n1,"a\n\nb"\n\n2,c\n')
    for size in (3, 1000):
        small_splits(size)
        got = csv_records(spark, path).select("line", "record").collect()
        assert sorted(map(tuple, got)) == [(1, "k,v"), (2, '1,"a\n\nb"'), (6, "2,c")]


def test_a_field_that_never_ends_stops_the_read(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    with open(path, "w") as out:
        out.write('k,v\n1,"a\n2,c\n')
    with pytest.raises(PySparkException, match="never closed"):
        csv_records(spark, path).collect()


def test_empty_files_and_headers_alone(spark, tmp_path):
    path = file_of(str(tmp_path / "f"), "a.csv", [("k", "v")])
    assert table(read_records(spark, path, "k INT, v STRING")[0]) == []
    file_of(path, "b.csv", [])
    assert table(read_records(spark, path, "v STRING, K INT", reject=True)[0]) == []


def test_another_header_stops_the_read(spark, tmp_path):
    path = file_of(str(tmp_path / "f"), "a.csv", [("k", "v"), (1, "a")])
    file_of(path, "b.csv", [("v", "k"), ("a", 1)])
    for reject in (False, True):
        with pytest.raises(PySparkException, match="another header in"):
            table(read_records(spark, path, "k INT, v STRING", reject)[0])


def test_a_row_that_does_not_fit(spark, tmp_path):
    path = file_of(str(tmp_path / "f"), "a.csv", [("k", "v"), (1, "a\nb"), ("x", "c"), (2, "d", 3), (4,), (5, "e")])
    with pytest.raises((PySparkException, Py4JJavaError)):
        table(read_records(spark, path, "k INT, v STRING")[0])
    rows, rejected = read_records(spark, path, "V STRING, k INT", reject=True)
    assert table(rows) == [("a\nb", 1), ("e", 5)] and rows.columns == ["V", "k"]
    assert table(rejected.select("line", "record")) == [(4, "x,c"), (5, "2,d,3"), (6, "4")]
    assert {os.path.basename(r["file"]) for r in rejected.collect()} == {"a.csv"}
    # Without a schema only the number of fields can be wrong.
    rows, rejected = read_source(spark, path, reject=True)
    assert rows.schema.simpleString() == "struct<k:string,v:string>" and table(rejected.select("line")) == [(5,), (6,)]


def test_the_star_goes_on_without_rejected_rows(spark):
    source, plain, built, clean, rejects = (scratch_path(spark) for _ in range(5))
    write_csv(wide(spark).coalesce(1), plain)
    good = [n for n in os.listdir(plain.removeprefix("file:")) if n.endswith(".csv")][0]
    with open(f"{plain.removeprefix('file:')}/{good}") as f:
        text = f.read()
    os.makedirs(source.removeprefix("file:"))
    bad = text.splitlines()[1]
    with open(f"{source.removeprefix('file:')}/a.csv", "w") as f:
        f.write(text + bad + ",more\n" + bad.replace(",900,", ",many,", 1) + "\n")
    with pytest.raises(Exception):
        main(["star", source, built, "--source-schema", SCHEMA])
    main(["star", source, built, "--source-schema", SCHEMA, "--rejects", rejects])
    main(["star", plain, clean, "--source-schema", SCHEMA])
    assert table(read_csv(spark, rejects).select("line")) == [(len(ROWS) + 2,), (len(ROWS) + 3,)]
    assert ("source", "rejected rows", 2) in table(read_star(spark, built, "star_checks"))
    for name in ("inventory_fact", "customers_dim", "time_dim"):
        assert table(read_star(spark, built, name)) == table(read_star(spark, clean, name))
    results = [scratch_path(spark) for _ in range(2)]
    for star, out in zip((built, clean), results):
        main(["reports", star, out])
    for name in ("top_10_customers", "quarterly_profit"):
        assert table(read_csv(spark, f"{results[0]}/{name}.csv")) == table(read_csv(spark, f"{results[1]}/{name}.csv"))


FIELDS = [
    "1", "-7", "+3", "007", "2147483648", "99999999999999999999", "1.0", ".5", "5.", "1e5", "-2E-3", "1.5f", "2d", "NaN", "Inf", "-Inf", "Infinity",
    "2011-01-05", "2011-13-05", "05-Jan-11", "2011-01-05 10:00:00", "2011-01-05T10:00:00Z", "true", "FALSE", "yes", " 1", "1 ", " 1.5 ", "x", None,
]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(FIELDS), min_size=4, max_size=4), min_size=1, max_size=4))
def test_types_are_those_the_reader_infers(spark, tmp_path_factory, columns):
    rows = list(zip(*columns))
    names = [f"c{i}" for i in range(len(columns))] + ["n"]
    path = file_of(str(tmp_path_factory.mktemp("types")), "f.csv", [names, *((*r, i) for i, r in enumerate(rows))])
    inferred = spark.read.csv(path, header=True, escape='"', inferSchema=True)
    ours, _ = read_source(spark, path)
    assert ours.schema.simpleString() == inferred.schema.simpleString()
    assert repr(table(ours)) == repr(table(inferred))


def test_types_of_single_fields(spark, tmp_path):
    path = file_of(str(tmp_path / "f"), "f.csv", [[f"c{i}" for i in range(len(FIELDS))], FIELDS])
    ours, _ = read_source(spark, path)
    inferred = read_csv(spark, path)
    assert ours.schema == inferred.schema and repr(table(ours)) == repr(table(inferred))


def test_types_of_the_sales(spark):
    path = scratch_path(spark)
    write_csv(wide(spark), path)
    ours, _ = read_source(spark, path)
    inferred = read_csv(spark, path)
    assert ours.schema.simpleString() == inferred.schema.simpleString() and table(ours) == table(inferred)
    assert types_of(spark.createDataFrame([], "a STRING")).simpleString() == "struct<a:string>"
