"""Dates, money and CSV."""

import datetime
import os
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystar import session
from tallystar.functions.dates import date_parts, in_year, parse_date
from tallystar.functions.money import exact, times
from tallystar.plans.star import calendar
from tallystar.sources import scratch
from tallystar.sources.scratch import pin, scratch_path
from tallystar.sources.tables import read_csv, read_table, read_written, write_csv, write_table
from tests.data import table


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t STRING")


def test_month_in_any_case_and_years_of_this_century(spark):
    got = texts(spark, "28-Aug-11", "28-AUG-11", "01-jan-98", None).select(parse_date(F.col("t")))
    assert [r[0] for r in got.collect()] == [
        datetime.date(2011, 8, 28),
        datetime.date(2011, 8, 28),
        datetime.date(2098, 1, 1),
        None,
    ]


@pytest.mark.parametrize("junk", ["1-Aug-11", "28/08/11", "soon"])
def test_unreadable_dates_fail_or_are_null(spark, junk):
    rows = texts(spark, junk)
    with pytest.raises(PySparkException):
        rows.select(parse_date(F.col("t"))).collect()
    assert rows.select(parse_date(F.col("t"), lenient=True)).first()[0] is None


def test_date_parts(spark):
    days = texts(spark, "28-Aug-11", "27-Aug-11", "31-Dec-12", "01-Apr-13")
    got = days.select("t", *date_parts(parse_date(F.col("t"))))
    assert table(got) == [
        ("01-Apr-13", 2013, 2, 4, 2),
        ("27-Aug-11", 2011, 3, 8, 7),
        ("28-Aug-11", 2011, 3, 8, 1),
        ("31-Dec-12", 2012, 4, 12, 2),
    ]


def test_in_year_is_the_year_of_the_date(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'1996-12-30', DATE'2000-01-02')) AS d"
    ).withColumn("ts", F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS"))
    for name in ("d", "ts"):
        assert days.where(in_year(F.col(name), 1998) != (F.year(name) == 1998)).count() == 0


def test_in_year_reaches_the_scan(spark):
    path = scratch_path(spark)
    spark.sql("SELECT DATE'1998-05-05' AS d").write.parquet(path)
    plan = spark.read.parquet(path).where(in_year(F.col("d"), 1998))
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d,1998-01-01)" in text
    assert "LessThan(d,1999-01-01)" in text


def test_casts_cut_the_fraction_off(spark):
    row = spark.sql("SELECT CAST(2.7D AS BIGINT), CAST(-2.7D AS BIGINT), CAST(-2.7 AS BIGINT)").first()
    assert tuple(row) == (2, -2, -2)


def test_exact_changes_only_fractional_types(spark):
    rows = spark.sql("SELECT 0.1D AS d, CAST(1 AS FLOAT) AS f, 3 AS i, CAST(2.5 AS DECIMAL(9,3)) AS m")
    kinds = [exact(rows, c) for c in rows.columns]
    assert [k for _, k in rows.select(*kinds).dtypes] == ["decimal(27,10)", "decimal(27,10)", "int", "decimal(9,3)"]
    total = spark.range(10).select(F.lit(0.1).alias("d"))
    assert total.agg(F.sum(exact(total, "d"))).first()[0] == Decimal("1.0000")


@pytest.mark.parametrize(
    "values, total",
    [
        ([0.00004, 0.00004], "0.00008"),
        ([1e15, 1e15, 0.12345], "2000000000000000.12345"),
        ([0.1 + 0.2, 60.300000000000004], "60.6"),
        ([-1e15, None, 1e-10], "-999999999999999.9999999999"),
    ],
)
def test_no_digit_of_a_double_is_lost(spark, values, total):
    rows = spark.createDataFrame([(v,) for v in values], "`an amount` DOUBLE")
    assert rows.agg(F.sum(exact(rows, "an amount"))).first()[0] == Decimal(total)


@pytest.mark.parametrize("value", [1e-11, 123.45678901234, 1e18, float("nan")])
def test_a_double_that_does_not_fit_stops_the_job(spark, value):
    rows = spark.createDataFrame([(value,)], "amount DOUBLE")
    with pytest.raises(PySparkException):
        rows.select(exact(rows, "amount")).collect()


def test_a_count_times_an_amount_keeps_all_decimals(spark):
    rows = spark.createDataFrame([(3, 0.00001, Decimal("2.50"), 7)], "n BIGINT, d DOUBLE, m DECIMAL(18,2), i INT")
    rows = rows.select("n", exact(rows, "d").alias("d"), "m", "i")
    got = rows.select(*[times(F.col("n"), rows, c).alias(c) for c in ("d", "m", "i")]).first()
    assert tuple(got) == (Decimal("0.00003"), Decimal("7.5"), 21)


def test_csv_keeps_blanks_commas_and_quotes(spark):
    rows = spark.createDataFrame(
        [(1, " SAN JOSE"), (2, "P.O. Box 7, Rear "), (3, 'the "old" mill'), (4, 'a\\b, "c"'), (5, None)],
        "`a no` INT, `Street Address` STRING",
    )
    path = scratch_path(spark)
    write_csv(rows, path)
    inferred = read_csv(spark, path)
    assert inferred.dtypes == [("a no", "int"), ("Street Address", "string")]
    assert table(inferred) == table(rows)
    assert table(read_csv(spark, path, rows.schema)) == table(rows)


def test_csv_written_by_other_programs(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_bytes(b'ID,Date,City\r\n1,28-Aug-11,"Elm, ""Rear"""\r\n2,, PARIS\r\n')
    assert read_csv(spark, str(file)).collect() == [
        (1, "28-Aug-11", 'Elm, "Rear"'),
        (2, None, " PARIS"),
    ]


def test_csv_columns_are_found_by_name(spark):
    rows = spark.createDataFrame([(1, 2.5, "x"), (2, None, "")], "id INT, Cost DOUBLE, name STRING")
    path = scratch_path(spark)
    write_csv(rows, path)
    got = read_written(spark, path, "csv", "name STRING, COST DOUBLE, ID INT")
    assert got.columns == ["name", "COST", "ID"]
    assert table(got) == table(rows.select("name", "Cost", "id"))


@pytest.mark.parametrize("schema", ["id INT", "id INT, cost DOUBLE, name STRING, more INT", "id INT, cost DOUBLE, other STRING"])
def test_csv_columns_missing_or_not_declared(spark, schema):
    path = scratch_path(spark)
    write_csv(spark.createDataFrame([(1, 2.5, "x")], "id INT, cost DOUBLE, name STRING"), path)
    with pytest.raises(ValueError):
        read_csv(spark, path, schema)


@pytest.mark.parametrize("line", ["1", "1,2,3", "x,2"])
def test_csv_rows_that_do_not_fit(spark, tmp_path, line):
    file = tmp_path / "x.csv"
    file.write_text(f"a,b\n7,8\n{line}\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, str(file), "a INT, b INT").select("a").collect()


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, str(tmp_path), "a INT, b INT").collect()


def test_written_csv_comes_back_whole(spark):
    texts = ["", None, " x ", "a\nb", "a\r\nb", "\n", 'q "q" \\', ",", "\\n", "é", "'", '"', "a\n,\"b", "#"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, t STRING")
    path = scratch_path(spark)
    write_table(rows, path, "csv")
    assert table(read_written(spark, path, "csv", rows.schema)) == table(rows)


def test_csv_fields_with_line_breaks(spark):
    rows = spark.createDataFrame([(1, "1 Elm\nRear"), (2, "2 Oak")], "id INT, street STRING")
    path = scratch_path(spark)
    write_csv(rows, path)
    assert table(read_csv(spark, path, rows.schema, line_breaks=True)) == table(rows)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_are_replaced(spark, fmt):
    path = scratch_path(spark)
    for n in (5, 2):
        write_table(spark.range(n), path, fmt)
    assert table(read_table(spark, path, fmt, "id BIGINT")) == [(0,), (1,)]


def test_pinned_rows_are_fixed(spark):
    pinned = pin(spark.range(100).select(F.rand().alias("a number")))
    assert table(pinned) == table(pinned)


def test_scratch_is_below_the_folder_the_cluster_names(spark, monkeypatch):
    class Context:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, conf, context):
            self.conf, self.sparkContext = conf, context

    named = Session({"spark.checkpoint.dir": "hdfs://shared/"}, Context("spark://host:7077"))
    assert scratch_path(named).startswith("hdfs://shared/tallystar/")
    with pytest.raises(ValueError):
        scratch_path(Session({}, Context("spark://host:7077")))
    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            scratch_path(Session({}, Context(master)))
        with pytest.warns(UserWarning, match="all machines share"):
            scratch_path(Session({"spark.checkpoint.dir": "file:/tmp/x"}, Context(master)))
    monkeypatch.setattr(scratch.tempfile, "mkdtemp", lambda prefix: "/tmp/own")
    assert scratch_path(Session({}, Context("local[2]"))).startswith("/tmp/own/tallystar/")


def test_shuffles_fit_the_input(spark):
    path = scratch_path(spark)
    write_csv(spark.range(0, 1000, 1, 4), path)
    rows = read_csv(spark, path, "id BIGINT")
    assert session.fit_shuffles(rows) == 8
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        many = session.fit_shuffles(rows.select("id"))
        assert many > 30
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert session.fit_shuffles(rows.select("id"), partition_bytes=session.PARTITION_BYTES // 4) == 4 * many
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert session.fit_shuffles(rows.select("id"), split_bytes=50, partition_bytes=25) > 2 * many
        spark.conf.set("spark.sql.shuffle.partitions", 1_000_000)
        assert session.fit_shuffles(rows) == 1_000_000
        assert spark.conf.get("spark.sql.execution.rangeExchange.sampleSizePerPartition") == "10"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_scratch_of_a_job_is_deleted(spark):
    with pytest.raises(RuntimeError), scratch.scratch_of_job(spark) as path:
        pinned = pin(spark.range(3))
        assert pinned.count() == 3 and pinned.inputFiles()[0].startswith(f"file://{path}/")
        raise RuntimeError
    assert not os.path.exists(path)


@pytest.mark.parametrize("fmt", ["dd-MMM-yy HH:mm", "dd-MMM-yy'T'ss.SSS", "dd-MMM-yy z"])
def test_a_calendar_takes_no_time_of_day(spark, fmt):
    with pytest.raises(ValueError):
        calendar(texts(spark, "28-Aug-11").toDF("Date"), fmt=fmt)


def test_quoted_letters_are_no_time_of_day(spark):
    assert calendar(texts(spark, "day 28-Aug-11").toDF("Date"), fmt="'day 'dd-MMM-yy").count() == 1


def test_a_calendar_takes_no_timestamps(spark):
    with pytest.raises(TypeError):
        calendar(spark.sql("SELECT current_timestamp() AS Date"))
