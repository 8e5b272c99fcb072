"""Reports: hand-written cases, and the plain joins they must agree with."""

import os
import random
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystar.plans import jobs, order_tables, queries, reports
from tallystar.plans.jobs import build_star, main, read_star, run_reports, stored_schemas
from tallystar.plans.layout import StarLayout
from tallystar.plans.order_tables import OrderTables
from tallystar.plans.star import distinct_rows, inventory_fact, time_dimension
from tallystar.sources.scratch import pin, pin_in_turn, scratch_path
from tallystar.sources.tables import read_csv, table_path, write_csv, write_table
from tallystar.sources.versions import current
from tests.data import ROWS, SCHEMA, table, wide

TABLES = ["inventory_fact", "customers_dim", "products_dim", "sellers_dim", "time_dim", "transaction_dim"]


@pytest.fixture(scope="module", params=["csv", "parquet"])
def star(request, spark):
    path = scratch_path(spark)
    schemas = build_star(wide(spark), path, fmt=request.param)
    return path, request.param, schemas


def run(spark, star, year=2011, **options):
    path, fmt, schemas = star
    out = scratch_path(spark)
    run_reports(spark, path, out, year, fmt=fmt, schemas=schemas, **options)
    return lambda name: [tuple(r) for r in read_csv(spark, table_path(out, name, "csv")).collect()]


def test_star_tables(spark, star):
    path, fmt, schemas = star
    assert sorted(schemas) == sorted(TABLES)
    for name, schema in schemas.items():
        written = read_star(spark, path, name)
        assert written.schema.simpleString() == schema.simpleString()
        ids = [c for c in written.columns if c == "FACT_ID" or c.endswith("_DIM_ID")]
        own = "FACT_ID" if name == "inventory_fact" else ids[-1]
        values = [r[0] for r in written.select(own).orderBy(own).collect()]
        assert values == list(range(1, len(values) + 1))


def test_reports(spark, star):
    report = run(spark, star)
    # Customer 3 has two addresses, so each of their sales counts twice;
    # transaction 900 has two lines, so its amount counts twice.
    assert report("top_10_customers") == [
        (2011, "Cy Cedar", 3, 500),
        (2011, "Ann Ash", 1, 200),
        (2011, "Bo Birch", 2, 200),
    ]
    assert report("statewise_orders") == [("CALIFORNIA", 4), ("OHIO", 4)]
    assert report("payment_mode_by_state") == [("NET BANKING", 1), ("PAYPAL", 2), ("COD", 3)]
    assert report("quarterly_profit") == [(2011, 1, 5), (2011, 3, -6), (2011, 4, 4)]
    assert report("quarterly_sales_count") == [(2011, 1, 4005, "LAPTOP", 1), (2011, 3, 4005, "LAPTOP", 2)]


def test_checks_of_the_star(spark, star):
    path, fmt, _ = star
    got = read_star(spark, path, "star_checks")
    assert table(got) == [
        ("customers_dim", "repeated keys", 1),
        ("inventory_fact", "undated sales", 1),
        ("products_dim", "repeated keys", 0),
        ("sellers_dim", "repeated keys", 0),
        ("transaction_dim", "repeated keys", 0),
    ]


def test_schemas_are_stored_with_the_star(spark, star):
    path, _, schemas = star
    assert stored_schemas(spark, path) == schemas
    assert stored_schemas(spark, scratch_path(spark)) == {}


def sums(spark, path):
    out = run_reports(spark, path, scratch_path(spark), 2011)
    return {name: [tuple(r) for r in report.collect()] for name, report in out.items()}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_job_that_fails_leaves_the_old_star(spark, monkeypatch, fmt):
    path = scratch_path(spark)
    build_star(wide(spark), path, fmt=fmt)
    before, old = sums(spark, path), current(spark, path)
    more = ROWS + [tuple("02-Jan-11" if v == "05-Jan-11" else v for v in ROWS[0])]
    tables = []

    def dies(made, at, kind):
        if len(tables) == 2:
            raise RuntimeError("killed")
        tables.append(at)
        write_table(made, at, kind)

    monkeypatch.setattr(jobs, "write_table", dies)
    with pytest.raises(RuntimeError, match="killed"):
        build_star(wide(spark, more), path, fmt=fmt)
    assert [os.path.basename(t) for t in tables] == [f"time_dim.{fmt}", f"inventory_fact.{fmt}"]
    assert current(spark, path) == old and sums(spark, path) == before
    assert not os.path.exists(os.path.dirname(tables[0]).removeprefix("file:"))
    monkeypatch.undo()
    build_star(wide(spark, more), path, fmt=fmt)
    assert current(spark, path).number == old.number + 1 and sums(spark, path) != before


@pytest.mark.parametrize("fmt, codec", [("csv", "gzip"), ("parquet", "zstd")])
def test_a_compressed_star_gives_the_same_reports(spark, fmt, codec):
    plain, small = scratch_path(spark), scratch_path(spark)
    build_star(wide(spark), plain, fmt=fmt)
    build_star(wide(spark), small, fmt=fmt, codec=codec)
    files = read_star(spark, small, "inventory_fact").inputFiles()
    assert files and all({"gzip": ".gz", "zstd": ".zstd."}[codec] in f for f in files)
    assert sums(spark, small) == sums(spark, plain)


def test_the_fact_is_written_before_the_dimensions_begin(spark, monkeypatch):
    order = []
    monkeypatch.setattr(jobs, "write_table", lambda made, at, kind: order.append(os.path.basename(at)) or write_table(made, at, kind))
    monkeypatch.setattr(jobs, "distinct_rows", lambda *a: order.append("dimension") or distinct_rows(*a))
    build_star(wide(spark), scratch_path(spark), fmt="parquet")
    assert order[:3] == ["time_dim.parquet", "inventory_fact.parquet", "dimension"]


def test_the_wide_table_goes_when_the_star_is_built(spark, monkeypatch):
    made, star = [], scratch_path(spark)

    class Tables:
        def __init__(self):
            self.spark = spark

        def pinned_wide(self):
            made.append(pin(wide(spark)))
            return made[0]

    monkeypatch.setattr(queries, "LAYOUT", StarLayout())
    queries._build(Tables(), star, "parquet")
    assert read_star(spark, star, "inventory_fact").count() == 6
    assert made and not any(os.path.exists(f.removeprefix("file://")) for f in made[0].inputFiles())


def test_lines_meet_their_orders_in_turns(spark, tmp_path, monkeypatch):
    turns = []
    monkeypatch.setattr(order_tables, "TURN_LINES", 10)
    monkeypatch.setattr(order_tables, "pin_in_turn", lambda frames, *a: pin_in_turn((turns.append(1) or f for f in frames), *a))
    made = {
        "nation": [(1, "OHIO", 0)],
        "customer": [(c, f"c{c}", 1, 0.0, "BUILDING") for c in range(3)],
        "supplier": [(s, f"s{s}", 1, 0.0) for s in range(2)],
        "part": [(p, f"p{p}", "b", "t", 1, 2.5) for p in range(4)],
        "orders": [(o, o % 4, "O", 10.0, None, "1-URGENT") for o in range(20)] + [(None, 1, "O", 1.0, None, "x")],
        "lineitem": [(k % 25, k % 5, k % 3, k, 2.0, 3.0, 0.0, 0.0, "N", "O", None) for k in range(75)] + [(None, 1, 1, 1, 2.0, 3.0, 0.0, 0.0, "N", "O", None)] * 2,
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, order_tables.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    got = OrderTables(spark, str(tmp_path)).pinned_wide()
    lines = [r for r in made["lineitem"] if r[0] is not None and r[0] < 20 and r[0] % 4 < 3 and r[1] < 4 and r[2] < 2]
    wanted = sorted((r[0], r[1], f"p{r[1]}", r[2], f"s{r[2]}", r[0] % 4, f"c{r[0] % 4}", Decimal("5.0000"), Decimal("3.00")) for r in lines)
    columns = ["TRANSACTION_ID", "PRODUCT_ID", "PRODUCT Name", "SELLER_ID", "SELLER_NAME", "CUSTOMER_ID", "Customer Name", "PRODUCT_COST_PRICE", "PRODUCT_SELLING_PRICE"]
    assert sorted(map(tuple, got.select(*columns).collect())) == wanted and len(turns) == 4


def test_old_versions_are_deleted_but_the_last(spark):
    path = scratch_path(spark)
    for _ in range(4):
        build_star(wide(spark), path, fmt="parquet", only=["sellers_dim"])
    folder = path.removeprefix("file:")
    assert len(os.listdir(f"{folder}/versions")) == len(os.listdir(f"{folder}/manifests")) == 2
    assert current(spark, path).number == 4 and read_star(spark, path, "sellers_dim").count() == 1


def test_one_table_is_rebuilt_and_the_others_stay(spark):
    path = scratch_path(spark)
    first = build_star(wide(spark), path)
    there = current(spark, path).tables
    assert list(build_star(wide(spark), path, fmt="parquet", only=["products_dim"])) == ["products_dim"]
    now = current(spark, path).tables
    assert {n for n in there if there[n] != now[n]} == {"products_dim"} and now["products_dim"].fmt == "parquet"
    assert stored_schemas(spark, path) == first
    assert sums(spark, path)["quarterly_sales_count"] == [(2011, 1, 4005, "LAPTOP", 1), (2011, 3, 4005, "LAPTOP", 2)]
    # The fact refers to the ids of the time table: one is not rebuilt without the other.
    assert sorted(build_star(wide(spark), path, only=["time_dim"])) == ["inventory_fact", "time_dim"]


def test_a_star_of_another_origin(spark):
    path = scratch_path(spark)
    build_star(wide(spark), path)
    plain = scratch_path(spark)
    for name in TABLES:
        write_csv(read_star(spark, path, name), table_path(plain, name, "csv"))
    assert current(spark, plain).tables == {}
    assert sums(spark, plain) == sums(spark, path)


def test_a_line_break_in_an_address(spark):
    """The same reports from both formats."""
    broken = [tuple("1 Elm\nRear" if v == "1 Elm, Rear" else v for v in row) for row in ROWS]
    for fmt in ("csv", "parquet"):
        path = scratch_path(spark)
        build_star(wide(spark, broken), path, fmt=fmt)
        out = run_reports(spark, path, scratch_path(spark), 2011, fmt=fmt)
        assert [tuple(r) for r in out["statewise_orders"].collect()] == [("CALIFORNIA", 4), ("OHIO", 4)]


def test_a_source_whose_columns_come_in_another_order(spark):
    source, built, out = (scratch_path(spark) for _ in range(3))
    write_csv(wide(spark), source)
    names = [f.strip() for f in SCHEMA.replace("\n", " ").split(",")]
    main(["star", source, built, "--source-schema", ", ".join(reversed(names))])
    main(["reports", built, out])
    got = [tuple(r) for r in read_csv(spark, f"{out}/quarterly_profit.csv").collect()]
    assert got == [(2011, 1, 5), (2011, 3, -6), (2011, 4, 4)]


def test_jobs_leave_no_scratch(spark):
    source, built, out = (scratch_path(spark) for _ in range(3))
    write_csv(wide(spark), source)
    root = os.path.dirname(source).removeprefix("file:")
    before = set(os.listdir(root))
    main(["star", source, built])
    main(["reports", built, out])
    with pytest.raises((PySparkException, Py4JJavaError)):
        main(["star", source, built + "x", "--source-schema", "Date INT, " + SCHEMA.split(",", 1)[1]])
    made = {os.path.basename(p) for p in (built, out, built + "x")}
    assert set(os.listdir(root)) - before <= made


def test_a_csv_star_is_parsed_once(spark, monkeypatch):
    path, read = scratch_path(spark), []
    build_star(wide(spark), path)
    original = jobs.read_written
    monkeypatch.setattr(jobs, "read_written", lambda s, p, *a: read.append(p) or original(s, p, *a))
    results = run_reports(spark, path, scratch_path(spark), 2011)
    stars = [os.path.basename(p) for p in read if p.startswith(path)]
    assert sorted(stars) == ["customers_dim.csv", "inventory_fact.csv", "products_dim.csv", "time_dim.csv", "transaction_dim.csv"]
    assert len(results) == 5


def test_a_csv_star_is_built_without_parsing_its_dimensions(spark, monkeypatch):
    read, original = [], jobs.read_written
    monkeypatch.setattr(jobs, "read_written", lambda s, p, *a: read.append(os.path.basename(p)) or original(s, p, *a))
    build_star(wide(spark), scratch_path(spark), fmt="csv")
    assert read == ["time_dim.csv"]


def test_report_columns(spark, star):
    path, fmt, schemas = star
    results = run_reports(spark, path, scratch_path(spark), 2011, fmt=fmt, schemas=schemas)
    assert {name: report.columns for name, report in results.items()} == {
        "top_10_customers": ["YEAR", "Customer Name", "CUSTOMER_ID", "TOTAL_SELLING_PRICE"],
        "statewise_orders": ["CUSTOMER_STATE", "ORDER_COUNT"],
        "payment_mode_by_state": ["TRANSACTION_TYPE", "ORDER_COUNT"],
        "quarterly_profit": ["YEAR", "QUARTER", "PROFIT"],
        "quarterly_sales_count": ["YEAR", "QUARTER", "CATEGORY_ID", "PRODUCT Name", "SALES_COUNT"],
    }


def test_arguments(spark, star):
    report = run(spark, star, k=2, category=None)
    assert [r[2] for r in report("top_10_customers")] == [3, 1]
    assert report("quarterly_sales_count") == [
        (2011, 1, 4004, "TELEVISION", 1),
        (2011, 1, 4005, "LAPTOP", 1),
        (2011, 3, 4005, "LAPTOP", 2),
        (2011, 4, 4004, "TELEVISION", 1),
    ]
    report = run(spark, star, year=2012, category="4004")
    assert report("quarterly_profit") == [(2012, 1, 1)]
    assert report("quarterly_sales_count") == []


def test_a_year_without_sales(spark, star):
    report = run(spark, star, year=1999)
    for name in ("top_10_customers", "quarterly_profit", "quarterly_sales_count"):
        assert report(name) == []
    assert report("statewise_orders") != []


def test_command_line(spark):
    source, built, out = (scratch_path(spark) for _ in range(3))
    write_csv(wide(spark), source)
    main(["star", source, built])
    main(["reports", built, out, "--category", "all", "--top", "1"])
    assert [tuple(r) for r in read_csv(spark, f"{out}/top_10_customers.csv").collect()] == [
        (2011, "Cy Cedar", 3, 500)
    ]
    assert read_csv(spark, f"{out}/quarterly_sales_count.csv").count() == 4


# Random stars with repeated keys on both sides, orphans and nulls, a third of the
# facts on one key.


@pytest.fixture(scope="module", params=range(3))
def random_star(request, spark):
    rng = random.Random(request.param)

    def key(n):
        return 0 if rng.random() < 0.33 else rng.choice([None, *range(n)])

    facts = [
        (key(40), key(12), key(9), key(20), Decimal(rng.randint(-999, 999)) / 100, Decimal(rng.randint(-999, 999)) / 100)
        for _ in range(900)
    ]
    customers = [(key(9), rng.choice("ab"), rng.choice(["Ohio", "OHIO", "Texas", None])) for _ in range(14)]
    products = [(key(12), rng.choice([4004, 4005]), rng.choice("xyz")) for _ in range(16)]
    transactions = [(key(20), rng.choice([None, 5, 7, 11]), rng.choice(["COD", "CARD", None])) for _ in range(30)]
    time = [(i, 2010 + i // 15, i // 4 % 4 + 1) for i in range(36)]
    frames = {
        "fact": (facts, "TIME_DIM_ID INT, PRODUCT_ID INT, CUSTOMER_ID INT, TRANSACTION_ID INT, "
                        "PRODUCT_COST_PRICE DECIMAL(9,2), PRODUCT_SELLING_PRICE DECIMAL(9,2)"),
        "customers": (customers, "CUSTOMER_ID INT, `Customer Name` STRING, CUSTOMER_STATE STRING"),
        "products": (products, "PRODUCT_ID INT, CATEGORY_ID INT, `PRODUCT Name` STRING"),
        "transactions": (transactions, "TRANSACTION_ID INT, TRANSACTION_AMOUNT INT, TRANSACTION_TYPE STRING"),
        "time": (time, "TIME_DIM_ID INT, YEAR INT, QUARTER INT"),
    }
    return {name: pin(spark.createDataFrame(rows, schema)) for name, (rows, schema) in frames.items()}


def test_top_customers_is_the_plain_join(random_star):
    s = random_star
    ours = reports.top_customers(s["fact"], s["customers"], s["time"], s["transactions"], 2011, k=1000)
    plain = (
        s["fact"].join(s["customers"], "CUSTOMER_ID").join(s["time"], "TIME_DIM_ID")
        .join(s["transactions"], "TRANSACTION_ID").where("YEAR = 2011")
        .groupBy("YEAR", "Customer Name", "CUSTOMER_ID").agg(F.sum("TRANSACTION_AMOUNT"))
    )
    assert table(ours) == table(plain)
    assert [r[3] for r in ours.collect()] == sorted((r[3] for r in plain.collect()), reverse=True)


def test_state_orders_is_the_plain_join(random_star):
    s = random_star
    plain = (
        s["fact"].join(s["customers"], "CUSTOMER_ID")
        .groupBy(F.upper("CUSTOMER_STATE")).agg(F.count("TRANSACTION_ID"))
    )
    assert table(reports.state_orders(s["fact"], s["customers"])) == table(plain)


def test_payment_modes_is_the_plain_join(random_star):
    s = random_star
    plain = (
        s["fact"].join(s["transactions"], "TRANSACTION_ID")
        .groupBy("TRANSACTION_TYPE").agg(F.count("TRANSACTION_ID"))
    )
    assert table(reports.payment_modes(s["fact"], s["transactions"])) == table(plain)


def test_quarterly_profit_is_the_plain_join(random_star):
    s = random_star
    plain = (
        s["fact"].join(s["time"], "TIME_DIM_ID").where("YEAR = 2011").groupBy("YEAR", "QUARTER")
        .agg(F.sum(F.col("PRODUCT_SELLING_PRICE") - F.col("PRODUCT_COST_PRICE")).cast("int"))
    )
    assert table(reports.quarterly_profit(s["fact"], s["time"], 2011)) == table(plain)


@pytest.mark.parametrize("category", [4005, None])
def test_category_sales_is_the_plain_join(random_star, category):
    s = random_star
    plain = s["fact"].join(s["time"], "TIME_DIM_ID").join(s["products"], "PRODUCT_ID").where("YEAR = 2011")
    if category:
        plain = plain.where(F.col("CATEGORY_ID") == category)
    plain = plain.groupBy("YEAR", "QUARTER", "CATEGORY_ID", "PRODUCT Name").agg(F.count("TRANSACTION_ID"))
    ours = reports.category_sales(s["fact"], s["time"], s["products"], 2011, category)
    assert table(ours) == table(plain)


@pytest.mark.parametrize("category", [4005, None])
def test_all_reports_are_the_single_ones(random_star, category):
    s = random_star
    ours = reports.all_reports(s["fact"], s["customers"], s["time"], s["products"], s["transactions"], 2011, category, 1000)
    single = {
        "top_10_customers": reports.top_customers(s["fact"], s["customers"], s["time"], s["transactions"], 2011, 1000),
        "statewise_orders": reports.state_orders(s["fact"], s["customers"]),
        "payment_mode_by_state": reports.payment_modes(s["fact"], s["transactions"]),
        "quarterly_profit": reports.quarterly_profit(s["fact"], s["time"], 2011),
        "quarterly_sales_count": reports.category_sales(s["fact"], s["time"], s["products"], 2011, category),
    }
    assert {n: table(r) for n, r in ours.items()} == {n: table(r) for n, r in single.items()}
    assert {n: r.schema.simpleString() for n, r in ours.items()} == {n: r.schema.simpleString() for n, r in single.items()}


def test_all_reports_pass_over_the_fact_twice(spark, random_star, monkeypatch):
    pinned = []
    monkeypatch.setattr(reports, "pin", lambda df: pinned.append(df) or pin(df))
    s = random_star
    ours = reports.all_reports(s["fact"], s["customers"], s["time"], s["products"], s["transactions"], 2011)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count(s["fact"].inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://"))

    assert [scans(df) for df in pinned] == [1, 1] and [scans(r) for r in ours.values()] == [0] * 5


def rows_scanned(plan):
    """Rows that each scan below ``plan`` gave out."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from rows_scanned(plan.executedPlan())
    elif "QueryStage" in name:
        yield from rows_scanned(plan.plan())
    elif name.startswith("Scan"):
        yield plan.metrics().apply("numOutputRows").value()
    else:
        for i in range(plan.children().size()):
            yield from rows_scanned(plan.children().apply(i))


def test_only_the_year_is_read_from_a_written_fact_table(spark):
    """The ids of a year are a range of the sorted fact table, and the scan skips the rest."""
    days = spark.range(0, 1461).select(F.expr("date_add(DATE'2010-01-01', CAST(id AS INT))").alias("Date"))
    lines = spark.range(20).select(F.col("id").cast("int").alias("line"))
    rows = days.crossJoin(lines).select(
        F.date_format("Date", "dd-MMM-yy").alias("Date"),
        *(F.col("line").alias(c) for c in ("TRANSACTION_ID", "PRODUCT_ID", "CUSTOMER_ID", "SELLER_ID")),
        F.lit(1).alias("PRODUCT_COST_PRICE"),
        F.lit(3).alias("PRODUCT_SELLING_PRICE"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        time = pin(time_dimension(rows))
        fact = pin(inventory_fact(rows, time, StarLayout().fact))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    report = reports.quarterly_profit(fact, time, 2011)
    assert [r["PROFIT"] for r in report.collect()] == [90 * 40, 91 * 40, 92 * 40, 92 * 40]
    plan = report._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" not in plan.toString()
    assert max(rows_scanned(plan)) < fact.count() / 2


def test_customers_are_joined_without_a_further_shuffle(spark, random_star):
    s = random_star
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ours = reports.top_customers(s["fact"], s["customers"], s["time"], s["transactions"], 2011)
        plan = ours._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line for line in plan.split("\n") if "Exchange hashpartitioning(CUSTOMER_ID" in line and "TRANSACTION_ID" not in line]
    assert len(lines) == 2  # one for each side of the join


def test_a_date_key_reads_no_calendar(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    t = OrderTables(spark, folder)
    plan = reports.quarterly_profit(t.sales(1998), None, 1998, time_key="Date")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "o_orderdate" in line]
    assert len(scans) == 1 and "GreaterThanOrEqual(o_orderdate" in scans[0]


def test_a_hot_order_is_split(spark):
    """A third of all lines in one order: the join splits them, and no line is lost."""
    folder = scratch_path(spark)
    spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        (F.col("id") % 100).alias("l_partkey"),
        F.col("id").alias("l_suppkey"),
        F.lit(1.0).alias("l_quantity"),
        (F.col("id") % 1000).cast("double").alias("l_extendedprice"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(5000).selectExpr(
        "id AS o_orderkey", "id % 10 AS o_custkey", "TIMESTAMP_NTZ'1998-03-04 05:06:07' AS o_orderdate",
        "1.0D AS o_totalprice", "'COD' AS o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(100).selectExpr(
        "id AS p_partkey", "'p' AS p_type", "'n' AS p_name", "'b' AS p_brand", "2.0D AS p_retailprice",
    ).write.parquet(f"{folder}/part.parquet")
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in tight.items():
        spark.conf.set(name, value)
    try:
        sales = OrderTables(spark, folder).sales()
        rows = sales.collect()
        plan = sales._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in tight:
            spark.conf.unset(name)
    assert len({r["SELLER_ID"] for r in rows}) == len(rows) == 300_000
    assert "SortMergeJoin(skew=true)" in plan


def test_the_transactions_are_filtered_before_their_shuffle(spark):
    """In the job, a Bloom filter of the year's transactions lies below the shuffle of all years'."""
    transactions = pin(spark.range(200_000).selectExpr("id AS TRANSACTION_ID", "id % 7 AS TRANSACTION_AMOUNT", "'COD' AS TRANSACTION_TYPE"))
    customers = pin(spark.range(50).selectExpr("id AS CUSTOMER_ID", "'n' AS `Customer Name`", "'s' AS CUSTOMER_STATE"))
    products = pin(spark.range(5).selectExpr("id AS PRODUCT_ID", "1 AS CATEGORY_ID", "'p' AS `PRODUCT Name`"))
    fact = pin(
        spark.range(20_000).selectExpr(
            "id * 10 AS TRANSACTION_ID", "id % 50 AS CUSTOMER_ID", "id % 5 AS PRODUCT_ID", "1 AS PRODUCT_COST_PRICE", "2 AS PRODUCT_SELLING_PRICE",
            "date_add(DATE'2011-01-01', CAST(id % 3650 AS INT)) AS Date",
        )
    )
    lowered = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        made = reports.all_reports(fact, customers, None, products, transactions, 2011, None, 1000, "Date")
        report = made["top_10_customers"]
        got = table(report)
        plan = report._jdf.queryExecution().executedPlan()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == table(reports.top_customers(fact, customers, None, transactions, 2011, 1000, "Date"))
    filtered = list(rows_of_filters(plan))
    matching = fact.where(F.year("Date") == 2011).select("TRANSACTION_ID").distinct().count()
    assert len(filtered) == 1 and matching <= filtered[0] <= 1.1 * matching


def rows_of_filters(plan):
    """Rows that each filter by ``might_contain`` below a shuffle lets through."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        yield from rows_of_filters(plan.executedPlan())
    elif "QueryStage" in name:
        yield from rows_of_filters(plan.plan())
    else:
        if name == "Filter" and "might_contain" in plan.condition().toString():
            yield plan.metrics().apply("numOutputRows").value()
        for i in range(plan.children().size()):
            yield from rows_of_filters(plan.children().apply(i))
