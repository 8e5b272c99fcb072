"""Every operator, dimension, report and job as a query over the order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.dates import date_parts, in_year, parse_date
from tallystar.operators.surrogate import dense_surrogate_key
from tallystar.plans import reports
from tallystar.plans.jobs import IDS, build_star, read_star, run_reports
from tallystar.plans.order_tables import LAYOUT, MONEY, SCHEMAS, OrderTables
from tallystar.plans.star import (
    distinct_dimension,
    inventory_fact,
    product_dimension,
    repeated_keys,
    time_dimension,
    undated_sales,
)
from tallystar.session import fit_shuffles, prepare
from tallystar.sources.scratch import pin, scratch_of_job, scratch_path
from tallystar.sources.tables import read_csv, write_csv

Query = Callable[[OrderTables], DataFrame]

YEAR = 1998
CATEGORY = "PROMO"


# Sources and sinks


def _customer_csv(t: OrderTables) -> str:
    path = scratch_path(t.spark)
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    write_csv(t.table("customer").select(*columns), path)
    return path


def csv_scan(t: OrderTables) -> DataFrame:
    return read_csv(t.spark, _customer_csv(t))


def csv_scan_schema(t: OrderTables) -> DataFrame:
    return read_csv(t.spark, _customer_csv(t), SCHEMAS["customer"])


def csv_scan_reordered(t: OrderTables) -> DataFrame:
    """The columns are found by name: the schema lists them in another order and case than the file."""
    backwards = "C_MKTSEGMENT STRING, c_acctbal DOUBLE, c_nationkey INT, c_name STRING, c_custkey BIGINT"
    read = read_csv(t.spark, _customer_csv(t), backwards)
    return read.withColumnRenamed("C_MKTSEGMENT", "c_mktsegment")


def csv_sink(t: OrderTables) -> DataFrame:
    counts = (
        t.table("orders")
        .groupBy(F.col("o_orderpriority").alias("transaction_type"))
        .agg(F.count("o_orderkey").alias("order_count"))
    )
    path = scratch_path(t.spark)
    write_csv(counts, path)
    return read_csv(t.spark, path, "transaction_type STRING, order_count BIGINT")


# Projections and scalar expressions


def project_columns(t: OrderTables) -> DataFrame:
    # Names are found in any case.
    day = F.col("O_ORDERDATE").alias("o_orderdate")
    return t.table("orders").select("o_orderkey", day, "o_totalprice", "o_orderpriority")


def spaced_alias(t: OrderTables) -> DataFrame:
    return t.table("customer").select(
        F.col("c_custkey").alias("CUSTOMER_ID"), F.col("c_name").alias("Customer Name")
    )


def arith_subtract(t: OrderTables) -> DataFrame:
    diff = F.col("l_extendedprice").cast(MONEY) - F.col("l_quantity").cast(MONEY)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", diff.alias("diff"))


def cast_truncate(t: OrderTables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("bigint").alias("price_int"),
        (-F.col("l_extendedprice")).cast("bigint").alias("negative_int"),
    )


def upper_case(t: OrderTables) -> DataFrame:
    return t.table("part").select("p_partkey", F.upper("p_name").alias("p_name"))


def _event_dates(t: OrderTables) -> DataFrame:
    """Events with their day as text, the way the sales data writes dates."""
    return t.table("events").select("event_id", F.date_format("ts", "dd-MMM-yy").alias("Date"))


def parse_date_text(t: OrderTables) -> DataFrame:
    return _event_dates(t).select("event_id", parse_date(F.col("Date")).alias("d"))


def date_parts_of_orders(t: OrderTables) -> DataFrame:
    day = F.col("order_date")
    days = t.dates().distinct().withColumnRenamed("Date", "order_date")
    return days.select(day, *date_parts(day)).toDF(
        "order_date", "year", "quarter", "month", "day_of_week"
    )


# Filters


def filter_equality(t: OrderTables) -> DataFrame:
    return (
        t.table("orders")
        .where(in_year(F.col("o_orderdate"), YEAR))
        .select("o_orderkey", "o_orderdate")
    )


def filter_chained(t: OrderTables) -> DataFrame:
    return (
        t.table("orders")
        .filter(in_year(F.col("o_orderdate"), YEAR))
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select("o_orderkey", "o_orderdate")
    )


# Joins


def inner_join(t: OrderTables) -> DataFrame:
    orders = t.table("orders").withColumnRenamed("o_custkey", "c_custkey")
    return orders.join(t.table("customer"), "c_custkey", "inner").select("o_orderkey", "c_name")


def join_chain(t: OrderTables) -> DataFrame:
    return (
        t.table("orders")
        .join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


# Aggregation and distinct


def drop_duplicates(t: OrderTables) -> DataFrame:
    return t.table("orders").select("o_custkey", "o_orderpriority").dropDuplicates()


def agg_sum(t: OrderTables) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast(MONEY))
    return t.table("orders").groupBy("o_custkey").agg(total.alias("total"))


def agg_count(t: OrderTables) -> DataFrame:
    return t.table("orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))


def agg_min(t: OrderTables) -> DataFrame:
    stock = F.min("p_size").alias("stock")
    return t.table("part").groupBy("p_name", "p_brand", "p_type").agg(stock)


def agg_then_cast(t: OrderTables) -> DataFrame:
    profit = F.col("l_extendedprice").cast(MONEY) - F.col("l_quantity").cast(MONEY)
    total = F.sum(profit).cast("bigint").alias("profit")
    return t.table("lineitem").groupBy("l_returnflag").agg(total)


def group_by_expression(t: OrderTables) -> DataFrame:
    return (
        t.table("part")
        .groupBy(F.upper("p_type").alias("p_type"))
        .agg(F.count("p_partkey").alias("n"))
    )


# Surrogate keys


def dense_key(t: OrderTables) -> DataFrame:
    pairs = t.table("orders").select("o_custkey", "o_orderpriority").dropDuplicates()
    return dense_surrogate_key(pairs, "id", ["o_custkey", "o_orderpriority"], t.rows("orders"))


# Sort and limit


def sort_multi(t: OrderTables) -> DataFrame:
    return (
        t.table("orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .orderBy(F.asc("o_custkey"), F.desc("o_orderdate"), F.asc("o_orderkey"))
    )


def top_k(t: OrderTables) -> DataFrame:
    return (
        t.table("orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


# Star schema


def dim_customer(t: OrderTables) -> DataFrame:
    return distinct_dimension(t.ordering_customers(), LAYOUT.customer, "CUSTOMER_DIM_ID", t.rows("customer"))


def dim_product(t: OrderTables) -> DataFrame:
    return product_dimension(t.stocked_products(), LAYOUT.product, LAYOUT.stock, rows=t.rows("part"))


def dim_seller(t: OrderTables) -> DataFrame:
    return distinct_dimension(t.selling_sellers(), LAYOUT.seller, "SELLER_DIM_ID", t.rows("supplier"))


def dim_time(t: OrderTables) -> DataFrame:
    return time_dimension(t.sale_dates())


def dim_time_text(t: OrderTables) -> DataFrame:
    return time_dimension(_event_dates(t))


def dim_transaction(t: OrderTables) -> DataFrame:
    return distinct_dimension(t.transactions(), LAYOUT.transaction, "TRANSACTION_DIM_ID", t.rows("orders"))


def fact_inventory(t: OrderTables) -> DataFrame:
    return inventory_fact(t.sale_lines(), pin(time_dimension(t.sale_dates())), LAYOUT.fact, rows=t.rows("lineitem"))


# Reports


def report_top_customers(t: OrderTables) -> DataFrame:
    return reports.top_customers(
        t.sales(YEAR), t.customers(), None, t.all_transactions(), YEAR, time_key="Date"
    )


def report_state_orders(t: OrderTables) -> DataFrame:
    return reports.state_orders(t.sales(), t.customers())


def report_payment_mode(t: OrderTables) -> DataFrame:
    return reports.payment_modes(t.sales(), t.all_transactions())


def report_quarterly_profit(t: OrderTables) -> DataFrame:
    return reports.quarterly_profit(t.sales(YEAR), None, YEAR, time_key="Date")


def report_category_sales(t: OrderTables) -> DataFrame:
    return reports.category_sales(
        t.sales(YEAR), None, t.products(), YEAR, CATEGORY, time_key="Date"
    )


def report_category_sales_all(t: OrderTables) -> DataFrame:
    return reports.category_sales(
        t.sales(YEAR), None, t.products(), YEAR, time_key="Date"
    )


# Jobs


def _build(t: OrderTables, out: str, fmt: str, **options) -> None:
    """The star in ``out``. The wide table goes when it is built."""
    with scratch_of_job(t.spark):
        build_star(t.pinned_wide(), out, LAYOUT, fmt=fmt, **options)


def job_build_star(t: OrderTables) -> DataFrame:
    """Builds the star from the wide table; gives the rows and ids of each table."""
    out = scratch_path(t.spark)
    _build(t, out, "parquet")
    counts = [
        read_star(t.spark, out, name).select(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.min(key).alias("first_id"),
            F.max(key).alias("last_id"),
            F.sum(F.col(key).cast("decimal(20,0)")).cast("decimal(38,0)").alias("id_sum"),
        )
        for name, key in IDS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _built(name: str, fmt: str) -> Query:
    """What the job writes for one table of the star, read back."""

    def query(t: OrderTables) -> DataFrame:
        out = scratch_path(t.spark)
        _build(t, out, fmt, only=[name])
        return read_star(t.spark, out, name)

    return query


def _run_reports(t: OrderTables, fmt: str) -> DataFrame:
    """Wide table to star to CSV reports; gives the lines of all five."""
    star, out = scratch_path(t.spark), scratch_path(t.spark)
    _build(t, star, fmt, codec="gzip" if fmt == "csv" else None)
    written = run_reports(t.spark, star, out, YEAR, CATEGORY, fmt=fmt)
    labels = {
        "top_10_customers": ("CUSTOMER_ID", "TOTAL_SELLING_PRICE"),
        "statewise_orders": ("CUSTOMER_STATE", "ORDER_COUNT"),
        "payment_mode_by_state": ("TRANSACTION_TYPE", "ORDER_COUNT"),
        "quarterly_profit": ("QUARTER", "PROFIT"),
        "quarterly_sales_count": (F.concat_ws("/", "QUARTER", "PRODUCT Name"), "SALES_COUNT"),
    }
    lines = [
        written[name].select(
            F.lit(name).alias("report"),
            (F.col(label) if isinstance(label, str) else label).cast("string").alias("label"),
            F.col(value).cast("decimal(38,2)").alias("value"),
        )
        for name, (label, value) in labels.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def job_run_reports(t: OrderTables) -> DataFrame:
    return _run_reports(t, "parquet")


def job_run_reports_csv(t: OrderTables) -> DataFrame:
    """All through text: the CSV star and what it stores of its types."""
    return _run_reports(t, "csv")


# Checks


def undated(t: OrderTables) -> DataFrame:
    """How many distinct sales are in no fact, as none of their days is in the calendar of a year."""
    time = time_dimension(t.sale_dates().where(in_year(F.col("Date"), YEAR)))
    missing = undated_sales(t.sale_lines(), pin(time), LAYOUT.fact)
    return missing.agg(F.count(F.lit(1)).alias("undated_sales"))


def repeated(t: OrderTables) -> DataFrame:
    """Customers with several orders, as keys of a table of orders that are not unique."""
    counts = repeated_keys(t.table("orders").select("o_custkey"), "o_custkey")
    return counts.select("o_custkey", F.col("ROWS").alias("n_rows"))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_scan_schema": csv_scan_schema,
    "csv_scan_reordered": csv_scan_reordered,
    "csv_sink": csv_sink,
    "project_columns": project_columns,
    "spaced_alias": spaced_alias,
    "arith_subtract": arith_subtract,
    "cast_truncate": cast_truncate,
    "upper_case": upper_case,
    "parse_date": parse_date_text,
    "date_parts": date_parts_of_orders,
    "filter_equality": filter_equality,
    "filter_chained": filter_chained,
    "inner_join": inner_join,
    "join_chain": join_chain,
    "drop_duplicates": drop_duplicates,
    "agg_sum": agg_sum,
    "agg_count": agg_count,
    "agg_min": agg_min,
    "agg_then_cast": agg_then_cast,
    "group_by_expression": group_by_expression,
    "dense_surrogate_key": dense_key,
    "sort_multi": sort_multi,
    "top_k": top_k,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_seller": dim_seller,
    "dim_time": dim_time,
    "dim_time_text": dim_time_text,
    "dim_transaction": dim_transaction,
    "fact_inventory": fact_inventory,
    "report_top_customers": report_top_customers,
    "report_state_orders": report_state_orders,
    "report_payment_mode": report_payment_mode,
    "report_quarterly_profit": report_quarterly_profit,
    "report_category_sales": report_category_sales,
    "report_category_sales_all": report_category_sales_all,
    "job_build_star": job_build_star,
    "job_run_reports": job_run_reports,
    "job_run_reports_csv": job_run_reports_csv,
    **{f"job_star_{name}": _built(name, "parquet") for name in IDS},
    **{f"job_star_csv_{name}": _built(name, "csv") for name in IDS},
    "undated_sales": undated,
    "repeated_keys": repeated,
}


# Shuffle partitions that fit the lines of a folder, by application: the files are looked at once.
_FITTED: dict[tuple[str, str], int] = {}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """Query ``name`` over the tables of ``folder``."""
    tables = OrderTables(prepare(spark), folder)
    key = spark.sparkContext.applicationId, folder
    if key not in _FITTED:
        _FITTED[key] = fit_shuffles(tables.table("lineitem"))
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if present < _FITTED[key]:
        spark.conf.set("spark.sql.shuffle.partitions", str(_FITTED[key]))
    return QUERIES[name](tables)
