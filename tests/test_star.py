"""Dimensions and the fact table on hand-written sales."""

from tallystar.plans.layout import StarLayout
from tallystar.plans.star import (
    calendar,
    distinct_dimension,
    inventory_fact,
    product_dimension,
    repeated_keys,
    time_dimension,
    undated_sales,
)
from tallystar.sources.scratch import pin
from tests.data import ROWS, sale, table, wide

LAYOUT = StarLayout()


def test_customers_keep_both_addresses_of_one_who_moved(spark):
    customers = distinct_dimension(wide(spark), LAYOUT.customer, "CUSTOMER_DIM_ID")
    assert customers.columns == [*LAYOUT.customer, "CUSTOMER_DIM_ID"]
    got = table(customers.select("CUSTOMER_DIM_ID", "CUSTOMER_ID", "CUSTOMER_STREET_ADDRESS"))
    assert got == [(1, 1, "1 Elm, Rear"), (2, 2, 'Ap "2" Oak'), (3, 3, "3 Fir"), (4, 3, "33 Yew")]
    assert table(repeated_keys(customers, "CUSTOMER_ID")) == [(3, 2)]


def test_products_have_one_row_with_the_smallest_stock(spark):
    products = product_dimension(wide(spark), LAYOUT.product, LAYOUT.stock)
    got = table(products.select("PRODUCT_DIM_ID", "PRODUCT_ID", "PRODUCT_STOCK"))
    assert got == [(1, 10, 5), (2, 11, 4), (3, 12, 5)]


def test_sellers_and_transactions(spark):
    assert distinct_dimension(wide(spark), LAYOUT.seller, "SELLER_DIM_ID").count() == 1
    transactions = distinct_dimension(wide(spark), LAYOUT.transaction, "TRANSACTION_DIM_ID")
    got = table(transactions.select("TRANSACTION_DIM_ID", "TRANSACTION_ID"))
    assert got == [(i + 1, 900 + i) for i in range(6)]


def test_time_ids_follow_the_calendar(spark):
    time = time_dimension(wide(spark))
    assert time.columns == ["Date", "YEAR", "QUARTER", "MONTH", "DAY_OF_WEEK", "TIME_DIM_ID"]
    assert sorted(map(tuple, time.collect()), key=lambda r: r[-1]) == [
        (None, None, None, None, None, 1),
        ("05-Jan-11", 2011, 1, 1, 4, 2),
        ("28-AUG-11", 2011, 3, 8, 1, 3),
        ("28-Aug-11", 2011, 3, 8, 1, 4),
        ("31-Dec-11", 2011, 4, 12, 7, 5),
        ("01-Jan-12", 2012, 1, 1, 1, 6),
    ]


def test_lenient_dates(spark):
    rows = wide(spark, [sale("someday", 1, 10, 1, 1.0, 2.0), sale("05-Jan-11", 2, 10, 1, 1.0, 2.0)])
    got = table(calendar(rows, lenient=True).drop("__day"))
    assert got == [("05-Jan-11", 2011, 1, 1, 4), ("someday", None, None, None, None)]


def test_a_column_of_dates_needs_no_parsing(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1998-01-01', DATE'1998-01-03')) AS Date")
    got = time_dimension(days.union(days)).select("Date", "YEAR", "TIME_DIM_ID")
    assert [(str(d), y, i) for d, y, i in table(got)] == [
        ("1998-01-01", 1998, 1),
        ("1998-01-02", 1998, 2),
        ("1998-01-03", 1998, 3),
    ]


def test_fact_has_distinct_dated_sales_in_date_order(spark):
    time = pin(time_dimension(wide(spark)))
    fact = inventory_fact(wide(spark), time, LAYOUT.fact)
    assert fact.columns == ["FACT_ID", "TIME_DIM_ID", *LAYOUT.fact]
    got = table(fact.select("FACT_ID", "TIME_DIM_ID", "TRANSACTION_ID", "PRODUCT_ID"))
    assert got == [
        (1, 2, 900, 10),
        (2, 2, 900, 12),
        (3, 3, 901, 11),
        (4, 4, 902, 11),
        (5, 5, 903, 12),
        (6, 6, 904, 10),
    ]
    assert undated_sales(wide(spark), time, LAYOUT.fact).select("TRANSACTION_ID").collect() == [(905,)]


def test_every_fact_finds_its_own_date(spark):
    source = wide(spark, ROWS * 3).repartition(5)
    time = pin(time_dimension(source))
    fact = inventory_fact(source, time, LAYOUT.fact)
    dated = fact.join(time, "TIME_DIM_ID").select("Date", *LAYOUT.fact)
    expected = source.where("Date IS NOT NULL").select("Date", *LAYOUT.fact).distinct()
    assert table(dated) == table(expected)


def test_column_names_in_another_case(spark):
    source = wide(spark).withColumnRenamed("Date", "DATE")
    time = pin(time_dimension(source))
    assert inventory_fact(source, time, LAYOUT.fact).count() == 6
