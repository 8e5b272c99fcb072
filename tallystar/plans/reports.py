"""Sales reports on the star schema.

Customers, transactions and products grow with the data and may be too large to
broadcast, and one of them may own a third of all sales. So sales are counted
per key before they are joined: partial counts are formed before the shuffle,
and the join meets one row per key however many sales it has. Where a dimension
has several rows for a key, each of them gets the full count, as if every sale
had been joined with every such row.

``all_reports`` forms the counts of the five reports in two passes over the fact: one over all years, one over the year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.functions.money import exact, times
from tallystar.operators.yearly import facts_of_year
from tallystar.sources.scratch import at_once, pin


# Counts and sums, by whatever a report needs. COUNT is of all sales, ORDERS of those with a transaction.


def _count() -> Column:
    return F.count(F.lit(1)).alias("COUNT")


def _orders() -> Column:
    return F.count("TRANSACTION_ID").alias("ORDERS")


def _profit(fact: DataFrame) -> Column:
    return F.sum(exact(fact, "PRODUCT_SELLING_PRICE") - exact(fact, "PRODUCT_COST_PRICE")).alias("PROFIT")


def top_customers(
    fact: DataFrame,
    customers: DataFrame,
    time: DataFrame | None,
    transactions: DataFrame,
    year: int,
    k: int = 10,
    time_key: str = "TIME_DIM_ID",
) -> DataFrame:
    """The ``k`` customers with the largest transaction amounts in a year.

    An amount counts once for each line of its transaction. Equal totals are
    ordered by customer. The year is the same in all rows, so it is in no
    key: what is summed per customer lies where the join with the customers needs it.
    """
    lines = facts_of_year(fact, time, year, time_key).groupBy("CUSTOMER_ID", "TRANSACTION_ID").agg(_count())
    return _top_customers(lines, customers, transactions, year, k)


def _top_customers(lines: DataFrame, customers: DataFrame, transactions: DataFrame, year: int, k: int) -> DataFrame:
    amounts = transactions.select(
        "TRANSACTION_ID", exact(transactions, "TRANSACTION_AMOUNT").alias("AMOUNT")
    )
    spent = (
        lines.join(amounts, "TRANSACTION_ID")
        .groupBy("CUSTOMER_ID")
        .agg(F.sum(times(F.col("COUNT"), amounts, "AMOUNT")).alias("SPENT"))
    )
    return (
        spent.join(customers.select("CUSTOMER_ID", "Customer Name"), "CUSTOMER_ID")
        .groupBy("CUSTOMER_ID", "Customer Name")
        .agg(F.sum("SPENT").alias("TOTAL_SELLING_PRICE"))
        .select(F.lit(year).alias("YEAR"), "Customer Name", "CUSTOMER_ID", "TOTAL_SELLING_PRICE")
        .orderBy(F.desc("TOTAL_SELLING_PRICE"), "CUSTOMER_ID", "Customer Name")
        .limit(k)
    )


def state_orders(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Number of orders by state, whatever the case the state is written in."""
    return _state_orders(fact.groupBy("CUSTOMER_ID").agg(_orders()), customers)


def _state_orders(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        per_customer.join(customers.select("CUSTOMER_ID", "CUSTOMER_STATE"), "CUSTOMER_ID")
        .groupBy(F.upper("CUSTOMER_STATE").alias("CUSTOMER_STATE"))
        .agg(F.sum("ORDERS").alias("ORDER_COUNT"))
        .orderBy("CUSTOMER_STATE")
    )


def payment_modes(fact: DataFrame, transactions: DataFrame) -> DataFrame:
    """Number of orders by transaction type, the rarest first."""
    return _payment_modes(fact.groupBy("TRANSACTION_ID").agg(_count()), transactions)


def _payment_modes(per_transaction: DataFrame, transactions: DataFrame) -> DataFrame:
    return (
        per_transaction.join(
            transactions.select("TRANSACTION_ID", "TRANSACTION_TYPE"), "TRANSACTION_ID"
        )
        .groupBy("TRANSACTION_TYPE")
        .agg(F.sum("COUNT").alias("ORDER_COUNT"))
        .orderBy("ORDER_COUNT", "TRANSACTION_TYPE")
    )


def quarterly_profit(
    fact: DataFrame, time: DataFrame | None, year: int, time_key: str = "TIME_DIM_ID"
) -> DataFrame:
    """Selling price less cost price by quarter of a year; the sum's fraction is cut off."""
    return _quarterly_profit(facts_of_year(fact, time, year, time_key).groupBy("YEAR", "QUARTER").agg(_profit(fact)))


def _quarterly_profit(by_quarter: DataFrame) -> DataFrame:
    return by_quarter.select("YEAR", "QUARTER", F.col("PROFIT").cast("bigint").alias("PROFIT")).orderBy("QUARTER")


def category_sales(
    fact: DataFrame,
    time: DataFrame | None,
    products: DataFrame,
    year: int,
    category: int | str | None = None,
    time_key: str = "TIME_DIM_ID",
) -> DataFrame:
    """Number of sales by quarter and product name, of one category or of all."""
    per_product = facts_of_year(fact, time, year, time_key).groupBy("YEAR", "QUARTER", "PRODUCT_ID").agg(_orders())
    return _category_sales(per_product, products, category)


def _category_sales(per_product: DataFrame, products: DataFrame, category: int | str | None) -> DataFrame:
    names = products.select("PRODUCT_ID", "CATEGORY_ID", "PRODUCT Name")
    if category is not None:
        names = names.where(F.col("CATEGORY_ID") == category)
    return (
        per_product.join(names, "PRODUCT_ID")
        .groupBy("YEAR", "QUARTER", "CATEGORY_ID", "PRODUCT Name")
        .agg(F.sum("ORDERS").alias("SALES_COUNT"))
        .orderBy("YEAR", "QUARTER", "CATEGORY_ID", "PRODUCT Name")
    )


def all_reports(
    fact: DataFrame,
    customers: DataFrame,
    time: DataFrame | None,
    products: DataFrame,
    transactions: DataFrame,
    year: int,
    category: int | str | None = None,
    k: int = 10,
    time_key: str = "TIME_DIM_ID",
) -> dict[str, DataFrame]:
    """The five reports, from two passes over ``fact``.

    The keys of several reports are grouping sets of one aggregation, whose rows, a few for each key, are written and read by
    each report. A set is told by its number of columns left out; where a null stands for a column left out, it is not mistaken
    for a null key.
    """

    def grouped(rows: DataFrame, sets: list[list[str]], *sums: Column) -> list[DataFrame]:
        names = list(dict.fromkeys(c for s in sets for c in s))
        made = pin(rows.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.grouping_id().alias("SET"), *sums))
        bits = [sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s) for s in sets]
        return [made.where(F.col("SET") == b).select(*s, *made.columns[len(names) + 1 :]) for b, s in zip(bits, sets, strict=True)]

    def of_all_years() -> list[DataFrame]:
        return grouped(fact, [["CUSTOMER_ID"], ["TRANSACTION_ID"]], _count(), _orders())

    def of_the_year() -> list[DataFrame]:
        return grouped(
            facts_of_year(fact, time, year, time_key),
            [["CUSTOMER_ID", "TRANSACTION_ID"], ["YEAR", "QUARTER"], ["YEAR", "QUARTER", "PRODUCT_ID"]],
            _count(),
            _orders(),
            _profit(fact),
        )

    (per_customer, per_transaction), (lines, by_quarter, per_product) = at_once(of_all_years, of_the_year)
    return {
        "top_10_customers": _top_customers(lines.drop("ORDERS", "PROFIT"), customers, transactions, year, k),
        "statewise_orders": _state_orders(per_customer, customers),
        "payment_mode_by_state": _payment_modes(per_transaction, transactions),
        "quarterly_profit": _quarterly_profit(by_quarter),
        "quarterly_sales_count": _category_sales(per_product, products, category),
    }
