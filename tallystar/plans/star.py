"""Dimensions and the fact table out of one wide table of sales.

``rows`` is about how many rows a table will have, if that is known: see ``dense_surrogate_key``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.dates import DATE_FORMAT, date_parts, parse_date
from tallystar.operators.surrogate import dense_surrogate_key

#: Rows a calendar is taken to have at most: one task sorts it.
DAYS = 1 << 18
#: Letters of date formats for times of day and zones.
_FINER = set("aBhHkKmsSAnNVvzOXx")


def distinct_rows(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``distinct_dimension`` before its ids."""
    return source.select(*columns).dropDuplicates()


def product_rows(source: DataFrame, columns: Sequence[str], stock: str) -> DataFrame:
    """``product_dimension`` before its ids."""
    return source.groupBy(*columns).agg(F.min(stock).alias(stock))


def distinct_dimension(source: DataFrame, columns: Sequence[str], id_column: str, rows: int | None = None) -> DataFrame:
    """The distinct values of ``columns`` with an id: customers, sellers, transactions.

    Rows are kept whole, so a customer with two addresses has two rows, and each
    of their sales joins both. ``repeated_keys`` finds them.
    """
    return dense_surrogate_key(distinct_rows(source, columns), id_column, columns, rows)


def product_dimension(
    source: DataFrame, columns: Sequence[str], stock: str, id_column: str = "PRODUCT_DIM_ID", rows: int | None = None
) -> DataFrame:
    """One row per product, with the smallest of its stock values."""
    return dense_surrogate_key(product_rows(source, columns, stock), id_column, columns, rows)


def calendar(
    source: DataFrame, date: str = "Date", fmt: str = DATE_FORMAT, lenient: bool = False
) -> DataFrame:
    """The distinct dates of ``source`` with their parts.

    ``date`` is a DATE or a text in ``fmt``, so the rows are bounded by the days
    there are, each in a few spellings; a timestamp, or a format with a time of
    day, has no such bound and is refused: cut it to days first.
    """
    if finer := sorted(set(re.sub(r"'[^']*'", "", fmt)) & _FINER):
        raise ValueError(f"the date format {fmt!r} is finer than a day: {', '.join(finer)}")
    days = source.select(date).dropDuplicates()
    kind = days.schema[0].dataType
    if not isinstance(kind, (T.DateType, T.StringType)):
        raise TypeError(f"{date} must be a date or a text, not {kind.simpleString()}")
    day = F.col(date) if isinstance(kind, T.DateType) else parse_date(F.col(date), fmt, lenient)
    return days.withColumn("__day", day).select(date, *date_parts(F.col("__day")), "__day")


def time_dimension(
    source: DataFrame,
    date: str = "Date",
    fmt: str = DATE_FORMAT,
    id_column: str = "TIME_DIM_ID",
    lenient: bool = False,
    rows: int | None = DAYS,
) -> DataFrame:
    """``calendar`` with ids that follow the calendar, not the text of the date."""
    days = calendar(source, date, fmt, lenient)
    return dense_surrogate_key(days, id_column, ["__day", date], rows).drop("__day")


def inventory_fact(
    source: DataFrame,
    time: DataFrame,
    columns: Sequence[str],
    date: str = "Date",
    id_column: str = "FACT_ID",
    time_id: str = "TIME_DIM_ID",
    rows: int | None = None,
    hold: Callable[[DataFrame], DataFrame] = lambda lines: lines,
) -> DataFrame:
    """The distinct sales with the id of their date; sales without a date drop out.

    ``time`` must be a written time dimension: its ids then are those that
    others see, and its size is known to the planner. The rows come out in runs
    ordered by date, so that files and row groups hold few days each. ``hold`` may pin the distinct lines, so that
    the shuffle that made them so is gone before the next.
    """

    def dated(sales: DataFrame) -> DataFrame:
        return sales.join(time.select(date, time_id), date).select(time_id, *columns)

    lines = source.select(date, *columns)
    return dense_surrogate_key(dated(hold(lines.dropDuplicates())), id_column, [time_id, *columns], rows, dated(lines)).select(
        id_column, time_id, *columns
    )


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Natural keys that have several rows in ``dimension``, and so multiply joined sales."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("ROWS")).where("ROWS > 1")


def undated_sales(
    source: DataFrame, time: DataFrame, columns: Sequence[str], date: str = "Date"
) -> DataFrame:
    """The distinct sales that ``inventory_fact`` leaves out."""
    return source.select(date, *columns).dropDuplicates().join(time, date, "left_anti")


def sales_without_date(source: DataFrame, columns: Sequence[str], date: str = "Date") -> DataFrame:
    """``undated_sales`` where the calendar was made of the same ``source``: then only sales whose date is null have no day.

    The scan looks for these, so the other sales are neither made distinct nor joined again.
    """
    return source.where(F.col(date).isNull()).select(date, *columns).dropDuplicates()
