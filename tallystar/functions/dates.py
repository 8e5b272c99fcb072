"""Date expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a date in the sales data, such as 28-Aug-11.
DATE_FORMAT = "dd-MMM-yy"


def parse_date(text: Column, fmt: str = DATE_FORMAT, lenient: bool = False) -> Column:
    """Date of a text. Text that does not match fails, or gives null when ``lenient``."""
    return F.try_to_date(text, fmt) if lenient else F.to_date(text, fmt)


def date_parts(day: Column) -> list[Column]:
    """YEAR, QUARTER, MONTH and DAY_OF_WEEK (Sunday is 1) of a date."""
    return [
        F.year(day).alias("YEAR"),
        F.quarter(day).alias("QUARTER"),
        F.month(day).alias("MONTH"),
        F.dayofweek(day).alias("DAY_OF_WEEK"),
    ]


def in_year(day: Column, year: int) -> Column:
    """``year(day) = year`` as a range, which a Parquet scan can use to skip row groups."""
    return (day >= F.lit(datetime.date(year, 1, 1))) & (
        day < F.lit(datetime.date(year + 1, 1, 1))
    )
