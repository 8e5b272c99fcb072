"""Money expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Wide enough for 1e17, with ten decimals; a count of up to ten digits times it, and its sums, stay exact.
WIDE = T.DecimalType(27, 10)
COUNT = T.DecimalType(10, 0)


def exact(df: DataFrame, name: str) -> Column:
    """Column ``name`` in a type whose sums do not depend on the order of rows.

    Sums of doubles differ from run to run, so doubles become decimals; a value
    that would lose more than its last binary digit stops the job, as does one that is too large.
    Declare decimals where amounts have more digits. Integers and decimals
    are exact already and stay as they are.
    """
    column = F.col(f"`{name}`")
    if not isinstance(df.select(column).schema[0].dataType, (T.FloatType, T.DoubleType)):
        return column
    wide = column.cast("double").cast(WIDE)
    near = F.abs(wide.cast("double") - column) <= F.abs(column) * 1e-15
    lost = column.isNotNull() & ~F.coalesce(near, F.lit(False))
    told = F.concat(F.lit(f"{name} does not fit {WIDE.simpleString()}: "), column.cast("string"))
    return F.when(lost, F.raise_error(told).cast(WIDE)).otherwise(wide)


def times(count: Column, df: DataFrame, amount: str) -> Column:
    """A count times an amount of ``df``, with all decimals of the amount."""
    whole = not isinstance(df.select(amount).schema[0].dataType, T.DecimalType)
    return (count if whole else count.cast(COUNT)) * F.col(amount)
