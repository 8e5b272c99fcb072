"""Facts of one year, with their calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.functions.dates import in_year


def facts_of_year(fact: DataFrame, time: DataFrame | None, year: int, time_key: str) -> DataFrame:
    """``fact`` of one year with YEAR and QUARTER.

    If the key is a date, it says both itself, and ``time`` is not read. Else ``fact`` is
    joined with the ``time`` rows of the year, whose size decides how. The
    join alone would read facts of all years, so the range of that year's surrogate keys (they follow the
    calendar, and so does the order of the written fact table) is put on the fact's own key
    column, where the scan can use it. It only narrows the scan; the join decides.
    """
    key = F.col(time_key)
    if isinstance(fact.select(time_key).schema[0].dataType, T.DateType):
        return fact.where(in_year(key, year)).withColumns({"YEAR": F.lit(year), "QUARTER": F.quarter(key)})
    days = time.where(F.col("YEAR") == year)
    # Two top-1 subqueries, because min and max would be merged into one that
    # returns a struct, and a scan cannot use a field of a struct to skip.
    keys = days.select(time_key).where(key.isNotNull())
    first = keys.orderBy(F.asc(time_key)).limit(1).scalar()
    last = keys.orderBy(F.desc(time_key)).limit(1).scalar()
    return fact.where((key >= first) & (key <= last)).join(days, time_key)
