"""Dense surrogate keys without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task sorts and numbers where the number of rows is told.
ROWS_PER_RANGE = 1 << 20
#: Most ranges (their bounds go to every task), rows sampled for each, and in all.
MOST_RANGES = 1 << 16
_SAMPLED = 100
_MOST_SAMPLED = 1 << 20
_HASHES = 1 << 32
#: ``monotonically_increasing_id`` holds the number of a row within its partition in its lower bits, that of the partition above.
_ROW_BITS = 33


def _range_of(key: Column, bounds: Column, ranges: int, df: DataFrame) -> DataFrame:
    """``df`` with ``__range``, the number of bounds up to the key: a binary search, one step for each bit."""
    df = df.withColumns({"__bounds": bounds, "__range": F.lit(0)})
    for bit in reversed(range((ranges - 1).bit_length())):
        beyond = F.col("__range") + (1 << bit)
        reached = (beyond <= ranges - 1) & (F.get("__bounds", beyond - 1) <= key)
        df = df.withColumn("__range", F.when(reached, beyond).otherwise(F.col("__range")))
    return df.drop("__bounds")


def dense_surrogate_key(
    df: DataFrame, id_column: str, order_by: Sequence[str], rows: int | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """``df`` with ids 1..N (bigint) in the order of ``order_by``.

    The ids equal ``row_number() over (order by order_by, <other columns>)``, but
    no task sees more than its own range of rows:

    1. bounds of the ranges from a sample, which the hash of a whole row decides: the same rows in every run, and as
       many from each part of the order as there are different rows;
    2. one shuffle by the number of the range, which is then the number of the partition;
    3. rows per range, and the running sum of these: one row per range, counted in the files of that shuffle;
    4. a sort within the range by the order alone, and id = rows in earlier ranges + position.

    All of it is one query. The bounds are values, not sampled anew by each reader, so counting and numbering see the same
    ranges and nothing is written in between. ``df`` is read for the sample and the
    rows (and once more for its number of rows if ``rows``, about how many there are, is not given): if it ends in a
    shuffle, as a distinct does, these read the files of that one shuffle. Pin other frames that are dear to compute.

    ``repeated``, if given, has the rows of ``df``, some of them several times, and is read for the sample in its place: the
    same rows are sampled, without being made distinct first.

    ``rows`` only sets the number of ranges and the sample: where a task can sort them all there is one range.
    All columns take part in the order, so that the ids are the same for every
    partitioning and a key value shared by many rows is still cut into several
    ranges. Rows should be distinct (equal rows get different ids, but all of
    them in one task); the star tables are.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = [F.col(f"`{c}`") for c in [*order_by, *(c for c in df.columns if c not in order_by)]]
    ranges = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    if rows is not None:
        ranges = max(1, min(ranges, math.ceil(rows / ROWS_PER_RANGE)))
    if ranges == 1:
        number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return df.select(*columns, number.alias(id_column))

    key = F.struct(*order)
    hashed = F.xxhash64(*order)
    total = F.lit(rows) if rows is not None else df.agg(F.count(F.lit(1))).scalar()
    below = F.lit(float(min(_SAMPLED * ranges, _MOST_SAMPLED)) * _HASHES) / F.greatest(total, F.lit(1))
    sampled = (df if repeated is None else repeated).where(F.pmod(hashed, F.lit(_HASHES)) < below)
    sample = sampled.agg(F.sort_array(F.collect_set(key)).alias("s"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("s", (i * F.size("s") / ranges).cast("int")))
    dealt = _range_of(key, sample.select(cuts).scalar(), ranges, df).repartitionById(ranges, F.col("__range"))

    # One row per range, so neither the window nor the broadcast grows with the rows. Rows with even and with odd hashes are counted,
    # since a count that asks for no column would prune the shuffle below it, which then is another one than that of the rows.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    odd = hashed.bitwiseAND(F.lit(1)) == 1
    in_range = dealt.groupBy("__range").agg((F.count_if(odd) + F.count_if(~odd)).alias("__rows"))
    offsets = in_range.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    # Sorted without the range, which is the same in all rows of a task: a window would compare it first, and buffer the rows.
    placed = dealt.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    told = F.concat(F.lit("a range lies in another partition: "), F.col("__range").cast("string"))
    own = F.shiftright("__at", _ROW_BITS) == F.col("__range")
    position = F.when(own, F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1).otherwise(F.raise_error(told).cast("bigint"))
    return placed.join(F.broadcast(offsets), "__range").select(*columns, (F.col("__before") + position).alias(id_column))
