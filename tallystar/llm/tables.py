"""Tables the operators share: inputs by path, columns by position, running totals."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.sources.scratch import pin

#: Task and number within the task in the name of a file that Spark wrote.
_PART = re.compile(r"^part-(\d+)-.*-c(\d+)\.")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plain(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """The names, with underscores added to those that a column has already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def first_by_hash(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows: those whose keys come first by hash, the same in every run.

    Rows whose hash is far from the first are left out before the sort, so that all tasks together send
    little more than ``most`` rows to the driver.
    """
    rows = df.count()
    share = min(1.0, (1.5 * most + 100) / max(rows, 1))
    place = F.pmod(F.xxhash64(plain(key)), F.lit(1 << 32))
    return df.where(place < int(share * (1 << 32))).orderBy(place, plain(key)).limit(most)


def in_written_order(df: DataFrame, file: str, row: str) -> DataFrame:
    """``df`` with two long columns that tell the order it is written in: number of the file, row in it.

    Read from the files if ``df`` is nothing but a table that Spark wrote; any other frame is written first, and
    its rows follow its partitions.
    """
    names = [f.rsplit("/", 1)[-1] for f in df.inputFiles()]
    scan = df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
    if not (scan and all(_PART.search(n) for n in names)):
        df = pin(df)
    name = F.col("_metadata.file_name")
    part, chunk = (F.regexp_extract(name, _PART.pattern, k).cast("long") for k in (1, 2))
    return df.select(*[plain(c) for c in df.columns], (part * 1_000_000 + chunk).alias(file), F.col("_metadata.row_index").alias(row))


def by_position(df: DataFrame) -> DataFrame:
    """The same columns with plain names: ``mapInArrow`` cannot find a column whose name has a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def running(df: DataFrame, size: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``rank`` (rows before) and ``before`` (sum of ``size`` before), within each key.

    ``df`` has few, short columns. It is sorted by ``keys`` and ``order`` over
    range partitions, so a key with most of the rows spans many of them; each task
    counts within its partition and the result is written once, since the sampled
    bounds of the partitions may differ in another run. What lies before a
    partition comes from one row per partition and key. ``order`` should tell the
    rows of a key apart, else equal rows may land in one partition.
    """
    keys, order = list(keys), list(order)
    schema = T.StructType(
        [*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__rank", T.LongType()), T.StructField("__sum", T.LongType())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, rank0, sum0 = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            change = np.zeros(n, bool)
            for k in keys:
                a, b = batch.column(k).slice(1), batch.column(k).slice(0, n - 1)
                change[1:] |= pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
                change[1:] |= pc.xor(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
            if last != [batch.column(k)[0].as_py() for k in keys]:
                rank0 = sum0 = 0
            begin = np.maximum.accumulate(np.where(change, np.arange(n), 0))
            total = np.cumsum(sizes) - sizes
            rank, before = np.arange(n) - begin, total - total[begin]
            rank[begin == 0] += rank0
            before[begin == 0] += sum0
            last = [batch.column(k)[n - 1].as_py() for k in keys]
            rank0, sum0 = int(rank[-1]) + 1, int(before[-1] + sizes[-1])
            added = [pa.array(np.full(n, part, np.int32)), pa.array(rank), pa.array(before)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [f.name for f in schema])

    by = [plain(c) for c in [*keys, *order]]
    counted = pin(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(count, schema))
    window = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that the planner knows its size before it plans the join.
    offsets = pin(
        counted.groupBy("__part", *keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.sum(size).alias("__s"))
        .select(
            F.col("__part").alias("__p"),
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.coalesce(F.sum("__n").over(window), F.lit(0)).alias("__n0"),
            F.coalesce(F.sum("__s").over(window), F.lit(0)).alias("__s0"),
        )
    )
    on = F.col("__part") == F.col("__p")
    for i, k in enumerate(keys):
        on &= plain(k).eqNullSafe(F.col(f"__k{i}"))
    return counted.join(offsets, on).select(
        *[plain(c) for c in df.columns],
        (F.col("__rank") + F.col("__n0")).alias("rank"),
        (F.col("__sum") + F.col("__s0")).alias("before"),
    )
