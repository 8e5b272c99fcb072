"""Session settings the plans rely on."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input a task reads, and a shuffle partition is made for.
SPLIT_BYTES = 128 << 20
PARTITION_BYTES = 128 << 20
#: Sort keys the driver may receive when the bounds of a range partitioning are sampled, and least per partition.
_SAMPLED_KEYS = 2_000_000
_LEAST_SAMPLED = 10
#: Where a join shuffles a table of at least the first size to meet at most the second, a Bloom filter of the keys of the small side
#: goes below the shuffle of the large one. The filter has a size that does not grow: ten bits for as many keys as the small side may have.
FILTERED_FROM = 1 << 30
FILTER_OF = 256 << 20
_FILTER_KEYS = 16 << 20
_FILTER_BITS = 10 * _FILTER_KEYS


def prepare(spark: SparkSession) -> SparkSession:
    """Let adaptive execution split a hot join key even where that costs a shuffle.

    By default a skewed join stays whole when a later step reuses its
    partitioning, as a distinct over the join key does. Plans without a hot key
    are not changed by this.

    Large dimensions are cut to the keys that a year's facts ask for before they are shuffled: Spark's runtime
    filter does it, within the sizes above. Beyond them the join shuffles the dimension's two columns whole.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    bloom = "spark.sql.optimizer.runtime.bloomFilter"
    spark.conf.set(f"{bloom}.enabled", "true")
    spark.conf.set(f"{bloom}.applicationSideScanSizeThreshold", str(FILTERED_FROM))
    spark.conf.set(f"{bloom}.creationSideThreshold", str(FILTER_OF))
    for setting, value in (("expectedNumItems", _FILTER_KEYS), ("maxNumItems", _FILTER_KEYS), ("numBits", _FILTER_BITS), ("maxNumBits", _FILTER_BITS)):
        spark.conf.set(f"{bloom}.{setting}", str(value))
    return spark


def fit_shuffles(table: DataFrame, split_bytes: int | None = None, partition_bytes: int = PARTITION_BYTES) -> int:
    """Let shuffle partitions grow with a table on disk: one for each ``partition_bytes`` of its splits.

    ``split_bytes`` sets the size of a split for later reads (the session's own if not given).
    There is no upper limit, so partitions keep their size however large the
    input; raise both sizes where there are too many. The planned scan tells how many splits there are.
    Adaptive execution merges partitions that turn out small, but splits
    large ones only for a skewed join. The more partitions, the fewer keys of each are sampled
    for a sort, so that the driver receives about as many in all.
    """
    spark = table.sparkSession
    if split_bytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = table.rdd.getNumPartitions()
    fitting = max(present, math.ceil(splits * (split_bytes or SPLIT_BYTES) / partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(fitting))
    sampled = max(_LEAST_SAMPLED, min(100, _SAMPLED_KEYS // fitting))
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", str(sampled))
    return fitting
