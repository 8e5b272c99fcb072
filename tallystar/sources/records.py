"""CSV whose fields may hold line breaks, read by many tasks a file.

Spark cuts a file into splits and lines without regard to quotes. Whether a line begins a record is told by the number of
quotes before it: even outside a quoted field, odd inside, as quotes within fields are doubled. So every split counts the
lines with an odd number of quotes, a running sum over the splits of a file says whether a split begins inside a field, and
the lines a split begins with inside one go to the split where their record began. Spark's own parser takes the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["file", "start"]


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a CSV file or folder: ``file``, ``line`` (of the file, from 1, where it begins) and ``record``, its text.

    Lines end with a line feed, or a carriage return and a line feed; those inside a record stay as they are (Spark's ``multiLine`` makes
    the latter a line feed, unless it is told the line end). The header is
    a record like others; blank lines are none. A file without rows has no records. A file whose quotes are odd in number stops the read,
    since its last field would never end. A quote inside a field that is not quoted is not for this reader (it would open one).

    A row per split is sorted by file; the lines are shuffled once, those of a split to one task, which holds one record at a time.
    A record that goes on over several splits is one task's, as is a file that is compressed.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )
    odd = ((F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))) % 2).alias("odd")
    lines = lines.select(*_SPLIT, "place", "text", odd)
    owned = _owners(lines)
    # After a field that an earlier split opened, or from the first line, the lines of a split are its own.
    inside = F.col("began_inside") & F.coalesce(F.col("place") <= F.col("closed_at"), F.lit(True))
    lines = lines.join(owned, _SPLIT).select(
        "file",
        F.when(inside, F.col("owner")).otherwise(F.col("start")).alias("owner"),
        (F.col("lines_before") + F.col("place") - F.col("first") + 1).alias("line"),
        "text",
        "odd",
    )
    in_order = Window.partitionBy("file", "owner").orderBy("line")
    begins = ((F.sum("odd").over(in_order) - F.col("odd")) % 2 == 0).cast("int")
    records = (
        lines.withColumn("begins", begins)
        .withColumn("number", F.sum("begins").over(in_order))
        .groupBy("file", "owner", "number")
        .agg(F.min("line").alias("line"), F.array_sort(F.collect_list(F.struct("line", "text"))).alias("parts"))
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    text = F.regexp_replace(text, r"\r\z", "")
    text = F.when(F.col("line") == 1, F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    return records.select("file", "line", text.alias("record")).where("record != ''")


def _owners(lines: DataFrame) -> DataFrame:
    """A row per split: its lines before, whether it begins inside a field, where that ends, and which split has its record."""
    splits = lines.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("odd").alias("odds"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.min(F.when(F.col("odd") == 1, F.col("place"))).alias("closed_at"),
    )
    along = Window.partitionBy("file").orderBy("start")
    whole = Window.partitionBy("file")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    never_closed = F.sum("odds").over(whole) % 2 == 1
    told = F.concat(F.lit("a quoted field is never closed in "), F.col("file"))
    splits = splits.select(
        *_SPLIT,
        "first",
        "last",
        "closed_at",
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
        F.when(never_closed, F.raise_error(told).cast("boolean"))
        .otherwise(F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1)
        .alias("began_inside"),
    )
    begins_one = ~F.col("began_inside") | (F.col("closed_at") < F.col("last"))
    owner = F.last(F.when(begins_one, F.col("start")), ignorenulls=True).over(before)
    return splits.select(*_SPLIT, "first", "closed_at", "lines_before", "began_inside", owner.alias("owner"))
