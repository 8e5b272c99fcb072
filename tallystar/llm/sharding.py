"""Contiguous shards of nearly equal size, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.tables import plain, running, table

SHARDS = 8


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut the documents, in order of key, into contiguous shards of nearly equal size.

    A document's size is the UTF-8 bytes of its text (null: none) plus 1. The
    shard is where the middle of the document falls among ``shards`` equal parts
    of the total, so a shard's size differs from its part by less than the
    longest document. Returns the key, ``size``, ``text_crc32``, ``shard`` and
    ``slot``, the position in the shard.

    Rows with a null key come first; rows that share a key are ordered by size
    and checksum, and equal rows count one by one. Other columns of ``docs`` are
    not read. An empty table gives an empty result. A document longer than a
    part leaves shards empty.

    Only key, size and checksum are sorted; the offsets come from one row per
    partition (``running``), and shard starts are an aggregate of one row each.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    words = F.coalesce(plain(text), F.lit(""))
    sized = docs.select(
        plain(key).alias("doc_id"),
        (F.octet_length(words) + 1).cast("long").alias("size"),
        F.crc32(words).alias("text_crc32"),
    )
    placed = running(sized, "size", ["doc_id", "size", "text_crc32"])
    total = placed.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 1
    cut = placed.withColumn("shard", F.expr(f"cast((before * 2 + size) * {shards} div {2 * total} as int)"))
    starts = cut.groupBy("shard").agg(F.min("rank").alias("first"))
    # One row per shard.
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
