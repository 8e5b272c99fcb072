"""Lines repeated across documents, found by probing a sharded minimal perfect hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.spans import mix
from tallystar.llm.tables import by_position, plain, table, unused
from tallystar.sources.scratch import pin

LEAST_CHARS = 20
LEAST_DOCS = 3
#: Aims of the layout, not limits: keys of a shard, and probes that meet one copy of a shard.
SHARD_KEYS = 1 << 16
SHARD_PROBES = 1 << 18
LEAST_PROBES = 1 << 10

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits per key of a level, and levels before the few keys left are listed.
_GAMMA, _LEVELS = 2, 24


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: key i of n gets a number of its own below n.

    Level by level, keys that are alone at their place in a bit array stay there and
    the others go on; the number is the rank of the bit. The keys left after the
    last level are kept in a sorted list. Levels are stored one after the other.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.ranks = np.concatenate([[0], np.cumsum(np.unpackbits(bits))]) if len(bits) else np.zeros(1, np.int64)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x632BE59BD9B4E019 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, arrays, left = [], [], keys
        for level in range(_LEVELS):
            if not len(left):
                break
            size = -(-_GAMMA * len(left) // 8) * 8
            place = cls._place(left, level, size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            arrays.append(np.packbits(alone))
            left = left[~alone[place]]
        bits = np.concatenate(arrays) if arrays else np.zeros(0, np.uint8)
        return cls(np.array(sizes, np.int64), bits, np.sort(left))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for a key that was not there when it was built."""
        out, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            place = self._place(keys[open_], level, int(size)) + start
            hit = (self.bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
            out[open_[hit]] = self.ranks[place[hit]]
            open_, start = open_[~hit], start + int(size)
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            found = self.rest[at] == keys[open_]
            out[open_[found]] = self.ranks[-1] + at[found]
        return out


def _lines(docs: DataFrame, id_: str, text: str, least_chars: int) -> DataFrame:
    """Each long enough line: document, checksum of its text, position, and two hashes of its key."""
    key = F.translate(F.btrim(F.col("line"), F.lit(_BLANKS)), _UPPER, _LOWER)
    words = F.coalesce(plain(text), F.lit(""))
    return (
        docs.select(plain(id_).cast("long").alias("doc_id"), F.xxhash64(words).alias("sum"), F.posexplode(F.split(words, "\n", -1)).alias("pos", "line"))
        .select("doc_id", "sum", "pos", key.alias("key"))
        .where(F.length("key") >= least_chars)
        .select("doc_id", "sum", "pos", F.xxhash64("key", F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))
    )


def _shard(shards: int) -> Column:
    # An int, as the index has it: int and bigint of one value hash to different partitions, and a cogroup does not cast its keys.
    return F.pmod(F.shiftrightunsigned("h1", 7), F.lit(shards)).cast("int")


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    h1 = frame["h1"].to_numpy(np.int64).view(np.uint64)
    # Two keys that share the first hash would share a place; they go by the second hash too.
    keys = mix(h1) ^ frame["h2"].to_numpy(np.int64).view(np.uint64)
    function = PerfectHash.build(keys)
    at = function.number(keys)
    arrays = {}
    for column in ("h1", "h2", "n_docs", "last"):
        values = frame[column].to_numpy(np.int64)
        arrays[column] = np.empty(len(values), np.int64)
        arrays[column][at] = values
    return pd.DataFrame(
        {
            "shard": [frame["shard"].iloc[0]],
            "sizes": [function.sizes.tobytes()],
            "bits": [function.bits.tobytes()],
            "rest": [function.rest.tobytes()],
            # 128 bits in all: the key's own 64 through the function's place, 64 more here.
            "marks": [(mix(arrays["h1"].view(np.uint64)) + arrays["h2"].view(np.uint64)).tobytes()],
            "counts": [arrays["n_docs"].tobytes()],
            "lasts": [arrays["last"].tobytes()],
        }
    )


def _probe(least_docs: int):
    def probe(lines: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(lines) or not len(shard):
            return pd.DataFrame({"id": [], "sum": [], "pos": []})
        s = shard.iloc[0]
        function = PerfectHash(np.frombuffer(s["sizes"], np.int64), np.frombuffer(s["bits"], np.uint8), np.frombuffer(s["rest"], np.uint64))
        marks, counts, lasts = (np.frombuffer(s[c], t) for c, t in (("marks", np.uint64), ("counts", np.int64), ("lasts", np.int64)))
        h1, h2 = (lines[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        at = function.number(mix(h1) ^ h2)
        known = at >= 0
        at = np.where(known, at, 0)
        doc = lines["id"].to_numpy(np.int64)
        drop = known & (marks[at] == mix(h1) + h2) & (counts[at] >= least_docs) & (lasts[at] != doc)
        return pd.DataFrame({"id": doc[drop], "sum": lines["sum"].to_numpy()[drop], "pos": lines["pos"].to_numpy()[drop]})

    return probe


_NULL = -(2**63)


def _index(lines: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash of its keys that are in two documents or more, and their arrays."""
    keys = (
        lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.max("id").alias("last"))
    )
    return (
        keys.where("n_docs >= 2")
        .withColumn("shard", _shard(shards))
        .groupBy("shard")
        .applyInPandas(_build, "shard int, sizes binary, bits binary, rest binary, marks binary, counts binary, lasts binary")
    )


def repeated_positions(lines: DataFrame, least_docs: int) -> DataFrame:
    """``id``, ``sum`` and ``pos`` of the lines to drop, by probing the index."""
    spark = lines.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = lines.count()
    shards = max(4 * tasks, -(-total // SHARD_KEYS))
    most = max(LEAST_PROBES, min(SHARD_PROBES, total // (2 * tasks)))
    lines = lines.withColumn("shard", _shard(shards))
    # Only shards with hot lines have several copies. Written, so that the planner knows their size and decides how to join them.
    split = pin(lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("copies")).where("copies > 1"))

    def with_copies(rows: DataFrame) -> DataFrame:
        return rows.join(split, "shard", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))

    probes = with_copies(lines).withColumn("copy", F.expr("pmod(xxhash64(id, pos), copies)").cast("int"))
    index = with_copies(pin(_index(lines, shards))).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return (
        probes.select("shard", "copy", "id", "sum", "pos", "h1", "h2")
        .groupBy("shard", "copy")
        .cogroup(index.drop("copies").groupBy("shard", "copy"))
        .applyInPandas(_probe(least_docs), "id long, sum long, pos int")
    )


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with its text less repeated lines, and ``__n_lines`` (before) and ``__n_dropped``.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
    lower-cased. A key of at least ``least_chars`` code points that is in at least
    ``least_docs`` (two or more) documents loses its lines everywhere but in the
    largest id that holds it. All other lines stay, short and empty ones too.

    How: lines become two 64-bit hashes. Those found in two documents or more are
    cut into shards, each a minimal perfect hash over arrays of check marks,
    counts and last ids. Hashed lines go to their shard and probe its arrays;
    what comes back are positions of lines to drop. A shard that holds a very
    frequent line is copied as often as its number of lines asks, and the probes
    are dealt over the copies. The text itself moves once, to meet its positions.

    Null text is one empty line and becomes the empty text. Rows that share an id
    count as one document. A null id is smaller than any other. An empty table
    stays empty; the other columns stay as they are, whatever their names, but for an
    earlier ``__n_lines`` or ``__n_dropped``, which is replaced.
    """
    if least_docs < 2:
        raise ValueError("a line is repeated from two documents on")
    docs = docs.drop("__n_lines", "__n_dropped")
    id_name, sum_name, drop_name = unused(docs.columns, "__id", "__sum", "__drop")
    lines = pin(_lines(docs, key, text, least_chars).withColumn("id", F.coalesce("doc_id", F.lit(_NULL))).drop("doc_id"))
    drops = (
        repeated_positions(lines, least_docs)
        .groupBy(F.col("id").alias(id_name), F.col("sum").alias(sum_name))
        .agg(F.collect_set("pos").alias(drop_name))
    )
    words = F.coalesce(plain(text), F.lit(""))
    on = (F.coalesce(plain(key).cast("long"), F.lit(_NULL)) == F.col(id_name)) & (F.xxhash64(words) == F.col(sum_name))
    fields = docs.schema.fieldNames()
    schema = T.StructType(
        [*(T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema.fields), T.StructField("__n_lines", T.LongType()), T.StructField("__n_dropped", T.LongType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, drop_at = fields.index(text), len(fields)
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for value, drop in zip(batch.column(at).to_pylist(), batch.column(drop_at).to_pylist(), strict=True):
                value = value or ""
                n_lines.append(value.count("\n") + 1)
                n_dropped.append(len(drop or ()))
                if drop:
                    gone = set(drop)
                    value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in gone)
                kept.append(value)
            columns = batch.columns[:drop_at]
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema.fieldNames())

    return by_position(docs.join(drops, on, "left").select(*[plain(c) for c in fields], drop_name)).mapInArrow(cut, schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated lines; ``n_chars`` follows the text."""
    cut = drop_repeated_lines(docs)
    return cut.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else plain(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents),
keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines),
often as (
    select key, max(doc_id) as last from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
judged as (
    select k.doc_id, k.pos, k.line, o.key is not null and o.last <> k.doc_id as gone
    from keyed k left join often o on k.key = o.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
