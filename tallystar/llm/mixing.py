"""Sources mixed to target weights by Pfair windows, earliest deadline first."""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.tables import plain, running, table, unused
from tallystar.sources.scratch import pin

#: Bytes of text in a block, and the power of a source's bytes that is its weight if no weights are given.
BLOCK_BYTES = 1 << 16
TEMPERATURE = 0.5


def cycle(shares: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot, for sources that get so many of the ``sum(shares)`` slots.

    Block i of a source with share q of Q may run from slot floor(i Q / q) on and must be
    done by slot ceil((i + 1) Q / q). Earliest deadline first meets all
    windows, so after t slots a source has had less than one block more or less than t q / Q.
    """
    total = sum(shares.values())
    waiting: list[tuple[int, str, int]] = [(0, source, 0) for source in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, source, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // shares[source]), source, i))
        _, source, i = heapq.heappop(ready)
        yield source
        if i + 1 < shares[source]:
            heapq.heappush(waiting, ((i + 1) * total // shares[source], source, i + 1))


def _shares(weights: Mapping[str, float]) -> dict[str, int]:
    """The least whole numbers in exactly the proportion of the weights, each taken as the fraction it is."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    divisor = math.gcd(*whole.values())
    return {s: n // divisor for s, n in whole.items()}


class Schedule:
    """Slots of all blocks of all sources.

    While all sources last, they are dealt by the exact weights, without rounding to a cycle. Weights like 5:1:2
    repeat after the sum of their least whole numbers; others may go on to the end of the phase without
    repeating. When a source runs out, the weights of the others are scaled up and a new phase begins, so
    every block is used once. The driver deals each phase until it repeats or ends and holds these slots: at
    most one of 8 bytes for each block, besides a phase per source.
    """

    def __init__(self, blocks: Mapping[str, int], weights: Mapping[str, float]):
        if missing := sorted(set(blocks) - set(weights)):
            raise ValueError(f"no weight for {missing[:5]}")
        if any(not 0 < weights[s] < math.inf for s in blocks):
            raise ValueError("weights must be above 0 and finite")
        left = {s: n for s, n in sorted(blocks.items()) if n > 0}
        done = dict.fromkeys(left, 0)
        #: Per source: first block of each phase, phase, first slot, slots until it repeats and own slots of these.
        self.phases: dict[str, list[tuple[int, int, int, int, np.ndarray]]] = {s: [] for s in left}
        begin = phase = 0
        while left:
            shares = _shares({s: weights[s] for s in left})
            length = sum(shares.values())
            rounds = min(n // shares[s] for s, n in left.items())
            rest = {s: n - rounds * shares[s] for s, n in left.items()}
            own = {s: array("q") for s in left}
            # What is left after whole cycles ends within the cycle.
            last = {s: 0 for s in left}
            extra, open_ = 0, True
            for slot, source in enumerate(cycle(shares)):
                if open_ and last[source] == rest[source]:
                    open_ = False
                if not open_ and not rounds:
                    break
                own[source].append(slot)
                if open_:
                    last[source] += 1
                    extra += 1
            for s in left:
                self.phases[s].append((done[s], phase, begin, length if rounds else extra, np.array(own[s], np.int64)))
                done[s] += rounds * shares[s] + last[s]
            begin += rounds * length + extra
            left = {s: rest[s] - last[s] for s in left if rest[s] > last[s]}
            phase += 1


def place(phases: list[tuple[int, int, int, int, np.ndarray]], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase and slot of blocks of a source, from its phases in a schedule."""
    firsts = [p[0] for p in phases]
    at = np.searchsorted(firsts, block, "right") - 1
    slots = np.zeros(len(block), np.int64)
    for k in np.unique(at):
        first, _, begin, length, own = phases[k]
        here = at == k
        rounds, i = np.divmod(block[here] - first, len(own))
        slots[here] = begin + rounds * length + own[i]
    return np.array([p[1] for p in phases], np.int32)[at], slots


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_bytes: int = BLOCK_BYTES,
    temperature: float = TEMPERATURE,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document its block, phase and slot: read by slot, the sources come in their target shares.

    ``weights`` gives each source its share of the bytes; without it, the weight
    of a source is its bytes to the power ``temperature``. The documents of a source,
    in an order shuffled by hash, are cut into blocks of ``block_bytes`` (UTF-8 bytes plus 1 each); a document belongs
    to the block it begins in, and one longer than a block uses up the slots of
    those it covers. Within a phase no source is a block or more ahead of or behind its share by the exact
    weights, however long the phase. No document is dropped or repeated: when
    a source is used up the others go on in proportion.

    ``position`` is ``before`` within a source; sort by ``slot`` and ``position``. Null
    text has one byte; a null source is the source ''. Equal rows
    have places of their own. A missing weight or one that is not above 0 is an error. Other columns are not
    read; an empty table gives an empty result.

    A source with most of the rows is spread over range partitions (``running``). One row
    per source goes to the driver, and the schedule to the tasks: 8 bytes a block at most (half a million blocks
    for 30 GB), less where the weights repeat; raise ``block_bytes`` for fewer.
    """
    if block_bytes < 1:
        raise ValueError("at least one byte in a block")
    spark = docs.sparkSession
    words = F.coalesce(plain(text), F.lit(""))
    sized = docs.select(
        plain(key).cast("long").alias("doc_id"),
        F.coalesce(plain(source).cast("string"), F.lit("")).alias("source"),
        (F.octet_length(words) + 1).cast("long").alias("size"),
        F.xxhash64(words).alias("sum"),
        F.xxhash64(plain(key), F.lit(3)).alias("draw"),
    )
    placed = pin(running(sized, "size", ["draw", "doc_id", "sum"], ["source"]).drop("rank", "draw"))
    totals = {r["source"]: r["bytes"] for r in placed.groupBy("source").agg(F.sum("size").alias("bytes")).collect()}  # one row per source
    wanted = {s: float(n) ** temperature for s, n in totals.items()} if weights is None else weights
    schedule = Schedule({s: -(-n // block_bytes) for s, n in totals.items()}, wanted)
    phases = spark.sparkContext.broadcast(schedule.phases)

    def placed_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            block = batch.column(4).to_numpy() // block_bytes
            phase, slot = np.zeros(len(block), np.int32), np.zeros(len(block), np.int64)
            for name in dict.fromkeys(names):
                here = names == name
                phase[here], slot[here] = place(phases.value[name], block[here])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block), pa.array(phase), pa.array(slot)], ["doc_id", "source", "size", "sum", "position", "block", "phase", "slot"]
            )

    schema = "doc_id long, source string, size long, sum long, position long, block long, phase int, slot long"
    return placed.select("doc_id", "source", "size", "sum", F.col("before").alias("position")).mapInArrow(placed_in, schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the mixed order: file by file and row by row as written."""
    names = dict(zip(("doc_id", "sum", "slot", "position"), unused(docs.columns, "__id", "__sum", "__slot", "__position"), strict=True))
    placed = mix_sources(docs).select(*[F.col(c).alias(n) for c, n in names.items()]).dropDuplicates([names["doc_id"], names["sum"]])
    on = plain("doc_id").cast("long").eqNullSafe(F.col(names["doc_id"])) & (F.xxhash64(F.coalesce(plain("text"), F.lit(""))) == F.col(names["sum"]))
    return docs.join(placed, on).orderBy(names["slot"], names["position"]).select(*[plain(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("sum")
