"""Packing of documents into sequences, by patterns fitted to the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.spans import texts
from tallystar.llm.tables import in_written_order, plain, running, table, unused
from tallystar.llm.tokens import WordEncoder
from tallystar.sources.scratch import pin

CAPACITY = 2048
#: Lengths are rounded up to so many grains of a sequence when patterns are fitted.
GRAINS = 128
#: Bytes of text encoded at once.
_TEXT_BYTES = 8 << 20
END = 0

# --- patterns ------------------------------------------------------------------------


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, most_steps: int) -> np.ndarray:
    """x >= 0 with the least ``|a x - b|`` (active sets after Lawson and Hanson), or close to it after ``most_steps``."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(most_steps):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            wanted = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (wanted > tolerance).all():
                x[:] = 0
                x[at] = wanted
                break
            low = wanted <= tolerance
            step = np.min(x[at][low] / np.maximum(x[at][low] - wanted[low], 1e-300))
            x[at] += step * (wanted - x[at])
            free[at[low & (x[at] <= tolerance)]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def patterns(grains: int) -> list[tuple[int, ...]]:
    """All ways to fill a sequence of ``grains`` with one, two or three lengths, longest first."""
    out: list[tuple[int, ...]] = [(grains,)]
    out += [(grains - j, j) for j in range(1, grains // 2 + 1)]
    out += [(grains - j - k, j, k) for k in range(1, grains // 3 + 1) for j in range(k, (grains - k) // 2 + 1)]
    return out


class Plan:
    """Where the documents of each length go, for a whole corpus, from its histogram alone.

    ``hist[l]`` documents of length l are numbered from 0; a row of ``rows`` says
    that those of ``length`` numbered ``rank`` to ``rank + n - 1`` go to the sequences
    ``sequence``, ``sequence + 1``, ... each at ``offset``. The number of rows depends on the
    lengths and patterns, not on the number of documents.
    """

    def __init__(self, hist: np.ndarray, capacity: int = CAPACITY, grains: int = GRAINS):
        self.capacity = capacity
        self.left = hist.astype(np.int64).copy()
        self.taken = np.zeros_like(self.left)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.n_sequences = 0
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.open_count = np.zeros(capacity + 1, np.int64)
        self._fit(min(grains, capacity))
        self._best_fit()
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.n, self.sequence, self.offset = rows.T

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((length, int(self.taken[length]), n, sequence, offset))
        self.taken[length] += n
        self.left[length] -= n

    def _leave_open(self, space: int, sequence: int, n: int) -> None:
        if space and n:
            self.open[space].append((sequence, n))
            self.open_count[space] += n

    def _fit(self, grains: int) -> None:
        """Pack as many copies of each pattern as the rounded fit says and the documents allow."""
        grain = -(-self.capacity // grains)
        grains = self.capacity // grain
        bin_of = np.minimum(-(-np.arange(self.capacity + 1) // grain), grains)
        wanted = np.bincount(bin_of[1:], self.left[1:], grains + 1)[1:]
        shapes = patterns(grains)
        a = np.zeros((grains, len(shapes)))
        for j, shape in enumerate(shapes):
            for g in shape:
                a[g - 1, j] += 1
        copies = np.rint(non_negative_least_squares(a, wanted, 4 * grains)).astype(np.int64)
        for j in np.argsort(-copies, kind="stable"):
            if copies[j]:
                self._realise(shapes[j], int(copies[j]), grain)

    def _longest(self, most: int, least: int = 1) -> int:
        """The longest length still there of at most ``most``, or 0."""
        found = np.flatnonzero(self.left[least : most + 1])
        return int(found[-1]) + least if len(found) else 0

    def _realise(self, shape: tuple[int, ...], copies: int, grain: int) -> None:
        while copies:
            room, picked = self.capacity, []
            for i, g in enumerate(shape):
                # The last one may be any length that fits best.
                last = i == len(shape) - 1 and i > 0
                length = self._longest(room) if last else self._longest(min(room, g * grain), (g - 1) * grain + 1)
                if not length:
                    break
                picked.append(length)
                self.left[length] -= 1
                room -= length
            for length in picked:
                self.left[length] += 1
            if len(picked) < len(shape):
                return
            n = min(copies, *(int(self.left[x]) // picked.count(x) for x in picked))
            if n == 0:
                return
            offset = 0
            for length in picked:
                self._put(length, n, self.n_sequences, offset)
                offset += length
            self._leave_open(self.capacity - offset, self.n_sequences, n)
            self.n_sequences += n
            copies -= n

    def _best_fit(self) -> None:
        """Residuals, longest first, each to the fullest sequence it fits in; a new one if there is none."""
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                spaces = np.flatnonzero(self.open_count[length:])
                n = int(self.left[length])
                if len(spaces):
                    space = int(spaces[0]) + length
                    sequence, there = self.open[space].pop()
                    self.open_count[space] -= there
                else:
                    space, sequence = self.capacity, self.n_sequences
                    there = -(-n // (space // length))
                    self.n_sequences += there
                each = space // length
                used = min(there, -(-n // each))
                if used < there:
                    self._leave_open(space, sequence + used, there - used)
                full = min(each, n // used)
                for i in range(full):
                    self._put(length, used, sequence, self.capacity - space + i * length)
                rest = min(n - full * used, used) if full < each else 0
                if rest:
                    self._put(length, rest, sequence, self.capacity - space + full * length)
                    self._leave_open(space - (full + 1) * length, sequence, rest)
                self._leave_open(space - full * length, sequence + rest, used - rest)


# --- documents -----------------------------------------------------------------------


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False, key: str = "doc_id", text: str = "text", order: Sequence[str] = ()
) -> DataFrame:
    """The documents as token pieces of at most ``capacity``: doc_id, piece, start, length, ids_crc32, and ``ids`` if asked.

    The long columns ``order`` go along as order0, order1 and so on.

    A document is the ids of its whole text (null: empty) and then id 0. If longer
    than ``capacity`` it is cut so that all pieces but the first are full.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + "".join(f", order{k} long" for k in range(len(order)))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids + [f"order{k}" for k in range(len(order))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary)
        for batch in batches:
            for some in texts(batch.column(1), _TEXT_BYTES):
                ids, begins = encoder.encode_texts(some)
                # Every document's own id at its end, and then the bounds of its pieces: the first takes what is left over.
                ids, begins = np.insert(ids, begins[1:], END).astype("<u4"), begins + np.arange(len(begins))
                n = np.diff(begins)
                count = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(piece == 0, 0, np.repeat(n - count * capacity, count) + piece * capacity)
                length = np.append(start[1:], 0) - start
                last = np.cumsum(count) - 1
                length[last] = n - start[last]
                data, ends = memoryview(ids.tobytes()), 4 * np.cumsum(length)
                crc = [zlib.crc32(data[a:b]) for a, b in zip((ends - 4 * length).tolist(), ends.tolist(), strict=True)]
                row = pa.array(doc + some.rows.start)
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, ends // 4).astype(np.int32)), pa.array(ids.astype(np.int32)))] * with_ids
                own = [batch.column(0).take(row), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([*own, *lists, *[c.take(row) for c in batch.columns[2:]]], names)

    return docs.select(plain(key).cast("long"), plain(text), *[plain(c) for c in order]).toDF(*[f"c{i}" for i in range(2 + len(order))]).mapInArrow(cut, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY, grains: int = GRAINS, order: Sequence[str] = ()) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    The histogram of lengths (at most ``capacity`` rows) goes to the driver. There
    repeat counts of all patterns of one to three rounded lengths that fill a
    sequence are fitted to it by non-negative least squares and rounded; residual
    documents are packed best fit, longest first, also counted by length. The
    plan has rows per length and pattern and goes to all tasks; a piece finds
    its place by its length and its number among the pieces of that length, a running count.

    ``cut`` must be a written table, since it is read twice. Pieces of a length are numbered by
    ``order``, then doc_id, piece, start and checksum. Equal pieces get places of their own.
    """
    spark = cut.sparkSession
    hist = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # one row per length
        hist[length] = n
    plan = Plan(hist, capacity, grains)
    shared = spark.sparkContext.broadcast(((plan.length << 42) + plan.rank, plan.rank, plan.sequence, plan.offset))
    numbered = running(
        cut.select("doc_id", "piece", "start", "length", "ids_crc32", *order), "length", [*order, "doc_id", "piece", "start", "ids_crc32"], ["length"]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rank0, sequence, offset = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(first, (length << 42) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[at] + rank - rank0[at]), pa.array(offset[at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, grains: int = GRAINS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents cut into pieces and packed into as few sequences as the patterns reach.

    A null or empty text is a document of one id. A null key is kept. Rows that
    share a key are packed one by one. Other columns are not read. An empty
    table gives an empty result.
    """
    return pack(pin(pieces(docs, vocabulary, capacity, key=key, text=text)), capacity, grains)


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, from pieces with ids and their places."""
    on = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = cut.dropDuplicates(on).select("ids", *[F.col(c).alias(f"_{c}") for c in on])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    # A sequence holds at most its capacity of ids.
    return (
        placed.join(ids, same)
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed in the order they are written in: of the pieces of a length, those of earlier rows come first."""
    import public_tokenizers

    order = unused(docs.columns, "__file", "__row")
    cut = pieces(in_written_order(docs, *order), public_tokenizers.path("byte_bpe_50k.json"), order=order)
    return pack(pin(cut), order=["order0", "order1"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
