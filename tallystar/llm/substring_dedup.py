"""Runs of words that occur earlier, found by recompression."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.llm.spans import Texts, hash_spans, mix, owner, texts
from tallystar.llm.tables import by_position, plain, table, unused
from tallystar.sources.scratch import pin

WINDOW = 20
#: Rounds of pairs after which symbols are counted over all documents, one Spark round each.
LEVELS = (3, 5)
#: Layout, not limits: bytes of text recompressed together, of the texts of a group, and of all texts per task that counts or judges.
SLICE_BYTES = 4 << 20
GROUP_BYTES = 3 << 20
BUCKET_BYTES = 32 << 20
_NULL = -(2**63)
_FAR = 1 << 40

#: Words before and after the first word of a symbol that decide where it begins, what it is, and that it is one.
BEFORE, AFTER = 3, 4
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW32, _LOW48 = np.uint64(0xFFFFFFFF), np.uint64((1 << 48) - 1)


# --- recompression ---------------------------------------------------------------------------


def symbols(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the symbols begin after a round of naming runs and then pairs, and their names.

    Two equal words that are not part of a longer run become one symbol. Then every symbol is of the
    left or the right kind, by its name, and a left one followed by a right one becomes
    one. Names are hashes of what they stand for, so all tasks name
    alike. What begins at word i depends on words i - BEFORE to i + AFTER only, so equal
    texts have equal symbols but for their ends.
    """
    n = len(words)
    same = np.zeros(n + 2, bool)  # same[i + 1]: words i and i + 1 are equal, in one text
    same[1:n] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    twin = same[1 : n + 1] & ~same[:n]
    twin &= ~same[2 : n + 2]
    first = np.ones(n, bool)
    first[1:] = ~twin[:-1]
    begin = np.flatnonzero(first)
    name = np.where(twin[begin], mix(words[begin] + _K1), words[begin])

    right = (mix(name ^ _K2) >> np.uint64(63)).astype(bool)
    joined = np.zeros(len(begin), bool)  # with the symbol before
    joined[1:] = right[1:] & ~right[:-1] & (text[begin[1:]] == text[begin[:-1]])
    whole = np.flatnonzero(~joined)
    follower = np.minimum(whole + 1, len(begin) - 1)
    pair = (whole + 1 < len(begin)) & joined[follower]
    return begin[whole], np.where(pair, mix(name[whole] * _K1 + name[follower]), name[whole])


@dataclass
class Symbols:
    """Symbols of some texts in order: text, name, and the words (from ``lo`` to before ``hi``) that decide where each begins and ends.

    Where the end of a text has a say, ``lo`` or ``hi`` is far away.
    """

    text: np.ndarray
    name: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a symbol is the first or the last of its text."""
        new = np.ones(len(self.text) + 1, bool)
        new[1:-1] = self.text[1:] != self.text[:-1]
        return new[:-1], new[1:]


def name_runs(words: np.ndarray, text: np.ndarray) -> Symbols:
    """Every longest run of equal words becomes a symbol; that its neighbours differ is part of it."""
    begin = _runs(text, words)
    end = np.append(begin[1:], len(words))
    count = (end - begin).astype(np.uint64)
    out = Symbols(text[begin], np.where(count > 1, mix(words[begin] * _K1 + count), words[begin]), begin - 1, end + 1)
    head, tail = out.edges()
    out.lo[head], out.hi[tail] = -_FAR, _FAR
    return out


def name_pairs(s: Symbols, level: int) -> Symbols:
    """Every symbol is of the left or the right kind, by its name; a left one and the right one after it become one.

    A pair is decided by its two symbols. A left one that stays alone is decided by the next, a right one by the one before.
    """
    right = (mix(s.name ^ (np.uint64(level) * _K1)) >> np.uint64(63)).astype(bool)
    head, tail = s.edges()
    joined = right & ~head
    joined[1:] &= ~right[:-1]
    whole = np.flatnonzero(~joined)
    follower = np.minimum(whole + 1, len(right) - 1)
    pair = joined[follower] & (follower > whole)
    alone = mix(s.name[whole] + np.uint64(level))
    lo = np.where(right[whole], np.where(head[whole], -_FAR, s.lo[whole - 1]), s.lo[whole])
    hi = np.where(right[whole], s.hi[whole], np.where(tail[whole], _FAR, s.hi[follower]))
    return Symbols(s.text[whole], np.where(pair, mix(s.name[whole] * _K1 + s.name[follower]), alone), lo, hi)


def possible(words: np.ndarray, text: np.ndarray, width: int, told: Mapping[int, Callable], levels: Sequence[int], ask: int | None = None):
    """Marks the words where a window begins that may occur twice; with ``ask``, the names of that level and whether each occurs twice here.

    A window holds all symbols that its own words decide, and equal windows hold the same; so a window with a
    symbol that occurs once in all documents occurs once. ``told`` has, for each of the levels before ``ask``, a function that says which of
    its names occur twice. Only names below a window that is still possible are asked, each once: equal windows
    are possible at all their places, so their names are asked at all of them.
    """
    live = np.zeros(len(words), bool)
    n = len(words) - width + 1
    if n < 1:
        return live if ask is None else (np.zeros(0, np.uint64), np.zeros(0, bool))
    live[:n] = text[:n] == text[width - 1 :]
    found, height = name_runs(words, text), 0
    for level in levels:
        while height < level:
            height += 1
            found = name_pairs(found, height)
        fit = np.flatnonzero(found.hi - found.lo <= width)
        first, last = np.maximum(found.hi[fit] - width, 0), found.lo[fit] + 1
        before = np.concatenate([[0], np.cumsum(live)])
        some = before[last] > before[first]
        fit, first, last = fit[some], first[some], last[some]
        names, number, counts = np.unique(found.name[fit], return_inverse=True, return_counts=True)
        if level == ask:
            return names, counts > 1
        if not len(names):
            continue
        once = ~told[level](names)[number]
        steps = np.bincount(first[once], minlength=len(live) + 1) - np.bincount(last[once], minlength=len(live) + 1)
        live &= np.cumsum(steps)[:-1] == 0
    return live


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def _row_hashes(words: np.ndarray, width: int, odd: np.uint64) -> np.ndarray:
    """A hash of each ``width`` words in a row: sums of powers, by differences of running sums."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    power = np.ones(len(words), np.uint64)
    power[1:] = odd
    power = np.multiply.accumulate(power)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ odd) * power, dtype=np.uint64)])
    back = np.ones(n, np.uint64)
    back[1:] = np.uint64(pow(int(odd), -1, 1 << 64))
    return mix((total[width:] - total[:n]) * np.multiply.accumulate(back))


def windows(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """All windows of the texts: their first word, text, anchor word, key of the anchor, and hash.

    The anchor of a window is the first of the symbols with the least name among those that begin where the
    window's own words decide them; its key is the words around it. Equal
    windows have the same anchor at the same place.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(words) - width + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    begin, name = symbols(words, text)
    order = np.full(len(words), np.uint64(2**64 - 1))
    order[begin] = (mix(name) >> np.uint64(32) << np.uint64(32)) | begin.astype(np.uint64)
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    # Symbols that begin BEFORE words after the window's first word, up to AFTER words before its last.
    anchor = (_least(order, width - BEFORE - AFTER)[at + BEFORE] & _LOW32).astype(np.int64)
    around = _row_hashes(words, BEFORE + AFTER + 1, _K1)
    return at, text[at], anchor, around[anchor - BEFORE], _row_hashes(words, width, _K2)[at]


# --- who is first ----------------------------------------------------------------------------


def later_ones(window: np.ndarray, rest: tuple[np.ndarray, ...], *place: np.ndarray) -> np.ndarray:
    """Marks the rows whose window, told by ``window`` and ``rest``, is also at an earlier place. Places are compared column by column."""
    out = np.zeros(len(window), bool)
    order = np.argsort(window, kind="stable")
    equal = window[order][1:] == window[order][:-1]
    some = np.zeros(len(window), bool)
    some[1:] |= equal
    some[:-1] |= equal
    rows = order[some]
    if not len(rows):
        return out
    told = [window, *rest]
    rows = rows[np.lexsort([p[rows] for p in reversed(place)] + [x[rows] for x in reversed(told)])]
    new = np.concatenate([[True], np.logical_or.reduce([x[rows][1:] != x[rows][:-1] for x in told])])
    head = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
    out[rows] = np.logical_or.reduce([p[rows] != p[head] for p in place])
    return out


def _low_bytes(values: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_bytes(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(raw, np.uint8).reshape(-1, n)
    return out.view("<u8")[:, 0]


_ROW = "bucket int, reply boolean, docs binary, sums binary, anchors binary, hashes binary"
_NAMES = ["bucket", "reply", "docs", "sums", "anchors", "hashes"]
_KINDS = [pa.int32(), pa.bool_(), *[pa.binary()] * 4]
_SENT = pa.schema(list(zip(_NAMES, _KINDS, strict=True)))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _replies(ids: np.ndarray, sums: np.ndarray, starts: np.ndarray, buckets: int) -> list[tuple]:
    """Starts of repeated windows, a row per bucket of documents: ids, sums, and per document its starts and their number."""
    if not len(ids):
        return []
    bucket = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((starts, sums, ids, bucket))
    bucket, ids, sums, starts = (x[order] for x in (bucket, ids, sums, starts))
    rows, cuts = [], _runs(bucket)
    for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True):
        heads = _runs(ids[a:b], sums[a:b]) + a
        counts = np.diff(np.append(heads, b)).astype("<u4")
        rows.append((int(bucket[a]), True, ids[heads].tobytes(), sums[heads].tobytes(), counts.tobytes(), starts[a:b].astype("<i4").tobytes()))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that are equal in group, id and checksum, once."""
    for batch in batches:
        if batch.num_rows:
            ids, sums = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            order = np.lexsort((sums, ids))
            yield batch.take(pa.array(np.sort(order[_runs(ids[order], sums[order])])))


def _slices(group: pa.Table) -> Iterator[tuple[int, Texts, np.ndarray, np.ndarray]]:
    """The different documents of a group in order of id and checksum, in slices of bounded size: number, texts, ids and checksums."""
    ids, sums = group.column("id").to_numpy(), group.column("sum").to_numpy()
    order = np.lexsort((sums, ids))
    if len(order):
        order = order[_runs(ids[order], sums[order])]
    column = group.column("text").take(pa.array(order))
    for part, t in enumerate(texts(column, SLICE_BYTES)):
        rows = order[t.rows]
        yield part, t, ids[rows], sums[rows]


def _bucket_order(names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names in order of their buckets, their buckets, and where each bucket begins."""
    bucket = (mix(names ^ _K2) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order], _runs(bucket[order])[: len(order)]


def _told(marks: pa.Table | None, part: int, buckets: int) -> dict[int, Callable]:
    """Per level counted so far, the answers that came back for the names of a slice."""
    if marks is None:
        return {}
    mine = marks.filter(pc.equal(marks.column("part"), part)).to_pylist()

    def answers(level: int) -> Callable:
        rows = {r["bucket"]: r["bits"] for r in mine if r["level"] == level}

        def told(names: np.ndarray) -> np.ndarray:
            out = np.zeros(len(names), bool)
            order, bucket, cuts = _bucket_order(names, buckets)
            for a, b in zip(cuts, [*cuts[1:], len(names)][: len(cuts)], strict=True):
                out[order[a:b]] = np.unpackbits(np.frombuffer(rows[int(bucket[a])], np.uint8), count=b - a).astype(bool)
            return out

        return told

    return {level: answers(level) for level in pc.unique(marks.column("level")).to_pylist()}


_ASK = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("part", pa.int32()), ("level", pa.int32()), ("names", pa.binary()), ("twice", pa.binary())])
_ASKED = "bucket int, slice int, part int, level int, names binary, twice binary"
_MARK = "slice int, part int, level int, bucket int, bits binary"


def _ask(width: int, buckets: int, levels: Sequence[int], level: int):
    """The names of a level to their buckets, each once per slice."""

    def ask(group: pa.Table, marks: pa.Table | None) -> pa.Table:
        rows = []
        for part, t, _, _ in _slices(group):
            starts, ends, first = t.words()
            names, twice = possible(hash_spans(t.buf, starts, ends), owner(first), width, _told(marks, part, buckets), levels, level)
            order, bucket, cuts = _bucket_order(names, buckets)
            for a, b in zip(cuts, [*cuts[1:], len(names)][: len(cuts)], strict=True):
                here = order[a:b]
                rows.append((int(bucket[a]), group.column("slice")[0].as_py(), part, level, _low_bytes(names[here], 6), np.packbits(twice[here]).tobytes()))
        return pa.Table.from_pylist([dict(zip(_ASK.names, r, strict=True)) for r in rows], _ASK)

    return ask


def _alone(ask: Callable) -> Callable:
    def alone(group: pa.Table) -> pa.Table:
        return ask(group, None)

    return alone


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All occurrences of the names of a bucket are here: for every slice, which of its names occur twice."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    if not rows:
        return
    names = _from_bytes(b"".join(r["names"] for r in rows), 6)
    ends = np.cumsum([len(r["names"]) // 6 for r in rows])
    begins = np.concatenate([[0], ends[:-1]])
    again = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=b - a) for r, a, b in zip(rows, begins, ends, strict=True)]).astype(bool)
    order = np.argsort(names, kind="stable")
    run = np.cumsum(np.concatenate([[True], names[order][1:] != names[order][:-1]])) - 1
    often = np.bincount(run, 1 + again[order]) > 1
    again[order] = often[run]
    bits = [np.packbits(again[a:b]).tobytes() for a, b in zip(begins, ends, strict=True)]
    columns = [pa.array([r[c] for r in rows], pa.int32()) for c in ("slice", "part", "level", "bucket")]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(bits, pa.binary())], ["slice", "part", "level", "bucket", "bits"])


def _send(width: int, buckets: int, levels: Sequence[int]):
    """Possible windows to the bucket of their anchor, each once per slice, and replies for those found again within the slice."""

    def send(group: pa.Table, marks: pa.Table) -> pa.Table:
        rows = []
        for part, t, ids, sums in _slices(group):
            starts, ends, first = t.words()
            words = hash_spans(t.buf, starts, ends)
            live = possible(words, owner(first), width, _told(marks, part, buckets), levels)
            if live.any():
                rows += _window_rows(windows(words, first, width), live, first, ids, sums, buckets)
        return pa.Table.from_batches([_batch(rows)] if rows else [], _SENT)

    return send


def _window_rows(found: tuple[np.ndarray, ...], live: np.ndarray, first: np.ndarray, ids: np.ndarray, sums: np.ndarray, buckets: int) -> list[tuple]:
    at, text, anchor, key, hashed = (x[live[found[0]]] for x in found)
    start = at - first[text]
    again = later_ones(hashed, (key,), ids[text], sums[text], start)
    rows = _replies(ids[text[again]], sums[text[again]], start[again], buckets)
    at, text, anchor, key, hashed, start = (x[~again] for x in (at, text, anchor, key, hashed, start))
    bucket = (mix(key ^ _K2) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at, text, anchor, key, hashed, start, bucket = (x[order] for x in (at, text, anchor, key, hashed, start, bucket))
    cuts = _runs(bucket)[: len(bucket)]
    for a, b in zip(cuts, [*cuts[1:], len(bucket)][: len(cuts)], strict=True):
        # Per anchor: its key, its place in the text, and the document's number here; per window: its hash and place before the anchor.
        heads = _runs(anchor[a:b]) + a
        docs, number = np.unique(text[heads], return_inverse=True)
        counts = np.diff(np.append(heads, b)).astype(np.uint8)
        per_anchor = _low_bytes(key[heads] & _LOW48, 6) + (anchor - at + start)[heads].astype("<u4").tobytes() + number.astype("<u4").tobytes() + counts.tobytes()
        per_window = _low_bytes(hashed[a:b] & _LOW48, 6) + (anchor - at)[a:b].astype(np.uint8).tobytes()
        rows.append((int(bucket[a]), False, ids[docs].tobytes(), sums[docs].tobytes(), per_anchor, per_window))
    return rows


def _judge(buckets: int):
    """All windows of the anchors of a bucket are here: replies for those that also start earlier."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        for batch in batches:
            yield batch.filter(batch.column(1))
            for row in batch.filter(pc.invert(batch.column(1))).to_pylist():
                n, m = len(row["anchors"]) // 15, len(row["hashes"]) // 7
                key = _from_bytes(row["anchors"][: 6 * n], 6)
                place = np.frombuffer(row["anchors"], "<u4", n, 6 * n)
                number = np.frombuffer(row["anchors"], "<u4", n, 10 * n)
                of = np.repeat(np.arange(n), np.frombuffer(row["anchors"], np.uint8, n, 14 * n))
                hashed, before = _from_bytes(row["hashes"][: 6 * m], 6), np.frombuffer(row["hashes"], np.uint8, m, 6 * m)
                # 48 bits of hash and 48 of key, in 64 and 32.
                window = (hashed << np.uint64(16)) | (key & np.uint64(0xFFFF))[of]
                found.append(
                    [
                        window,
                        (key >> np.uint64(16)).astype(np.uint32)[of],
                        before,
                        np.frombuffer(row["docs"], np.int64)[number][of],
                        np.frombuffer(row["sums"], np.int32)[number][of],
                        (place[of] - before).astype(np.int32),
                    ]
                )
        if found:
            window, keys, before, ids, sums, starts = (np.concatenate(c) for c in zip(*found, strict=True))
            found.clear()
            again = later_ones(window, (keys, before), ids, sums, starts)
            del window, keys, before
            if rows := _replies(ids[again], sums[again], starts[again], buckets):
                yield _batch(rows)

    return judge


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All replies of a bucket of documents are here: one row per document."""
    found: list[list[np.ndarray]] = []
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["anchors"], "<u4")
            found.append(
                [
                    np.repeat(np.frombuffer(row["docs"], np.int64), counts),
                    np.repeat(np.frombuffer(row["sums"], np.int32), counts),
                    np.frombuffer(row["hashes"], "<i4"),
                ]
            )
    if not found:
        return
    ids, sums, starts = (np.concatenate(c) for c in zip(*found, strict=True))
    found.clear()
    order = np.lexsort((starts, sums, ids))
    ids, sums, starts = ids[order], sums[order], starts[order]
    cuts = _runs(ids, sums)
    packed = pa.array([starts[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(ids[cuts]), pa.array(sums[cuts]), packed], ["id", "sum", "starts"])


# --- operator --------------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, width: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words of repeated windows removed, and ``__n_words`` (before) and ``__n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``width`` (10 to 255) consecutive words
    of one document. A word goes if a window that covers it also starts earlier: in a smaller id,
    or in the same document at an earlier word. Windows are judged on the input. The text becomes the kept words with
    single spaces.

    How: recompression names runs of words, then level by level pairs of symbols, the same way everywhere, so equal
    windows hold the same symbols wherever their own words decide these. A Spark round per entry of ``LEVELS`` counts the names of that level
    over all documents: each slice of text asks once for each of its names, and only for those under a window that
    is still possible; a window with a name that occurs once is not. Names are hashes, so that a round need not
    rename the texts; a chance collision only lets a window go on to be verified. Each possible window goes by its anchor, a symbol
    of the first round in it, to the task where all equal windows meet; windows that share an anchor travel
    together in packed arrays, each once per slice, so a passage in most documents reaches a task once per slice. There
    key and hash, 96 bits in all, verify which are equal, and those that are not the first are sent
    back, packed by document. Groups of texts and tasks follow the bytes of the input.

    Null text has no words. Documents of less than ``width`` words have no windows. Rows that share an id are
    ordered by a checksum of their text; rows equal in id and text are one document. A null id
    is the smallest. Other columns stay, whatever their names, but for an earlier ``__n_words`` or
    ``__n_removed``, which is replaced. An empty table stays empty.
    """
    if not BEFORE + AFTER + 3 <= width <= 255:
        raise ValueError("windows have 10 to 255 words")
    docs = docs.drop("__n_words", "__n_removed")
    id_name, sum_name, starts_name = unused(docs.columns, "__id", "__sum", "__starts")
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length(plain(text)).cast("long"))).first()[0] or 0
    buckets, groups = max(least, -(-size // BUCKET_BYTES)), max(1, -(-size // GROUP_BYTES))
    id_ = F.coalesce(plain(key).cast("long"), F.lit(_NULL))
    # A checksum that fits an int.
    sum_ = F.hash(F.coalesce(plain(text), F.lit("")))
    given = docs.select(F.pmod(F.xxhash64(id_, sum_), F.lit(groups)).cast("int").alias("slice"), id_.alias("id"), sum_.alias("sum"), plain(text).alias("text"))
    grouped = given.mapInArrow(_once, given.schema).repartition(max(least, groups // 8), "slice").groupBy("slice")
    marks, levels = None, LEVELS
    for level in levels:
        ask = _ask(width, buckets, levels, level)
        if marks is None:
            asked = grouped.applyInArrow(_alone(ask), _ASKED)
        else:
            asked = grouped.cogroup(marks.groupBy("slice")).applyInArrow(ask, _ASKED)
        counted = pin(asked.repartitionById(buckets, F.col("bucket")).mapInArrow(_count, _MARK))
        marks = counted if marks is None else marks.unionByName(counted)
    sent = grouped.cogroup(marks.groupBy("slice")).applyInArrow(_send(width, buckets, levels), _ROW)
    replies = sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_judge(buckets), _ROW).where("reply")
    starts = replies.repartitionById(buckets, F.col("bucket")).mapInArrow(_gather, "id long, sum int, starts binary").toDF(id_name, sum_name, starts_name)
    names = docs.columns
    fields = [T.StructField(f.name, T.StringType()) if f.name == text else f for f in docs.schema.fields]
    schema = T.StructType([*fields, T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            for value, packed in zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                words = (value or b"").split()
                n_words.append(len(words))
                if packed:
                    edge = np.zeros(len(words) + 1, np.int64)
                    first = np.frombuffer(packed, np.int32)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + width, -1)
                    words = [w for w, gone in zip(words, np.cumsum(edge).tolist(), strict=False) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], schema.fieldNames())

    joined = docs.join(starts, (id_ == F.col(id_name)) & (sum_ == F.col(sum_name)), "left")
    return by_position(joined.select(*[plain(c) for c in names], starts_name)).mapInArrow(cut, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
with words as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 18)) as s, w from words where len(w) >= 20),
windows as (select doc_id, s, array_to_string(w[s : s + 19], ' ') as win from starts),
firsts as (select win, min((doc_id, s)) as first from windows group by win having count(*) > 1),
repeats as (select x.doc_id, x.s from windows x join firsts f on x.win = f.win where (x.doc_id, x.s) <> f.first),
edges as (
    select doc_id, pos, sum(step) as step
    from (select doc_id, s as pos, 1 as step from repeats union all select doc_id, s + 20, -1 from repeats) group by doc_id, pos),
spelt as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from words where len(w) > 0),
judged as (
    select s.doc_id, s.word, s.pos, sum(coalesce(e.step, 0)) over (partition by s.doc_id order by s.pos) > 0 as gone
    from spelt s left join edges e on e.doc_id = s.doc_id and e.pos = s.pos),
kept as (
    select doc_id, count(*) filter (where gone) as n_removed, coalesce(string_agg(word, ' ' order by pos) filter (where not gone), '') as kept
    from judged group by doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(k.n_removed, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from words w left join kept k on k.doc_id = w.doc_id
"""
