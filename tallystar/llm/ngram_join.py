"""Documents that share nine tenths of their word n-grams, by blocked incidence products."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.components import components, spanning
from tallystar.llm.spans import LOWER, Texts, hash_spans, mix, texts
from tallystar.llm.tables import plain, table, unused
from tallystar.sources.scratch import kept, pin

#: Links ask for an intersection of at least PERCENT / 100 of the union.
PERCENT = 90
WIDTH = 3
#: Near duplicates of the pipeline, as elsewhere: five words, 80 percent.
STAGE_PERCENT, STAGE_WIDTH = 80, 5
#: Layout, not limits: documents and n-grams of a block, and columns multiplied at once.
BLOCK = 1024
BLOCK_GRAMS = 1 << 20
COLUMNS = 4096
#: N-grams of one document in so many are common.
COMMON = 2048
#: Bytes of text in which n-grams are counted together.
_COUNTED_BYTES = 4 << 20
_NULL = -(2**63)


# --- n-grams of a slice of texts -----------------------------------------------------------


def ngram_sets(t: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different n-gram hashes of each text, sorted, one text after the other, and where each begins."""
    starts, ends, first = t.words()
    words = hash_spans(LOWER[t.buf], starts, ends)
    n_words = np.diff(first)
    n_grams = np.where(n_words == 0, 0, np.maximum(n_words - width + 1, 1))
    begin = np.concatenate([[0], np.cumsum(n_grams)])
    text = np.repeat(np.arange(len(t)), n_grams)
    at = np.repeat(first[:-1], n_grams) + np.arange(len(text)) - np.repeat(begin[:-1], n_grams)
    grams = np.zeros(len(text), np.uint64)
    last = np.repeat(first[1:], n_grams)
    for i in range(width):
        inside = at + i < last
        step = np.where(inside, words[np.minimum(at + i, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else grams
        grams = np.where(inside, mix(grams * np.uint64(0x9E3779B97F4A7C15) + step + np.uint64(i + 1)), grams)
    order = np.lexsort((grams, text))
    grams = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=len(t))
    return grams[new], np.concatenate([[0], np.cumsum(counts)])


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[begin[1:]] - total[begin[:-1]]


# --- signatures ----------------------------------------------------------------------------


class Scheme:
    """Signatures such that two linked sets have one in common.

    Linked sets of sizes m and n differ in at most ``(100 - p) / (100 + p) * (m + n)``
    elements. A class of sizes up to ``high`` cuts every set into more parts, by hash,
    than two linked sets of the class can differ in; so some part is the same in both.
    Empty parts tell nothing. A linked set lacks at most as many of a set's filled parts as the two differ in, so two linked sets have a part in
    common among the first of each, one more than that, in any order that is the same for all: the fullest first. The others, often a single
    element that strangers have by chance and become one family through, are not signed. If the filled parts are not more than a set
    can differ in from a linked one, it signs them all, and also elements by themselves. Two linked sets have one in common among the first ``n - p n / 100 + 1``
    of their n elements in any order that is the same for all sets; here common ones come last. Elements that very many sets have
    are also left out of the parts, since sets without them differ no more; else all documents with a common passage would
    look alike where a part holds nothing but that. A set signs for
    its own class, and for the next if a larger partner may be there. Classes grow by a quarter, so from 80 percent
    on no partner is farther off, and parts hold about as much as they can.
    """

    def __init__(self, percent: int):
        if not 80 <= percent <= 100:
            raise ValueError("links ask for 80 to 100 percent")
        self.percent = percent
        highs = [1]
        while highs[-1] < 1 << 40:
            highs.append(max(highs[-1] + 1, highs[-1] * 5 // 4))
        self.highs = np.array(highs)
        self.differ = 2 * self.highs * (100 - percent) // (100 + percent)
        # A quarter to spare: so many parts at least need not be signed.
        self.parts = self.differ + 2 + self.differ // 4

    def _most_differing(self, sizes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """In how many elements a set of that size can differ from any linked one of the class."""
        largest = np.minimum(self.highs[kinds], sizes * 100 // self.percent)
        return (sizes + largest) * (100 - self.percent) // (100 + self.percent)

    def sign(self, grams: np.ndarray, begin: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Signatures, and the set of each. ``common`` (sorted) are elements left out of parts."""
        sizes = np.diff(begin)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rare = np.ones(len(grams), bool)
        if common is not None and len(common):
            rare = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] != grams
        # Places of the elements, rare ones first, and how many of a set are signed at most.
        rares = np.concatenate([[0], np.cumsum(rare)])
        place_rare = rares[:-1] - rares[begin[owner]]
        place_common = (rares[begin[1:]] - rares[begin[:-1]])[owner] + np.arange(len(grams)) - begin[owner] - place_rare
        rank = np.where(rare, place_rare, place_common)
        ahead = sizes + (-self.percent * sizes // 100) + 1
        own = np.searchsorted(self.highs, sizes)
        up = (sizes > 0) & (100 * sizes >= self.percent * (self.highs[own] + 1))
        signs, sets = [], []
        for kinds, chosen in ((own, sizes > 0), (own + 1, up)):
            chosen = chosen & (self.differ[kinds] > 0)  # else only equal sets are linked
            inside = chosen[owner]
            which, values = owner[inside & rare], grams[inside & rare]
            filled, most = np.zeros(len(sizes), np.int64), self._most_differing(sizes, kinds)
            if len(which):
                kind = kinds[which]
                part = ((values >> np.uint64(20)) % self.parts[kind].astype(np.uint64)).astype(np.int64)
                place = np.concatenate([[0], np.cumsum(np.where(chosen, self.parts[kinds], 0))])
                slot = place[which] + part
                order = np.argsort(slot, kind="stable")
                slot = slot[order]
                new = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
                sums = np.add.reduceat(mix(values[order]), new)
                part_set, part_at, part_kind = which[order][new], part[order][new], kind[order][new]
                made = mix(sums + mix((part_kind.astype(np.uint64) << np.uint64(44)) + part_at.astype(np.uint64)))
                filled = np.bincount(part_set, minlength=len(sizes))
                fullest = np.lexsort((made, -np.diff(new, append=len(slot)), part_set))
                ahead_of = np.arange(len(made)) - np.repeat(np.cumsum(filled) - filled, filled)
                signed = fullest[ahead_of <= most[part_set]]
                signs.append(made[signed])
                sets.append(part_set[signed])
            unsure = chosen & (filled <= most)
            alone = unsure[owner] & (rank < ahead[owner])
            signs.append(mix(grams[alone] + mix(kinds[owner[alone]].astype(np.uint64) + (np.uint64(1) << np.uint64(60)))))
            sets.append(owner[alone])
        return np.concatenate(signs), np.concatenate(sets)


def _often(width: int):
    """N-grams that several documents of a slice share, and how many do."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(0), _COUNTED_BYTES):
                grams, counts = np.unique(ngram_sets(t, width)[0], return_counts=True)
                several = counts >= 3
                yield pa.RecordBatch.from_arrays([pa.array(grams[several].view(np.int64)), pa.array(counts[several])], ["gram", "n"])

    return often


def _common(docs: DataFrame, width: int, n_docs: int, one_in: int) -> np.ndarray:
    """N-grams of about one document in ``one_in`` or more, sorted.

    There are at most ``one_in`` times as many as an average document has, however many
    documents there are, so the driver can hold them. Which they are changes the work, not the result.
    """
    least = max(8, n_docs // one_in)
    often = docs.select("text").mapInArrow(_often(width), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["gram"] for r in often.select("gram").collect()], np.int64).view(np.uint64))


def _measure(width: int):
    """Size and checksums of each document's set."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                grams, begin = ngram_sets(t, width)
                sums = [_sums(mix(grams ^ salt), begin) for salt in _SALTS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.rows.start, len(t)), pa.array(np.diff(begin)), *(pa.array(x.view(np.int64)) for x in sums)],
                    ["id", "n", "set1", "set2"],
                )

    return measure


_SALTS = (np.uint64(0), np.uint64(0xD6E8FEB86659FD93))
_PACKET = "bucket int, links boolean, left binary, right binary, sets binary"
_NAMES = ["bucket", "links", "left", "right", "sets"]


def _group(signs: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each signature once, with one of its sets, and links from the others to that one."""
    order = np.lexsort((sets, signs))
    signs, sets = signs[order], sets[order]
    new = np.ones(len(signs), bool)
    new[1:] = signs[1:] != signs[:-1]
    least = sets[np.flatnonzero(new)][np.cumsum(new) - 1]
    links = np.unique(np.stack([sets, least], 1)[sets != least], axis=0)
    return signs[new], sets[new], links


def _send(percent: int, width: int, buckets: int, common: Broadcast):
    """Signatures to their buckets, packed, each once per slice; sets that share one here are linked at once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(percent)
        for batch in batches:
            for t in texts(batch.column(0)):
                grams, begin = ngram_sets(t, width)
                names = _sums(mix(grams ^ _SALTS[0]), begin).view(np.int64)
                signs, owners = scheme.sign(grams, begin, common.value)
                if not len(signs):
                    continue
                signs, sets, links = _group(signs, names[owners])
                rows = []
                if len(links):
                    rows.append((int(links[0, 0] % buckets), True, links[:, 0].tobytes(), links[:, 1].tobytes(), None))
                bucket = (mix(signs) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, signs, sets = bucket[order], signs[order], sets[order]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                    here, number = np.unique(sets[a:b], return_inverse=True)
                    rows.append((int(bucket[a]), False, signs[a:b].tobytes(), number.astype("<u4").tobytes(), here.tobytes()))
                kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)

    return send


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All signatures of a bucket are here: links between the sets of each. Links found before pass through."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["links"]:
                yield _links(np.frombuffer(row["left"], np.int64), np.frombuffer(row["right"], np.int64))
            else:
                found.append((np.frombuffer(row["left"], np.uint64), np.frombuffer(row["sets"], np.int64)[np.frombuffer(row["right"], "<u4")]))
    if found:
        signs, sets = (np.concatenate(c) for c in zip(*found, strict=True))
        found.clear()
        links = _group(signs, sets)[2]
        yield _links(links[:, 0], links[:, 1])


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


# --- products ------------------------------------------------------------------------------


def linked(sets: list[np.ndarray], percent: int, others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets are linked with each other, or with the ``others``: overlaps from products of incidence matrices, some columns at a time."""
    square = others is None
    both = sets if square else [*sets, *others]
    size = np.array([len(s) for s in both])
    n = len(sets)
    left, right = np.arange(n), np.arange(n) if square else np.arange(n, len(both))
    total = size[left][:, None] + size[right][None, :]
    # The overlap is the smaller set's size at most.
    possible = (100 + percent) * np.minimum(size[left][:, None], size[right][None, :]) >= percent * total
    if square:
        np.fill_diagonal(possible, False)
    row = np.repeat(np.arange(len(both)), size)
    order = np.argsort(np.concatenate(both), kind="stable")
    row, value = row[order], np.concatenate(both)[order]
    column = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]]))
    on_left = np.bincount(column, row < n)
    count = np.bincount(column)
    # Columns that no pair shares multiply to nothing.
    met = count > 1 if square else (on_left > 0) & (on_left < count)
    row, column = row[met[column]], (np.cumsum(met) - 1)[column[met[column]]]
    overlap = np.zeros(possible.shape, np.float32)
    wide = int(column[-1]) + 1 if len(column) else 0
    rest = np.bincount(row, minlength=len(both)).astype(np.float32)

    def incidence(rows: np.ndarray, columns: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        here = np.unique(rows)
        part = np.zeros((len(here), width), np.float32)
        part[np.searchsorted(here, rows), columns] = 1
        return here, part

    for begin in range(0, wide, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        rows, columns, width = row[a:b], column[a:b] - begin, min(COLUMNS, wide - begin)
        if square:
            (x, part) = (y, other) = incidence(rows, columns, width)
        else:
            x, part = incidence(rows[rows < n], columns[rows < n], width)
            y, other = incidence(rows[rows >= n], columns[rows >= n], width)
        overlap[np.ix_(x, y if square else y - n)] += part @ other.T
        rest -= np.bincount(rows, minlength=len(both))
        if begin + COLUMNS < wide:
            # Pairs that cannot reach their bound with all columns left are out; sets without a pair need no more products.
            possible &= (100 + percent) * (overlap + np.minimum(rest[left][:, None], rest[right][None, :])) >= percent * total
            alive = possible.any(axis=1)
            alive = alive | possible.any(axis=0) if square else np.concatenate([alive, possible.any(axis=0)])
            going = alive[row[b:]]
            row, column = np.concatenate([row[:b], row[b:][going]]), np.concatenate([column[:b], column[b:][going]])
    return possible & ((100 + percent) * overlap.astype(np.int64) >= percent * total)


def _products(percent: int):
    def products(frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, family in frame.groupby("family", sort=False):
            # Rows of one id may have several sets.
            family = family.drop_duplicates(["id", "set1", "row"]).sort_values("id", kind="stable")
            ids, row = family["id"].to_numpy(), family["row"].to_numpy(dtype=bool)
            sets = [np.frombuffer(g, np.uint64) for g in family["grams"]]
            if not row.any():
                matrix = linked(sets, percent) if len(ids) > 1 else np.zeros((1, 1), bool)
            else:
                x, y = np.flatnonzero(row), np.flatnonzero(~row)
                matrix = np.zeros((len(ids), len(ids)), bool)
                matrix[np.ix_(x, y)] = linked([sets[i] for i in x], percent, [sets[i] for i in y])
                matrix |= matrix.T
            out += [(ids[a], ids[b]) for a, b in spanning(matrix)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return products


def _grams(width: int):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                values, begin = ngram_sets(t, width)
                sets = pa.array([values[a:b].tobytes() for a, b in zip(begin, begin[1:], strict=False)], pa.binary())
                check = pa.array(_sums(mix(values ^ _SALTS[0]), begin).view(np.int64))
                id_, _, family, set1, of, block, row = (c.slice(t.rows.start, len(t)) for c in batch.columns)
                out = pa.RecordBatch.from_arrays([id_, family, set1, sets, of, block, row], ["id", "family", "set1", "grams", "of", "block", "row"])
                # Another row of the same id has another text.
                yield out.filter(pc.equal(check, set1))

    return grams


def _sets_of(docs: DataFrame, targets: DataFrame, width: int) -> DataFrame:
    """``targets`` with their n-grams. Written, so that later products of the same sets need not move the documents again."""
    # A broadcast of the targets would follow their number; both sides are sorted and merged at any size.
    rows = docs.join(targets.hint("merge"), "id").select("id", "text", "family", "set1", "of", "block", "row")
    return pin(rows.mapInArrow(_grams(width), "id long, family long, set1 long, grams binary, of long, block long, row boolean"))


def _multiplied(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that hold together what is linked in each group (``of``, ``block``) of sets."""
    return pin(sets.groupBy("of", "block").applyInPandas(_products(percent), "a long, b long"))


def links_within_families(docs: DataFrame, members: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) with the components of all links between members (id, set1, n, family).

    Small families are multiplied whole, many to a task. A large family is cut into
    blocks, by documents and by n-grams, each multiplied with itself and the family's first document. What hangs
    together then needs no more products within: only the documents
    outside the largest part so far meet all blocks, as the rows of products whose columns are a block. The sets are copied to
    each product; in so many rounds that the copies of one take about as much as the sets themselves, however large a family is.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = members.groupBy("family").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_GRAMS)).alias("blocks"), F.min("id").alias("first"))
    sized = pin(members.join(sizes, "family"))
    rows, grams = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(4 * tasks, -(-rows // BLOCK), -(-grams // BLOCK_GRAMS))
    columns = ["id", "set1", "family", "of", "block", "row"]
    own = F.when(F.col("blocks") == 1, F.expr(f"pmod(xxhash64(family), {buckets}L)")).otherwise(F.expr("pmod(xxhash64(id), blocks)"))
    of = F.when(F.col("blocks") == 1, F.lit(_NULL)).otherwise(F.col("family"))
    first = sized.where("blocks > 1 and id = first").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first = first.where(F.col("block") != own)
    targets = sized.withColumn("block", own).withColumn("of", of).unionByName(first.withColumn("of", F.col("family"))).withColumn("row", F.lit(False)).select(columns)
    sets = _sets_of(docs, targets, width)
    found = _multiplied(sets, percent)

    parts = components(found)
    large = sized.where("blocks > 1").join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    by_part = large.groupBy("family", "part").count().groupBy("family").agg(F.max_by("part", F.struct("count", "part")).alias("main"))
    large = pin(large.join(by_part, "family").withColumn("outside", F.col("part") != F.col("main")).drop("component", "main"))
    outside = large.where("outside").groupBy("family").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_GRAMS)).alias("rows"))
    if outside.isEmpty():
        return found
    both = large.join(outside, "family")

    def name(row: str, column: str) -> Column:
        return F.expr(f"{row} * blocks + {column}")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    at_row, at_column = F.expr("pmod(xxhash64(id, 2), rows)"), F.expr("pmod(xxhash64(id), blocks)")
    rows = both.where("outside").withColumn("r", at_row).withColumn("c", all_of("blocks"))
    cols = both.withColumn("c", at_column).withColumn("r", all_of("rows"))
    sides = rows.withColumn("row", F.lit(True)).unionByName(cols.withColumn("row", F.lit(False)))
    rounds = -(-sides.agg(F.sum("n")).first()[0] // max(grams, tasks * BLOCK_GRAMS // 4))
    # Each set is in its own block once; the family's first is in others, too.
    here = sets.where(F.col("of") != _NULL).select("id", "set1", "grams", F.col("block").alias("there"))
    targets = sides.withColumn("own", own).withColumn("block", name("r", "c")).withColumn("of", F.col("family")).select(*columns, "own")

    def met(k: int) -> DataFrame:
        now = targets.where(F.expr(f"pmod(xxhash64(of, block, 3), {rounds}L) = {k}"))
        return now.join(here, ["id", "set1"]).where("own = there").select(*columns, "grams")

    return reduce(DataFrame.unionByName, [_multiplied(met(k), percent) for k in range(rounds)], found)


def ngram_components(
    docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common_one_in: int | None = COMMON, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    A document is the set of its different n-grams of ``width`` words (white space
    ``[\\x20\\x09-\\x0D]``, A-Z lower-cased); with fewer words, the whole sequence is one.
    Two documents are linked if their intersection is at least ``percent`` / 100 of
    their union. Null text and text without words are linked with nothing.

    How: equal sets are one class. Each set signs its parts (``Scheme``), so that any
    two linked sets share a signature; sets that do form families. N-grams that one document in ``common_one_in`` or more
    has (if given) sign last or not at all, so that a passage of many documents makes no family of them. Within a family the
    overlaps are blocked products of the incidence matrix of documents and n-grams;
    pairs that cannot reach the bound their sizes set are discarded on
    the way. Only links that hold components together leave a task, never all
    pairs. N-grams are told by 64-bit hashes, sets by 128 bits.

    Each row is a document; rows that share an id are linked like others. A null id is the
    smallest. Other columns are not read; an empty table gives an empty result.
    """
    docs = docs.select(F.coalesce(plain(key).cast("long"), F.lit(_NULL)).alias("id"), plain(text).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    measured = pin(docs.mapInArrow(_measure(width), "id long, n long, set1 long, set2 long"))
    often = np.zeros(0, np.uint64) if common_one_in is None else _common(docs, width, measured.count(), common_one_in)
    common = docs.sparkSession.sparkContext.broadcast(often)
    # The signatures are many, so they are made on their way to the buckets and not written.
    sent = docs.select("text").mapInArrow(_send(percent, width, buckets, common), _PACKET)
    families = kept(docs.sparkSession, lambda: components(sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_meet, "a long, b long")))

    classes = measured.where("n > 0").groupBy("set1", "set2", "n").agg(F.min("id").alias("rep"))
    members = classes.join(families, F.col("set1") == F.col("node")).select(F.col("rep").alias("id"), "set1", "n", F.col("component").alias("family"))
    # The sets are as large as the texts, so they are not left to what follows.
    parts = kept(docs.sparkSession, lambda: components(links_within_families(docs, members, percent, width)))
    placed = classes.join(parts, F.col("rep") == F.col("node"), "left").select(
        F.col("set1").alias("s1"), F.col("set2").alias("s2"), F.col("n").alias("m"), F.coalesce("component", "rep").alias("component")
    )
    on = (F.col("set1") == F.col("s1")) & (F.col("set2") == F.col("s2")) & (F.col("n") == F.col("m"))
    return measured.join(placed, on, "left").select(
        F.nullif("id", F.lit(_NULL)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "id"), F.lit(_NULL)).alias("component_id"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one with the component's own id. Documents without words stay.

    Of rows equal in id and text one stays; rows that share an id but not the text stay together.
    """
    (id_name,) = unused(docs.columns, "__id")
    groups = ngram_components(docs, STAGE_PERCENT, STAGE_WIDTH).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(id_name)).distinct()
    return docs.join(groups, plain("doc_id").cast("long").eqNullSafe(F.col(id_name)), "left_semi").dropDuplicates(["doc_id", "text"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
with words as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents),
grams as (
    select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g
    from words),
sets as (select min(doc_id) as rep, g from (select doc_id, list_sort(g) as g from grams) group by g),
sized as (select rep, len(g) as n, g from sets where len(g) > 0),
units as (select rep, n, unnest(g) as gram from sized),
counted as (select rep, n, gram, count(*) over (partition by gram) as often from units),
ranked as (select rep, n, gram, row_number() over (partition by rep order by often, gram) as pos from counted where true),
prefix as (select rep, n, gram from ranked where pos <= n - (n * 90 + 99) // 100 + 1),
pairs as (
    select distinct a.rep as a, b.rep as b from prefix a join prefix b on a.gram = b.gram and a.rep < b.rep
    where 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
links as (
    select p.a, p.b from pairs p join sized x on p.a = x.rep join sized y on p.b = y.rep
    where 190 * len(list_intersect(x.g, y.g)) >= 90 * (x.n + y.n)),
twoway as (select a, b from links union all select b, a from links),
reach as (
    with recursive r(node, root) as (
        select rep, rep from sets union select twoway.b, r.root from r join twoway on r.node = twoway.a where r.root < twoway.b)
    select node, min(root) as root from r group by node)
select g.doc_id, len(g.g) as n_shingles, case when len(g.g) = 0 then g.doc_id else reach.root end as component_id
from (select doc_id, list_sort(g) as g from grams) g join sets on sets.g = g.g join reach on reach.node = sets.rep
"""
