"""Near-duplicate vectors: int8 products of all tiles, full precision where the error bound asks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.components import components, spanning
from tallystar.llm.tables import plain, table
from tallystar.sources.scratch import pin

LEAST_COSINE = 0.9
#: Layout, not limits: vectors of a block, dimensions summed exactly in single precision, pairs computed at once.
BLOCK = 4096
_EXACT_DIMS = 1024
_STRIPE = 256
_PAIRS = 1 << 17
#: More than double precision can err in a cosine and its bound.
_ROUNDING = 1e-9
_NULL = -(2**63)


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors of the rows, their scales, and the lengths of what the codes miss."""
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of int8 codes: single precision holds the sums of 1024 dimensions."""
    parts = (a[:, k : k + _EXACT_DIMS].astype(np.float32) @ b[:, k : k + _EXACT_DIMS].astype(np.float32).T for k in range(0, a.shape[1], _EXACT_DIMS))
    total = next(parts)
    for part in parts:
        total = total.astype(np.float64) + part
    return total


def judged_pairs(a: tuple, b: tuple, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that may have a cosine of at least ``least``, and whether they surely have, from (codes, scales, errors) of both sides.

    With unit vectors u = s q + r, the cosine differs from s s' (q . q') by at most
    |r| |u'| + |r'| |u| + |r| |r'|. Given stripe by stripe of the first side.
    """
    (qa, sa, ea), (qb, sb, eb) = a, b
    if not len(qa) or not len(qb):
        return
    most = ea.max() + eb + ea.max() * eb + 1e-5
    for k in range(0, len(qa), _STRIPE):
        products = code_products(qa[k : k + _STRIPE], qb)
        scaled = products * sa[k : k + _STRIPE, None].astype(products.dtype)
        rows, columns = np.nonzero(scaled >= ((least - most) / sb).astype(products.dtype)[None, :])
        about = products[rows, columns].astype(np.float64)
        rows += k
        about *= sa[rows] * sb[columns]
        bound = ea[rows] + eb[columns] + ea[rows] * eb[columns] + _ROUNDING
        some = about >= least - bound
        yield rows[some], columns[some], (about >= least + bound)[some]


def confirmed(va: np.ndarray, vb: np.ndarray, rows: np.ndarray, columns: np.ndarray, least: float) -> np.ndarray:
    """Whether pairs of rows have a cosine of at least ``least`` in double precision."""
    na, nb = np.linalg.norm(va, axis=1), np.linalg.norm(vb, axis=1)
    keep = np.zeros(len(rows), bool)
    for k in range(0, len(rows), _PAIRS):
        r, c = rows[k : k + _PAIRS], columns[k : k + _PAIRS]
        keep[k : k + _PAIRS] = np.einsum("ij,ij->i", va[r], vb[c]) / (na[r] * nb[c]) >= least
    return keep


_CODED = "h1 long, h2 long, id long, weight long, vector array<double>, dim int, codes binary, scale double, error double"


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(4)
        dims = np.diff(lists.offsets.to_numpy())
        values, begin = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(dims)])
        codes, scales, errors = [b""] * len(dims), np.zeros(len(dims)), np.zeros(len(dims))
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            q, scales[at], errors[at] = quantise(values[begin[at][:, None] + np.arange(d)])
            for i, row in zip(at, q, strict=True):
                codes[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(dims.astype(np.int32)), pa.array(codes, pa.binary()), pa.array(scales), pa.array(errors)],
            ["h1", "h2", "id", "weight", "vector", "dim", "codes", "scale", "error"],
        )


#: What a tile returns: links (a, b), sums of links (of h1, h2), or vectors (h1, h2 of a block) whose full precision it asks for.
_FOUND = "a long, b long, h1 long, h2 long, degree long, dim int, i int, j int, block int"
_FOUND_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.int32()) for c in _FOUND.split(", ")])


def _tile(least: float, full: bool):
    """Links of a tile: those the bounds ensure and the vectors of open pairs, or, with their full precision, the links among open pairs."""

    def tile(group: pa.Table) -> pa.Table:
        dim, i, j = (group.column(c)[0].as_py() for c in ("dim", "i", "j"))
        block = group.column("block").to_numpy()
        ids, weights, h1, h2 = (group.column(c).to_numpy() for c in ("id", "weight", "h1", "h2"))
        q = np.frombuffer(b"".join(group.column("codes").to_pylist()), np.int8).reshape(-1, dim)
        s, e = group.column("scale").to_numpy(), group.column("error").to_numpy()
        first, last = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if full:
            v = pc.list_flatten(group.column("vector")).to_numpy().astype(np.float64).reshape(-1, dim)
            va, vb = v[first], v[last]
        linked = np.zeros((len(first), len(last)), bool)
        degree, open_ = np.zeros(len(ids)), np.zeros(len(ids), bool)
        for rows, columns, sure in judged_pairs(*((q[x], s[x], e[x]) for x in (first, last)), least):
            if i == j:
                apart = rows != columns
                rows, columns, sure = rows[apart], columns[apart], sure[apart]
            if full:
                rows, columns = rows[~sure], columns[~sure]
                sure = confirmed(va, vb, rows, columns, least)
            else:
                open_[first[rows[~sure]]] = open_[last[columns[~sure]]] = True
            rows, columns = rows[sure], columns[sure]
            linked[rows, columns] = True
            degree += np.bincount(first[rows], weights[last[columns]], len(ids))
            if i != j:
                degree += np.bincount(last[columns], weights[first[rows]], len(ids))
        # The links that hold the components of the tile together, among the rows that have links.
        x, y = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if i == j:
            nodes, matrix = first[x], linked[np.ix_(x, x)]
        else:
            nodes, matrix = np.concatenate([first[x], last[y]]), np.zeros((len(x) + len(y),) * 2, bool)
            matrix[: len(x), len(x) :] = linked[np.ix_(x, y)]
            matrix |= matrix.T
        held = nodes[np.array(spanning(matrix), np.int64).reshape(-1, 2)]
        some, asked = np.flatnonzero(degree), np.flatnonzero(open_)
        tile_ = [pa.array(np.full(len(asked), k, np.int32)) for k in (dim, i, j)]
        parts = [
            {"a": ids[held[:, 0]], "b": ids[held[:, 1]]},
            {"h1": h1[some], "h2": h2[some], "degree": degree[some].astype(np.int64)},
            {"h1": h1[asked], "h2": h2[asked], "dim": tile_[0], "i": tile_[1], "j": tile_[2], "block": block[asked].astype(np.int32)},
        ]
        lens = [len(held), len(some), len(asked)]
        return pa.concat_tables(
            pa.Table.from_arrays([pa.array(p[f.name], f.type) if f.name in p else pa.nulls(n, f.type) for f in _FOUND_ARROW], schema=_FOUND_ARROW)
            for p, n in zip(parts, lens, strict=True)
        )

    return tile


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector its number of links, its component and whether it is the one kept.

    Two vectors of one dimension are linked if their cosine in double precision is
    at least ``least`` (over 0). Null and zero vectors and those with null or non-finite
    components are linked with nothing. ``n_links`` counts all other linked rows,
    ``component_id`` is the smallest id reachable.

    How: equal vectors are one with a weight, so copies are not expanded. The different
    vectors are cut into blocks of bounded size, and every pair of blocks is
    one task's product of int8 codes, which is all that is sent to it. Pairs whose error bounds lie on one side of ``least`` are
    settled there; for the vectors of the others full precision is fetched, tile by tile, and these pairs are
    computed in it. A tile returns sums of links and the few links that hold its components together,
    never its pairs. All pairs are looked at, so the work grows with the square of the number of
    different vectors.

    Rows that share an id are different vectors. A null id is the smallest. Other
    columns are not read; an empty table gives an empty result.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies above 0 and is at most 1")
    given = vectors.select(F.coalesce(plain(key).cast("long"), F.lit(_NULL)).alias("id"), plain(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    given = given.select("id", F.when(usable, F.col("vector")).alias("vector"))
    marked = pin(given.withColumn("h1", F.xxhash64("vector", F.lit(1))).withColumn("h2", F.xxhash64(F.lit(2), "vector")))
    classes = marked.where("vector is not null").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    coded = pin(classes.mapInArrow(_code, _CODED))
    blocks = max(1, -(-coded.count() // BLOCK))
    mine = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    tiles = (
        coded.drop("vector")
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )
    settled = pin(tiles.groupBy("dim", "i", "j").applyInArrow(_tile(least, False), _FOUND))
    asked = settled.where("block is not null").select("dim", "i", "j", "block", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    fetched = asked.join(coded.drop("dim"), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).drop("k1", "k2")
    found = pin(settled.where("block is null").unionByName(fetched.groupBy("dim", "i", "j").applyInArrow(_tile(least, True), _FOUND)))
    parts = components(found.where("b is not null").select("a", "b"))
    degrees = found.where("b is null").groupBy(F.col("h1").alias("k1"), F.col("h2").alias("k2")).agg(F.sum("degree").alias("degree"))
    placed = (
        coded.select("h1", "h2", "id", "weight")
        .join(degrees, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
        .drop("k1", "k2")
        .join(parts, F.col("id") == parts["node"], "left")
        .select(
            F.col("h1").alias("k1"),
            F.col("h2").alias("k2"),
            (F.coalesce("degree", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "id").alias("part"),
        )
    )
    on = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & F.col("vector").isNotNull()
    component = F.coalesce("part", "id")
    return marked.join(placed, on, "left").select(
        F.nullif("id", F.lit(_NULL)).alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(_NULL)).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
with vectors as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.9),
reach as (
    with recursive r(node, root) as (
        select vec_id, vec_id from embeddings union select links.b, r.root from r join links on r.node = links.a where r.root < links.b)
    select node, min(root) as root from r group by node)
select e.vec_id, coalesce(d.n, 0) as n_links, reach.root as component_id, e.vec_id = reach.root as kept
from embeddings e join reach on reach.node = e.vec_id
left join (select a, count(*) as n from links group by a) d on d.a = e.vec_id
"""
