"""Mixing, sharding, running totals and components."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallystar.llm.components import components, spanning
from tallystar.llm.mixing import Schedule, cycle, mix_sources, place, stage
from tallystar.llm.sharding import shard_by_bytes
from tallystar.llm.tables import running

from .common import awkward, documents


def test_running_totals(spark):
    rng = np.random.default_rng(0)
    rows = [(f"k{min(k, 3)}" if k else None, int(i), int(s)) for i, (k, s) in enumerate(zip(rng.integers(0, 20, 900), rng.integers(0, 9, 900), strict=True))]
    got = running(spark.createDataFrame(rows, "k string, i long, s long").repartition(7), "s", ["i"], ["k"]).collect()
    seen = defaultdict(lambda: [0, 0])
    want = {}
    for k, i, s in rows:
        want[i] = tuple(seen[k])
        seen[k][0] += 1
        seen[k][1] += s
    assert {r.i: (r["rank"], r["before"]) for r in got} == want


@pytest.mark.parametrize("rows", [awkward(), [], [(1, None)], [(i, "x" * (i % 7)) for i in range(500)]])
def test_shards(spark, rows):
    got = sorted(shard_by_bytes(documents(spark, rows, clashes=True)).collect(), key=lambda r: (r.shard, r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and len(got) == len(rows)
    assert sorted(r.text_crc32 for r in got) == sorted(zlib.crc32((t or "").encode()) for _, t in rows)
    sizes = defaultdict(int)
    for shard in range(8):
        mine = [r for r in got if r.shard == shard]
        assert [r.slot for r in mine] == list(range(len(mine)))
        sizes[shard] = sum(r.size for r in mine)
    if got:
        total, longest = sum(r.size for r in got), max(r.size for r in got)
        assert total == sum(len((t or "").encode()) + 1 for _, t in rows)
        assert all(abs(s - total / 8) <= longest for s in sizes.values())


def test_a_cycle_is_never_a_block_off():
    for shares in ({"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 700, "b": 200, "c": 99, "d": 1}, {f"s{k}": k + 1 for k in range(30)}):
        total, got = sum(shares.values()), defaultdict(int)
        for t, s in enumerate(cycle(shares), 1):
            got[s] += 1
            assert all(abs(got[x] - t * q / total) < 1 for x, q in shares.items())
        assert got == shares


def test_a_schedule_uses_every_slot_once():
    blocks = {"a": 100, "b": 1000, "c": 37, "d": 5000, "e": 1, "f": 0}
    weights = {"a": 1, "b": 2, "c": 0.5, "d": 3, "e": 0.01, "f": 1}
    schedule = Schedule(blocks, weights)
    slots = defaultdict(list)
    for s, n in blocks.items():
        if n:
            phase, slot = place(schedule.phases[s], np.arange(n))
            assert (np.diff(slot) > 0).all() and (np.diff(phase) >= 0).all()
            for p, t in zip(phase, slot, strict=True):
                slots[int(p)].append((int(t), s))
    order = [x for p in sorted(slots) for x in sorted(slots[p])]
    assert [t for t, _ in order] == list(range(sum(blocks.values())))
    with pytest.raises(ValueError):
        Schedule({"x": 1}, {})
    with pytest.raises(ValueError):
        Schedule({"x": 1}, {"x": 0})


@pytest.mark.parametrize(
    "weights, slots",
    [
        ({"s0": 5, "s1": 1, "s2": 2, "s3": 1, "": 3}, 120_000),
        ({"big": 0.999} | {f"s{k}": 0.001 / 99 for k in range(99)}, 30_000),
        ({"big": 0.874} | {f"s{k}": 0.126 / 999 for k in range(999)}, 30_000),
        ({f"s{k}": float(k + 2) ** 0.5 for k in range(7)}, 60_000),
    ],
)
def test_a_phase_never_strays_a_block_from_the_given_weights(weights, slots):
    total = sum(weights.values())
    blocks = {s: int(slots * w / total) + 2 for s, w in weights.items()}
    schedule = Schedule(blocks, weights)
    seen = 0
    for s, n in blocks.items():
        phase, slot = place(schedule.phases[s], np.arange(n))
        slot = slot[phase == 0]
        exact = slot * (weights[s] / total)
        i = np.arange(len(slot))
        # Before and after each own slot.
        assert (np.abs(i - exact) < 1 + 1e-6).all() and (np.abs(i + 1 - exact - weights[s] / total) < 1 + 1e-6).all()
        seen += len(slot)
    assert seen > 0.9 * slots


def test_documents_come_in_their_shares(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(0, 900))) for i in range(4000)]
    df = documents(spark, rows)
    weights = {"s0": 5, "s1": 1, "s2": 2, "s3": 1, "": 3}
    got = mix_sources(df, weights, block_bytes=2000).collect()
    assert sorted(r.doc_id for r in got) == [i for i, _ in rows]
    first = sorted((r.slot, r.position, r.source, r["size"]) for r in got if r.phase == 0)
    total = sum(x[3] for x in first)
    for s, w in weights.items():
        assert sum(x[3] for x in first if x[2] == s) / total == pytest.approx(w / sum(weights.values()), abs=0.02)


def test_awkward_documents_mixed(spark):
    df = documents(spark, awkward(), clashes=True)
    out = stage(spark, df, "")
    key = lambda r: tuple(str(x) for x in r)
    assert out.columns == df.columns and sorted(out.collect(), key=key) == sorted(df.collect(), key=key)
    assert mix_sources(documents(spark, [])).count() == 0


def test_components_of_random_links(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(-50, 150, (120, 2))] + [(500 + k, 501 + k) for k in range(40)] + [(900, 901 + k) for k in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for link in links if link[0] != link[1] for x in link}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_links_hold_components_together():
    m = np.zeros((6, 6), bool)
    for a, b in ((0, 2), (2, 4), (1, 5)):
        m[a, b] = m[b, a] = True
    assert sorted(spanning(m)) == [(0, 2), (0, 4), (1, 5)]
