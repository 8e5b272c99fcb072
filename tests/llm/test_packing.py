import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallystar.llm.packing import Plan, non_negative_least_squares, pack, pack_documents, patterns, pieces, sequences
from tallystar.llm.tokens import WordEncoder
from tallystar.sources.scratch import pin

from .common import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.integers(1, 40), st.lists(st.integers(1, 40), max_size=200), st.integers(1, 50))
@settings(deadline=None, max_examples=150)
def test_a_plan_places_every_document_once(capacity, lengths, grains):
    lengths = np.array([x for x in lengths if x <= capacity], np.int64)
    hist = np.bincount(lengths, minlength=capacity + 1)
    plan = Plan(hist, capacity, grains)
    places = {}
    ranks = {}
    for length, rank, n, sequence, offset in zip(plan.length, plan.rank, plan.n, plan.sequence, plan.offset, strict=True):
        ranks.setdefault(length, []).extend(range(rank, rank + n))
        for k in range(n):
            places.setdefault(sequence + k, []).append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(hist[k])) for k in np.flatnonzero(hist)}
    for at in places.values():
        at.sort()
        assert [o for o, _ in at] == np.cumsum([0, *(x for _, x in at)])[:-1].tolist()
        assert sum(x for _, x in at) <= capacity
    assert len(places) == plan.n_sequences


def test_few_sequences():
    lengths = np.minimum(np.random.default_rng(0).lognormal(6, 1, 20_000).astype(int) + 1, 2048)
    assert Plan(np.bincount(lengths, minlength=2049)).n_sequences <= 1.005 * lengths.sum() / 2048


def test_non_negative_least_squares():
    rng = np.random.default_rng(0)
    a, x = rng.random((20, 12)), np.maximum(rng.standard_normal(12), 0)
    assert np.allclose(non_negative_least_squares(a, a @ x, 100), x, atol=1e-6)
    b = rng.standard_normal(20)
    got = non_negative_least_squares(a, b, 100)
    gain = a.T @ (b - a @ got)
    assert (got >= 0).all() and (gain <= 1e-6).all() and np.allclose(gain[got > 0], 0, atol=1e-6)


def test_patterns_fill_a_sequence():
    assert sorted(map(sorted, patterns(6))) == sorted(map(list, [(6,), (1, 5), (2, 4), (3, 3), (1, 1, 4), (1, 2, 3), (2, 2, 2)]))


@given(st.lists(st.lists(st.sampled_from(["a", "b", " ", " ", "\n", "\t", "é", ".", "'s", "1", "\x1c", "\x85", "<|endoftext|>", "́", "word", "\r", "日"]), max_size=12).map("".join), max_size=6))
@settings(deadline=None, max_examples=300)
def test_ids_are_those_of_tokenizers(values):
    for got, value in zip(ENCODER.encode(values), values, strict=True):
        assert got.tolist() == TOKENIZER.encode(value, add_special_tokens=False).ids


ENCODER, TOKENIZER = WordEncoder(PATH), Tokenizer.from_file(PATH)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_documents_round_trip(spark, capacity):
    rows = [(i, t if t is None else t[:4000]) for i, t in awkward()]
    df = documents(spark, rows, clashes=True)
    cut = pin(pieces(df, PATH, capacity, with_ids=True))
    placed = pin(pack(cut, capacity))
    whole = {r.sequence_id: r.ids for r in sequences(cut, placed).collect()}
    assert all(len(ids) <= capacity for ids in whole.values())
    got = {}
    for r in placed.collect():
        ids = whole[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        got.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
    assert sum(len(p) for p in got.values()) == cut.count()
    for i, text in rows:
        if [x for x, _ in rows].count(i) == 1:
            ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
            parts = sorted(got[i])
            assert [x for _, _, p in parts for x in p] == ids
            assert [s for _, s, _ in parts] == np.cumsum([0, *(len(p) for _, _, p in parts)])[:-1].tolist()
            assert all(len(p) == capacity for _, _, p in parts[1:])


def test_no_documents(spark):
    assert pack_documents(documents(spark, []), PATH).count() == 0
