import numpy as np
import pytest

from tallystar.llm import ngram_join
from tallystar.llm.ngram_join import Scheme, linked, ngram_components

from .common import WORD, awkward, documents

NULL = -(2**63)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def expected(rows, percent, width):
    sets = [grams(t, width) for _, t in rows]
    ids = [NULL if i is None else i for i, _ in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((ids[k], len(sets[k]), least[find(k)]) for k in range(len(rows)))


def found(df):
    return sorted((NULL if r.doc_id is None else r.doc_id, r.n_shingles, NULL if r.component_id is None else r.component_id) for r in df.collect())


def copies(rng, n, words, changes):
    base = [f"w{k}" for k in rng.integers(0, 500, words)]
    out = []
    for _ in range(n):
        text = list(base)
        for at in rng.integers(0, words, rng.integers(0, changes + 1)):
            text[at] = f"x{rng.integers(0, 9999)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5)])
def test_awkward_documents(spark, percent, width):
    assert found(ngram_components(documents(spark, awkward(), clashes=True), percent, width)) == expected(awkward(), percent, width)


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5)])
def test_near_copies(spark, percent, width):
    rng = np.random.default_rng(percent)
    texts = [t for words in (4, 9, 12, 20, 60, 150, 400) for t in copies(rng, 25, words, max(1, words // 20))]
    rows = list(enumerate(np.array(texts, object)[rng.permutation(len(texts))].tolist()))
    assert found(ngram_components(documents(spark, rows), percent, width)) == expected(rows, percent, width)


def test_a_common_passage(spark):
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} {t}" for words in (3, 9, 30, 120) for t in copies(rng, 12, words, max(1, words // 15))]
    texts += [f"{passage} " + " ".join(f"y{k}" for k in rng.integers(0, 10**6, n)) for n in rng.integers(0, 60, 60)]
    rows = list(enumerate(texts))
    for one_in in (None, 512, 3):
        assert found(ngram_components(documents(spark, rows), 80, 5, one_in)) == expected(rows, 80, 5)


def test_families_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = list(enumerate(copies(rng, 150, 80, 4) + copies(rng, 90, 50, 2)))
    assert found(ngram_components(documents(spark, rows))) == expected(rows, 90, 3)


def test_two_texts_of_one_id_in_a_family(spark):
    def text(**changed):
        words = [f"w{k}" for k in range(100)]
        for at, word in changed.items():
            words[int(at[1:])] = word
        return " ".join(words)

    # 2 is near only the first text of 5, and 3 only the second.
    rows = [(5, text()), (5, text(_50="x")), (2, text(_80="y")), (3, text(_50="x", _20="z"))]
    assert found(ngram_components(documents(spark, rows))) == expected(rows, 90, 3)
    assert found(ngram_components(documents(spark, rows[::-1]))) == expected(rows, 90, 3)


def test_no_documents(spark):
    assert ngram_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(0)
    scheme = Scheme(percent)
    for size in [*range(1, 130), 333, 1000]:
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        most = len(a) * (100 - percent) // 100
        b = np.unique(np.concatenate([a[: len(a) - most], rng.integers(0, 2**63, rng.integers(0, 2 + size * (100 - percent) // 100)).astype(np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) and set(a) != set(b):
            for common in (None, a[:: 2 + size % 7], a):
                signs, sets = scheme.sign(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), common)
                assert set(signs[sets == 0]) & set(signs[sets == 1]), size


def test_strangers_with_a_few_elements_in_common_hardly_share_a_signature():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 2000).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(pool, 150, False), rng.integers(0, 2**63, 2350).astype(np.uint64)])) for _ in range(80)]
    signs, owner = Scheme(80).sign(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))
    assert len(np.unique(np.stack([signs, owner.astype(np.uint64)], 1), axis=0)) - len(np.unique(signs)) <= 5  # 77 if all parts are signed


def test_copies_for_products_come_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 300)
    sent = []
    original = ngram_join._multiplied
    monkeypatch.setattr(ngram_join, "_multiplied", lambda sets, *a: sent.append(sets.selectExpr("sum(length(grams)) / 8").first()[0] or 0) or original(sets, *a))
    rng = np.random.default_rng(14)
    rows = list(enumerate(copies(rng, 60, 60, 12)))
    # Whatever shares a gram is one family here, most of it unlinked.
    monkeypatch.setattr(Scheme, "sign", lambda self, grams, begin, common=None: (grams, np.repeat(np.arange(len(begin) - 1), np.diff(begin))))
    assert found(ngram_components(documents(spark, rows))) == expected(rows, 90, 3)
    assert len(sent) > 3 and max(sent[1:]) < 3 * sent[0] < sum(sent[1:])


def test_products_agree_with_sets(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    out = linked(sets, 60)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert out[i, j] == (i != j and 100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b)))


def test_products_of_two_sides_agree_with_sets(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    out = linked(sets[:20], 60, sets[20:])
    assert out.shape == (20, 40) and out.any()
    for i, a in enumerate(sets[:20]):
        for j, b in enumerate(sets[20:]):
            assert out[i, j] == (100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b)))


def test_blocks_by_ngrams(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 500)
    rng = np.random.default_rng(4)
    rows = list(enumerate(copies(rng, 60, 80, 4) + copies(rng, 40, 50, 8)))
    assert found(ngram_components(documents(spark, rows))) == expected(rows, 90, 3)


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5)])
def test_strangers_with_one_passage_are_no_family(spark, monkeypatch, percent, width):
    sent = []
    original = ngram_join._multiplied
    monkeypatch.setattr(ngram_join, "_multiplied", lambda sets, *a: sent.append(sets.count()) or original(sets, *a))
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"y{k}" for k in rng.integers(0, 10**7, n)) + " " + passage) for i, n in enumerate(rng.integers(20, 300, 3000))]
    rows += [(3000 + i, t) for i, t in enumerate(copies(rng, 20, 100, 3))]
    assert found(ngram_components(documents(spark, rows), percent, width))[:3000] == sorted((i, len(grams(t, width)), i) for i, t in rows[:3000])
    assert sum(sent) <= 2 * len(rows)


def test_one_document_of_each_group_stays(spark):
    df = documents(spark, [(5, "a b c d e f g h"), (3, "A b c d e f g h"), (7, None), (8, ""), (9, "z"), (9, "z")], clashes=True)
    out = ngram_join.stage(spark, df, "")
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 7, 8, 9]
