import numpy as np
import pyarrow as pa
import pytest

from tallystar.llm import substring_dedup
from tallystar.llm.spans import mix
from tallystar.llm.substring_dedup import _K2, AFTER, BEFORE, _batch, _judge, name_pairs, name_runs, possible, remove_repeats, symbols

from .common import WORD, awkward, documents

NULL = -(2**63)


def expected(rows, width):
    seen, out = {}, []
    docs = sorted({(NULL if i is None else i, t) for i, t in rows}, key=lambda r: (r[0], r[1] or ""))
    assert len({i for i, t in docs if len(WORD.findall(t or "")) >= width}) == len([1 for _, t in docs if len(WORD.findall(t or "")) >= width])
    kept = {}
    for i, t in docs:
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            window = tuple(words[s : s + width])
            if seen.setdefault(window, (i, s)) != (i, s):
                gone[s : s + width] = [True] * width
        kept[i, t] = " ".join(w for w, g in zip(words, gone, strict=True) if not g), len(words), sum(gone)
    for i, t in rows:
        me = NULL if i is None else i
        out.append((me, *kept[me, t]))
    return sorted(out)


def found(df):
    return sorted((NULL if r.doc_id is None else r.doc_id, r.text, r["__n_words"], r["__n_removed"]) for r in df.collect())


@pytest.mark.parametrize("width", [10, 20])
def test_awkward_documents(spark, width):
    rows = [r for r in awkward() if r[0] != 8]
    assert found(remove_repeats(documents(spark, rows), width)) == expected(rows, width)


@pytest.mark.parametrize("words", [2, 3, 40])
def test_random_repeats(spark, words, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 300)
    rng = np.random.default_rng(words)
    passages = [" ".join(f"p{k}" for k in rng.integers(0, words, rng.integers(10, 60))) for _ in range(12)]
    rows = []
    for i in rng.permutation(120).tolist():
        parts = [passages[k] for k in rng.integers(0, len(passages), rng.integers(0, 3))]
        parts.insert(int(rng.integers(0, len(parts) + 1)), " ".join(f"u{k}" for k in rng.integers(0, 5000, rng.integers(0, 30))))
        rows.append((i, " \n".join(parts)))
    assert found(remove_repeats(documents(spark, rows), 20)) == expected(rows, 20)


def test_equal_rows_are_one_document(spark):
    text = " ".join(f"w{k}" for k in range(25))
    out = found(remove_repeats(documents(spark, [(4, text), (4, text), (9, text)])))
    assert [r[3] for r in out] == [0, 0, 25]


def test_no_documents_and_other_columns(spark):
    assert remove_repeats(documents(spark, [])).count() == 0
    rows = [r for r in awkward() if r[0] != 8]
    df = documents(spark, rows, clashes=True)
    out = remove_repeats(df)
    assert out.columns == [*df.columns, "__n_words", "__n_removed"]
    assert found(out) == expected(rows, 20)
    with pytest.raises(ValueError):
        remove_repeats(df, 5)


def test_symbols_depend_on_near_words_only():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = 40
        words = rng.integers(1, 4, n).astype(np.uint64)
        at = int(rng.integers(BEFORE, n - AFTER))
        other = rng.integers(1, 4, n).astype(np.uint64)
        other[at - BEFORE : at + AFTER + 1] = words[at - BEFORE : at + AFTER + 1]
        one, two = (dict(zip(*(x.tolist() for x in symbols(w, np.zeros(n, int))), strict=True)) for w in (words, other))
        assert one.get(at) == two.get(at)
        gaps = np.diff(sorted(one))
        assert gaps.max() <= 4


def test_windows_are_told_by_key_and_hash():
    # Keys and hashes of 48 bits whose mix(key) + hash * _K2 is one value of 64 bits.
    keys = np.arange(8, 1 << 21, dtype=np.uint64)
    other = np.uint64(5) + (mix(np.array([7], np.uint64)) - mix(keys)) * np.uint64(pow(int(_K2), -1, 1 << 64))
    hit = np.flatnonzero(other < 1 << 48)[0]

    def replies(key, hashed):
        words = lambda x, n, kind: b"".join(int(v).to_bytes(n, "little") for v in x) if kind is None else np.array(x, kind).tobytes()
        anchors = words(key, 6, None) + words([3, 3], 4, "<u4") + words([0, 1], 4, "<u4") + words([1, 1], 1, np.uint8)
        row = (0, False, words([1, 2], 8, np.int64), words([0, 0], 4, np.int32), anchors, words(hashed, 6, None) + words([2, 2], 1, np.uint8))
        return sum(b.num_rows for b in _judge(1)([_batch([row])]))

    assert replies([7, 7], [5, 5]) == 1
    assert replies([7, int(keys[hit])], [5, int(other[hit])]) == 0


def decided(words, text, level, lo, hi):
    """Symbols that words lo to hi decide: place among these, and name."""
    s = name_runs(words, text)
    for k in range(1, level + 1):
        s = name_pairs(s, k)
    return {(int(a) - lo, int(b) - lo, int(n)) for a, b, n in zip(s.lo, s.hi, s.name, strict=True) if a >= lo and b <= hi}


@pytest.mark.parametrize("kinds", [2, 3, 50])
def test_equal_passages_have_equal_symbols(kinds):
    rng = np.random.default_rng(kinds)
    found = [0] * 7
    for _ in range(200):
        n, width = 60, 24
        texts = []
        passage = rng.integers(1, kinds + 1, width).astype(np.uint64)
        for _ in range(2):
            words = rng.integers(1, kinds + 1, n).astype(np.uint64)
            at = int(rng.integers(0, n - width + 1))
            words[at : at + width] = passage
            # Some texts begin or end at the passage.
            text = np.zeros(n, np.int64)
            if rng.random() < 0.3:
                text[at:] = 1
            if rng.random() < 0.3:
                text[at + width :] = 2
            texts.append((words, text, at))
        for level in range(7):
            one, two = (decided(w, t, level, at, at + width) for w, t, at in texts)
            assert one == two
            found[level] += len(one)
    assert found[3] > 200 and found == sorted(found, reverse=True)


def test_only_shared_symbols_let_windows_through():
    rng = np.random.default_rng(8)
    n, width, levels = 4000, 20, (3, 5)
    words = rng.integers(1, 2000, n).astype(np.uint64)
    words[3000:3050] = words[100:150]
    words[2000:2060] = 7
    text = np.repeat(np.arange(4), 1000)
    told = {}
    for level in levels:
        names, twice = possible(words, text, width, told, levels, level)
        often = dict(zip(names.tolist(), twice.tolist(), strict=True))
        told[level] = lambda asked, often=often: np.array([often[x] for x in asked.tolist()], bool)
    live = possible(words, text, width, told, levels)
    seen = {}
    for i in range(n - width + 1):
        if text[i] == text[i + width - 1]:
            seen.setdefault(tuple(words[i : i + width].tolist()), []).append(i)
    repeated = {i for places in seen.values() if len(places) > 1 for i in places}
    assert len(repeated) > 90 and repeated <= set(np.flatnonzero(live).tolist())
    # Of 3,850 windows that occur once, only a few at the edges of what repeats are left.
    assert live.sum() < len(repeated) + 40
    # Without shared symbols nothing is found, but in the run, whose windows decide no symbol.
    none = possible(words, text, width, dict.fromkeys(levels, lambda asked: np.zeros(len(asked), bool)), levels)
    assert not none[:1990].any() and not none[2070:].any()


def test_the_result_comes_through_the_symbols(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "x " + text), (2, text + " y"), (3, " ".join(f"u{k}" for k in range(60)))]
    assert [r[3] for r in found(remove_repeats(documents(spark, rows)))] == [0, 60, 0]
    # If no symbol is shared, nothing goes.
    monkeypatch.setattr(substring_dedup, "_count", _once_each)
    assert [r[3] for r in found(remove_repeats(documents(spark, rows)))] == [0, 0, 0]


def _once_each(batches):
    for batch in batches:
        bits = [bytes(len(n)) for n in batch.column("names").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("slice", "part", "level", "bucket")), pa.array(bits, pa.binary())], ["slice", "part", "level", "bucket", "bits"])
