import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tallystar.llm.spans import hash_spans, texts

from .common import WORD

ODD = st.text(alphabet="ab \n\t\x0b\x0c\r\x1c\x85  é日", max_size=12)


@given(st.lists(st.none() | ODD, max_size=8), st.integers(1, 40))
def test_words_and_lines_of_slices(values, most):
    words, lines = [], []
    for t in texts(pa.array(values, pa.string()), most):
        raw = t.buf.tobytes()
        for spans, out in ((t.words(), words), (t.lines(), lines)):
            starts, ends, first = spans
            assert len(first) == len(t) + 1
            out += [[raw[a:b].decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first, first[1:], strict=False)]
    assert words == [WORD.findall(v or "") for v in values]
    assert lines == [(v or "").split("\n") for v in values]


def test_slices_of_an_array_with_an_offset():
    column = pa.array(["x", "ab cd", None, "e"]).slice(1)
    assert [t.buf.tobytes() for t in texts(column, 1)] == [b"ab cd", b"e"]


def test_hashes_tell_long_words_apart():
    words = [b"a" * 64 + b"b" * 64, b"b" * 64 + b"a" * 64, b"ab", b"ba", b"a", b"aa"]
    ends = np.cumsum([len(w) for w in words])
    hashes = hash_spans(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
    assert len(set(hashes.tolist())) == len(words)
