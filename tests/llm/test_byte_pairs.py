import base64
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystar.llm.byte_pairs import Codec, decode, encode, query, read_ranks, round_trip
from tallystar.llm.pieces import piece_starts
from tallystar.llm.spans import texts
from tallystar.llm.tables import table

from .common import awkward, documents

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = [
    "", " ", "  ", "\n", " \n ", "a", " a", "a ", "a  b", "a   b \n c", "it's they'll I'D", "x y  z   w 　q", "a ’b “c”", "1234 56  7",
    "日本語 あい 日", "\U0001f600 \U0001f600\U0001f600", "=" * 700, "ab" * 400 + " tail", "\x1c\x1d x \x1fy", "<|endoftext|> a<|endoftext|>",
    "é café", "\r\n\r\n x\r\n", "\t\tif (x) {\n\t\t\treturn;\n", "".join(chr(c) for c in range(1, 300)), " ".join(chr(c) for c in range(0x2000, 0x2070)),
]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in read_ranks(PATH).splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


def test_ids_and_bytes_of_odd_texts(spark, ranks):
    docs = documents(spark, [*ODD, *ODD, None], clashes=True)
    encoded = encode(docs, ranks, public_tokenizers.PATTERN)
    own = reference()
    for row in decode(encoded, ranks, public_tokenizers.PATTERN).collect():
        text = ([*ODD, *ODD, None][row.doc_id]) or ""
        assert row.ids == own.encode_ordinary(text), text
        assert bytes(row.bytes) == text.encode()


def test_round_trip_of_awkward_documents(spark, ranks):
    rows = [(i, t) for i, t in awkward()]
    own = reference()

    def expected(i, t):
        ids = own.encode_ordinary(t or "")
        return i or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    found = round_trip(documents(spark, rows, clashes=True), ranks, public_tokenizers.PATTERN)
    assert sorted((r[0] or -1, *r[1:]) for r in found.collect()) == sorted(expected(i, t) for i, t in rows)
    assert round_trip(documents(spark, []), ranks, public_tokenizers.PATTERN).count() == 0


def test_all_documents(spark, folder, ranks):
    own = reference()
    found = {r.doc_id: r for r in query(spark, folder).collect()}
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(docs)
    for doc in docs:
        ids = own.encode_ordinary(doc.text)
        row = found[doc.doc_id]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


def test_long_words_follow_the_same_rule(ranks):
    codec = Codec(ranks, public_tokenizers.PATTERN)
    rng = np.random.default_rng(2)
    for alphabet in ("a", "ab", "theandingre", "0123456789abcdef"):
        for n in (2, 3, 17, 60, 200):
            word = "".join(rng.choice(list(alphabet), n)).encode()
            assert codec._contract([word])[0].tolist() == codec._contract_long(word).tolist()


def test_a_merge_may_open_a_lower_rank():
    # "bc" comes first, and the pair it forms with "a" has a lower rank than "bc" itself.
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"de", b"abcde"]
    ranks = b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens))
    codec = Codec(ranks, r"\S+|\s+")
    for word, ids in ((b"abcbc", [256, 257]), (b"abcde", [259]), (b"dede", [258, 258]), (b"abcdx", [256, 100, 120])):
        assert codec._contract([word])[0].tolist() == codec._contract_long(word).tolist()
        if word in tokens:
            assert codec._learn([word])[0].tolist() == ids
        else:
            assert codec._contract([word])[0].tolist() == ids


def test_unknown_ids_stop(ranks):
    with pytest.raises(ValueError):
        Codec(ranks, public_tokenizers.PATTERN).decode(np.array([99_999_999]), np.array([0, 1]))


def test_pieces_begin_at_spaces_before_words():
    some = next(texts(pa.array(["ab  cd e", " f", "g ", " h", "", None, "x  y"])))
    cut = [bytes(some.buf[a:b]).decode() for a, b in zip(piece_starts(some), [*piece_starts(some)[1:], len(some.buf)], strict=True)]
    assert cut == ["ab ", " cd", " e", " f", "g ", " h", "x  y"]
