"""Token ids of a byte-level BPE, encoding each different piece of a task's texts once."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from tallystar.llm.pieces import Pieces, flat, piece_starts
from tallystar.llm.spans import Texts, texts

def _byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class WordEncoder:
    """Encodes texts as ``tokenizers`` does with the same file, without special tokens added.

    ``path`` is a vocabulary of ``tokenizers`` whose ids are the ranks of its merges.
    Its words are handed to ``tiktoken``, which gives the same ids in less time. Texts that hold the string of
    a special token, which cuts them elsewhere, are encoded whole.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {x["content"]: x["id"] for x in content["added_tokens"]}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in word): i for word, i in content["model"]["vocab"].items() if word not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = [x.encode() for x in special]
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(w) for w in ranks]
        self.pieces = Pieces(self._learn)

    def _whole(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype(np.int32)

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that begin with a space before a word are encoded as one text, which is cut again by bytes; others alone."""
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        joined = np.frombuffer(b"".join(pieces), np.uint8)
        # Where a piece still begins if all of them are one text, it may follow others.
        begins = np.isin(bounds[:-1], piece_starts(Texts(slice(0, 1), joined, np.array([0, len(joined)]))))
        follows = begins & (joined[bounds[:-1]] == 0x20)
        sizes, order = np.diff(bounds), np.concatenate([np.flatnonzero(follows), np.flatnonzero(~follows)])
        together = int(follows.sum())
        parts = [self._whole(b"".join([pieces[i] for i in order[:together]]).decode())]
        ends = np.searchsorted(np.cumsum(self.lengths[parts[0]]), np.cumsum(sizes[order[:together]])) + 1
        parts += [self._whole(pieces[i].decode()) for i in order[together:]]
        lens, starts = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        lens[order] = np.concatenate([np.diff(ends, prepend=0), [len(x) for x in parts[1:]]])
        starts[order] = np.cumsum(lens[order]) - lens[order]
        return np.concatenate(parts)[flat(starts, lens)], lens

    def encode_texts(self, some: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one after the other, and where each text's begin (one more than texts)."""
        data = some.buf.tobytes()
        if not any(s in data for s in self.special):
            return self.pieces.encode(some)
        out = []
        for a, b in zip(some.bounds[:-1].tolist(), some.bounds[1:].tolist(), strict=True):
            if any(s in data[a:b] for s in self.special):
                out.append(self._whole(data[a:b].decode()))
            else:
                out.append(self.pieces.encode(Texts(slice(0, 1), some.buf[a:b], np.array([0, b - a])))[0])
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    def encode(self, values: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        for some in texts(pa.array(values, pa.large_string())):
            ids, begins = self.encode_texts(some)
            out += np.split(ids, begins[1:-1])
        return out
