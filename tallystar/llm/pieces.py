"""Texts cut where no token reaches across, so that each different piece of a task is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tallystar.llm.spans import Texts

#: Different pieces kept; beyond that the memory of pieces starts anew.
MOST_PIECES = 600_000

# Bytes that may begin white space after a space: ASCII alone, others with their second byte.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WHITE_LEADS = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}


def piece_starts(texts: Texts) -> np.ndarray:
    """Where a text begins, or a space is followed by something other than white space.

    Patterns that allow a token one space in front and leave the last space of a run to the next token cut there in any
    case. Some characters that begin like white space are taken for it, which only makes a piece longer.
    """
    buf, bounds = texts.buf, texts.bounds
    first = np.unique(bounds[:-1][np.diff(bounds) > 0])
    if len(buf) < 2:
        return first
    at = np.flatnonzero(buf[:-1] == 0x20)
    after = buf[at + 1]
    cut = ~_WHITE[after]
    for lead, seconds in _WHITE_LEADS.items():
        some = np.flatnonzero(after == lead)
        cut[some] = ~np.isin(buf[np.minimum(at[some] + 2, len(buf) - 1)], seconds)
    begins = np.zeros(len(buf) + 1, bool)
    begins[first] = True
    cut &= ~begins[at + 1]
    begins[at[cut]] = True
    return np.flatnonzero(begins[:-1])


def flat(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ..`` of each span, one after the other."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)


class Memory:
    """Lists of ids by key, in one flat array."""

    def __init__(self):
        self.places: dict = {}
        self.starts, self.lens, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def put(self, keys: list, ids: np.ndarray, lens: np.ndarray) -> None:
        """New keys, the ids of all of them one after the other, and how many each has."""
        lens = lens.astype(np.int64)
        self.places.update(zip(keys, range(len(self.places), len(self.places) + len(keys)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def get(self, keys: list, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys (of the keys numbered ``at``, if given) one after the other, and how many each has."""
        places = np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))
        places = places if at is None else places[at]
        lens = self.lens[places]
        return self.ids[flat(self.starts[places], lens)], lens


class Pieces:
    """Ids of texts from the ids of their pieces, which ``learn`` gives for pieces not seen yet.

    ``learn`` takes a list of different pieces (bytes) and returns their ids, one after the other, and how many each has.
    """

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.learn, self.memory = learn, Memory()

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (one more than texts)."""
        if len(self.memory.places) > MOST_PIECES:
            self.memory = Memory()
        starts = piece_starts(texts)
        offsets = np.append(starts, len(texts.buf)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(texts.buf)])
        coded = column.dictionary_encode()
        different = coded.dictionary.to_pylist()
        new = [p for p in different if p not in self.memory.places]
        if new:
            self.memory.put(new, *self.learn(new))
        ids, lens = self.memory.get(different, coded.indices.to_numpy())
        return ids, np.concatenate([[0], np.cumsum(lens)])[np.searchsorted(starts, texts.bounds)]
