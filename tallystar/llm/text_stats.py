"""Counts over whole texts, a slice of texts at a time."""

from __future__ import annotations

import numpy as np

from tallystar.llm.spans import SPACE, Texts, hash_spans, mix, owner

SYMBOLS = b"#*$%&|<>"
CHAR_CLASSES = ["lower", "upper", "digit", "space", "point", "symbol", "other_ascii", "two_bytes", "more_bytes"]

_CLASS = np.full(256, 6, np.int8)
_CLASS[0x61:0x7B] = 0
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[SPACE] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[list(SYMBOLS)] = 5
_CLASS[0xC0:0xE0] = 7
_CLASS[0xE0:] = 8
_CLASS[0x80:0xC0] = -1

_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of every three words in a row, from the words' hashes."""
    return mix(words[:-2] * _K1 + mix(words[1:-1] * _K2) + words[2:] * _K3)


def _per_text(marks: np.ndarray, t: Texts) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[t.bounds[1:]] - total[t.bounds[:-1]]


def char_classes(t: Texts) -> np.ndarray:
    """Code points of each class, per text."""
    kinds = _CLASS[t.buf]
    text = np.repeat(np.arange(len(t)), np.diff(t.bounds))
    seen = kinds >= 0
    n = len(CHAR_CLASSES)
    return np.bincount(text[seen] * n + kinds[seen], minlength=len(t) * n).reshape(len(t), n)


def base_counts(t: Texts, starts: np.ndarray, first: np.ndarray, words: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text.

    Equal lines and equal runs of three words are told by 64-bit hashes, within one text.
    """
    points = (t.buf & 0xC0) != 0x80
    filled = ~SPACE[t.buf]
    n = len(t)
    text = owner(first)

    line_from, line_to, line_first = t.lines()
    total = np.concatenate([[0], np.cumsum(filled)])
    some = total[line_to] > total[line_from]
    line_text = owner(line_first)[some]
    lines = hash_spans(t.buf, line_from[some], line_to[some])
    different = np.unique(mix(lines + line_text.astype(np.uint64) * _K2), return_index=True)[1]
    dup_lines = np.bincount(line_text, minlength=n) - np.bincount(line_text[different], minlength=n)

    repeated = np.zeros(len(words) + 2, bool)
    if len(words) > 2:
        same = np.flatnonzero(text[:-2] == text[2:])
        runs = mix(shingles(words)[same] + text[same].astype(np.uint64) * _K2)
        order = np.argsort(runs)
        ordered = runs[order]
        equal = ordered[1:] == ordered[:-1]
        found = np.zeros(len(runs), bool)
        found[order[1:][equal]] = True
        found[order[:-1][equal]] = True
        at = same[found]
        repeated[at] = repeated[at + 1] = repeated[at + 2] = True
    return {
        "n_words": np.diff(first),
        "word_chars": _per_text(points & filled, t),
        "n_symbols": _per_text(np.isin(t.buf, list(SYMBOLS)), t),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(text[repeated[: len(words)]], minlength=n),
    }
