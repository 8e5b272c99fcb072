"""A bidirectional LSTM, in numpy, that tells which blocks of a page are its main text."""

from __future__ import annotations

import random

import numpy as np

from tallystar.llm.html_blocks import Block, blocks
from tallystar.llm.spans import LOWER, Texts, hash_spans

PATH_DIMS, LEAF_DIMS, WORD_DIMS, PLAIN_DIMS = 160, 16, 32, 8
DIMS = PATH_DIMS + LEAF_DIMS + WORD_DIMS + PLAIN_DIMS
HIDDEN = 16
EPOCHS = 8
BATCH = 32
#: Blocks, with padding, that are labelled at once.
_AT_ONCE = 8192


# --- vectors of blocks -----------------------------------------------------------------------


def _hash_word(word: str) -> int:
    raw = np.frombuffer(word.encode() or b" ", np.uint8)
    return int(hash_spans(raw, np.zeros(1, np.int64), np.full(1, len(raw)))[0])


class Vectors:
    """Vectors of blocks; what is known of element paths is kept."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 100_000:
                self.paths.clear()
            out = np.zeros(PATH_DIMS + LEAF_DIMS, np.float32)
            for word in {w for element in path for w in element.split()}:
                h = self.words.setdefault(word, _hash_word(word))
                # Two places each, so that few names share both.
                out[h % PATH_DIMS] += 1
                out[(h >> 20) % PATH_DIMS] += 1 if h >> 60 & 1 else -1
            if path:
                out[PATH_DIMS + _hash_word(path[-1].split()[0]) % LEAF_DIMS] = 1
            self.paths[path] = out
        return self.paths[path]

    def __call__(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """One matrix per page."""
        flat = [b for page in pages for b in page]
        x = np.zeros((len(flat), DIMS), np.float32)
        if flat:
            raw = [b.text.encode() for b in flat]
            bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
            t = Texts(slice(0, len(raw)), np.frombuffer(b"".join(raw), np.uint8), bounds)
            starts, ends, first = t.words()
            hashes = hash_spans(LOWER[t.buf], starts, ends)
            block = np.repeat(np.arange(len(flat)), np.diff(first))
            bins = np.bincount(block * WORD_DIMS + (hashes & np.uint64(WORD_DIMS - 1)).astype(np.int64), minlength=len(flat) * WORD_DIMS)
            n_words = np.maximum(np.diff(first), 1)
            begin = PATH_DIMS + LEAF_DIMS
            x[:, begin : begin + WORD_DIMS] = np.sqrt(bins.reshape(len(flat), -1) / n_words[:, None])
            for i, b in enumerate(flat):
                x[i, :begin] = self._path(b.path)
            chars = np.array([len(b.text) for b in flat])
            points = np.array([b.text.count(".") + b.text.count(",") for b in flat])
            plain = x[:, begin + WORD_DIMS :]
            plain[:, 0] = np.log1p(chars) / 8
            plain[:, 1] = np.minimum(np.array([b.linked for b in flat]) / chars, 1)
            plain[:, 2] = np.minimum(points / n_words, 1)
            plain[:, 3] = np.minimum(n_words / 50, 2)
            plain[:, 4] = [len(b.path) / 10 for b in flat]
            plain[:, 5] = [b.text[-1] in ".!?:" for b in flat]
            at = 0
            for page in pages:
                n = len(page)
                plain[at : at + n, 6] = np.arange(n) / max(n, 1)
                at += n
            plain[:, 7] = 1
        cuts = np.cumsum([len(p) for p in pages])[:-1] if pages else []
        return np.split(x, cuts) if pages else []


# --- network ---------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction over steps x rows x dims; padding leaves the state as it is."""
    steps, rows, _ = x.shape
    h = c = np.zeros((rows, HIDDEN), np.float32)
    states, seen = np.zeros((steps, rows, HIDDEN), np.float32), []
    for t in range(steps):
        gates = x[t] @ w + h @ u + b
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        after = f * c + i * g
        tanh = np.tanh(after)
        if keep:
            seen.append((h, c, i, f, o, g, tanh, m))
        h = m * (o * tanh) + (1 - m) * h
        c = m * after + (1 - m) * c
        states[t] = h
    return states, seen


def _back(x: np.ndarray, seen: list, w: np.ndarray, u: np.ndarray, d_states: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of w, u and b."""
    dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(w.shape[1], np.float32)
    dh = dc = np.zeros_like(d_states[0])
    for t in range(len(seen) - 1, -1, -1):
        h, c, i, f, o, g, tanh, m = seen[t]
        dh = dh + d_states[t]
        here = dh * m
        after = dc * m + here * o * (1 - tanh * tanh)
        d_gates = np.hstack([after * g * i * (1 - i), after * c * f * (1 - f), here * tanh * o * (1 - o), after * i * (1 - g * g)])
        dw += x[t].T @ d_gates
        du += h.T @ d_gates
        db += d_gates.sum(axis=0)
        dh = dh * (1 - m) + d_gates @ u.T
        dc = dc * (1 - m) + after * f
    return dw, du, db


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps x rows x dims, the same backwards, and the mask."""
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), DIMS), np.float32)
    back, mask = np.zeros_like(x), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], back[: len(p), k], mask[: len(p), k] = p, p[::-1], 1
    return x, back, mask


def _turned(states: np.ndarray, lens: list[int]) -> np.ndarray:
    out = np.zeros_like(states)
    for k, n in enumerate(lens):
        out[:n, k] = states[:n, k][::-1]
    return out


class Labeller:
    """Probability that a block is main text, read forwards and backwards over the whole page."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {}
        for way in ("forth", "back"):
            self.p[f"w_{way}"], self.p[f"u_{way}"] = normal(DIMS, 4 * HIDDEN) * 0.5, normal(HIDDEN, 4 * HIDDEN)
            self.p[f"b_{way}"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"b_{way}"][HIDDEN : 2 * HIDDEN] = 1
        self.p["v"], self.p["skip"], self.p["a"] = normal(2 * HIDDEN, 1)[:, 0], np.zeros(DIMS, np.float32), np.zeros(1, np.float32)

    def _forward(self, pages: list[np.ndarray], keep: bool) -> tuple:
        x, back, mask = _padded(pages)
        lens = [len(p) for p in pages]
        p = self.p
        forth, seen_f = _run(x, mask, p["w_forth"], p["u_forth"], p["b_forth"], keep)
        turned, seen_b = _run(back, mask, p["w_back"], p["u_back"], p["b_back"], keep)
        both = np.concatenate([forth, _turned(turned, lens)], axis=2)
        return x, back, mask, lens, both, both @ p["v"] + x @ p["skip"] + p["a"], seen_f, seen_b

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page whether its blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and (end - begin + 1) * len(pages[order[end]]) <= _AT_ONCE:
                end += 1
            chosen = order[begin:end]
            logits = self._forward([pages[k] for k in chosen], False)[5]
            for row, k in enumerate(chosen):
                out[k] = logits[: len(pages[k]), row] > 0
            begin = end
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> Labeller:
        """Adam on the mean log loss of blocks."""
        rng = random.Random(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, order = 0, [k for k in range(len(pages)) if len(pages[k])]
        for epoch in range(epochs):
            rng.shuffle(order)
            for begin in range(0, len(order), BATCH):
                chosen = sorted(order[begin : begin + BATCH])
                x, back, mask, lens, both, logits, seen_f, seen_b = self._forward([pages[k] for k in chosen], True)
                y = np.zeros_like(mask)
                for row, k in enumerate(chosen):
                    y[: lens[row], row] = labels[k]
                d = ((_sigmoid(logits) - y) * mask / mask.sum()).astype(np.float32)
                d_both = d[:, :, None] * self.p["v"]
                grads = {"v": np.einsum("tb,tbh->h", d, both), "skip": np.einsum("tb,tbd->d", d, x), "a": d.sum(keepdims=True)[0]}
                sides = (("forth", x, seen_f, d_both[:, :, :HIDDEN]), ("back", back, seen_b, _turned(d_both[:, :, HIDDEN:], lens)))
                for way, inputs, seen, d_states in sides:
                    parts = _back(inputs, seen, self.p[f"w_{way}"], self.p[f"u_{way}"], d_states)
                    grads |= {f"{n}_{way}": g for n, g in zip("wub", parts, strict=True)}
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                for k, g in grads.items():
                    g = g / max(1.0, norm)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    now = rate * (0.3 if epoch >= epochs - 2 else 1)
                    self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


# --- pages to learn from -----------------------------------------------------------------------

_MAIN = "article content post entry main story body text page".split()
_ASIDE = {
    "menu": ("nav menu navbar navigation breadcrumb topbar pagination tabs links".split(), "Home About Contact News Archive Products Blog Help".split()),
    "header": ("header masthead banner top logo site branding".split(), "Welcome to our site The daily news".split()),
    "footer": ("footer bottom copyright legal colophon site info".split(), "© 2020 All rights reserved Privacy policy Terms Imprint".split()),
    "sidebar": ("sidebar side aside widget related recommended popular rail column trending more".split(), "Related stories Most read Popular Recommended for you See also".split()),
    "notice": ("notice cookie consent alert gdpr message warning popup modal overlay banner".split(), "We use cookies Accept By using this site you agree Notice".split()),
    "advert": ("ad ads advert advertisement sponsor sponsored promo promotion banner commercial".split(), "Advertisement Sponsored Buy now Sale Offer".split()),
    "form": ("form newsletter subscribe signup login search contact".split(), "Subscribe to our newsletter Your email Sign up Search Log in".split()),
    "comments": ("comments comment reply replies discussion disqus thread respond responses commentlist".split(), "Comments Reply says wrote Leave a comment Great post thanks".split()),
    "share": ("share social tags meta byline author toolbar sharing tools".split(), "Share Tweet Like Posted by Tags Print Email".split()),
}
_ELEMENTS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section"}


class Templates:
    """Made-up pages around given paragraphs, in many layouts, with the label of every block."""

    def __init__(self, paragraphs: list[str], seed: int = 5):
        self.paragraphs = paragraphs or [" ".join(f"word{i * k % 97}" for i in range(1, 12 + k)) + "." for k in range(1, 60)]
        self.rng = random.Random(seed)

    def _name(self, words: list[str]) -> str:
        rng = self.rng
        chosen = rng.sample(words, min(len(words), rng.choice([1, 1, 2])))
        name = rng.choice(["-", "_", " "]).join(chosen)
        if rng.random() < 0.3:
            name = rng.choice(["site", "box", "block", "wrapper", "js", "c", "inner", "section", "container"]) + rng.choice(["-", "_", " "]) + name
        return f'{rng.choice(["class", "class", "id"])}="{name}"'

    def _prose(self, most_words: int) -> str:
        words = self.rng.choice(self.paragraphs).split()
        begin = self.rng.randrange(max(1, len(words) - most_words))
        return " ".join(words[begin : begin + most_words])

    def _escape(self, text: str) -> str:
        return text.replace("&", "&amp;").replace("<", "&lt;")

    def _aside(self, kind: str) -> str:
        rng = self.rng
        names, phrases = _ASIDE[kind]
        n = rng.randint(1, 5)
        texts = [self._escape(self._prose(rng.randint(1, 30)) if rng.random() < 0.6 else " ".join(rng.sample(phrases, min(len(phrases), rng.randint(1, 5))))) for _ in range(n)]
        if kind == "comments" or kind == "sidebar" and rng.random() < 0.4:
            texts = [self._escape(self._prose(rng.randint(3, 80))) for _ in range(n)]
        if kind == "menu" or rng.random() < 0.3:
            inner = "<ul>" + "".join(f'<li><a href="/{i}">{t[:40]}</a></li>' for i, t in enumerate(texts)) + "</ul>"
        elif rng.random() < 0.3:
            inner = texts[0]
        else:
            inner = "".join(f"<{e}>{t}</{e}>" for t, e in ((t, rng.choice(["p", "div", "p", "h3", "span"])) for t in texts))
        if kind == "form" and rng.random() < 0.7:
            inner = f"<form action='/f'><label>{texts[0][:30]}</label><input name=a><button>Go</button><p>{texts[-1]}</p></form>"
        element, told = _ELEMENTS.get(kind), self._name(names)
        if element is None or rng.random() < 0.5:
            return f"<div {told}>{inner}</div>"
        return f"<{element}>{inner}</{element}>" if rng.random() < 0.5 else f"<{element} {told}>{inner}</{element}>"

    def _main(self) -> list[str]:
        rng = self.rng
        out = [f"<h1>{self._escape(self._prose(rng.randint(1, 10)))}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 12)):
            text = self._escape(self._prose(rng.choice([1, 2, 4, 8, 20, 40, 80, 150])))
            roll = rng.random()
            if roll < 0.06:
                out.append(f"<h2>{text[:60]}</h2>")
            elif roll < 0.12:
                out.append("<ul>" + "".join(f"<li>{self._escape(self._prose(rng.randint(1, 15)))}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
            elif roll < 0.16:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif roll < 0.2:
                out.append(f"<pre>{text}</pre>")
            elif roll < 0.23:
                out.append(f"<table><tr><td>{text[:40]}</td><td>{text[-40:]}</td></tr></table>")
            elif roll < 0.3:
                out.append(f"<p><b>{text}<br>")
            elif roll < 0.4:
                out.append(f'<p>{text} <a href="/x">{self._escape(self._prose(3))}</a></p>')
            else:
                out.append(f"<p>{text}</p>")
        return out

    def page(self) -> tuple[list[Block], np.ndarray]:
        """Blocks of a page and whether each is main text."""
        rng = self.rng
        kinds = list(_ASIDE)
        before = [self._aside(k) for k in rng.sample(kinds[:1] + kinds[1:2] + kinds[4:6] + kinds[8:], rng.randint(0, 3))]
        after = [self._aside(k) for k in rng.sample(["sidebar", "footer", "comments", "share", "advert", "form", "notice", "menu"], rng.randint(0, 5))]
        inner = self._main()
        marks = [True] * len(inner)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randint(0, len(inner))
            inner.insert(at, self._aside(rng.choice(["advert", "sidebar", "share", "form", "notice", "comments", "header", "menu"])))
            marks.insert(at, False)
        element = rng.choice(["article", "article", "main", "div", "div", "section", "div"])
        told = "" if element in ("article", "main") and rng.random() < 0.6 else " " + self._name(_MAIN)
        wrap = rng.choice([("", ""), ("", ""), ('<div class="wrapper">', "</div>"), ('<div id="page"><div class="container">', "</div></div>"), ("<main>", "</main>")])
        # A character that no page holds marks what is main text.
        mark = ""
        marked = "".join(f"{self._marked(x, mark)}" if m else x for x, m in zip(inner, marks, strict=True))
        body = "".join(before) + f"{wrap[0]}<{element}{told}>{marked}</{element}>" + (wrap[1] + "".join(after) if rng.random() < 0.5 else "".join(after) + wrap[1])
        out, labels = [], []
        for b in blocks(f"<html><head><title>t</title></head><body>{body}</body></html>"):
            text = b.text.replace(mark, "")
            if text.strip():
                out.append(Block(" ".join(text.split()), b.path, b.linked))
                labels.append(mark in b.text)
        return out, np.array(labels, bool)

    @staticmethod
    def _marked(piece: str, mark: str) -> str:
        """The mark before every run of text of a piece of markup."""
        out, inside = [], True
        for c in piece:
            if c == "<":
                inside = True
            elif inside and c != ">" and out and out[-1] == ">":
                out.append(mark)
                inside = False
            out.append(c)
        return "".join(out)


_WORDS_OF_ASIDES = frozenset(w for names, _ in _ASIDE.values() for w in names) - {"site", "top", "more", "message", "column", "thread", "section", "info", "links"}


def told_by_elements(page: list[Block]) -> np.ndarray | None:
    """Labels of a page that marks its text by article or main; None if it does not."""
    labels = []
    marked = False
    for b in page:
        inside = False
        for element in b.path:
            words = element.split()
            if words[0] in ("article", "main"):
                inside = marked = True
            elif words[0] in ("nav", "header", "footer", "aside", "form") or _WORDS_OF_ASIDES & set(words[1:]):
                inside = False
        labels.append(inside)
    return np.array(labels, bool) if marked else None


def train(pages: list[str], made: int = 1200, epochs: int = EPOCHS, seed: int = 3) -> Labeller:
    """A labeller taught by made-up layouts around the paragraphs of ``pages``, and by those of ``pages`` that mark their text."""
    read = [blocks(p) for p in pages]
    told = [(b, y) for b in read if (y := told_by_elements(b)) is not None]
    templates = Templates([x.text for b, y in told for x, t in zip(b, y, strict=True) if t and len(x.text) > 40][:5000], seed)
    lessons = [templates.page() for _ in range(made)] + told
    x = Vectors()([b for b, _ in lessons])
    return Labeller().fit(x, [y for _, y in lessons], epochs)
