"""Leaf blocks of raw HTML, with the path of elements above each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup, and those whose text nobody reads.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_SILENT = frozenset("script style textarea title iframe noembed noframes noscript template select option button svg canvas audio video object".split())
#: Elements that are blocks. All others, unknown ones too, stand within a line.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li listing main menu nav ol p plaintext pre search section summary table tbody td tfoot th thead tr ul xmp".split()
)
#: Elements that end at the start of another one, up to the element named last.
_CLOSED_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def _end_of_raw(page: str, name: str, at: int) -> int:
    found = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
    return found.start() if found else len(page)


def _named(tag: str, attributes: str) -> str:
    """Element name with the words of its class, id and role."""
    if "=" not in attributes:
        return tag
    words = [w.lower() for m in _NAMED.finditer(attributes) for w in _PARTS.findall(m[2] or m[3] or m[4] or "")]
    return " ".join([tag, *dict.fromkeys(words)])


def blocks(page: str) -> list[Block]:
    """The texts between block elements, decoded and with single spaces, in page order.

    Never fails: what does not close ends with its parent or the page, and a
    closing tag without an element is ignored. Scripts, styles, comments and form choices have no text and do not cut
    the line they stand in, nor do elements that are not known. Formulas in
    MathML keep their text, also what annotates them, in the block they stand in.
    """
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    silent = links = linked = 0
    open_count: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tuple(x for _, x in stack), linked))
        parts.clear()
        linked = 0

    def pop(name: str) -> None:
        nonlocal silent, links
        while stack:
            top, _ = stack.pop()
            open_count[top] -= 1
            silent -= top in _SILENT
            links -= top == "a"
            if top == name:
                return

    def outside(name: str) -> bool:
        """Whether the innermost element of that name is not within one without text."""
        last = max((i for i, (x, _) in enumerate(stack) if x == name), default=0)
        return not any(x in _SILENT for x, _ in stack[:last])

    def say(text: str) -> None:
        nonlocal linked
        if text and not silent:
            parts.append(text)
            linked += len(text) * (links > 0)

    at = 0
    while True:
        found = _TAG.search(page, at)
        say(page[at : found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        # What is inside an element without text does not cut the line that this stands in.
        block = name in _BLOCK and (not silent or bool(found[1]) and outside(name))
        if name.startswith("annotation") and open_count.get("math"):
            say(" ")
        if name == "br":
            say(" ")
        elif found[1]:
            if open_count.get(name):
                if block:
                    flush()
                pop(name)
        else:
            if block:
                flush()
                if open_count.get("p") and name not in _VOID:
                    pop("p")
            if name in _CLOSED_BY:
                other, within = _CLOSED_BY[name]
                for top, _ in reversed(stack):
                    if top in within:
                        break
                    if top in (name, other):
                        pop(top)
                        break
            if name in _VOID:
                continue
            stack.append((name, _named(name, found[3] or "")))
            open_count[name] = open_count.get(name, 0) + 1
            silent += name in _SILENT
            links += name == "a"
            if name in _RAW:
                end = _end_of_raw(page, name, at)
                say(page[at:end])
                at = end
    flush()
    return out
