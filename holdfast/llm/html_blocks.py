"""HTML as a sequence of text blocks, each with the path of elements above it."""

from __future__ import annotations

import html
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
LETTERS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"[0-9]")

#: Elements whose content is no text of the page.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe"}
HIDDEN = {"head", "select", "button", "svg", "object", "datalist", "canvas", "audio", "video"}
#: Elements that may stand in a head; any other, or text, ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Elements that, left open, hold nothing but the named ones.
LISTS = {"select": ("option", "optgroup"), "datalist": ("option", "optgroup")}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input",
    "math", "annotation", "annotation-xml", "maction", "menclose", "merror", "mfenced", "mfrac", "mi", "mlabeledtr",
    "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt",
    "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "none", "semantics",
}
#: An opening tag of these ends an open element of the named kinds.
ENDS = {"li": ("li", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p")}

#: Names and class words of elements that hold main text, and of what cannot be main text.
MAIN = {"article", "main"}
OTHER = {
    "nav", "footer", "aside", "form", "ad", "ads", "advert", "advertisement", "banner", "sidebar", "menu", "comment",
    "comments", "cookie", "notice", "related", "share", "social", "promo", "newsletter", "breadcrumb", "breadcrumbs",
    "login", "search", "widget", "sponsored", "popup", "modal", "toolbar", "reply", "respond",
}

PATH_SIZE, WORD_SIZE = 96, 24
#: Sizes and signs of a block itself, and its place among the others of the page.
OWN, PLACE = 9, 12
WIDTH = PATH_SIZE + WORD_SIZE + OWN + PLACE
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Coordinates of a path vector for each token.
TOKEN_PLACES = 4
#: How much of an element's parent stays in its path vector.
FADE = 0.75


@dataclass
class Element:
    name: str
    vector: np.ndarray
    hidden: bool
    keep: bool | None
    #: What the innermost telling element says: main text, other text, or nothing.
    semantic: bool | None = None
    #: Number of the element on its page, and of its place: like elements in like places share it.
    number: int = 0
    place: int = 0


@dataclass
class Block:
    text: str
    path: np.ndarray
    semantic: bool | None
    linked: int
    keep: bool | None
    name: str = ""
    #: Numbers of the block's element and of the one around it, and of their places.
    inside: tuple[int, int, int, int] = (0, 0, 0, 0)


def hashed(token: str) -> Iterator[tuple[int, float]]:
    """The coordinates of a path vector that a token adds to: several, so that no unknown word passes for a known one."""
    raw = token.encode("utf-8", "surrogatepass")
    for salt in range(TOKEN_PLACES):
        code = zlib.crc32(raw, salt)
        yield code % PATH_SIZE, 1.0 if code >> 31 else -1.0


def closed(page: str, name: str) -> set[int]:
    """Where elements of that name start that have an end tag."""
    starts, found = [], set()
    for tag in re.finditer(f"<(/?){re.escape(name)}(?=[\\s/>])", page, re.I):
        if not tag[1]:
            starts.append(tag.start())
        elif starts:
            found.add(starts.pop())
    return found


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order: runs of text between the borders of block elements.

    A hidden element without an end tag hides nothing, but for the options of a list: what follows
    may be text of the page. A head ends where something stands that cannot be in one. Time is linear in the page,
    whatever its depth: an end tag is looked for only where its element is open, and what it passes is closed.
    """
    root = Element("", np.zeros(PATH_SIZE), False, None)
    stack, out, known = [root], [], {}
    opened: Counter[str] = Counter()
    numbers = itertools.count(1)
    text: list[str] = []
    linked, links, at = 0, 0, 0
    ended: dict[str, set[int]] = {}
    open_list = ""  # a list without an end tag that is open

    def flush() -> None:
        nonlocal linked
        words = html.unescape("".join(text)).split() if text else ()
        if words:
            top = stack[-1]
            around = stack[-2] if len(stack) > 1 else top
            inside = (top.number, around.number, top.place, around.place)
            out.append(Block(" ".join(words), top.vector, top.semantic, linked, top.keep, top.name, inside))
        text.clear()
        linked = 0

    def push(name: str, attributes: str) -> None:
        top = stack[-1]
        given = {}
        if "=" in attributes:
            given = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        described = " ".join(given.get(k, "") for k in ("class", "id", "role")).lower()
        tokens = (name, *LETTERS.findall(described)) if described else (name,)
        place = (id(top.vector), tokens)
        if place not in known:
            vector = top.vector * FADE
            for token in tokens:
                for i, sign in hashed(token):
                    vector[i] += sign / 2
            semantic = top.semantic
            for token in tokens:
                semantic = True if token in MAIN else False if token in OTHER else semantic
            known[place] = (vector, semantic, len(known) + 1)
        vector, semantic, like = known[place]
        keep = given["data-keep"] == "1" if "data-keep" in given else top.keep
        stack.append(Element(name, vector, top.hidden or name in HIDDEN, keep, semantic, next(numbers), like))
        opened[name] += 1

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    def close(names: tuple[str, ...]) -> None:
        if any(opened[name] for name in names):
            while pop() not in names:
                pass

    for found in TAG.finditer(page):
        start, end = found.span()
        if start < at:
            continue
        if start > at and stack[-1].name == "head" and not page[at:start].isspace():
            pop()
        if start > at and not stack[-1].hidden:
            piece = page[at:start]
            text.append(piece)
            if links:
                linked += len(piece)
        at = end
        name = found[2] or found[5]
        if name is None:
            continue
        name, closing = name.lower(), found[1] or found[4]
        if stack[-1].name == "head" and not closing and name not in IN_HEAD:
            pop()
        if name not in INLINE:
            if name == "br":
                text.append(" ")
                continue
            if closing and name not in VOID:
                flush()
                close((name,))
                links = 0
                continue
            flush()
            if name in RAW:
                finish = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
                at = finish.end() if finish else len(page)
                continue
            if name == "xmp":  # its content is text as it stands
                finish = re.compile(r"</xmp\s*>", re.I).search(page, at)
                close(("p",))
                links = 0
                push(name, found[3] or found[6] or "")
                if not stack[-1].hidden:
                    text.append(html.escape(page[at : finish.start() if finish else len(page)]))
                    flush()
                pop()
                at = finish.end() if finish else len(page)
                continue
            if name not in VOID:
                if open_list and name not in LISTS[open_list]:
                    close((open_list,))
                    open_list = ""
                if name in HIDDEN and name != "head":
                    if name not in ended:
                        ended[name] = closed(page, name)
                    if start not in ended[name]:
                        if name not in LISTS:
                            continue
                        open_list = name
                if stack[-1].name not in ("", "div", "body"):
                    close(ENDS.get(name, ("p",)))
                    links = 0
                push(name, found[3] or found[6] or "")
        elif name == "a":
            links = max(0, links - 1) if closing else links + 1
    if at < len(page) and stack[-1].name == "head" and not page[at:].isspace():
        pop()
    if at < len(page) and not stack[-1].hidden:
        text.append(page[at:])
    flush()
    return out


def features(page: list[Block]) -> np.ndarray:
    """(blocks, WIDTH): path, hashed words, sizes and place on the page."""
    rows = np.zeros((len(page), WIDTH))
    for row, block in zip(rows, page):
        words = block.text.split(" ")
        row[:PATH_SIZE] = block.path
        raw = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
        counted = np.bincount(raw % WORD_SIZE, weights=np.where(raw >> 31, 1.0, -1.0), minlength=WORD_SIZE)
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = counted / np.sqrt(len(words))
        size = len(block.text)
        stops = sum(map(block.text.count, ".,;:!?"))
        row[PATH_SIZE + WORD_SIZE : -PLACE] = (
            np.log1p(size) / 5,
            np.log1p(len(words)) / 4,
            min(1.0, block.linked / size),
            stops / len(words),
            size / len(words) / 10,
            block.text[-1] in ".!?:",
            len(DIGITS.findall(block.text)) / size,
            block.name in HEADINGS,
            block.name == "h1",
        )
    if page:
        rows[:, -PLACE:] = places(page)
    return rows


def places(page: list[Block]) -> np.ndarray:
    """(blocks, PLACE): where blocks stand on the page, and how much of it stands with them."""
    n = len(page)
    sizes = np.array([len(block.text) for block in page], dtype=float)
    inside = np.array([block.inside for block in page])
    at = np.arange(n)
    out = np.zeros((n, PLACE))
    out[:, 0] = at / max(1, n - 1)
    out[:, 1] = np.log1p(at) / 4
    for k in range(4):  # the element, the one around it, and all in the same places
        out[:, 2 + k] = np.bincount(inside[:, k], weights=sizes)[inside[:, k]] / sizes.sum()
    for k in range(2):  # How many elements are in that place: remarks and links repeat, the main text does not.
        place_of = np.full(inside[:, k].max() + 1, -1)
        place_of[inside[:, k]] = inside[:, 2 + k]
        out[:, 6 + k] = np.log1p(np.bincount(place_of[place_of >= 0])[inside[:, 2 + k]]) / 3
    out[1:, 8] = inside[1:, 1] == inside[:-1, 1]
    out[:-1, 9] = out[1:, 8]
    out[1:, 10] = inside[1:, 2] == inside[:-1, 2]
    out[:, 11] = np.log1p(sizes.sum()) / 8
    return out
