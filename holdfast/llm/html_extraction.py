"""Main text of web pages by a recurrent labeller of blocks.

A page is read as its sequence of text blocks (see `html_blocks`). A bidirectional LSTM in numpy reads the
tag-path and hashed-word vectors of all blocks of a page, and labels each block as main text or
not, with the whole page as context. Blocks labelled main are joined by line feeds.

The labeller is trained on a bounded sample, at most `PAGES` pages (those whose ids and content hash lowest) and of
each the first blocks, up to about `PAGE_SIZE` characters of text. Their own labels come from semantic elements (article, main, and what cannot be
main text within). As pages of one corpus may share one layout, the same texts are also laid out in
others: by the lists of wrappers below, and on pages whose elements and class names are any, where only the structure
tells: order, sizes, links, headings, what repeats, and how much of the page stands together.

Where no page of the sample has a block longer than `LONG` characters there is nothing to learn from, and
the semantic elements alone tell the main text.

Null and empty pages give the empty text, as do pages without main text. Rows without a page_id and
repeated rows are extracted like others. An empty table gives an empty one. Other columns are kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass, replace
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import lowest_hashes, map_batches
from holdfast.llm.html_blocks import WIDTH, Block, blocks, features
from holdfast.llm.recurrent import Adam, both_gradients, both_ways, sigmoid

PAGES, PAGE_SIZE = 300, 60_000
#: Characters that each block of the sample counts for besides its text.
BLOCK_SIZE = 64
#: Blocks that are longer make the pages that are laid out anew.
LONG = 40
LAYOUTS, STEPS, ROWS = 2400, 1200, 16
HIDDEN = 16
SEED = 42
#: Blocks (with padding) that are labelled at once.
CELLS = 1 << 16

#: Wrappers of main text, and of everything else, for the pages that are laid out anew.
MAIN_WRAPPERS = (
    "article", "main", "article class='post'", "div class='content'", "div id='content'", "div class='post-body'",
    "div class='entry-content'", "section class='story'", "div class='article-text'", "div id='main'",
    "section", "td", "td class='main'", "div class='text'", "div itemprop='articleBody'", "main id='page'", "div", "div class='page-content'",
)
OTHER_WRAPPERS = (
    "nav", "header", "footer", "aside", "form", "div class='ad'", "div class='ads banner'", "div class='advertisement'",
    "div class='sidebar'", "div id='sidebar'", "div class='menu'", "ul class='menu'", "div class='nav'",
    "div class='header'", "div id='header'", "div class='footer'", "div id='footer'", "section class='comments'",
    "div class='comment'", "div id='comments'", "ol class='comment-list'", "div class='cookie-notice'",
    "div class='notice'", "div class='alert'", "div class='related'", "div class='share social'",
    "div class='promo'", "div class='newsletter'", "div class='breadcrumbs'", "div class='login'",
    "form class='search'", "div class='widget'", "div class='sponsored'", "div class='popup modal'",
    "div role='navigation'", "div role='complementary'", "section class='reader-comments'", "div class='copyright'",
    "div class='toolbar'", "div class='subscribe'", "div class='site-header'", "div class='site-footer'",
    "div class='user-comments'", "div class='user-reviews'", "div class='reviews'", "div class='message'",
    "div class='warning'", "div class='reply'", "section class='sidebar'", "div class='gdpr consent'",
)
AROUND = ("", "div", "div class='container'", "div id='wrapper'", "div class='row'", "div class='page'", "div id='layout'")


@dataclass
class Labeller:
    values: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = SEED) -> Labeller:
        random = np.random.default_rng(seed)
        values = {
            "forward": random.standard_normal((WIDTH, 4 * HIDDEN)) * 0.2,
            "backward": random.standard_normal((WIDTH, 4 * HIDDEN)) * 0.2,
            "weights_0": random.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2,
            "weights_1": random.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2,
            "gates": np.zeros(8 * HIDDEN),
            "out": random.standard_normal(2 * HIDDEN + WIDTH) * 0.1,
            "bias": np.zeros(1),
        }
        values["gates"][HIDDEN : 2 * HIDDEN] = values["gates"][5 * HIDDEN : 6 * HIDDEN] = 1  # remember at first
        return cls(values)

    def _forward(self, rows: np.ndarray, mask: np.ndarray):
        v = self.values
        weights = [v["weights_0"], v["weights_1"]]
        ahead = rows @ v["forward"] + v["gates"][: 4 * HIDDEN]
        back = rows @ v["backward"] + v["gates"][4 * HIDDEN :]
        states, kept = both_ways(ahead, back, weights, mask)
        read = np.concatenate([states, rows], axis=2)
        return sigmoid(read @ v["out"] + v["bias"]), read, kept, weights

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The chance of each block of each page to be main text; batches are of pages of like length."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        out: list = [np.zeros(0)] * len(pages)
        while order:
            longest = max(1, len(pages[order[-1]]))
            part, order = order[-max(1, CELLS // longest) :], order[: -max(1, CELLS // longest)]
            found = self._forward(*padded([pages[i] for i in part]))[0]
            for column, i in enumerate(part):
                out[i] = found[: len(pages[i]), column]
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS) -> list[float]:
        """Fit to (features, labels) of pages. Returns the losses."""
        v, random, losses = self.values, np.random.default_rng(SEED), []
        adam = Adam(v, 0.02)
        for step in range(steps):
            chosen = [pages[i] for i in random.integers(0, len(pages), ROWS)]
            rows, mask = padded([page for page, _ in chosen])
            gold = padded([labels[:, None] for _, labels in chosen])[0][:, :, 0]
            chance, read, kept, weights = self._forward(rows, mask)
            total = mask.sum()
            losses.append(float(-(np.log(np.where(gold > 0, chance, 1 - chance) + 1e-9) * mask).sum() / total))
            slope = (chance - gold) * mask / total
            inner = slope[:, :, None] * v["out"]
            ahead, back, recurrent = both_gradients(inner[:, :, : 2 * HIDDEN], kept, weights, mask)
            flat = rows.reshape(-1, WIDTH).T
            adam.update(
                {
                    "forward": flat @ ahead.reshape(-1, 4 * HIDDEN),
                    "backward": flat @ back.reshape(-1, 4 * HIDDEN),
                    "weights_0": recurrent[0],
                    "weights_1": recurrent[1],
                    "gates": np.concatenate([ahead.sum(axis=(0, 1)), back.sum(axis=(0, 1))]),
                    "out": np.einsum("tr,trd->d", slope, read) + 1e-4 * v["out"],
                    "bias": np.array([slope.sum()]),
                },
                rate=1 - 0.9 * step / steps,
            )
        return losses


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, width) and the mask of what is there."""
    longest = max(1, max(map(len, pages)))
    rows, mask = np.zeros((longest, len(pages), pages[0].shape[1])), np.zeros((longest, len(pages)))
    for i, page in enumerate(pages):
        rows[: len(page), i], mask[: len(page), i] = page, 1
    return rows, mask


def element(wrapper: str, content: str, keep: int | None = None) -> str:
    if not wrapper:
        return content
    label = "" if keep is None else f" data-keep='{keep}'"
    return f"<{wrapper}{label}>{content}</{wrapper.split(' ')[0]}>"


def layout(random: np.random.Generator, texts: list[str]) -> str:
    """A page with blocks of `texts` as its main text and as much else, labelled by data-keep."""

    def some(n: int) -> list[str]:
        return [texts[i] for i in random.integers(0, len(texts), n)]

    def short(text: str) -> str:
        words = text.split(" ")
        start = int(random.integers(0, len(words)))
        return " ".join(words[start : start + int(random.integers(1, 9))])

    def other() -> str:
        wrapper = OTHER_WRAPPERS[random.integers(0, len(OTHER_WRAPPERS))]
        kind, parts = random.random(), some(int(random.integers(1, 6)))
        if "menu" in wrapper or "nav" in wrapper or kind < 0.25:
            inner = "<ul>" + "".join(f"<li><a href='/x'>{escape(short(t))}</a></li>" for t in parts) + "</ul>"
        elif "comment" in wrapper or "reply" in wrapper or kind < 0.65:
            tag = ("p", "p", "div", "li", "div class='body'")[random.integers(0, 5)]
            inner = "".join(element(tag, escape(t)) for t in parts[: int(random.integers(1, 4))])
        elif kind < 0.85:
            inner = "".join(element(("p", "div", "span", "h3")[random.integers(0, 4)], escape(short(t))) for t in parts)
        else:
            inner = escape(parts[0] if kind > 0.92 else short(parts[0]))
        return element(wrapper, inner, 0)

    body = [element(("h1", "h1", "h2", "header")[random.integers(0, 4)], escape(short(some(1)[0])))]
    for text in some(int(random.integers(1, 16))):
        tag = ("p", "p", "p", "p", "p", "h2", "li", "blockquote", "div", "td")[random.integers(0, 10)]
        body.append(element(tag, escape(short(text) if tag in ("h2", "li") else text)))
        if random.random() < 0.06:
            body.append(other())
        if random.random() < 0.06:
            items = "".join(element("li", escape(short(t))) for t in some(int(random.integers(2, 6))))
            body.append(element(("ul", "ol")[random.integers(0, 2)], items))
    wrapper = MAIN_WRAPPERS[random.integers(0, len(MAIN_WRAPPERS))]
    main = element(wrapper, "".join(body), 1)
    before = [other() for _ in range(random.integers(0, 5))]
    after = [other() for _ in range(random.integers(0, 5))]
    if wrapper.startswith("td"):
        beside = [element(("td", "td class='left'")[random.integers(0, 2)], other(), 0) for _ in range(random.integers(0, 3))]
        main = element("table", element("tr", "".join([*beside, main]), 0))
    for _ in range(int(random.integers(0, 3))):
        main = element(AROUND[random.integers(0, len(AROUND))], main)
    page = "".join([*before, main, *after])
    return element("body", element(AROUND[random.integers(0, len(AROUND))], page, 0))


def bare_layout(random: np.random.Generator, texts: list[str]) -> str:
    """A page whose wrappers seldom tell: titles, paragraphs, menus, remarks of readers, teasers, notices and
    imprints in elements of any class name. Labelled by data-keep."""
    wrappers: dict[str, str] = {}

    def chance(share: float) -> bool:
        return random.random() < share

    def one(of: Sequence[str]) -> str:
        return of[random.integers(0, len(of))]

    def number(low: int, high: int) -> int:
        return int(random.integers(low, high + 1))

    def words(low: int, high: int) -> str:
        found = one(texts).split(" ")
        start = number(0, max(0, len(found) - low))
        return escape(" ".join(found[start : start + number(low, high)]))

    def around(kind: str, known: Sequence[str] = OTHER_WRAPPERS, share: float = 0.2) -> str:
        if kind not in wrappers:
            name = "".join(map(chr, random.integers(97, 123, number(2, 9))))
            wrapper = one(("div", "div class='%s'", "div class='%s'", "div id='%s'", "section class='%s'")).replace("%s", name)
            wrappers[kind] = one(known) if chance(share) else wrapper
        return wrappers[kind]

    def link(text: str) -> str:
        return f"<a href='/x'>{text}</a>"

    def date() -> str:
        return one((f"{number(1, 28)} {words(1, 1)} {number(1999, 2030)}", f"{number(1, 12)}/{number(1, 28)}/{number(1999, 2030)}", f"{number(2, 23)} {words(1, 2)}"))

    def menu() -> str:
        links = [link(words(1, 3)) for _ in range(number(2, 9))]
        form = number(0, 2)
        inner = " ".join(links) if not form else "".join(element("li" if form == 1 else around("item", share=0), x) for x in links)
        return element(around("menu"), element("ul", inner) if form == 1 else inner, 0)

    def imprint() -> str:
        line = one((f"&copy; {number(1999, 2030)} {words(1, 5)}", words(2, 10), f"{words(1, 3)} {link(words(1, 2))} {link(words(1, 2))}"))
        return element(around("imprint"), element(one(("", "p", "div", "span")), line), 0)

    def notice() -> str:
        line = element(one(("", "p", "div", "span")), words(4, 30))
        return element(around("notice"), line + one(("", link(words(1, 2)), f"<button>{words(1, 2)}</button>")), 0)

    def teasers() -> str:
        parts = [element(one(("h2", "h3", "h4", "div")), words(1, 4))] if chance(0.7) else []
        body = chance(0.5)
        for _ in range(number(2, 7)):
            title = element("h4" if body else "", link(words(2, 9)))
            parts.append(element("div" if body else "p", title + (element("p", words(5, 25)) if body else "")))
        return element(around("teasers"), "".join(parts), 0)

    paragraph = one(("p", "p", "p", "div"))
    author, dated, reply, listed = chance(0.85), chance(0.5), chance(0.4), chance(0.35)
    together = chance(0.4)  # the name and the date in one line
    author_tag, text_tag = one(("b", "strong", "span", "div", "h4", "h5", "p", "div class='by'")), one((paragraph, "p", "div", "div class='x'"))

    def remark() -> str:
        parts = [words(1, 3) + one(("", "", ":", f" {words(1, 1)}"))] if author else []
        if dated:
            parts.append(date())
        parts = [element(author_tag, " ".join(parts))] if together and parts else [element(author_tag, part) for part in parts]
        said = [escape(one(texts)) if chance(0.6) else words(3, 40) for _ in range(1 if chance(0.8) else 2)]
        parts += [element(text_tag, text) for text in said]
        if reply:
            parts.append(link(words(1, 1)))
        return element("li" if listed else around("remark", share=0.1), "".join(parts))

    def remarks() -> str:
        inner = "".join(remark() for _ in range(number(1, 8)))
        title = one((words(1, 3), f"{number(1, 90)} {words(1, 1)}", f"{words(1, 1)} ({number(1, 90)})"))
        head = element(one(("h2", "h3", "h3", "h4", "div", "p")), title) if chance(0.6) else ""
        field = "<form><textarea></textarea><input></form>" if chance(0.2) else ""
        return element(around("remarks"), head + (element("ul", inner) if listed else inner) + field, 0)

    body = [element(one(("h1", "h1", "h1", "h2", "div", paragraph)), words(2, 12))]
    if chance(0.05):
        body = []
    for _ in range(number(2, 14)):
        body.append(element(paragraph, escape(one(texts)) if chance(0.85) else words(2, 40)))
        kind = random.random()
        if kind < 0.1:
            body.append(element(one(("h2", "h3")), words(1, 8)))
        elif kind < 0.15:
            body.append(element(one(("ul", "ol")), "".join(element("li", words(2, 20)) for _ in range(number(2, 5)))))
        elif kind < 0.18:
            body.append(element("blockquote", element("p", escape(one(texts)))))
        elif kind < 0.21:
            body.append(one((notice, teasers))())
    main = element(around("main", MAIN_WRAPPERS, 0.3), "".join(body), 1)
    said = remarks() if chance(0.65) else ""
    if chance(0.25):  # the remarks in one wrapper with the text, but not in it
        main, said = element(around("both", MAIN_WRAPPERS, 0.3), main + said, 0), ""
    before = [menu] * chance(0.75) + [notice] * chance(0.4) + [imprint] * chance(0.3) + [teasers] * chance(0.15)
    after = [menu] * chance(0.2) + [notice] * chance(0.3) + [teasers] * chance(0.35) + [imprint] * chance(0.7)
    rest = [after[i]() for i in random.permutation(len(after))]
    if said:
        rest.insert(number(0, min(1, len(rest))), said)
    page = "".join([*(before[i]() for i in random.permutation(len(before))), main, *rest])
    return element("body", element(one(AROUND), page, 0))


def sampled(page: str) -> bytes:
    """The first blocks of a page."""
    read, size = [], 0
    for block in blocks(page):
        size += len(block.text) + BLOCK_SIZE
        if read and size > PAGE_SIZE:
            break
        read.append(replace(block, text=block.text[:PAGE_SIZE]))
    return pickle.dumps(read)


def sample(pages: DataFrame) -> list[list[Block]]:
    """The blocks of the pages of the sample, read where the pages are."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = [sampled(page) for page in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(read, pa.binary())], ["key", "read"])

    there = pages.where(F.length("html") > 0).select(F.xxhash64("page_id", "html").alias("key"), "html")
    chosen = lowest_hashes(there, "key", PAGES)
    rows = there.join(F.broadcast(chosen), "key").dropDuplicates(["key"])
    found = map_batches(rows, each, "key long, read binary", rows=20).collect()
    return [pickle.loads(row.read) for row in sorted(found, key=lambda row: row.key)]


def train(pages: DataFrame) -> Labeller | None:
    """A labeller from the sample of `pages` (page_id, html); None where that has no text to learn from."""
    read = sample(pages)
    texts = [block.text for page in read for block in page if len(block.text) > LONG]
    if not texts:
        return None
    examples = []
    for page in read:
        labels = [block.semantic for block in page]
        if True in labels:
            examples.append((features(page), np.array([label is True for label in labels], dtype=float)))
    random = np.random.default_rng(SEED)
    for i in range(LAYOUTS):
        page = blocks((bare_layout if i % 4 else layout)(random, texts))
        examples.append((features(page), np.array([bool(block.keep) for block in page], dtype=float)))
    model = Labeller.fresh()
    model.train(examples)
    return model


def extract(pages: DataFrame, model: Labeller | None, html: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the main text of each; `text` replaces a column of that name. Without a model the semantic
    elements tell."""
    kept = [c for c in pages.columns if c != text]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        read = [blocks(page or "") for page in batch.column(html).to_pylist()]
        if model:
            chances = model.chances([features(page) for page in read])
        else:
            chances = [np.array([float(block.semantic is True) for block in page]) for page in read]
        found = [
            "\n".join(block.text for block, chance in zip(page, row.tolist()) if chance >= 0.5)
            for page, row in zip(read, chances)
        ]
        columns = [batch.column(kept.index(c)) for c in kept]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], [*kept, text])

    rows = pages.select(*kept)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], f"`{text}` string"])
    return map_batches(rows, each, schema, rows=200)
