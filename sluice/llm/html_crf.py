"""Main text of web pages: a linear-chain conditional random field over the page's leaf blocks.

A page is cut into leaf blocks (runs of inline content) in page order. Each block has features of its
ancestors (tags, words of their class, id and role) and of its text. The field scores a block's label, content or
not, and the step from one label to the next; it is trained by gradient ascent on labelled pages and decoded by
Viterbi. Labelled pages are composed from common page layouts, filled with text of a bounded sample of the given pages.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Container, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages whose text fills the labelled pages, and how many of those are composed.
SAMPLE, LABELLED = 200, 900
STEPS, RATE, RIDGE = 120, 0.15, 1e-4

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img input".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style template noscript title head option svg math object iframe".split())
#: Tags that an open p ends before.
BEFORE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"ul", "ol", "dl", "table", "body", "article", "section", "main", "div"}
#: Open elements that a start tag may end, or that keep it from ending others.
LOOKED_AT = SCOPES | {"p", "head"} | {t for own in BEFORE.values() for t in own}
NAME = re.compile(r"[a-z]+")
TAG = re.compile(r"[A-Za-z][^\s/>]*+")
#: An attribute, or nothing but what stands before the end of a tag; ``open``: its value never ends.
ATTRIBUTE = re.compile(r"""[\s/]*+(?:(?P<name>[^\s/>][^\s/=>]*+)(?:\s*+=\s*+(?:"(?P<double>[^"]*+)(?:"|(?P<open>\Z))|'(?P<single>[^']*+)(?:'|\Z)|(?P<bare>[^\s>]*+)))?)?""")
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}


class Node:
    """An open element that is not inline: tag, words of its class, id and role, and the element it is in."""

    __slots__ = ("tag", "names", "up", "last", "own")

    def __init__(self, tag: str, names: tuple[str, ...], up: Node | None):
        self.tag, self.names, self.up, self.own = tag, names, up, None
        before = up.last if up else ()
        self.last = before if tag in ("html", "body") else (*before[-1:], tag)

    def features(self, known: Container[str] | None) -> frozenset[str]:
        """Of this element and those it is in; elements that add nothing share one set, so deep pages stay small."""
        chain, node = [], self
        while node is not None and node.own is None:
            chain.append(node)
            node = node.up
        held = node.own if node else frozenset()
        for node in reversed(chain):
            own = ["in " + node.tag, *("named " + n for n in node.names)]
            if node.up and node.up.last and node.tag not in ("html", "body"):
                own.append(f"{node.tag} in {node.up.last[-1]}")
            own = {f for f in own if known is None or f in known}
            node.own = held = held if own <= held else held | own
        return held


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node: Node | None, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked

    @property
    def path(self) -> tuple:
        """(tag, words of its class, id and role) of each ancestor, outermost first."""
        out, node = [], self.node
        while node is not None:
            out.append((node.tag, node.names))
            node = node.up
        return tuple(reversed(out))


class Blocks:
    """Leaf blocks of a page, from one pass over its tags: each character is looked at a few times, whatever the page.

    A tag, comment or attribute value that never ends takes the rest of the page, as in browsers.
    """

    def __init__(self):
        self.open: list[tuple[str, Node | None]] = []
        self.count: Counter[str] = Counter()
        self.ends: list[int] = []  # places in ``open`` that a start tag may have to look at
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0

    @property
    def hidden(self) -> bool:
        return any(self.count[t] for t in HIDDEN)

    def read(self, html: str) -> list[Block]:
        at, size = 0, len(html)
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                self.data(unescape(html[at:lt]))
            if lt == size:
                break
            then = html[lt + 1 : lt + 2]
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = size if end < 0 else end + 3
            elif then in ("!", "?") or then == "/" and not TAG.match(html, lt + 2):
                end = html.find(">", lt + 2)
                at = size if end < 0 else end + 1
            elif then == "/":
                name = TAG.match(html, lt + 2)
                end = html.find(">", name.end())
                at = size if end < 0 else end + 1
                if end >= 0:
                    self.end(name[0].lower())
            elif name := TAG.match(html, lt + 1):
                at = self.tag(html, name)
            else:
                self.data("<")
                at = lt + 1
        self.flush()
        return self.blocks

    def tag(self, html: str, name: re.Match) -> int:
        """Reads a start tag and, of a script or style, its content; the place after it."""
        tag, at, size, names = name[0].lower(), name.end(), len(html), []
        while True:
            m = ATTRIBUTE.match(html, at)
            at = m.end()
            if at >= size or m["open"]:
                return size
            if m["name"] is None:
                break
            if m["name"].lower() in ("class", "id", "role"):
                value = m["double"] or m["single"] or m["bare"]
                names += NAME.findall(unescape(value).lower()) if value else []
        closed = html[at - 1] == "/"
        self.start(tag, tuple(names))
        if closed and tag not in VOID:
            self.end(tag)
        elif not closed and tag in RAW:
            end = RAW[tag].search(html, at + 1)
            return end.start() if end else size
        return at + 1

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.open[-1][1] if self.open else None, text, self.linked))
        self.parts, self.linked = [], 0

    def close_to(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.count[tag] -= 1
        del self.open[at:]
        while self.ends and self.ends[-1] >= at:
            self.ends.pop()

    def start(self, tag: str, names: tuple[str, ...]) -> None:
        up = self.open[-1][1] if self.open else None
        if tag not in INLINE:
            self.flush()
            for i in reversed(self.ends):  # what this tag ends without saying so
                name = self.open[i][0]
                if name == "p" or name in BEFORE.get(tag, ()) or name == "head" and tag == "body":
                    self.close_to(i)
                    up = self.open[-1][1] if self.open else None
                    break
                if name in SCOPES:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag not in VOID:
            if tag in LOOKED_AT:
                self.ends.append(len(self.open))
            self.open.append((tag, up if tag in INLINE else Node(tag, names, up)))
            self.count[tag] += 1

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if self.count[tag] > 0:
            i = len(self.open) - 1
            while self.open[i][0] != tag:
                i -= 1
            self.close_to(i)

    def data(self, text: str) -> None:
        if not self.hidden:
            self.parts.append(text)
            if self.count["a"]:
                self.linked += len(text)


def blocks(html: str) -> list[Block]:
    return Blocks().read(html)


def features(page: list[Block], known: Container[str] | None = None) -> list[list[str]]:
    """Of each block; of its ancestors only ``known`` ones, if given."""
    out = []
    for i, b in enumerate(page):
        f = {"any"}
        if b.node:
            f |= b.node.features(known)
        f.add("path " + " ".join(b.node.last if b.node else ()))
        n = len(b.text)
        f.add(f"size {min(n.bit_length(), 10)}")
        f.add(f"linked {4 * min(b.linked, n) // n}")
        if b.text[-1] in ".!?":
            f.add("sentence")
        if "©" in b.text or "@" in b.text:
            f.add("sign")
        if i == 0:
            f.add("first")
        if i == len(page) - 1:
            f.add("last")
        out.append(sorted(f))
    return out


class Field:
    """Weights of the field: features by label, first label, steps between labels."""

    def __init__(self, names: list[str]):
        self.names = {n: i for i, n in enumerate(names)}
        self.w, self.first, self.step = np.zeros((len(names), 2)), np.zeros(2), np.zeros((2, 2))

    def rows(self, page: list[list[str]]) -> list[np.ndarray]:
        return [np.array([self.names[f] for f in block if f in self.names], np.int64) for block in page]

    def viterbi(self, page: list[list[str]]) -> list[int]:
        """The most probable labels; not content among equals."""
        names, w, back = self.names, self.w, []
        best = None
        for block in page:
            s = w[[names[f] for f in block if f in names]].sum(0)
            if best is None:
                best = self.first + s
            else:
                reach = best[:, None] + self.step
                back.append(reach.argmax(0))
                best = reach.max(0) + s
        label = [int(best.argmax())] if page else []
        for b in reversed(back):
            label.append(int(b[label[-1]]))
        return label[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> Field:
    """Gradient ascent on the pages' log likelihood; forward and backward run over all pages side by side."""
    pages = [p for p in pages if p[0]]
    field = Field(sorted({f for page, _ in pages for block in page for f in block}))
    n, width = len(pages), max((len(p) for p, _ in pages), default=0)
    if not n:
        return field
    at, row = [], []  # features of block (page, place)
    mask, gold = np.zeros((n, width), bool), np.zeros((n, width), np.int64)
    for i, (page, labels) in enumerate(pages):
        mask[i, : len(page)] = True
        gold[i, : len(page)] = labels
        for j, r in enumerate(field.rows(page)):
            at.append(np.full(len(r), i * width + j))
            row.append(r)
    at, row = np.concatenate(at), np.concatenate(row)
    truth = np.eye(2)[gold] * mask[:, :, None]
    pairs = mask[:, 1:]
    true_step = np.einsum("nia,nib->ab", truth[:, :-1] * pairs[:, :, None], truth[:, 1:])
    parts = (field.w, field.first, field.step)
    squares = [np.zeros_like(p) for p in parts]
    for _ in range(steps):
        s = np.stack([np.bincount(at, field.w[row, y], minlength=n * width) for y in (0, 1)], 1).reshape(n, width, 2)
        a = np.empty((n, width, 2))
        a[:, 0] = field.first + s[:, 0]
        for j in range(1, width):
            a[:, j] = np.where(mask[:, j, None], np.logaddexp.reduce(a[:, j - 1, :, None] + field.step, axis=1) + s[:, j], a[:, j - 1])
        b = np.zeros((n, width, 2))
        for j in range(width - 2, -1, -1):
            b[:, j] = np.where(mask[:, j + 1, None], np.logaddexp.reduce(field.step + (s[:, j + 1] + b[:, j + 1])[:, None, :], axis=2), b[:, j + 1])
        whole = np.logaddexp.reduce(a[:, -1], axis=1)
        p = np.exp(a + b - whole[:, None, None]) * mask[:, :, None]
        step = np.exp(a[:, :-1, :, None] + field.step + (s[:, 1:] + b[:, 1:])[:, :, None, :] - whole[:, None, None, None]) * pairs[:, :, None, None]
        miss = (truth - p).reshape(-1, 2)
        grads = (np.stack([np.bincount(row, miss[at, y], minlength=len(field.w)) for y in (0, 1)], 1), (truth - p)[:, 0].sum(0), true_step - step.sum((0, 1)))
        for x, g, q in zip(parts, grads, squares):
            g = g / n - RIDGE * x
            q += g * g
            x += RATE * g / np.sqrt(q + 1e-12)
    return field


#: Names that layouts give to parts of a page: fixed values.
LAYOUT = {
    "header": "header site-header masthead top-bar page-header branding",
    "menu": "nav menu navbar navigation main-nav breadcrumbs tabs toolbar pagination pager",
    "notice": "notice cookie-banner consent alert cookies gdpr popup modal message warning overlay",
    "advert": "ad ads advert advertisement sponsored promo banner ad-slot partner sponsor",
    "sidebar": "sidebar aside widget related rail recommended trending popular more-stories tags share social",
    "form": "form search subscribe newsletter login signup contact search-form",
    "comments": "comments comment reply discussion responses comment-list disqus",
    "footer": "footer site-footer copyright legal bottom page-footer credits",
    "content": "content post entry article-body main-content story post-content text body-text article page-content",
}


def labelled_pages(texts: list[str], n: int = LABELLED, seed: int = 1) -> Iterator[tuple[str, list[int]]]:
    """Composed pages, and whether each leaf block is content. ``texts`` fill them."""
    draw = random.Random(seed)
    names = {k: v.split() for k, v in LAYOUT.items()}
    texts = [t.replace("&", "&amp;").replace("<", "&lt;") for t in texts if t.strip()] or ["Some words."]

    def line(longest: int) -> str:
        t = draw.choice(texts)
        a = draw.randrange(len(t))
        return t[a : a + draw.randint(1, longest)].strip() or "Word"

    def part(kind: str, *inner: tuple[str, int], tag: str = "") -> list[tuple[str, int]]:
        name = draw.choice(names[kind])
        how = draw.choice(("class", "class", "id"))
        own = draw.choice((tag, "div")) if tag else draw.choice(("div", "section"))
        plain = own not in ("div", "section") and draw.random() < 0.6
        return [(f"<{own}>" if plain else f'<{own} {how}="{name}">', -1), *inner, (f"</{own}>", -1)]

    def leaf(tag: str, longest: int, label: int, link: float = 0.0) -> tuple[str, int]:
        t = line(longest)
        if draw.random() < link:
            t = f'<a href="/x">{t}</a>'
        elif draw.random() < 0.2:
            t = f"<b>{t}</b>" if draw.random() < 0.5 else f"{t} <a href='/y'>{line(12)}</a>"
        return (f"<{tag}>{t}</{tag}>", label)

    def several(most: int, tag: str, longest: int, label: int, link: float = 0.0) -> list[tuple[str, int]]:
        return [leaf(tag, longest, label, link) for _ in range(draw.randint(1, most))]

    def menu() -> list[tuple[str, int]]:
        return part("menu", ("<ul>", -1), *several(8, "li", 14, 0, 0.95), ("</ul>", -1), tag="nav")

    def aside() -> list[tuple[str, int]]:
        return part("sidebar", *several(2, draw.choice(("h2", "h3", "h4")), 30, 0), *several(4, draw.choice(("li", "p")), 90, 0, 0.6), tag="aside")

    def advert() -> list[tuple[str, int]]:
        return part("advert", *several(2, draw.choice(("p", "span", "div")), 140, 0, 0.3))

    def notice() -> list[tuple[str, int]]:
        return part("notice", *several(2, "p", 200, 0, 0.1), ("<button>", -1), (line(8), 0), ("</button>", -1))

    def form() -> list[tuple[str, int]]:
        return [("<form>", -1), *part("form", *several(3, draw.choice(("p", "div")), 40, 0), ("<button>", -1), (line(10), 0), ("</button>", -1)), ("</form>", -1)]

    def comments() -> list[tuple[str, int]]:
        return part("comments", leaf("h3", 20, 0), *(x for _ in range(draw.randint(1, 4)) for x in part("comments", leaf("p", 15, 0, 0.5), leaf("p", 300, 0))))

    def article() -> list[tuple[str, int]]:
        out = [leaf(draw.choice(("h1", "h1", "h2")), 70, 1)]
        if draw.random() < 0.2:
            out = [("<header>", -1), *out, ("</header>", -1)]
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.75:
                out.append(leaf("p", 600, 1))
            elif kind < 0.82:
                out.append(leaf(draw.choice(("h2", "h3")), 60, 1))
            elif kind < 0.88:
                out += [("<ul>", -1), *several(5, "li", 120, 1, 0.1), ("</ul>", -1)]
            elif kind < 0.92:
                out.append(leaf(draw.choice(("blockquote", "pre", "figcaption", "dd")), 200, 1))
            elif kind < 0.95:
                out += [("<table><tr>", -1), *several(4, "td", 30, 1), ("</tr></table>", -1)]
            else:
                out += draw.choice((advert, aside, form))()
        if draw.random() < 0.4:  # the article's own element, around a named part or not
            out = part("content", *out)
        return [("<article>", -1), *out, ("</article>", -1)] if draw.random() < 0.5 else part("content", *out, tag="main")

    for _ in range(n):
        page = [] if draw.random() < 0.4 else part("header", leaf(draw.choice(("h1", "div", "p")), 30, 0, 0.5), *(menu() if draw.random() < 0.4 else []), tag="header")
        for make, chance in ((menu, 0.7), (notice, 0.3), (advert, 0.4), (form, 0.2)):
            page += make() if draw.random() < chance else []
        page += article()
        for make, chance in ((advert, 0.3), (aside, 0.5), (comments, 0.35), (form, 0.2), (menu, 0.2), (notice, 0.15)):
            page += make() if draw.random() < chance else []
        if draw.random() < 0.85:
            page += part("footer", *several(3, draw.choice(("p", "div", "li")), 100, 0, 0.4), (draw.choice(("&copy; ", "")) + line(60), 0), tag="footer")
        html = "".join(x for x, _ in page)
        yield f"<html><head><title>{line(40)}</title></head><body>{html}</body></html>", [y for _, y in page if y >= 0]


def train(texts: list[str], n: int = LABELLED, seed: int = 1) -> Field:
    """Field trained on composed pages; one whose blocks do not fall one to one on the labels is left out."""
    pages = [(features(b), y) for html, y in labelled_pages(texts, n, seed) if len(b := blocks(html)) == len(y)]
    return fit(pages)


def extractor(field: Field):
    """A column function: html -> main text."""
    @F.arrow_udf("string")
    def extract(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = []
            for html in part:
                page = blocks(html.as_py() or "")
                out.append("\n".join(b.text for b, y in zip(page, field.viterbi(features(page, field.names))) if y))
            yield pa.array(out, pa.string())

    return extract


def main_text(pages: DataFrame, html: str | Column = "html", sample: int = SAMPLE) -> Column:
    """The main text of each page of ``html``, from a field trained for these pages.

    Blocks in page order, joined by one \\n; in a block every run of white space is one space, character references are
    decoded, a line break tag is a space. Null, empty and textless pages give the empty text. The sample is a share of
    the distinct pages chosen by a hash of the html, ``sample`` in expectation, of which equal pages lend one; it only lends its words to the labelled pages, so an empty table trains on one fixed
    sentence. Long pages are read whole; repeated rows get equal results.
    """
    html = F.col(html) if isinstance(html, str) else html
    own = pages.select(html.alias("html")).filter("html is not null").withColumn("hash", F.xxhash64("html"))
    share = min(1.0, sample / max(1, own.agg(F.approx_count_distinct("hash")).first()[0]))
    lent = own.filter(F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30))).groupBy("hash").agg(F.first("html").alias("html")).collect()
    texts = [b.text for r in sorted(lent, key=lambda r: r["hash"]) for b in blocks(r["html"])]
    return extractor(train(texts))(html)
