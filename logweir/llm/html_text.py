"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

A page is parsed into a tree of elements and pieces of text.  Each node gets features: its tag, the
tokens of its class, id and role attributes, the same of its ancestors, the density of text, links and
tags in its subtree, its depth, and how it stands among its siblings.  Boosted trees say how likely
it holds main text.  Decoding then chooses labels for the whole tree at once: nothing below a node
that is left out can be main text, and what is kept has only kept ancestors; the choice of largest
likelihood is found with one pass up and one down.  Kept text is put together block by block.

No page comes with labels, so the trees learn from composed pages: articles and menus, headers,
footers, sidebars, notices, adverts, forms and reader comments in many layouts, with and without telling
tags and names, filled with words of a bounded sample of the table's own pages (``SAMPLE_PAGES``, in
a fixed random order).  In a composed page the place of each piece of text is known.

Character references are decoded, white space in a block becomes one space, blocks are trimmed and joined
by two line feeds in page order.  Scripts, styles and other text that is not shown are markup.

Defined cases: null and empty pages, and pages without main text, give an empty text; pages without any
markup are one text; broken markup is read as far as it goes (open elements end with the page, stray
end tags are passed over); very deep nesting is read without recursion; equal pages get equal
texts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logweir.llm.boosting import Boosted, fit
from logweir.llm.common import slices

SAMPLE_PAGES = 200
COMPOSED_PAGES = 700

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title textarea select option datalist svg iframe".split())
RAW = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr
    math mfrac mi mn mo mover mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics""".split())
CLOSES_P = frozenset("""address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p
    pre section table ul""".split())
#: A start tag ends the open element of these names, up to the nearest of the second set.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

GROUPS = {name: k for k, names in enumerate((
    "#text", "html body", "div", "section", "article", "main", "nav menu", "header", "footer", "aside", "form fieldset input button label",
    "ul ol dl", "li dt dd", "h1 h2 h3 h4 h5 h6", "p", "blockquote pre figure figcaption", "table tbody thead tr td th", "a", "span b i em strong",
)) for name in names.split()}
N_GROUPS = max(GROUPS.values()) + 2

NAMES = {name: k for k, names in enumerate((
    "nav menu navbar navigation breadcrumb breadcrumbs tabs pagination pager toc skip",
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion werbung anzeige publicite",
    "header head masthead topbar top logo branding brand",
    "footer foot bottom copyright legal imprint colophon",
    "sidebar side aside rail widget widgets related recommended recommendations more popular trending tags",
    "cookie cookies consent notice notices alert gdpr popup modal overlay message warning paywall",
    "comment comments reply replies respond disqus discussion reader kommentare commentaires",
    "form search login signup subscribe newsletter subscription register contact",
    "share sharing social follow facebook twitter buttons toolbar meta byline author date",
    "article content main post entry story body text page article-body maincontent entrytext hentry inhalt contenu",
)) for name in names.split()}
N_NAMES = max(NAMES.values()) + 1

OPENING = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME_END = re.compile(r"[\s/>]")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE = re.compile(r"[.!?,;:](?:\s|$)")


@dataclass
class Page:
    """Nodes in page order; a node's subtree is the run up to ``last``."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    names: list[int] = field(default_factory=list)  # bits of NAMES
    text: list[str] = field(default_factory=list)

    def add(self, tag: str, parent: int, names: int = 0, text: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.last.append(len(self.tag))
        self.names.append(names)
        self.text.append(text)
        return len(self.tag) - 1


def name_bits(attributes: str) -> int:
    bits = 0
    if "=" in attributes:
        for _, a, b, c in ATTRIBUTE.findall(attributes):
            for token in TOKEN.findall(a or b or c):
                k = NAMES.get(token.lower())
                if k is not None:
                    bits |= 1 << k
    return bits


class Marks:
    """Where the tags of a page end.  Each question is answered from sorted places, so broken pages take no longer."""

    def __init__(self, source: str):
        self.source = source
        self.special = [m.start() for m in re.finditer("[>\"']", source)]
        self.kinds = [source[i] for i in self.special]
        self.last_end = source.rfind(">")
        self.after: dict[int, int] = {}  # by number of a special character outside quotes: where its tag ends
        self.next_same: list[int] | None = None
        self.name_ends: list[int] | None = None

    def closing(self, at: int) -> int:
        """The first ``>`` from ``at`` on that no quotation holds, -1 if there is none."""
        k, passed = bisect_left(self.special, at), []
        while k not in self.after:
            if k >= len(self.special):
                end = -1
                break
            if self.kinds[k] == ">":
                end = self.special[k]
                break
            passed.append(k)
            k = self._partner(k) + 1
        else:
            end = self.after[k]
        for k in passed:
            self.after[k] = end
        return end

    def _partner(self, k: int) -> int:
        """The number of the next quotation mark of the same kind; behind the last place if there is none."""
        if self.next_same is None:
            last: dict[str, int] = {}
            self.next_same = [len(self.special)] * len(self.special)
            for i in range(len(self.special) - 1, -1, -1):
                self.next_same[i] = last.get(self.kinds[i], len(self.special))
                last[self.kinds[i]] = i
        return self.next_same[k]

    def declaration_end(self, at: int) -> int:
        """The first ``>`` from ``at`` on, in quotes or not, -1 if there is none."""
        if at > self.last_end:
            return -1
        return self.source.find(">", at)

    def name_end(self, at: int) -> int:
        """Where the tag name that starts at ``at`` ends."""
        near = NAME_END.search(self.source, at, at + 64)
        if near:
            return near.start()
        if self.name_ends is None:
            self.name_ends = [m.start() for m in NAME_END.finditer(self.source)]
        k = bisect_left(self.name_ends, at)
        return self.name_ends[k] if k < len(self.name_ends) else len(self.source)


class Open:
    """The open elements, with the places of each name and of those that are no inline elements."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.tags: list[str] = []
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: int, tag: str) -> None:
        depth = len(self.nodes)
        self.nodes.append(node)
        self.tags.append(tag)
        self.of.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)

    def pop(self) -> int:
        tag = self.tags.pop()
        self.of[tag].pop()
        if tag not in INLINE:
            self.blocks.pop()
        return self.nodes.pop()

    def innermost(self, names: set[str] | tuple[str, ...]) -> int:
        """Depth of the innermost element of these names below the root, 0 if there is none."""
        return max((self.of[n][-1] for n in names if self.of.get(n)), default=0)


def parse(source: str) -> Page:
    page, marks, stack = Page(), Marks(source), Open()
    root = page.add("html", -1)
    stack.push(root, "html")
    at = 0
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = "".join(pieces)
            pieces.clear()
            if text and not text.isspace():
                page.add("#text", stack.nodes[-1], 0, entities.unescape(text))
            elif text:  # white space between inline pieces matters when blocks are put together
                page.add("#space", stack.nodes[-1], 0, " ")

    def close(depth: int) -> None:
        while len(stack.nodes) > depth:
            page.last[stack.pop()] = len(page.tag)

    length = len(source)
    while at < length:
        found = OPENING.search(source, at)
        if found is None:
            pieces.append(source[at:])
            break
        start = found.start()
        if start > at:
            pieces.append(source[at:start])
        if found.group() == "<!--":
            end = source.find("-->", start + 4)
            at = length if end < 0 else end + 3
            continue
        if found.group() in ("<!", "<?"):
            end = marks.declaration_end(start)
        else:
            ending = source[start + 1] == "/"
            begin = start + 2 if ending else start + 1
            name_end = marks.name_end(begin)
            end = marks.closing(name_end)
        if end < 0:  # never closed: text
            pieces.append(source[start:start + 1])
            at = start + 1
            continue
        at = end + 1
        if found.group() in ("<!", "<?"):
            continue
        flush()
        name, attributes = source[begin:name_end].lower(), source[name_end:end]
        if ending:
            depth = stack.innermost((name,))
            if depth and (name not in INLINE or depth > stack.blocks[-1]):
                close(depth)
            continue
        if name in ("html", "body"):
            page.names[root] |= name_bits(attributes)
            continue
        if name in CLOSES_P:
            depth = stack.innermost(("p",))
            if depth and depth == stack.blocks[-1]:
                close(depth)
        elif name in ENDS:
            ended, bound = ENDS[name]
            depth = stack.innermost(ended)
            if depth > stack.innermost(bound):
                close(depth)
        node = page.add(name, stack.nodes[-1], name_bits(attributes))
        if name in RAW and not attributes.endswith("/"):
            # The first end tag counts; where that one is never closed, no later one is.
            tag = re.compile(f"</{name}", re.I).search(source, at)
            end = source.find(">", tag.end()) if tag else -1
            at = length if end < 0 else end + 1
        elif name not in VOID and not attributes.endswith("/"):
            stack.push(node, name)
    flush()
    close(0)
    return page


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    group = np.array([GROUPS.get(t, N_GROUPS - 1) for t in page.tag])
    names = np.array(page.names, np.int64)
    chars, words, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, text in enumerate(page.text):
        if text and page.tag[i] == "#text":
            chars[i] = len(text)
            words[i] = text.count(" ") + 1
            stops[i] = len(SENTENCE.findall(text))
    # Ancestors come before their descendants, so one pass down inherits and sums over runs add up subtrees.
    depth = np.zeros(n)
    above_group, above_names = np.zeros(n, np.int64), np.zeros(n, np.int64)
    hidden = np.zeros(n, bool)
    for i in range(1, n):
        p = page.parent[i]
        depth[i] = depth[p] + 1
        above_group[i] = above_group[p] | (1 << int(group[p]))
        above_names[i] = above_names[p] | names[p]
        hidden[i] = hidden[p] or page.tag[i] in HIDDEN
    chars[hidden] = words[hidden] = stops[hidden] = 0
    last = np.array(page.last)
    starts = np.arange(n)

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(values)))
        return total[last] - total[starts]

    in_link = (above_group >> GROUPS["a"] & 1).astype(bool)
    all_chars, all_words, all_stops = subtree(chars), subtree(words), subtree(stops)
    links = subtree(np.where(in_link, chars, 0.0))
    tags = subtree((group != 0).astype(float))
    paragraphs = subtree((group == GROUPS["p"]).astype(float))
    at_least = np.maximum(all_chars, 1.0)
    safe = np.maximum(parent, 0)
    whole = max(all_chars[0], 1.0)
    before = np.concatenate(([0.0], np.cumsum(chars)))[starts]
    shown = (~hidden).astype(float)
    siblings = np.bincount(safe, shown, n)[safe]
    order = np.zeros(n)
    counter = np.zeros(n)
    for i in range(1, n):
        p = page.parent[i]
        order[i] = counter[p]
        counter[p] += 1
    heard = np.bincount(safe[1:], all_chars[1:], n)[safe] if n > 1 else np.zeros(n)
    columns = [(group == k).astype(float) for k in range(N_GROUPS)]
    columns += [(above_group >> k & 1).astype(float) for k in range(2, N_GROUPS)]
    columns += [(names >> k & 1).astype(float) for k in range(N_NAMES)]
    columns += [(above_names >> k & 1).astype(float) for k in range(N_NAMES)]
    parent_group = np.where(parent >= 0, group[safe], -1)
    columns += [
        np.log1p(all_chars), np.log1p(all_words), links / at_least, np.log1p(100 * tags / at_least), np.log1p(paragraphs),
        100 * all_stops / at_least, depth, before / whole, 1 - (before + all_chars) / whole, all_chars / whole,
        all_chars / np.maximum(all_chars[safe], 1.0), np.log1p(siblings), order / np.maximum(siblings, 1.0),
        np.log1p((heard - all_chars) / np.maximum(siblings - 1, 1.0)), in_link.astype(float),
        links[safe] / at_least[safe], np.log1p(all_chars[safe]), np.log1p(paragraphs[safe]), parent_group.astype(float),
    ]
    return np.stack(columns, axis=1)


def decode(page: Page, scores: np.ndarray) -> np.ndarray:
    """Labels of largest likelihood in which every kept node has kept ancestors."""
    n = len(page.tag)
    keep, drop = -np.logaddexp(0, -scores), -np.logaddexp(0, scores)
    hidden = np.array([t in HIDDEN for t in page.tag])
    keep[hidden] = -np.inf
    empty = np.array([t == "#space" for t in page.tag])
    keep[empty], drop[empty] = 0.0, 0.0
    inside, outside = keep.copy(), drop.copy()  # best of the subtree if the node is kept, or left out
    parent = page.parent
    for i in range(n - 1, 0, -1):
        p = parent[i]
        outside[p] += outside[i]
        inside[p] += max(inside[i], outside[i])
    label = np.zeros(n, bool)
    label[0] = inside[0] > outside[0]
    for i in range(1, n):
        label[i] = label[parent[i]] and inside[i] >= outside[i]
    return label


def blocks(page: Page, label: np.ndarray) -> list[str]:
    """Kept text, one string per block."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    open_: list[int] = []
    for i, tag in enumerate(page.tag):
        while open_ and i >= page.last[open_[-1]]:
            open_.pop()
            end()
        if tag in ("#text", "#space"):
            if label[i]:
                run.append(page.text[i])
        elif tag in ("br", "img", "wbr"):
            run.append(" " if tag == "br" else "")
        elif tag not in INLINE:
            end()
            open_.append(i)
    end()
    return out


@dataclass
class Extractor:
    model: Boosted

    def texts(self, pages: list[str | None]) -> list[str]:
        parsed = [parse(p) if p else None for p in pages]
        rows = [features(p) for p in parsed if p is not None]
        scores = self.model.scores(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for page in parsed:
            if page is None:
                out.append("")
                continue
            n = len(page.tag)
            label = decode(page, scores[at:at + n])
            if n == 2 and page.tag[1] == "#text":  # no markup at all
                label[:] = True
            out.append("\n\n".join(blocks(page, label)))
            at += n
        return out


class Composer:
    """Pages of known main text: every piece of text that is main text carries a mark that is taken off after parsing."""

    MARK = "\x02"

    def __init__(self, words: list[str], seed: int):
        self.words, self.rng = words, random.Random(seed)

    def some(self, least: int, most: int) -> str:
        return " ".join(self.rng.choice(self.words) for _ in range(self.rng.randint(least, most)))

    def prose(self, mark: str, least: int = 8, most: int = 70) -> str:
        text = []
        for _ in range(self.rng.randint(1, 4)):
            text.append(self.some(least, most // 2).capitalize() + self.rng.choice([".", ".", ".", "!", "?", ","]))
        out = mark + " ".join(text)
        if self.rng.random() < 0.3:
            out += f" <{(t := self.rng.choice(['b', 'i', 'em', 'strong', 'span']))}>{mark}{self.some(1, 4)}</{t}> {mark}{self.some(2, 12)}."
        if self.rng.random() < 0.2:
            out += f' <a href="/x">{mark}{self.some(1, 3)}</a> {mark}{self.some(2, 10)}.'
        return out

    def named(self, tags: list[str], names: list[str], inner: str) -> str:
        tag = self.rng.choice(tags)
        shape = self.rng.random()
        attribute = "" if shape < 0.25 else f' class="{self.rng.choice(names)}"' if shape < 0.7 else f' id="{self.rng.choice(names)}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def links(self, least: int, most: int, mark: str = "") -> str:
        items = [f'<a href="/{k}">{mark}{self.some(1, 4)}</a>' for k in range(self.rng.randint(least, most))]
        return self.rng.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items), " ".join(items)])

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        if kind == "menu":
            tags, names = ["nav", "nav", "div", "ul"], ["menu", "nav", "main-nav", "navbar", "navigation", "breadcrumb", "pagination"]
            return self.named(tags, names, self.links(3, 9))
        if kind == "header":
            inner = r.choice([f"<a href='/'>{self.some(1, 3)}</a>", f"<h1>{self.some(1, 3)}</h1>", f"<div>{self.some(2, 8)}</div>"])
            return self.named(["header", "header", "div"], ["header", "site-header", "masthead", "topbar", "branding"], inner + self.links(0, 5))
        if kind == "footer":
            inner = r.choice(["&copy; ", "Copyright "]) + self.some(1, 8) + r.choice(["", self.links(1, 6), f"<p>{self.some(4, 25)}.</p>"])
            return self.named(["footer", "footer", "div"], ["footer", "site-footer", "bottom", "legal"], inner)
        if kind == "side":
            inner = f"<h3>{self.some(1, 3)}</h3>" + r.choice([self.links(3, 9), f"<p>{self.some(5, 30)}.</p>", self.links(2, 4) + f"<p>{self.some(3, 20)}</p>"])
            return self.named(["aside", "aside", "div", "section"], ["sidebar", "related", "widget", "more", "popular", "rail", "side"], inner)
        if kind == "notice":
            inner = r.choice([f"<p>{self.some(5, 30)}.</p>", self.some(5, 25) + "."]) + r.choice(["", "<button>OK</button>", "<a href='#'>OK</a>"])
            return self.named(["div", "div", "section", "aside"], ["cookie-notice", "cookies", "consent", "notice", "alert", "popup", "banner gdpr"], inner)
        if kind == "advert":
            inner = r.choice([self.some(3, 14) + ".", f"<a href='/ad'>{self.some(3, 10)}</a>", f"<p>{self.some(3, 20)}.</p>"])
            return self.named(["div", "div", "aside", "section"], ["ad", "ads", "advert", "sponsored", "ad-box", "promo", "banner"], inner)
        if kind == "form":
            inner = f"<label>{self.some(1, 3)}</label><input name='q'><button>{self.some(1, 2)}</button>" + r.choice(["", f"<p>{self.some(3, 15)}.</p>"])
            form = f"<form>{inner}</form>"
            return r.choice([form, self.named(["div", "section"], ["search", "newsletter", "subscribe", "login", "signup"], form)])
        if kind == "share":
            return self.named(["div", "ul", "p"], ["share", "social", "meta", "byline", "toolbar"], r.choice([self.links(2, 5), self.some(2, 6)]))
        inner = "".join(self.named(["div", "li", "article"], ["comment", "reply", "comment-body"], r.choice([f"<b>{self.some(1, 2)}</b> ", ""]) + f"<p>{self.prose('')}</p>")
                        for _ in range(r.randint(1, 6)))
        title = r.choice(["", f"<h2>{self.some(1, 2)}</h2>", f"<h3>{self.some(1, 2)}</h3>"])
        return self.named_always(["div", "section", "ol"], ["comments", "comment-list", "discussion", "respond", "disqus"], title + inner)

    def named_always(self, tags: list[str], names: list[str], inner: str) -> str:
        return f"<{(t := self.rng.choice(tags))} {self.rng.choice(['class', 'id'])}=\"{self.rng.choice(names)}\">{inner}</{t}>"

    def article(self) -> str:
        r, m = self.rng, self.MARK
        out = [f"<{(t := r.choice(['h1', 'h1', 'h2']))}>{m}{self.some(1, 12)}</{t}>"] if r.random() < 0.85 else []
        if r.random() < 0.2:
            out.append(self.boilerplate("share"))
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9])):
            shape = r.random()
            if shape < 0.62:
                out.append(f"<p>{self.prose(m, *r.choice([(8, 70), (1, 5), (30, 160), (2, 20)]))}" + r.choice(["</p>", "</p>", ""]))
            elif shape < 0.7:
                out.append(f"<p><b>{m}{self.some(3, 60)}.<br>" + r.choice(["", f"<p>{self.prose(m)}</p>"]))
            elif shape < 0.76:
                out.append(f"<{(t := r.choice(['h2', 'h3']))}>{m}{self.some(1, 7)}</{t}>")
            elif shape < 0.83:
                out.append(f"<{(t := r.choice(['ul', 'ol']))}>" + "".join(f"<li>{m}{self.some(2, 18)}</li>" for _ in range(r.randint(2, 6))) + f"</{t}>")
            elif shape < 0.88:
                out.append(f"<blockquote>{r.choice(['<p>', ''])}{self.prose(m)}</blockquote>")
            elif shape < 0.91:
                out.append("<table>" + "".join(f"<tr><td>{m}{self.some(1, 5)}</td><td>{m}{self.some(1, 8)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif shape < 0.94:
                out.append(f"<div>{self.prose(m)}</div>")
            elif shape < 0.97:
                out.append(f"<pre>{m}{self.some(4, 30)}</pre>")
            else:
                out.append(self.boilerplate(r.choice(["advert", "side", "share", "form"])))
        inner = "".join(out)
        shape = r.random()
        if shape < 0.45:
            return f"<article{r.choice(['', ' class=\"post\"', ' id=\"story\"'])}>{inner}</article>"
        if shape < 0.6:
            return f"<main>{inner}</main>"
        if shape < 0.88:
            return self.named_always(["div", "div", "section"], ["content", "post", "entry-content", "article-body", "main-content", "story", "text"], inner)
        return f"<div>{inner}</div>"

    def page(self) -> str:
        r = self.rng
        before = r.sample(["menu", "header", "notice", "advert", "form"], r.randint(0, 4))
        after = r.sample(["side", "comments", "advert", "share", "form", "notice", "menu"], r.randint(0, 4)) + ["footer"] * (r.random() < 0.8)
        first, last = "".join(map(self.boilerplate, before)), "".join(map(self.boilerplate, after))
        middle = self.article()
        if r.random() < 0.3:
            middle = self.named(["div", "main", "section"], ["container", "wrapper", "page", "content", "row"], r.choice(["", self.boilerplate("side")]) + middle + r.choice(["", last]))
        body = first + middle + last
        if r.random() < 0.2:
            body = f"<div class='{r.choice(['wrap', 'page', 'site', 'container'])}'>{body}</div>"
        head = f"<head><title>{self.some(1, 8)}</title><style>p{{margin:0}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{body}" + r.choice(["</body></html>", ""])


def examples(words: list[str], n_pages: int = COMPOSED_PAGES, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features of the nodes of composed pages, and whether each holds main text."""
    composer = Composer(words, seed)
    rows, labels = [], []
    for _ in range(n_pages):
        page = parse(composer.page())
        main = np.array([composer.MARK in t for t in page.text])
        page.text = [t.replace(composer.MARK, "") for t in page.text]
        total = np.concatenate(([0], np.cumsum(main)))
        holds = total[np.array(page.last)] > total[np.arange(len(main))]
        counts = np.array([t != "#space" and t not in HIDDEN and t not in VOID for t in page.tag])
        rows.append(features(page)[counts])
        labels.append(holds[counts])
    return np.concatenate(rows), np.concatenate(labels).astype(float)


def sample_words(pages: DataFrame) -> list[str]:
    """Words of a bounded sample of the table's pages."""
    rows = (pages.select("page_id", "html").filter("html IS NOT NULL")
            .orderBy(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), "html").limit(SAMPLE_PAGES).collect())
    words = {w for r in rows for t in parse(r["html"]).text for w in t.split()[:400] if "<" not in w and "&" not in w and len(w) < 30}
    return sorted(words)[:20_000] or ["word", "and", "another", "text"]


def learn(pages: DataFrame) -> Extractor:
    return Extractor(fit(*examples([entities.escape(w) for w in sample_words(pages)])))


def extract(pages: DataFrame, extractor: Extractor) -> DataFrame:
    """page_id, url, text and n_chars of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, 64):
                texts = extractor.texts(part.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    slim = pages.select("page_id", "url", "html")
    kinds = [slim.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return slim.mapInArrow(batches, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
