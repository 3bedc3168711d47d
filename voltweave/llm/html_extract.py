"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 6).

A page is parsed into a tree in one pass (unclosed and misnested elements are closed as HTML's
rules close them). Each element has features: its own and its ancestors' kind, tokens of class, id
and role, depth, text and link density of its subtree, and what its siblings are like. Boosted trees, trained here
on generated pages of many layouts whose main text is known, give each element the log odds that its text belongs
to the article. Decoding goes from the root down: an element is kept, dropped, or left to its children,
whichever gives the subtree the highest summed log odds, so that no descendant of a kept element contradicts
it, nor does one of a dropped element.

Rules after decoding: block elements separate blocks (a line break is white space), character references
are decoded, white space inside a block becomes one space, empty blocks go, blocks are joined by a blank line.

Edge cases: null and empty pages give an empty text; text outside any element is judged with the root;
elements nested deeper than ``MAX_DEPTH`` are children of the one at that depth, with all their text; repeated pages are each
extracted; other columns pass through, but for text and n_chars, which the results replace.
"""

from __future__ import annotations

import heapq
import html
import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import schema_of, ship, slices, table, with_plain_names, without

#: Open elements that a stack holds; deeper ones are parsed flat.
MAX_DEPTH = 200
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 32
TRAINING_PAGES, SEED = 500, 7

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: What never is text of a page.
UNSEEN = frozenset("script style noscript iframe template xmp noembed noframes head title textarea select option datalist svg math canvas object audio video button input".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag of a key closes an open element of its value, up to the scope.
_P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre search section summary table ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
SCOPE = frozenset("table td th caption button object html body".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())

#: A comment, a tag (quotes may hold ">"; if they don't close, it ends at the first ">"), a declaration. Possessive: no backtracking.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>|<[!?][^>]*+>?", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WHITE = re.compile(r"\s+")

KINDS = ("root", "article", "main", "section", "div", "p", "heading", "list", "item", "nav", "aside", "header", "footer", "form", "table", "quote", "figure", "link", "inline", "other")
KIND = {"#root": 0, "html": 0, "body": 0, "article": 1, "main": 2, "section": 3, "div": 4, "p": 5, "ul": 7, "ol": 7, "dl": 7, "menu": 7, "li": 8, "dt": 8, "dd": 8, "nav": 9, "aside": 10, "header": 11, "footer": 12, "form": 13, "fieldset": 13, "label": 13, "button": 13, "table": 14, "tr": 14, "td": 14, "th": 14, "tbody": 14, "thead": 14, "blockquote": 15, "pre": 15, "figure": 16, "figcaption": 16, "a": 17} | {f"h{i}": 6 for i in range(1, 7)} | {x: 18 for x in INLINE if x != "a" and x != "label"}
BAD = re.compile(r"(?:^|[-_\s])(?:ad|ads|advert\w*|adv|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|breadcrumb\w*|crumbs?|sidebar|side|aside|widget\w*|foot\w*|head|header|masthead|topbar|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|comment\w*|disqus|repl(?:y|ies)|respond|discussion|share|sharing|social|related|recommend\w*|more|tags?|pager|pagination|copyright|legal|search|form|toolbar|skip|rating|poll|author-box|bio|toc)(?:$|[-_\s\d])", re.I)
COMMENT = re.compile(r"(?:^|[-_\s])(?:comment\w*|disqus|repl(?:y|ies)|respond|discussion|responses?|feedback|reader\w*)(?:$|[-_\s\d])", re.I)
GOOD = re.compile(r"(?:^|[-_\s])(?:article\w*|main\w*|content\w*|post\w*|entry\w*|story\w*|body|text|blog|page|prose|article-?body)(?:$|[-_\s\d])", re.I)
FEATURES = 46


class Node:
    __slots__ = ("tag", "token", "parent", "children", "depth", "length", "linked", "blocks", "stops", "elements", "index")

    def __init__(self, tag: str, token: str, parent: Node | None):
        self.tag, self.token, self.parent = tag, token, parent
        #: Nodes, and strings of text in between.
        self.children: list[Node | str] = []
        self.depth = 0 if parent is None else parent.depth + 1


def parse(page: str) -> Node:
    root = Node("#root", "", None)
    stack, at, n = [root], 0, len(page)
    low = None
    # Open elements beyond MAX_DEPTH, whose end tags close nothing else, and how many there are of each tag.
    deep: list[str] = []
    n_deep: Counter = Counter()
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if n_deep[tag]:
                last = ""
                while last != tag:
                    last = deep.pop()
                    n_deep[last] -= 1
                continue
            if tag == "p" and not any(x.tag == "p" for x in stack):
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # An inline end tag does not close the block that it stands in.
                if tag in INLINE and stack[k].tag in BLOCK and stack[k].tag != "p":
                    break
            continue
        if tag in _P_CLOSERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE or (stack[k].tag in BLOCK):
                    break
        if tag in CLOSES:
            closed, scope = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in scope:
                    break
                if stack[k].tag in closed:
                    del stack[k:]
                    if tag not in ("tr", "tbody"):
                        break
        token = ""
        if "=" in attributes:
            token = " ".join(html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(attributes) if a[0].lower() in ("class", "id", "role", "itemprop", "aria-label"))
            if re.search(r"\bhidden\b|display\s*:\s*none", attributes):
                token += " hidden"
        node = Node(tag, token, stack[-1])
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at) if len(low) == n else page.find(f"</{tag}", at)
            end = n if end < 0 else end
            if tag not in UNSEEN:
                node.children.append(page[at:end])
            close = page.find(">", end)
            at = n if close < 0 else close + 1
            continue
        if not attributes.endswith("/") or tag not in ("svg", "path", "g", "use"):
            if len(stack) < MAX_DEPTH:
                stack.append(node)
            else:
                deep.append(tag)
                n_deep[tag] += 1
    return root


def listed(root: Node) -> list[Node]:
    """Elements in page order, with the sums of their subtrees."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        x.index = len(order)
        order.append(x)
        todo += [c for c in reversed(x.children) if isinstance(c, Node) and c.tag not in UNSEEN]
    for x in reversed(order):
        length = linked = stops = 0
        blocks, elements = x.tag in BLOCK, 1
        for c in x.children:
            if isinstance(c, str):
                k = len(c) if not c.isspace() else 0
                length += k
                stops += c.count(".") + c.count(",") + c.count("!") + c.count("?") if k else 0
            elif c.tag not in UNSEEN:
                length, linked, stops, blocks, elements = length + c.length, linked + c.linked, stops + c.stops, blocks + c.blocks, elements + c.elements
        x.length, x.linked, x.stops, x.blocks, x.elements = length, length if x.tag == "a" else linked, stops, int(blocks), elements
    return order


def features(order: list[Node]) -> np.ndarray:
    out: list[list[float]] = []
    total = max(order[0].length, 1)
    n = len(order)
    position = 0
    #: Of each element's children: how many, how many of each tag, the two largest lengths.
    around: dict[int, tuple[int, Counter, int, int]] = {}
    for x in order:
        kids = [c for c in x.children if isinstance(c, Node) and c.tag not in UNSEEN]
        if kids:
            around[x.index] = (len(kids), Counter(c.tag for c in kids), *(heapq.nlargest(2, (c.length for c in kids)) + [0])[:2])
    for i, x in enumerate(order):
        p = x.parent
        row = [0.0] * FEATURES
        out.append(row)
        kind = KIND.get(x.tag, 19)
        row[kind] = 1
        token = x.token
        bad, good, comment = bool(token) and BAD.search(token) is not None, bool(token) and GOOD.search(token) is not None, bool(token) and COMMENT.search(token) is not None
        up = out[p.index] if p is not None else None
        bad |= "hidden" in token
        row[20], row[21], row[22] = bad, good, comment
        # What the ancestors are: inherited downwards.
        if up is not None:
            for f, own in ((23, bad), (24, good), (25, comment), (26, kind in (1,)), (27, kind == 2), (28, kind in (9, 10, 12, 13)), (29, kind == 11), (30, x.tag == "body")):
                row[f] = up[f] or own
            row[45] = KIND.get(p.tag, 19)
        row[31] = min(x.depth, 30)
        row[32] = math.log1p(x.length)
        row[33] = x.linked / max(x.length, 1)
        row[34] = x.length / x.elements
        row[35] = x.stops / (x.length + 20)
        row[36] = x.length / total
        row[37] = i / n
        row[38] = position / total
        n_siblings, tags, longest, next_longest = around[p.index] if p is not None else (1, {x.tag: 1}, x.length, 0)
        row[39] = math.log1p(n_siblings)
        row[40] = x.length / max(1, p.length if p is not None else x.length)
        row[41] = tags[x.tag] / n_siblings
        row[42] = math.log1p(x.blocks)
        row[43] = math.log1p(next_longest if x.length == longest else longest)
        row[44] = (p.linked / max(p.length, 1)) if p is not None else 0
        position += sum(len(c) for c in x.children if isinstance(c, str) and not c.isspace())
    return np.array(out, np.float32)


# Boosted trees -------------------------------------------------------------------------------


@dataclass
class Forest:
    """Trees of one depth as arrays: split feature, threshold, leaf value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = self.value.shape[1].bit_length() - 1
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Forest:
    """Gradient boosting on the logistic loss, with histograms over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    z = np.full(len(y), base)
    n_inner, n_leaves = 2**depth - 1, 2**depth
    features_, cuts_, values_ = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut, node = np.zeros(n_inner, np.int64), np.full(n_inner, np.inf), np.zeros(len(y), np.int64)
        for k in range(n_inner):
            own = np.flatnonzero(node == k)
            best = (1e-3, 0, np.inf)
            if len(own) >= 20:
                gs, hs = g[own], h[own]
                whole = gs.sum() ** 2 / (hs.sum() + 1)
                for j in range(x.shape[1]):
                    if not len(cuts[j]):
                        continue
                    b = binned[own, j]
                    gl = np.cumsum(np.bincount(b, gs, len(cuts[j]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, hs, len(cuts[j]) + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (gs.sum() - gl) ** 2 / (hs.sum() - hl + 1) - whole
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), j, float(cuts[j][i]))
            feature[k], cut[k] = best[1], best[2]
            node[own] = 2 * k + 1 + (x[own, best[1]] > best[2])
        leaf = node - n_inner
        value = -rate * np.bincount(leaf, g, n_leaves) / (np.bincount(leaf, h, n_leaves) + 1)
        z += value[leaf]
        features_.append(feature)
        cuts_.append(cut)
        values_.append(value)
    return Forest(np.stack(features_), np.stack(cuts_), np.stack(values_), base)


# Training pages ------------------------------------------------------------------------------


class _Maker:
    """Generated pages of many layouts; text inside ``\\x01``...``\\x02`` is main text."""

    SYLLABLES = "ba co den er fi gra hu in jo ka lu men no or pe qui ra so ter un ve wi xa yo zen st th".split()

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, n: int) -> str:
        r = self.r
        return " ".join("".join(r.choice(self.SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

    def sentence(self, a: int = 4, b: int = 22) -> str:
        return self.words(self.r.randint(a, b)).capitalize() + self.r.choice(".....!?")

    def prose(self, a: int = 1, b: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(a, b)))

    def tag(self, name: str, inner: str, token: str = "", kind: str = "class") -> str:
        return f'<{name}{f" {kind}={chr(34)}{token}{chr(34)}" if token else ""}>{inner}</{name}>'

    def link(self, n: int = 2) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{self.words(self.r.randint(1, n))}</a>'

    def menu(self) -> str:
        r = self.r
        items = "".join(f"<li>{self.link()}</li>" for _ in range(r.randint(3, 9)))
        inner = f"<ul>{items}</ul>"
        return r.choice([lambda: self.tag("nav", inner), lambda: self.tag("div", inner, r.choice(["nav", "menu", "navbar", "main-menu", "breadcrumb"])), lambda: self.tag("ul", items, r.choice(["menu", "nav", "links"])), lambda: self.tag("nav", " | ".join(self.link() for _ in range(r.randint(2, 6))))])()

    def junk(self) -> str:
        """Something that stands beside the article or in its flow and is no part of it."""
        r = self.r
        text = self.prose(1, 4)
        return r.choice([
            lambda: self.tag("div", text, r.choice(["ad", "ads", "advert", "sponsored", "banner", "promo"])),
            lambda: self.tag("aside", r.choice([text, self.tag("h3", self.words(2)) + "<ul>" + "".join(f"<li>{self.link(6)}</li>" for _ in range(r.randint(2, 6))) + "</ul>"]), r.choice(["", "sidebar", "related", "widget"])),
            lambda: self.tag("div", self.tag("p", text) + self.tag("button", self.words(1)), r.choice(["cookie", "cookie-notice", "notice", "consent", "popup", "alert"])),
            lambda: self.tag("form", self.tag("label", self.words(2)) + '<input type="text">' + self.tag("p", text) + self.tag("button", self.words(1)), r.choice(["", "search", "newsletter", "signup"])),
            lambda: self.tag("div", self.tag("h3", self.words(3)) + "".join(self.tag("p", self.link(8)) for _ in range(r.randint(2, 5))), r.choice(["related", "recommended", "more", "widget"])),
            lambda: self.tag("div", " ".join(self.link(1) for _ in range(r.randint(2, 5))), r.choice(["share", "social", "tags", "sharing"])),
            lambda: self.tag("div", self.link() + " &rsaquo; " + self.link(), "breadcrumbs"),
        ])()

    def comments(self) -> str:
        r = self.r
        one = lambda: self.tag(r.choice(["div", "li", "article"]), r.choice(["", self.tag("b", self.words(1))]) + self.tag("p", self.prose(1, 4)), r.choice(["comment", "comment-body", "reply", ""]))
        return self.tag(r.choice(["section", "div", "ol"]), r.choice(["", self.tag("h3", self.words(1))]) + "".join(one() for _ in range(r.randint(1, 6))), r.choice(["comments", "comment-list", "discussion", "responses"]), r.choice(["class", "id"]))

    def block(self) -> str:
        """A block of the article."""
        r = self.r
        m = lambda s: f"\x01{s}\x02"
        para = lambda: m(self.prose(1, 7) if r.random() < 0.8 else self.sentence(1, 5))
        kind = r.random()
        if kind < 0.55:
            return self.tag("p", para())
        if kind < 0.63:
            return self.tag("p", m(self.sentence()) + f'<a href="/x">{m(self.words(2))}</a>' + m(self.sentence()))
        if kind < 0.7:
            return self.tag(r.choice(["h2", "h3"]), m(self.words(r.randint(1, 8)).capitalize()))
        if kind < 0.77:
            return self.tag(r.choice(["ul", "ol"]), "".join(self.tag("li", m(self.sentence(2, 12))) for _ in range(r.randint(2, 6))))
        if kind < 0.82:
            return self.tag("blockquote", r.choice([para(), self.tag("p", para())]))
        if kind < 0.87:
            return f"<p><b>{para()}<br>"
        if kind < 0.91:
            return self.tag("div", para())
        if kind < 0.94:
            return self.tag("pre", m(self.words(12)))
        if kind < 0.97:
            return self.tag("table", "".join(self.tag("tr", "".join(self.tag("td", m(self.words(2))) for _ in range(3))) for _ in range(r.randint(2, 4))))
        return self.tag("figure", '<img src="/i.png">' + self.tag("figcaption", m(self.sentence())))

    def page(self) -> str:
        r = self.r
        title = self.words(r.randint(1, 9)).capitalize()
        head = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style></head><body>"
        body = "".join(self.block() if r.random() < 0.93 else self.junk() for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25])))
        top = r.choice([self.tag("h1", f"\x01{title}\x02"), self.tag("h1", f"\x01{title}\x02"), ""])
        inner = top + body
        article = r.choice([
            lambda: self.tag("article", inner, r.choice(["", "", "post", "article"])),
            lambda: self.tag("article", inner),
            lambda: self.tag("main", inner), lambda: self.tag("main", self.tag("article", inner)),
            lambda: self.tag("div", inner, r.choice(["content", "post", "entry-content", "article-body", "main", "story", "text"]), r.choice(["class", "id"])),
            lambda: self.tag("div", self.tag("div", inner), r.choice(["", "content", "wrapper"])),
            lambda: self.tag("section", inner, r.choice(["", "content"])),
        ])()
        parts = [self.menu() if r.random() < 0.85 else ""]
        if r.random() < 0.4:
            parts.insert(0, self.tag("header", r.choice([self.tag("h1", self.words(2)), self.tag("p", self.sentence()), self.link()]) + r.choice(["", self.menu()])))
        parts += [self.junk() for _ in range(r.choice([0, 1, 1, 2]))]
        parts.append(article)
        parts += [self.junk() for _ in range(r.choice([0, 0, 1, 2]))]
        if r.random() < 0.35:
            comments = self.comments()
            if r.random() < 0.3 and parts[-1].endswith("</article>"):
                parts[-1] = parts[-1][: -len("</article>")] + comments + "</article>"
            else:
                parts.append(comments)
        if r.random() < 0.85:
            parts.append(self.tag(*r.choice([("footer", "&copy; " + self.prose(1, 2)), ("div", "&copy; " + self.sentence() + self.link(), "footer"), ("footer", self.link() + self.link() + self.tag("p", self.sentence()))])))
        end = r.choice(["</body></html>", "</body></html>", ""])
        shell = r.choice([lambda x: x, lambda x: self.tag("div", x, "wrapper"), lambda x: self.tag("div", x)])
        return head + shell("".join(parts)) + end


def train(pages: int = TRAINING_PAGES, seed: int = SEED) -> Forest:
    """Trees from generated pages; an element is positive if most of its subtree's text is main text."""
    maker, xs, ys = _Maker(seed), [], []
    for _ in range(pages):
        order = listed(parse(maker.page()))
        good = np.zeros(len(order))
        for node in reversed(order):
            for c in node.children:
                if isinstance(c, str):
                    good[node.index] += len(c.strip()) if "\x01" in c else 0
                elif c.tag not in UNSEEN:
                    good[node.index] += good[c.index]
        held = np.array([n.length for n in order])
        own = held > 0
        xs.append(features(order)[own])
        ys.append((good > 0.5 * np.maximum(held, 1))[own])
    return boost(np.concatenate(xs), np.concatenate(ys).astype(float))


# Decoding ------------------------------------------------------------------------------------


def decode(order: list[Node], odds: np.ndarray) -> np.ndarray:
    """For each element whether its own text is main text.

    An element whose own text weighs w is worth w * log odds if kept. Per subtree the best of: keep
    all of it, drop all of it, or decide for each child (its own text going by its own log odds).
    """
    keep_all, best, choice = np.zeros(len(order)), np.zeros(len(order)), np.zeros(len(order), np.int8)
    for node in reversed(order):
        i = node.index
        own = sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace()) ** 0.5
        kids = [c.index for c in node.children if isinstance(c, Node) and c.tag not in UNSEEN]
        worth = own * odds[i]
        keep_all[i] = worth + sum(keep_all[k] for k in kids) + (odds[i] if kids else 0)
        mixed = max(worth, 0) + sum(max(0.0, best[k]) for k in kids) - (1.0 if kids else 0)
        best[i], choice[i] = max((0.0, 0), (keep_all[i], 1), (mixed, 2))
    kept = np.zeros(len(order), bool)
    todo = [(order[0], int(choice[0]))]
    while todo:
        node, what = todo.pop()
        if what == 0:
            continue
        kept[node.index] = what == 1 or odds[node.index] > 0
        todo += [(c, 1 if what == 1 else int(choice[c.index])) for c in node.children if isinstance(c, Node) and c.tag not in UNSEEN]
    return kept


def blocks(root: Node, kept: np.ndarray) -> list[str]:
    """Kept text in page order; block elements and line breaks end a block."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if line:
            text = WHITE.sub(" ", html.unescape("".join(line))).strip()
            if text:
                out.append(text)
            line.clear()

    todo: list[tuple[Node, int]] = [(root, 0)]
    while todo:
        node, at = todo.pop()
        if at == 0 and node.tag in BLOCK:
            end()
        for k in range(at, len(node.children)):
            c = node.children[k]
            if isinstance(c, str):
                if kept[node.index]:
                    line.append(c)
            elif c.tag == "br":
                line.append(" ")
            elif c.tag not in UNSEEN:
                todo += [(node, k + 1), (c, 0)]
                break
        else:
            if node.tag in BLOCK:
                end()
    end()
    return out


def extract_page(page: str, forest: Forest) -> str:
    root = parse(page)
    order = listed(root)
    return "\n\n".join(blocks(root, decode(order, forest.log_odds(features(order)))))


@with_plain_names
def extract(pages: DataFrame, forest: Forest | None = None) -> DataFrame:
    """``pages`` without html, with text and n_chars."""
    ship(pages.sparkSession)
    pages = without(pages, "text", "n_chars")
    forest = forest or train()
    names = [x for x in pages.columns if x != "html"]

    def run(batches):
        for batch in slices(batches, "html", 1 << 20):
            trees = [listed(parse(x or "")) for x in batch.column("html").to_pylist()]
            odds = forest.log_odds(np.concatenate([features(t) for t in trees]))
            ends = np.cumsum([len(t) for t in trees])
            texts = ["\n\n".join(blocks(t[0], decode(t, odds[e - len(t) : e]))) for t, e in zip(trees, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*names, "text", "n_chars"])

    return pages.mapInArrow(run, schema_of(pages, "text string, n_chars long", "html"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.col("n_chars"))

