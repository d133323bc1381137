"""HTML extraction: boosted trees over DOM nodes, with one consistent choice for the whole tree.

A page is parsed into a tree, in one pass; text that stands beside elements is a node like them. Each node gets features: its tag and those
above it, tokens of its class, id and role (by groups of words, and hashed), text and link density of its subtree, depth, and statistics of its
siblings. Boosted trees give the odds that a node belongs to the main text. Decoding picks, over the whole tree at once, which nodes are kept
or dropped with all that is below them and which are left to their children, so no ancestor contradicts a descendant; what it picks is the text. The trees learn
from pages that this module composes from a grammar of layouts (TRAINING_PAGES of them), for which the main text is known.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, in_batches

#: Size of the composed training sample, and of the model.
TRAINING_PAGES, TREES, DEPTH, RATE, BINS = 700, 60, 4, 0.2, 32
#: Below this odds' gain, an element is rather kept or dropped whole than split among its children.
SPLIT_COST = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript template svg math".split())
#: Elements whose text no reader sees as text of the page.
HIDDEN = frozenset("script style title xmp noembed noframes iframe noscript template svg math head select option button textarea object audio video canvas datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of the first kind ends an open element of the second, within the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: An attribute with its value: in quotes (to the end of the page, if they do not close), or up to white space or the tag's end.
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?""")
TELLING = frozenset("class id role itemprop aria-label data-role".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Open elements that are looked through for one that an opening tag ends.
LOOKED_AT = 256
#: Children that do not make the text beside them a node.
BREAKS = frozenset("br wbr img".split())
PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Words in class, id and role that speak for or against the main text.
GOOD = frozenset("article content main post entry body story text prose blog hentry page copy paragraph column".split())
BAD = frozenset(
    """ad ads advert advertisement advertising adsbygoogle werbung anzeige publicidad publicite reklame sponsor sponsored promo promotion banner nav navbar navigation menu sidebar side footer foot header head masthead
    comment comments reply replies respond discussion disqus cookie consent notice notification alert popup modal overlay newsletter subscribe signup login social share sharing
    related recommended widget breadcrumb breadcrumbs pagination pager toolbar tags meta search form rail outbrain taboola copyright legal skip hidden""".split()
)
GROUPS = (
    frozenset("ad ads advert advertisement advertising adsbygoogle werbung anzeige publicidad publicite reklame sponsor sponsored promo promotion banner outbrain taboola".split()),
    frozenset("nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar skip".split()),
    frozenset("comment comments reply replies respond discussion disqus".split()),
    frozenset("cookie consent notice notification alert popup modal overlay newsletter subscribe signup login".split()),
    frozenset("sidebar side rail widget related recommended social share sharing tags".split()),
    frozenset("footer foot header head masthead copyright legal".split()),
)
TAGS = ("#text", "p", "h1", "h2", "h3", "div", "section", "article", "main", "ul", "li", "table", "blockquote", "pre", "figure", "a", "span")
#: Tags that, above an element, tell where it stands.
PLACES = ("article", "main", "nav", "header", "footer", "aside", "form")


class Node:
    __slots__ = ("tag", "children", "tokens", "hidden")

    def __init__(self, tag: str):
        self.tag = tag
        #: Children in order, texts among them.
        self.children: list[Node | str] = []
        self.hidden = False
        self.tokens: set[str] = set()

    def told(self, name: str, value: str) -> None:
        name = name.lower()
        if name == "hidden":
            self.hidden = True
        elif name == "style":
            self.hidden |= bool(UNSEEN.search(value))
        elif name in TELLING:
            self.tokens.update(PARTS.findall(CAMEL.sub(" ", value).lower()))


class Open:
    """The open elements, innermost last."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.blocks = [root]
        #: How many blocks of each tag are open, and how many inline elements of each within the innermost block, and so on outwards.
        self.count: Counter[str] = Counter()
        self.inline: list[Counter[str]] = [Counter()]

    def push(self, node: Node) -> None:
        self.stack.append(node)
        if node.tag in INLINE:
            self.inline[-1][node.tag] += 1
        else:
            self.blocks.append(node)
            self.count[node.tag] += 1
            self.inline.append(Counter())

    def close(self, node: Node) -> None:
        """Ends node and all within it."""
        while True:
            last = self.stack.pop()
            if last.tag in INLINE:
                self.inline[-1][last.tag] -= 1
            else:
                self.blocks.pop()
                self.inline.pop()
                self.count[last.tag] -= 1
            if last is node:
                return

    def innermost(self, tag: str) -> Node | None:
        """The open element that an end tag ends: an inline one only within the innermost block."""
        if not (self.inline[-1] if tag in INLINE else self.count)[tag]:
            return None
        return next(x for x in reversed(self.stack if tag in INLINE else self.blocks) if x.tag == tag)


def parsed(page: str) -> Node:
    """The tree of a page, in time proportional to its length; unclosed and misnested tags are mended as far as the main text asks for."""
    root = Node("#root")
    open_ = Open(root)
    never: set[str] = set()  # tags of raw text that close nowhere from here on
    pos, n = 0, len(page)
    while pos < n:
        i = page.find("<", pos)
        if i < 0:
            i = n
        text, begin = i, pos
        # A "<" that opens nothing is text.
        m = NAME.match(page, i + 1 + (page.startswith("/", i + 1))) if i < n else None
        if i < n and m is None and page[i + 1 : i + 2] not in ("!", "?", "/"):
            open_.stack[-1].children.append(page[begin : i + 1])
            pos = i + 1
            continue
        if text > begin:
            open_.stack[-1].children.append(page[begin:text])
        if i == n:
            break
        if m is None:
            end = page.find("-->", i + 4) if page.startswith("<!--", i) else page.find(">", i)
            pos = n if end < 0 else end + (3 if page.startswith("<!--", i) else 1)
            continue
        tag, ends = m[0].lower(), page[i + 1] == "/"
        node = Node(tag)
        pos = m.end()
        slash = False
        while True:
            a = ATTRIBUTE.match(page, pos)
            if a is None:
                break
            pos = a.end()
            if not ends:
                node.told(a[1], a[2] or a[3] or a[4] or "")
        while pos < n and page[pos] != ">":
            slash = page[pos] == "/"
            pos += 1
        pos += 1
        if pos > n:
            break  # a tag that does not end is none
        if ends:
            up = open_.innermost(tag)
            if up is not None:
                open_.close(up)
            continue
        if tag in ENDS_P:
            if open_.blocks[-1].tag == "p":
                open_.close(open_.blocks[-1])
        elif tag in CLOSES:
            outer, within = CLOSES[tag]
            found = None
            for up in open_.blocks[: -LOOKED_AT - 1 : -1]:
                if up is root or up.tag in within:
                    break
                if up.tag in outer:
                    found = up
            if found is not None:
                open_.close(found)
        if tag == "html" and len(open_.stack) > 1:
            continue
        if tag == "body" and open_.stack[-1].tag == "head":
            open_.close(open_.stack[-1])
        open_.stack[-1].children.append(node)
        if tag in RAW:
            close = None if tag in never else re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(page, pos)
            if close is None:
                never.add(tag)
                if tag in ("svg", "math", "noscript", "template", "iframe", "title"):
                    continue
                pos = n
            else:
                if tag == "textarea":
                    node.children.append(page[pos : close.start()])
                pos = close.end()
            continue
        if tag in VOID or slash and tag not in INLINE and tag not in ENDS_P:
            continue
        open_.push(node)
    return root


def listed(root: Node) -> tuple[list[Node], list[int], list[list[int]]]:
    """(nodes in page order without hidden ones, parent numbers, children numbers); text beside elements becomes a node."""
    nodes, parent = [], []
    children: list[list[int]] = []
    stack = [(root, -1)]
    while stack:
        node, up = stack.pop()
        if node.tag in HIDDEN or node.hidden:
            continue
        k = len(nodes)
        nodes.append(node)
        parent.append(up)
        children.append([])
        if up >= 0:
            children[up].append(k)
        if any(isinstance(c, Node) and c.tag not in BREAKS for c in node.children):
            for i, c in enumerate(node.children):
                if isinstance(c, str) and not c.isspace():
                    node.children[i] = beside = Node("#text")
                    beside.children.append(c)
        stack.extend((c, k) for c in reversed(node.children) if isinstance(c, Node))
    return nodes, parent, children


#: Columns that hashed tokens fall into.
HASHED = 64


@functools.lru_cache(1 << 16)
def column_of(token: str) -> int:
    return zlib.crc32(token.encode()) % HASHED


def features(nodes: list[Node], parent: list[int], children: list[list[int]]) -> np.ndarray:
    n = len(nodes)
    text, link, words, tags, marks, paras = (np.zeros(n) for _ in range(6))
    own = np.zeros(n)
    for k, node in enumerate(nodes):
        s = 0
        for c in node.children:
            if isinstance(c, str):
                t = len(c.strip()) if c else 0
                s += t
                words[k] += c.count(" ") + 1 if t else 0
                marks[k] += c.count(".") + c.count(",")
        own[k] = text[k] = s
        paras[k] = node.tag == "p"
    tags += 1
    depth = np.zeros(n)
    inside = np.zeros((n, len(PLACES)))
    good, bad = np.zeros(n), np.zeros(n)
    good_up, bad_up = np.zeros(n), np.zeros(n)
    group = np.zeros((n, len(GROUPS)))
    hashed = np.zeros((n, HASHED))
    in_link = np.zeros(n, bool)
    for k, node in enumerate(nodes):
        up = parent[k]
        good[k], bad[k] = len(node.tokens & GOOD), len(node.tokens & BAD)
        for j, g in enumerate(GROUPS):
            group[k, j] = bool(node.tokens & g)
        for token in node.tokens:
            hashed[k, column_of(token)] = 1
        if up >= 0:
            depth[k] = depth[up] + 1
            inside[k] = inside[up]
            good_up[k], bad_up[k] = good_up[up], bad_up[up]
            group[k] = np.maximum(group[k], group[up])
            # What stands above counts for half.
            hashed[k] = np.maximum(hashed[k], (hashed[up] > 0) * 0.5)
            in_link[k] = in_link[up]
        good_up[k] += good[k]
        bad_up[k] += bad[k]
        if node.tag in PLACES:
            inside[k, PLACES.index(node.tag)] = 1
        if node.tag == "a":
            in_link[k] = True
        if in_link[k]:
            link[k] = own[k]
    for k in range(n - 1, 0, -1):
        up = parent[k]
        for a in (text, link, words, tags, marks, paras):
            a[up] += a[k]
    total = max(1.0, text[0])
    up = np.maximum(np.array(parent), 0)
    kids = np.array([len(c) for c in children], float)
    same, place, before, after = (np.zeros(n) for _ in range(4))
    for c in children:
        count: dict[str, int] = {}
        for i, k in enumerate(c):
            count[nodes[k].tag] = count.get(nodes[k].tag, 0) + 1
            place[k] = i / max(1, len(c) - 1) if len(c) > 1 else 0.5
            before[k] = text[c[i - 1]] if i else 0
            after[k] = text[c[i + 1]] if i + 1 < len(c) else 0
        for k in c:
            same[k] = count[nodes[k].tag]
    order = np.cumsum(own) / total
    cols = [
        np.log1p(text), np.log1p(own), link / np.maximum(1, text), text / tags, np.log1p(words), text / np.maximum(1, words), marks / np.maximum(1, words), text / total,
        text / np.maximum(1, text[up]), depth, kids, same, place, np.log1p(before), np.log1p(after), order, np.log1p(paras), paras / tags, good, bad, good_up, bad_up,
        link[up] / np.maximum(1, text[up]), text[up] / tags[up], np.log1p(tags), np.log1p(text[up]),
    ]
    cols += [np.array([x.tag == t for x in nodes], float) for t in TAGS]
    cols.append(np.array([x.tag in INLINE for x in nodes], float))
    return np.column_stack([*cols, inside, group, hashed])


class Boosted:
    """Gradient-boosted trees for a yes-or-no label, over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.edges = [self._edges(x[:, j]) for j in range(x.shape[1])]
        b = self.binned(x)
        self.base = float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p)
            tree = self._grown(b, g, h)
            self.trees.append(tree)
            score += self._values(tree, b)

    @staticmethod
    def _edges(v: np.ndarray) -> np.ndarray:
        """Between the values, if they are few; else at equal shares of the rows."""
        few = np.unique(v)
        return few[:-1] if len(few) < BINS else np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1]))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """(features x rows) the bin of each value."""
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def _grown(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        """A tree as arrays by node: feature, cut, value; the children of node k are 2k+1 and 2k+2."""
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        where = np.zeros(len(g), np.int64)
        for k in range(size):
            at = np.flatnonzero(where == k)
            if not len(at):
                continue
            gs, hs = g[at].sum(), h[at].sum()
            value[k] = RATE * gs / (hs + 1)
            if 2 * k + 2 >= size or len(at) < 20:
                continue
            best, gain0 = 1e-3, gs * gs / (hs + 1)
            here, ga, ha = b[:, at], g[at], h[at]
            for j in range(len(b)):
                if len(self.edges[j]) == 0:
                    continue
                gl = np.cumsum(np.bincount(here[j], weights=ga, minlength=BINS))[:-1]
                hl = np.cumsum(np.bincount(here[j], weights=ha, minlength=BINS))[:-1]
                ok = (hl > 1) & (hs - hl > 1)
                gain = np.where(ok, gl * gl / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gain0, -1)
                i = int(np.argmax(gain))
                if gain[i] > best:
                    best, feature[k], cut[k] = gain[i], j, i
            if feature[k] >= 0:
                where[at] = 2 * k + 1 + (here[feature[k]] > cut[k])
        return feature, cut, value

    @staticmethod
    def _values(tree, b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        rows = np.arange(b.shape[1])
        at = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            f = feature[at]
            go = f >= 0
            at = np.where(go, 2 * at + 1 + (b[np.maximum(f, 0), rows] > cut[at]), at)
        return value[at]

    def odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.base + sum(self._values(t, b) for t in self.trees)


def decoded(odds: np.ndarray, children: list[list[int]]) -> np.ndarray:
    """Whether each element is kept: the choice of highest total, in which all below a kept or dropped element follows it."""
    n = len(odds)
    keep, drop, best = odds.copy(), -odds, np.zeros(n)
    for k in range(n - 1, -1, -1):
        mixed = -SPLIT_COST
        for c in children[k]:
            keep[k] += keep[c]
            drop[k] += drop[c]
            mixed += best[c]
        best[k] = max(keep[k], drop[k], mixed) if children[k] else max(keep[k], drop[k])
    out = np.zeros(n, bool)
    stack = [0]
    while stack:
        k = stack.pop()
        if children[k] and best[k] > max(keep[k], drop[k]):
            stack.extend(children[k])
            continue
        if keep[k] >= drop[k]:
            below = [k]
            while below:
                i = below.pop()
                out[i] = True
                below.extend(children[i])
    return out


def main_text(nodes: list[Node], kept: np.ndarray) -> str:
    """The kept text: references decoded, white space in a block one blank, blocks joined by an empty line."""
    blocks: list[str] = []
    run: list[str] = []
    number = {id(x): k for k, x in enumerate(nodes)}

    def end() -> None:
        if run:
            s = " ".join(entities.unescape("".join(run)).split())
            if s:
                blocks.append(s)
            run.clear()

    stack: list = [nodes[0]]
    while stack:
        x = stack.pop()
        if x is None:
            end()
            continue
        if isinstance(x, str):
            run.append(x)
            continue
        k = number.get(id(x))
        if k is None:
            continue
        if x.tag not in INLINE and x.tag != "#text":
            end()
            stack.append(None)
        if x.tag == "br":
            run.append(" ")
        # Blanks between elements part words, whoever holds them.
        stack.extend(c for c in reversed(x.children) if isinstance(c, Node) or kept[k] or c.isspace())
    end()
    return "\n\n".join(blocks)


# Composed pages: layouts whose main text is known.

_SYLLABLES = "ba co di fe gu ha li mo nu pe ra so ti ve an er is on ur est ing ly ment tion ard ous".split()


#: What can stand between words: references, and runs of signs.
_SIGNS = [f" {x} " for x in "&amp; &mdash; &lt; &#8217; &nbsp; &eacute; | * ** -- / + = ~ # ## ### % %% $ @ ( ) [ ] { } ; : < 3<4".split()]


def _word(r: random.Random) -> str:
    return "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))


def _sentence(r: random.Random, low: int = 2, high: int = 18) -> str:
    return " ".join(_word(r) for _ in range(r.randint(low, high))).capitalize() + r.choice([".", ".", ".", "?", "!", "..."])


def _paragraph(r: random.Random) -> str:
    s = " ".join(_sentence(r) for _ in range(r.choice([1, 1, 2, 3, 5, 8])))
    if r.random() < 0.15:
        s = re.sub(r" ", lambda m: r.choice([" ", " ", r.choice(_SIGNS)]), s)
    if r.random() < 0.2:
        w = s.split(" ")
        i = r.randrange(len(w))
        w[i] = r.choice(["<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<strong>{}</strong>", "<code>{}</code>"]).format(w[i])
        s = " ".join(w)
    if r.random() < 0.05:
        t = r.choice("b i em strong span u small".split())
        s = f"<{t}>{s}" + r.choice(["", "<br>", f"</{t}>"])
    return s


def _advert_within(r: random.Random) -> str:
    """An advert amid the words of a paragraph."""
    t = r.choice("a a span ins em".split())
    return f' <{t} class="{r.choice(_ADVERTS)}" {_OTHER}>{" ".join(_word(r) for _ in range(r.randint(1, 8)))}</{t}> '


def _links(r: random.Random, low: int = 3, high: int = 9) -> str:
    return "<ul>" + "".join(f'<li><a href="/{_word(r)}">{" ".join(_word(r) for _ in range(r.randint(1, 3)))}</a></li>' for _ in range(r.randint(low, high))) + "</ul>"


#: Marks of a composed page: all of an element, none of it, the text that stands loose in it.
_MAIN, _OTHER, _LOOSE = "data-role=zzmain", "data-role=zzother", "data-role=zzloose"
_ADVERTS = ["ad", "ads", "advert", "banner-ad", "ad banner", "sponsored", "promo", "ad-slot", "advertisement", "adsbygoogle", "werbung", "anzeige", "publicidad", "publicite", "reklame", "partner-link"]


def composed(r: random.Random) -> str:
    """A page; elements that are main text whole carry one mark, those that are none of it another."""

    def other(tag: str, names: list[str], body: str, always: bool = False) -> str:
        called = f"{_word(r)}-{r.randint(1, 99)}" if r.random() < 0.08 else r.choice(names) if names else ""
        name = f' {r.choice(["class", "class", "id"])}="{called}"' if names and (always or r.random() < 0.85) else ""
        return f"<{tag}{name} {_OTHER}>{body}</{tag}>"

    def short(low: int = 1, high: int = 2) -> str:
        return " ".join(_sentence(r, 2, 12) for _ in range(r.randint(low, high)))

    def advert() -> str:
        return other(r.choice(["div", "div", "aside", "section", "p"]), _ADVERTS, short() if r.random() < 0.8 else f"<p>{short()}</p>", True)

    def comments() -> str:
        each = "".join(f'<{t} class="{r.choice(["comment", "reply", "comment-body"])}"><p>{_paragraph(r)}</p></{t}>' for t in [r.choice(["div", "li", "article"])] for _ in range(r.randint(1, 5)))
        return other(r.choice(["section", "div", "ol"]), ["comments", "comment-list", "respond", "discussion", "user-comments"], (f"<h3>{r.choice(['Comments', 'Replies', short(1, 1)])}</h3>" if r.random() < 0.6 else "") + each, True)

    def notice() -> str:
        return other("div", ["cookie-notice", "notice", "consent", "alert", "newsletter", "subscribe-box", "popup"], f"<p>{short()}</p>" if r.random() < 0.5 else short(), True)

    def side() -> str:
        body = "".join(r.choice([f"<h3>{short(1, 1)}</h3>{_links(r)}", f"<p>{_paragraph(r)}</p>", _links(r)]) for _ in range(r.randint(1, 3)))
        return other(r.choice(["aside", "aside", "div"]), ["sidebar", "related", "widget", "side-bar", "recommended"], body, True) if r.random() < 0.8 else f"<aside {_OTHER}>{body}</aside>"

    def form() -> str:
        return f'<form action="/s" {_OTHER}><label>{short(1, 1)}</label><input name="q"><button>{_word(r)}</button></form>'

    def block() -> str:
        kind = r.random()
        if kind < 0.72:
            return f"<p {_MAIN}>{_paragraph(r)}</p>"
        if kind < 0.82:
            t = r.choice(["h2", "h3", "h4"])
            return f"<{t} {_MAIN}>{' '.join(_word(r) for _ in range(r.randint(1, 7)))}</{t}>"
        if kind < 0.88:
            t = r.choice(["ul", "ol"])
            return f"<{t} {_MAIN}>" + "".join(f"<li>{_paragraph(r)}</li>" for _ in range(r.randint(1, 5))) + f"</{t}>"
        if kind < 0.92:
            return f"<blockquote {_MAIN}><p>{_paragraph(r)}</p></blockquote>"
        if kind < 0.935:
            return f"<pre {_MAIN}>{_paragraph(r)}</pre>"
        if kind < 0.945:
            return f"<table {_MAIN}>" + "".join(f"<tr><td>{_word(r)}</td><td>{_sentence(r)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if kind < 0.955:
            return f"<p {_MAIN}><b>{_paragraph(r)}<br>"
        return f"<p {_LOOSE}>{_paragraph(r)}{_advert_within(r)}{_paragraph(r)}</p>"

    def loose() -> str:
        """Text without elements of its own, parted by line breaks, adverts and blocks."""
        out = [_paragraph(r)]
        for _ in range(r.randint(1, 5)):
            out.append(r.choice(["<br>", "<br><br>", " "]) if r.random() < 0.5 else r.choice([advert, advert, block, notice, lambda: _advert_within(r)])())
            out.append(_paragraph(r))
        return "".join(out)

    title = " ".join(_word(r) for _ in range(r.randint(1, 10)))
    body = [block() for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 14]))]
    if r.random() < 0.35:
        body.insert(0, f"<p {_MAIN}><b>{_paragraph(r)}<br>")
    if not body:
        body = [f"<p {_MAIN}>{_paragraph(r)}</p>"]
    inside = list(body)
    whole = True
    if r.random() < 0.15:
        inside = [loose()] if r.random() < 0.6 else [*inside, loose()]
        whole = False
    for piece, chance in ((advert, 0.2), (side, 0.08), (form, 0.05), (comments, 0.1), (notice, 0.06)):
        if r.random() < chance:
            inside.insert(len(inside) if piece is comments else r.randint(0, len(inside)), piece())
            whole = False
    if r.random() < 0.1:
        inside.append(other("div", ["share", "social-share", "tags", "post-meta"], _links(r, 2, 4), True))
        whole = False
    head = f"<h1 {_MAIN}>{title}</h1>" if r.random() < 0.85 else ""
    mark = _MAIN if whole and _LOOSE not in "".join(inside) else _LOOSE
    kind = r.random()
    if kind < 0.5:
        main = f"<article {mark}>{head}{''.join(inside)}</article>"
    elif kind < 0.7:
        main = f"<main>{f'<article {mark}>' if r.random() < 0.5 else f'<div {mark}>'}{head}{''.join(inside)}</div></main>"
    elif kind < 0.9:
        name = r.choice(["content", "post", "entry-content", "article-body", "main", "story", "post-content", "page-body", f"{_word(r)}-{r.randint(1, 99)}", "inhalt", "contenu"])
        main = f'<div {r.choice(["class", "id"])}="{name}" {mark}>{head}{"".join(inside)}</div>'
    else:
        main = f"<div {mark}>{head}{''.join(inside)}</div>"
    nav = [other("nav", ["nav", "menu", "main-nav", "navbar", ""], _links(r)) if r.random() < 0.8 else other("div", ["nav", "menu", "top-menu", "breadcrumbs"], _links(r), True) for _ in range(r.choice([0, 1, 1, 1, 2]))]
    if r.random() < 0.4:
        nav.insert(0, other("header", ["header", "site-header", "masthead"], f"<h1>{short(1, 1)}</h1>" if r.random() < 0.3 else f"<a href='/'>{_word(r)}</a> {short(1, 1)}"))
    before = [x() for x, c in ((advert, 0.55), (notice, 0.2), (form, 0.12), (side, 0.12)) if r.random() < c]
    after = [x() for x, c in ((advert, 0.15), (side, 0.25), (comments, 0.22), (form, 0.1), (notice, 0.12)) if r.random() < c]
    foot = other("footer", ["footer", "site-footer", ""], f"&copy; {_word(r)}.example.com &middot; {short()}" if r.random() < 0.6 else f"<p>{short()}</p>{_links(r, 2, 5)}") if r.random() < 0.85 else other("div", ["footer", "copyright", "legal"], short(), True)
    if r.random() < 0.3:
        before, nav = nav, before
    page = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
    page += "".join(nav) + "".join(before) + main + "".join(after) + foot
    return page + ("</body></html>" if r.random() < 0.9 else "")


def labels(nodes: list[Node], parent: list[int]) -> np.ndarray:
    """1 for nodes of a composed page that are main text with all below them, 0 for those that are none of it, NaN for others; the marks go."""
    label = np.full(len(nodes), np.nan)
    for k, x in enumerate(nodes):
        if "zzmain" in x.tokens:
            label[k] = 1
        elif "zzother" in x.tokens:
            label[k] = 0
        elif parent[k] >= 0 and not np.isnan(label[parent[k]]):
            label[k] = label[parent[k]]
        elif parent[k] >= 0 and "zzloose" in nodes[parent[k]].tokens and (x.tag == "#text" or x.tag in INLINE):
            label[k] = 1
    for x in nodes:
        x.tokens -= {"zzmain", "zzother", "zzloose"}
    return label


@functools.lru_cache(4)
def trained(pages: int = TRAINING_PAGES, seed: int = 4) -> Boosted:
    """Trees that learned from composed pages; once for each sample in a driver's life."""
    r = random.Random(seed)
    xs, ys, ws = [], [], []
    for _ in range(pages):
        nodes, parent, children = listed(parsed(composed(r)))
        label = labels(nodes, parent)
        x = features(nodes, parent, children)
        known = ~np.isnan(label)
        xs.append(x[known])
        ys.append(label[known])
        ws.append(np.full(known.sum(), 1 / np.sqrt(max(1, known.sum()))))
    w = np.concatenate(ws)
    return Boosted(np.concatenate(xs), np.concatenate(ys), w / w.mean())


def texts_of(model: Boosted, pages: list[str]) -> list[str]:
    trees = [listed(parsed(p)) for p in pages]
    if not trees:
        return []
    x = [features(*t) for t in trees]
    odds = model.odds(np.concatenate(x))
    out, at = [], 0
    for nodes, _, children in trees:
        part = odds[at : at + len(nodes)]
        at += len(nodes)
        out.append(main_text(nodes, decoded(part, children)) if len(nodes) > 1 else main_text(nodes, np.ones(1, bool)))
    return out


def extracted(pages: DataFrame, model: Boosted | None = None, batch_bytes: int = 1 << 19) -> DataFrame:
    """(page_id, url, text, n_chars) of every page (page_id, url, html).

    A null html is empty, and so is its text. Markup-free html is text. Rows stay one to one, repeated ones too;
    other columns are not read. Pages of any length are parsed in time proportional to it.
    """
    spark = pages.sparkSession
    sent = spark.sparkContext.broadcast(model or trained())

    def run(batches):
        for t in gathered(batches, batch_bytes, "html"):
            texts = texts_of(sent.value, t.column("html").to_pylist())
            cols = [t.column("page_id").combine_chunks(), t.column("url").combine_chunks(), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return in_batches(rows, run, "page_id long, url string, text string, n_chars long")
