"""Main text of web pages by a tree-structured graphical model.

A page is read into a tree of blocks: every block element is a node, and so is
every run of inline text (a leaf).  A node is content or not; the joint model has
a potential for each node (a log-linear function of its tag, its class and id
words, its length and its share of links) and one for each parent-child pair (a
2 x 2 table by the kind of the child).  The graph is a tree, so one pass of
sum-product messages up and one down give every node's exact marginal; leaves
with a marginal of one half or more are the main text.

The weights are fitted by gradient ascent on the likelihood of labelled pages,
whose gradient is the observed less the expected counts under the same marginals.
Labelled pages are HTML with ``data-label="content"`` or ``"other"`` on elements
(it holds for what is inside, too); :func:`labelled_pages` writes them from a
grammar of layouts, ``ModelRules.pages`` of them, a bounded sample; users may pass
their own.

The trees of a batch of pages are one forest, whose messages are passed level by
level.  Pages are narrow rows: no shuffle, nothing but the weights is broadcast.

Results in the odd cases: a null or empty page has an empty text; character
references are decoded and white space (Unicode's) is one blank; a line break
tag is white space; an unclosed comment, script or tag reaches to the page's end;
nesting of any depth and pages of any length are read whole (a page is one row,
so at most what Spark puts in one); repeated rows each have their result; an empty
table gives no rows; extra columns are not passed on.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class ModelRules:
    #: labelled pages written for training, and their seed
    pages: int = 800
    seed: int = 12
    #: gradient steps, their first length, and the pull towards zero
    steps: int = 200
    rate: float = 0.1
    decay: float = 0.02
    #: characters of pages whose trees are one forest
    forest: int = 4_000_000


# ---------------------------------------------------------------- reading a page
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
                  r"|<([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|(\S*)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: fixed values of HTML: elements without content, with raw text, and those that stand in a line
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes template svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr label".split())
#: what an open element ends for, and where the search for it stops
ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}, "thead": {"thead", "tbody", "tfoot"}, "tbody": {"thead", "tbody", "tfoot"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "p": {"td", "th", "table", "caption", "button"}}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
NAMED = ("class", "id", "role", "itemprop")


class Tree:
    """Nodes in page order: parents come before children.  ``text`` is None for an
    element; ``label`` is 1, 0 or -1 (not said)."""

    def __init__(self):
        self.parent, self.tag, self.words, self.text, self.links, self.label = [-1], ["html"], [()], [None], [0], [-1]

    def add(self, parent: int, tag: str, words=(), text=None, links: int = 0, label: int = -1) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.links.append(links)
        self.label.append(label)
        return len(self.tag) - 1


def _attributes(source: str) -> tuple[tuple, int]:
    words, label = [], -1
    for name, *values in _ATTRIBUTE.findall(source):
        name = name.lower()
        if name in NAMED:
            words += [w.lower() for w in _WORD.findall(next((v for v in values if v), ""))]
        elif name == "hidden":
            words.append("hidden")
        elif name == "data-label":
            label = int("content" in values)
    return tuple(words), label


def read_page(source: str) -> Tree:
    tree = Tree()
    # open elements: (tag, node of the nearest block, label)
    open_ = [("html", 0, -1)]
    pieces, links, anchors, at = [], 0, 0, 0

    def flush():
        nonlocal links
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                tree.add(open_[-1][1], tree.tag[open_[-1][1]], (), text, min(links, len(text)), open_[-1][2])
            pieces.clear()
            links = 0

    def close(upto: int):
        nonlocal anchors
        for tag, *_ in open_[upto:]:
            anchors -= tag == "a"
        del open_[upto:]

    def find(tags, stops=(), inline: bool = False):
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] in tags:
                return k
            if open_[k][0] in stops or inline and open_[k][0] not in INLINE:
                return 0
        return 0

    while m := _TAG.search(source, at):
        if m.start() > at:
            pieces.append(source[at:m.start()])
            links += (m.start() - at) * (anchors > 0)
        at = m.end()
        end, start = m[1], m[2]
        if end:
            tag = end.lower()
            if tag in INLINE:
                k = find((tag,), inline=True)
                if k:
                    close(k)
            elif tag == "br":
                pieces.append(" ")
            else:
                k = find((tag,))
                if k:
                    flush()
                    close(k)
        elif start:
            tag = start.lower()
            if tag in RAW:
                # a raw element is no text; its end is the page's where it is not closed
                done = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = len(source) if done is None else done.end()
                continue
            if tag == "br" or tag == "img":
                pieces.append(" ")
                continue
            if tag in INLINE:
                if tag == "a":
                    anchors += 1
                label = _attributes(m[3])[1] if "data-label" in m[3] else -1
                open_.append((tag, open_[-1][1], open_[-1][2] if label < 0 else label))
                continue
            if tag in ("html", "body", "head"):
                flush()
                continue
            flush()
            k = find(("p",), STOPS["p"])
            if k:
                close(k)
            if tag in HEADINGS and open_[-1][0] in HEADINGS:
                close(len(open_) - 1)
            if tag in ENDED:
                k = find(ENDED[tag], STOPS[tag])
                if k:
                    close(k)
            words, label = _attributes(m[3]) if m[3] else ((), -1)
            label = open_[-1][2] if label < 0 else label
            if tag in VOID:
                continue
            node = tree.add(open_[-1][1], tag, words, None, 0, label)
            open_.append((tag, node, label))
    if at < len(source):
        pieces.append(source[at:])
        links += (len(source) - at) * (anchors > 0)
    flush()
    return tree


# ---------------------------------------------------------------- features
#: kinds of children, each with its own pair potential; other tags share the last
KINDS = {tag: k for k, tag in enumerate(
    "leaf div section article main p li ul ol h1 h2 h3 h4 h5 h6 td tr table tbody blockquote figure figcaption pre dl dt dd "
    "header nav footer aside form ins dialog noscript button select option center details summary".split())}
OTHER_KIND = len(KINDS)
#: log potential of what cannot be
NEVER = -30.0


def _size(n: int) -> int:
    """Doubling steps of a length; all from 512 characters on are long."""
    return min(10, n.bit_length())


def node_features(tree: Tree, known=None) -> list[list[str]]:
    """Names of what holds for each node: its own tag, words, length and links, and
    the tags and words of what it stands in (of ``known`` ones, where given)."""
    n = len(tree.tag)
    length, links, leaves = [0] * n, list(tree.links), [0] * n
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            length[i], leaves[i] = len(tree.text[i]), 1
        if i:
            p = tree.parent[i]
            length[p] += length[i]
            links[p] += links[i]
            leaves[p] += leaves[i]
    total = max(1, length[0])
    out, around = [], [frozenset()] * n
    for i in range(n):
        share = 10 * links[i] // max(1, length[i])
        text, tag = tree.text[i], tree.tag[i]
        above = around[tree.parent[i]] if i else frozenset()
        if text is None:
            own = [f"tag {tag}", f"links {share}", f"mean {_size(length[i] // max(1, leaves[i]))}", f"of page {10 * length[i] // total}"]
            own += [f"word {w}" for w in tree.words[i]]
            here = [x for x in (f"inside tag {tag}", *[f"inside word {w}" for w in tree.words[i]]) if x not in above]
            here = [x for x in here if known is None or x in known]
            around[i] = above.union(here) if here else above
        else:
            own = [f"in {tag}", f"text links {share}", f"length {_size(len(text))}",
                   "ends as a sentence" if text[-1] in ".!?…\"”»" else "ends otherwise"]
            if "©" in text:
                own.append("copyright")
        out.append(own + list(above))
    return out


class Forest:
    """Trees side by side, as arrays: parents, kinds, features and levels."""

    def __init__(self, trees: list[Tree], index: dict[str, int], grow: bool = False):
        parents, kinds, rows, cols, self.first = [], [], [], [], []
        for tree in trees:
            base = len(parents)
            self.first.append(base)
            parents += [p + base if p >= 0 else -1 for p in tree.parent]
            kinds += [KINDS["leaf"] if x is not None else KINDS.get(t, OTHER_KIND) for t, x in zip(tree.tag, tree.text)]
            for i, names in enumerate(node_features(tree, None if grow else index)):
                for name in names:
                    k = index.setdefault(name, len(index)) if grow else index.get(name, -1)
                    if k >= 0:
                        rows.append(base + i)
                        cols.append(k)
        self.n = len(parents)
        self.parent, self.kind = np.array(parents, np.int64), np.array(kinds, np.int64)
        self.rows, self.cols = np.array(rows, np.int64), np.array(cols, np.int64)
        depth = np.zeros(self.n, np.int64)
        for i, p in enumerate(parents):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.lexsort((self.parent, depth))
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if self.n else []
        # the children of one parent stand together in their level
        self.families = [np.flatnonzero(np.r_[True, np.diff(self.parent[level]) != 0]) for level in self.levels]

    def unary(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.cols], self.n)


def marginals(forest: Forest, unary: np.ndarray, pair: np.ndarray):
    """Sum-product: ``P(node is content)``, and the joint of every node with its parent
    as (n, parent's state, own state).  ``unary`` is the log-odds of each node alone,
    ``pair`` (kinds, parent's state, own state) the logs of the pair potentials."""
    n, parent = forest.n, forest.parent
    up = np.zeros((n, 2))
    up[:, 1] = unary
    edge = pair[forest.kind]
    sent = np.zeros((n, 2))  # to the parent
    for level, family in zip(forest.levels[:0:-1], forest.families[:0:-1]):
        sent[level] = np.logaddexp(edge[level, :, 0] + up[level, None, 0], edge[level, :, 1] + up[level, None, 1])
        up[parent[level[family]]] += np.add.reduceat(sent[level], family)
    full, rest = up.copy(), np.zeros((n, 2))
    for level in forest.levels[1:]:
        rest[level] = full[parent[level]] - sent[level]
        down = np.logaddexp(edge[level, 0] + rest[level, 0, None], edge[level, 1] + rest[level, 1, None])
        full[level] += down
    joint = rest[:, :, None] + edge + up[:, None, :]
    joint -= joint.max(axis=(1, 2), keepdims=True)
    np.exp(joint, out=joint)
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return 1.0 / (1.0 + np.exp(np.clip(full[:, 0] - full[:, 1], -700, 700))), joint


# ---------------------------------------------------------------- training
def node_labels(tree: Tree) -> np.ndarray:
    """1 for content leaves and for the elements that hold one."""
    out = np.array([x is not None and l == 1 for x, l in zip(tree.text, tree.label)], float)
    for i in range(len(out) - 1, 0, -1):
        if out[i]:
            out[tree.parent[i]] = 1.0
    return out


def train(pages: list[str], rules: ModelRules = ModelRules()):
    """``(feature index, weights, pair)`` from labelled pages, a bounded sample."""
    trees, index = [read_page(p) for p in pages], {}
    forest = Forest(trees, index, grow=True)
    y = np.concatenate([node_labels(t) for t in trees])
    inner = np.flatnonzero(forest.parent >= 0)
    kinds, above = forest.kind[inner], y[forest.parent[inner]].astype(int)
    shape = (OTHER_KIND + 1, 2, 2)
    seen = np.bincount(kinds * 4 + above * 2 + y[inner].astype(int), minlength=4 * shape[0]).reshape(shape).astype(float)
    observed = np.bincount(forest.cols, y[forest.rows], len(index))
    split = len(index)
    theta = np.zeros(split + seen.size)
    theta[split:].reshape(-1, 4)[:, 1] = NEVER
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rules.steps + 1):
        p, joint = marginals(forest, forest.unary(theta[:split]), theta[split:].reshape(shape))
        expected = np.stack([np.bincount(kinds, joint[inner, a, b], shape[0]) for a in (0, 1) for b in (0, 1)], 1)
        g = np.r_[observed - np.bincount(forest.cols, p[forest.rows], split), (seen.reshape(-1, 4) - expected).ravel()] - rules.decay * theta
        g[split:].reshape(-1, 4)[:, 1] = 0.0  # what holds no content has no part that does
        # steps of one length for every weight, whatever its counts (Adam)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        theta += rules.rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    w, pair = theta[:split], theta[split:].reshape(shape)
    return index, w, pair


# ---------------------------------------------------------------- labelled pages
#: fixed words of class and id attributes, by part of a page
PARTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs links topbar pagination pager tabs toc",
    "header": "header masthead banner branding logo top title-bar",
    "footer": "footer bottom copyright colophon legal credits imprint",
    "sidebar": "sidebar aside related widget recommended popular rail teaser more trending latest tags",
    "notice": "notice cookie consent gdpr popup modal overlay alert message privacy banner hidden",
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion adsense commercial",
    "form": "form search newsletter subscribe login signup contact register",
    "comments": "comments comment reply replies discussion respond commentlist feedback disqus reactions",
    "share": "share social sharing follow meta buttons",
}
CONTENT_WORDS = "content article post entry main story body text page single prose maincontent articlebody".split()
PLAIN_WORDS = "container wrap wrapper row col inner outer site layout box block grid section root app".split()
PART_TAGS = {"menu": ("nav", "div", "ul", "nav"), "header": ("header", "div", "header"), "footer": ("footer", "div", "footer"),
             "sidebar": ("aside", "div", "section", "aside"), "notice": ("div", "section", "dialog", "noscript"),
             "advert": ("div", "aside", "div", "section"), "form": ("form", "div", "form"),
             "comments": ("section", "div", "ol", "ul"), "share": ("div", "ul", "section")}
#: parts whose tag alone says what they are
TELLING = {"nav", "header", "footer", "aside", "form", "dialog", "noscript"}
LETTERS = "etaoinshrdlucmfwypvbgkéüñçßàö"


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng
        often = range(len(LETTERS), 0, -1)
        self.lexicon = ["".join(rng.choices(LETTERS, weights=often, k=rng.randint(1, 11))) for _ in range(2000)]

    def words(self, least: int, most: int, stop: bool = True) -> str:
        r = self.rng
        text = " ".join(r.choices(self.lexicon, k=r.randint(least, most)))
        return text[:1].upper() + text[1:] + (r.choice(".....!?") if stop else "")

    def sentences(self, least: int, most: int) -> str:
        return " ".join(self.words(2, 22) for _ in range(self.rng.randint(least, most)))

    def inline(self, text: str) -> str:
        """Some words of a text in line elements."""
        r = self.rng
        if r.random() < 0.3:
            words = text.split(" ")
            i = r.randrange(len(words))
            tag = r.choice(("b", "i", "em", "strong", "span", "a", "code"))
            words[i] = f"<{tag}{' href=/x' if tag == 'a' else ''}>{words[i]}</{tag}>"
            text = " ".join(words)
        return text

    def named(self, words) -> str:
        r = self.rng
        name = r.choice(words)
        if r.random() < 0.3:
            name = f"{r.choice(PLAIN_WORDS)}-{name}" if r.random() < 0.5 else f"{name}-{r.choice(PLAIN_WORDS)}"
        return f' {r.choice(("class", "class", "id"))}="{name}"'

    def part(self, kind: str) -> str:
        r = self.rng
        tag = r.choice(PART_TAGS[kind])
        name = self.named(PARTS[kind].split()) if tag not in TELLING or r.random() < 0.6 else ""
        inside = getattr(self, "in_" + kind)(tag)
        return f'<{tag}{name} data-label="other">{inside}</{tag}>'

    def link_list(self, tag: str, least: int, most: int, words: int = 3) -> str:
        items = [f'<a href="/{k}">{self.words(1, words, False)}</a>' for k in range(self.rng.randint(least, most))]
        if tag in ("ul", "ol"):
            return "".join(f"<li>{x}</li>" for x in items)
        return self.rng.choice(("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items)))

    def in_menu(self, tag):
        return self.link_list(tag, 2, 9)

    def in_header(self, tag):
        r = self.rng
        name = self.words(1, 4, False)
        return r.choice((f'<a href="/">{name}</a>', f"<h1>{name}</h1>", f"<p>{name}</p>", name)) + r.choice(("", f"<p>{self.words(2, 9)}</p>"))

    def in_footer(self, tag):
        r = self.rng
        line = r.choice(("&copy; ", "© ", "Copyright ", "")) + self.words(1, 4, False) + r.choice((" &middot; ", " - ", " ")) + self.words(2, 20)
        return r.choice((line, f"<p>{line}</p>", f"<p>{line}</p>" + self.link_list("div", 2, 6)))

    def in_sidebar(self, tag):
        r = self.rng
        return r.choice(("", f"<h3>{self.words(1, 4, False)}</h3>")) + r.choice(
            (self.link_list("div", 2, 8, 9), f"<p>{self.sentences(1, 3)}</p>", self.link_list("div", 1, 4, 6) + f"<p>{self.sentences(1, 2)}</p>"))

    def in_notice(self, tag):
        r = self.rng
        text = self.sentences(1, 4)
        return r.choice((text, f"<p>{text}</p>")) + r.choice(("", f"<button>{self.words(1, 2, False)}</button>", f'<a href="/p">{self.words(1, 3, False)}</a>'))

    def in_advert(self, tag):
        text = self.sentences(1, 3)
        return self.rng.choice((text, f"<p>{text}</p>", f'<a href="http://x">{text}</a>', f'<a href="/a">{self.words(1, 5, False)}</a><p>{text}</p>'))

    def in_form(self, tag):
        r = self.rng
        return "".join(r.choice((f"<label>{self.words(1, 3, False)}</label><input name=q>", f"<p>{self.words(2, 12)}</p>",
                                 f"<select><option>{self.words(1, 1, False)}<option>{self.words(1, 2, False)}</select>")) for _ in range(r.randint(1, 4))) + \
            f"<button>{self.words(1, 2, False)}</button>"

    def in_comments(self, tag):
        r = self.rng
        each = "li" if tag in ("ol", "ul") else r.choice(("div", "div", "p", "article"))
        head = r.choice(("", f"<h2>{self.words(1, 3, False)}</h2>", f"<h3>{self.words(1, 3, False)}</h3>")) if each != "li" else ""
        out = []
        for _ in range(r.randint(1, 6)):
            text = self.sentences(1, 5)
            body = text if each == "p" else r.choice((f"<p>{text}</p>", text, f"<b>{self.words(1, 2, False)}</b><p>{text}</p><p>{self.sentences(1, 3)}</p>"))
            name = ' class="comment"' if r.random() < 0.5 else ""
            out.append(f"<{each}{name}>{body}</{each}>")
        return head + "".join(out) + (f"<form><button>{self.words(1, 2, False)}</button></form>" if r.random() < 0.3 else "")

    def in_share(self, tag):
        return self.link_list(tag, 2, 5, 2)

    def article(self) -> str:
        """The main text, with parts that are none between its blocks."""
        r = self.rng
        out = []
        if r.random() < 0.85:
            title = f"<h1>{self.words(1, 12, False)}</h1>"
            out.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
        for _ in range(r.choice((1, 1, 2, 3, 5, 8, 12, 20))):
            x = r.random()
            if x < 0.75:
                text = self.inline(self.sentences(1, r.choice((1, 2, 6, 12))))
                close = "</p>" if r.random() < 0.8 else ""
                out.append(r.choice((f"<p>{text}{close}", f"<p>{text}{close}", f"<p>{text}{close}", f"<div>{text}</div>", f"<p><b>{text}<br>")))
            elif x < 0.82:
                out.append(f"<h2>{self.words(1, 8, False)}</h2>")
            elif x < 0.88:
                tag = r.choice(("ul", "ol"))
                out.append(f"<{tag}>" + "".join(f"<li>{self.inline(self.words(1, 20, r.random() < 0.5))}" for _ in range(r.randint(1, 6))) + f"</{tag}>")
            elif x < 0.92:
                out.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif x < 0.95:
                out.append(f"<figure><img src=x><figcaption>{self.words(2, 12)}</figcaption></figure>")
            elif x < 0.97:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4, False)}" for _ in range(3)) for _ in range(r.randint(1, 4))) + "</table>")
            else:
                out.append(f"<pre>{self.words(3, 20, False)}</pre>")
            if r.random() < 0.06:
                out.append(self.part(r.choice(("advert", "sidebar", "share", "notice", "form"))))
        return "".join(out)

    def page(self) -> str:
        r = self.rng

        def some(kind, often):
            return self.part(kind) if r.random() < often else ""
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        name = "" if tag in ("article", "main") and r.random() < 0.6 else self.named(CONTENT_WORDS) if r.random() < 0.8 else self.named(PLAIN_WORDS)
        inner = f'<{tag}{name} data-label="content">{self.article()}{some("share", .1)}{some("comments", .12)}</{tag}>'
        if tag != "main" and r.random() < 0.25:
            inner = f"<main>{inner}</main>"
        inner = some("notice", .15) + some("advert", .35) + inner + some("share", .15) + some("comments", .3) + some("sidebar", .35) + some("advert", .15)
        for _ in range(r.choice((0, 0, 1, 2))):
            inner = f"<div{self.named(PLAIN_WORDS)}>{inner}</div>"
        return ("<!DOCTYPE html><html><head><title>" + self.words(1, 8, False) + "</title><script>var t='</p>';</script></head><body>"
                + some("header", .5) + some("menu", .7) + some("notice", .2) + some("advert", .2) + some("form", .15) + inner
                + some("comments", .08) + some("notice", .1) + some("menu", .1) + some("footer", .75) + r.choice(("</body></html>", "")))


def labelled_pages(n: int, seed: int) -> list[str]:
    """Pages of many layouts, with ``data-label`` attributes."""
    writer = _Writer(random.Random(seed))
    return [writer.page() for _ in range(n)]


@lru_cache(maxsize=4)
def default_model(rules: ModelRules = ModelRules()):
    return train(labelled_pages(rules.pages, rules.seed), rules)


# ---------------------------------------------------------------- extraction
def main_texts(sources: list[str], model) -> list[str]:
    """The main text of every page, from one forest."""
    index, weights, pair = model
    trees = [read_page(s) for s in sources]
    forest = Forest(trees, index)
    if not forest.n:
        return []
    p, _ = marginals(forest, forest.unary(weights), pair)
    return ["\n".join(x for x, q in zip(t.text, p[a:a + len(t.text)]) if x is not None and q >= 0.5)
            for t, a in zip(trees, forest.first)]


def extract_text(pages: DataFrame, model=None, rules: ModelRules = ModelRules(), page_id: str = "page_id", url: str = "url",
                 source: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model(rules))

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        out, part, size = [], [], 0
        for s in column.fillna(""):
            part.append(s)
            size += len(s)
            if size >= rules.forest:
                out += main_texts(part, sent.value)
                part, size = [], 0
        return pd.Series(out + main_texts(part, sent.value), dtype="str")

    out = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), text_of(pages[source]).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
