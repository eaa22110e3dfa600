"""Main text of web pages by a graphical model on the DOM tree.

Each node is content or not. A node's own evidence is a linear function of features
(tag, words of its class and id, share of link text, amount of text, place); parent and
child share a potential that depends on the child's kind of tag. One pass up the tree
and one down (sum-product) give each node's marginal given the whole page. Weights and
potentials are learned together by maximum likelihood: the gradient is what the labels
show less what the same messages expect.

The model is trained on labelled pages: given as (html, content) pairs through
``labelled_by_text``, or, as here, pages that say themselves where their article is. Nodes
under ``article`` or ``main`` are content, apart from landmarks, adverts, forms, comments
and the like inside them, and all others are not. Each page is learned from four times:
as it is, without the names of its article, without all landmark tags, and without these
and all class names, so that evidence from text, links and place counts too. A class word is one feature among others:
it takes a block away only if the words say so together (``ad-box``, not ``story-ad-hoc``),
and never the article itself. At most
``MAX_PAGES`` pages are learned from, those with the least hashes; that bounds what
reaches the driver. Every page is extracted whole.

Text nodes that are content are joined within a block; character references are decoded,
white space (a ``br`` too) becomes one space, blocks are trimmed and joined by newlines in
page order; empty ones vanish. What stands in a script, style, noscript, template,
textarea, title, svg or iframe is no text of the page; formulas and the fallback content
of objects are.

Defined results: null and empty pages have an empty text; text outside any tag is a block
of the page's root; broken markup is read as browsers do in simple cases (unclosed
paragraphs, items and inline tags end with their block; a noscript, template, svg or iframe
without an end tag holds nothing); repeated rows give equal texts;
null ids and urls are kept; an empty table gives an empty result; other columns are
dropped. Without any labelled page the built-in pages train the model.
"""

from __future__ import annotations

import html as entities
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Labelled pages that the model learns from, at most.
MAX_PAGES = 300

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")

RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe"}
#: Of these, the ones that go on to the end of the page without an end tag.
TO_THE_END = {"script", "style", "textarea", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas and objects stand in the line.
INLINE |= set("object param math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
#: Tags that an opening block ends when they are open in the same block.
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"ul", "ol", "table", "dl", "select", "div", "section", "article", "body", "nav", "main", "aside", "header", "footer", "form"}
LANDMARK = {"article", "main"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "head", "dialog", "menu", "button", "select"}
#: Parts of class, id and role names of what is no content (fixed values).
BOILERPLATE = set("ad ads advert adverts advertisement sponsor sponsored promo nav navbar navigation menu footer header masthead sidebar aside widget banner cookie cookies consent notice notices alert popup modal newsletter subscribe signup login form search share social related comment comments reply replies disqus breadcrumb breadcrumbs pagination copyright legal disclaimer toolbar".split())
GOOD = set("article content main post entry story body text paragraph prose".split())
#: Last parts of names that say nothing: an ``ad-box`` is an ad.
HOLDERS = set("area bar block box buttons container holder inner item items link links list outer panel section slot unit wrap wrapper zone".split())


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...] = ()  # parts of class, id and role names
    apart: bool = False  # a whole name says that this is no content
    good: bool = False  # a whole name says that it is
    text: str | None = None  # of text nodes
    block: int = 0  # the nearest node that isn't inline
    run: int = 0  # text nodes of one run stand in one block without another block between them
    chars: int = 0
    linked: int = 0
    words: int = 0
    stops: int = 0
    children: list[int] = field(default_factory=list)


def _name(node: Node, attributes: str) -> None:
    """What the names of a tag say of it."""
    parts: list[str] = []
    for a in _NAMES.finditer(attributes):
        for name in (a[2] or a[3] or a[4] or "").split():
            own = _PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
            parts += own
            head = next((w for w in reversed(own) if w not in HOLDERS), "")
            node.apart = node.apart or head in BOILERPLATE
            node.good = node.good or bool(own) and own[-1] in GOOD
    node.names = tuple(parts)


def parse(page: str) -> list[Node]:
    """The tree as nodes in page order; node 0 is the root, parents come before children."""
    nodes = [Node("#root", -1)]
    open_tags = [0]
    blocks = [0]  # per open tag: where the nearest one that isn't inline stands
    still_open: dict[str, int] = {}
    run = at = 0
    unended: set[str] = set()  # tags of RAW without an end tag in the rest of the page

    def add(node: Node) -> int:
        node.block = len(nodes) if node.tag not in INLINE and node.text is None else nodes[node.parent].block
        nodes[node.parent].children.append(len(nodes))
        nodes.append(node)
        return len(nodes) - 1

    def close(k: int) -> None:
        for i in open_tags[k:]:
            still_open[nodes[i].tag] -= 1
        del open_tags[k:], blocks[k:]

    def put(piece: str) -> None:
        if piece and not piece.isspace():
            add(Node("#text", open_tags[-1], text=entities.unescape(piece), run=run))
        elif piece:
            add(Node("#text", open_tags[-1], text=" ", run=run))

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            put(" ")
            continue
        if tag == "mtd":
            put(" ")
        if tag not in INLINE:
            run += 1
        if m[1]:
            for k in range(len(open_tags) - 1, 0, -1) if still_open.get(tag) else ():
                if nodes[open_tags[k]].tag == tag:
                    close(k)
                    break
                if tag in INLINE and nodes[open_tags[k]].tag not in INLINE:
                    break
            continue
        if tag not in INLINE and nodes[open_tags[blocks[-1]]].tag == "p":
            close(blocks[-1])  # a paragraph, with what is open in it, ends before a block
        if ends := _ENDED_BY.get(tag):
            for k in range(len(open_tags) - 1, 0, -1) if any(map(still_open.get, ends)) else ():
                if nodes[open_tags[k]].tag in ends:
                    close(k)
                    break
                if nodes[open_tags[k]].tag in _SCOPES:
                    break
        i = add(Node(tag, open_tags[-1]))
        if m[3]:
            _name(nodes[i], m[3])
        if tag in RAW:
            if tag == "svg" and m[3].endswith("/") or tag in unended:
                continue
            if end := re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at):
                at = end.end()
            elif tag in TO_THE_END:
                at = len(page)
            else:
                unended.add(tag)
        elif tag not in VOID and not m[3].endswith("/"):
            blocks.append(blocks[-1] if tag in INLINE else len(open_tags))
            open_tags.append(i)
            still_open[tag] = still_open.get(tag, 0) + 1
    for i in range(len(nodes) - 1, 0, -1):
        own, up = nodes[i], nodes[nodes[i].parent]
        if own.text is not None:
            own.chars = len(own.text.strip())
            own.words = own.text.count(" ") + 1 if own.chars else 0
            own.stops = sum(map(own.text.count, ".,;:!?"))
        if own.tag == "a":
            own.linked = own.chars
        for k in ("chars", "linked", "words", "stops"):
            setattr(up, k, getattr(up, k) + getattr(own, k))
    return nodes


TAGS = sorted(LANDMARK | OUTSIDE | {"p", "div", "section", "h", "li", "ul", "table", "a", "b", "#text", "#root", "html", "body", "pre", "blockquote", "figure", "raw", "other", "apart"})
_TAG = {t: i for i, t in enumerate(TAGS)}
_WORD = {w: i for i, w in enumerate(sorted(BOILERPLATE | GOOD))}
#: Tags that count on pages that name their article.
SPEAKING = LANDMARK | OUTSIDE | {"raw", "html", "body", "#root"}
N_TEXT = 16
N_FEATURES = 2 * len(TAGS) + 2 + len(_WORD) + N_TEXT


def kind(node: Node) -> str:
    tag = node.tag
    if re.fullmatch("h[1-6]", tag):
        return "h"
    if tag in RAW:
        return "raw"
    if tag in INLINE and tag != "a":
        return "b"
    return {"ol": "ul", "dl": "ul", "dd": "li", "dt": "li"}.get(tag, tag if tag in _TAG else "other")


def is_boilerplate(node: Node) -> bool:
    """Whether the names of a node, taken together, say that it is no content."""
    return node.apart and not node.good and node.tag not in LANDMARK


def bond_kind(node: Node) -> int:
    """Of which kind the bond to the parent is: blocks named apart have one of their own."""
    return _TAG["apart" if is_boilerplate(node) and node.tag not in OUTSIDE else kind(node)]


def features(nodes: list[Node]) -> np.ndarray:
    """One row of features per node.

    Pages that name their article are told from others: there only names and the tags that
    name parts of a page count, and the rest follows by its parents; text, links, place and
    other tags, which are weaker evidence, count on pages that don't.
    """
    out = np.zeros((len(nodes), N_FEATURES))
    total = max(1, nodes[0].chars)
    plain = not any(n.tag in LANDMARK for n in nodes)
    names = 2 * len(TAGS)
    base = names + 2 + len(_WORD)
    paragraphs, titles, last = [0] * len(nodes), [0] * len(nodes), [-1] * len(nodes)
    if plain:
        for i in range(len(nodes) - 1, 0, -1):
            n = nodes[i]
            paragraphs[n.parent] += paragraphs[i] + (n.tag == "p" and n.chars > 0)
            titles[n.parent] += titles[i] + (n.tag == "h1")
            if last[n.parent] < 0 and n.chars and n.tag not in INLINE and n.text is None:
                last[n.parent] = i
    for i, n in enumerate(nodes):
        row = out[i]
        if n.names and n.tag not in LANDMARK:
            row[names] = is_boilerplate(n)
            row[names + 1] = plain and n.good and not n.apart
            if is_boilerplate(n):
                for w in n.names:
                    if w in BOILERPLATE:
                        row[names + 2 + _WORD[w]] = 1
        if not n.chars and i and n.text is None:
            row[:] = 0
            continue
        if n.text is not None or n.tag in INLINE:  # these follow the block that they stand in
            continue
        tag = kind(n)
        if plain or tag in SPEAKING:
            row[_TAG[tag] + len(TAGS) * plain] = 1
        if plain and tag not in ("#root", "html", "body"):
            box = tag in ("div", "section", "other")
            row[base] = n.linked / max(1, n.chars)
            row[base + 1] = n.linked * 2 > n.chars
            row[base + 2] = min(1.0, n.words / 20)
            row[base + 3] = min(1.0, n.words / 200)
            row[base + 4] = min(1.0, n.stops / 5)
            row[base + 5] = n.chars / total
            row[base + 6] = n.chars == 0
            row[base + 7] = len(n.children) > 8
            row[base + 8] = n.chars * 2 > total
            row[base + 9] = box and paragraphs[i] > 0
            row[base + 10] = box and min(1.0, paragraphs[i] / 4)
            row[base + 11] = box and titles[i] > 0
            row[base + 12] = box and titles[i] > 0 and paragraphs[i] > 0
            row[base + 13] = last[n.parent] == i
            row[base + 14] = box and paragraphs[i] == 0 and n.chars * 2 <= total
            row[base + 15] = box and paragraphs[i] > 0 and n.chars * 2 > total
    return out


@dataclass
class Forest:
    """The nodes of one or more trees as arrays, level by level."""

    parent: np.ndarray  # -1 for roots
    kinds: np.ndarray
    held: np.ndarray  # nodes that hold text; others, like images and scripts, tell nothing of their parents
    levels: list[np.ndarray]  # nodes by depth, roots first

    @classmethod
    def of(cls, trees: list[list[Node]]) -> Forest:
        parent, kinds, depth, held = array("q"), array("q"), array("q"), array("b")
        for nodes in trees:
            base = len(parent)
            for n in nodes:
                parent.append(base + n.parent if n.parent >= 0 else -1)
                kinds.append(bond_kind(n))
                held.append((n.chars > 0 or n.text is not None) and n.parent >= 0)
                depth.append(depth[parent[-1]] + 1 if n.parent >= 0 else 0)
        deep = np.array(depth)
        order = np.argsort(deep, kind="stable")
        return cls(np.array(parent), np.array(kinds), np.array(held, dtype=bool), np.split(order, np.cumsum(np.bincount(deep))[:-1]))

    def beliefs(self, own: np.ndarray, bonds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each node given its whole tree, and the probability that it agrees with its parent.

        ``own`` are the log-odds of each node's own evidence, ``bonds`` the log potentials per
        kind of node that it has its parent's state.
        """
        bond = bonds[self.kinds] * self.held
        def message(odds, b):
            return np.logaddexp(odds + b, 0.0) - np.logaddexp(odds, b)

        below, up = own.copy(), np.zeros(len(own))  # own evidence and messages from below
        for level in self.levels[:0:-1]:
            up[level] = message(below[level], bond[level])
            np.add.at(below, self.parent[level], up[level])
        total, agree = below.copy(), np.ones(len(own))
        for level in self.levels[1:]:
            above = total[self.parent[level]] - up[level]  # the parent without this node's message
            total[level] += message(above, bond[level])
            equal = np.logaddexp(0.0, below[level] + above) + bond[level]
            agree[level] = np.exp(equal - np.logaddexp(equal, np.logaddexp(below[level], above)))
        return total, agree


@dataclass
class Model:
    weights: np.ndarray  # log-odds of content per feature
    bonds: np.ndarray  # log potential per kind of child: it has its parent's state

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        """Probability of content for each node, by messages up and then down the tree."""
        forest = Forest.of([nodes])
        odds, _ = forest.beliefs(features(nodes) @ self.weights, self.bonds)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        content = self.marginals(nodes)
        blocks: dict[tuple[int, int], list[str]] = {}
        for i, n in enumerate(nodes):
            if n.text is not None and (content[i] >= 0.5 or n.text == " "):
                blocks.setdefault((n.run, n.block), []).append(n.text)
        joined = (" ".join("".join(x).split()) for x in blocks.values())
        return "\n".join(x for x in joined if x)


def landmark_labels(nodes: list[Node]) -> np.ndarray | None:
    """1 for nodes of the article that a page names itself, 0 for others; null without one."""
    state = np.zeros(len(nodes), dtype=int)
    inside = [False] * len(nodes)  # a part of the page that is no content, or of one
    for i, n in enumerate(nodes[1:], 1):
        inside[i] = inside[n.parent] or n.tag in RAW or n.tag in OUTSIDE or is_boilerplate(n)
        state[i] = not inside[i] and (state[n.parent] or n.tag in LANDMARK)
    return state if state.any() else None


def labelled_by_text(page: str, content: set[str]) -> tuple[list[Node], np.ndarray]:
    """Nodes and states where the trimmed texts in ``content`` are the main text.

    A container is content if it holds some and nothing else.
    """
    nodes = parse(page)
    good, bad = [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.text is not None and n.text.strip():
            good[i], bad[i] = (1, 0) if n.text.strip() in content else (0, 1)
        if i:
            good[n.parent] += good[i]
            bad[n.parent] += bad[i]
    return nodes, np.array([int(g > 0 and b == 0 and n.tag not in ("#root", "html", "body")) for g, b, n in zip(good, bad, nodes)])


#: Tags that only name a part of a page.
NAMING = LANDMARK | OUTSIDE - {"head", "form", "button", "select"}


def without_names(nodes: list[Node], plain: set[str], classes: bool = False) -> list[Node]:
    """The same tree with the tags in ``plain`` as containers and, if asked, no class names."""
    hidden = {"tag": "div"}
    nothing = {"names": (), "apart": False, "good": False}
    return [replace(n, **(hidden if n.tag in plain else {}), **(nothing if classes else {})) for n in nodes]


def train(pages: list[tuple[list[Node], np.ndarray]], steps: int = 200, ridge: float = 0.02) -> Model:
    """Weights and bonds of greatest likelihood, by gradient steps of adapted length."""
    trees, states = [], []
    for page, state in pages:
        trees += [page, without_names(page, LANDMARK), without_names(page, NAMING), without_names(page, NAMING, True)]
        states += [state] * 4
    forest = Forest.of(trees)
    x = np.concatenate([features(t).astype(np.float32) for t in trees])
    y = np.concatenate(states)
    child = forest.held  # roots hold none
    kinds = forest.kinds[child]
    equal = (y == y[forest.parent])[child]
    # Bonds start as none for parts that stand in an article as well as outside.
    at = np.concatenate([np.zeros(N_FEATURES), [0.0 if t in OUTSIDE or t == "apart" else 2.0 for t in TAGS]])
    mean, square = np.zeros(len(at)), np.zeros(len(at))
    for k in range(1, steps + 1):
        odds, agree = forest.beliefs((x @ at[:N_FEATURES].astype(np.float32)).astype(float), at[N_FEATURES:])
        off = y - 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        bonds = np.bincount(kinds, equal - agree[child], len(TAGS))
        slope = np.concatenate([off.astype(np.float32) @ x, bonds]) - ridge * at
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        size = 0.3 * (1 - k / (steps + 1))
        at = at + size * mean / (1 - 0.9**k) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        at[N_FEATURES:] = np.clip(at[N_FEATURES:], 0, 8)
    return Model(at[:N_FEATURES], at[N_FEATURES:])


#: Labelled pages that stand for usual ones; they always take part in the training.
EXAMPLES = (
    """<html><head><title>t</title></head><body><header><h1>Site</h1><p>A motto of the site.</p></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie notice"><p>We use cookies, as others do.</p><button>Fine</button></div><div class="ad">Buy it now.</div><main><article><h1>A title of some length</h1><p>First paragraph, with <a href="/x">a link</a> and text.
<h2>Part</h2><p>Second paragraph, which is longer, and has several sentences. It goes on.</p><ul><li>An item of the text</li><li>Another item, of the text</li></ul>
<blockquote><p>A quoted sentence.</p></blockquote><aside class="related"><p>See also</p><ul><li><a href="/r">Related page</a></li></ul></aside><form><p>Sign up, please.</p><input></form></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this text, it is good.</p></div></section></main>
<aside class="sidebar"><h3>Most read</h3><p>What others read, in short.</p><ul><li><a href="/1">One</a></li></ul></aside><footer><p>&copy; Site, and others.</p><ul><li><a href="/l">Legal</a></li></ul></footer></body></html>""",
    """<html><body><div class="menu"><ul><li><a href="/">Start</a></li></ul></div><div id="sidebar"><p>Weather and more, every day.</p></div><main><h1>Another title</h1><div><p>A paragraph in a container, with a few words.</p>
<p>One more. It is short.</p></div><table><tr><td>A cell</td><td>12</td></tr></table><ol><li>First, do this.</li><li>Then do that.</li></ol><div class="advert"><p>Best prices, only today.</p></div><div class="share"><ul><li>Share it</li></ul></div>
<div id="comments"><ul><li><p>First reader, who has an opinion.</p></li></ul><form><p>Leave a reply.</p></form></div></main><div class="popup"><p>Subscribe to our letter, it is free.</p></div><footer>Imprint</footer></body></html>""",
    """<html><body><article><header><h1>Title in a head</h1></header><section><h2>Section</h2><p>Text of a section, in a sentence.</p><figure><img><figcaption>What it shows.</figcaption></figure><pre>some = code</pre></section>
<section class="related"><h2>More</h2><p>Other texts, on the same theme.</p></section><footer><p>By an author, on a day.</p></footer></article><aside><p>Aside from the text, this.</p></aside><form><p>Ask us, if you like.</p></form></body></html>""",
    "<html><body><nav><a href='/'>Home</a></nav><article><header><p>By an author.</p></header><h1>Title between adverts</h1>"
    + "<p>A paragraph of it.</p><div class='ad'>Buy it.</div><aside><p>See also this.</p></aside><section class='related'><ul><li><a href='/x'>Another</a></li></ul></section><form><p>Sign up.</p><button>Yes</button><select><option>One</option></select></form><nav><ul><li><a href='#p'>Part</a></li></ul></nav><div class='share'><p>Share it.</p></div><footer>Of the part</footer>" * 8
    + "</article><footer>Imprint</footer></body></html>",
)

#: Labelled pages without landmark tags: (page, the texts that are content).
PLAIN_EXAMPLES = (
    (
        """<html><body><div class="wrapper"><div class="top"><a href="/">Home</a><a href="/a">About us</a></div><div class="story"><h1>A title here</h1><div class="form-group"><p>Text in a group, as styled.</p></div>
<p class="social-history">What the patient did, before and after.</p><div class="ad-box">Buy it now, and cheap.</div><div class="story-ad-hoc"><p>A report made in haste, which stays.</p></div><p>The last one. It has two sentences.</p></div>
<div class="bottom">&copy; Some site, all rights.</div></div></body></html>""",
        {"A title here", "Text in a group, as styled.", "What the patient did, before and after.", "A report made in haste, which stays.", "The last one. It has two sentences."},
    ),
    ("<html><body><div><p>One short paragraph.</p></div></body></html>", {"One short paragraph."}),
    ("<html><body><h1>Title</h1><p>First, on the page itself.</p><p>Second, on the page itself.</p></body></html>", {"Title", "First, on the page itself.", "Second, on the page itself."}),
    ("<html><body><div>Words without a paragraph, that are all there is.</div></body></html>", {"Words without a paragraph, that are all there is."}),
    (
        """<html><body><div><a href="/">Home</a> <a href="/n">News</a></div><div><h1>Head</h1><p>A short text.</p></div><div>Ask us about offers.</div><div>&copy; A site &middot; imprint</div></body></html>""",
        {"Head", "A short text."},
    ),
)


def labelled_nodes(page: str) -> tuple[list[Node], np.ndarray] | None:
    nodes = parse(page)
    state = landmark_labels(nodes)
    return None if state is None else (nodes, state)


def examples() -> list[tuple[list[Node], np.ndarray]]:
    """The built-in pages with their states."""
    return [labelled_nodes(x) for x in EXAMPLES] + [labelled_by_text(*x) for x in PLAIN_EXAMPLES]


def learn(pages: DataFrame, html: str = "html", most: int = MAX_PAGES) -> Model:
    """A model from the pages that name their article."""
    own = pages.select(F.col(html).alias("html")).where(F.col("html").rlike("(?i)<(?:article|main)\\b"))
    hashed = own.select(F.xxhash64("html").alias("h"), "html")
    least = hashed.select("h").distinct().orderBy("h").limit(most)
    sample = hashed.join(F.broadcast(least), "h").dropDuplicates(["h"]).orderBy("h").select("html").collect()  # at most MAX_PAGES
    known = [labelled_nodes(r["html"]) for r in sample]
    return train(examples() * max(2, len(sample) // 10) + [k for k in known if k is not None])


def main_texts(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    rows = pages.select("page_id", "url", F.col(html).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "html"):
            texts = [model.extract(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
