"""Main text of web pages: a tree-structured graphical model over the DOM.

A page becomes a tree: its block elements, and as leaves its blocks of text (maximal runs of
inline text). Every node has a binary variable, "holds main text". Node potentials weigh features
of the node (its text's length, links and sentence marks, its names); parent-child potentials
weigh the pairs of values, by the kind of child, and rule out a child with main text below a
parent without. Sum-product messages pass from the leaves to the root and back down and give
every node's marginal; the text is the leaves whose marginal reaches one half, in page order.

The weights maximise the conditional likelihood of labelled pages, (html, text) with the known
main text. Names count by class, not one by one: elements called like navigation, advertising or
comments, and elements called like content. Every labelled page is learned three times: as it is;
with all names hidden and some paragraphs made list items, so that such pages are judged by their
texts; and with some paragraphs repeated in sections named as comments or the like, which are not
main text. A prior on the weights decides what no page shows, and everything where no page is
labelled.

Where no labels are at hand, ``self_labelled`` takes those pages that mark their article: one
``article`` (else ``main``) element, without the parts in it that are named otherwise.

Fitting takes at most ``MOST_PAGES`` labelled pages, whole, in the order of a hash, as far as
they have ``MOST_NODES`` nodes together; what the driver gathers is so bounded. Extraction is one
pass over all whole pages.

Special cases: a null or empty page, or one without main text, has the empty text; broken and cut
markup is read as browsers do (open elements end where they must, an unfinished tag is dropped);
rows are judged one by one, so ids and urls may be null or repeated; columns other than the
named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, table

MOST_PAGES = 300
MOST_NODES = 400_000
STEPS = 120
RATE = 0.08
PRIOR = 0.02  # weight of the squared distance from the prior
REPEATED = 6  # paragraphs repeated in a section that is not main text

# Element names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TEXT = frozenset(
    "script style title textarea iframe xmp noembed noframes".split()
)
UNSEEN = frozenset(
    "head noscript template svg math select option datalist button object canvas audio video map"
    " progress meter".split()
)
BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol"
    " p pre search section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open element that the start of another ends, and what it is not looked for beyond.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
SCOPES = frozenset("table td th caption".split())

OTHER_TAGS = frozenset("nav aside footer form menu dialog search".split())
CONTENT_TAGS = frozenset("article main".split())
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar"
    " toolbar form".split()
)
CONTENT_ROLES = frozenset("main article".split())
# Parts of class and id names.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " banner nav navbar navigation menu menus breadcrumb breadcrumbs crumbs topbar masthead footer"
    " sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login register search share"
    " sharing social comment comments commentlist respond reply replies disqus discussion feedback"
    " related recommended recommendations trending popular pagination pager copyright legal"
    " disclaimer toolbar skip form hidden".split()
)
HEADER_NAMES = frozenset("header head heading".split())
CONTENT_NAMES = frozenset("article content contents entry main post story body".split())
# Names that say what else is on the page, or that something may be added to an element.
_QUALIFIED = re.compile(
    r"(?:no|has|have|with|without|is|not)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|status|count)", re.I
)

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*)|<[!?/][^A-Za-z>][^>]*+(?:>|\Z)|<![^>]*+(?:>|\Z)|</?+>"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?P<closed>>?)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?:^|[\s/\"'])(class|id|role|hidden|style|aria-hidden|href)(?=[\s=/]|$)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?",
    re.I | re.S,
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?…。！？](?=\s|$|[\"'”’)])")


class Tree(NamedTuple):
    """A page: parents come before their children, node 0 is the body."""

    parent: list[int]
    own: list[int]  # named as content 1, as something else -1, else 0
    near: list[int]  # the same of the nearest node with such a name, itself included
    kind: list[int]  # 0 element, 1 leaf
    tag: list[str]  # of a leaf, its element's
    text: list[str]  # of leaves
    linked: list[int]  # characters in links
    article: list[bool]  # article elements
    main: list[bool]


def _naming(tag: str, rest: str, near: int) -> int:
    """1 for an element named as content, -1 for one named as something else, else 0."""
    held = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest else {}
    role = held.get("role", "").lower().strip()
    if "hidden" in held or held.get("aria-hidden", "").lower() == "true":
        return -1
    if "display:none" in held.get("style", "").lower().replace(" ", ""):
        return -1
    named = f"{held.get('class', '')} {held.get('id', '')}".split()
    names = {n.lower() for item in named if not _QUALIFIED.fullmatch(item) for n in _NAME.findall(item)}
    if tag in OTHER_TAGS or role in OTHER_ROLES or names & OTHER_NAMES:
        return -1
    if tag == "header" or names & HEADER_NAMES:
        return 0 if near == 1 else -1  # an article's own heading is a part of it
    if tag in CONTENT_TAGS or role in CONTENT_ROLES or names & CONTENT_NAMES:
        return 1
    return 0


class _Reader:
    """Builds the tree of one page."""

    def __init__(self):
        self.tree = Tree([-1], [0], [0], [0], ["body"], [""], [0], [False], [False])
        self.stack: list[tuple[str, int]] = [("body", 0)]  # open elements and their nodes
        self.unseen = 0
        self.links = 0
        self.run: list[str] = []
        self.run_linked = 0

    def add(self, parent: int, own: int, kind: int, tag: str, text: str = "", linked: int = 0) -> int:
        t = self.tree
        near = t.near[parent]
        t.parent.append(parent)
        t.own.append(own if near >= 0 or own < 0 else 0)
        t.near.append(near if near < 0 or not own else own)
        t.kind.append(kind)
        t.tag.append(tag)
        t.text.append(text)
        t.linked.append(linked)
        t.article.append(not kind and tag == "article")
        t.main.append(not kind and tag == "main")
        return len(t.parent) - 1

    def flush(self) -> None:
        """End the block of text."""
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                tag = next((tag for tag, _ in reversed(self.stack) if tag in BLOCKS), "body")
                self.add(self.stack[-1][1], 0, 1, tag, text, min(self.run_linked, len(text)))
            self.run, self.run_linked = [], 0

    def pop(self, to: int) -> None:
        """Close the open elements from place ``to`` on."""
        for tag, _ in self.stack[to:]:
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"
        del self.stack[to:]

    def open_place(self, tags, beyond) -> int:
        """The place of the innermost open element of ``tags``, 0 if none before ``beyond``."""
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at][0]
            if tag in tags:
                return at
            if tag in beyond:
                return 0
        return 0

    def start(self, tag: str, rest: str) -> None:
        if tag in ("html", "body"):
            self.pop_if("head")
            return
        if self.unseen and tag not in UNSEEN:
            # Text elements in an unclosed head end it, as in browsers.
            if not (tag in BLOCKS and self.pop_if("head") and not self.unseen):
                return
        if tag in BLOCKS or tag == "hr":
            self.flush()
            at = self.open_place({"p"}, (BLOCKS - {"p"}) | SCOPES)
            if at:
                self.pop(at)
            if tag in HEADINGS and self.stack[-1][0] in HEADINGS:
                self.pop(len(self.stack) - 1)
        if tag in ENDS:
            at = self.open_place(*ENDS[tag])
            if at:
                self.pop(at)
        if tag in ("br", "td", "th", "img"):
            self.run.append(" " if tag != "img" else "")
        if tag in VOID:
            return
        node = self.stack[-1][1]
        if tag in BLOCKS:
            node = self.add(node, _naming(tag, rest, self.tree.near[node]), 0, tag)
        self.unseen += tag in UNSEEN
        self.links += tag == "a"
        self.stack.append((tag, node))

    def pop_if(self, tag: str) -> bool:
        at = self.open_place({tag}, ())
        if at:
            self.pop(at)
        return bool(at)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.run.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            if tag in HEADINGS:
                at = self.open_place(HEADINGS, SCOPES)
            else:
                at = self.open_place({tag}, SCOPES - {tag})
        elif tag in UNSEEN or tag in SCOPES:
            at = self.open_place({tag}, ())
        else:
            at = self.open_place({tag}, BLOCKS | SCOPES)
        if at:
            self.pop(at)
        if tag in SCOPES:
            self.run.append(" ")

    def characters(self, text: str) -> None:
        if self.unseen:
            return
        if "&" in text:
            text = unescape(text)
        self.run.append(text)
        if self.links:
            self.run_linked += len(text)


def parse(html: str | None) -> Tree:
    reader = _Reader()
    at, html = 0, html or ""
    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            reader.characters(html[at:])
            break
        if m.start() > at:
            reader.characters(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None or not m["closed"]:
            continue
        tag = tag.lower()
        if m["end"]:
            reader.end(tag)
        elif tag in RAW_TEXT:
            closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = closing.end() if closing else len(html)
        else:
            reader.start(tag, m["rest"])
    reader.flush()
    return reader.tree


class Pages(NamedTuple):
    """Nodes of several pages, one after the other."""

    x: np.ndarray  # features
    parent: np.ndarray  # -1 of a page's body
    kind: np.ndarray
    levels: list[np.ndarray]  # nodes by depth

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.kind == 1)


FEATURES = (
    "one leaf other content under_other under_content linked words short sentences heading listed"
    " paragraph copyright share prose"
).split()
# What is expected of the weights before a page is seen.
EXPECTED = {
    "one": -0.5, "other": -5.0, "content": 2.0, "under_other": -4.0, "under_content": 2.5,
    "linked": -3.0, "words": 1.5, "short": -0.5, "sentences": 1.0, "heading": 1.0, "copyright": -2.0,
    "share": 1.5, "prose": 1.5,
}
KINDS = 2
IMPOSSIBLE = -50.0  # log potential of main text below a node without


def levels_of(parent: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parent), dtype=np.int64)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def stacked(trees: list[Tree]) -> Pages:
    """The nodes of all trees with their features."""
    sizes = [len(t.parent) for t in trees]
    base = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
    parent = np.array([p for t in trees for p in t.parent], dtype=np.int64)
    parent = np.where(parent < 0, -1, parent + base)
    levels = levels_of(parent)

    def column(values) -> np.ndarray:
        return np.array(list(values), dtype=np.float64)

    kind = column(k for t in trees for k in t.kind).astype(np.int64)
    texts = [s for t in trees for s in t.text]
    tags = [g for t in trees for g in t.tag]
    own, near = column(o for t in trees for o in t.own), column(n for t in trees for n in t.near)
    sums = np.stack(
        [
            column(len(s) for s in texts),
            column(n for t in trees for n in t.linked),
            column(s.count(" ") + 1 if s else 0 for s in texts),
            column(len(_SENTENCE.findall(s)) for s in texts),
        ],
        axis=1,
    )
    for level in reversed(levels[1:]):
        np.add.at(sums, parent[level], sums[level])
    chars, linked, words, sentences = sums.T
    body = base
    linked = linked / np.maximum(chars, 1)
    x = np.stack(
        [
            np.ones(len(parent)),
            kind,
            own < 0,
            own > 0,
            near < 0,
            near > 0,
            linked,
            np.log1p(words) / 4,
            words <= 2,
            np.minimum(sentences, 3) / 3,
            column(g in HEADINGS for g in tags),
            column(g in ("li", "dt", "dd", "ul", "ol", "dl") for g in tags),
            column(g in ("p", "blockquote", "pre") for g in tags),
            column("©" in s or "copyright" in s.lower() for s in texts),
            chars / np.maximum(chars[body], 1),
            np.log1p(words) / 4 * (1 - linked) * (sentences > 0),
        ],
        axis=1,
    ).astype(np.float64)
    return Pages(x, parent, kind, levels)


class TreeModel:
    """Weights of node and parent-child potentials, and sum-product over trees."""

    def __init__(self):
        self.node = np.array([EXPECTED.get(f, 0.0) for f in FEATURES])
        self.pair = np.zeros((KINDS, 2, 2))  # by kind of child, value of parent, of child
        self.pair[:, 1, 1] = 1.0

    def potentials(self) -> np.ndarray:
        out = self.pair.copy()
        out[:, 0, 1] = IMPOSSIBLE
        return out

    def marginals(self, pages: Pages) -> tuple[np.ndarray, np.ndarray]:
        """P(node = 1), and of every node's pair (parent, node) the joint of their values."""
        n = len(pages.parent)
        pair = self.potentials()[pages.kind]
        up = np.zeros((n, 2))  # own potential and what the children say
        up[:, 1] = pages.x @ self.node
        said = np.zeros((n, 2))  # by a node to its parent
        for level in reversed(pages.levels[1:]):
            said[level] = np.logaddexp(pair[level, :, 0] + up[level, 0:1], pair[level, :, 1] + up[level, 1:2])
            np.add.at(up, pages.parent[level], said[level])
        belief = up.copy()
        joint = np.zeros((n, 2, 2))
        for level in pages.levels[1:]:
            above = belief[pages.parent[level]] - said[level]  # without what this node said
            both = above[:, :, None] + pair[level] + up[level][:, None, :]
            top = both.max(axis=(1, 2), keepdims=True)
            both = np.exp(both - top)
            both /= both.sum(axis=(1, 2), keepdims=True)
            joint[level] = both
            belief[level] = up[level] + np.logaddexp(
                above[:, 0:1] + pair[level, 0], above[:, 1:2] + pair[level, 1]
            )
        gap = np.clip(belief[:, 0] - belief[:, 1], -700, 700)
        return 1 / (1 + np.exp(gap)), joint

    def learn(self, pages: Pages, label: np.ndarray) -> None:
        """Conditional likelihood of all nodes' labels, by Adam; the prior is where it starts."""
        weights = np.concatenate([self.node, self.pair.ravel()])
        prior = weights.copy()
        inner = np.flatnonzero(pages.parent >= 0)
        seen = np.zeros((KINDS, 2, 2))
        np.add.at(seen, (pages.kind[inner], label[pages.parent[inner]], label[inner]), 1)
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, STEPS + 1):
            p, joint = self.marginals(pages)
            expected = np.zeros((KINDS, 2, 2))
            for k in range(KINDS):
                expected[k] = joint[inner][pages.kind[inner] == k].sum(axis=0)
            gradient = np.concatenate([pages.x.T @ (p - label), (expected - seen).ravel()]) / len(label)
            gradient += PRIOR / 10 * (weights - prior)
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            weights = weights - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            self.node = weights[: len(self.node)]
            self.pair = weights[len(self.node) :].reshape(KINDS, 2, 2)


def own_text(tree: Tree) -> str | None:
    """The text of the one element a page marks as its article; null if it marks none."""
    for marked in (tree.article, tree.main):
        if sum(marked) == 1:
            inside = [False] * len(marked)
            for i, p in enumerate(tree.parent):
                inside[i] = marked[i] or (p >= 0 and inside[p])
            return "\n".join(
                s for s, k, i, near in zip(tree.text, tree.kind, inside, tree.near, strict=True)
                if k and i and near > 0
            )
    return None


def node_labels(tree: Tree, text: str) -> np.ndarray:
    """1 for the leaves whose texts are, in order, the lines of ``text``, and what is above."""
    lines = text.split("\n") if text else []
    # The last fitting leaf for each line, from the end: titles recur in menus above the article.
    label = np.zeros(len(tree.parent), dtype=np.int64)
    at = len(lines) - 1
    places: dict[str, int] = {}
    for j, line in enumerate(lines):
        places[line] = j
    for i in range(len(label) - 1, 0, -1):
        if tree.kind[i] and at >= 0 and tree.text[i] in places:
            j = at
            while j >= 0 and lines[j] != tree.text[i]:
                j -= 1
            if j == at or (j >= 0 and at - j <= 3):  # lines the parser breaks otherwise are passed
                label[i], at = 1, j - 1
    for i in range(len(label) - 1, 0, -1):
        if label[i]:
            label[tree.parent[i]] = 1
    return label


def without_names(tree: Tree, label: np.ndarray) -> Tree:
    """All names hidden, and every other block of the main text a list item: lists are not a
    sign of menus, links are."""
    none = [0] * len(tree.parent)
    tags = list(tree.tag)
    for i in np.flatnonzero(label).tolist()[::2]:
        if tree.kind[i] and tags[i] not in HEADINGS:
            tags[i] = "li"
    return tree._replace(own=none, near=none, tag=tags)


def with_sections(tree: Tree, label: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The page with paragraphs of its main text repeated in sections named as something else,
    one below the article and one below the body."""
    copied = [i for i in np.flatnonzero(label).tolist() if tree.kind[i] and tree.tag[i] not in HEADINGS]
    copied = copied[-REPEATED:]
    if not copied:
        return tree, label
    grown = Tree(*(list(column) for column in tree))
    parents = {0, tree.parent[tree.parent[copied[0]]] if tree.parent[copied[0]] > 0 else 0}
    for parent in sorted(parents):
        section = len(grown.parent)
        for values in [(parent, -1, -1, 0, "div", "", 0)] + [
            (section, 0, -1, 1, tree.tag[i], tree.text[i], tree.linked[i]) for i in copied
        ]:
            for column, value in zip(grown, (*values, False, False), strict=True):
                column.append(value)
    return grown, np.concatenate([label, np.zeros(len(grown.parent) - len(label), dtype=np.int64)])


def self_labelled(pages: DataFrame, *, html_col: str = "html", most_pages: int = MOST_PAGES) -> DataFrame:
    """(html, text) of at most ``most_pages`` pages that mark their article."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [own_text(parse(html)) for html in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["html"], pa.array(texts, pa.string())], names=["html", "text"]
            )

    # Pages that may mark one, by their text; twice as many as wanted, as some will not.
    likely = pages.select(F.col(html_col).alias("html")).filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    found = _by_hash(likely, 2 * most_pages).mapInArrow(run, "html string, text string")
    return found.filter("text IS NOT NULL").limit(most_pages)


def _by_hash(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` distinct rows by a hash of them. Only hashes are sorted; equal rows
    become one in every task, so neither they nor long pages meet."""
    hashed = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    order = hashed.select("_hash").distinct().orderBy("_hash").limit(most)
    last = order.agg(F.max("_hash")).first()[0]
    if last is None:
        return rows.limit(0)
    first = hashed.filter(F.col("_hash") <= last).groupBy("_hash")
    return first.agg(*[F.first(c).alias(c) for c in rows.columns]).drop("_hash")


def fit(
    labelled: DataFrame,
    *,
    html_col: str = "html",
    text_col: str = "text",
    most_pages: int = MOST_PAGES,
    most_nodes: int = MOST_NODES,
) -> TreeModel:
    """A model from (html, text) pages, text being the known main text, one block a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, text in zip(batch["html"].to_pylist(), batch["text"].to_pylist(), strict=True):
                tree = parse(html)
                label = node_labels(tree, text or "")
                for t, y in ((tree, label), (without_names(tree, label), label), with_sections(tree, label)):
                    nodes = stacked([t])
                    out.append((len(y), nodes.x.tobytes(), nodes.parent.tobytes(), nodes.kind.tobytes(), y.tobytes()))
            columns = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["n", "x", "parent", "kind", "label"],
            )

    spark = labelled.sparkSession
    work = Workspace(spark, "html_extraction")
    rows = labelled.select(F.col(html_col).alias("html"), F.col(text_col).alias("text"))
    rows = _by_hash(rows, most_pages)
    held = work.write(
        rows.mapInArrow(run, "n long, x binary, parent binary, kind binary, label binary"), "learned"
    )
    learned = held.withColumn("hash", F.xxhash64("x", "label"))
    sizes = learned.select("n", "hash").orderBy("hash").collect()  # three rows a page
    reached, last = 0, None
    for r in sizes:
        reached += r.n
        if reached > most_nodes:
            break
        last = r.hash
    model = TreeModel()
    if last is not None:
        taken = learned.filter(F.col("hash") <= last).collect()  # MOST_NODES nodes
        taken.sort(key=lambda r: (bytes(r.x), bytes(r.label)))
        x = np.concatenate([np.frombuffer(r.x).reshape(-1, len(FEATURES)) for r in taken])
        base = np.cumsum([0, *(r.n for r in taken)])
        parent = np.concatenate(
            [
                np.where((p := np.frombuffer(r.parent, dtype=np.int64)) < 0, -1, p + b)
                for r, b in zip(taken, base[:-1], strict=True)
            ]
        )
        kind = np.concatenate([np.frombuffer(r.kind, dtype=np.int64) for r in taken])
        label = np.concatenate([np.frombuffer(r.label, dtype=np.int64) for r in taken])
        model.learn(Pages(x, parent, kind, levels_of(parent)), label)
    work.drop(held)
    return model


UNIT_PAGES = 64


def main_texts(htmls: list[str | None], model: TreeModel) -> list[str]:
    trees = [parse(html) for html in htmls]
    pages = stacked(trees)
    p, _ = model.marginals(pages)
    kept = (p >= 0.5) & (pages.kind == 1)
    out, start = [], 0
    for t in trees:
        stop = start + len(t.parent)
        out.append("\n".join(t.text[i - start] for i in (np.flatnonzero(kept[start:stop]) + start).tolist()))
        start = stop
    return out


def extract(
    pages: DataFrame,
    model: TreeModel,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, UNIT_PAGES):
                part = batch.slice(start, UNIT_PAGES)
                texts = main_texts(part["html"].to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"),
    ).mapInArrow(run, "page_id long, url string, text string")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = fit(self_labelled(pages))
    return extract(pages, model).withColumn("n_chars", F.length("text").cast("long"))
