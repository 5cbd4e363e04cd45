"""Main text of web pages by a tree-structured graphical model over the document tree.

A page is read into a tree: elements that form blocks, and runs of text below them. Every node is
*content* or not. A node's own features (tag, words in class and id, link density, length, marks) give a likelihood
ratio; potentials between parent and child, by kind of child, tie the nodes together; sum-product messages
up and down the tree give the exact marginal of every run of text. Runs above one half are the main text.

*Labelled pages.* Pages whose markup names the article (``article``, ``main``) are labelled by it; what such a
page marks as navigation, header of the site, aside, form, advert or comments is not content. Each
labelled page is also trained in variants: the article under a neutral tag, and blocks that such pages lack
(comments, sidebars, notices, forms, adverts, related links), filled with text of the page itself.

Cases: null and empty pages, and pages without text, give an empty text. Markup that is not closed is closed
where its parent ends. Without any labelled page the model is that of its priors. Repeated rows are all
extracted. Columns beyond ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.llm.batches import bounded_batches, map_batches

PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*\"|=\s*+'[^']*'|[=\"'])*+)>|</?[A-Za-z][^>]*$", re.S
)
SPACE = re.compile(r"\s+")
ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# fixed values: kinds of elements, and words that sites use in class, id and role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title head".split())  # skipped to the closing tag, else to the end of the page
HIDDEN = frozenset("noscript template svg select button".split())  # elements whose text is left out
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
TAGS = "article main section div p h1 h2 h3 nav header footer aside form ul ol li table tr td blockquote pre figure body".split()
WORDS = {
    "content": "content article post entry story main text body prose",
    "comment": "comment comments reply replies discussion disqus respond",
    "side": "sidebar side aside widget rail",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toolbar",
    "head": "header masthead banner topbar",
    "foot": "footer foot bottom copyright legal colophon",
    "advert": "ad ads advert advertisement promo promoted sponsor sponsored",
    "notice": "cookie consent notice alert popup modal newsletter subscribe subscription gdpr paywall",
    "share": "share sharing social related recommended recommend more tags",
    "form": "form login signup search",
}
WORD_PLACE = {w: i for i, own in enumerate(WORDS.values()) for w in own.split()}
SPLIT_NAME = re.compile(r"[^a-z]+")
N_FEATURES = len(TAGS) + 1 + len(WORDS) + 7
KINDS = 4  # of child: run of text, element that names boilerplate, element that names content, other element
NOT_CONTENT = frozenset("nav aside footer form".split())
BLOCKS_CLOSING_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


@dataclass
class Tree:
    """Nodes of one page in page order, parents before children; runs of text have a ``text``."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    words: list[frozenset] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)  # label given in the markup: 1, 0, or -1
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, words: frozenset = frozenset(), mark: int = -1, text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.mark.append(mark)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def _names(attributes: str) -> tuple[frozenset, int]:
    """Kinds of words in class, id and role, and the label in ``data-y``."""
    found, mark = set(), -1
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "data-y":
            mark = int(value) if value in ("0", "1") else -1
        else:
            found.update(WORD_PLACE[w] for w in SPLIT_NAME.split(value) if w in WORD_PLACE)
    return frozenset(found), mark


def parse(page: str) -> Tree:
    """The tree of a page."""
    tree = Tree()
    root = tree.add(-1, "body")
    stack: list[tuple[str, int, bool]] = [("body", root, False)]  # open blocks; whether text is left out
    unclosed: set[str] = set()
    inline_links = 0
    parts: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text and not stack[-1][2]:
                tree.add(stack[-1][1], "#text", text=text, linked=min(linked, len(text)))
            parts.clear()
        linked = 0

    end = len(page)
    while at < end:
        found = PIECE.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            piece = page[at:stop]
            parts.append(piece)
            if inline_links:
                linked += len(piece.strip())
        if not found:
            break
        at = found.end()
        tag = (found.group(2) or "").lower()
        if not tag:
            continue
        closing = bool(found.group(1))
        if tag in RAW and not closing:
            if not found.group(3).endswith("/"):
                shut = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if tag == "head" and not shut:
                    continue
                at = shut.end() if shut else end
            continue
        if tag in INLINE:
            if tag == "a":
                inline_links = max(0, inline_links + (-1 if closing else 1))
            continue
        if tag in ("html", "body", "br", "wbr") or (tag in VOID and tag != "hr"):
            if tag == "br":
                parts.append(" ")
            continue
        hides = tag in HIDDEN and not closing
        if hides:
            if found.group(3).endswith("/"):
                continue
            if tag not in unclosed and not re.compile(rf"</{tag}\s*>", re.I).search(page, at):
                unclosed.add(tag)
            if tag in unclosed:  # nothing tells where it ends, so its text stays
                continue
        flush()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    inline_links = 0
                    break
            continue
        if tag in BLOCKS_CLOSING_P and stack[-1][0] == "p":
            stack.pop()
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack[-1][0] == tag:
            stack.pop()
        if tag == "hr":
            continue
        words, mark = _names(found.group(3)) if found.group(3) else (frozenset(), -1)
        inline_links = 0
        away = hides or stack[-1][2]
        stack.append((tag, stack[-1][1] if away else tree.add(stack[-1][1], tag, words, mark), away))
    flush()
    return tree


def features(tree: Tree) -> np.ndarray:
    """One row per node."""
    n = len(tree.parent)
    out = np.zeros((n, N_FEATURES))
    size, links, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, text in enumerate(tree.text):
        if text is not None:
            size[i], links[i], marks[i] = len(text), tree.linked[i], text.count(",") + text.count(".")
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        size[p] += size[i]
        links[p] += links[i]
        marks[p] += marks[i]
    total = max(size[0], 1.0)
    seen = 0.0
    base = len(TAGS) + 1
    for i in range(n):
        tag = tree.tag[i] if tree.text[i] is None else "#text"
        if tag != "#text":
            out[i, TAGS.index(tag) if tag in TAGS else len(TAGS)] = 1
            for w in tree.words[i]:
                out[i, base + w] = 1
        own = out[i, base + len(WORDS) :]
        own[0] = tag == "#text"
        own[1] = links[i] / max(size[i], 1.0)
        own[2] = min(size[i], 100.0) / 100
        own[3] = size[i] / total
        own[4] = min(marks[i] / max(size[i], 1.0) * 30, 1.0)
        own[5] = seen / total
        own[6] = size[i] < 40
        if tree.text[i] is not None:
            seen += size[i]
    return out


def kinds(tree: Tree) -> np.ndarray:
    """The kind of each node as a child."""
    content = list(WORDS).index("content")

    def kind(i: int) -> int:
        if tree.text[i] is not None:
            return 0
        if tree.tag[i] in NOT_CONTENT or tree.tag[i] == "header" or any(w != content for w in tree.words[i]):
            return 1
        return 2 if tree.tag[i] in ("article", "main") or content in tree.words[i] else 3

    return np.array([kind(i) for i in range(len(tree.parent))])


@dataclass
class PageModel:
    """Weights of the likelihood ratio, and ``log P(child state | parent state)`` by kind of child."""

    weights: np.ndarray
    step: np.ndarray  # kind, parent state, child state
    root: np.ndarray

    def marginals(self, trees: list[Tree]) -> list[np.ndarray]:
        """The probability of content of every node, by messages upward and downward over all trees at once."""
        sizes = np.array([len(t.parent) for t in trees])
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        parent = np.concatenate([np.array(t.parent) + o for t, o in zip(trees, first)])
        parent[first] = -1
        level = np.zeros(len(parent), np.int64)
        for i, p in enumerate(parent):  # parents come before children
            if p >= 0:
                level[i] = level[p] + 1
        ratio = np.concatenate([features(t) for t in trees]) @ self.weights[:-1] + self.weights[-1]
        belief = np.stack((np.zeros(len(ratio)), ratio), 1)
        table = self.step[np.concatenate([kinds(t) for t in trees])]
        message = np.zeros((len(ratio), 2))
        rows = [np.flatnonzero(level == d) for d in range(level.max() + 1)]
        for own in rows[:0:-1]:
            message[own] = np.logaddexp(table[own][:, :, 0] + belief[own, 0:1], table[own][:, :, 1] + belief[own, 1:2])
            np.add.at(belief, parent[own], message[own])
        top = belief.copy()
        top[rows[0]] += self.root
        for own in rows[1:]:
            above = top[parent[own]] - message[own]
            top[own] += np.logaddexp(table[own][:, 0, :] + above[:, 0:1], table[own][:, 1, :] + above[:, 1:2])
        p = 1 / (1 + np.exp(np.clip(top[:, 0] - top[:, 1], -50, 50)))
        return [p[o : o + n] for o, n in zip(first, sizes)]

    def extract(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        trees = [parse(p) for p in pages]
        out = []
        for tree, p in zip(trees, self.marginals(trees) if trees else []):
            out.append("\n".join(t for t, x in zip(tree.text, p) if t is not None and x >= 0.5))
        return out


def labels(tree: Tree) -> np.ndarray | None:
    """States of all nodes of a page whose markup tells them; None if it does not."""
    n = len(tree.parent)
    told = np.full(n, -1)
    content = list(WORDS).index("content")
    named = any(m >= 0 for m in tree.mark) or any(t in ("article", "main") for t in tree.tag)
    if not named:
        return None
    told[0] = 0
    for i in range(1, n):
        p = tree.parent[i]
        told[i] = told[p]
        if tree.text[i] is None:
            if tree.mark[i] >= 0:
                told[i] = tree.mark[i]
            elif tree.tag[i] in ("article", "main"):
                told[i] = 1
            elif tree.tag[i] in NOT_CONTENT or any(w != content for w in tree.words[i]):
                told[i] = 0
    # an element is content when most of its text is
    size, good = np.zeros(n), np.zeros(n)
    for i, text in enumerate(tree.text):
        if text is not None:
            size[i], good[i] = len(text), len(text) * told[i]
    for i in range(n - 1, 0, -1):
        size[tree.parent[i]] += size[i]
        good[tree.parent[i]] += good[i]
    element = np.array([t is None for t in tree.text])
    return np.where(element & (size > 0), good * 2 > size, told == 1).astype(int)


ARTICLE = re.compile(r"<(article|main)\b([^>]*)>(.*?)(</\1\s*>|$)", re.I | re.S)
NEUTRAL = ('div class="post"', 'div class="entry-content"', 'section class="story"', "div", 'div id="main"', "main")
EXTRA = (
    '<aside class="sidebar" data-y="0"><h3>{a}</h3><ul><li><a href="#">{b}</a></li><li><a href="#">{c}</a></li></ul></aside>',
    '<section class="comments" data-y="0"><h3>{a}</h3><div class="comment"><p>{b}</p></div><div class="comment"><p>{c}</p></div></section>',
    '<div id="comments" data-y="0"><p>{b}</p><p>{c}</p></div>',
    '<div class="cookie-notice" data-y="0"><p>{a}</p></div>',
    '<form data-y="0"><p>{a}</p><input name="q"></form>',
    '<div class="ad-banner" data-y="0">{b}</div>',
    '<div class="related" data-y="0"><a href="#">{a}</a> <a href="#">{b}</a></div>',
    '<header data-y="0"><p>{a}</p></header>',
    '<div class="widget" data-y="0"><p>{c}</p></div>',
    '<div class="share" data-y="0"><a href="#">{a}</a></div>',
    '<div class="newsletter" data-y="0"><p>{a}</p></div>',
)

GOOD = (
    "<ul><li>{a}</li><li>{b}</li></ul>",
    "<ol><li>{c}</li></ol>",
    "<blockquote>{a}</blockquote>",
    "<h2>{b}</h2><p>{c}</p>",
    "<table><tr><td>{a}</td><td>{b}</td></tr></table>",
)


def variants(page: str, seed: int) -> list[str]:
    """The page itself and labelled changes of it; empty if its markup names no article."""
    found = ARTICLE.search(page)
    if not found:
        return []
    draw = np.random.default_rng(seed)
    said = [t for t in re.split(r"(?<=\.) |[<>]", found.group(3)) if len(t) > 20] or ["more."]

    def filled(block: str, most: int) -> str:
        return block.format(**{k: str(said[draw.integers(0, len(said))])[:most] for k in "abc"})

    def some(n: int) -> str:
        return "".join(filled(EXTRA[i], 200) for i in draw.choice(len(EXTRA), n, replace=False))

    out = [page]
    for _ in range(3):
        opening = NEUTRAL[draw.integers(0, len(NEUTRAL))]
        inner = found.group(3)
        if draw.random() < 0.5:
            inner += filled(GOOD[draw.integers(0, len(GOOD))], 30)
        if draw.random() < 0.8:
            inner += some(1)
        body = f'<{opening} data-y="1">{inner}</{opening.split()[0]}>'
        out.append(page[: found.start()] + some(2) + body + some(2) + page[found.end() :])
    kept = found.group(0) + some(2)
    out.append(page[: found.start()] + some(1) + kept + page[found.end() :])
    bare = re.sub("<(p|h1)>", r'<\1 data-y="1">', found.group(3))
    out.append(f"<html><body>{some(1)}{bare}{some(1)}</body></html>")
    return out


# shares of child states by parent state before any page is seen, worth 50 nodes each
STEP_PRIOR = np.array([
    [[0.99, 0.01], [0.01, 0.99]],
    [[0.99, 0.01], [0.98, 0.02]],
    [[0.30, 0.70], [0.05, 0.95]],
    [[0.95, 0.05], [0.05, 0.95]],
])
PRIOR = {"article": 3.0, "main": 3.0, "nav": -4.0, "footer": -4.0, "aside": -4.0, "form": -4.0, "header": -3.0}


def prior_weights() -> np.ndarray:
    """Weights before any page is seen: what the names of tags and classes mean."""
    w = np.zeros(N_FEATURES + 1)
    for tag, value in PRIOR.items():
        w[TAGS.index(tag)] = value
    for i, name in enumerate(WORDS):
        w[len(TAGS) + 1 + i] = 2.0 if name == "content" else -3.0
    w[len(TAGS) + 1 + len(WORDS) + 1] = -3.0
    return w


@dataclass(frozen=True)
class PageText:
    """``sample_rows`` bounds the pages of the fit; ``smoothing`` is added to the shares of parent and child states."""

    sample_rows: int = 500
    smoothing: float = 0.001
    seed: int = 3

    def fit(self, pages: DataFrame) -> PageModel:
        """Train on a bounded sample of labelled pages; only these reach the driver."""
        named = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]")).select("html", F.xxhash64("html").alias("mark"))
        n = named.select("mark").distinct().count()
        share = min(1.0, self.sample_rows / n) if n else 0.0
        picked = named.where(F.pmod(F.xxhash64("mark"), F.lit(1 << 20)) < int(share * (1 << 20)))
        # about ``sample_rows`` different pages
        rows = picked.groupBy("mark").agg(F.first("html").alias("html")).orderBy("mark").collect()
        xs, ys = [], []
        step = 50 * STEP_PRIOR
        for i, r in enumerate(rows):
            for page in variants(r.html, self.seed * 1_000_003 + i):
                tree = parse(page)
                state = labels(tree)
                if state is None:
                    continue
                xs.append(features(tree))
                ys.append(state)
                above = np.array(tree.parent[1:], int)
                np.add.at(step, (kinds(tree)[1:], state[above], state[1:]), 1)
        # pages of other sites are less regular than those seen
        step = step / np.maximum(step.sum(2, keepdims=True), 1) + self.smoothing * (1 + 4 * np.eye(2))
        w = prior_weights()
        share = 0.5
        if xs:
            x, y = np.concatenate(xs), np.concatenate(ys).astype(float)
            share = float(np.clip(y.mean(), 0.02, 0.98))
            x = np.hstack((x, np.ones((len(x), 1))))
            w = _logistic(x, y, w)
            w[-1] -= np.log(share / (1 - share))  # a likelihood ratio, without the share of content
        return PageModel(w, np.log(step / step.sum(2, keepdims=True)), np.log(np.array([1 - share, share])))

    def run(self, pages: DataFrame, model: PageModel) -> DataFrame:
        """``page_id, url, text, n_chars`` of every row."""
        shared = pages.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                source = batch.column("html").fill_null("").to_pylist()
                for low in range(0, len(source), 200):
                    texts = shared.value.extract(source[low : low + 200])
                    yield {
                        "page_id": batch.column("page_id").slice(low, 200),
                        "url": batch.column("url").slice(low, 200),
                        "text": texts,
                        "n_chars": [len(t) for t in texts],
                    }

        bounded_batches(pages.sparkSession)
        return map_batches(
            pages.select(F.col("page_id").cast("bigint"), "url", "html"), read, "page_id bigint, url string, text string, n_chars bigint"
        )


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Newton steps with Gaussian priors."""
    w, weight = prior.copy(), 50.0
    for _ in range(15):
        mean = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (mean * (1 - mean))[:, None]).T @ x + weight * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, x.T @ (y - mean) - weight * (w - prior)), -2, 2)
    return w
