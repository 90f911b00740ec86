"""Main-text extraction: gradient-boosted trees over DOM nodes and a hierarchical decoding.

A page is parsed into block elements and text blocks (runs of inline content). Each node gets features of its subtree
(text and link density, punctuation), attribute tokens of itself and its ancestors, depth and siblings. The trees give
the probability that a node holds main text; the decoding then picks the most likely labelling in which nothing below a
dropped node is kept. The trees are trained here on a bounded sample of pages, labelled by their semantic elements, and
on generated layouts filled with the sample's words.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmart.llm.common import steps

INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr "
                    # containers whose text is part of what surrounds them: fallbacks, formulas, drawings
                    "noscript object canvas audio video iframe picture svg g text tspan textpath math semantics annotation mrow mi mn mo ms mtext "
                    "mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mpadded mphantom").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are no text of the page: code, what stands in the head, and what forms hold.
SILENT = frozenset("script style template title select option textarea datalist".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
TAGS = (("article",), ("main",), ("section",), ("div",), ("p", "blockquote", "pre"), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li", "dt", "dd"),
        ("ul", "ol", "dl"), ("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "dialog"),
        ("table", "tbody", "tr", "td", "th"), ("body", "html", "#page"))
TOKENS = ("article|content|main|post|entry|story|body|text|read|page", "nav|navbar|menu|breadcrumb|breadcrumbs|tabs|pagination|pager|toc",
          "footer|copyright|legal|colophon|bottom", "header|masthead|banner|logo|top|topbar|hero", "sidebar|side|aside|widget|rail|column",
          "related|recommended|recommend|popular|trending|more|teaser|read-more|latest", "ad|ads|adv|advert|advertisement|adsense|sponsor|sponsored|promo|promotion|dfp|banner-ad",
          "comment|comments|reply|replies|discussion|disqus|respond|reader|feedback|thread",
          "cookie|cookies|consent|notice|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|alert|paywall|message|privacy|signup",
          "share|social|follow|sharing|like|tweet|facebook|twitter", "search|login|form|input|register|signin")
TOKEN_GROUP = {w: i for i, g in enumerate(TOKENS) for w in g.split("|")}
WORD = re.compile(r"[a-z]+")


class Page(HTMLParser):
    """Nodes in page order; node 0 is the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens, self.is_text = ["#page"], [-1], [frozenset()], [False]
        self.text: list[str] = [""]
        self.linked = [0]
        self.stack, self.run, self.run_links, self.links, self.silent = [0], [], 0, 0, []
        self.open: dict[str, int] = {}

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.add("#text", frozenset(), True)
                self.text[-1] = text
                self.linked[-1] = min(self.run_links, len(text))
            self.run, self.run_links = [], 0

    def add(self, tag: str, tokens: frozenset, text: bool) -> int:
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        self.tokens.append(tokens)
        self.is_text.append(text)
        self.text.append("")
        self.linked.append(0)
        return len(self.tag) - 1

    def pop(self) -> None:
        self.flush()
        tag = self.tag[self.stack.pop()]
        self.open[tag] -= 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if self.silent:
            return
        if tag == "br":
            self.run.append(" ")
        elif tag in INLINE:
            self.links += tag == "a"
        elif tag in VOID:
            if tag == "hr":
                self.flush()
        else:
            self.flush()
            self.links = 0
            top = self.tag[self.stack[-1]]
            if top == "p" or re.fullmatch("h[1-6]", top) and re.fullmatch("h[1-6]|p", tag):
                self.pop()
            shut = CLOSES.get(tag, ())
            while len(self.stack) > 1 and self.tag[self.stack[-1]] in shut:
                self.pop()
            words = " ".join(v for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label") and v).lower()
            node = self.add(tag, frozenset(TOKEN_GROUP[w] for w in WORD.findall(words) if w in TOKEN_GROUP), False)
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
                return
            if not self.open.get(tag):
                return
            self.silent.clear()  # the end of an element around it ends one that was not closed
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag not in INLINE and tag not in VOID and self.open.get(tag):
            while self.tag[self.stack[-1]] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data: str) -> None:
        if not self.silent and self.stack:
            self.run.append(data)
            if self.links:
                self.run_links += len(data)


def parse(html: str | None) -> Page:
    page = Page()
    if html:
        page.feed(html)
        page.close()
        page.flush()
    return page


def features(page: Page) -> np.ndarray:
    """One row of features for each node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own = np.array([(len(t), x, t.count(" ") + bool(t), sum(map(t.count, ".,;!?")), t.count("©") + t.count("|") + t.count("·") + t.count("»"),
                     1, bool(t), sum(c.isdigit() for c in t) if len(t) < 400 else 0) for t, x in zip(page.text, page.linked, strict=True)], float)
    tot, depth = own.copy(), np.zeros(n)
    kids, index, text_before = np.zeros(n), np.zeros(n), np.zeros(n)
    groups = len(TOKENS)
    tok, above = np.zeros((n, groups)), np.zeros((n, groups))
    tag_no = {t: i for i, g in enumerate(TAGS) for t in g}
    tags, tags_above = np.zeros((n, len(TAGS) + 1)), np.zeros((n, len(TAGS)))
    seen = 0.0
    for i in range(n):
        p = parent[i]
        text_before[i] = seen
        seen += own[i, 0]
        for g in page.tokens[i]:
            tok[i, g] = 1
        t = tag_no.get(page.tag[i], len(TAGS))
        tags[i, t] = 1
        if i:
            depth[i] = depth[p] + 1
            index[i] = kids[p]
            kids[p] += 1
            above[i] = above[p] + tok[p]
            tags_above[i] = tags_above[p] + tags[p, :-1]
    for i in range(n - 1, 0, -1):
        tot[parent[i]] += tot[i]
    up = np.maximum(parent, 0)
    whole = max(tot[0, 0], 1)
    chars = np.maximum(tot[:, 0], 1)
    cols = [depth, np.log1p(tot[:, 0]), tot[:, 0] / whole, tot[:, 1] / chars, tot[:, 0] / tot[:, 5], tot[:, 3] / np.maximum(tot[:, 2], 1),
            tot[:, 2] / np.maximum(tot[:, 6], 1), tot[:, 4], tot[:, 7] / chars, kids, index, kids[up], (index + 1) / np.maximum(kids[up], 1),
            text_before / whole, tot[up, 1] / chars[up], np.log1p(tot[up, 0]), chars / chars[up], np.array(page.is_text, float),
            tot[:, 0] / np.maximum(tot[:, 6], 1)]
    return np.concatenate([np.stack(cols, 1), tags, np.minimum(tags_above, 1), tok, np.minimum(above, 1)], axis=1)


@dataclass
class BoostedTrees:
    """Gradient boosting with complete trees of fixed depth on binned features, logistic loss."""

    depth: int = 4
    trees: int = 60
    rate: float = 0.2
    bins: int = 32
    start: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    above: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
        width = max(len(e) for e in edges) + 1
        mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, above = np.zeros(2 ** self.depth - 1, np.int64), np.full(2 ** self.depth - 1, np.inf)
            for level in range(self.depth):
                size, first = 2 ** level, 2 ** level - 1
                best = np.full(size, 1e-6)
                cut = np.full(size, width)
                pick = np.zeros(size, np.int64)
                for f in range(x.shape[1]):
                    if not len(edges[f]):
                        continue
                    at = node * width + binned[:, f]
                    gs = np.bincount(at, g, size * width).reshape(size, width).cumsum(1)
                    hs = np.bincount(at, h, size * width).reshape(size, width).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = (gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1))[:, :len(edges[f])]
                    gain = np.where((hs[:, :len(edges[f])] > 1) & ((ht - hs)[:, :len(edges[f])] > 1), gain, 0)
                    b = gain.argmax(1)
                    won = gain[np.arange(size), b] > best
                    best[won], cut[won], pick[won] = gain[np.arange(size), b][won], b[won], f
                for k in range(size):
                    if cut[k] < width:
                        feature[first + k], above[first + k] = pick[k], edges[pick[k]][cut[k]]
                node = node * 2 + (binned[np.arange(len(y)), pick[node]] > cut[node])
            gs, hs = np.bincount(node, g, 2 ** self.depth), np.bincount(node, h, 2 ** self.depth)
            leaf = -self.rate * gs / (hs + 1)
            score += leaf[node]
            self.feature.append(feature)
            self.above.append(above)
            self.leaf.append(leaf)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, above, leaf in zip(self.feature, self.above, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            out += leaf[node - (2 ** self.depth - 1)]
        return out


def decode(parent: list[int], logit: np.ndarray) -> np.ndarray:
    """Keep or drop for each node: the most likely labelling in which a dropped node's descendants are dropped."""
    logit = np.clip(logit, -20, 20)
    keep, drop = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    for i in range(len(parent) - 1, 0, -1):  # children stand after their parents
        keep[parent[i]] += max(keep[i], drop[i])
        drop[parent[i]] += drop[i]
    out = keep >= drop
    for i in range(1, len(parent)):
        out[i] &= out[parent[i]]
    return out


def main_texts(pages: list[Page], model: BoostedTrees) -> list[str]:
    x = [features(p) for p in pages]
    logit = model.logit(np.concatenate(x)) if x else np.empty(0)
    out, at = [], 0
    for p, f in zip(pages, x, strict=True):
        kept = decode(p.parent, logit[at:at + len(f)])
        out.append("\n\n".join(t for t, k in zip(p.text, kept, strict=True) if t and k))
        at += len(f)
    return out


NOT_MAIN = frozenset("nav header footer aside form fieldset button dialog menu".split())


def weak_labels(page: Page) -> np.ndarray | None:
    """1 for nodes that hold text of the semantic main element, outside elements of other purposes; None without one."""
    roots = [i for i, t in enumerate(page.tag) if t == "article"] or [i for i, t in enumerate(page.tag) if t == "main"]
    if not roots:
        return None
    inside, top = np.zeros(len(page.tag), bool), set(roots[:1])
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        odd = page.tag[i] in NOT_MAIN or bool(page.tokens[i] & {1, 2, 4, 5, 6, 7, 8, 9, 10})
        inside[i] = i in top or inside[p] and not (odd and i not in top)
    return holders(page, [bool(t) and k for t, k in zip(page.text, inside, strict=True)])


def holders(page: Page, main: list[bool]) -> np.ndarray:
    y = np.array(main, float)
    for i in range(len(y) - 1, 0, -1):
        y[page.parent[i]] = max(y[page.parent[i]], y[i])
    return y


MAIN_MARK = "\ue000"  # a private character that marks main text in generated pages


def layout(rng: random.Random, words: list[str]) -> str:
    """A generated page; main text blocks start with MAIN_MARK."""
    say = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    sentence = lambda a, b: say(a, b).capitalize() + rng.choice([".", ".", "!", "?"])
    para = lambda: " ".join(sentence(4, 18) for _ in range(rng.randint(1, 8)))
    anon = rng.random() < 0.2

    def body_text() -> str:
        """A paragraph of main text, often with links and emphasis inside."""
        text = para()
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            text = text.replace(" ", rng.choice([f' <a href="/{rng.choice(words)}">{say(1, 4)}</a> ', f" <strong>{say(1, 3)}</strong> ", f" &amp; {say(1, 2)}, ", " &quot;"]), 1) if rng.random() < 0.5 else f"{text} {say(1, 6)} <a href=x>{say(1, 3)}</a>."
        return text

    def box(group: str, tags: str, inner: str) -> str:
        tag = rng.choice(tags.split())
        name = rng.choice(TOKENS[TOKEN_GROUP[group]].split("|"))
        if rng.random() < 0.3:
            name = f"{rng.choice(['site', 'block', 'x', 'js', 'c'])}-{name}"
        attr = "" if anon and tag != "div" or rng.random() < 0.12 and tag != "div" else f' {rng.choice(["class", "id"])}="{name}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    link = lambda: f'<a href="/{rng.choice(words)}">{say(1, 4)}</a>'
    menu = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9))) + "</ul>" if rng.random() < 0.7 else " | ".join(link() for _ in range(rng.randint(2, 7)))
    advert = lambda: box("ad", "div div aside section", rng.choice([sentence(3, 12), f"<p>{sentence(3, 15)}</p>", link() + " " + sentence(2, 8)]))
    share = lambda: box("share", "div ul p", " ".join(link() for _ in range(rng.randint(1, 4))))
    notice = lambda: box("cookie", "div section aside", f"<p>{sentence(5, 25)}</p>" + (f"<button>{say(1, 2)}</button>" if rng.random() < 0.6 else ""))
    form = lambda: rng.choice([f"<form>{say(1, 4)}<input><button>{say(1, 2)}</button></form>", box("login", "div section", f"<form><label>{say(1, 2)}</label><input><button>{say(1, 1)}</button></form>")])

    def comment() -> str:
        return box("comment", "div li article", f"<p>{say(1, 2)}</p>" * (rng.random() < 0.5) + f"<p>{para()}</p>")

    comments = lambda: box("comments", "section div", f"<h3>{say(1, 3)}</h3>" + "".join(comment() for _ in range(rng.randint(1, 5))) + (form() if rng.random() < 0.4 else ""))
    related = lambda: box("related", "div aside section", f"<h3>{say(1, 3)}</h3>{menu()}" if rng.random() < 0.7 else "".join(f"<p>{link()} {sentence(3, 10)}</p>" for _ in range(3)))
    sidebar = lambda: box("sidebar", "aside div", "".join(rng.choice([related, advert, form, lambda: f"<p>{sentence(3, 20)}</p>"])() for _ in range(rng.randint(1, 3))))
    blocks = [f"<h1>{MAIN_MARK}{say(2, 12)}</h1>"] if rng.random() < 0.85 else []
    if blocks and rng.random() < 0.2:
        blocks = [f"<header>{blocks[0]}</header>"]
    for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14])):
        kind = rng.random()
        if kind < 0.7:
            blocks.append(f"<p>{MAIN_MARK}{rng.choice(['', '<b>', '<em>'])}{body_text()}" + rng.choice(["</p>", "</p>", "", "<br></p>", "<br>"]))
        elif kind < 0.78:
            blocks.append(f"<{(h := rng.choice(['h2', 'h3']))}>{MAIN_MARK}{say(1, 8)}</{h}>")
        elif kind < 0.85:
            blocks.append("<ul>" + "".join(f"<li>{MAIN_MARK}{say(2, 14)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.9:
            blocks.append(f"<blockquote><p>{MAIN_MARK}{body_text()}</p></blockquote>" if rng.random() < 0.5 else f"<pre>{MAIN_MARK}{para()}</pre>")
        elif kind < 0.93:
            blocks.append("<table>" + "".join(f"<tr><td>{MAIN_MARK}{say(1, 4)}</td><td>{MAIN_MARK}{say(1, 4)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>")
        else:
            blocks.append(f"<div>{MAIN_MARK}{body_text()}</div>")
        if rng.random() < 0.12:
            blocks.append(rng.choice([advert, share, related, form, notice])())
    if rng.random() < 0.2:
        blocks.append(share())
    inner_comments = rng.random() < 0.15
    body = "".join(blocks) + (comments() if inner_comments else "")
    style = rng.random()
    if style < 0.5:
        body = f"<article{rng.choice(['', ' class=post', ' id=content'])}>{body}</article>"
    elif style < 0.7:
        body = f"<main>{body}</main>"
    elif style < 0.95:
        body = box("article", "div div section", body)
    for _ in range(rng.choice([0, 0, 1, 2])):
        body = rng.choice(["<div>{}</div>", '<div class="container">{}</div>', '<div class="row wrap">{}</div>', "<main>{}</main>", "<section>{}</section>"]).format(body)
    before = [f for f, p in ((lambda: box("header", "header div", link() + " " + say(1, 5)), 0.5), (lambda: box("nav", "nav nav div", menu()), 0.7),
                             (notice, 0.25), (advert, 0.35), (form, 0.15), (sidebar, 0.15)) if rng.random() < p]
    after = [f for f, p in ((related, 0.25), (comments, 0.3 if not inner_comments else 0), (sidebar, 0.3), (advert, 0.25), (form, 0.15), (notice, 0.2),
                            (lambda: box("footer", "footer footer div", rng.choice(["&copy; ", "", "&middot; "]) + sentence(2, 15) + (menu() if rng.random() < 0.4 else "")), 0.8))
             if rng.random() < p]
    return f"<html><head><title>{say(2, 6)}</title></head><body>{''.join(f() for f in before)}{body}{''.join(f() for f in after)}</body></html>"


def marked(page: Page) -> np.ndarray:
    main = [t.startswith(MAIN_MARK) for t in page.text]
    page.text = [t.removeprefix(MAIN_MARK) for t in page.text]
    return holders(page, main)


SAMPLE_PAGES, LAYOUTS = 200, 700


def train(pages: DataFrame, *, html_col: str = "html", sample_pages: int = SAMPLE_PAGES, layouts: int = LAYOUTS, seed: int = 3) -> BoostedTrees:
    """Fit on about ``sample_pages`` pages (chosen by a hash of the html) and ``layouts`` generated ones."""
    rows = pages.select(F.col(html_col).alias("html")).filter("html is not null")
    n = rows.count()
    draw = F.pmod(F.xxhash64(F.lit(13), "html"), F.lit(1_000_000))
    got = rows.filter(draw < F.lit(int(1_000_000 * min(1.0, sample_pages / max(n, 1))))).orderBy(draw).limit(2 * sample_pages).collect()
    rng, x, y, words = random.Random(seed), [], [], []
    for r in got:
        page = parse(r.html)
        words += [w.strip(".,;!?") for t in page.text for w in t.split()]
        label = weak_labels(page)
        if label is not None:
            x.append(features(page))
            y.append(label)
    words = sorted({w for w in words if w.isalpha()}) or ["lorem", "ipsum", "dolor", "sit", "amet", "elit"]
    for _ in range(layouts):
        page = parse(layout(rng, words))
        y.append(marked(page))
        x.append(features(page))
    return BoostedTrees().fit(np.concatenate(x), np.concatenate(y))


def extract(pages: DataFrame, model: BoostedTrees, *, key_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``(<key_cols>, text, n_chars)`` for every row: the kept text blocks in page order, joined by a blank line.

    A null or empty html, or one without main text, gives an empty text. White space inside a block becomes one space.
    Whole pages are parsed, however long or broken; repeated rows give repeated rows; other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    narrow = pages.select(F.struct(*(F.col(c) for c in key_cols)).alias("key"), F.col(html_col).alias("html"))
    key_type, kind = to_arrow_type(narrow.schema[0].dataType), narrow.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, htmls in steps(batches):
            texts = main_texts([parse(h) for h in htmls], model)
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["key", "text", "n_chars"])

    found = narrow.mapInArrow(run, f"key {kind}, text string, n_chars long")
    return found.select(*(F.col("key").getField(c).alias(c) for c in key_cols), "text", "n_chars")
