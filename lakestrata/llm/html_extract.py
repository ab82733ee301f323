"""Main text of HTML pages by gradient-boosted trees over DOM nodes.

Each node of a page has features of its subtree (text, density, links), its
attributes' words, its depth, its ancestors and its siblings.  Boosted
regression trees give the log-odds that a node holds article text.  Hierarchical
decoding picks the most likely labels of the whole tree under one rule: a node
can only be kept if its parent is.  So no paragraph is kept inside a dropped
menu, and no container is dropped above a kept paragraph.

The trees are trained here, on pages that are put together from paragraphs of
a bounded sample of the table's own pages (``SAMPLE_PAGES``): articles in
various wrappers, among and around menus, headers, footers, sidebars, notices,
adverts, forms, and reader comments, each labelled as it is made.

Scale: training is one task over the sample; extraction is one pass over the
pages without a shuffle, with trees and decoding on arrays of many pages.

Defined cases: a null or empty page has an empty text; text without any element
is judged as the body's; repeated rows are extracted alike; without paragraphs
to learn from, training texts are numbered filler; extra columns are ignored.
Blocks are the texts between starts and ends of block elements; a line break
counts as white space; white space is what ``str.split`` takes for it.
"""

from __future__ import annotations

import html as entities
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import blocks, materialize
from lakestrata.llm.html_dom import Forest, Page, features, parse

SAMPLE_PAGES = 300
MADE_PAGES = 700
SAMPLE_CHARS = 2_000  # of one paragraph that is reused in training pages
TREES, DEPTH, RATE, BINS, RIDGE = 60, 5, 0.25, 32, 1.0
ROWS_PER_TREE = 0.6


class BoostedTrees:
    """Complete binary trees over binned features, for logistic loss."""

    def __init__(self, edges: list[np.ndarray], start: float):
        self.edges, self.start = edges, start
        self.feature, self.cut, self.leaf = [], [], []  # of each tree: per inner node, per leaf

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
        base = float(np.clip((weight * y).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        model = cls(edges, float(np.log(base / (1 - base))))
        b = model.binned(x)
        k = b.shape[1]
        offsets = np.arange(k) * BINS
        score = np.full(len(b), model.start)
        rng = np.random.default_rng(1)
        whole_b, whole_y, whole_weight = b, y, weight
        for _ in range(TREES):
            rows = np.flatnonzero(rng.random(len(whole_b)) < ROWS_PER_TREE)
            b, y, weight, n = whole_b[rows], whole_y[rows], whole_weight[rows], len(rows)
            p = 1 / (1 + np.exp(-score[rows]))
            g, h = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight
            where = np.zeros(n, dtype=np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, BINS, dtype=np.int64)
            for level in range(DEPTH):
                width = 2**level
                cells = (where[:, None] * (k * BINS) + offsets + b).ravel()
                sums = [np.bincount(cells, weights=np.repeat(v, k), minlength=width * k * BINS).reshape(width, k, BINS).cumsum(axis=2) for v in (g, h)]
                whole = [s[:, :, -1:] for s in sums]
                gain = sum((s**2) / (t + RIDGE) for s, t in ((sums[0], sums[1]), (whole[0] - sums[0], whole[1] - sums[1])))
                best = gain.reshape(width, -1).argmax(axis=1)
                at = width - 1 + np.arange(width)
                feature[at], cut[at] = best // BINS, best % BINS
                where = 2 * where + (b[np.arange(n), feature[at][where]] > cut[at][where])
            gs, hs = (np.bincount(where, weights=v, minlength=2**DEPTH) for v in (g, h))
            leaf = -RATE * gs / (hs + RIDGE)
            model.feature.append(feature)
            model.cut.append(cut)
            model.leaf.append(leaf)
            score += model.tree(whole_b, feature, cut, leaf)
        return model

    @staticmethod
    def tree(b: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        rows, at = np.arange(len(b)), np.zeros(len(b), dtype=np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
        return leaf[at - (2**DEPTH - 1)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        score = np.full(len(b), self.start)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            score += self.tree(b, feature, cut, leaf)
        return score


def decode(forest: Forest, log_odds: np.ndarray) -> np.ndarray:
    """The most likely keep/drop labels in which every kept node's parent is
    kept.  ``gain`` is a subtree's best log-likelihood with its root kept, over
    that with all of it dropped."""
    gain = log_odds.copy()
    for level in reversed(forest.levels[1:]):
        np.add.at(gain, forest.parent[level], np.maximum(gain[level], 0))
    kept = gain > 0
    for level in forest.levels[1:]:
        kept[level] &= kept[forest.parent[level]]
    return kept


def labels(forest: Forest) -> np.ndarray:
    """1 for nodes that hold article text or lie in the article, by marks."""
    inside = np.where(forest.mark >= 0, forest.mark, 0)
    for level in forest.levels[1:]:
        inside[level] = np.where(forest.mark[level] >= 0, forest.mark[level], inside[forest.parent[level]])
    return (forest.up(np.where(inside == 1, forest.own_chars + 1e-3, 0.0)) > 0).astype(float)


class PageMaker:
    """Training pages from paragraphs; marks say what is article text."""

    def __init__(self, paragraphs: list[str], seed: int):
        self.rng = np.random.default_rng(seed)
        self.paragraphs = paragraphs or [f"Filler sentence number {i}, for want of text." for i in range(50)]

    def pick(self, *options: str) -> str:
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def text(self, most: int = 10_000) -> str:
        return entities.escape(self.paragraphs[int(self.rng.integers(len(self.paragraphs)))][:most], quote=False)

    def pick_length(self) -> int:
        return int(self.rng.choice([20, 60, 300, SAMPLE_CHARS]))

    def few(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def links(self) -> str:
        return "".join(f'<li><a href="/x">{self.text(12)}</a></li>' for _ in self.few(3, 9))

    def boilerplate(self, inside: bool) -> str:
        """One unwanted region, marked 0."""
        kind = self.pick("menu", "advert", "side", "notice", "form", "comments", "share", "advert", "related", *([] if inside else ["header", "footer", "menu", "footer"]))
        mark = 'data-keep="0"'
        name = lambda *words: f'{self.pick("class", "class", "id")}="{self.pick(*words)}"'
        if kind == "menu":
            return self.pick(f"<nav {mark}><ul>{self.links()}</ul></nav>", f"<div {mark} {name('menu', 'nav-bar', 'navigation', 'breadcrumbs', 'pagination')}><ul>{self.links()}</ul></div>", f"<ul {mark} {name('menu', 'nav')}>{self.links()}</ul>")
        if kind == "advert":
            body = self.pick(self.text(120), f"<p>{self.text(150)}</p>", f'<a href="/x">{self.text(60)}</a>')
            return self.pick(f"<div {mark} {name('ad', 'ads', 'advert', 'sponsored', 'promo', 'banner')}>{body}</div>", f"<aside {mark} {name('ad', 'advertisement', 'sponsor')}>{body}</aside>", f"<section {mark} {name('promo-box', 'ad-slot')}>{body}</section>")
        if kind in ("side", "related"):
            body = f"<h3>{self.text(20)}</h3>" + self.pick(f"<ul>{self.links()}</ul>", f"<p>{self.text(200)}</p>", "".join(f"<p>{self.text(300)}</p>" for _ in self.few(1, 3)))
            return self.pick(f"<aside {mark}>{body}</aside>", f"<aside {mark} {name('sidebar', 'related', 'widget')}>{body}</aside>", f"<div {mark} {name('sidebar', 'side', 'related-posts', 'widget', 'recommended')}>{body}</div>")
        if kind == "notice":
            body = self.pick(f"<p>{self.text(200)}</p>", self.text(150), f"<p>{self.text(80)}</p><button>{self.text(8)}</button>")
            return self.pick(f"<div {mark} {name('notice', 'cookie-notice', 'cookie-banner', 'alert', 'consent', 'disclaimer', 'popup')}>{body}</div>", f'<section {mark} role="alert" {name("notice", "message")}>{body}</section>')
        if kind == "form":
            body = f'<label>{self.text(15)}</label><input type="text"><button>{self.text(10)}</button>'
            return self.pick(f"<form {mark}>{body}</form>", f"<form {mark} {name('search', 'login', 'newsletter')}><p>{self.text(60)}</p>{body}</form>", f"<div {mark} {name('newsletter', 'signup', 'search-form')}><form>{body}</form></div>")
        if kind == "comments":
            one = lambda: self.pick(f'<div class="comment"><p>{self.text(300)}</p></div>', f"<li><b>{self.text(10)}</b><p>{self.text(300)}</p></li>", f"<p>{self.text(250)}</p>")
            body = f"<h2>{self.text(12)}</h2>" + "".join(one() for _ in self.few(1, 6))
            return self.pick(f"<section {mark} {name('comments', 'reader-comments', 'discussion')}>{body}</section>", f"<div {mark} {name('comments', 'comment-list', 'respond')}>{body}</div>", f"<ol {mark} {name('commentlist', 'comments')}>{body}</ol>")
        if kind == "share":
            return f"<div {mark} {name('share', 'social', 'share-buttons', 'follow')}>" + "".join(f'<a href="/x">{self.text(9)}</a> ' for _ in self.few(2, 5)) + "</div>"
        if kind == "header":
            body = self.pick(self.text(30), f'<a href="/">{self.text(15)}</a><p>{self.text(60)}</p>', f"<h2>{self.text(20)}</h2><nav><ul>{self.links()}</ul></nav>")
            return self.pick(f"<header {mark}>{body}</header>", f"<div {mark} {name('header', 'masthead', 'top-bar')}>{body}</div>")
        body = self.pick(f"&copy; {self.text(80)}", f"<p>&copy; {self.text(120)}</p><ul>{self.links()}</ul>", f"<p>{self.text(250)}</p>")
        return self.pick(f"<footer {mark}>{body}</footer>", f"<div {mark} {name('footer', 'bottom', 'copyright', 'legal')}>{body}</div>")

    def article(self) -> str:
        title = self.text(int(self.rng.integers(3, 90)))
        parts = [self.pick(*[f"<h1>{title}</h1>"] * 4, f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>", f"<h1>{title}</h1><p><b>{title}<br>", f"<h1>{title}</h1><p>{title}</p>")]
        for _ in self.few(0, 14):
            one = self.text(int(self.rng.integers(3, self.pick_length())))
            parts.append(self.pick(
                *[f"<p>{one}</p>"] * 8, f"<p>{one}", f"<p><b>{one}<br>", f"<h2>{self.text(50)}</h2><p>{one}</p>", f"<blockquote><p>{one}</p></blockquote>",
                f"<ul>{''.join(f'<li>{self.text(80)}</li>' for _ in self.few(2, 5))}</ul>", f'<p>{one} <a href="/x">{self.text(20)}</a> {self.text(100)}</p>',
                f"<div>{one}</div>", f"{one}<br><br>", f"<table><tr><td>{self.text(30)}</td><td>{self.text(30)}</td></tr></table>", f"<pre>{self.text(200)}</pre>",
                f"<figure><img src='x'><figcaption>{self.text(60)}</figcaption></figure>",
            ))
            if self.chance(0.08):
                parts.append(self.boilerplate(True))
        body = "".join(parts)
        return self.pick(
            *[f'<article data-keep="1">{body}</article>'] * 4, f'<main><article data-keep="1">{body}</article></main>', f'<main data-keep="1">{body}</main>',
            f'<div data-keep="1" class="{self.pick("content", "post", "entry-content", "article-body", "story", "text")}">{body}</div>', f'<div data-keep="1">{body}</div>',
            f'<section data-keep="1" id="{self.pick("content", "main", "post-body")}">{body}</section>',
        )

    def page(self) -> str:
        around = lambda low, high: "".join(self.boilerplate(False) for _ in self.few(low, high))
        inner = around(0, 3) + self.article() + around(0, 3)
        inner = self.pick(inner, inner, f'<div id="{self.pick("wrapper", "page", "container")}">{inner}</div>', f"<main>{inner}</main>")
        return f"<!DOCTYPE html><html><head><title>{self.text(40)}</title></head><body>{around(0, 2)}{inner}{around(0, 2)}</body></html>"


def train(paragraphs: list[str], pages: int = MADE_PAGES, seed: int = 3) -> BoostedTrees:
    maker = PageMaker(paragraphs, seed)
    forest = Forest([parse(maker.page()) for _ in range(pages)])
    y = labels(forest)
    return BoostedTrees.fit(features(forest), y, 1 + np.log1p(forest.up(forest.own_chars)) / 4)


def page_text(page: Page, kept: np.ndarray) -> str:
    """Texts of kept nodes: blocks in page order, one line each."""
    out: list[str] = []
    now, held = None, []
    for node, block, raw in [*page.texts, (-1, -1, "")]:
        if block != now:
            line = " ".join(entities.unescape("".join(held)).split())
            if line:
                out.append(line)
            now, held = block, []
        if node >= 0 and kept[node]:
            held.append(raw)
    return "\n".join(out)


def extract_all(pages: list[str], model: BoostedTrees) -> list[str]:
    parsed = [parse(x, marked=False) for x in pages]
    forest = Forest(parsed)
    kept = decode(forest, model.log_odds(features(forest)))
    return [page_text(p, kept[a:b]) for p, a, b in zip(parsed, forest.first[:-1], forest.first[1:], strict=True)]


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> BoostedTrees:
    """Trees trained on pages made of paragraphs of a bounded sample."""
    ids = pages.filter("html is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    ids = materialize(ids, "page-sample")
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).join(F.broadcast(ids), "page_id")  # at most sample_pages ids
    rows = rows.groupBy("page_id").agg(F.min("html").alias("html"))
    rows = materialize(rows, "page-texts").coalesce(1).sortWithinPartitions("page_id").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paragraphs: list[str] = []
        for batch in batches:
            for x in batch.column(0).to_pylist():
                page = parse(x, marked=False)
                held: dict[int, str] = {}
                for node, block, raw in page.texts:
                    held[block] = held.get(block, "") + raw[:SAMPLE_CHARS]
                lines = [" ".join(entities.unescape(t).split()) for t in held.values()]
                paragraphs += [t for t in lines if len(t) >= 40][:40]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_plain(train(paragraphs)))], pa.binary())], names=["model"])

    found = rows.mapInArrow(run, "model binary").collect()  # one row: a few thousand numbers
    return _trees(pickle.loads(found[0].model)) if found else train([], pages=100)


def _plain(model: BoostedTrees) -> tuple:
    return model.edges, model.start, model.feature, model.cut, model.leaf


def _trees(state: tuple) -> BoostedTrees:
    model = BoostedTrees(state[0], state[1])
    model.feature, model.cut, model.leaf = state[2:]
    return model


def extract(pages: DataFrame, model: BoostedTrees) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(_plain(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(shared.value)
        for batch, raw in blocks(batches, "html"):
            texts = extract_all([x.decode() for x in raw], trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
